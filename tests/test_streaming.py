"""Structured Streaming landing gives the batch fact's JSON rows."""

import os
import tempfile

from hirelake.operators import fact as fact_ops
from hirelake.sources import adapters as ad
from hirelake.streaming import landing
from oracle import canonical, spark_rows


def test_stream_matches_batch(spark, smoke_dir):
    base = tempfile.mkdtemp(prefix="hirelake-stream-")
    pages = ad.raw_pages(spark, smoke_dir)
    pages.write.mode("overwrite").json(os.path.join(base, "landing"))
    q = landing.write_parquet(landing.fact_stream(landing.page_stream(spark, os.path.join(base, "landing"))),
                              os.path.join(base, "out"), os.path.join(base, "ckpt"))
    q.awaitTermination(300)
    streamed = spark.read.parquet(os.path.join(base, "out"))
    from hirelake.sources.tables import read_pages
    batch = fact_ops.json_postings(fact_ops.archive_rows(read_pages(spark, os.path.join(base, "landing"))))
    assert canonical(*spark_rows(streamed)) == canonical(*spark_rows(batch))
    # A restart from the checkpoint processes nothing twice.
    q2 = landing.write_parquet(landing.fact_stream(landing.page_stream(spark, os.path.join(base, "landing"))),
                               os.path.join(base, "out"), os.path.join(base, "ckpt"))
    q2.awaitTermination(300)
    assert spark.read.parquet(os.path.join(base, "out")).count() == batch.count()


def test_stream_daily_counts_and_dedup(spark, smoke_dir):
    base = tempfile.mkdtemp(prefix="hirelake-stream-")
    ad.raw_pages(spark, smoke_dir).write.mode("overwrite").json(os.path.join(base, "landing"))
    postings = landing.fact_stream(landing.page_stream(spark, os.path.join(base, "landing")))
    q = (landing.daily_counts(postings).writeStream.format("memory").queryName("daily_counts")
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination(300)
    q = (landing.dedup_jobs(postings).writeStream.format("memory").queryName("dedup_jobs")
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination(300)
    dedup = spark.sql("SELECT job_id FROM dedup_jobs")
    assert dedup.count() == dedup.distinct().count() > 0
    # Every day the watermark has closed carries the batch count.
    from hirelake.operators import marts
    batch = {r.search_date: r.jobs_daily for r in marts.health_jobs_daily(
        fact_ops.json_postings(fact_ops.archive_rows(ad.raw_pages(spark, smoke_dir)))).collect()
        if r.search_date is not None}
    streamed = {r.search_date: r.jobs_daily for r in spark.sql("SELECT * FROM daily_counts").collect()}
    assert streamed and all(batch[d] == n for d, n in streamed.items())
    assert len(streamed) >= len(batch) - 2
