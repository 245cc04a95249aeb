"""Structured Streaming over a landing folder of raw pages (extension).

The batch operators are stateless projections, so the same functions build
the streaming fact: file source -> archive rows (page metadata) -> JSON
postings.  Stateful parts use watermarks: a per-day posting count with a
one-day tumbling window (M14) and de-duplication of job ids within the
watermark (A11).  Sinks are checkpointed, so a restarted query resumes
after lost executors or a lost driver without duplicating output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.fact import archive_rows, json_postings
from ..sources.tables import PAGE_SCHEMA


def page_stream(spark: SparkSession, path: str, *, fmt: str = "json",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Raw pages landing as files (one JSON object per line by default)."""
    reader = spark.readStream.schema(PAGE_SCHEMA).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def fact_stream(pages: DataFrame) -> DataFrame:
    """Streaming JSON postings: the batch fact's JSON side, row for row."""
    return json_postings(archive_rows(pages))


def event_instant(ts: str) -> "F.Column":
    """A TIMESTAMP_NTZ wall clock as the instant with that wall clock in UTC,
    computed arithmetically, so the session time zone plays no part and
    one-day windows coincide with calendar days."""
    c = F.col(ts)
    seconds = (F.unix_date(F.to_date(c)).cast("bigint") * 86400
               + F.hour(c) * 3600 + F.minute(c) * 60)
    micros = seconds * 1000000 + (F.second(c).cast("bigint") * 1000000)
    return F.timestamp_micros(micros)


def utc_date(instant: "F.Column") -> "F.Column":
    """Calendar date (UTC) of an instant, independent of the session zone."""
    return F.date_from_unix_date(F.floor(F.unix_micros(instant) / 86400000000).cast("int"))


def daily_counts(postings: DataFrame, *, watermark: str = "1 day") -> DataFrame:
    """M14 on a stream: COUNT(job_id) per search day, final once the watermark passes."""
    return (postings.withColumn("_ts", event_instant("search_time"))
            .withWatermark("_ts", watermark)
            .groupBy(F.window("_ts", "1 day").alias("day"))
            .agg(F.count("job_id").alias("jobs_daily"))
            .select(utc_date(F.col("day.start")).alias("search_date"), "jobs_daily"))


def dedup_jobs(postings: DataFrame, *, watermark: str = "1 day") -> DataFrame:
    """A11 on a stream: keep the first posting of a job id seen within the watermark."""
    return (postings.where(F.col("job_id").isNotNull())
            .withColumn("_ts", event_instant("search_time"))
            .withWatermark("_ts", watermark)
            .dropDuplicatesWithinWatermark(["job_id"])
            .drop("_ts"))


def write_parquet(stream: DataFrame, path: str, checkpoint: str, *,
                  available_now: bool = True, mode: str = "append") -> StreamingQuery:
    """Checkpointed parquet sink; ``available_now`` processes what has landed and stops."""
    w = (stream.writeStream.format("parquet").outputMode(mode)
         .option("path", path).option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
