"""The public, de-duplicated posting table.

One posting per (company_name, job_title, job_schedule_type, job_description,
job_location); NULLs in the key compare equal.  The reference keeps an
arbitrary row (ROW_NUMBER without ORDER BY); here the survivor is the
earliest search (search_time, search_id, job_id), chosen by a map-side
combinable ``min`` so that a key shared by a third of all rows (the NULL
postings of empty pages, say) is reduced before the shuffle.  The shuffle
is keyed by a digest of the five key columns, so the description text,
which the public table does not keep, never travels.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import null_to_false
from .dedup import dedup_by_key

DEDUP_KEYS = ["company_name", "job_title", "job_schedule_type", "job_description", "job_location"]
TIE_BREAK = ["search_time", "search_id", "job_id"]
#: The fact's columns that the public table is made of.
FACT_NEEDED = DEDUP_KEYS + TIE_BREAK + ["job_via", "job_work_from_home", "job_no_degree_mention", "job_health_insurance"]


def dedup_key(cols: list[str]) -> "Column":
    """SHA-256 of the key tuple, serialised unambiguously (``to_json`` keeps
    NULL apart from an empty string), so equal keys - NULLs included - get
    equal digests.  Grouping on the 32-byte digest keeps long texts such as
    the description out of the shuffle."""
    return F.unhex(F.sha2(F.to_json(F.struct(*[F.col(c) for c in cols])), 256))


#: Partition column of stored survivors: the first two hex digits of the key.
PREFIX = "key_prefix"


def survivors(wide: DataFrame, *, keywords: str = "keywords_all") -> DataFrame:
    """W1 + A13: the row kept for each key, with the key's digest and what
    decides between rows, so that survivors of several batches can be merged."""
    carried = [c for c in DEDUP_KEYS if c != "job_description"]
    needed = carried + TIE_BREAK + ["job_title_final", "job_via", "job_work_from_home",
                                    "job_no_degree_mention", "job_health_insurance"]
    # a known search time comes before an unknown one
    keyed = wide.select(dedup_key(DEDUP_KEYS).alias("_key"), F.col("search_time").isNull().alias("_unknown"), *needed,
                        F.col(keywords).alias("keywords"))
    return dedup_by_key(keyed, ["_key"], ["_unknown", *TIE_BREAK])


def stored_survivors(wide: DataFrame, **kw) -> DataFrame:
    """A batch's survivors as they are stored: partitioned by the key's prefix,
    so that a key's rows of all batches lie in one partition."""
    one = survivors(wide, **kw)
    return one.withColumn(PREFIX, F.lower(F.left(F.hex("_key"), F.lit(2))))


def merged_survivors(stored: DataFrame) -> DataFrame:
    """One row per key over all batches: the row that one pass over all postings keeps."""
    return dedup_by_key(stored.drop(PREFIX), ["_key"], ["_unknown", *TIE_BREAK])


def keys_of(stored: DataFrame, prefixes) -> DataFrame:
    """The stored survivors of some prefixes: other partitions are not read."""
    return stored.where(F.col(PREFIX).isin(*prefixes))


def finished(one: DataFrame) -> DataFrame:
    """The public columns of survivors."""
    return one.select(
        "job_title_final",
        F.col("job_title").alias("job_title_original"),
        "company_name",
        "job_location",
        F.col("search_time").alias("job_posted_at"),
        F.replace(F.col("job_via"), F.lit("via "), F.lit("")).alias("job_posting_site"),   # P15
        "job_schedule_type",
        null_to_false("job_work_from_home").alias("job_work_from_home"),                  # P16
        null_to_false("job_no_degree_mention").alias("job_no_degree_mention"),
        null_to_false("job_health_insurance").alias("job_health_insurance"),
        F.col("keywords").alias("job_keywords"),                                           # P17
    )


def public_table(wide: DataFrame, *, keywords: str = "keywords_all") -> DataFrame:
    return finished(survivors(wide, keywords=keywords))


def element_values(arr: str) -> Column:
    """array<struct<element>> (parquet list encoding) -> array of values."""
    return F.transform(F.col(arr), lambda x: x["element"])
