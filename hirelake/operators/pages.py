"""Landed pages as data: which fields they hold (S8/P18 from the data), rows
typed by that, and the chains of result pages that one search makes (S8).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import sinks
from .fact import TYPED_ALLOW_LIST, as_variant, scalar_text

FIELDS = "map<string,variant>"
NESTED = "detected_extensions"
#: Fields of a posting that other tables take and the landing table does not.
ELSEWHERE = ("job_highlights", "related_links")


# ------------------------------------------------------- fields of a posting
def posting_fields(archive: DataFrame, *, results: str = "results") -> DataFrame:
    """The search's columns and ``fields``: a posting's fields by name, those of
    ``detected_extensions`` lifted among them (a name that both have keeps the
    posting's own).  Failed searches and pages without postings give no row."""
    jobs = F.try_variant_get(as_variant(archive, results), "$.jobs_results", "array<variant>")
    rest = [c for c in archive.columns if c != results]
    rows = archive.where(~F.col("error")).select(*rest, F.explode(jobs).alias("_job"))
    own = rows.select(*rest, F.try_variant_get("_job", "$", FIELDS).alias("_own"))
    # the lifted fields in a step of their own: explode keeps the step from being worked out again for each use
    both = own.select(*rest, F.explode(F.array(F.struct("_own", F.try_variant_get(F.col("_own")[NESTED], "$", FIELDS).alias("_more")))).alias("_f"))
    top = F.map_filter(F.col("_f._own"), lambda k, _: k != NESTED)
    lifted = F.map_filter(F.coalesce(F.col("_f._more"), F.create_map().cast(FIELDS)), lambda k, _: ~F.map_contains_key(F.col("_f._own"), k))
    return both.select(*rest, F.map_concat(top, lifted).alias("fields"))


def field_profile(postings: DataFrame) -> DataFrame:
    """A row per field name: (field, n_postings, type), the type that all its
    values merge to (VARIANT where they differ beyond a common type)."""
    return (postings.select(F.explode("fields").alias("field", "value"))
            .groupBy("field").agg(F.count(F.lit(1)).alias("n_postings"), F.schema_of_variant_agg("value").alias("type")))


def _read_as(kind: str) -> str | None:
    """What a value of the inferred type is read as (None: text, where values are of several)."""
    if kind == "BOOLEAN" or kind.startswith(("BIGINT", "DOUBLE", "DECIMAL", "TIMESTAMP", "DATE", "ARRAY<STRING>")):
        return kind
    return "array<string>" if kind.startswith("ARRAY") else None


def landing_by_data(archive: DataFrame, *, allowed: Sequence[str] = TYPED_ALLOW_LIST, load_time: Column | None = None,
                    known: Iterable[str] = ELSEWHERE, profile: DataFrame | None = None, results: str = "results") -> DataFrame:
    """S8 / P18 with the schema that the pages have: the allowed fields that
    occur, each with the type its values have, plus ``rescued``: as JSON text
    all that would be lost otherwise - fields that nobody knows (neither allowed
    nor ``known``) and allowed ones whose value is not of the field's type.

    ``profile``: a stored field_profile; without one, one more pass over the
    pages infers it.  At most as many of its rows as fields are allowed come to
    the driver."""
    load_time = F.current_timestamp().cast("timestamp_ntz") if load_time is None else load_time
    postings = posting_fields(archive.withColumn("date_time", load_time), results=results)
    profile = field_profile(postings) if profile is None else profile
    search = ["date_time", "search_term", "search_location"]
    wanted = [c for c in allowed if c not in search]
    kinds = {r.field: r.type for r in profile.where(F.col("field").isin(wanted)).collect()}
    columns = {c: f"_c{i}" for i, c in enumerate(c for c in wanted if c in kinds and kinds[c] != "VOID")}
    read_as = {c: _read_as(kinds[c]) for c in columns}
    fields = F.col("fields")

    # Each value is read once, in a step of its own; which of them are lost is
    # known before the fields are gone through by name.
    read = postings.select(*search, "fields", *(F.try_variant_get(fields[c], "$", read_as[c] or "string").alias(n) for c, n in columns.items()))
    typed = read.select(*search, "fields", *((F.col(n) if read_as[c] else scalar_text(F.col(n), fields[c])).alias(n) for c, n in columns.items()))
    unread = [F.when(F.col(n).isNull() & F.map_contains_key(fields, c) & ~F.is_variant_null(fields[c]), F.lit(c)) for c, n in columns.items()]
    found = typed.withColumn("_unread", F.array_compact(F.array(F.lit(None).cast("string"), *unread)))

    def lost(name, _):
        strange = ~name.isin(*wanted, *known) if wanted else F.lit(True)
        return strange | F.array_contains("_unread", name)

    kept = found.withColumn("_rescued", F.map_filter("fields", lost))
    return kept.select(*(F.col(n).alias(c) for c, n in columns.items()), *(c for c in search if c in allowed),
                       F.when(F.size("_rescued") > 0, F.to_json("_rescued")).alias("rescued"))


# -------------------------------------------------------------- page chains
def page_chains(pages: DataFrame, *, search: str = "search", token: str = "token", following: str = "next_token",
                rounds: int = 48) -> DataFrame:
    """Order the result pages of each search by their tokens.

    A page was asked for with ``token`` (NULL for a search's first page) and
    names the next one in ``following`` (NULL for the last).  Gives the page's
    columns with

    * ``result_offset``: how many pages stand ahead of it in the search's chain
      (NULL unless that chain starts at the first page),
    * ``chain_start``: the token of the page that its chain starts with,
    * ``place``: its place in that chain, from 0,
    * ``state``: ``whole``; ``broken`` (the page ahead is missing, for it or a
      page ahead of it); ``cycle`` (it stands in, or behind, a ring),
    * ``next_is``: ``none`` (it names no page), ``follows`` (the page it names
      comes next), ``missing`` (that page is not there) or ``elsewhere`` (another
      page stands ahead of that one, as where a chain runs back into itself).

    Chains are followed by doubling: in each round a page looks up its ancestor's
    ancestor, so a chain of n pages takes log2(n) joins, each on (search, token)
    and written, never one join a page.  Pages that no round settles any more
    are the rings.  If several pages name a page, the least token counts as the
    one ahead; of rows that repeat (search, token), all get the same place."""
    spark = pages.sparkSession
    root = sinks.scratch_path(spark, "page-chains")
    # a search or token that is NULL needs a key that joins: text apart from all others
    key = F.to_json(F.struct(F.col(search).alias("s"), F.col(token).alias("t")))
    after = F.when(F.col(following).isNotNull(), F.to_json(F.struct(F.col(search).alias("s"), F.col(following).alias("t"))))
    nodes = pages.select(key.alias("node"), F.col(token).alias("token"), after.alias("after"))
    distinct = nodes.groupBy("node").agg(F.min("token").alias("token"))
    ahead = (nodes.where(F.col("after").isNotNull() & (F.col("after") != F.col("node")))
             .groupBy(F.col("after").alias("node")).agg(F.min(F.struct("token", "node")).alias("of")))
    rings = nodes.where(F.col("after") == F.col("node")).select("node").distinct().withColumn("own_ring", F.lit(True))
    first = F.col("token").isNull()
    start = (distinct.join(ahead, "node", "left").join(rings, "node", "left")
             .select("node", "token", F.when(first | F.col("of").isNull(), F.col("node")).otherwise(F.col("of.node")).alias("up"),
                     F.when(first | F.col("of").isNull(), 0).otherwise(1).cast("long").alias("place"),
                     ((first | F.col("of").isNull()) & (first | F.col("own_ring").isNull())).alias("done")))

    def store(df, name):
        sinks.write_table(df, f"{root}/{name}")
        return spark.read.parquet(f"{root}/{name}")

    state = store(start, "0")
    open_ = state.where(~F.col("done")).count()
    for i in range(1, rounds + 1):
        if not open_:
            break
        up = state.select(F.col("node").alias("u_node"), F.col("up").alias("u_up"), F.col("place").alias("u_place"), F.col("done").alias("u_done"))
        state = store(state.join(up, (F.col("up") == F.col("u_node")) & ~F.col("done"), "left").select(
            "node", "token", F.coalesce("u_up", "up").alias("up"), (F.col("place") + F.coalesce("u_place", F.lit(0))).alias("place"),
            (F.col("done") | F.coalesce("u_done", F.lit(False))).alias("done")), str(i))
        before, open_ = open_, state.where(~F.col("done")).count()
        if open_ == before:
            break
    starts = state.select(F.col("node").alias("s_node"), F.col("token").alias("chain_start"), F.col("token").isNull().alias("s_first"))
    found = (state.join(starts, F.col("up") == F.col("s_node"), "left")
             .select("node", F.when(F.col("done"), F.col("chain_start")).alias("chain_start"), F.when(F.col("done"), F.col("place")).alias("place"),
                     F.when(~F.col("done"), "cycle").when(F.col("s_first"), "whole").otherwise("broken").alias("state")))
    next_is = (F.when(F.col("_after").isNull(), "none").when(F.col("a_node").isNull(), "missing")
               .when((F.col("h_of") == F.col("_node")) & F.col("a_token").isNotNull(), "follows").otherwise("elsewhere"))
    heir = ahead.select(F.col("node").alias("h_node"), F.col("of.node").alias("h_of"))
    named = (distinct.select(F.col("node").alias("a_node"), F.col("token").alias("a_token"))
             .join(heir, F.col("a_node") == F.col("h_node"), "left").drop("h_node"))
    return (pages.withColumn("_node", key).withColumn("_after", after)
            .join(found, F.col("_node") == F.col("node")).join(named, F.col("_after") == F.col("a_node"), "left")
            .select(*pages.columns, F.when(F.col("state") == "whole", F.col("place")).alias("result_offset"), "chain_start", "place", "state",
                    next_is.alias("next_is")))
