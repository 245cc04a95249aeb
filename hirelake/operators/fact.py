"""Fact build (M19/M20): raw JSON pages + typed landing rows -> fact table.

Pages are parsed once into VARIANT when archived (``try_parse_json``:
malformed -> NULL) and kept as VARIANT;
``jobs_results`` is unnested with ``explode_outer`` (an empty or missing array
keeps one NULL posting, as LEFT JOIN UNNEST does).  Everything is a
projection over the scan: no shuffle until the union is written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import true_or_null

# FIXED VALUES (down to TYPED_RENAMES, and TYPED_ALLOW_LIST): page fields,
# block titles, prefixes and column names of the posting schema.
HIGHLIGHT_TITLES = {
    "job_highlights_qualifications": "Qualifications",
    "job_highlights_responsibilities": "Responsibilities",
    "job_highlights_benefits": "Benefits",
}
HIGHLIGHT_POSITIONS = 3          # only the first three blocks are looked at
GOOGLE_PREFIX = "https://www.google.com"
SEE_WEB = "See web"

FACT_COLUMNS = [
    "job_id", "job_title", "company_name", "job_location", "job_via", "job_description",
    "job_highlights_qualifications", "job_highlights_responsibilities", "job_highlights_benefits",
    "job_posted_at", "job_salary", "job_schedule_type", "job_work_from_home", "job_commute_time",
    "job_extensions", "company_link", "company_link_google", "company_thumbnail", "error",
    "search_term", "search_location", "search_time", "search_id",
]

#: Types of the fact's columns that are not text.
FACT_TYPES = {"job_highlights_qualifications": "array<string>", "job_highlights_responsibilities": "array<string>",
              "job_highlights_benefits": "array<string>", "job_extensions": "array<string>", "job_work_from_home": "boolean",
              "error": "boolean", "search_time": "timestamp_ntz"}

# One posting of jobs_results, as read from the page in one cast (unknown keys
# ignored; a field whose value does not cast becomes NULL on its own).  Scalars
# come as text; ``scalar_text`` drops what is the text of an object or array.
JOB_FIELDS = {
    "job_id": "string", "title": "string", "company_name": "string", "location": "string", "via": "string",
    "description": "string", "thumbnail": "string", "extensions": "array<string>",
    "detected_extensions": "struct<posted_at string, salary string, schedule_type string, work_from_home boolean, commute_time string>",
    "job_highlights": "array<struct<title string, items array<string>>>",
    "related_links": "array<struct<link string, text string>>",
}

# Typed landing column -> fact column.
TYPED_RENAMES = {
    "title": "job_title", "company_name": "company_name", "location": "job_location",
    "via": "job_via", "description": "job_description", "extensions": "job_extensions",
    "job_id": "job_id", "thumbnail": "company_thumbnail", "posted_at": "job_posted_at",
    "schedule_type": "job_schedule_type", "work_from_home": "job_work_from_home",
    "salary": "job_salary", "search_term": "search_term", "search_location": "search_location",
    "date_time": "search_time", "commute_time": "job_commute_time",
}


def _get(v: Column, path: str, typ: str = "string") -> Column:
    return F.try_variant_get(v, path, typ)


def job_schema(fields=tuple(JOB_FIELDS)) -> str:
    return "struct<" + ", ".join(f"{f} {JOB_FIELDS[f]}" for f in fields) + ">"


def scalar_text(text: Column, value: Column) -> Column:
    """The text of a scalar, NULL for an object or array.  Only where the
    text could be one by its first character is ``value`` (VARIANT) looked at."""
    return (F.when(~text.startswith("{") & ~text.startswith("["), text)
            .when(F.schema_of_variant(value) == "STRING", text))


def variant_text(value: Column) -> Column:
    """The same of a VARIANT alone."""
    return scalar_text(_get(value, "$"), value)


def serialise(*cols: str | Column) -> Column:
    """A record as JSON text."""
    return F.to_json(F.struct(*cols))


def append_pages(first: DataFrame, *pages: DataFrame) -> DataFrame:
    """U4: rows of pages whose columns differ; a column a page lacks is NULL."""
    for page in pages:
        first = first.unionByName(page, allowMissingColumns=True)
    return first


# ------------------------------------------------------------ P21 / P22
def parse_zoned_time(s: str | Column) -> Column:
    """``2023-01-05 10:00:00 UTC`` -> TIMESTAMP_NTZ wall clock (zone label not
    applied, as a naive strptime does).  Built from the parts, so the
    session time zone plays no role; bad text or dates -> NULL."""
    s = F.col(s) if isinstance(s, str) else s
    # every part stands at a fixed place, so one match serves all of them
    part = [F.substring(s, at, n) for at, n in ((1, 4), (6, 2), (9, 2), (12, 2), (15, 2), (18, 2))]
    time = F.try_make_timestamp_ntz(*[p.try_cast("int") for p in part[:5]],
                                    part[5].try_cast("decimal(16,6)"))
    return F.when(s.rlike(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2} \S+$"), time)


def as_variant(df: DataFrame, results: str = "results") -> Column:
    """The page as VARIANT: parsed once (malformed -> NULL), or as stored."""
    if dict(df.dtypes)[results] == "variant":
        return F.col(results)
    return F.try_parse_json(F.col(results))


META_FIELDS = {"search_id": "search_metadata.id", "search_time": "search_metadata.created_at",
               "search_time_taken": "search_metadata.total_time_taken", "search_language": "search_parameters.hl"}
PAGE_META = ("struct<search_metadata struct<id string, created_at string, total_time_taken double>, "
             "search_parameters struct<hl string>>")


def with_metadata(df: DataFrame, *, results: str = "results") -> DataFrame:
    """Search id / time / time taken / language from a parsed page; if any
    of the four is missing or unparsable, all four are NULL.

    The page is cast once, and each step's columns are those that the next one
    reads several times, so none is worked out again for each use."""
    read = df.select("*", _get(F.col(results), "$", PAGE_META).alias("_meta"))
    found = read.select(*df.columns, *[(parse_zoned_time(F.col(f"_meta.{f}")) if n == "search_time" else F.col(f"_meta.{f}")).alias(n)
                                       for n, f in META_FIELDS.items()])
    complete = None
    for n in META_FIELDS:
        complete = F.col(n).isNotNull() if complete is None else complete & F.col(n).isNotNull()
    return found.select(*df.columns, *[F.when(complete, F.col(n)).alias(n) for n in META_FIELDS])


def archive_rows(pages: DataFrame, *, results: str = "results") -> DataFrame:
    """Raw archive rows: the landing columns, page metadata (P21/P22) and the
    page itself as VARIANT, parsed here once; stored that way, later reads
    never parse the JSON text again.

    Input columns: search_term, search_location, result_offset, error,
    results (JSON text or VARIANT)."""
    parsed = pages.select("search_term", "search_location", "result_offset", "error",
                          as_variant(pages, results).alias(results))
    return with_metadata(parsed, results=results).select("search_term", "search_location", "result_offset", "error",
                                                         *META_FIELDS, results)


def page_key(archive: DataFrame, *, results: str = "results") -> Column:
    """What makes an archived page the same page when it is landed again: its
    search and offset, or, where the page tells no search, all that it holds."""
    held = F.sha2(F.to_json(F.struct("search_term", "search_location", "result_offset", "error",
                                     F.to_json(F.col(results)).alias("page"))), 256)
    known = F.concat(F.lit("search:"), F.to_json(F.struct("search_id", "result_offset")))
    return F.when(F.col("search_id").isNotNull(), known).otherwise(F.concat(F.lit("page:"), held))


# -------------------------------------------------------- P3 - P9, J2
def _highlight(highlights: Column, title: str) -> Column:
    """P5: items of the first of blocks 0..2 whose title matches, else NULL."""
    out = None
    for i in range(HIGHLIGHT_POSITIONS):
        block = F.get(highlights, i)
        hit = block["title"] == F.lit(title)
        out = F.when(hit, block["items"]) if out is None else out.when(hit, block["items"])
    return out


#: Fact column -> the posting's field that it comes from.
FROM_FIELD = {
    "job_id": "job_id", "job_title": "title", "company_name": "company_name", "job_location": "location", "job_via": "via",
    "job_description": "description", "company_thumbnail": "thumbnail", "job_extensions": "extensions",
    **dict.fromkeys(["job_posted_at", "job_salary", "job_schedule_type", "job_work_from_home", "job_commute_time"], "detected_extensions"),
    **dict.fromkeys(HIGHLIGHT_TITLES, "job_highlights"),
    **dict.fromkeys(["company_link", "company_link_google"], "related_links"),
}


def json_postings(archive: DataFrame, *, columns: list[str] | None = None, failed: bool = False,
                  results: str = "results") -> DataFrame:
    """S1 + P3 + J2 + P4-P9: one row per posting of every successful page.

    Each posting is cast once from VARIANT to a fixed struct; every field
    below is then a plain struct access (no repeated path navigation).
    ``columns``: fact columns wanted, the cast takes only their fields.
    ``failed``: with a row (its ``error`` not false) for each other page too, so
    that the cut-off can be taken from the same rows."""
    jobs = _get(as_variant(archive, results), "$.jobs_results", "array<variant>")
    if failed:
        exploded = archive.select("*", F.explode_outer(F.when(~F.col("error"), jobs)).alias("_job"))
    else:
        exploded = archive.where(~F.col("error")).select("*", F.explode_outer(jobs).alias("_job"))     # P3 (NULL drops too), J2
    wanted = FACT_COLUMNS if columns is None else [c for c in FACT_COLUMNS if c in columns]
    fields = [f for f in JOB_FIELDS if f in {FROM_FIELD.get(c) for c in wanted}] or ["job_id"]
    typed = exploded.withColumn("_j", F.try_variant_get("_job", "$", job_schema(fields)))

    def text(*path) -> Column:
        value, at = F.col("_j"), "$"
        for step in path:
            value = F.get(value, step) if isinstance(step, int) else value[step]
            at += f"[{step}]" if isinstance(step, int) else f".{step}"
        return scalar_text(value, _get(F.col("_job"), at, "variant"))

    def link(i):
        return text("related_links", i, "link")

    def says_web(i):
        return F.left(text("related_links", i, "text"), F.lit(7)) == F.lit(SEE_WEB)

    cols = {
        "job_id": lambda: text("job_id"),
        "job_title": lambda: text("title"),
        "company_name": lambda: text("company_name"),
        "job_location": lambda: text("location"),
        "job_via": lambda: text("via"),
        "job_description": lambda: text("description"),
        **{name: (lambda title=title: _highlight(F.col("_j.job_highlights"), title)) for name, title in HIGHLIGHT_TITLES.items()},
        "job_posted_at": lambda: text("detected_extensions", "posted_at"),
        "job_salary": lambda: text("detected_extensions", "salary"),
        "job_schedule_type": lambda: text("detected_extensions", "schedule_type"),
        "job_work_from_home": lambda: F.col("_j.detected_extensions.work_from_home"),                  # P7
        "job_commute_time": lambda: text("detected_extensions", "commute_time"),
        "job_extensions": lambda: F.col("_j.extensions"),                                              # P6
        "company_link": lambda: F.when(F.left(link(0), F.lit(22)) != F.lit(GOOGLE_PREFIX), link(0)),   # P8
        "company_link_google": lambda: F.when(says_web(0), link(0)).when(says_web(1), link(1)),        # P9
        "company_thumbnail": lambda: text("thumbnail"),
    }
    return typed.select(*[cols[c]().alias(c) if c in cols else c for c in wanted])


# ------------------------------------------------------------- P1 / P2
def pre_cutoff(typed: DataFrame, archive: DataFrame, *, ts: str = "date_time") -> DataFrame:
    """Typed rows older than the first archived page, renamed.

    The cut-off is an uncorrelated scalar subquery: one partial aggregate over
    the archive's time column."""
    return typed_rows(typed, archive.agg(F.min("search_time")).scalar(), ts=ts)


def typed_rows(typed: DataFrame, cutoff: Column, *, ts: str = "date_time") -> DataFrame:
    """Typed rows older than ``cutoff``, renamed."""
    return (typed.where(F.col(ts) < cutoff)
            .select(*[F.col(src).alias(dst) for src, dst in TYPED_RENAMES.items()]))


# ----------------------------------------------------- U1 / P10 / P11
def build_fact(archive: DataFrame, typed: DataFrame) -> DataFrame:
    """JSON postings UNION ALL older typed rows, plus the two TRUE/NULL flags."""
    older = pre_cutoff(typed, archive)
    return with_flags(json_postings(archive).unionByName(older, allowMissingColumns=True))   # U1 + P11


def fact_of(postings: DataFrame, typed: DataFrame, *, columns: list[str] | None = None) -> DataFrame:
    """M19 from stored ``json_postings(..., failed=True)``: the cut-off and the
    postings are read from one narrow table, and no page is kept whole."""
    older = typed_rows(typed, postings.agg(F.min("search_time")).scalar())
    fact = with_flags(postings.where(~F.col("error")).unionByName(older, allowMissingColumns=True))
    return fact if columns is None else fact.select(*columns)


def with_flags(rows: DataFrame) -> DataFrame:
    """P10: the fact's columns (those that ``rows`` lacks are NULL) and the two
    TRUE/NULL flags."""
    ext = F.col("job_extensions")
    filled = rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast(FACT_TYPES.get(c, "string")).alias(c) for c in FACT_COLUMNS])
    return filled.select(
        *FACT_COLUMNS,
        true_or_null(F.array_contains(ext, F.lit("No degree mentioned"))).alias("job_no_degree_mention"),
        true_or_null(F.array_contains(ext, F.lit("Health insurance"))).alias("job_health_insurance"),
    )


# ------------------------------------------------------ S8 / P18 - P20
TYPED_ALLOW_LIST = ["title", "company_name", "location", "via", "description", "extensions",
                    "job_id", "thumbnail", "posted_at", "schedule_type", "salary",
                    "work_from_home", "date_time", "search_term", "search_location", "commute_time"]



def flatten_struct(df: DataFrame, struct_col: str) -> DataFrame:
    """Lift a struct's fields into the row and drop the struct."""
    return df.select("*", f"{struct_col}.*").drop(struct_col)


def allow_list(df: DataFrame, allowed: list[str]) -> DataFrame:
    """Keep the allowed columns that exist, in the frame's order."""
    return df.select(*[c for c in df.columns if c in set(allowed)])


def landing_rows(archive: DataFrame, *, load_time: Column | None = None,
                 results: str = "results") -> DataFrame:
    """Typed landing rows from pages (one row per posting).

    A failed search lands nothing; pages without postings add no row (inner
    explode).  Each posting is cast to a fixed struct, its
    detected_extensions flattened, the search tags and the load time added,
    and the columns restricted to the typed table's allow-list."""
    load_time = F.current_timestamp().cast("timestamp_ntz") if load_time is None else load_time
    ok = archive.where(~F.col("error"))
    jobs = _get(as_variant(archive, results), "$.jobs_results", "array<variant>")
    rows = ok.select("search_term", "search_location", load_time.alias("date_time"),
                     F.explode(jobs).alias("_job"))
    # both: the cast posting, and the fields as they stand for those that may not be scalars
    typed = rows.select("search_term", "search_location", "date_time", "_job",
                        F.try_variant_get("_job", "$", job_schema([f for f in JOB_FIELDS if f not in ("job_highlights", "related_links")])).alias("_j"))
    flat = flatten_struct(flatten_struct(typed, "_j"), "detected_extensions")
    inside = {f: f"$.{f}" for f in JOB_FIELDS}
    nested = {f: f"$.detected_extensions.{f}" for f in ("posted_at", "salary", "schedule_type", "commute_time")}
    text = {**{f: p for f, p in inside.items() if JOB_FIELDS[f] == "string"}, **nested}
    kept = allow_list(flat, TYPED_ALLOW_LIST)
    return flat.select(*[scalar_text(F.col(c), _get(F.col("_job"), text[c], "variant")).alias(c) if c in text else c for c in kept.columns])
