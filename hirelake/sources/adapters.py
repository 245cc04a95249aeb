"""Views of the driver tables in the shape of the job-posting tables.

The driver tables hold no job postings, so each view maps existing columns
the work grows with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table  # noqa: F401

AS_OF = "2001-08-01"          # last o_orderdate: the reporting date of the views
JSON_START = "1998-01-01"     # orders from this date are landed as JSON pages


def _nation(spark, sf_dir):
    # nation has 25 rows by the TPC-H definition: a fixed size bound.
    return F.broadcast(read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"]))


def order_brands(spark: SparkSession, sf_dir: str, key: "Column | None" = None,
                 name: str = "l_orderkey") -> DataFrame:
    """(key, keywords_all): distinct sorted part brands of an order.

    collect_set is combined map-side and bounded by the number of brands,
    so a hot order key cannot blow up one task.  ``key`` lets the caller
    aggregate on the join key it needs (e.g. the string job id), so the
    aggregate's partitioning is reused by the join."""
    lineitem = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey"])
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_brand"])
    key = F.col("l_orderkey") if key is None else key
    return (lineitem.join(part, lineitem.l_partkey == part.p_partkey)
            .groupBy(key.alias(name))
            .agg(F.array_sort(F.collect_set("p_brand")).alias("keywords_all")))


def postings_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scale view of the wide table: one posting per order."""
    orders = read_table(spark, sf_dir, "orders", heavy=True)
    customer = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey", "c_mktsegment"])
    title = F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED"))
    return (
        orders.join(customer, orders.o_custkey == customer.c_custkey, "left")
        .join(_nation(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(order_brands(spark, sf_dir), F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .select(
            F.col("o_orderkey").alias("job_id"),
            title.alias("job_title"),
            title.alias("job_title_clean"),
            F.coalesce(title, F.col("c_mktsegment")).alias("job_title_final"),
            F.col("c_mktsegment").alias("search_term"),
            F.col("n_name").alias("search_location"),
            F.when(F.col("n_regionkey") != 4, F.col("n_name")).alias("search_country"),
            F.col("o_orderdate").alias("search_time"),
            F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).alias("salary_year"),
            F.col("keywords_all"),
        )
    )


# DuckDB text of the same view, used by the oracle queries.
POSTINGS_WIDE_SQL = """
pw AS (
  SELECT o.o_orderkey AS job_id,
         nullif(o.o_orderpriority, '4-NOT SPECIFIED') AS job_title,
         nullif(o.o_orderpriority, '4-NOT SPECIFIED') AS job_title_clean,
         coalesce(nullif(o.o_orderpriority, '4-NOT SPECIFIED'), c.c_mktsegment) AS job_title_final,
         c.c_mktsegment AS search_term,
         n.n_name AS search_location,
         CASE WHEN n.n_regionkey <> 4 THEN n.n_name END AS search_country,
         o.o_orderdate AS search_time,
         CASE WHEN o.o_orderstatus = 'F' THEN o.o_totalprice END AS salary_year,
         b.keywords_all
  FROM orders o
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN (SELECT l.l_orderkey, list_sort(list_distinct(list(p.p_brand))) AS keywords_all
             FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
             GROUP BY l.l_orderkey) b ON b.l_orderkey = o.o_orderkey
)"""


# --------------------------------------------------------------------------
# Posting attributes of one order.  Shared by the typed landing view and by
# the JSON pages, so that both sources describe the same postings.
def _salary_text() -> "Column":
    p = F.col("o_totalprice")
    k = F.floor(p / 10000).cast("bigint")
    month = F.floor(p / 100).cast("bigint")
    return (
        F.when(F.col("o_orderpriority") == "1-URGENT",
               F.concat(k.cast("string"), F.lit("K–"), (k + 10).cast("string"), F.lit("K a year")))
        .when(F.col("o_orderpriority") == "2-HIGH",
              F.concat(k.cast("string"), F.lit("–"), (k + 5.5).cast("string"), F.lit(" an hour")))
        .when(F.col("o_orderpriority") == "3-MEDIUM",
              F.concat(F.floor(month / 1000).cast("string"), F.lit(","),
                       F.lpad((month % 1000).cast("string"), 3, "0"), F.lit(" a month")))
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED",
              F.concat(F.lit("$"), F.round(p / 10000, 1).cast("string"), F.lit("K a year")))
        .when(F.col("o_orderstatus") == "F", F.lit("Competitive"))
        .when(F.col("o_orderstatus") == "O",
              F.concat(k.cast("string"), F.lit("K-"), (k + 3).cast("string"), F.lit("K a year")))
    )


def posting_columns() -> dict[str, "Column"]:
    """Typed posting columns of an order joined with its customer and nation."""
    prio, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    ext = F.filter(F.array(prio,
                           F.when(status == "F", F.lit("No degree mentioned")),
                           F.when(F.col("o_totalprice") > 150000, F.lit("Health insurance"))),
                   lambda x: x.isNotNull())
    return {
        "title": prio,
        "company_name": F.col("c_name"),
        "location": F.col("n_name"),
        "via": F.concat(F.lit("via "), F.col("c_mktsegment")),
        "description": F.concat(F.lit("Order "), F.col("o_orderkey").cast("string"), F.lit(" for "),
                                F.col("c_name"), F.lit(" is "), status),
        "extensions": F.when(prio != "5-LOW", ext),
        "job_id": F.col("o_orderkey").cast("string"),
        "thumbnail": F.when(prio != "1-URGENT",
                            F.concat(F.lit("https://img.example/"), F.col("c_custkey").cast("string"))),
        "posted_at": F.date_format("o_orderdate", "yyyy-MM-dd"),
        "schedule_type": F.when(status == "F", F.lit("Full-time")).when(status == "O", F.lit("Contractor")),
        "work_from_home": F.when(prio.isin("1-URGENT", "2-HIGH"), F.lit(True)),
        "salary": _salary_text(),
        "search_term": F.col("c_mktsegment"),
        "date_time": F.col("o_orderdate"),
        "search_location": F.col("n_name"),
        "commute_time": F.lit(None).cast("string"),
    }


def _orders_customers(spark, sf_dir) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders", heavy=True)
    customer = read_table(spark, sf_dir, "customer")
    return (orders.join(customer, orders.o_custkey == customer.c_custkey, "left")
            .join(_nation(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"), "left"))


def typed_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 shape: the 16-column typed landing table, one row per order."""
    return _orders_customers(spark, sf_dir).select(
        *[e.alias(n) for n, e in posting_columns().items()])


_SALARY_TEXT_SQL = """CASE
    WHEN o.o_orderpriority = '1-URGENT' THEN CAST(floor(o.o_totalprice / 10000) AS BIGINT) || 'K–'
         || CAST(floor(o.o_totalprice / 10000) AS BIGINT) + 10 || 'K a year'
    WHEN o.o_orderpriority = '2-HIGH' THEN CAST(floor(o.o_totalprice / 10000) AS BIGINT) || '–'
         || CAST(CAST(floor(o.o_totalprice / 10000) AS BIGINT) + 5.5 AS VARCHAR) || ' an hour'
    WHEN o.o_orderpriority = '3-MEDIUM' THEN CAST(floor(CAST(floor(o.o_totalprice / 100) AS BIGINT) / 1000) AS BIGINT) || ','
         || lpad(CAST(CAST(floor(o.o_totalprice / 100) AS BIGINT) % 1000 AS VARCHAR), 3, '0') || ' a month'
    WHEN o.o_orderpriority = '4-NOT SPECIFIED' THEN '$' || CAST(round(o.o_totalprice / 10000, 1) AS VARCHAR) || 'K a year'
    WHEN o.o_orderstatus = 'F' THEN 'Competitive'
    WHEN o.o_orderstatus = 'O' THEN CAST(floor(o.o_totalprice / 10000) AS BIGINT) || 'K-'
         || CAST(floor(o.o_totalprice / 10000) AS BIGINT) + 3 || 'K a year'
  END"""

TYPED_POSTINGS_SQL = f"""
typed AS (
  SELECT o.o_orderpriority AS title, c.c_name AS company_name, n.n_name AS location,
         'via ' || c.c_mktsegment AS via,
         'Order ' || CAST(o.o_orderkey AS VARCHAR) || ' for ' || c.c_name || ' is ' || o.o_orderstatus AS description,
         CASE WHEN o.o_orderpriority <> '5-LOW' THEN list_filter(
              [o.o_orderpriority,
               CASE WHEN o.o_orderstatus = 'F' THEN 'No degree mentioned' END,
               CASE WHEN o.o_totalprice > 150000 THEN 'Health insurance' END], lambda x: x IS NOT NULL) END AS extensions,
         CAST(o.o_orderkey AS VARCHAR) AS job_id,
         CASE WHEN o.o_orderpriority <> '1-URGENT' THEN 'https://img.example/' || CAST(c.c_custkey AS VARCHAR) END AS thumbnail,
         strftime(o.o_orderdate, '%Y-%m-%d') AS posted_at,
         CASE o.o_orderstatus WHEN 'F' THEN 'Full-time' WHEN 'O' THEN 'Contractor' END AS schedule_type,
         CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN true END AS work_from_home,
         {_SALARY_TEXT_SQL} AS salary,
         c.c_mktsegment AS search_term,
         o.o_orderdate AS date_time,
         n.n_name AS search_location,
         CAST(NULL AS VARCHAR) AS commute_time,
         o.o_orderstatus, o.o_orderkey, c.c_custkey, c.c_acctbal, c.c_mktsegment, c.c_name, n.n_name, n.n_regionkey, o.o_orderdate
  FROM orders o
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""


# --------------------------------------------------------------------------
# Raw JSON pages.  Orders from JSON_START on are landed as search-result
# pages: one page per customer and block of ten order keys, so a page never
# holds more than ten postings whatever the skew of customers.  Pending
# orders ('P') are not posted; a page with none posted is empty (or has no
# jobs_results at all for AUTOMOBILE).  Pages of customers with a negative
# balance failed (error = true); HOUSEHOLD pages lack search_parameters, so
# their metadata is incomplete.
PAGE_SIZE = 10

# Pages of these segments hold an object or an array where a scalar is due:
# segment -> (field, its text, what the page holds instead).
NESTED_FIELDS = {"MACHINERY": ("via", "via MACHINERY", '{"site":"MACHINERY"}'),
                 "BUILDING": ("schedule_type", "Contractor", '["Contractor"]')}


def _highlights() -> "Column":
    prio = F.col("o_orderpriority")
    key = F.col("o_orderkey").cast("string")

    def block(title, *items):
        return F.struct(F.lit(title).alias("title"), F.array(*items).alias("items"))

    q = block("Qualifications", F.concat(F.lit("q"), key), F.col("o_orderstatus"))
    r = block("Responsibilities", F.concat(F.lit("r"), key))
    r2 = block("Responsibilities", F.lit("r2"))
    b = block("Benefits", F.concat(F.lit("b"), F.col("c_custkey").cast("string")))
    return (F.when(prio == "1-URGENT", F.array(q, r, b))
            .when(prio == "2-HIGH", F.array(b, q))
            .when(prio == "3-MEDIUM", F.array(r, r2, q, b))
            .when(prio == "4-NOT SPECIFIED", F.array_remove(F.array(q), q)))


def _links() -> "Column":
    prio = F.col("o_orderpriority")

    def link(url, text):
        return F.struct(url.alias("link"), text.alias("text"))

    g = link(F.concat(F.lit("https://www.google.com/search?q="), F.col("c_name")),
             F.concat(F.lit("See web results for "), F.col("c_name")))
    g2 = link(F.lit("https://www.google.com/maps"), F.lit("See web map"))
    w = link(F.concat(F.lit("https://co.example/"), F.col("c_custkey").cast("string")), F.lit("Website"))
    return (F.when(prio == "1-URGENT", F.array(g, w))
            .when(prio == "2-HIGH", F.array(w, g))
            .when(prio == "3-MEDIUM", F.array(g, g2))
            .when(prio == "5-LOW", F.array(w)))


def raw_pages(spark: SparkSession, sf_dir: str, since: str | None = JSON_START) -> DataFrame:
    """S1/S8 shape: (search_term, search_location, result_offset, error, results);
    pages of the orders from ``since`` on, or of all."""
    pc = posting_columns()
    job = F.struct(
        *[pc[n].alias(n) for n in ["job_id", "title", "company_name", "location", "via",
                                   "description", "thumbnail", "extensions"]],
        F.struct(*[pc[n].alias(n) for n in ["posted_at", "salary", "schedule_type",
                                            "work_from_home", "commute_time"]]).alias("detected_extensions"),
        _highlights().alias("job_highlights"),
        _links().alias("related_links"),
    )
    posted = F.col("o_orderstatus").isin("F", "O")
    src = _orders_customers(spark, sf_dir)
    if since is not None:
        src = src.where(F.col("o_orderdate") >= F.lit(since).cast("timestamp_ntz"))
    # postings are text before they are grouped: lists of text are far lighter to sort and merge than nested rows
    pages = (src.groupBy("c_custkey", F.floor(F.col("o_orderkey") / PAGE_SIZE).alias("_page"),
                         "c_mktsegment", "n_name", "c_acctbal")
             .agg(F.min("o_orderdate").alias("_time"),
                  F.count(F.lit(1)).alias("_n"),
                  F.collect_list(F.when(posted, F.to_json(job))).alias("_jobs")))
    seg = F.col("c_mktsegment")
    meta = F.struct(
        F.concat(F.lit("srch-"), F.col("c_custkey").cast("string"), F.lit("-"),
                 F.col("_page").cast("string")).alias("id"),
        F.concat(F.date_format("_time", "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC")).alias("created_at"),
        (F.col("_n") / 10).alias("total_time_taken"))
    params = F.when(seg != "HOUSEHOLD", F.struct(F.lit("en").alias("hl")))
    no_list = (F.size("_jobs") == 0) & (seg == "AUTOMOBILE")
    head = F.to_json(F.struct(meta.alias("search_metadata"), params.alias("search_parameters")))
    open_head = F.left("_head", F.length("_head") - 1)
    results = F.when(no_list, F.col("_head")).otherwise(
        F.concat(open_head, F.lit(',"jobs_results":['), F.array_join("_jobs", ","), F.lit("]}")))
    pages = pages.withColumn("_head", head).select("c_mktsegment", "n_name", "c_acctbal", results.alias("results"))
    # each change in a step of its own, which reads the text made before and doesn't make it again
    for segment, (field, text, nested) in NESTED_FIELDS.items():
        pages = pages.withColumn("results", F.when(seg == segment, F.replace("results", F.lit(f'"{field}":"{text}"'), F.lit(f'"{field}":{nested}'))
                                                   ).otherwise(F.col("results")))
    return pages.select(seg.alias("search_term"), F.col("n_name").alias("search_location"),
                        F.lit(0).cast("bigint").alias("result_offset"),
                        (F.col("c_acctbal") < 0).alias("error"), "results")


# DuckDB: the fact those pages and the typed rows should give, written
# relationally (no JSON).
def fact_sql(since: str | None = JSON_START) -> str:
    landed = "true" if since is None else f"date_time >= TIMESTAMP '{since}'"
    return "WITH " + TYPED_POSTINGS_SQL + f""",
src AS (SELECT * REPLACE (CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE via END AS via,
                          CASE WHEN c_mktsegment = 'BUILDING' AND schedule_type = 'Contractor' THEN NULL
                               ELSE schedule_type END AS schedule_type),
               o_orderkey // {PAGE_SIZE} AS page FROM typed WHERE {landed}),
pages AS (
  SELECT c_custkey, page, c_mktsegment, n_name, c_acctbal,
         min(date_time) AS ptime, count(*) AS n_all,
         count(*) FILTER (WHERE o_orderstatus IN ('F', 'O')) AS n_posted
  FROM src GROUP BY c_custkey, page, c_mktsegment, n_name, c_acctbal),
pmeta AS (
  SELECT *, c_acctbal < 0 AS error,
         CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN 'srch-' || CAST(c_custkey AS VARCHAR) || '-' || CAST(page AS VARCHAR) END AS search_id,
         CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN ptime END AS search_time,
         CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN n_all / 10 END AS search_time_taken,
         CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN 'en' END AS search_language
  FROM pages),
cutoff AS (SELECT min(search_time) AS t FROM pmeta),
fact AS (
  SELECT s.job_id, s.title AS job_title, s.company_name, s.location AS job_location, s.via AS job_via,
         s.description AS job_description,
         CASE WHEN s.title IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN 'q' || CAST(s.o_orderkey AS VARCHAR) || '|' || s.o_orderstatus END AS job_highlights_qualifications,
         CASE WHEN s.title IN ('1-URGENT', '3-MEDIUM') THEN 'r' || CAST(s.o_orderkey AS VARCHAR) END AS job_highlights_responsibilities,
         CASE WHEN s.title IN ('1-URGENT', '2-HIGH') THEN 'b' || CAST(s.c_custkey AS VARCHAR) END AS job_highlights_benefits,
         s.posted_at AS job_posted_at, s.salary AS job_salary, s.schedule_type AS job_schedule_type,
         s.work_from_home AS job_work_from_home, s.commute_time AS job_commute_time,
         s.extensions AS job_extensions,
         CASE WHEN s.title IN ('2-HIGH', '5-LOW') THEN 'https://co.example/' || CAST(s.c_custkey AS VARCHAR) END AS company_link,
         CASE WHEN s.title IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN 'https://www.google.com/search?q=' || s.c_name END AS company_link_google,
         s.thumbnail AS company_thumbnail, m.error, m.c_mktsegment AS search_term, m.n_name AS search_location,
         m.search_time, m.search_id
  FROM pmeta m JOIN src s ON s.c_custkey = m.c_custkey AND s.page = m.page
  WHERE NOT m.error AND s.o_orderstatus IN ('F', 'O')
  UNION ALL
  SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
         m.error, m.c_mktsegment, m.n_name, m.search_time, m.search_id
  FROM pmeta m WHERE NOT m.error AND m.n_posted = 0
  UNION ALL
  SELECT job_id, title, company_name, location, via, description, NULL, NULL, NULL, posted_at, salary,
         schedule_type, work_from_home, commute_time, extensions, NULL, NULL, thumbnail, NULL,
         search_term, search_location, date_time, NULL
  FROM typed WHERE date_time < (SELECT t FROM cutoff)),
factf AS (
  SELECT *, CASE WHEN list_contains(job_extensions, 'No degree mentioned') THEN true END AS job_no_degree_mention,
            CASE WHEN list_contains(job_extensions, 'Health insurance') THEN true END AS job_health_insurance
  FROM fact)"""


FACT_SQL = fact_sql()


# --------------------------------------------------------------------------
# Text postings: one posting per document, timed by the event with the same
# id, flagged by its labels.  Copies of a text in the same language share the
# de-duplication key of the public table.
def postings_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", heavy=True)
    events = read_table(spark, sf_dir, "events", ["event_id", "ts"])
    labels = read_table(spark, sf_dir, "labels")
    d = (docs.join(events, docs.doc_id == events.event_id, "left")
         .join(labels, "doc_id", "left"))
    return d.select(
        F.col("doc_id").cast("string").alias("job_id"),
        F.col("lang").alias("job_title"),
        F.upper("lang").alias("job_title_final"),
        F.concat(F.lit("company-"), F.col("lang")).alias("company_name"),
        F.col("lang").alias("job_location"),
        F.col("text").alias("job_description"),
        F.when(F.col("n_chars") > 5000, F.lit("Full-time")).alias("job_schedule_type"),
        F.concat(F.lit("via "), F.col("source")).alias("job_via"),
        F.col("ts").alias("search_time"),
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("search_id"),
        F.when(F.col("quality") == 1, F.lit(True)).alias("job_work_from_home"),
        F.when(F.col("toxic") == 1, F.lit(True)).alias("job_no_degree_mention"),
        F.lit(None).cast("boolean").alias("job_health_insurance"),
        F.array("lang", "source").alias("keywords_all"),
    )


POSTINGS_TEXT_SQL = """
pt AS (
  SELECT CAST(d.doc_id AS VARCHAR) AS job_id, d.lang AS job_title, upper(d.lang) AS job_title_final,
         'company-' || d.lang AS company_name, d.lang AS job_location, d.text AS job_description,
         CASE WHEN d.n_chars > 5000 THEN 'Full-time' END AS job_schedule_type,
         'via ' || d.source AS job_via, e.ts AS search_time, 'doc-' || CAST(d.doc_id AS VARCHAR) AS search_id,
         CASE WHEN l.quality = 1 THEN true END AS job_work_from_home,
         CASE WHEN l.toxic = 1 THEN true END AS job_no_degree_mention,
         CAST(NULL AS BOOLEAN) AS job_health_insurance,
         [d.lang, d.source] AS keywords_all
  FROM documents d LEFT JOIN events e ON d.doc_id = e.event_id LEFT JOIN labels l ON l.doc_id = d.doc_id
)"""


# Texts that hold keywords of a dictionary: ``documents`` with keywords chosen by
# doc_id before and after the text, next to punctuation.
KEYWORD_STEPS = (1, 7, 31, 5)


def keyword_documents(spark: SparkSession, sf_dir: str, keywords: list[str]) -> DataFrame:
    words = F.array(*[F.lit(k) for k in keywords])
    a, b, c, d = (F.element_at(words, (F.pmod(F.col("doc_id") * n + n, F.lit(len(keywords))) + 1).cast("int"))
                  for n in KEYWORD_STEPS)
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"], heavy=True)
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", F.concat(a, F.lit(", "), b, F.lit(". "), text, F.lit(" ("), c, F.lit(") "), d, F.lit("!"),
                                          ).alias("text"))


def keyword_documents_sql(keywords: list[str]) -> str:
    words = "[" + ", ".join(f"'{k}'" for k in keywords) + "]"
    a, b, c, d = (f"words[(doc_id * {n} + {n}) % {len(keywords)} + 1]" for n in KEYWORD_STEPS)
    return (f"(SELECT doc_id, {a} || ', ' || {b} || '. ' || coalesce(text, '') || ' (' || {c} || ') ' || {d} || '!' AS text "
            f"FROM documents, (SELECT {words} AS words)) AS src")


# Dimensions of the star join built from the driver tables.
def country_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """search_location -> search_country; region 4 has no entry (unmatched)."""
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    return (nation.join(region, nation.n_regionkey == region.r_regionkey)
            .where(F.col("n_regionkey") != 4)
            .select(F.col("n_name").alias("search_location"), F.col("r_name").alias("search_country")))


def title_dim_from(fact: DataFrame) -> DataFrame:
    """Labelled titles: '1-URGENT' -> 'urgent'; '4-NOT SPECIFIED' stays unlabelled."""
    return (fact.select("job_title").where(F.col("job_title").isNotNull()).distinct()
            .where(F.col("job_title") != "4-NOT SPECIFIED")
            .select("job_title", F.lower(F.regexp_extract("job_title", "-(.*)", 1)).alias("job_title_clean")))


def brand_skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Skill dimension keyed like the fact: (job_id, job_description, keywords_all)."""
    return order_brands(spark, sf_dir, F.col("l_orderkey").cast("string"), "job_id").select(
        "job_id", F.lit(None).cast("string").alias("job_description"), "keywords_all")
