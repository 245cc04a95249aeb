"""Registered queries of the repeatable loads, the increments, the pages' own
schema and chains, and the title model; in the registers of ``catalog``.

Every query runs over whole driver tables.  Loads are done twice and in
overlapping batches on purpose: their oracles are the plain tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import MONTH_COL, month_of
from ..operators import fact as fact_ops
from ..operators import pages as page_ops
from ..operators import partials, title_model
from ..operators import public as public_ops
from ..operators import skills as skill_ops
from ..operators.titles import ABBREVIATIONS
from ..sources import adapters as ad
from ..sources import sinks, tables
from ..sources.batches import BatchTable
from .catalog import (_ALL_GRAINS_SQL, _M1_SQL, _SLICER_SQL, _TREND_SQL, D7, D30, DYTD, PW, ALL_TIME, LAST_7, LAST_30, YTD,
                      _public_sql, archive, register, staged)

#: Where the first batch of a load ends.
SPLIT = "2000-01-01"


# ------------------------------------------------- K2 / K3 repeatable loads
@register("append_idempotent", ad.fact_sql(None) + """
SELECT c_mktsegment AS search_term, n_name AS search_location, error, search_id, search_time,
       count(*) AS pages FROM pmeta GROUP BY ALL""")
def q_append_idempotent(spark, sf_dir):
    """Pages in two batches that overlap by a year, each loaded twice, and all
    of them once more under another name: every page is there once."""
    rows = archive(spark, sf_dir, None)
    rows = staged(rows.withColumns({"page_key": fact_ops.page_key(rows), MONTH_COL: month_of("search_time")}), "pages")
    table = BatchTable(spark, sinks.scratch_path(spark, "archive"), [MONTH_COL])
    early = F.coalesce(F.col("search_time") < SPLIT, F.lit(True))
    late = F.coalesce(F.col("search_time") >= F.lit(SPLIT).cast("timestamp_ntz") - F.expr("INTERVAL 1 YEAR"), F.lit(True))
    order = F.sha2(F.to_json(F.col("results")), 256)
    for batch, part in (("early", rows.where(early)), ("late", rows.where(late)), ("early", rows.where(early)), ("again", rows)):
        table.append(batch, part, key="page_key", order=order)
    return (table.read().groupBy("search_term", "search_location", "error", "search_id", "search_time")
            .agg(F.count(F.lit(1)).alias("pages")))


# ------------------------------------------------------- K9 quarantine
def _bad_pages():
    return {"corrupt line": F.col(tables.CORRUPT).isNotNull(), "no page": F.col("results").isNull(),
            "unreadable page": F.try_parse_json("results").isNull()}


def _landed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed pages as JSON lines, as a broken transfer leaves them: of failed
    searches, furniture lines and automobile pages are cut off at the end and
    household pages are missing."""
    pages = ad.raw_pages(spark, sf_dir, None)
    cut = F.substring("results", 1, F.length("results") - 1)
    term = F.col("search_term")
    results = (F.when(F.col("error") & (term == "AUTOMOBILE"), cut)
               .when(~F.col("error") | (term != "HOUSEHOLD"), F.col("results")))
    line = F.to_json(F.struct("search_term", "search_location", "result_offset", "error", results.alias("results")))
    return pages.select(F.when(F.col("error") & (term == "FURNITURE"), F.left(line, F.length(line) - 1)).otherwise(line).alias("value"))


@register("load_quarantine", ad.fact_sql(None) + """,
parted AS (
  SELECT *, CASE WHEN error AND c_mktsegment = 'FURNITURE' THEN 'corrupt line' WHEN error AND c_mktsegment = 'HOUSEHOLD' THEN 'no page'
                 WHEN error AND c_mktsegment = 'AUTOMOBILE' THEN 'unreadable page' END AS reason FROM pmeta)
SELECT CASE WHEN reason IS NULL THEN 'accepted' ELSE 'rejected' END AS outcome, reason,
       CASE WHEN reason IS DISTINCT FROM 'corrupt line' THEN c_mktsegment END AS search_term, count(*) AS pages,
       coalesce(reason = 'corrupt line', false) AS kept_as_text, (SELECT count(*) FROM pmeta) AS loaded,
       (SELECT count(*) FROM parted WHERE reason IS NOT NULL) AS rejected
FROM parted GROUP BY ALL""")
def q_load_quarantine(spark, sf_dir):
    path, parted = (sinks.scratch_path(spark, n) for n in ("lines", "parted"))
    _landed_lines(spark, sf_dir).write.text(path)
    landed = tables.read_pages(spark, path, corrupt=True)
    seen = sinks.routed(landed, parted, _bad_pages())
    sides = [sinks.read_routed(spark, parted, side, landed.schema).withColumn("outcome", F.lit(side))
             for side in (sinks.ACCEPTED, sinks.REJECTED)]
    return (sides[0].unionByName(sides[1]).groupBy("outcome", "reason", "search_term", F.col(tables.CORRUPT).isNotNull().alias("kept_as_text"))
            .agg(F.count(F.lit(1)).alias("pages"))
            .withColumns({"loaded": F.lit(seen["rows"]).cast("bigint"), "rejected": F.lit(seen[sinks.REJECTED]).cast("bigint")}))


# --------------------------------------------- A2 - A5 from partials
_COUNTED = {"skills": partials.skill_partials, "sizes": partials.size_partials, "pay": partials.pay_partials}


def _partial_tables(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    """The partials of all postings, loaded in two batches, the second twice."""
    wide = staged(ad.postings_wide(spark, sf_dir), "wide")
    early = F.coalesce(F.col("search_time") < SPLIT, F.lit(True))
    out = []
    for name in names:
        counted = _COUNTED[name]
        table = BatchTable(spark, sinks.scratch_path(spark, name), [MONTH_COL])
        for batch, part in (("early", wide.where(early)), ("late", wide.where(~early)), ("late", wide.where(~early))):
            table.append(batch, counted(part))
        out.append(table.read())
    return out


@register("increment_skills", _M1_SQL)
def q_increment_skills(spark, sf_dir):
    return partials.skills_by_timeframe(*_partial_tables(spark, sf_dir, "skills", "sizes"), ad.AS_OF)


@register("increment_grains", _ALL_GRAINS_SQL)
def q_increment_grains(spark, sf_dir):
    return partials.skill_grains(*_partial_tables(spark, sf_dir, "skills", "sizes"), ad.AS_OF)


@register("increment_slicer", _SLICER_SQL.format(extra=""))
def q_increment_slicer(spark, sf_dir):
    return partials.title_country_counts(*_partial_tables(spark, sf_dir, "sizes"))


@register("increment_trend", _TREND_SQL)
def q_increment_trend(spark, sf_dir):
    return partials.skill_trend(*_partial_tables(spark, sf_dir, "skills", "sizes"))


# ------------------------------------------- M16 over batches
@register("increment_public", "WITH " + ad.POSTINGS_TEXT_SQL + "," + _public_sql("pt"))
def q_increment_public(spark, sf_dir):
    """The public table from the survivors of two batches, the later one first."""
    wide = staged(ad.postings_text(spark, sf_dir), "wide")
    late = F.coalesce(F.col("search_time") >= "2024-01-02", F.lit(False))
    table = BatchTable(spark, sinks.scratch_path(spark, "public"), [public_ops.PREFIX])
    for batch, part in (("late", wide.where(late)), ("early", wide.where(~late)), ("late", wide.where(late))):
        table.append(batch, public_ops.stored_survivors(part))
    out = public_ops.finished(public_ops.merged_survivors(table.read()))
    return out.withColumn("job_keywords", F.array_join("job_keywords", "|"))


# ------------------------------------------- A8 mergeable median
@register("skill_pay_sketch", PW + f""",
frames AS (
  SELECT '{ALL_TIME}' AS timeframe, CAST(NULL AS TIMESTAMP) AS since
  UNION ALL SELECT '{LAST_7}', {D7}
  UNION ALL SELECT '{LAST_30}', {D30}
  UNION ALL SELECT '{YTD}', {DYTD})
SELECT skill, timeframe, count(job_id) AS count, round(avg(salary_year), 4) AS avg, min(salary_year) AS min,
       max(salary_year) AS max, true AS median_in_bounds
FROM (SELECT job_id, search_time, salary_year, unnest(keywords_all) AS skill FROM pw WHERE salary_year IS NOT NULL)
JOIN frames ON since IS NULL OR search_time >= since GROUP BY skill, timeframe""")
def q_skill_pay_sketch(spark, sf_dir):
    """Pay per skill and timeframe from merged day sketches; the median's rank
    is looked up among the postings themselves.  A share of postings can't be
    closer to a half than one posting allows."""
    wide = ad.postings_wide(spark, sf_dir)
    found = partials.skill_pay(*_partial_tables(spark, sf_dir, "pay"), ad.AS_OF)
    ranked = partials.rank_of(wide, found, ad.AS_OF)
    slack = F.lit(2 * partials.RANK_ERROR) + 1 / F.col("count")
    return ranked.select("skill", "timeframe", "count", F.round("avg", 4).alias("avg"), "min", "max",
                         ((F.col("below") <= 0.5 + slack) & (F.col("upto") >= 0.5 - slack)).alias("median_in_bounds"))


# ------------------------------------- S8 / P18 schema from the data
def changed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages whose fields have changed: household postings have a badge (text)
    and a rating (an object) that nobody knows, furniture ones a badge that is a number."""
    pages = archive(spark, sf_dir, None)
    raw = ad.raw_pages(spark, sf_dir, None)
    term = F.col("search_term")
    after = F.lit('"company_name":')
    more = (F.when(term == "HOUSEHOLD", F.replace("results", after, F.concat(F.lit('"badge":"new","rating":{"stars":4.5,"by":["a","b"]},'), after)))
            .when(term == "FURNITURE", F.replace("results", after, F.concat(F.lit('"badge":7,'), after))).otherwise(F.col("results")))
    return fact_ops.archive_rows(raw.withColumn("results", more)).select(*pages.columns)


_LANDED_SQL = ad.fact_sql(None) + """,
landed AS (
  SELECT s.*, m.search_time FROM pmeta m JOIN src s ON s.c_custkey = m.c_custkey AND s.page = m.page
  WHERE NOT m.error AND s.o_orderstatus IN ('F', 'O'))"""


@register("page_fields", _LANDED_SQL + """,
named AS (
  SELECT unnest(['job_id', 'title', 'company_name', 'location', 'description', 'posted_at', 'related_links']) AS field,
         unnest([count(job_id), count(title), count(company_name), count(location), count(description), count(posted_at),
                 count(*) FILTER (title IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW'))]) AS n_postings,
         'plain' AS kind FROM landed
  UNION ALL SELECT 'via', count(*), 'mixed' FROM landed
  UNION ALL SELECT 'schedule_type', count(*), 'mixed' FROM landed WHERE o_orderstatus IN ('F', 'O')
  UNION ALL SELECT 'salary', count(salary), 'plain' FROM landed
  UNION ALL SELECT 'thumbnail', count(thumbnail), 'plain' FROM landed
  UNION ALL SELECT 'extensions', count(extensions), 'plain' FROM landed
  UNION ALL SELECT 'work_from_home', count(work_from_home), 'plain' FROM landed
  UNION ALL SELECT 'job_highlights', count(*) FILTER (title <> '5-LOW'), 'plain' FROM landed
  UNION ALL SELECT 'badge', count(*), 'mixed' FROM landed WHERE c_mktsegment IN ('HOUSEHOLD', 'FURNITURE')
  UNION ALL SELECT 'rating', count(*), 'plain' FROM landed WHERE c_mktsegment = 'HOUSEHOLD')
SELECT field, n_postings, kind FROM named WHERE n_postings > 0""")
def q_page_fields(spark, sf_dir):
    profile = page_ops.field_profile(page_ops.posting_fields(staged(changed_pages(spark, sf_dir), "archive")))
    return profile.select("field", "n_postings", F.when(F.col("type") == "VARIANT", "mixed").otherwise("plain").alias("kind"))


@register("landing_by_data", _LANDED_SQL + """
SELECT title, company_name, location, via, description, array_to_string(extensions, '|') AS extensions, job_id, thumbnail,
       posted_at, schedule_type, salary, work_from_home, search_time AS date_time, c_mktsegment AS search_term,
       n_name AS search_location,
       CASE c_mktsegment WHEN 'MACHINERY' THEN '{"via":{"site":"MACHINERY"}}'
            WHEN 'BUILDING' THEN CASE WHEN o_orderstatus = 'O' THEN '{"schedule_type":["Contractor"]}' END
            WHEN 'HOUSEHOLD' THEN '{"badge":"new","rating":{"by":["a","b"],"stars":4.5}}'
            WHEN 'FURNITURE' THEN '{"badge":7}' END AS rescued
FROM landed""")
def q_landing_by_data(spark, sf_dir):
    rows = page_ops.landing_by_data(staged(changed_pages(spark, sf_dir), "archive"), load_time=F.col("search_time"))
    return rows.withColumn("extensions", F.array_join("extensions", "|"))


# --------------------------------------------------- S8 page chains
def chained_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A search per customer whose pages are blocks of ten orders, in order: the
    first is asked for without a token, each names the next one.  Pages of
    pending orders only were never landed (gaps); the last page of a customer
    in debt names the customer's second page (a ring)."""
    orders = ad.read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus"])
    customer = ad.read_table(spark, sf_dir, "customer", ["c_custkey", "c_acctbal"])
    blocks = (orders.groupBy("o_custkey", F.floor(F.col("o_orderkey") / ad.PAGE_SIZE).alias("block"))
              .agg(F.max(F.col("o_orderstatus") != "P").alias("landed")))
    # a customer's blocks: bounded by the customer's orders, ten to a block
    own = Window.partitionBy("o_custkey").orderBy("block")
    token = F.concat(F.lit("p"), F.col("block").cast("string"))
    every = own.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    named = blocks.select("*", F.row_number().over(own).alias("n"), F.lead(token).over(own).alias("after"),
                          F.nth_value(token, 2).over(every).alias("second"))
    whole = named.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return whole.where("landed").select(
        F.col("o_custkey").alias("search"), F.when(F.col("n") > 1, token).alias("token"),
        F.coalesce("after", F.when((F.col("c_acctbal") < 0) & (F.col("n") > 2), F.col("second"))).alias("next_token"))


@register("page_chains", """
WITH RECURSIVE blocks AS (
  SELECT o_custkey, o_orderkey // 10 AS block, bool_or(o_orderstatus <> 'P') AS landed FROM orders GROUP BY ALL),
named AS (
  SELECT *, row_number() OVER own AS n, lead('p' || block) OVER own AS after,
         nth_value('p' || block, 2) OVER (own ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS second
  FROM blocks WINDOW own AS (PARTITION BY o_custkey ORDER BY block)),
pages AS (
  SELECT o_custkey AS search, CASE WHEN n > 1 THEN 'p' || block END AS token,
         coalesce(after, CASE WHEN c_acctbal < 0 AND n > 2 THEN second END) AS next_token
  FROM named JOIN customer ON o_custkey = c_custkey WHERE landed),
-- the page ahead: the one without a token first, then the least token
ahead AS (
  SELECT search, next_token AS token, bool_or(token IS NULL) AS by_first, min(token) AS by_token
  FROM pages WHERE next_token IS NOT NULL AND next_token IS DISTINCT FROM token GROUP BY ALL),
linked AS (
  SELECT p.*, a.search IS NOT NULL AND p.token IS NOT NULL AS has_ahead,
         CASE WHEN NOT a.by_first THEN a.by_token END AS ahead_token,
         coalesce(p.next_token = p.token, false) AS own_ring
  FROM pages p LEFT JOIN ahead a ON a.search = p.search AND a.token = p.token),
walk AS (
  SELECT search, token, token AS chain_start, CAST(0 AS BIGINT) AS place FROM linked
  WHERE token IS NULL OR (NOT has_ahead AND NOT own_ring)
  UNION ALL
  SELECT l.search, l.token, w.chain_start, w.place + 1
  FROM walk w JOIN linked l ON l.search = w.search AND l.has_ahead AND l.ahead_token IS NOT DISTINCT FROM w.token)
SELECT l.search, l.token, l.next_token,
       CASE WHEN w.place IS NOT NULL AND w.chain_start IS NULL THEN w.place END AS result_offset,
       w.chain_start, w.place,
       CASE WHEN w.place IS NULL THEN 'cycle' WHEN w.chain_start IS NULL THEN 'whole' ELSE 'broken' END AS state,
       CASE WHEN l.next_token IS NULL THEN 'none' WHEN n.search IS NULL THEN 'missing'
            WHEN n.has_ahead AND n.ahead_token IS NOT DISTINCT FROM l.token THEN 'follows' ELSE 'elsewhere' END AS next_is
FROM linked l LEFT JOIN walk w ON w.search = l.search AND w.token IS NOT DISTINCT FROM l.token
LEFT JOIN linked n ON n.search = l.search AND n.token = l.next_token""")
def q_page_chains(spark, sf_dir):
    return page_ops.page_chains(staged(chained_pages(spark, sf_dir), "pages"))


# -------------------------------------------------- T2 title model
TITLE_WORDS = r"^[ \t\n]*([^ \t\n]+(?:[ \t\n]+[^ \t\n]+){0,7})"
LANGUAGES = ["en", "de", "fr", "es"]


def headline_titles(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(labelled titles, all titles): the first eight words of the documents.
    Those of documents that ``labels`` covers are labelled, by their language."""
    docs = ad.read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang"])
    covered = ad.read_table(spark, sf_dir, "labels", ["doc_id"]).distinct()
    rows = staged(docs.select("doc_id", F.regexp_extract("text", TITLE_WORDS, 1).alias("job_title"), F.col("lang").alias("job_title_clean"))
                  .where(F.col("job_title") != ""), "titles")
    return rows.join(covered, "doc_id", "left_semi").drop("doc_id"), rows.drop("doc_id")


_MODEL_SQL = f"""
WITH t AS (
  SELECT doc_id, regexp_extract(text, '{TITLE_WORDS}', 1) AS job_title, lang FROM documents),
titles AS (SELECT * FROM t WHERE job_title <> ''),
words AS (
  SELECT job_title, list_filter(string_split(list_reduce(list_prepend(' ' || trim(regexp_replace(lower(job_title), '[^a-z0-9]+', ' ', 'g')) || ' ',
         {[f"{a}|{b}" for a, b in ABBREVIATIONS.items()]}),
         lambda s, r: regexp_replace(s, ' ' || string_split(r, '|')[1] || ' ', ' ' || string_split(r, '|')[2] || ' ', 'g')), ' '),
         lambda w: w <> '') AS w
  FROM (SELECT DISTINCT job_title FROM titles)),
grams AS (
  SELECT job_title, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS gram FROM words),
known AS (SELECT DISTINCT job_title, lang FROM titles WHERE doc_id IN (SELECT doc_id FROM labels)),
places(pos, lang) AS (VALUES {", ".join(f"({i}, '{x}')" for i, x in enumerate(LANGUAGES))}),
counts AS (SELECT gram, lang, count(*) AS n FROM known JOIN grams USING (job_title) WHERE lang IN (SELECT lang FROM places) GROUP BY ALL),
vocabulary AS (SELECT DISTINCT gram FROM counts),
bases AS (
  SELECT pos, lang, ln(count(*) / sum(count(*)) OVER ()) AS base FROM known JOIN places USING (lang) GROUP BY pos, lang),
sums AS (SELECT lang, sum(n) + (SELECT count(*) FROM vocabulary) AS whole FROM counts GROUP BY lang),
scored AS (
  SELECT g.job_title, b.pos, b.lang, count(*) AS n_known,
         round(sum(ln(coalesce(c.n, 0) + 1)) - count(*) * ln(any_value(s.whole)) + any_value(b.base), {title_model.DECIMALS}) AS score
  FROM grams g JOIN vocabulary v USING (gram) CROSS JOIN bases b JOIN sums s ON s.lang = b.lang
  LEFT JOIN counts c ON c.gram = g.gram AND c.lang = b.lang
  GROUP BY g.job_title, b.pos, b.lang)
SELECT job_title, lang AS job_title_clean, n_known, round(score, 6) AS score FROM scored
QUALIFY row_number() OVER (PARTITION BY job_title ORDER BY score DESC, pos) = 1"""


@register("title_model", _MODEL_SQL)
def q_title_model(spark, sf_dir):
    labelled, titles = headline_titles(spark, sf_dir)
    model = title_model.fit(labelled, LANGUAGES, sinks.scratch_path(spark, "title-model"))
    return title_model.score(titles, model).withColumn("score", F.round("score", 6))


# --------------------------------------- T1 / S6 dictionary as a table
_TOKENS_SQL = r"""
WITH toks AS (
  SELECT doc_id, lang, list_filter(list_transform(regexp_split_to_array(lower(text), '\s+'),
           lambda w: regexp_replace(w, '^[,;:!?*\-()"'']+|[.,;:!?*\-()"'']+$', '', 'g')), lambda w: w <> '') AS tok
  FROM documents)"""


def phrase_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dictionary that grows with the data: the first word, and the first two
    and three words, of every document, by language."""
    docs = ad.read_table(spark, sf_dir, "documents", ["lang", "text"])
    tok = docs.select("lang", skill_ops.tokens("text").alias("t"))
    phrases = F.array(*(F.when(F.size("t") >= n, F.array_join(F.slice("t", 1, n), " ")) for n in (1, 2, 3)))
    return (tok.select(F.coalesce("lang", F.lit("none")).alias("category"), F.explode(phrases).alias("keyword"))
            .where(F.col("keyword").isNotNull()).distinct())


@register("keyword_table", _TOKENS_SQL + """,
dict AS (
  SELECT DISTINCT coalesce(lang, 'none') AS category, array_to_string(tok[1:n], ' ') AS keyword
  FROM toks, (VALUES (1), (2), (3)) v(n) WHERE len(tok) >= n),
pos AS (SELECT doc_id, tok, unnest(range(1, len(tok) + 1)) AS i FROM toks),
grams AS (
  SELECT doc_id, i, tok[i] AS g FROM pos
  UNION ALL SELECT doc_id, i, tok[i] || ' ' || tok[i + 1] FROM pos WHERE i + 1 <= len(tok)
  UNION ALL SELECT doc_id, i, tok[i] || ' ' || tok[i + 1] || ' ' || tok[i + 2] FROM pos WHERE i + 2 <= len(tok))
SELECT doc_id, category, keyword, CAST(min(i) AS INTEGER) AS place FROM grams JOIN dict ON g = keyword GROUP BY ALL""")
def q_keyword_table(spark, sf_dir):
    path = sinks.scratch_path(spark, "dictionary")
    skill_ops.write_dictionary(phrase_dictionary(spark, sf_dir), path)
    docs = ad.read_table(spark, sf_dir, "documents", ["doc_id", "text"], heavy=True)
    return skill_ops.tag_by_table(docs, "text", skill_ops.read_dictionary(spark, path), key="doc_id")


# ------------------------------------------------------------- K10
@register("load_report", """
SELECT s_nationkey, count(*) AS rows, 'struct<s_suppkey:bigint,s_name:string,s_nationkey:' ||
       lower(CASE typeof(any_value(s_nationkey)) WHEN 'INTEGER' THEN 'int' ELSE typeof(any_value(s_nationkey)) END) || ',s_acctbal:double>' AS schema
FROM supplier GROUP BY s_nationkey""")
def q_load_report(spark, sf_dir):
    """Each nation's suppliers and their schema, as a load's log has them."""
    supplier = ad.read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"])
    return sinks.reports(supplier, "s_nationkey")
