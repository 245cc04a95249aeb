"""Search planning: T5 country weights, O3 weighted order, O4 search plan,
W5 budget cut-off.

These mostly work on per-country tables, but O3 and W5 put no bound on their
input: places and running sums come from range partitions and the totals of the
partitions ahead, so no window sees the whole table in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .numbering import number_rows, sum_before

# FIXED VALUES: the reference's search terms.
SEARCH_TERMS = ["Data Analyst", "Data Scientist", "Data Engineer"]


def ratio_to_total(df: DataFrame, value: str, out: str = "percent") -> DataFrame:
    """Value / SUM(value) over all rows; the sum is a scalar subquery
    (partial aggregate), not a window that gathers all rows in one task."""
    total = df.agg(F.sum(value)).scalar()
    return df.withColumn(out, F.try_divide(F.col(value), total))


def country_weights(views: DataFrame, codes: DataFrame, *, geography: str = "Geography",
                    views_col: str = "Views", watch: str = "Watch time (hours)",
                    exclude: Sequence[str] = ("US",), total_label: str = "Total") -> DataFrame:
    """T5: (country, percent) from a views report and a country-code table.

    Drops the total row (by value, not position), countries without views and
    the excluded codes (P26), weights by watch time (A14) and names the
    country by a left join on the code (J11).  The code table is not
    hinted: AQE broadcasts it once it has measured it small."""
    kept = views.where((F.col(geography) != total_label) & (F.col(views_col) != 0)
                       & ~F.col(geography).isin(*exclude))
    weighted = ratio_to_total(kept, watch)
    return (weighted.join(codes.select(F.col("code"), F.col("country")),
                          F.col(geography) == F.col("code"), "left")
            .select("country", "percent"))


def weighted_order(df: DataFrame, weight: str, *, seed: int, key: Sequence[str] | None = None,
                   out: str = "draw_rank") -> DataFrame:
    """O3: weighted random permutation without replacement (Efraimidis-Spirakis:
    sort by -ln(U)/w ascending).

    U in (0, 1] comes from the first 13 digits of the MD5 of the seed and the
    row's key columns (default: every column but the weight), not from
    ``rand``: the draw of a row does not depend on row order inside a
    partition, so it is the same on every task retry and under any plan.
    Rows without weight come last."""
    key = [c for c in df.columns if c != weight] if key is None else list(key)
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in key]))
    u = (F.conv(F.left(digest, F.lit(13)), 16, 10).cast("bigint") + 1).cast("double") / float(1 << 52)
    drawn = df.withColumn("_es_key", F.coalesce(F.try_divide(-F.log(u), F.col(weight)), F.lit(float("inf"))))
    return number_rows(drawn, ["_es_key", *key], out).drop("_es_key")


def search_plan(locations: DataFrame, location: str, terms: Sequence[str] = SEARCH_TERMS,
                *, term_col: str = "search_term") -> DataFrame:
    """Every (location, term) pair, terms being a short fixed list: each
    location row is expanded in place (no join)."""
    return locations.withColumn(term_col, F.explode(F.array(*[F.lit(t) for t in terms])))


def budget_cutoff(items: DataFrame, order: str | Column, cost: str, limit: int,
                  *, start: int = 0, out: str = "spent_before") -> DataFrame:
    """Keep items while the amount spent before the item is below the limit
    (items of one place in ``order``: by their other columns)."""
    spent = sum_before(items, [order, *(c for c in items.columns if c != order)], cost, out)
    return spent.withColumn(out, F.lit(start) + F.col(out)).where(F.col(out) < limit)
