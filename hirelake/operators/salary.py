"""Salary text -> salary dimension (one row per job id).

``62K–65K a year`` -> min 62000, max 65000, avg 63500, salary_year 63500.
Only the en dash (U+2013) marks a range; each side of a range is scaled by
its own ``K``; malformed numbers become NULL (``try_cast``, ANSI-safe).
Numbers are DOUBLE (the reference stores 32-bit floats).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedup import dedup_by_key

EN_DASH = "–"

SALARY_COLUMNS = ["salary_pay", "salary_rate", "salary_avg", "salary_min", "salary_max",
                  "salary_year", "salary_hour"]


def _number(s: Column) -> Column:
    """Strip a ``K`` and multiply by 1000, else plain number; bad -> NULL."""
    scaled = F.replace(s, F.lit("K"), F.lit("")).try_cast("double") * F.lit(1000.0)
    return F.when(s.contains("K"), scaled).otherwise(s.try_cast("double"))


def _parsed(t: Column, compat: bool, step: Callable[[str, Column], Column]) -> dict[str, Column]:
    """The salary columns; ``step`` gets each value that later ones use several
    times, and gives the column by which they use it."""
    words = step("_words", F.split(t, " "))
    pay = F.replace(F.get(words, 0), F.lit(","), F.lit(""))      # Y1, Y2
    rate = F.get(words, 2)
    pay = F.regexp_replace(pay, "$", "") if compat else F.replace(pay, F.lit("$"), F.lit(""))
    pay = step("_pay", F.replace(pay, F.lit(" "), F.lit("")))
    is_range = pay.contains(EN_DASH)                             # Y3
    single = step("_single", F.when(~is_range, pay))
    bounds = step("_bounds", F.split(F.when(is_range, pay), EN_DASH))   # Y4
    lo = step("_lo", _number(F.get(bounds, 0)))
    hi = step("_hi", _number(F.get(bounds, 1)))
    avg = step("_avg", F.when(lo.isNotNull(), (lo + hi) / 2).otherwise(_number(single)))   # Y7
    return {
        "salary_pay": pay,
        "salary_rate": rate,
        "salary_avg": avg,
        "salary_min": lo,
        "salary_max": hi,
        "salary_year": F.when(rate.contains("year"), avg),        # Y8
        "salary_hour": F.when(rate.contains("hour"), avg),
    }


def parse_salary_columns(text: str | Column, *, compat: bool = False) -> dict[str, Column]:
    """The seven salary columns as expressions over one text column.

    ``compat=True`` reproduces the reference's no-op ``$`` removal (an
    unescaped regex anchor), which leaves ``$``-prefixed pay unparsed.
    Over many rows use ``with_salary``: here each column repeats the whole parse."""
    return _parsed(F.col(text) if isinstance(text, str) else text, compat, lambda _, c: c)


def with_salary(df: DataFrame, text: str, *, compat: bool = False) -> DataFrame:
    """``df`` with the seven salary columns.  Each step is a projection of its
    own, so that a value is worked out once a row and not at each use."""
    held = df

    def step(name: str, column: Column) -> Column:
        nonlocal held
        held = held.withColumn(name, column)
        return F.col(name)

    cols = _parsed(F.col(text), compat, step)
    return held.select(*df.columns, *[e.alias(n) for n, e in cols.items()])


def salary_dimension(fact: DataFrame, *, key: str = "job_id", text: str = "job_salary",
                     compat: bool = False) -> DataFrame:
    """Salary dimension: rows with salary text, one per key, parsed.

    The dedup keeps, per key, the smallest salary text (deterministic and
    combined map-side, so a hot key does not gather in one task)."""
    src = fact.select(key, text).where(F.col(text).isNotNull())          # S3
    one = dedup_by_key(src, [key])                                        # A11
    return with_salary(one, text, compat=compat).select(key, *SALARY_COLUMNS)
