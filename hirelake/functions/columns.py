"""Column-expression helpers shared by the operators (all JVM-side)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names of the reporting timeframes, in the order the marts list them.
ALL_TIME = "All time"
LAST_7 = "Last 7 days"
LAST_30 = "Last 30 days"
YTD = "YTD"
TIMEFRAME_NAMES = [ALL_TIME, LAST_7, LAST_30, YTD]


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_lit(as_of: str | _dt.date | Column) -> Column:
    """The reporting date as a DATE literal (``as_of`` replaces CURRENT_DATE)."""
    if isinstance(as_of, Column):
        return as_of.cast("date")
    return F.lit(str(as_of)).cast("date")


def timeframe_start(name: str, as_of) -> Column | None:
    """Lower bound (inclusive) of a timeframe, or None for all time."""
    d = date_lit(as_of)
    if name == ALL_TIME:
        return None
    if name == LAST_7:
        return F.date_sub(d, 7)
    if name == LAST_30:
        return F.date_sub(d, 30)
    if name == YTD:
        return F.trunc(d, "year")
    raise ValueError(f"unknown timeframe {name!r}")


def in_timeframe(ts: str | Column, name: str, as_of) -> Column:
    """``ts >= start`` (NULL timestamps fall outside every bounded timeframe)."""
    start = timeframe_start(name, as_of)
    if start is None:
        return F.lit(True)
    return col(ts) >= start


# Month partition column of stored wide/fact tables (first day of the month).
MONTH_COL = "search_month"


def month_of(ts: str | Column) -> Column:
    return F.trunc(F.to_date(col(ts)), "month")


def timeframe_filter(df, ts: str, name: str, as_of):
    """Rows of a timeframe.  When the table is stored partitioned by the
    month of ``ts`` (column ``search_month``), the same bound is also put on
    the month, which Catalyst folds to a literal: the scan then skips every
    older partition (a 7-day mart reads one or two months, not the history)."""
    start = timeframe_start(name, as_of)
    if start is None:
        return df
    out = df.where(col(ts) >= start)
    if MONTH_COL in df.columns:
        out = out.where(F.col(MONTH_COL) >= F.trunc(start, "month"))
    return out


def true_or_null(cond: Column) -> Column:
    """TRUE when the condition holds, otherwise NULL (never FALSE)."""
    return F.when(cond, F.lit(True))


def empty_to_null(arr: str | Column) -> Column:
    """An empty array becomes NULL; NULL stays NULL."""
    a = col(arr)
    return F.when(F.size(a) > 0, a)


def null_to_false(c: str | Column) -> Column:
    return F.coalesce(col(c), F.lit(False))


def round6(c: str | Column) -> Column:
    """Float results are order dependent in their last bits; compare at 6 places."""
    return F.round(col(c), 6)
