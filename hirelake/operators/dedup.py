"""Keep one row per key.

``dropDuplicates`` keeps an arbitrary survivor.  Here the survivor is the
smallest row (by the given order columns, then by all remaining columns), and
the choice is an aggregate (``min`` of a struct) that Spark combines map-side,
so a key holding a third of all rows is reduced inside every map task before
the shuffle and never gathered into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup_by_key(df: DataFrame, keys: Sequence[str],
                 order_by: Sequence[str] = ()) -> DataFrame:
    """One row per key (NULL keys compare equal, as in GROUP BY / PARTITION BY).

    The survivor has the smallest ``order_by`` values; ties are broken by
    the remaining columns, so the result does not depend on the plan."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    ordered = list(order_by) + [c for c in rest if c not in order_by]
    packed = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(ordered)])
    best = df.groupBy(*keys).agg(F.min(packed).alias("_best"))
    return best.select(*keys, *[F.col(f"_best._o{ordered.index(c)}").alias(c) for c in rest])
