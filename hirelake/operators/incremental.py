"""T3 incremental enrichment and the anti/semi joins it relies on.

All joins here are equi-joins (hash or sort-merge, broadcast when AQE
measures a small side); no null-aware NOT IN, which Spark can only run as a
nested-loop join once the subquery side is large.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def new_keys(source: DataFrame, dim: DataFrame, key: str, *, null_aware: bool = False) -> DataFrame:
    """Rows of ``source`` whose key is not yet in ``dim``.

    Default: ``left_anti`` on non-NULL keys.  ``null_aware=True`` gives the
    exact ``NOT IN (subquery)`` result: a NULL key in ``dim`` empties the
    result, a NULL key in ``source`` is left out unless ``dim`` is empty
    (expressed as EXISTS over the dim, not as a nested-loop join)."""
    known = dim.select(key).where(F.col(key).isNotNull())
    if not null_aware:
        return source.where(F.col(key).isNotNull()).join(known, key, "left_anti")
    dim_has_null = dim.where(F.col(key).isNull()).select(F.lit(1)).exists()
    dim_is_empty = ~dim.select(F.lit(1)).exists()
    return (source.join(known, key, "left_anti")
            .where((F.col(key).isNotNull() | dim_is_empty) & ~dim_has_null))


def unlabelled(source: DataFrame, dim: DataFrame, key: str, label: str) -> DataFrame:
    """LEFT JOIN ... WHERE label IS NULL (a key present with a NULL label
    is returned again)."""
    return (source.join(dim.select(key, label), key, "left")
            .where(F.col(label).isNull()))


def semi(source: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is IN the (small) key set."""
    return source.join(keys.select(key), key, "left_semi")


def enrich_new(source: DataFrame, dim: DataFrame, key: str,
               enrich: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows to append to ``dim``: enrich only keys it lacks.

    Running it again after the append yields nothing new (idempotent)."""
    return enrich(new_keys(source, dim, key))
