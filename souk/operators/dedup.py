"""Keyed de-duplication.

Both operators keep one row per key with ``row_number() = 1`` over a window.
Spark plans this as a *partial* ``WindowGroupLimit`` before the shuffle and a
final one after it, so a key that holds a third of all rows ships at most one
row per map partition — the hot key never lands whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per ``keys``: the first by ``order`` (make ``order`` total for
    deterministic output)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def latest_per_key(df: DataFrame, key: str, ts: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """The most recent row per ``key`` (``ts DESC``, NULLs first as in
    PostgreSQL), ties broken by ``tiebreak`` ascending."""
    return keep_first(df, [key], [F.col(ts).desc_nulls_first()] + [F.col(c).asc_nulls_first() for c in tiebreak])
