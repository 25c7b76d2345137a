"""Data-quality operators: batch completeness profile (A8) and grain check.

Both are single aggregations with partial (map-side) aggregation; their output
is one row per group, never the input rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# columns the collectors report on after each batch
PROFILE_COLUMNS = ["company", "location", "sector", "function", "contract_type", "education", "experience"]
PROFILE_LENGTHS = [50, 100]


def completeness_profile(df: DataFrame, by: str | None = None) -> DataFrame:
    """Total rows, non-null count per column, rows whose description is
    longer than 50 / 100 characters — in one pass, optionally per group."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    aggs += [F.count(c).alias(f"n_{c}") for c in PROFILE_COLUMNS if c in df.columns]
    aggs += [F.count_if(F.length("description") > k).alias(f"n_description_gt_{k}") for k in PROFILE_LENGTHS]
    return df.groupBy(by).agg(*aggs) if by else df.agg(*aggs)


def completeness_profile_sql(table: str, by: str | None = None) -> str:
    cols = ["COUNT(*) AS n_rows"] + [f'COUNT("{c}") AS n_{c}' for c in PROFILE_COLUMNS]
    cols += [f"COUNT(*) FILTER (WHERE length(description) > {k}) AS n_description_gt_{k}" for k in PROFILE_LENGTHS]
    select = (f"{by}, " if by else "") + ", ".join(cols)
    return f"SELECT {select} FROM {table}" + (f" GROUP BY {by}" if by else "")


def grain_check(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row (empty when the declared grain holds)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .filter(F.col("n_rows") > 1))
