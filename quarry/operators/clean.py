"""Cleaning operators: null profiles, de-duplication and key validations.

All are single aggregation passes (partial aggregate on the map side, one
shuffle on the grouping key), so a hot key only grows one hash-map entry per
task before the exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: ``total`` = count(*), and ``<col>_non_null`` = count(col)."""
    cols = list(columns or df.columns)
    return df.agg(F.count(F.lit(1)).alias("total"),
                  *[F.count(F.col(c)).alias(f"{c}_non_null") for c in cols])


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: ``<col>_nulls`` = number of rows where col IS NULL (count_if)."""
    cols = list(columns or df.columns)
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in cols])


def dedupe_keep_max(df: DataFrame, keys: Sequence[str], rest: Sequence[str] | None = None,
                    drop_null_keys: bool = True) -> DataFrame:
    """Collapse rows per key, keeping ``max`` of every other column.

    ``max`` ignores NULL, so a duplicate that lost a value (e.g. email) merges
    into the row that kept it.
    """
    rest = [c for c in (rest or df.columns) if c not in keys]
    src = df
    if drop_null_keys:
        cond = None
        for k in keys:
            c = F.col(k).isNotNull()
            cond = c if cond is None else cond & c
        src = df.filter(cond)
    return src.groupBy(*keys).agg(*[F.max(c).alias(c) for c in rest])


def max_rows_per_key(df: DataFrame, keys: Sequence[str], alias: str = "no_duplicate_ids") -> DataFrame:
    """Uniqueness validation: ``max(count(*) per key) <= 1`` as one boolean row."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
    return per_key.agg((F.max("row_count") <= 1).alias(alias))


def at_most_one(df: DataFrame, key: str, value: str, alias: str = "at_most_one_id") -> DataFrame:
    """At-most-one validation: every non-null ``key`` maps to <= 1 ``value``."""
    per_key = (df.filter(F.col(key).isNotNull())
                 .groupBy(key).agg(F.count(value).alias("value_count")))
    return per_key.agg((F.max("value_count") <= 1).alias(alias))
