"""Checks that return the offending rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def check_unique(df: DataFrame, key) -> DataFrame:
    """Keys held by more than one row, with their number of rows."""
    return df.groupBy(*_keys(key)).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def check_not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with a null in any of the columns."""
    return df.filter(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns]))


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def check_range(df: DataFrame, *conditions: Column) -> DataFrame:
    """Rows that break a condition; a condition that is null passes."""
    ok = reduce(lambda a, b: a & b, [F.coalesce(c, F.lit(True)) for c in conditions])
    return df.filter(~ok)


def check_fk(df: DataFrame, parent: DataFrame, key, parent_key=None) -> DataFrame:
    """Rows whose key has no parent; a key with a null in it passes."""
    keys, parents = _keys(key), _keys(parent_key or key)
    p = parent.select(*[F.col(b).alias(a) for a, b in zip(keys, parents)])
    return df.dropna(subset=keys).join(p, keys, "left_anti")


def with_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    return df.select(
        *[F.coalesce(F.col(c), F.lit(defaults[c])).alias(c) if c in defaults else F.col(c) for c in df.columns]
    )


def check_thresholds(df: DataFrame, blue: str = "blue", yellow: str = "yellow", red: str = "red") -> DataFrame:
    """Sites whose thresholds are not blue < yellow < red."""
    return check_range(df, (F.col(blue) < F.col(yellow)) & (F.col(yellow) < F.col(red)))
