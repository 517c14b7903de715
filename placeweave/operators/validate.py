"""Checks at stage boundaries: one aggregate each, an error with a count and examples."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import DataError


def require_columns(df: DataFrame, names: Iterable[str], source: str) -> None:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise DataError(f"{source}: missing columns {', '.join(missing)}")


def reject(df: DataFrame, bad: Column, show: list[str], what: str, examples: int = 5) -> None:
    """Raise if any row is bad; at most so many examples reach the driver."""
    found = df.where(bad).select(*show)
    some = [tuple(r) for r in found.limit(examples).collect()]
    if some:
        raise DataError(f"{what}: {found.count()} rows, such as {some}")


def reject_blank(df: DataFrame, names: list[str], source: str) -> None:
    bad = F.lit(False)
    for n in names:
        bad = bad | F.col(n).isNull() | (F.col(n) == "")
    reject(df, bad, names, f"{source}: blank {', '.join(names)}")


def reject_duplicates(df: DataFrame, keys: list[str], source: str) -> None:
    reject(df.groupBy(*keys).count(), F.col("count") > 1, [*keys, "count"], f"{source}: repeated {', '.join(keys)}")


def reject_conflicts(df: DataFrame, key: str, value: str, source: str) -> None:
    """More than one value of a key."""
    reject(df.groupBy(key).agg(F.count_distinct(value).alias("n"), F.min(value).alias("low"), F.max(value).alias("high")), F.col("n") > 1, [key, "low", "high"], f"{source}: {key} with several {value}")
