"""Visits: transactions of a card at a merchant, close repeats merged, busy card days dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import VisitConfig


def merged(tx: DataFrame, window_minutes: int) -> DataFrame:
    """A visit starts where the card's last transaction at the merchant is none or window_minutes old or more."""
    before = F.lag("timestamp").over(Window.partitionBy("card_id", "merchant_id").orderBy("timestamp"))
    gap = F.timestamp_diff("MICROSECOND", F.col("_before"), F.col("timestamp"))
    rows = tx.select("card_id", "merchant_id", "timestamp").withColumn("_before", before)
    return rows.where(F.col("_before").isNull() | (gap >= window_minutes * 60_000_000)).drop("_before")


def daily_merchants(visits: DataFrame) -> DataFrame:
    """Distinct merchants of each card and day."""
    return visits.groupBy("card_id", F.col("timestamp").cast("date").alias("day")).agg(F.count_distinct("merchant_id").alias("merchants"))


def without_busy_days(visits: DataFrame, most: int) -> DataFrame:
    """All visits of a card's day go if it has more than most merchants."""
    busy = daily_merchants(visits).where(F.col("merchants") > most).select("card_id", "day")
    return visits.withColumn("day", F.col("timestamp").cast("date")).join(busy, ["card_id", "day"], "left_anti").drop("day")


def build_visits(tx: DataFrame, config: VisitConfig = VisitConfig()) -> DataFrame:
    return without_busy_days(merged(tx, config.merge_window_minutes), config.max_daily_merchants)


def visit_counts(visits: DataFrame) -> DataFrame:
    return visits.groupBy("merchant_id").agg(F.count("*").alias("visits"))
