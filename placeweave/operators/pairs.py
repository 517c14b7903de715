"""Pair evidence: two merchants that one card visits within a window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import PairConfig
from ..functions.times import minutes_between


def evidence(visits: DataFrame, window_minutes: int, decay_minutes: float) -> DataFrame:
    """card_id, l, r, weight of every two visits at most window_minutes apart.

    A band join: visits are dealt to time buckets of the window's length, the right side also
    to both neighbours, so the join keys are card and bucket and a card with a long history
    meets only nearby visits of its own.
    """
    micros = window_minutes * 60_000_000
    zero = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    bucket = F.floor(F.timestamp_diff("MICROSECOND", zero, F.col("timestamp")) / micros).cast("bigint")
    a = visits.select("card_id", F.col("merchant_id").alias("l"), F.col("timestamp").alias("ta"), bucket.alias("b"))
    near = F.explode(F.array(*(F.col("b") + k for k in (-1, 0, 1)))).alias("b")
    b = a.select("card_id", F.col("l").alias("r"), F.col("ta").alias("tb"), near)
    apart = F.abs(F.timestamp_diff("MICROSECOND", F.col("ta"), F.col("tb")))
    both = a.join(b, ["card_id", "b"]).where((F.col("l") < F.col("r")) & (apart <= micros))
    return both.select("card_id", "l", "r", F.exp(-F.abs(minutes_between(F.col("ta"), F.col("tb"))) / F.lit(float(decay_minutes))).alias("weight"))


def card_votes(found: DataFrame) -> DataFrame:
    """One vote a card and pair: its closest visits."""
    return found.groupBy("card_id", "l", "r").agg(F.max("weight").alias("weight"))


def pair_statistics(visits: DataFrame, config: PairConfig = PairConfig()) -> DataFrame:
    """l, r, strength (sum of the cards' votes), support (cards)."""
    votes = card_votes(evidence(visits, config.window_minutes, config.decay_minutes))
    return votes.groupBy("l", "r").agg(F.sum("weight").alias("strength"), F.count("*").alias("support"))


def merge_statistics(*parts: DataFrame) -> DataFrame:
    """Statistics of disjoint sets of cards, added."""
    out = parts[0].select("l", "r", "strength", "support")
    for p in parts[1:]:
        out = out.unionByName(p.select("l", "r", "strength", "support"))
    return out.groupBy("l", "r").agg(F.sum("strength").alias("strength"), F.sum("support").alias("support"))


def tiered_evidence(visits: DataFrame, window_minutes: int = 120, damped: bool = False) -> DataFrame:
    """The older weights: 3, 2 or 1 by thirds of the window, summed; damped: divided by the root of a card's visits."""
    found = evidence(visits, window_minutes, 1.0)
    apart = -F.log("weight")
    tier = F.when(apart <= window_minutes / 3, 3.0).when(apart <= 2 * window_minutes / 3, 2.0).otherwise(1.0)
    found = found.withColumn("weight", tier)
    if damped:
        own = visits.groupBy("card_id").agg(F.count("*").alias("n"))
        found = found.join(own, "card_id").withColumn("weight", F.col("weight") / F.sqrt("n"))
    return found.groupBy("l", "r").agg(F.sum("weight").alias("weight"))


def both_ways(edges: DataFrame, *more: str) -> DataFrame:
    """Each edge from either end: node, other and the named columns."""
    a = edges.select(F.col("l").alias("node"), F.col("r").alias("other"), *more)
    return a.unionByName(edges.select(F.col("r").alias("node"), F.col("l").alias("other"), *more))
