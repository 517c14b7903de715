"""Scores of merchants against communities by graph, place and customers; their fusion, decision and review.

Members: merchant_id, community_id. Anchors are members, a bounded number of each community.
A merchant or community without evidence of a kind has no row in that kind's scores. Empty
inputs give empty results; rows with null names link nothing. Inputs need one row a merchant.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import haversine_m
from .geo import _celled
from .pairs import both_ways

#: Weights of graph, geographic and customer scores.
WEIGHTS = (0.6, 0.3, 0.1)


def _strongest(edges: DataFrame, k: int) -> DataFrame:
    """node, other, weight of each node's k strongest neighbours, ties by name."""
    order = Window.partitionBy("node").orderBy(F.desc("weight"), "other")
    return both_ways(edges, "weight").withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= k).select("node", "other", "weight")


def graph_scores(edges: DataFrame, members: DataFrame, anchors: DataFrame, k: int, boost: float = 1.5) -> DataFrame:
    """node, community_id, graph: the share of its k strongest neighbours' weight that the community has; an anchor counts boost times."""
    m = members.select(F.col("merchant_id").alias("other"), "community_id")
    a = anchors.select(F.col("merchant_id").alias("other")).distinct().withColumn("_anchor", F.lit(True))
    votes = _strongest(edges, k).join(m, "other", "left").join(a, "other", "left")
    sums = votes.groupBy("node", "community_id").agg(F.sum(F.col("weight") * F.when(F.col("_anchor"), boost).otherwise(1.0)).alias("v"))
    total = sums.withColumn("t", F.sum("v").over(Window.partitionBy("node")))
    return total.where("community_id IS NOT NULL AND t > 0").select("node", "community_id", (F.col("v") / F.col("t")).alias("graph"))


def bandwidths(placed: DataFrame, least_m: float) -> DataFrame:
    """community_id, sigma: the median distance between two of its anchors, least_m at least; one anchor alone: least_m."""
    a = placed.select("community_id", "merchant_id", "longitude", "latitude")
    pair = a.toDF("community_id", "l", "xa", "ya").join(a.toDF("community_id", "r", "xb", "yb"), "community_id").where("l < r")
    gap = haversine_m(F.col("xa"), F.col("ya"), F.col("xb"), F.col("yb"))
    spread = pair.groupBy("community_id").agg(F.percentile(gap, F.lit(0.5)).alias("gap"))
    every = a.select("community_id").distinct().join(spread, "community_id", "left")
    return every.select("community_id", F.greatest(F.coalesce("gap", F.lit(least_m)), F.lit(least_m)).alias("sigma"))


def geo_scores(coords: DataFrame, anchors: DataFrame, reach_m: float, least_m: float = 100.0) -> DataFrame:
    """node, community_id, geo: Gaussian of the distance to the nearest anchor other than itself within reach_m."""
    placed = anchors.select("merchant_id", "community_id").join(coords, "merchant_id")
    a = _celled(coords.select("merchant_id", "longitude", "latitude"), reach_m, True).toDF("node", "lon_a", "lat_a", "_x", "_y", "_z")
    b = _celled(placed.select("merchant_id", "longitude", "latitude", "community_id"), reach_m, False).toDF("anchor", "lon_b", "lat_b", "community_id", "_x", "_y", "_z")
    d = haversine_m(F.col("lon_a"), F.col("lat_a"), F.col("lon_b"), F.col("lat_b"))
    near = a.join(b, ["_x", "_y", "_z"]).where("node <> anchor").withColumn("d", d).where(F.col("d") <= reach_m)
    least = near.groupBy("node", "community_id").agg(F.min("d").alias("d")).join(bandwidths(placed, least_m), "community_id")
    return least.select("node", "community_id", F.exp(-F.col("d") * F.col("d") / (2 * F.col("sigma") * F.col("sigma"))).alias("geo"))


def customer_scores(visits: DataFrame, members: DataFrame) -> DataFrame:
    """node, community_id, customers: exact Jaccard of the merchant's cards with those of the community's members."""
    seen = visits.select(F.col("merchant_id").alias("node"), "card_id").distinct()
    of = seen.join(members.select(F.col("merchant_id").alias("node"), "community_id"), "node").select("community_id", "card_id").distinct()
    both = seen.join(of, "card_id").groupBy("node", "community_id").agg(F.count("*").alias("both"))
    own = seen.groupBy("node").agg(F.count("*").alias("a"))
    all_ = of.groupBy("community_id").agg(F.count("*").alias("b"))
    return both.join(own, "node").join(all_, "community_id").select("node", "community_id", (F.col("both") / (F.col("a") + F.col("b") - F.col("both"))).alias("customers"))


def fused(graph: DataFrame, place: DataFrame, customers: DataFrame, coords: DataFrame) -> DataFrame:
    """node, community_id, graph, geo, customers, score; without coordinates the place's weight goes to the others in proportion."""
    keys = ["node", "community_id"]
    rows = graph.join(place, keys, "full").join(customers, keys, "full").na.fill(0.0, ["graph", "geo", "customers"])
    rows = rows.join(coords.select(F.col("merchant_id").alias("node"), F.lit(True).alias("_placed")), "node", "left")
    g, p, c = WEIGHTS
    full = g * F.col("graph") + p * F.col("geo") + c * F.col("customers")
    rest = (g * F.col("graph") + c * F.col("customers")) / (g + c)
    return rows.select(*keys, "graph", "geo", "customers", F.when(F.col("_placed"), full).otherwise(rest).alias("score"))


def decisions(scores: DataFrame, threshold: float, margin: float) -> DataFrame:
    """node, community_id (best, ties to the smaller), score, second, decision.

    review: graph and place name different communities, or the best passes the threshold by less
    than margin over the second; assign: it passes both; watch: the rest. Scores are compared to nine places.
    """
    s = scores.withColumns({c: F.round(c, 9) for c in ("graph", "geo", "score")})
    best = lambda c: F.min_by("community_id", F.struct(-F.col(c), F.col("community_id")))
    ranked = s.withColumn("_n", F.row_number().over(Window.partitionBy("node").orderBy(F.desc("score"), "community_id")))
    top = ranked.groupBy("node").agg(
        F.max(F.when(F.col("_n") == 1, F.col("community_id"))).alias("community_id"),
        F.max("score").alias("score"),
        F.coalesce(F.max(F.when(F.col("_n") == 2, F.col("score"))), F.lit(0.0)).alias("second"),
        (best("graph") != best("geo")).alias("_differ"),
        F.least(F.max("graph"), F.max("geo")).alias("_both"),
    )
    enough, clear = F.col("score") >= threshold, F.round(F.col("score") - F.col("second"), 9) >= margin
    conflict = F.col("_differ") & (F.col("_both") > 0)
    decision = F.when(conflict | (enough & ~clear), "review").when(enough, "assign").otherwise("watch")
    return top.select("node", "community_id", "score", "second", decision.alias("decision"))


def doubtful_members(scores: DataFrame, members: DataFrame, threshold: float) -> DataFrame:
    """merchant_id, community_id, score of members whose score for their own community is below the threshold; no evidence scores 0."""
    own = scores.select(F.col("node").alias("merchant_id"), "community_id", "score")
    held = members.select("merchant_id", "community_id").join(own, ["merchant_id", "community_id"], "left").na.fill(0.0, ["score"])
    return held.where(F.round("score", 9) < threshold)


def inferred_coordinates(edges: DataFrame, coords: DataFrame, k: int) -> DataFrame:
    """merchant_id, longitude, latitude of unplaced merchants: mean of the placed among the k strongest neighbours, by weight."""
    near = _strongest(edges.where("weight > 0"), k).join(coords.select(F.col("merchant_id").alias("node")), "node", "left_anti")
    near = near.join(coords.select(F.col("merchant_id").alias("other"), "longitude", "latitude"), "other")
    mean = lambda c: (F.sum(F.col("weight") * F.col(c)) / F.sum("weight")).alias(c)
    return near.groupBy(F.col("node").alias("merchant_id")).agg(mean("longitude"), mean("latitude"))


def stable_anchor_scores(scores: DataFrame, participation: DataFrame, coords: DataFrame, bonus: float = 0.5) -> DataFrame:
    """node, mean, stability, anchor_score from scores of several periods (node, period, score).

    A period without the node counts as 0. stability: mean / (1 + deviation); anchor score: mean by
    what does not participate elsewhere, by stability, and 1 + bonus where the place is known.
    """
    periods = scores.agg(F.count_distinct("period").alias("p"))
    sums = scores.groupBy("node").agg(F.sum("score").alias("s"), F.sum(F.col("score") * F.col("score")).alias("q")).crossJoin(F.broadcast(periods))
    mean = F.col("s") / F.col("p")
    each = sums.select("node", mean.alias("mean"), F.sqrt(F.greatest(F.col("q") / F.col("p") - mean * mean, F.lit(0.0))).alias("deviation"))
    each = each.withColumn("stability", F.col("mean") / (1 + F.col("deviation")))
    each = each.join(participation.select("node", "participation"), "node", "left").join(coords.select(F.col("merchant_id").alias("node"), F.lit(bonus).alias("_bonus")), "node", "left")
    score = F.col("mean") * (1 - F.coalesce("participation", F.lit(0.0))) * F.col("stability") * (1 + F.coalesce("_bonus", F.lit(0.0)))
    return each.select("node", "mean", "stability", score.alias("anchor_score"))


def online_features(tx: DataFrame, minutes: float = 10.0, metres_per_second: float = 35.0) -> DataFrame:
    """merchant_id, region_entropy, night_share, impossible_share.

    Entropy (natural) of the merchant's transactions over the cards' home regions, a card's most frequent
    region, ties to the smallest; share from 0 to 6 o'clock; consecutive transactions of a card within
    the minutes whose places nobody reaches in time, by the merchant's transactions (one may be in two pairs, so up to 2).
    """
    home = tx.groupBy("card_id", "region").agg(F.count("*").alias("n")).groupBy("card_id").agg(F.min_by("region", F.struct(-F.col("n"), F.col("region"))).alias("home"))
    of = tx.select("card_id", "merchant_id").join(home, "card_id").groupBy("merchant_id", "home").agg(F.count("*").alias("n"))
    of = of.withColumn("p", F.col("n") / F.sum("n").over(Window.partitionBy("merchant_id")))
    spread = of.groupBy("merchant_id").agg((-F.sum(F.col("p") * F.ln("p"))).alias("region_entropy"))
    order = Window.partitionBy("card_id").orderBy("timestamp", "merchant_id")
    prior = F.lag(F.struct("timestamp", "merchant_id", "longitude", "latitude")).over(order)
    steps = tx.select("card_id", "timestamp", "merchant_id", "longitude", "latitude").withColumn("before", prior).where("before IS NOT NULL")
    seconds = F.timestamp_diff("MICROSECOND", F.col("before.timestamp"), F.col("timestamp")) / 1e6
    d = haversine_m(F.col("before.longitude"), F.col("before.latitude"), F.col("longitude"), F.col("latitude"))
    bad = steps.where((seconds <= 60 * minutes) & (d > metres_per_second * seconds))
    hits = bad.select(F.explode(F.array("merchant_id", "before.merchant_id")).alias("merchant_id")).groupBy("merchant_id").agg(F.count("*").alias("hits"))
    base = tx.groupBy("merchant_id").agg(F.count("*").alias("n"), F.avg((F.hour("timestamp") < 6).cast("double")).alias("night_share"))
    out = base.join(spread, "merchant_id").join(hits, "merchant_id", "left")
    return out.select("merchant_id", "region_entropy", "night_share", (F.coalesce("hits", F.lit(0)) / F.col("n")).alias("impossible_share"))
