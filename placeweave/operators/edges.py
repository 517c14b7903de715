"""Edge weights and sparse graphs from pair statistics."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import GraphConfig
from ..errors import ConfigError
from .pairs import both_ways


def marginals(pairs: DataFrame) -> DataFrame:
    """node and the summed strength of its pairs."""
    return both_ways(pairs, "strength").groupBy("node").agg(F.sum("strength").alias("marginal"))


def totals(margins: DataFrame, smoothing: float) -> DataFrame:
    """One row: total strength, and half the sum of smoothed marginals."""
    return margins.agg((F.sum("marginal") / 2).alias("total"), (F.sum(F.pow("marginal", F.lit(smoothing))) / 2).alias("smoothed"))


def sppmi_metrics(pairs: DataFrame, smoothing: float = 0.75, shift: float = 3.0) -> DataFrame:
    """l, r, strength, support, sppmi, z of every pair.

    The mean of the two directions' smoothed PMI is ln s + ln S - (1 + a)/2 (ln m_l + ln m_r),
    with S the smoothed total; less ln shift and at least 0. z compares s with what the
    marginals let expect.
    """
    m = marginals(pairs)
    t = F.broadcast(totals(m, smoothing))  # one row
    rows = pairs.join(m.toDF("l", "m_l"), "l").join(m.toDF("r", "m_r"), "r").join(t)
    pmi = F.log("strength") + F.log("smoothed") - (1 + smoothing) / 2 * (F.log("m_l") + F.log("m_r"))
    expected = F.col("m_l") * F.col("m_r") / F.col("total")
    return rows.select("l", "r", "strength", "support", F.greatest(pmi - math.log(shift), F.lit(0.0)).alias("sppmi"), ((F.col("strength") - expected) / F.sqrt(expected)).alias("z_score"))


def candidates(pairs: DataFrame, config: GraphConfig = GraphConfig(), min_support: int = 1) -> DataFrame:
    """l, r, weight, z_score, support of the pairs that may become edges."""
    kept = pairs.where(F.col("support") >= min_support)
    if config.method == "transaction_count":
        return kept.select("l", "r", F.col("strength").alias("weight"), F.lit(None).cast("double").alias("z_score"), "support")
    if config.method == "sppmi":
        m = sppmi_metrics(kept, config.smoothing, config.shift)
        return m.where((F.col("sppmi") > 0) & (F.col("z_score") >= config.min_z)).select("l", "r", F.col("sppmi").alias("weight"), "z_score", "support")
    raise ConfigError(f"unknown edge method {config.method!r}")


def degrees(edges: DataFrame) -> DataFrame:
    return both_ways(edges).groupBy("node").agg(F.count("*").alias("degree"))


def jaccard(edges: DataFrame) -> DataFrame:
    """edges with the Jaccard of their ends' neighbours: common ones by a join through the shared neighbour."""
    near = both_ways(edges)
    common = edges.select("l", "r").join(near.toDF("l", "x"), "l").join(near.toDF("r", "x"), ["r", "x"]).groupBy("l", "r").agg(F.count("*").alias("common"))
    d = degrees(edges)
    out = edges.join(common, ["l", "r"], "left").join(d.toDF("l", "d_l"), "l").join(d.toDF("r", "d_r"), "r")
    n = F.coalesce("common", F.lit(0))
    return out.select(*edges.columns, (n / (F.col("d_l") + F.col("d_r") - n)).alias("jaccard"))


def degree_penalised(edges: DataFrame, gamma: float) -> DataFrame:
    """Weights divided by (degree * degree) ^ gamma."""
    d = degrees(edges)
    out = edges.join(d.toDF("l", "d_l"), "l").join(d.toDF("r", "d_r"), "r")
    return out.withColumn("weight", F.col("weight") / F.pow(F.col("d_l") * F.col("d_r"), F.lit(gamma))).select(edges.columns)


def prepared(edges: DataFrame, gamma: float, min_jaccard: float) -> DataFrame:
    """Degree penalty, then edges of enough neighbourhood overlap (both over the candidates' own degrees)."""
    j = jaccard(edges)
    out = degree_penalised(j, gamma) if gamma else j
    return out.where(F.col("jaccard") >= min_jaccard) if min_jaccard > 0 else out


def top_neighbours(edges: DataFrame, k: int) -> DataFrame:
    """node, other: each node's k best by weight, support, then name."""
    order = Window.partitionBy("node").orderBy(F.desc("weight"), F.desc("support"), "other")
    return both_ways(edges, "weight", "support").withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= k).select("node", "other")


def mutual_top_k(edges: DataFrame, k: int) -> DataFrame:
    """Edges that are among the k best of both their ends."""
    top = top_neighbours(edges, k)
    return edges.join(top.toDF("l", "r"), ["l", "r"], "left_semi").join(top.toDF("r", "l"), ["l", "r"], "left_semi")


def from_edge_list(edges: DataFrame) -> DataFrame:
    """l < r; blank ends and self edges go; repeated edges add up."""
    ok = edges.where((F.trim("l") != "") & (F.trim("r") != "") & (F.col("l") != F.col("r")))
    return ok.select(F.least("l", "r").alias("l"), F.greatest("l", "r").alias("r"), "weight").groupBy("l", "r").agg(F.sum("weight").alias("weight"))


def without_nodes(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges with neither end among nodes (column node)."""
    return edges.join(nodes.select(F.col("node").alias("l")), "l", "left_anti").join(nodes.select(F.col("node").alias("r")), "r", "left_anti").select(edges.columns)


def within_nodes(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    return edges.join(nodes.select(F.col("node").alias("l")), "l", "left_semi").join(nodes.select(F.col("node").alias("r")), "r", "left_semi").select(edges.columns)


def chain_threshold(counts: DataFrame, quantile: float, least: int) -> int:
    """Nearest-rank quantile of visit counts, at least so much; without counts, that."""
    q = counts.agg(F.expr(f"percentile_disc({quantile}) WITHIN GROUP (ORDER BY visits)")).first()[0]
    return max(int(q or 0), least)


def chain_merchants(counts: DataFrame, metadata: DataFrame, threshold: int) -> DataFrame:
    """merchant_id, chain_reason: category 2 first, else visits at the threshold or more."""
    by_category = metadata.where("merchant_category = 2").select("merchant_id", F.lit("merchant_category").alias("chain_reason"))
    by_visits = counts.where(F.col("visits") >= threshold).select("merchant_id", F.lit("visit_count").alias("chain_reason"))
    return by_category.unionByName(by_visits).groupBy("merchant_id").agg(F.min("chain_reason").alias("chain_reason"))
