"""Merchant, business, target and community rows from a cleaned graph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import AnchorConfig
from ..functions.text import formatted_id, status_code
from . import community
from .validate import reject

ROW = ["city_code", "merchant_id", "primary_community_id", "community_id", "merchant_status", "is_anchor_candidate", "anchor_score", "pagerank", "participation", "weighted_degree", "community_share", "is_primary_community", "is_multi_community_member", "connected_community_count", "chain_visit_count_threshold", "is_chain_like", "chain_reason", "visit_count"]
TARGET = ["storename", "community_id", "previous_community_id", "region", "is_interfere", "update_time", "is_abnormal", "is_position", "dt"]


def anchor_count(size: Column, c: AnchorConfig) -> Column:
    scaled = F.ceil(size / c.merchants_per_anchor)
    return F.least(size, F.greatest(F.lit(c.min_count), F.least(scaled, F.lit(c.max_count))))


def anchors(rows: DataFrame, c: AnchorConfig) -> DataFrame:
    """merchant_id of each community's anchors.

    rows: merchant_id, community_id, participation, anchor_score, weighted_degree, visit_count.
    """
    sizes = rows.groupBy("community_id").agg(F.count("*").alias("_size")).where(F.col("_size") >= c.min_community)
    order = Window.partitionBy("community_id").orderBy(F.desc("anchor_score"), F.desc("weighted_degree"), F.desc("visit_count"), "merchant_id")
    ok = rows.where(F.col("participation") <= c.max_participation).withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= c.max_count + c.min_count)
    return ok.join(sizes, "community_id").where(F.col("_n") <= anchor_count(F.col("_size"), c)).select("merchant_id")


def expanded(rows: DataFrame, shares: DataFrame) -> DataFrame:
    """One row for each community that a merchant is linked with, its own included; only that one keeps anchor and score."""
    linked = shares.where("share > 0").select(F.col("node").alias("merchant_id"), F.col("community_id").alias("_c"), F.col("share").alias("community_share"))
    own = rows.select("merchant_id", F.col("community_id").alias("_c")).join(linked, ["merchant_id", "_c"], "left_anti").withColumn("community_share", F.lit(0.0))
    many = Window.partitionBy("merchant_id")
    out = rows.withColumnRenamed("community_id", "primary_community_id").join(linked.unionByName(own), "merchant_id")
    primary = (F.col("_c") == F.col("primary_community_id")).cast("int")
    return out.withColumns(
        {
            "is_multi_community_member": (F.count("*").over(many) > 1).cast("int"),
            "is_primary_community": primary,
            "is_anchor_candidate": F.col("is_anchor_candidate") * primary,
            "anchor_score": F.col("anchor_score") * primary,
        }
    ).withColumnRenamed("_c", "community_id")


def chain_rows(chains: DataFrame, shares: DataFrame, counts: DataFrame, city: str, threshold: int) -> DataFrame:
    """Rows of chain merchants (merchant_id, chain_reason) from the shares of all their candidate edges."""
    s = shares.select(F.col("node").alias("merchant_id"), "community_id", F.col("share").alias("community_share"))
    per = s.groupBy("merchant_id").agg(F.min_by("community_id", F.struct((-F.col("community_share")).alias("s"), "community_id")).alias("primary_community_id"), F.count("*").alias("connected_community_count"), (1 - F.sum(F.pow("community_share", F.lit(2.0)))).alias("participation"))
    out = chains.join(per, "merchant_id", "left").join(s, "merchant_id", "left").join(counts, "merchant_id", "left")
    none = F.coalesce("primary_community_id", F.lit(-1).cast("long"))
    return out.select(
        F.lit(city).alias("city_code"),
        "merchant_id",
        none.alias("primary_community_id"),
        F.coalesce("community_id", F.lit(-1).cast("long")).alias("community_id"),
        F.when(none >= 0, "active").otherwise("suspect_isolated").alias("merchant_status"),
        F.lit(0).alias("is_anchor_candidate"),
        F.lit(0.0).alias("anchor_score"),
        F.lit(0.0).alias("pagerank"),
        F.coalesce("participation", F.lit(0.0)).alias("participation"),
        F.lit(0.0).alias("weighted_degree"),
        F.coalesce("community_share", F.lit(0.0)).alias("community_share"),
        (F.coalesce("community_id", F.lit(-1)) == none).cast("int").alias("is_primary_community"),
        (F.coalesce("connected_community_count", F.lit(0)) > 1).cast("int").alias("is_multi_community_member"),
        F.coalesce("connected_community_count", F.lit(0)).cast("long").alias("connected_community_count"),
        F.lit(threshold).cast("long").alias("chain_visit_count_threshold"),
        F.lit(1).alias("is_chain_like"),
        "chain_reason",
        F.coalesce("visits", F.lit(0)).cast("long").alias("visit_count"),
    )


def merchant_results(statuses: DataFrame, edges: DataFrame, partition: DataFrame, counts: DataFrame, candidate_shares: DataFrame, chains: DataFrame, threshold: int, config: AnchorConfig, city: str, expand: bool = True) -> DataFrame:
    """All merchant rows: clustered ones (with anchors, one row a linked community), chains, and removed online ones."""
    ids = partition.join(chains.select(F.col("merchant_id").alias("node")), "node", "left_anti")
    shares = community.shares(edges, partition)
    part = community.participation(shares)
    linked = shares.where("share > 0").groupBy("node").agg(F.count("*").alias("connected_community_count"))
    base = ids.join(community.pageranks(edges, ids), "node").join(part, "node", "left").join(community.weighted_degrees(edges).drop("degree"), "node", "left").join(statuses, "node").join(linked, "node", "left")
    base = base.join(counts.withColumnRenamed("merchant_id", "node"), "node", "left")
    p = F.coalesce("participation", F.lit(0.0))
    base = base.select(
        F.lit(city).alias("city_code"),
        F.col("node").alias("merchant_id"),
        "community_id",
        F.col("status").alias("merchant_status"),
        (F.col("pagerank") * (1 - p)).alias("anchor_score"),
        "pagerank",
        p.alias("participation"),
        F.coalesce("weighted_degree", F.lit(0.0)).alias("weighted_degree"),
        F.coalesce("connected_community_count", F.lit(0)).cast("long").alias("connected_community_count"),
        F.lit(threshold).cast("long").alias("chain_visit_count_threshold"),
        F.lit(0).alias("is_chain_like"),
        F.lit("").alias("chain_reason"),
        F.coalesce("visits", F.lit(0)).cast("long").alias("visit_count"),
    )
    base = community.shared_table(base, "merchants")
    picked = anchors(base, config).withColumn("_a", F.lit(1))
    base = base.join(picked, "merchant_id", "left").withColumn("is_anchor_candidate", F.coalesce("_a", F.lit(0))).drop("_a")
    if expand:
        rows = expanded(base, shares)
    else:
        own = shares.select(F.col("node").alias("merchant_id"), "community_id", F.col("share").alias("community_share"))
        rows = base.join(own, ["merchant_id", "community_id"], "left").withColumns({"community_share": F.coalesce("community_share", F.lit(0.0)), "primary_community_id": F.col("community_id"), "is_primary_community": F.lit(1), "is_multi_community_member": F.lit(0)})
    gone = statuses.where("status = 'suspect_online'").join(chains.select(F.col("merchant_id").alias("node")), "node", "left_anti").join(counts.withColumnRenamed("merchant_id", "node"), "node", "left")
    zero, none = F.lit(0.0), F.lit(-1).cast("long")
    fixed = {"primary_community_id": none, "community_id": none, "is_anchor_candidate": F.lit(0), "is_primary_community": F.lit(0), "is_multi_community_member": F.lit(0), "connected_community_count": F.lit(0).cast("long"), "chain_visit_count_threshold": F.lit(threshold).cast("long"), "is_chain_like": F.lit(0), "chain_reason": F.lit(""), "city_code": F.lit(city), **dict.fromkeys(("anchor_score", "pagerank", "participation", "weighted_degree", "community_share"), zero)}
    gone = gone.select(F.col("node").alias("merchant_id"), F.col("status").alias("merchant_status"), F.coalesce("visits", F.lit(0)).cast("long").alias("visit_count")).withColumns(fixed)
    return rows.select(ROW).unionByName(chain_rows(chains, candidate_shares, counts, city, threshold).select(ROW)).unionByName(gone.select(ROW))


def of_size(merchants: DataFrame, least: int) -> DataFrame:
    """Rows of communities with at least so many rows."""
    sizes = merchants.where("community_id >= 0").groupBy("community_id").agg(F.count("*").alias("_n")).where(F.col("_n") >= least)
    return merchants.join(sizes.select("community_id"), "community_id", "left_semi").select(merchants.columns)


def business_rows(merchants: DataFrame, metadata: DataFrame, update_time: str, least: int) -> DataFrame:
    """One row a merchant of the metadata and membership; communities below least rows, and isolated merchants, have none."""
    valid = merchants.where("community_id >= 0").groupBy("community_id").agg(F.count("*").alias("_n")).where(F.col("_n") >= least).select("community_id", F.lit(True).alias("_ok"))
    rows = metadata.join(merchants.drop("city_code", "visit_count"), "merchant_id", "left").join(valid, "community_id", "left")
    rows = rows.join(valid.toDF("primary_community_id", "_primary_ok"), "primary_community_id", "left")
    online = F.col("merchant_status") == "suspect_online"
    has = F.coalesce(F.col("_ok") & (F.col("merchant_status") != "suspect_isolated") & ~online, F.lit(False))
    chain = (F.coalesce("is_chain_like", F.lit(0)) == 1) & (F.coalesce("chain_reason", F.lit("")) != "merchant_category")
    status = F.when(F.coalesce(online, F.lit(False)), "suspect_online").when(has & chain, "suspect_chain_store").when(has, "normal").otherwise("suspect_isolated")
    only = lambda c, kind: F.when(has, F.coalesce(c, F.lit(0))).otherwise(0).cast(kind).alias(c)
    plain = lambda c, kind: F.coalesce(c, F.lit(0)).cast(kind).alias(c)
    return rows.select(
        F.col("merchant_id").alias("storename"),
        F.when(has & F.col("_primary_ok"), F.col("primary_community_id").cast("string")).otherwise("").alias("primary_community_id"),
        F.when(has, F.col("community_id").cast("string")).otherwise("").alias("community_id"),
        F.lit("").alias("previous_community_id"),
        "region",
        F.lit("N").alias("is_interfere"),
        F.lit(update_time).alias("update_time"),
        status.alias("status"),
        F.when(has, F.coalesce("is_anchor_candidate", F.lit(0))).otherwise(0).alias("is_position"),
        only("community_share", "double"),
        only("is_primary_community", "int"),
        only("is_multi_community_member", "int"),
        plain("is_chain_like", "int"),
        F.coalesce("chain_reason", F.lit("")).alias("chain_reason"),
        plain("chain_visit_count_threshold", "long"),
        plain("connected_community_count", "long"),
        "dt",
    )


def target_rows(business: DataFrame, dt: str, least: int) -> DataFrame:
    """The nine columns of the result table: ids as text, status codes, communities below least distinct stores cleared."""
    rows = business.withColumn("community_id", formatted_id(F.col("community_id")))
    sizes = rows.where("community_id <> ''").groupBy("community_id").agg(F.count_distinct("storename").alias("_n")).where(F.col("_n") >= least).select("community_id", F.lit(True).alias("_ok"))
    code = status_code(F.col("status"))
    reject(rows, code.isNull(), ["storename", "status"], "status")
    rows = rows.join(sizes, "community_id", "left")
    ok = F.coalesce("_ok", F.lit(False))
    kept = F.when(ok, F.col("community_id")).otherwise("")
    lost = (F.col("community_id") != "") & ~ok
    return rows.select("storename", kept.alias("community_id"), formatted_id(F.col("previous_community_id")).alias("previous_community_id"), "region", "is_interfere", "update_time", F.when(lost, "3").otherwise(code).alias("is_abnormal"), F.when(ok, F.col("is_position")).otherwise(0).alias("is_position"), F.lit(dt).alias("dt"))


def hourly_profiles(members: DataFrame, visits: DataFrame) -> DataFrame:
    """community_id, peak_hour (the first of the busiest), hourly_consistency (mean cosine of members with the community)."""
    m = members.select("community_id", "merchant_id").distinct()
    cells = m.join(visits, "merchant_id").groupBy("community_id", "merchant_id", F.hour("timestamp").alias("hour")).agg(F.count("*").cast("double").alias("n"))
    profile = cells.groupBy("community_id", "hour").agg(F.sum("n").alias("total"))
    top = profile.groupBy("community_id").agg(F.max_by("hour", F.struct("total", (-F.col("hour")).alias("h"))).alias("peak_hour"), F.sqrt(F.sum(F.col("total") * F.col("total"))).alias("norm"))
    dots = cells.join(profile, ["community_id", "hour"]).groupBy("community_id", "merchant_id").agg(F.sum(F.col("n") * F.col("total")).alias("dot"), F.sqrt(F.sum(F.col("n") * F.col("n"))).alias("own"))
    mean = dots.join(top, "community_id").groupBy("community_id").agg(F.avg(F.col("dot") / (F.col("own") * F.col("norm"))).alias("hourly_consistency"))
    return top.select("community_id", "peak_hour").join(mean, "community_id")


def community_rows(merchants: DataFrame, visits: DataFrame | None, city: str) -> DataFrame:
    """Size, anchors (joined by |, in result order) and, with visits, the hourly profile of each community."""
    active = merchants.where("community_id >= 0")
    marks = F.when(F.col("is_anchor_candidate") == 1, F.struct("merchant_status", (-F.col("anchor_score")).alias("s"), "merchant_id"))
    out = active.groupBy("community_id").agg(F.count("*").alias("merchant_count"), F.sum("is_anchor_candidate").cast("long").alias("anchor_count"), F.array_sort(F.collect_list(marks)).alias("_a"))  # at most max_count anchors
    out = out.select(F.lit(city).alias("city_code"), "community_id", "merchant_count", "anchor_count", F.array_join(F.transform("_a", lambda a: a["merchant_id"]), "|").alias("anchor_merchants"))
    if visits is None:
        return out
    prof = hourly_profiles(active, visits)
    return out.join(prof, "community_id", "left").withColumns({"peak_hour": F.coalesce("peak_hour", F.lit(0)), "hourly_consistency": F.coalesce("hourly_consistency", F.lit(0.0))})
