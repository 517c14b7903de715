"""The older geographic clustering: centres, merging, trimming, risk, incremental updates."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import haversine_m
from ..functions.text import id_order
from ..sources.tables import shared_table
from . import kernels
from .community import component_labels, detect, numbered, renumbered
from .pairs import both_ways

LEGACY_EARTH_M = 6371000.0


def centres(partition: DataFrame, coords: DataFrame) -> DataFrame:
    """community_id, longitude, latitude (means), members with coordinates."""
    placed = partition.join(coords.withColumnRenamed("merchant_id", "node"), "node")
    return placed.groupBy("community_id").agg(F.avg("longitude").alias("longitude"), F.avg("latitude").alias("latitude"), F.count("*").alias("placed"))


def centre_text(lon: str = "longitude", lat: str = "latitude"):
    return F.format_string("%.6f,%.6f", F.col(lon), F.col(lat))


def trimmed(placed: DataFrame, most_m: float = 2500.0) -> DataFrame:
    """community_id, node, longitude, latitude of the members that stay when the farthest go until all are near the centre."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node", ignore_index=True)
        return pdf[kernels.trimmed(pdf["longitude"].to_numpy(), pdf["latitude"].to_numpy(), most_m)]

    return placed.select("community_id", "node", "longitude", "latitude").groupBy("community_id").applyInPandas(run, "community_id long, node string, longitude double, latitude double")


def merged_centres(points: DataFrame, threshold_m: float = 1500.0, linkage: str = "average", cell_degrees: float = 0.5) -> DataFrame:
    """community_id, geo_cluster: centres merged while clusters are closer than threshold_m.

    Centres are first split into groups that no chain of near cells connects, so that one
    task holds one region, not the whole country.
    """
    cells = points.select("community_id", "longitude", "latitude", F.floor(F.col("longitude") / cell_degrees).alias("cx"), F.floor(F.col("latitude") / cell_degrees).alias("cy"))
    name = lambda x, y: F.concat_ws(":", x, y)
    used = cells.select("cx", "cy").distinct()
    steps = F.explode(F.sequence(F.lit(-1), F.lit(1)))
    around = used.withColumn("dx", steps).withColumn("dy", F.explode(F.sequence(F.lit(-1), F.lit(1))))
    near = around.select(name("cx", "cy").alias("a"), name(F.col("cx") + F.col("dx"), F.col("cy") + F.col("dy")).alias("b")).where("a < b").join(used.select(name("cx", "cy").alias("b")), "b")
    regions = component_labels(used.select(name("cx", "cy").alias("node")), near.select(F.col("a").alias("l"), F.col("b").alias("r")))
    tagged = cells.withColumn("node", name("cx", "cy")).join(regions, "node")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("community_id", ignore_index=True)
        label = kernels.agglomerative(kernels.distances(pdf["longitude"].to_numpy(), pdf["latitude"].to_numpy(), LEGACY_EARTH_M), threshold_m, linkage)
        low = pdf.groupby(label)["community_id"].transform("min")
        return pd.DataFrame({"community_id": pdf["community_id"], "geo_cluster": low.astype("int64")})

    return tagged.select("component", "community_id", "longitude", "latitude").groupBy("component").applyInPandas(lambda pdf: run(pdf), "community_id long, geo_cluster long")


def inside_clusters(edges: DataFrame, clusters: DataFrame, least: int = 8) -> DataFrame:
    """node, community_id: communities inside each geo cluster (node, geo_cluster); small clusters are one."""
    c = clusters.select("node", "geo_cluster")
    inner = edges.join(c.toDF("l", "gl"), "l").join(c.toDF("r", "gr"), "r").where("gl = gr").select("l", "r", "weight")
    found = detect(c.select("node"), inner, 1.0, refine=False)
    sizes = c.groupBy("geo_cluster").agg(F.count("*").alias("n"))
    whole = c.join(sizes, "geo_cluster").join(found, "node")
    return renumbered(whole.select("node", F.when(F.col("n") < least, F.concat(F.lit("g"), "geo_cluster")).otherwise(F.concat_ws(":", "geo_cluster", "community_id")).alias("grp")), "grp")


def ungeo_assignment(edges: DataFrame, partition: DataFrame, unplaced: DataFrame, min_second: float = 0.2, max_gap: float = 0.15, max_first: float = 0.65) -> DataFrame:
    """node, community_id, p1, p2, risky: linked weight by community, normalised; risky where two are close."""
    near = both_ways(edges, "weight").join(unplaced.select("node"), "node", "left_semi").join(partition.select(F.col("node").alias("other"), "community_id"), "other")
    w = near.groupBy("node", "community_id").agg(F.sum("weight").alias("w"))
    total = Window.partitionBy("node")
    p = w.withColumn("p", F.col("w") / F.sum("w").over(total)).withColumn("n", F.row_number().over(total.orderBy(F.desc("p"), "community_id")))
    out = p.where("n <= 2").groupBy("node").agg(F.max(F.when(F.col("n") == 1, F.col("community_id"))).alias("community_id"), F.max(F.when(F.col("n") == 1, F.col("p"))).alias("p1"), F.coalesce(F.max(F.when(F.col("n") == 2, F.col("p"))), F.lit(0.0)).alias("p2"))
    return out.withColumn("risky", (F.col("p2") >= min_second) & (F.col("p1") - F.col("p2") <= max_gap) & (F.col("p1") <= max_first))


def position_flags(edges: DataFrame, partition: DataFrame, top: int = 5, without: DataFrame | None = None) -> DataFrame:
    """node, community_id of each community's top members by weight inside it (of those not in without)."""
    p = partition.select("node", "community_id")
    inner = edges.join(p.toDF("l", "cl"), "l").join(p.toDF("r", "cr"), "r").where("cl = cr")
    w = both_ways(inner, "weight").groupBy("node").agg(F.sum("weight").alias("w"))
    rows = p.join(w, "node", "left").withColumn("w", F.coalesce("w", F.lit(0.0)))
    if without is not None:
        rows = rows.join(without.select("node"), "node", "left_anti")
    order = Window.partitionBy("community_id").orderBy(F.desc("w"), "node")
    return rows.withColumn("n", F.row_number().over(order)).where(F.col("n") <= top).select("node", "community_id")


def community_stats(edges: DataFrame, partition: DataFrame, transactions: DataFrame) -> DataFrame:
    """community_id, merchants, edges, weight, density, transactions (merchant_id, transactions)."""
    p = partition.select("node", "community_id")
    size = p.groupBy("community_id").agg(F.count("*").alias("merchants"))
    inner = edges.join(p.toDF("l", "cl"), "l").join(p.toDF("r", "cr"), "r").where("cl = cr").groupBy(F.col("cl").alias("community_id")).agg(F.count("*").alias("edges"), F.sum("weight").alias("weight"))
    tx = transactions.withColumnRenamed("merchant_id", "node").join(p, "node").groupBy("community_id").agg(F.sum("transactions").alias("transactions"))
    out = size.join(inner, "community_id", "left").join(tx, "community_id", "left").na.fill(0, ["edges", "weight", "transactions"])
    n = F.col("merchants")
    return out.withColumn("density", F.when(n > 1, 2 * F.col("edges") / (n * (n - 1))).otherwise(0.0))


def isolated_communities(edges: DataFrame, partition: DataFrame, max_edges: int = 1, max_weight: float = 2.0) -> DataFrame:
    """node of communities with hardly any inner edge or weight and no edge to others."""
    p = partition.select("node", "community_id")
    e = edges.join(p.toDF("l", "cl"), "l").join(p.toDF("r", "cr"), "r")
    inner = e.where("cl = cr").groupBy(F.col("cl").alias("community_id")).agg(F.count("*").alias("n"), F.sum("weight").alias("w"))
    cross = e.where("cl <> cr").select(F.explode(F.array("cl", "cr")).alias("community_id")).distinct()
    out = p.join(cross, "community_id", "left_anti").join(inner, "community_id", "left").na.fill(0, ["n", "w"])
    return out.where((F.col("n") <= max_edges) | (F.col("w") <= max_weight)).select("node")


def inactive(tx: DataFrame, days: int = 30) -> DataFrame:
    """merchant_id whose last transaction is more than days before the last of all."""
    last = tx.groupBy("merchant_id").agg(F.max("timestamp").alias("last"))
    top = F.broadcast(last.agg(F.max("last").alias("top")))  # one row
    return last.join(top).where(F.timestamp_diff("SECOND", F.col("last"), F.col("top")) > days * 86400).select("merchant_id")


def linked_far_clusters(edges: DataFrame, placed: DataFrame, centre: DataFrame, unplaced: DataFrame, distance_m: float = 2000.0) -> DataFrame:
    """node of unplaced merchants linked with two clusters whose centres lie further apart than distance_m."""
    near = both_ways(edges).join(unplaced.select("node"), "node", "left_semi").join(placed.select(F.col("node").alias("other"), "community_id"), "other").select("node", "community_id").distinct()
    at = near.join(centre.select("community_id", "longitude", "latitude"), "community_id")
    a, b = at.toDF("ca", "node", "lon_a", "lat_a"), at.toDF("cb", "node", "lon_b", "lat_b")
    d = haversine_m(F.col("lon_a"), F.col("lat_a"), F.col("lon_b"), F.col("lat_b"), LEGACY_EARTH_M)
    return a.join(b, "node").where((F.col("ca") < F.col("cb")) & (d > distance_m)).select("node").distinct()


def local_update(nodes: DataFrame, edges: DataFrame, partition: DataFrame, touched: DataFrame, hops: int = 1, resolution: float = 0.5) -> DataFrame:
    """node, community_id: communities found anew around touched nodes, all others of the graph as they are.

    A new group takes the old id with the most edge weight to it, then the most members in it,
    then the smaller text. Groups choose in the order of those two figures of their favourite,
    then of their size (largest first), then of their smallest node; each id goes once, and
    groups left without one are numbered on from the largest old id.
    """
    nodes = nodes.select("node")
    area = touched.select("node").join(nodes, "node", "left_semi").distinct()
    for _ in range(hops):
        area = both_ways(edges).join(area, "node", "left_semi").select(F.col("other").alias("node")).unionByName(area).distinct()
    area = shared_table(area, "area")
    inner = edges.join(area.toDF("l"), "l", "left_semi").join(area.toDF("r"), "r", "left_semi")
    fresh = detect(area, inner, resolution, refine=False).withColumnRenamed("community_id", "new_id")
    old = partition.select("node", "community_id")
    members = fresh.join(old, "node").groupBy("new_id", "community_id").agg(F.count("*").alias("members"))
    tied = both_ways(edges, "weight").join(fresh, "node").join(old.toDF("other", "community_id"), "other")
    tied = tied.groupBy("new_id", "community_id").agg(F.round(F.sum("weight"), 9).alias("tied"))
    wishes = members.join(tied, ["new_id", "community_id"], "full_outer").na.fill(0, ["members", "tied"])
    order = Window.partitionBy("new_id").orderBy(F.desc("tied"), F.desc("members"), F.col("community_id").cast("string"))
    wishes = shared_table(wishes.withColumn("wish", F.row_number().over(order)), "wishes")
    first = wishes.where("wish = 1").select("new_id", "tied", "members")
    groups = fresh.groupBy("new_id").agg(F.count("*").alias("size"), F.min("node").alias("low")).join(first, "new_id", "left").na.fill(0, ["members", "tied"])
    groups = shared_table(groups.select("new_id", F.struct((-F.col("tied")).alias("t"), (-F.col("members")).alias("m"), (-F.col("size")).alias("s"), "low").alias("turn")), "groups")
    at = groups.select("new_id", "turn", F.lit(1).alias("wish"))
    while True:  # every group asks for its next wish; an id stays with the asker whose turn is first
        asked = at.join(wishes.select("new_id", "wish", "community_id"), ["new_id", "wish"])
        held = asked.groupBy("community_id").agg(F.min_by("new_id", "turn").alias("holder"))
        asked = shared_table(asked.join(held, "community_id"), "asked")
        if asked.where("new_id <> holder").isEmpty():
            break
        lost = asked.where("new_id <> holder").select("new_id", F.lit(1).alias("next"))
        at = shared_table(at.join(lost, "new_id", "left").select("new_id", "turn", (F.col("wish") + F.coalesce("next", F.lit(0))).alias("wish")), "at")
    top = partition.agg(F.max("community_id")).first()[0] or 0
    rest = numbered(groups.join(asked, "new_id", "left_anti"), [F.asc("turn")], "n").select("new_id", (F.col("n") + F.lit(top) + 1).alias("community_id"))
    named = fresh.join(asked.select("new_id", "community_id").unionByName(rest), "new_id").select("node", "community_id")
    return old.join(nodes, "node", "left_semi").join(area, "node", "left_anti").unionByName(named)


def component_cluster(edges: DataFrame, components: DataFrame, clusters: DataFrame) -> DataFrame:
    """component, cluster_id with the strongest links: weight, then edges, linked members, and smallest id."""
    near = both_ways(edges, "weight").join(components.select("node", "component"), "node").join(clusters.select(F.col("node").alias("other"), "cluster_id"), "other")
    score = near.groupBy("component", "cluster_id").agg(F.sum("weight").alias("w"), F.count("*").alias("e"), F.count_distinct("node").alias("m"))
    best = F.min_by("cluster_id", F.struct((-F.col("w")).alias("w"), (-F.col("e")).alias("e"), (-F.col("m")).alias("m"), id_order(F.col("cluster_id").cast("string"))))
    return score.groupBy("component").agg(best.alias("cluster_id"))


def status_cascade(rows: DataFrame) -> DataFrame:
    """rows with abnormal: a status that came in, then inactive, online, isolated, normal."""
    given = F.when(~F.coalesce("input_status", F.lit("")).isin("", "1"), F.col("input_status"))
    return rows.withColumn("abnormal", F.coalesce(given, F.when(F.col("inactive"), "6"), F.when(F.col("online"), "2"), F.when(F.col("isolated"), "3"), F.lit("1")))



def top_communities(assignment: DataFrame) -> DataFrame:
    """geo_cluster, community_id: the community most members of the cluster have, ties to the smaller id; null ids don't count."""
    n = assignment.where("community_id IS NOT NULL").groupBy("geo_cluster", "community_id").agg(F.count("*").alias("n"))
    return n.groupBy("geo_cluster").agg(F.min_by("community_id", F.struct(-F.col("n"), F.col("community_id"))).alias("community_id"))


def ranked_clusters(stats: DataFrame, least: int = 3) -> DataFrame:
    """community_id, geo_cluster: 1, 2, ... by weight, edges and merchants, largest first, then id; clusters of fewer than least merchants go."""
    order = [F.desc("weight"), F.desc("edges"), F.desc("merchants"), F.asc("community_id")]
    ranked = numbered(stats.where(F.col("merchants") >= least), order, "_number")
    return ranked.select("community_id", (F.col("_number") + 1).alias("geo_cluster"))


def reclustered(partition: DataFrame, coords: DataFrame, edges: DataFrame, transactions: DataFrame, merge_m: float = 1500.0, most_m: float = 2500.0, least: int = 3) -> DataFrame:
    """node, geo_cluster: communities trimmed to places near their centre, near centres merged, trimmed again and numbered."""
    placed = partition.join(coords.withColumnRenamed("merchant_id", "node"), "node")
    first = shared_table(trimmed(placed, most_m), "trimmed")
    merged = merged_centres(centres(first.select("node", "community_id"), coords), merge_m)
    joined = first.join(merged, "community_id").select("node", "longitude", "latitude", F.col("geo_cluster").alias("community_id"))
    kept = shared_table(trimmed(joined, most_m), "clusters").select("node", "community_id")
    return kept.join(ranked_clusters(community_stats(edges, kept, transactions), least), "community_id").select("node", "geo_cluster")
