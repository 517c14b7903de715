"""Spatial joins on a grid of cubes, and what is built on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..errors import DataError
from ..functions.geo import cell, haversine_m
from ..functions.text import id_order
from .pairs import both_ways


def _celled(points: DataFrame, side_m: float, spread: bool) -> DataFrame:
    x, y, z = cell(F.col("longitude"), F.col("latitude"), side_m)
    if not spread:
        return points.withColumns({"_x": x, "_y": y, "_z": z})
    steps = [F.array(*(F.lit(d) for d in (-1, 0, 1)))] * 3
    out = points.withColumns({"_x": x, "_y": y, "_z": z})
    for c, s in zip(("_x", "_y", "_z"), steps, strict=True):
        out = out.withColumn("_d", F.explode(s)).withColumn(c, F.col(c) + F.col("_d")).drop("_d")
    return out


def nearby_pairs(points: DataFrame, radius_m: float) -> DataFrame:
    """l, r, distance_m of points (merchant_id, longitude, latitude) at most radius_m apart, l < r.

    Each point meets only those in its own cube and the 26 around it.
    """
    a = _celled(points, radius_m, False).toDF("l", "lon_a", "lat_a", "_x", "_y", "_z")
    b = _celled(points, radius_m, True).toDF("r", "lon_b", "lat_b", "_x", "_y", "_z")
    d = haversine_m(F.col("lon_a"), F.col("lat_a"), F.col("lon_b"), F.col("lat_b"))
    both = a.join(b, ["_x", "_y", "_z"]).where("l < r").withColumn("distance_m", d)
    return both.where(F.col("distance_m") <= radius_m).select("l", "r", "distance_m")


def nearest_member(candidates: DataFrame, members: DataFrame, radius_m: float) -> DataFrame:
    """candidate, community_id, member, distance_m: the nearest member within radius_m, ties by id then name.

    Both sides: merchant_id, longitude, latitude; members also community_id (text).
    """
    a = _celled(candidates.select("merchant_id", "longitude", "latitude"), radius_m, True).toDF("candidate", "lon_a", "lat_a", "_x", "_y", "_z")
    b = _celled(members.select("merchant_id", "longitude", "latitude", "community_id"), radius_m, False).toDF("member", "lon_b", "lat_b", "community_id", "_x", "_y", "_z")
    d = haversine_m(F.col("lon_a"), F.col("lat_a"), F.col("lon_b"), F.col("lat_b"))
    both = a.join(b, ["_x", "_y", "_z"]).withColumn("distance_m", d).where(F.col("distance_m") <= radius_m)
    best = F.min_by(F.struct("community_id", "member", "distance_m"), F.struct("distance_m", id_order(F.col("community_id")), "member"))
    return both.groupBy("candidate").agg(best.alias("b")).select("candidate", "b.*")


def suspect_online(edges: DataFrame, coords: DataFrame, min_neighbours: int, distance_m: float) -> DataFrame:
    """merchant_id of merchants without coordinates whose neighbours' coordinates lie further apart than distance_m.

    Only edges of positive weight count, and only merchants with min_neighbours placed ones.
    """
    near = both_ways(edges.where("weight > 0")).join(coords.select(F.col("merchant_id").alias("node")), "node", "left_anti")
    placed = near.join(coords.toDF("other", "lon", "lat"), "other")
    many = placed.groupBy("node").agg(F.count("*").alias("n")).where(F.col("n") >= min_neighbours)
    placed = placed.join(many, "node", "left_semi").select("other", "node", "lon", "lat")
    a, b = placed.toDF("oa", "node", "lon_a", "lat_a"), placed.toDF("ob", "node", "lon_b", "lat_b")
    far = haversine_m(F.col("lon_a"), F.col("lat_a"), F.col("lon_b"), F.col("lat_b")) > distance_m
    return a.join(b, "node").where((F.col("oa") < F.col("ob")) & far).select(F.col("node").alias("merchant_id")).distinct()


def with_seed_edges(edges: DataFrame, coords: DataFrame, radius_m: float) -> DataFrame:
    """edges with ten times the largest weight added between merchants at most radius_m apart (geo_seed 1)."""
    seeds = nearby_pairs(coords, radius_m).select("l", "r", F.lit(1).alias("geo_seed"))
    top = F.broadcast(edges.agg(F.coalesce(10 * F.max("weight"), F.lit(1.0)).alias("boost")))  # one row
    both = edges.join(seeds, ["l", "r"], "full_outer").join(top)
    w = F.coalesce("weight", F.lit(0.0)) + F.when(F.col("geo_seed") == 1, F.col("boost")).otherwise(0.0)
    return both.select("l", "r", w.alias("weight"), F.coalesce("support", F.lit(0)).alias("support"), F.coalesce("geo_seed", F.lit(0)).alias("geo_seed"))


def bounded_points(points: DataFrame, west: float, east: float, south: float, north: float, place: str = "place") -> DataFrame:
    """The first coordinate of each name inside a box, in the order of the column place (as read_places gives it).

    A box without any point is an error.
    """
    inside = points.where(F.col("longitude").between(west, east) & F.col("latitude").between(south, north))
    order = Window.partitionBy("merchant_id").orderBy(place)
    out = inside.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")
    if out.isEmpty():
        raise DataError(f"no coordinate lies in {west} to {east}, {south} to {north}")
    return out
