"""Assigning merchants to existing communities, and merging result blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..errors import DataError
from ..functions.text import clean, id_order, normal_status
from . import clean as cleaning
from . import geo
from .pairs import both_ways
from .results import TARGET
from .validate import reject


def candidates(tx: DataFrame, existing: DataFrame, dt: str) -> DataFrame:
    """merchant_id, region, merchant_category, dt of merchants without a community, from their latest transaction."""
    order = Window.partitionBy("merchant_id").orderBy(F.desc("timestamp"), F.desc("region"), F.desc("global_flow_number"))
    last = tx.withColumn("_n", F.row_number().over(order)).where("_n = 1")
    return last.join(existing.select("merchant_id"), "merchant_id", "left_anti").select("merchant_id", "region", "merchant_category", F.lit(dt).alias("dt"))


def strongest_edge(edges: DataFrame, members: DataFrame, wanted: DataFrame) -> DataFrame:
    """merchant_id, community_id of its strongest edge into any member; ties by id, then member. Edges are not added up."""
    near = both_ways(edges, "weight").join(members.select(F.col("merchant_id").alias("other"), "community_id"), "other").join(wanted.select(F.col("merchant_id").alias("node")), "node", "left_semi")
    best = F.min_by("community_id", F.struct((-F.col("weight")).alias("w"), id_order(F.col("community_id")), "other"))
    return near.groupBy(F.col("node").alias("merchant_id")).agg(best.alias("community_id"))


def assigned(cands: DataFrame, coords: DataFrame, members: DataFrame, edges: DataFrame, radius_m: float) -> DataFrame:
    """Every candidate with community_id ('' for none): those with coordinates by distance only, others by edge only."""
    placed = cands.join(coords, "merchant_id").select("merchant_id", "longitude", "latitude")
    by_place = geo.nearest_member(placed, members.join(coords, "merchant_id"), radius_m).select(F.col("candidate").alias("merchant_id"), "community_id")
    loose = cands.join(placed, "merchant_id", "left_anti")
    found = by_place.unionByName(strongest_edge(edges, members, loose))
    return cands.join(found, "merchant_id", "left").withColumn("community_id", F.coalesce("community_id", F.lit("")))


def assigned_rows(rows: DataFrame, update_time: str) -> DataFrame:
    """Target rows of assigned candidates: code 1 with a community, 3 without."""
    has = F.col("community_id") != ""
    return rows.select(F.col("merchant_id").alias("storename"), "community_id", F.lit("").alias("previous_community_id"), "region", F.lit("N").alias("is_interfere"), F.lit(update_time).alias("update_time"), F.when(has, "1").otherwise("3").alias("is_abnormal"), F.lit(0).alias("is_position"), "dt")


def existing_rows(tx: DataFrame, existing: DataFrame, update_time: str, dt: str) -> DataFrame:
    """Target rows of merchants that have a community: it stays, with the latest region."""
    order = Window.partitionBy("merchant_id").orderBy(F.desc("timestamp"), F.desc("region"), F.desc("global_flow_number"))
    last = tx.withColumn("_n", F.row_number().over(order)).where("_n = 1").select("merchant_id", "region")
    return last.join(existing, "merchant_id").select(F.col("merchant_id").alias("storename"), "community_id", F.lit("").alias("previous_community_id"), "region", F.lit("N").alias("is_interfere"), F.lit(update_time).alias("update_time"), F.lit("1").alias("is_abnormal"), F.lit(0).alias("is_position"), F.lit(dt).alias("dt"))


def excluded_rows(tx: DataFrame, update_time: str, dt: str) -> DataFrame:
    """Target rows of merchants whose latest transaction has an excluded status: it passes through."""
    order = Window.partitionBy("merchant_id").orderBy(F.desc("timestamp"), F.desc("region"), F.desc("global_flow_number"))
    last = tx.withColumn("_n", F.row_number().over(order)).where("_n = 1").withColumn("is_abnormal", normal_status(F.col("is_abnormal")))
    last = last.where(F.col("is_abnormal").isin(*cleaning.EXCLUDED_STATUSES))
    return last.select(F.col("merchant_id").alias("storename"), clean(F.col("business_district")).alias("community_id"), F.lit("").alias("previous_community_id"), "region", F.lit("N").alias("is_interfere"), F.lit(update_time).alias("update_time"), "is_abnormal", F.lit(0).alias("is_position"), F.lit(dt).alias("dt"))


def overlay(target: DataFrame, rows: DataFrame) -> DataFrame:
    """rows replace all of target that has their store names."""
    return target.join(rows.select("storename").distinct(), "storename", "left_anti").select(TARGET).unionByName(rows.select(TARGET))


def cross_region_rows(cross: DataFrame, included: DataFrame, update_time: str, dt: str) -> DataFrame:
    """Target rows, code 5, of cross-region stores of category 1 and 2 that are not included otherwise; the last row of a store."""
    mine = cleaning.keep_categories(cross, "cross-region") if not cross.isEmpty() else cross
    mine = mine.join(included.select("storename").distinct(), "storename", "left_anti")
    order = Window.partitionBy("storename").orderBy(F.desc("transaction_time"), F.desc("global_flow_number"))
    last = mine.withColumn("_n", F.row_number().over(order)).where("_n = 1")
    return last.select("storename", F.lit("").alias("community_id"), F.lit("").alias("previous_community_id"), clean(F.col("region")).alias("region"), F.lit("N").alias("is_interfere"), F.lit(update_time).alias("update_time"), F.lit("5").alias("is_abnormal"), F.lit(0).alias("is_position"), F.lit(dt).alias("dt"))


def append_new(target: DataFrame, rows: DataFrame) -> DataFrame:
    """rows whose store is not in target yet, added."""
    return target.select(TARGET).unionByName(rows.join(target.select("storename").distinct(), "storename", "left_anti").select(TARGET))


def merged_initial(clustered: DataFrame, assigned_out: DataFrame, existing: DataFrame, least: int) -> DataFrame:
    """Existing communities win over assigned, assigned over clustered; small new communities are cleared.

    clustered, assigned_out: target rows; existing: merchant_id, community_id. An existing
    store without a clustered row is an error.
    """
    names = existing.toDF("storename", "_id")
    lost = names.join(clustered.select("storename").distinct(), "storename", "left_anti")
    reject(lost, F.lit(True), ["storename"], "existing stores without a row")
    order = Window.partitionBy("storename").orderBy("community_id", "region")
    one = clustered.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")
    old = one.join(names, "storename").withColumns({"community_id": F.col("_id"), "is_abnormal": F.lit("1"), "is_position": F.lit(0)}).select(TARGET)
    new = assigned_out.where("community_id <> ''").join(names, "storename", "left_anti").select(TARGET)
    rest = clustered.join(names, "storename", "left_anti").join(new.select("storename"), "storename", "left_anti").select(TARGET)
    known = names.select(F.col("_id").alias("community_id")).distinct()
    sizes = rest.where("community_id <> ''").groupBy("community_id").agg(F.count_distinct("storename").alias("_n"))
    small = sizes.join(known, "community_id", "left_anti").where(F.col("_n") < least).select("community_id", F.lit(True).alias("_small"))
    rest = rest.join(small, "community_id", "left")
    gone = F.coalesce("_small", F.lit(False))
    rest = rest.withColumns({"is_abnormal": F.when(gone, "3").otherwise(F.col("is_abnormal")), "is_position": F.when(gone, 0).otherwise(F.col("is_position")), "community_id": F.when(gone, "").otherwise(F.col("community_id"))}).select(TARGET)
    return old.unionByName(new).unionByName(rest)


def combined(candidate_rows: DataFrame, existing_out: DataFrame, tx: DataFrame) -> DataFrame:
    """Both blocks; every merchant of tx must stand in them exactly once, and no other."""
    out = candidate_rows.select(TARGET).unionByName(existing_out.select(TARGET))
    names = tx.select(F.col("merchant_id").alias("storename")).distinct()
    reject(names.join(out, "storename", "left_anti"), F.lit(True), ["storename"], "stores without a result")
    reject(out.join(names, "storename", "left_anti"), F.lit(True), ["storename"], "results of unknown stores")
    reject(out.groupBy("storename").count(), F.col("count") > 1, ["storename", "count"], "stores with several results")
    return out


def need_existing(existing: DataFrame) -> None:
    if existing.isEmpty():
        raise DataError("no store has a community yet")
