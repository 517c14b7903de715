"""From raw tables to canonical transactions, merchant metadata and coordinates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..errors import DataError
from ..functions.geo import coordinate_pair
from ..functions.text import category, clean, formatted_id, in_city, kept_name, normal_status, strip
from ..functions.times import FORMATS, parsed
from .validate import reject, reject_blank, reject_conflicts, reject_duplicates, require_columns

TABLE_COLUMNS = ["account_number", "global_flow_number", "storename", "merchant_category", "transaction_time", "pos_longitude", "pos_latitude", "region", "is_interfere", "is_abnormal", "business_district"]
TEXT_COLUMNS = ["account_number", "global_flow_number", "storename", "transaction_time", "pos_longitude", "pos_latitude", "region", "is_intefere", "status", "dt"]
CLUSTERED = (1, 2)
EXCLUDED_STATUSES = ("2", "5", "6")


def keep_categories(df: DataFrame, source: str) -> DataFrame:
    """Merchants of category 1 and 2. Bad categories, and several for one store, are errors; so is an empty result."""
    typed = df.withColumn("merchant_category", category(F.col("merchant_category")))
    reject(df, category(F.col("merchant_category")).isNull(), ["storename", "merchant_category"], f"{source}: merchant_category")
    reject_conflicts(typed, "storename", "merchant_category", source)
    out = typed.where(F.col("merchant_category").isin(*CLUSTERED))
    if out.isEmpty():
        raise DataError(f"{source}: no merchant of category 1 or 2")
    return out


def first_of_flow(df: DataFrame) -> DataFrame:
    """One row a flow number: the earliest dt, then the earliest time as text, then card and store."""
    order = [F.col(c).asc_nulls_last() for c in ("dt", "transaction_time", "account_number", "storename")]
    return df.withColumn("_n", F.row_number().over(Window.partitionBy("global_flow_number").orderBy(*order))).where("_n = 1").drop("_n")


def canonical(df: DataFrame, source: str, formats: tuple[str, ...] = FORMATS) -> DataFrame:
    """Renamed, parsed and checked columns; times that no format reads are an error."""
    lon, lat = coordinate_pair(F.col("pos_longitude"), F.col("pos_latitude"))
    out = df.withColumns({"timestamp": parsed(F.col("transaction_time"), formats), "longitude": lon, "latitude": lat})
    reject(out, F.col("timestamp").isNull(), ["global_flow_number", "transaction_time"], f"{source}: transaction_time")
    return out.withColumnsRenamed({"account_number": "card_id", "storename": "merchant_id"}).drop("transaction_time")


def load_table(df: DataFrame, dt: str, source: str = "table", formats: tuple[str, ...] = FORMATS) -> DataFrame:
    """Canonical transactions of a table. Repeated flow numbers: the first stays. Extra columns go."""
    require_columns(df, TABLE_COLUMNS, source)
    kept = keep_categories(df, source)
    day = clean(F.col("dt")) if "dt" in df.columns else F.lit("")
    others = [c for c in TABLE_COLUMNS if c not in ("storename", "merchant_category")]
    rows = kept.select(kept_name(F.col("storename")).alias("storename"), "merchant_category", F.when(day == "", F.lit(dt)).otherwise(day).alias("dt"), *(clean(F.col(c)).alias(c) for c in others))
    reject_blank(rows, ["account_number", "global_flow_number", "storename", "region", "dt"], source)
    return canonical(first_of_flow(rows), source, formats)


def load_text(df: DataFrame, source: str = "text", formats: tuple[str, ...] = FORMATS) -> DataFrame:
    """Canonical transactions of a delimited text: repeated flow numbers are an error."""
    require_columns(df, TEXT_COLUMNS, source)
    rows = df.select(kept_name(F.col("storename")).alias("storename"), *(clean(F.col(c)).alias(c) for c in TEXT_COLUMNS if c != "storename"))
    reject_blank(rows, ["account_number", "global_flow_number", "storename"], source)
    reject_duplicates(rows, ["global_flow_number"], source)
    return canonical(rows, source, formats)


def load_offline(df: DataFrame, formats: tuple[str, ...] = FORMATS) -> DataFrame:
    """card_id, merchant_id, timestamp of a three-column text; exact repeats go."""
    require_columns(df, ["account_number", "transaction_time", "storename"], "offline")
    rows = df.select(strip(F.col("account_number")).alias("card_id"), strip(F.col("storename")).alias("merchant_id"), strip(F.col("transaction_time")).alias("transaction_time"))
    reject_blank(rows, ["card_id", "merchant_id", "transaction_time"], "offline")
    rows = rows.withColumn("timestamp", parsed(F.col("transaction_time"), formats))
    reject(rows, F.col("timestamp").isNull(), ["transaction_time"], "offline: transaction_time")
    return rows.select("card_id", "merchant_id", "timestamp").distinct()


def split_by_region(df: DataFrame, regions: dict[str, list[str]]) -> tuple[DataFrame, DataFrame]:
    """Included and cross-region rows. regions: parameter region to city keywords; a row of a listed region whose
    name stands in another city is cross-region."""
    same, here = F.lit(False), F.lit(False)
    for region, keywords in regions.items():
        mine = F.col("region") == region.strip()
        same, here = same | mine, here | (mine & in_city(F.col("storename"), keywords))
    marked = df.withColumns({"_same": F.coalesce(same, F.lit(False)), "_here": F.coalesce(here, F.lit(False))})
    return marked.where("_here").drop("_same", "_here"), marked.where("_same AND NOT _here").drop("_same", "_here")


def exclude_statuses(df: DataFrame, column: str = "is_abnormal") -> DataFrame:
    """Statuses as integer text; rows of the excluded ones go."""
    return df.withColumn(column, normal_status(F.col(column))).where(~F.col(column).isin(*EXCLUDED_STATUSES))


def only_statuses(df: DataFrame, column: str = "is_abnormal") -> DataFrame:
    return df.withColumn(column, normal_status(F.col(column))).where(F.col(column).isin(*EXCLUDED_STATUSES))


def keep_assigned(included: DataFrame, cross: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cross-region rows that already have a district join the included ones."""
    has = clean(F.col("business_district")) != ""
    return included.unionByName(cross.where(has)), cross.where(~has)


def drop_interfered(df: DataFrame) -> DataFrame:
    """All rows of a store go if any of them is marked Y."""
    marked = df.where(F.upper(strip(F.col("is_interfere"))) == "Y").select("storename").distinct()
    return df.join(marked, "storename", "left_anti")


def latest_metadata(tx: DataFrame) -> DataFrame:
    """merchant_id, region, dt, merchant_category of the latest transaction; two regions or dts at that time are an error."""
    top = tx.withColumn("_r", F.rank().over(Window.partitionBy("merchant_id").orderBy(F.desc("timestamp")))).where("_r = 1")
    both = top.withColumn("_at", F.concat_ws("|", "region", "dt"))
    reject_conflicts(both, "merchant_id", "_at", "metadata")
    order = [F.desc("timestamp"), F.desc("region"), F.desc("dt")]
    last = top.withColumn("_n", F.row_number().over(Window.partitionBy("merchant_id").orderBy(*order))).where("_n = 1")
    return last.select("merchant_id", "region", "dt", "merchant_category")


def merchant_coordinates(tx: DataFrame, strict: bool = True) -> DataFrame:
    """merchant_id, longitude, latitude: the only pair a merchant has (two are an error), or the latest."""
    points = tx.where(F.col("longitude").isNotNull() & F.col("latitude").isNotNull())
    if strict:
        pairs = points.select("merchant_id", "longitude", "latitude").distinct()
        reject(pairs.groupBy("merchant_id").count(), F.col("count") > 1, ["merchant_id", "count"], "coordinates: several for a merchant", 10)
        return pairs
    order = [F.desc("timestamp"), F.desc("longitude"), F.desc("latitude")]
    return points.withColumn("_n", F.row_number().over(Window.partitionBy("merchant_id").orderBy(*order))).where("_n = 1").select("merchant_id", "longitude", "latitude")


def shared_coordinates(coords: DataFrame) -> DataFrame:
    return coords.groupBy("longitude", "latitude").agg(F.count("*").alias("merchants"))


def reliable_coordinates(coords: DataFrame, most: int) -> DataFrame:
    """Without the coordinates that more than most merchants share."""
    return coords.join(shared_coordinates(coords).where(F.col("merchants") <= most).drop("merchants"), ["longitude", "latitude"], "left_semi").select("merchant_id", "longitude", "latitude")


def existing_districts(tx: DataFrame) -> DataFrame:
    """merchant_id, community_id of merchants with a district; two different ones are an error."""
    rows = tx.select("merchant_id", clean(F.col("business_district")).alias("community_id")).where("community_id <> ''").distinct()
    reject_conflicts(rows, "merchant_id", "community_id", "districts")
    return rows


def id_texts(df: DataFrame, column: str = "community_id") -> DataFrame:
    return df.withColumn(column, formatted_id(F.col(column)))
