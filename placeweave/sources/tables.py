"""Catalog tables, partitioned folders, snapshots and the shared folder."""

from __future__ import annotations

import tempfile
import uuid
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import DataError
from ..functions.times import parameter_date
from ..operators.validate import reject, require_columns

_OWN: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share; only a session on one machine may name none, and gets a local one."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise DataError("spark.checkpoint.dir must name a folder that driver and executors share")
    key = spark.sparkContext.applicationId
    if key not in _OWN:
        _OWN[key] = tempfile.mkdtemp(prefix="placeweave-")
    return _OWN[key]


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read again: cuts the lineage and survives lost executors."""
    path = f"{shared_folder(df.sparkSession)}/placeweave/{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def partition_path(root: str, table: str, dt: str) -> str:
    """{root}/{table}/dt={dt}; a database prefix of the table name is no part of the path."""
    return f"{root.rstrip('/')}/{table.rsplit('.', 1)[-1]}/dt={dt}"


def read_partitions(spark: SparkSession, root: str, table: str, dts: list[str]) -> DataFrame:
    """All part files of the partitions that exist; dt is the folder's, whatever the files hold."""
    if not dts:
        raise DataError(f"{table}: no partitions asked for")
    parts = []
    for dt in dts:
        path = partition_path(root, table, dt)
        if _exists(spark, path):
            df = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "part*").parquet(path)
            parts.append(df.withColumn("dt", F.lit(dt)))
    if not parts:
        raise DataError(f"{table}: none of the partitions {dts} exists")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    if out.isEmpty():
        raise DataError(f"{table}: partitions {dts} have no rows")
    return out


@dataclass(frozen=True)
class Parameters:
    start: date
    end: date
    region: str
    window_minutes: int
    min_support: int
    min_community_size: int
    daily: bool


PARAMETER_COLUMNS = ["start_date", "end_date", "region", "max_transaction_time_interval", "min_transaction_number", "min_merchant_count", "is_daily"]


def read_parameters(df: DataFrame, source: str = "parameters") -> list[Parameters]:
    """The rows of the parameter table, checked; at most 1000 may be there."""
    require_columns(df, PARAMETER_COLUMNS, source)
    out = []
    for r in df.select(PARAMETER_COLUMNS).limit(1001).collect():
        try:
            numbers = [float(r[c]) for c in PARAMETER_COLUMNS[3:6]]
        except (TypeError, ValueError) as e:
            raise DataError(f"{source}: not a number in {r}") from e
        flag = str(r["is_daily"]).strip()
        if flag.endswith(".0"):
            flag = flag[:-2]
        if any(n != int(n) or n <= 0 for n in numbers) or flag not in ("0", "1") or not str(r["region"] or "").strip():
            raise DataError(f"{source}: bad row {r}")
        start, end = parameter_date(r["start_date"]), parameter_date(r["end_date"])
        if start > end:
            raise DataError(f"{source}: start after end in {r}")
        out.append(Parameters(start, end, r["region"].strip(), *map(int, numbers), flag == "1"))
    if not out or len(out) > 1000:
        raise DataError(f"{source}: {len(out)} rows")
    return out


def overwrite_partition(df: DataFrame, table: str, dt: str) -> None:
    """Replace one dt partition of a catalog table; an empty result is an error and leaves it alone."""
    if df.isEmpty():
        raise DataError(f"{table}: nothing to write for dt={dt}")
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        df.withColumn("dt", F.lit(dt)).write.partitionBy("dt").format("parquet").saveAsTable(table)
        return
    view = f"rows_{uuid.uuid4().hex}"
    columns = [c for c in spark.table(table).columns if c != "dt"]
    df.select(columns).createOrReplaceTempView(view)
    try:
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION (dt = '{dt}') SELECT * FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def overwrite_dynamic(df: DataFrame, path: str) -> None:
    """Replace the dt partitions that df has, in one write."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dt").parquet(path)


def replace_table(df: DataFrame, table: str) -> None:
    df.write.mode("overwrite").format("parquet").saveAsTable(table)


def write_statistics(pairs: DataFrame, counts: DataFrame, folder: str) -> None:
    pairs.write.mode("overwrite").parquet(f"{folder}/pairs")
    counts.write.mode("overwrite").parquet(f"{folder}/visit_counts")


def read_statistics(spark: SparkSession, folder: str, strict: bool = True) -> tuple[DataFrame, DataFrame]:
    """Pairs and visit counts; strict: ordered ends, positive strength, support of 1 or more, ends with visits."""
    pairs = spark.read.schema("l string, r string, strength double, support long").parquet(f"{folder}/pairs")
    counts = spark.read.schema("merchant_id string, visits long").parquet(f"{folder}/visit_counts")
    if strict:
        bad = ~((F.col("l") < F.col("r")) & (F.col("strength") > 0) & (F.col("strength") < float("inf")) & (F.col("support") >= 1))
        reject(pairs, F.coalesce(bad, F.lit(True)), ["l", "r", "strength", "support"], "pair statistics")
        ends = pairs.select(F.explode(F.array("l", "r")).alias("merchant_id")).distinct().join(counts, "merchant_id", "left_anti")
        reject(ends, F.lit(True), ["merchant_id"], "pair statistics: no visits")
    return pairs, counts


def merge_state(spark: SparkSession, old: str, delta: DataFrame, new: str, keys: list[str], sums: list[str]) -> DataFrame:
    """The old state and a delta, added by key, as a new version; the old one stays for a rollback."""
    both = spark.read.parquet(old).unionByName(delta) if _exists(spark, old) else delta
    both.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in sums)).write.mode("errorifexists").parquet(new)
    return spark.read.parquet(new)
