"""Cumulative pair statistics from a stream of visits.

Each micro-batch holds whole card days (the source is partitioned so), its statistics are
added to the last state and written as a new version, named by the batch; a batch that is
run again finds its version written and changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import PairConfig, VisitConfig
from ..operators import pairs, visits
from ..sources.tables import _exists


def state_path(folder: str, batch: int) -> str:
    return f"{folder}/version={batch}"


def latest(spark: SparkSession, folder: str, before: int | None = None) -> str | None:
    """The newest complete version (before a batch)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return None
    found = [int(s.getPath().getName().split("=")[1]) for s in fs.listStatus(p) if s.getPath().getName().startswith("version=") and _exists(spark, f"{s.getPath()}/_SUCCESS")]
    found = [v for v in found if before is None or v < before]
    return state_path(folder, max(found)) if found else None


def add_batch(batch: DataFrame, number: int, folder: str, visit_config: VisitConfig, pair_config: PairConfig) -> None:
    spark = batch.sparkSession
    if _exists(spark, f"{state_path(folder, number)}/_SUCCESS"):
        return
    new = pairs.pair_statistics(visits.build_visits(batch, visit_config), pair_config)
    old = latest(spark, folder, number)
    out = pairs.merge_statistics(spark.read.parquet(old), new) if old else new
    out.write.mode("overwrite").parquet(state_path(folder, number))


def run(stream: DataFrame, folder: str, checkpoint: str, visit_config: VisitConfig = VisitConfig(), pair_config: PairConfig = PairConfig()) -> StreamingQuery:
    """Start the query over a stream of card_id, merchant_id, timestamp."""
    return stream.writeStream.foreachBatch(lambda df, n: add_batch(df, n, folder, visit_config, pair_config)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def sessions(stream: DataFrame, gap_minutes: int = 30, late_minutes: int = 120) -> DataFrame:
    """Visits by event time: card, merchant and session start; later rows than late_minutes are left out."""
    at = stream.withColumn("timestamp", F.col("timestamp").cast("timestamp")).withWatermark("timestamp", f"{late_minutes} minutes")
    gap = F.session_window("timestamp", f"{gap_minutes} minutes")
    return at.groupBy("card_id", "merchant_id", gap.alias("w")).agg(F.count("*").alias("transactions")).select("card_id", "merchant_id", F.col("w.start").alias("timestamp"), "transactions")
