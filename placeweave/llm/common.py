"""Shared plumbing of the text operators: input columns, shared-folder tables, digests."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir).

    Only a session on one machine may name none; it gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    key = spark.sparkContext.applicationId
    if key not in _OWN_DIRS:
        _OWN_DIRS[key] = tempfile.mkdtemp(prefix="placeweave-")
    return _OWN_DIRS[key]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/placeweave/{uuid.uuid4().hex}/{name}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet to the shared folder and return the reread table (cuts the lineage)."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete a table made by written() that nothing reads any more."""
    spark = df.sparkSession
    jvm = spark._jvm
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/placeweave/" in path:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id long, text string (null: empty); whatever else docs carries is left behind."""
    return docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )


def crc_mod(n: int, id_col: str = "doc_id"):
    """crc32 of the id's decimal text, modulo n (the train / held-out folds)."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % n


#: Stands for a null id where ids are numbers to sort by; a real id of that value comes back as null.
NO_ID = -(2**63)


def tasks_by_bytes(df: DataFrame, text_col: str = "text", each: int = 64 << 20) -> int:
    """How many tasks a shuffle of these texts needs: one for so many bytes, and no fewer than the session's."""
    size = df.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // each))


def in_slices(texts: list[str], most_chars: int = 2_000_000):
    """Ranges (start, stop) of texts with at most so many characters, or one text."""
    start = 0
    while start < len(texts):
        stop, chars = start, 0
        while stop < len(texts) and (stop == start or chars + len(texts[stop]) <= most_chars):
            chars += len(texts[stop])
            stop += 1
        yield start, stop
        start = stop
