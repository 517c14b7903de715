"""Approximate nearest neighbours by shifted space-filling curves.

Each of CURVES orderings projects the vectors on its own mix of the principal axes (fitted
on at most SAMPLE vectors), shifts and scales them to a grid, and numbers the cells along a
Hilbert curve. An ordering is cut into ranges of about RANGE vectors, or more where there would
be over RANGES of them, so the list of cuts is bounded; a query looks in its own range and in those up to a reach on both sides, and the orderings' findings are merged
and ranked by the exact inner product. The reach is the least that finds RECALL of the true
neighbours of JUDGED queries, which are compared with every vector; so it grows as the table
demands it, to the whole table if need be. Equal vectors are one entry with their smallest ids, so a very common
vector fills no range. Inner products of vectors of unlike length become distances by one
more coordinate, which brings every vector to the largest norm.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

CURVES = 14
DIMENSIONS, BITS = 10, 6
RANGE, RANGES = 2048, 1 << 14
#: Above this relative error of the matrix product a score decides; all that may be among the best are scored exactly.
NEAR = 1e-9
SAMPLE = 4096
RECALL, JUDGED = 0.95, 128


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place along the Hilbert curve of each row of grid cells (0 to 2^bits - 1), by Gray-code transposition."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    for level in range(bits - 1, 0, -1):
        bit = 1 << level
        low = bit - 1
        for i in range(n):
            high = (x[i] & bit) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((x[n - 1] >> level) & 1, (1 << level) - 1, 0)
    x ^= turn
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> level) & 1)
    return key


class Curves:
    """The orderings: fitted on a bounded sample, applied to every vector."""

    def __init__(self, sample: np.ndarray, largest_norm: float, curves: int = CURVES, seed: int = 11) -> None:
        self.largest = largest_norm
        x = self.raised(sample)
        self.mean = x.mean(0)
        values, axes = np.linalg.eigh(np.cov((x - self.mean).T) if len(x) > 1 else np.eye(x.shape[1]))
        top = axes[:, np.argsort(-values)[: min(24, x.shape[1])]]
        rng = np.random.default_rng(seed)
        self.ways = []
        for _ in range(curves):
            mix, _ = np.linalg.qr(rng.normal(size=(top.shape[1], top.shape[1])))
            way = top @ mix[:, : min(DIMENSIONS, top.shape[1])]
            spread = ((x - self.mean) @ way).std(0).max() or 1.0
            self.ways.append((way / (6 * spread), rng.uniform(0.3, 0.7, way.shape[1])))

    def raised(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.largest**2 - (x * x).sum(1), 0))
        return np.hstack([x, rest[:, None]])

    def keys(self, x: np.ndarray) -> list[np.ndarray]:
        x = self.raised(x) - self.mean
        return [hilbert_key(np.clip((x @ way + shift) * (1 << BITS), 0, (1 << BITS) - 1), BITS) for way, shift in self.ways]


def inner(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products in double precision, each summed alike wherever it stands."""
    return np.add.reduce(x * q, axis=1)


def matrix(column: pa.Array | pa.ChunkedArray, d: int) -> np.ndarray:
    """Lists of d doubles as rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(-1, d)


def best_of(q: np.ndarray, c: np.ndarray, most: int) -> list[np.ndarray]:
    """For each row of q the rows of c that may be among its most largest inner products, ties at the end included."""
    near = q @ c.T
    if len(c) <= most:
        return [np.arange(len(c))] * len(q)
    least = np.partition(near, len(c) - most, axis=1)[:, len(c) - most]
    slack = NEAR * np.sqrt((q * q).sum(1) * (c * c).sum(1).max())
    return [np.flatnonzero(row >= low) for row, low in zip(near, least - slack, strict=True)]


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id and v (array of double) of the rows that take part."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), v.alias("v"))
    return rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)).where(~bad).where(F.exists("v", lambda x: x != 0))


def true_pairs(entries: DataFrame, keys: DataFrame, d: int, k: int, judged: int = JUDGED) -> list:
    """(keys of a query, keys of one of its k nearest entries) for sampled queries, by comparison with every entry."""
    rows = entries.where("asked").orderBy(F.xxhash64("entry"), "entry").select("entry", "v").limit(judged).collect()
    asker, q = np.array([r["entry"] for r in rows], np.int64), np.array([r["v"] for r in rows], np.float64).reshape(-1, d)

    def best(batches):
        for b in batches:
            if not b.num_rows or not len(q):
                continue
            entry, x = b.column(0).to_numpy(), matrix(b.column(1), d)
            score = np.where(asker[:, None] == entry, -np.inf, q @ x.T)
            most = min(k, len(entry))
            top = np.argpartition(-score, most - 1, axis=1)[:, :most].ravel()
            yield pa.record_batch([pa.array(np.repeat(asker, most)), pa.array(entry[top]), pa.array(score[np.repeat(np.arange(len(q)), most), top])], names=["asker", "entry", "score"])

    near = F.row_number().over(Window.partitionBy("asker").orderBy(F.desc("score"), "entry"))
    found = entries.select("entry", "v").mapInArrow(best, "asker long, entry long, score double").where(F.col("score") > float("-inf"))
    found = found.withColumn("at", near).where(F.col("at") <= k).select("asker", "entry")  # at most judged x k rows
    own = keys.join(F.broadcast(found), "entry").select("asker", F.col("keys").alias("near"))
    return keys.toDF("asker", "keys").join(F.broadcast(own), "asker").select("keys", "near").collect()


def reach_of(pairs: list, splits: list[np.ndarray], recall: float = RECALL) -> int:
    """The least number of ranges to each side, at least one, in which the share recall of the pairs stands."""
    if not pairs:
        return 1
    a, b = (np.array([p[i] for p in pairs], np.float64) for i in (0, 1))
    apart = np.min([np.abs(np.searchsorted(s, a[:, c], "right") - np.searchsorted(s, b[:, c], "right")) for c, s in enumerate(splits)], axis=0)
    return max(1, int(np.sort(apart)[max(0, int(np.ceil(recall * len(apart))) - 1)]))


def nearest(vectors: DataFrame, k: int = 20, every: int = 20, range_size: int = RANGE, curves: int = CURVES) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose id is divisible by every, its k nearest found.

    Nearest is the largest inner product, ties go to the smaller id. Rows whose vector is
    null, empty, zero or not finite take no part, nor do rows without an id; vectors are
    compared with those of their own length. Repeated rows (equal id and vector) count once.
    With few vectors all are compared. An empty table gives an empty one.
    """
    rows = usable(vectors)
    lengths = [r[0] for r in rows.groupBy(F.size("v").alias("d")).count().orderBy("d").collect()]  # one row a length
    found = [_nearest(rows.where(F.size("v") == d).distinct(), d, k, every, range_size, curves) for d in lengths]
    if not found:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return functools.reduce(DataFrame.unionByName, found)


def _nearest(rows: DataFrame, d: int, k: int, every: int, range_size: int, curves: int) -> DataFrame:
    # an entry for each different vector: its k + 1 smallest ids are all that a result can hold
    first = rows.withColumn("at", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).where(F.col("at") <= k + 1)
    entries = first.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    asks = rows.where(F.pmod("vec_id", F.lit(every)) == 0)
    entries = entries.join(asks.select("v").distinct().withColumn("asked", F.lit(True)), "v", "left").select(F.col("ids")[0].alias("entry"), "ids", "v", F.coalesce("asked", F.lit(False)).alias("asked"))
    entries = written(entries, "entries")
    total, norm = entries.agg(F.count("*"), F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)))).first()
    share = min(1.0, 1.2 * SAMPLE / total)
    turn = F.xxhash64("entry")
    sample = entries.where(F.pmod(turn, F.lit(1_000_000)) < int(share * 1_000_000) + 1).orderBy(turn, "entry").select("v").limit(SAMPLE).toArrow()
    index = Curves(matrix(sample["v"], d) if len(sample) else np.ones((1, d)), float(norm), curves)

    def place(batches):
        for b in batches:
            x = matrix(b.column(1), d)
            cols = np.array(index.keys(x) if len(x) else np.empty((curves, 0), np.int64))
            yield pa.record_batch([b.column(0), pa.array(list(cols.T), pa.list_(pa.int64())), b.column(2)], names=["entry", "keys", "asked"])

    keys = written(entries.select("entry", "v", "asked").mapInArrow(place, "entry long, keys array<long>, asked boolean"), "keys")
    ranges = min(RANGES, max(1, -(-total // range_size)))
    cuts = [i / ranges for i in range(1, ranges)]
    spots = keys.select(*(F.col("keys")[c].cast("double").alias(f"k{c}") for c in range(curves)))
    splits = spots.approxQuantile([f"k{c}" for c in range(curves)], cuts, 0.2 / ranges) if cuts else [[] for _ in range(curves)]
    splits = [np.unique(s) for s in splits]  # keys that many entries share make no empty ranges
    reach = reach_of(true_pairs(entries, keys.select("entry", "keys"), d, k), splits) if cuts else 1

    def ranged(batches):
        for b in batches:
            if not b.num_rows:
                continue
            entry, asked = b.column(0).to_numpy(), np.flatnonzero(b.column(2).to_numpy(zero_copy_only=False))
            grid = matrix(b.column(1), curves)
            for c in range(curves):
                at = np.searchsorted(splits[c], grid[:, c], "right")
                low, high = np.maximum(at[asked] - reach, 0), np.minimum(at[asked] + reach, len(splits[c]))
                many = high - low + 1
                wide = np.repeat(low, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                whole = np.concatenate((entry, np.repeat(entry[asked], many)))
                yield pa.record_batch([pa.array(whole), pa.array(np.full(len(whole), c, np.int32)), pa.array(np.concatenate((at, wide)).astype(np.int32)), pa.array(np.arange(len(whole)) >= len(entry))], names=["entry", "curve", "spot", "asks"])

    dealt = keys.mapInArrow(ranged, "entry long, curve int, spot int, asks boolean").join(entries.select("entry", "v"), "entry")

    def search(t: pa.Table) -> pa.Table:
        asks_, x, entry = t.column("asks").to_numpy(), matrix(t.column("v"), d), t.column("entry").to_numpy()
        order = np.argsort(entry, kind="stable")
        asks_, x, entry = asks_[order], x[order], entry[order]
        q, qid, c, cid = x[asks_], entry[asks_], x[~asks_], entry[~asks_]
        out: tuple[list, list, list] = ([], [], [])
        for start in range(0, len(q) if len(c) else 0, 256):
            for i, some in enumerate(best_of(q[start : start + 256], c, k + 1), start):
                score = inner(q[i], c[some])
                top = np.lexsort((cid[some], -score))[: k + 1]
                out[0].append(np.full(len(top), qid[i]))
                out[1].append(cid[some][top])
                out[2].append(score[top])
        cols = [pa.array(np.concatenate(o) if o else np.empty(0, kind)) for o, kind in zip(out, (np.int64, np.int64, np.float64), strict=True)]
        return pa.table(cols, names=["asker", "entry", "score"])

    found = dealt.groupBy("curve", "spot").applyInArrow(search, "asker long, entry long, score double")
    found = found.groupBy("asker", "entry").agg(F.max("score").alias("score"))
    near = F.row_number().over(Window.partitionBy("asker").orderBy(F.desc("score"), "entry"))
    found = found.withColumn("at", near).where(F.col("at") <= k + 1)
    wide = found.join(entries.select("entry", "ids"), "entry").select("asker", "score", F.explode("ids").alias("vec_id"))
    near = F.row_number().over(Window.partitionBy("asker").orderBy(F.desc("score"), "vec_id"))
    wide = wide.withColumn("at", near).where(F.col("at") <= k + 1)
    lists = wide.groupBy("asker").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("down"), "vec_id"))).alias("near"))
    askers = asks.join(entries.where("asked").select("v", F.col("entry").alias("asker")), "v").select(F.col("vec_id").alias("query_id"), "asker")
    own = askers.join(lists, "asker").select("query_id", F.posexplode(F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)).alias("pos", "near"))
    return own.select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("near.vec_id").alias("vec_id"), (-F.col("near.down")).alias("score"))
