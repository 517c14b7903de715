"""Document fingerprints by winnowing.

Every K characters have a rolling 44-bit hash. In each window of WINDOW hashes the minimum
is chosen, the rightmost of equal ones. Chosen hashes keep their positions, so any passage
of at least K + WINDOW - 1 characters that two texts share yields a common fingerprint.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NO_ID, discard, id_text, tasks_by_bytes, written
from .huffman import in_order
from .words import BASE, INVERSE, mix, powers

K = 12
WINDOW = 16
BITS = 44
SPAN = 1 << 20
PLACE = np.uint64(20)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def kgram_hashes(points: np.ndarray, k: int = K) -> np.ndarray:
    """Hash of every k characters; of the whole text where it is shorter; none if empty."""
    n = len(points)
    if not n:
        return np.empty(0, np.uint64)
    k = min(k, n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((points.astype(np.uint64) + np.uint64(1)) * powers(BASE, n), out=sums[1:])
    return mix((sums[k:] - sums[:-k]) * powers(INVERSE, n)[: n - k + 1]) >> np.uint64(64 - BITS)


def winnow(points: np.ndarray, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Chosen hashes and the positions where their k-grams begin, ascending."""
    h = kgram_hashes(points, k)
    if not len(h):
        return h, np.empty(0, np.int64)
    w = min(window, len(h))
    chosen = []
    for start in range(0, len(h) - w + 1, SPAN - w + 1):  # a hash and its place from the right fit one number
        part = h[start : start + SPAN]
        low, done = (part << PLACE) | np.arange(SPAN - 1, SPAN - 1 - len(part), -1).astype(np.uint64), 1
        while done < w:  # minima of windows of done hashes; the right one wins ties
            step = min(done, w - done)
            low = np.minimum(low[step:], low[:-step])
            done += step
        low = low[np.concatenate(([True], low[1:] != low[:-1]))]
        chosen.append(start + SPAN - 1 - (low & np.uint64(SPAN - 1)).astype(np.int64))
    at = np.concatenate(chosen) if len(chosen) > 1 else chosen[0]
    if len(chosen) > 1:
        at = at[np.concatenate(([True], at[1:] != at[:-1]))]
    return h[at], at


def distinct(h: np.ndarray) -> np.ndarray:
    h = np.sort(h)
    return h[np.concatenate(([True], h[1:] != h[:-1]))] if len(h) else h


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard of two sorted arrays of distinct hashes; two empty ones are alike."""
    if not len(a) and not len(b):
        return 1.0
    both = np.concatenate((a, b))
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return common / (len(both) - common)


def digest(hashes: np.ndarray, at: np.ndarray) -> str:
    return hashlib.blake2b(hashes.astype("<u8").tobytes() + at.astype("<i8").tobytes(), digest_size=16).hexdigest()


def edited(text: str, following: str) -> str:
    """The last quarter replaced by as much of the beginning of the next text."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def fingerprints(docs: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """doc_id, hashes (array of long, as signed) and positions (array of long); null or empty text: empty arrays."""

    def run(batches):
        for b in batches:
            got = [winnow(code_points(t), k, window) for t in b.column(1).to_pylist()]
            yield pa.record_batch([b.column(0), pa.array([h.view(np.int64) for h, _ in got], pa.list_(pa.int64())), pa.array([p for _, p in got], pa.list_(pa.int64()))], names=["doc_id", "hashes", "positions"])

    return id_text(docs).mapInArrow(run, "doc_id long, hashes array<long>, positions array<long>")


FIELDS = [("part", pa.int32()), ("kind", pa.string()), ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()), ("text", pa.string())]
SCHEMA = "part int, kind string, doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, text string"


def compared(text: str, own: tuple, following: str, after: tuple) -> tuple:
    """n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    new = edited(text, following)
    h, at = winnow(code_points(new))
    mine = distinct(own[0])
    return len(text), hashlib.sha256(new.encode("utf-8", "replace")).hexdigest(), digest(*own), digest(h, at), likeness(mine, distinct(h)), likeness(mine, distinct(after[0]))


def _stretches(docs: DataFrame) -> DataFrame:
    """Results of each partition in ascending doc_id order, but for its last document, whose next lies elsewhere.

    kind 'done': a result; 'head' and 'tail': the text of the partition's first and last document.
    """

    def run(batches):
        from pyspark import TaskContext

        part, last, out = TaskContext.get().partitionId(), None, []

        def flush():
            cols = list(zip(*out, strict=True))
            return pa.record_batch([pa.array(c, t) for c, (_, t) in zip(cols, FIELDS, strict=True)], names=[n for n, _ in FIELDS])

        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                own = winnow(code_points(text))
                if last is None:
                    out.append((part, "head", doc, *[None] * 6, text))
                else:
                    out.append((part, "done", last[0], *compared(last[1], last[2], text, own), None))
                last = doc, text, own
            if out:
                yield flush()
                out = []
        if last is not None:
            out.append((part, "tail", last[0], *[None] * 6, last[1]))
            yield flush()

    return docs.sortWithinPartitions("doc_id", "text").mapInArrow(run, SCHEMA)


def edit_likeness(docs: DataFrame) -> DataFrame:
    """Per document its fingerprint, that of its edited text, and likenesses to that and to the next document.

    Next: in ascending (doc_id, text) order, after the last the first; null text: empty;
    a null doc_id comes first and stays null. A single document is its own next. Tables
    whose partitions hold disjoint ranges of ids are not shuffled, others by range.
    """
    spark = docs.sparkSession
    docs = id_text(docs).withColumn("doc_id", F.coalesce("doc_id", F.lit(NO_ID)))
    rows = written(_stretches(docs), "stretches")
    ends = lambda df: [(r.part, r.low, r.high) for r in df.where("kind <> 'done'").groupBy("part").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).collect()]  # noqa: E731  one row a task
    parts = ends(rows)
    order = in_order(parts)
    if order is None:
        discard(rows)
        rows = written(_stretches(docs.repartitionByRange(tasks_by_bytes(docs), "doc_id", "text")), "stretches")
        order = [p[0] for p in sorted(ends(rows), key=lambda p: (p[1], p[2]))]
    following = spark.createDataFrame([(p, order[(k + 1) % len(order)]) for k, p in enumerate(order)], "part int, next_part int")
    tails = rows.where("kind = 'tail'").select("part", "doc_id", "text")
    heads = rows.where("kind = 'head'").select(F.col("part").alias("next_part"), F.col("text").alias("next_text"))

    def run(batches):
        for b in batches:
            got = []
            for t, n in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                got.append(compared(t, winnow(code_points(t)), n, winnow(code_points(n))))
            cols = list(zip(*got, strict=True)) or [[]] * 6
            yield pa.record_batch([b.column(0), *(pa.array(c, t) for c, (_, t) in zip(cols, FIELDS[3:9], strict=True))], names=[n for n, _ in FIELDS[2:9]])

    names = [n for n, _ in FIELDS[2:9]]
    joined = tails.join(following, "part").join(heads, "next_part").select("doc_id", "text", "next_text")
    last = joined.mapInArrow(run, SCHEMA.split("kind string, ")[1].rsplit(", text", 1)[0])
    return rows.where("kind = 'done'").select(names).unionByName(last).withColumn("doc_id", F.nullif("doc_id", F.lit(NO_ID)))
