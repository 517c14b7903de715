"""Token files: canonical length-limited Huffman codes in independent blocks.

Ids in ascending doc_id order are cut into blocks. A block is self-contained: header,
document ids and lengths, the bit offset of every STRIDE-th id (checkpoints), payload.
The code comes from counts over all blocks; only code lengths are stored, in a table
beside the blocks. Decoding looks LIMIT bits up in one table, for all checkpoints of a
block side by side.

Blocks are rows of a Parquet table (part, block, n_ids, n_docs, data binary), so any
store that Spark writes can hold them.
"""

from __future__ import annotations

import heapq
import itertools
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import encoded, vocabulary_path
from .common import NO_ID, discard, id_text, new_path, tasks_by_bytes, written

LIMIT = 16
STRIDE = 256
MAGIC = 0x48554631
BLOCK_CHARS = 2_000_000


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal code lengths of at most limit bits (package-merge); 0 where the count is 0."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint8)
    if len(used) <= 1:
        out[used] = 1
        return out
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} symbols don't fit codes of {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    weight = counts[order].astype(np.float64)
    n = len(order)
    # level by level: which of the merged list are leaves; packages take two each
    levels, packages = [], np.empty(0)
    for _ in range(limit):
        merged = np.concatenate((weight, packages))
        at = np.argsort(merged, kind="stable")
        levels.append(at < n)
        merged = merged[at]
        packages = merged[0 : len(merged) // 2 * 2].reshape(-1, 2).sum(1)
    take = 2 * (n - 1)
    bits = np.zeros(n, np.int64)
    for leaf in reversed(levels):
        leaves = int(leaf[:take].sum())
        bits[:leaves] += 1
        take = 2 * (take - leaves)
    out[order] = bits
    return out


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of (length, id)."""
    codes = np.zeros(len(lengths), np.uint32)
    code, last = 0, 0
    for i in np.lexsort((np.arange(len(lengths)), lengths)):
        size = int(lengths[i])
        if size:
            code <<= size - last
            codes[i], last = code, size
            code += 1
    return codes


def decode_table(lengths: np.ndarray, limit: int = LIMIT) -> tuple[np.ndarray, np.ndarray]:
    """For every value of the next limit bits: the id and its code's length."""
    ids, size = np.zeros(1 << limit, np.uint16), np.zeros(1 << limit, np.uint8)
    codes = canonical(lengths)
    for i in np.flatnonzero(lengths):
        low = int(codes[i]) << (limit - int(lengths[i]))
        high = low + (1 << (limit - int(lengths[i])))
        ids[low:high], size[low:high] = i, lengths[i]
    return ids, size


def put_bits(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The codes one after another, high bit first, and the bit offset of every STRIDE-th."""
    if not len(ids):
        return b"", np.zeros(0, np.int64)
    size = lengths[ids].astype(np.int64)
    at = np.cumsum(size) - size
    word = at >> 5
    value = codes[ids].astype(np.uint64) << (64 - size - (at & 31)).astype(np.uint64)
    first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
    out = np.zeros(int(word[-1]) + 2, np.uint64)
    out[word[first]] = np.add.reduceat(value >> np.uint64(32), first)
    out[word[first] + 1] += np.add.reduceat(value & np.uint64(0xFFFFFFFF), first)
    return out.astype(">u4").tobytes(), at[::STRIDE]


def get_bits(payload: bytes, n: int, checkpoints: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """n ids; all stretches between checkpoints advance together, one id at a time."""
    ids, size = table
    words = np.concatenate((np.frombuffer(payload, ">u4").astype(np.uint64), np.zeros(2, np.uint64)))
    out = np.zeros((STRIDE, len(checkpoints)), np.uint16)
    at = checkpoints.astype(np.int64).copy()
    last = (len(words) - 2) * 32
    for k in range(min(STRIDE, n)):
        w = at >> 5
        two = (words[w] << np.uint64(32)) | words[w + 1]
        peek = ((two >> (64 - LIMIT - (at & 31)).astype(np.uint64)) & np.uint64((1 << LIMIT) - 1)).astype(np.int64)
        out[k] = ids[peek]
        at = np.minimum(at + size[peek], last)
    return out.T.reshape(-1)[:n]


def write_block(doc_ids: np.ndarray, sizes: np.ndarray, ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> bytes:
    payload, checkpoints = put_bits(ids, lengths, codes)
    head = np.array([MAGIC, len(doc_ids), len(ids), len(checkpoints)], "<i8")
    return b"".join((head.tobytes(), doc_ids.astype("<i8").tobytes(), sizes.astype("<u4").tobytes(), checkpoints.astype("<u4").tobytes(), payload))


def read_block(data: bytes, table: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """doc ids, their numbers of ids, all ids."""
    magic, n_docs, n_ids, n_points = np.frombuffer(data, "<i8", 4).tolist()
    if magic != MAGIC:
        raise ValueError("not a block of this format")
    at = 32
    docs = np.frombuffer(data, "<i8", n_docs, at)
    sizes = np.frombuffer(data, "<u4", n_docs, at + 8 * n_docs)
    points = np.frombuffer(data, "<u4", n_points, at + 12 * n_docs)
    return docs, sizes, get_bits(data[at + 12 * n_docs + 4 * n_points :], n_ids, points, table)


TOKEN_BLOCKS = "part int, block int, low long, high long, docs binary, sizes binary, ids binary"


def token_blocks(docs: DataFrame, end_id: int, path: str) -> DataFrame:
    """Ids of each input partition in blocks, documents in ascending order within a partition."""

    def run(batches):
        from pyspark import TaskContext

        part, enc = TaskContext.get().partitionId(), itertools.count()
        for doc_ids, ids, at in encoded(batches, path, BLOCK_CHARS):
            d = np.array(doc_ids.to_pylist(), np.int64)
            sizes = np.diff(at) + 1
            own = np.insert(ids, at[1:], np.uint16(end_id))
            yield pa.record_batch([[part], [next(enc)], [int(d[0])], [int(d[-1])], [d.tobytes()], [sizes.astype(np.uint32).tobytes()], [own.astype(np.uint16).tobytes()]], schema=BLOCK_SCHEMA)

    return id_text(docs).sortWithinPartitions("doc_id").mapInArrow(run, TOKEN_BLOCKS)


BLOCK_SCHEMA = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("low", pa.int64()), ("high", pa.int64()), ("docs", pa.binary()), ("sizes", pa.binary()), ("ids", pa.binary())])


def in_order(parts: list) -> list[int] | None:
    """Part numbers by their lowest id; None where the ranges of two parts overlap.

    parts: (part, low, high), one for each task of the scan.
    """
    ordered = sorted(parts, key=lambda p: (p[1], p[2]))
    if any(b[1] < a[2] for a, b in itertools.pairwise(ordered)):
        return None
    return [p[0] for p in ordered]


def write_token_files(docs: DataFrame, end_id: int = 2, path: str | None = None) -> tuple[str, dict[int, int]]:
    """Write the block table and the code table; return their folder and each part's rank.

    Documents whose input partitions already hold disjoint ranges of doc_id stay where they
    are; others are range-partitioned by doc_id first. A null text has the end id alone.
    A null doc_id sorts first; it is kept as the smallest long, which read_token_files gives back as null.
    """
    spark = docs.sparkSession
    path = path or vocabulary_path()
    docs = id_text(docs).withColumn("doc_id", F.coalesce("doc_id", F.lit(NO_ID)))
    blocks = written(token_blocks(docs, end_id, path), "tokens")
    ranges = blocks.groupBy("part").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    order = in_order([tuple(r) for r in ranges.collect()])
    if order is None:
        discard(blocks)
        blocks = written(token_blocks(docs.repartitionByRange(tasks_by_bytes(docs), "doc_id"), end_id, path), "tokens")
        ranges = blocks.groupBy("part").agg(F.min("low").alias("low"), F.max("high").alias("high"))
        order = [p[0] for p in sorted((tuple(r) for r in ranges.collect()), key=lambda p: (p[1], p[2]))]

    def tally(batches):
        total = np.zeros(1 << 16, np.int64)
        for b in batches:
            for data in b.column(0):
                total += np.bincount(np.frombuffer(data.as_buffer(), np.uint16), minlength=1 << 16)
        seen = np.flatnonzero(total)
        yield pa.record_batch([pa.array(seen, pa.int32()), pa.array(total[seen], pa.int64())], names=["id", "n"])

    counts = np.zeros(1 << 16, np.int64)  # one entry an id of the vocabulary
    for i, n in blocks.select("ids").mapInArrow(tally, "id int, n long").groupBy("id").agg(F.sum("n")).collect():
        counts[i] = n
    lengths = code_lengths(counts)
    folder = new_path(spark, "token_files")

    def encode(batches):
        codes = canonical(lengths)
        for b in batches:
            data, n_ids = [], []
            for d, s, i in zip(b.column(2), b.column(3), b.column(4), strict=True):
                ids = np.frombuffer(i.as_buffer(), np.uint16)
                data.append(write_block(np.frombuffer(d.as_buffer(), np.int64), np.frombuffer(s.as_buffer(), np.uint32), ids, lengths, codes))
                n_ids.append(len(ids))
            yield pa.record_batch([b.column(0), b.column(1), pa.array(n_ids, pa.int64()), pa.array(data, pa.binary())], names=["part", "block", "n_ids", "data"])

    out = blocks.select("part", "block", "docs", "sizes", "ids").mapInArrow(encode, "part int, block int, n_ids long, data binary")
    out.write.option("compression", "uncompressed").parquet(f"{folder}/blocks")
    spark.createDataFrame([(bytearray(lengths.tobytes()),)], "lengths binary").coalesce(1).write.parquet(f"{folder}/code")
    discard(blocks)
    return folder, {p: k for k, p in enumerate(order)}


def read_token_files(spark, folder: str, ranks: dict[int, int]) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, decoded from the files."""
    lengths = np.frombuffer(bytes(spark.read.parquet(f"{folder}/code").first()[0]), np.uint8)
    blocks = spark.read.schema("part int, block int, n_ids long, data binary").parquet(f"{folder}/blocks")
    totals = dict(tuple(r) for r in blocks.groupBy("part").agg(F.sum("n_ids")).collect())  # one row a task of the scan
    before, upto = {}, 0
    for p in sorted(totals, key=ranks.__getitem__):
        before[p] = upto
        upto += totals[p]
    starts = blocks.select("part", "block", "n_ids").withColumn("in_part", F.sum("n_ids").over(Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)))
    starts = written(starts.select("part", "block", F.coalesce("in_part", F.lit(0)).alias("in_part")), "starts")

    def decode(batches):
        table = decode_table(lengths)
        for b in batches:
            for part, block, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                docs, sizes, ids = read_block(data.as_py(), table)
                ends = np.cumsum(sizes.astype(np.int64))
                wide = ids.astype("<u4")
                crc = [zlib.crc32(wide[a:z].tobytes()) for a, z in zip((ends - sizes).tolist(), ends.tolist(), strict=True)]
                n = len(docs)
                yield pa.record_batch([pa.array(np.full(n, part), pa.int32()), pa.array(np.full(n, block), pa.int32()), pa.array(docs), pa.array(ends - sizes + before[part], pa.int64()), pa.array(sizes, pa.int64()), pa.array(crc, pa.int64())], names=["part", "block", "doc_id", "at", "n_tokens", "ids_crc32"])

    rows = blocks.select("part", "block", "data").mapInArrow(decode, "part int, block int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return rows.join(starts, ["part", "block"]).select(F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id"), (F.col("at") + F.col("in_part")).alias("start"), "n_tokens", "ids_crc32")


def token_file_digests(docs: DataFrame, end_id: int = 2, path: str | None = None) -> DataFrame:
    """Write token files and read them back: doc_id, start, n_tokens and ids_crc32 of every row.

    Null text: the end id alone. A null doc_id comes first and stays null; rows of one doc_id
    follow each other in any order, each with its own start. An empty table gives an empty one.
    """
    return read_token_files(docs.sparkSession, *write_token_files(docs, end_id, path))


def plain_lengths(counts: list[int]) -> list[int]:
    """Unlimited Huffman code lengths by a heap, to compare with in tests."""
    heap = [(c, k, (k,)) for k, c in enumerate(counts) if c]
    heapq.heapify(heap)
    out = [0] * len(counts)
    if len(heap) == 1:
        out[heap[0][1]] = 1
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        for k in (*a[2], *b[2]):
            out[k] += 1
        heapq.heappush(heap, (a[0] + b[0], min(a[1], b[1]), (*a[2], *b[2])))
    return out
