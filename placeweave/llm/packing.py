"""Best-fit packing of token pieces into sequences by swap-based local search.

Pieces are dealt by a hash into groups of about GROUP pieces, whose number grows with the
table. In each group every piece first goes to the fullest bin that it fits (best fit,
longest first). Then bins that are not full trade contents: one piece moves, one is
exchanged for one, or two for one, whenever that raises the sum of squared fills. Filling
the fuller bins drains the emptiest one, until it is empty and goes; passes are repeated
until no trade helps. The bins that the groups leave below FULL are opened and packed again
in fewer groups, until one group holds them all or their number no longer falls.
"""

from __future__ import annotations

import functools
import itertools
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import encoded, vocabulary_path
from .common import id_text, written

GROUP = 4096
FULL = 0.98
SEARCH_BINS = 512

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces_of(docs: DataFrame, capacity: int = 2048, end_id: int = 0, path: str | None = None) -> DataFrame:
    """Per piece doc_id, piece, start, length and the crc32 of its ids.

    A document's ids end with end_id, so an empty or null text has one piece of length 1.
    Only documents longer than capacity are cut. Repeated rows each have their pieces.
    """
    path = path or vocabulary_path()

    def run(batches):
        for doc_ids, ids, at in encoded(batches, path):
            rows: list[tuple] = []
            for doc, lo, hi in zip(doc_ids.to_pylist(), at[:-1].tolist(), at[1:].tolist(), strict=True):
                own = np.append(ids[lo:hi].astype("<u4"), np.uint32(end_id))
                for k, start in enumerate(range(0, len(own), capacity)):
                    part = own[start : start + capacity]
                    rows.append((doc, k, start, len(part), zlib.crc32(part.tobytes())))
            cols = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return id_text(docs).mapInArrow(run, PIECES)


def best_fit(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of piece numbers: longest first, each into the fullest bin with room."""
    free: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by room left
    rooms = 0  # bit r is set where free[r] has a bin
    bins: list[list[int]] = []
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fits = rooms >> size
        if fits:
            room = size + ((fits & -fits).bit_length() - 1)
            b = free[room].pop()
            if not free[room]:
                rooms ^= 1 << room
        else:
            b, room = len(bins), capacity
            bins.append([])
        bins[b].append(i)
        room -= size
        if room:
            free[room].append(b)
            rooms |= 1 << room
    return bins


def local_search(bins: list[list[int]], sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Trade pieces between bins with room while squared fill rises; drop bins that empty.

    A bin gains from another that is at most as full only by taking more than it gives, so
    every trade raises the sum of squares and the search ends.
    """
    size = sizes.tolist()
    fill = [sum(size[i] for i in b) for b in bins]
    traded = True
    while traded:
        traded = _pass(bins, fill, size, capacity)
    return [b for b in bins if b]


def _pass(bins: list[list[int]], fill: list[int], size: list[int], capacity: int) -> bool:
    """Every bin with room gives once, the emptiest first; whether anything was traded."""
    open_bins = sorted((k for k in range(len(bins)) if bins[k] and fill[k] < capacity), key=lambda k: (fill[k], k))
    traded = False
    for donor in open_bins:
        if not bins[donor]:
            continue
        for start in range(len(open_bins) - 1, -1, -SEARCH_BINS):  # fullest first, all of them in turn
            for taker in open_bins[max(0, start - SEARCH_BINS + 1) : start + 1][::-1]:
                if taker == donor or not bins[taker] or fill[taker] < fill[donor]:
                    continue
                while bins[donor] and fill[taker] < capacity and _trade(bins, fill, size, donor, taker, capacity):
                    traded = True
                if not bins[donor]:
                    break
            if not bins[donor]:
                break
    return traded


def _trade(bins: list[list[int]], fill: list[int], size: list[int], donor: int, taker: int, capacity: int) -> bool:
    room = capacity - fill[taker]
    best: tuple[int, tuple, tuple] | None = None
    out, back_from = _by_size(bins[donor], size, 2), _by_size(bins[taker], size, 1)
    for i in out:  # a move
        if size[i] <= room and (best is None or size[i] > best[0]):
            best = size[i], (i,), ()
    for j in back_from:  # one for one, and two for one
        if best is not None and best[0] == room:
            break
        most = size[j] + room
        for a, i in enumerate(out):
            gain = size[i] - size[j]
            if 0 < gain <= room and (best is None or gain > best[0]):
                best = gain, (i,), (j,)
            if size[i] < most:
                for k in out[a + 1 :]:
                    gain = size[i] + size[k] - size[j]
                    if 0 < gain <= room and (best is None or gain > best[0]):
                        best = gain, (i, k), (j,)
    if best is None:
        return False
    gain, given, back = best
    bins[donor] = [i for i in bins[donor] if i not in given] + list(back)
    bins[taker] = [j for j in bins[taker] if j not in back] + list(given)
    fill[donor] -= gain
    fill[taker] += gain
    return True


def _by_size(pieces: list[int], size: list[int], most: int) -> list[int]:
    """At most so many pieces of each size: others of that size would trade alike."""
    seen: dict[int, int] = {}
    out = []
    for i in pieces:
        seen[size[i]] = seen.get(size[i], 0) + 1
        if seen[size[i]] <= most:
            out.append(i)
    return out


def pack(pieces: DataFrame, capacity: int = 2048, group: int = GROUP) -> DataFrame:
    """pieces (length long and any other columns) with sequence_id and offset, which replace columns of those names.

    Lengths are 1 to capacity; none may be null. Equal pieces and repeated rows are packed one
    by one. Empty in, empty out.
    """
    names = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    inner = [f"c{i}" for i in range(len(names))]
    length = inner[names.index("length")]
    plain = pieces.select(*(F.col(f"`{c}`") for c in names)).toDF(*inner)
    left = written(plain.withColumn("at", F.monotonically_increasing_id()), "pieces")
    done, n, before = [], left.count(), None
    for turn in itertools.count():
        groups = max(1, -(-n // group))
        packed = written(_packed(left, length, capacity, groups, turn), "packed")
        fill = packed.groupBy("sequence_id").agg(F.sum(length).alias("fill"))
        loose = written(fill.where(F.col("fill") < int(FULL * capacity)).select("sequence_id"), "open_bins")
        bins = loose.count()
        if groups == 1 or not bins or (before is not None and bins >= before):
            done.append(packed)
            break
        done.append(packed.join(loose, "sequence_id", "left_anti"))
        left, before = packed.join(loose, "sequence_id", "left_semi").drop("sequence_id", "offset"), bins
        n = left.count()
    out = functools.reduce(DataFrame.unionByName, [d.select(*inner, "sequence_id", "offset") for d in done])
    return out.toDF(*names, "sequence_id", "offset")


def _packed(pieces: DataFrame, length: str, capacity: int, groups: int, turn: int) -> DataFrame:
    columns = pieces.columns

    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("at", kind="stable", ignore_index=True)
        sizes = pdf[length].to_numpy(np.int64)
        bins = local_search(best_fit(sizes, capacity), sizes, capacity)
        bin_of, offset = np.empty(len(pdf), np.int64), np.empty(len(pdf), np.int64)
        for k, b in enumerate(bins):
            at = 0
            for i in b:
                bin_of[i], offset[i] = k, at
                at += sizes[i]
        pdf["sequence_id"] = (np.int64(turn) << 56) + (np.int64(key[0]) << 20) + bin_of
        pdf["offset"] = offset
        return pdf[[*columns, "sequence_id", "offset"]]

    dealt = pieces.withColumn("group", F.pmod(F.xxhash64("at", F.lit(turn)), F.lit(groups)))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema)
    return dealt.groupBy("group").applyInPandas(lambda key, pdf: run(key, pdf.drop(columns="group")), f"{fields}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, capacity: int = 2048, end_id: int = 0, path: str | None = None) -> DataFrame:
    """The pieces of all documents (see pieces_of) with sequence_id and offset.

    Null and empty texts have one piece, the end id; null and repeated doc_ids stay as they
    are; other columns are left behind; an empty table gives an empty one.
    """
    return pack(pieces_of(docs, capacity, end_id, path), capacity)
