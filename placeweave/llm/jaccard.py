"""N-gram Jaccard join by vertical partitioning.

The global order of n-grams is by frequency class (eighths of an octave of the number of
documents, rare first) and then by hash. To count documents, each batch of texts deals its
different n-grams, with their counts, to fragments of the hash range, so a very common
n-gram is one entry a batch; a fragment adds up and sends back the classes of those that more
than one document has. A document whose rarest n-grams are all its own can't reach the
threshold with any other, and needs no more work.

Equal sets become one class. Classes that share an n-gram of their prefixes are
candidates. The global order is cut into fragments of equal weight, and a candidate pair's
overlap is counted in each fragment apart and summed: the pairs of one class are cut into
blocks of at most BLOCK, and a block meets the class's n-grams of a fragment in one group.
First each prefix n-gram's classes are compared with one of them only, the one with the
fewest n-grams that no other document has; what that links is a component, and pairs within a
component are never made. Then all other pairs that pass the length and position filters, and
whose n-gram counts by hash class allow the overlap, are compared, so that no link between
components is lost.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, id_text, written
from .words import SPACE, hashes, joined, mix, spans

FRAGMENT_BYTES = 4 << 20
BATCH_CHARS, BATCH_DOCS = 1_500_000, 4000
#: Fragments of the global order, at least; one holds at most so many n-grams of a document.
FRAGMENTS, SEGMENT_KEYS = 8, 250_000
#: Pairs of one class that are counted together; bytes of n-grams of a group, about; groups at least, by fragment.
BLOCK, GROUP_BYTES, GROUPS = 256, 16 << 20, 32
#: Hash classes of the counts that bound an overlap.
SKETCH = 64
FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
BELOW = np.uint64(16)

#: Fragment rows: low and high bits of n-grams, documents of the batch that have each. A batch's own row (frag < 0): its
#: documents, references to earlier n-grams, which n-grams are new, and the fragments of the new ones.
DEALT = pa.schema([("frag", pa.int32()), ("batch", pa.int64()), ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary()), ("d", pa.binary())])
DEALT_SQL = "frag int, batch long, a binary, b binary, c binary, d binary"
#: Fragment rows: which of the dealt n-grams other documents have too, their hashes and frequency classes.
COUNTED, COUNTED_SQL = DEALT, DEALT_SQL


def shingle_sets(texts: list[str], words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of all texts, text after text and ascending, and where each begins.

    Words: runs of bytes other than ASCII white space, A-Z folded. A text of fewer words is
    one n-gram; one without words has none.
    """
    buf, at = joined([t.encode("utf-8", "replace").translate(FOLD) for t in texts])
    starts, ends = spans(~SPACE[buf])
    h = hashes(buf, starts, ends)
    first = np.searchsorted(starts, at)
    run = np.zeros(max(0, len(h) - words + 1), np.uint64)
    for k in range(words):
        run = mix(run * np.uint64(3) + h[k : k + len(run)])
    out, sizes = [], np.zeros(len(texts) + 1, np.int64)
    for k, (a, z) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True)):
        if z - a >= words:
            own = np.sort(run[a : z - words + 1])
            own = own[np.concatenate(([True], own[1:] != own[:-1]))]
        else:
            own = np.zeros(min(1, z - a), np.uint64)
            for x in h[a:z]:
                own = mix(own * np.uint64(5) + x + np.uint64(z - a))
        out.append(own)
        sizes[k + 1] = len(own)
    return np.concatenate(out) if out else np.empty(0, np.uint64), np.cumsum(sizes)


def _fragments(docs: DataFrame) -> int:
    """A power of two that grows with the bytes of the texts, so that a fragment stays small."""
    size = id_text(docs).agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return 1 << min(20, max(6, math.ceil(math.log2(max(1, size / FRAGMENT_BYTES)))))


def _dealt(docs: DataFrame, words: int, bits: int) -> DataFrame:
    """A batch's different n-grams by fragment, and one row a batch of what tells the documents that have them."""

    def run(batches):
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        for b in batches:
            ids, texts, start = b.column(0), b.column(1).to_pylist(), 0
            while start < len(texts):
                stop, chars = start, 0
                while stop < len(texts) and stop - start < BATCH_DOCS and (stop == start or chars + len(texts[stop]) <= BATCH_CHARS):
                    chars += len(texts[stop])
                    stop += 1
                keys, at = shingle_sets(texts[start:stop], words)
                batch = (part << 24) + number
                number += 1
                info = pa.Table.from_arrays([ids[start:stop], pa.array(np.diff(at)), pa.array([hashlib.blake2b(keys[a:z].tobytes(), digest_size=16).digest() for a, z in zip(at[:-1], at[1:], strict=True)], pa.binary())], names=["doc_id", "n", "sig"])
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, info.schema) as w:
                    w.write_table(info)
                new, refs, times = _first_places(keys)
                keys = keys[new]
                frag = (keys >> np.uint64(64 - bits)).astype(np.int32)
                order = np.argsort(frag, kind="stable")
                own = -1 - batch % (1 << bits)  # a batch's own row travels with one of the fragments, a different one for each
                rows = [[own], [batch], [sink.getvalue().to_pybytes()], [refs.tobytes()], [np.packbits(new).tobytes()], [frag.astype(_kind(bits)).tobytes()]]
                frag, times, keys = frag[order], times[order], keys[order] << np.uint64(bits)
                low, high = (keys >> np.uint64(32)).astype(np.uint32), ((keys >> BELOW) & np.uint64(0xFFFF)).astype(np.uint16)
                cuts = np.concatenate(([0], np.flatnonzero(frag[1:] != frag[:-1]) + 1, [len(frag)])) if len(frag) else np.zeros(1, np.int64)
                for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                    for col, v in zip(rows, (int(frag[a]), batch, low[a:z].tobytes(), high[a:z].tobytes(), times[a:z].tobytes(), None), strict=True):
                        col.append(v)
                yield pa.record_batch([pa.array(c, t.type) for c, t in zip(rows, DEALT, strict=True)], schema=DEALT)
                start = stop

    return id_text(docs).mapInArrow(run, DEALT_SQL)


def _kind(bits: int) -> type:
    return np.uint16 if bits <= 16 else np.uint32


def _first_places(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which places hold a value for the first time; for the others the number of their value; and each value's places.

    Values are numbered as they come.
    """
    order = np.argsort(keys, kind="stable")
    first = np.ones(len(keys), bool)
    first[1:] = keys[order][1:] != keys[order][:-1]
    starts = np.flatnonzero(first)
    new = np.zeros(len(keys), bool)
    new[order[starts]] = True
    group = np.empty(len(keys), np.int64)
    group[order] = np.cumsum(first) - 1
    number = (np.cumsum(new) - 1)[order[starts]]  # by group
    times = np.empty(len(starts), np.uint16)
    times[number] = np.diff(np.append(starts, len(keys)))
    return new, number[group[~new]].astype(np.uint32), times


def _count(t: pa.Table, bits: int) -> pa.Table:
    """One fragment: for each batch those of its n-grams that two documents and more have, with their frequency class."""
    t = t.combine_chunks()
    is_own = pc.less(t.column("frag"), 0)
    own, t = t.filter(is_own), t.filter(pc.invert(is_own))
    if not len(t):
        return own
    frag = t.column("frag")[0].as_py()
    low, high, times = (np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in t.column(c)]) for c, kind in (("a", np.uint32), ("b", np.uint16), ("c", np.uint16)))
    size = np.array([len(x.as_buffer()) // 2 for x in t.column("c")])
    keys = (low.astype(np.uint64) << np.uint64(32)) | (high.astype(np.uint64) << BELOW)
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    first = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
    total = np.add.reduceat(times[order].astype(np.int64), first)
    grade = np.where(total > 1, np.minimum(np.floor(8 * np.log2(np.maximum(total, 1))), 255), 0).astype(np.uint8)
    of = np.empty(len(k), np.uint8)
    of[order] = np.repeat(grade, np.diff(np.append(first, len(k))))
    keys = (np.uint64(frag) << np.uint64(64 - bits)) | (keys >> np.uint64(bits))
    out: list[list] = [[], [], [], [], [], []]
    at = 0
    for b, n in zip(t.column("batch").to_pylist(), size.tolist(), strict=True):
        many = of[at : at + n] > 0
        if many.any():
            for col, x in zip(out, (frag, b, np.packbits(many).tobytes(), keys[at : at + n][many].tobytes(), of[at : at + n][many].tobytes(), None), strict=True):
                col.append(x)
        at += n
    return pa.concat_tables([own, pa.table([pa.array(c, f.type) for c, f in zip(out, COUNTED, strict=True)], schema=COUNTED)])


SETS = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("sig", pa.binary()), ("prefix", pa.list_(pa.int64())), ("skip", pa.int64()), ("keys", pa.binary()), ("grades", pa.binary())])
SETS_SQL = "doc_id long, n long, sig binary, prefix array<long>, skip long, keys binary, grades binary"


def _sets(bits: int, percent: int):
    """A batch's documents: size, signature; and where a link is possible, the shared part of the prefix and the shared n-grams in global order."""

    def run(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        is_own = pc.less(t.column("frag"), 0)
        own, rest = t.filter(is_own), t.filter(pc.invert(is_own))
        info = pa.ipc.open_stream(own.column("a")[0].as_buffer()).read_all()
        ids, n, sig = info.column("doc_id").to_pylist(), info.column("n").to_numpy(), info.column("sig").to_pylist()
        frag = np.frombuffer(own.column("d")[0].as_buffer(), _kind(bits))
        number = np.argsort(frag, kind="stable")
        starts = np.searchsorted(frag[number], np.arange((1 << bits) + 1))
        key, grade = np.zeros(len(frag), np.uint64), np.zeros(len(frag), np.uint8)
        for f, mask, k, g in zip(rest.column("frag").to_pylist(), rest.column("a"), rest.column("b"), rest.column("c"), strict=True):
            mine = number[starts[f] : starts[f + 1]]
            mine = mine[np.unpackbits(np.frombuffer(mask.as_buffer(), np.uint8), count=len(mine)).astype(bool)]
            key[mine], grade[mine] = np.frombuffer(k.as_buffer(), np.uint64), np.frombuffer(g.as_buffer(), np.uint8)
        new = np.unpackbits(np.frombuffer(own.column("c")[0].as_buffer(), np.uint8), count=int(n.sum())).astype(bool)
        at_place = np.cumsum(new) - 1
        at_place[~new] = np.frombuffer(own.column("b")[0].as_buffer(), np.uint32)
        docs = np.repeat(np.arange(len(ids)), n)
        shared = grade[at_place] > 0
        docs, keys, grades = docs[shared], key[at_place[shared]], grade[at_place[shared]]
        order = np.lexsort((keys, grades, docs))
        docs, keys, grades = docs[order], keys[order], grades[order]
        at = np.searchsorted(docs, np.arange(len(ids) + 1))
        chief: dict[bytes, int] = {}
        for k, s in enumerate(sig):
            if s not in chief or (ids[k] is not None and (ids[chief[s]] is None or ids[k] < ids[chief[s]])):
                chief[s] = k
        out: list[list] = [[], [], [], []]
        for k in range(len(ids)):
            mine = slice(at[k], at[k + 1])
            alone = int(n[k]) - int(at[k + 1] - at[k])
            size = int(n[k]) - -(-percent * int(n[k]) // 100) + 1
            able = alone < size and n[k] and chief[sig[k]] == k
            for col, v in zip(out, (keys[mine][: size - alone].view(np.int64), alone, keys[mine].tobytes(), grades[mine].tobytes()) if able else (None,) * 4, strict=True):
                col.append(v)
        return pa.table([pa.array(c, f.type) for c, f in zip((ids, n, sig, *out), SETS, strict=True)], schema=SETS)

    return run


def _fragment_of(keys: np.ndarray, grades: np.ndarray, before: np.ndarray, weight: np.ndarray, fragments: int) -> np.ndarray:
    """Cuts of equal weight through the global order: by class, and in a class by hash, which is spread evenly.

    before: n-grams of the classes before each one; weight: of each one.
    """
    place = before[grades] + weight[grades] * (keys.astype(np.float64) / 2.0**64)
    return np.minimum((place * (fragments / max(1.0, float(weight.sum())))).astype(np.int64), fragments - 1)


def _overlaps(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """x, y and how many n-grams both have: counted by fragment of the global order, then summed.

    pairs: x and y, each pair once; x is the class that many pairs have in common.
    """
    col = F.col
    ends = pairs.select(F.explode(F.array("x", "y")).alias("nid")).distinct()
    used = classes.join(ends, "nid", "left_semi").select("nid", "keys", "grades")

    def weigh(batches):
        total = np.zeros(256, np.int64)
        for b in batches:
            for g in b.column(0):
                total += np.bincount(np.frombuffer(g.as_buffer(), np.uint8), minlength=256)
        yield pa.record_batch([pa.array(np.arange(256, dtype=np.int32)), pa.array(total)], names=["grade", "n"])

    rows = used.select("grades").mapInArrow(weigh, "grade int, n long").groupBy("grade").agg(F.sum("n").alias("n")).collect()
    weight = np.zeros(256)
    for grade, n in rows:
        weight[grade] = n
    before = np.cumsum(weight) - weight
    longest = used.agg(F.max(F.length("grades"))).first()[0] or 0
    fragments = max(FRAGMENTS, -(-longest // SEGMENT_KEYS))

    def cut(batches):
        for b in batches:
            rows: list[list] = [[], [], []]
            for nid, data, g in zip(b.column(0).to_pylist(), b.column(1), b.column(2), strict=True):
                keys = np.frombuffer(data.as_buffer(), np.uint64)
                part = _fragment_of(keys, np.frombuffer(g.as_buffer(), np.uint8), before, weight, fragments)
                where = np.searchsorted(part, np.arange(fragments + 1))  # the n-grams stand in global order
                for v in np.flatnonzero(np.diff(where)).tolist():
                    for c, x in zip(rows, (v, nid, keys[where[v] : where[v + 1]].tobytes()), strict=True):
                        c.append(x)
            yield pa.record_batch([pa.array(rows[0], pa.int32()), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.binary())], names=["v", "nid", "keys"])

    segments = used.mapInArrow(cut, "v int, nid long, keys binary")
    blocks = F.ceil(col("many") / BLOCK)
    dealt = pairs.join(pairs.groupBy("x").agg(F.count("*").alias("many")), "x").select("x", "y", F.pmod(F.xxhash64("y"), blocks).alias("block"))
    sizes = classes.select(col("nid").alias("y"), F.length("keys").alias("bytes"))
    size = pairs.join(sizes, "y").agg(F.sum("bytes")).first()[0] or 0
    groups = max(GROUPS, -(-size // (fragments * GROUP_BYTES)))
    dealt = dealt.withColumn("g", F.pmod(F.xxhash64("x", "block"), F.lit(groups)).cast("int"))
    leaves = dealt.join(segments, dealt["y"] == segments["nid"]).select("g", "v", "x", "block", "y", "keys")
    heads = dealt.select("g", "x", "block").distinct().join(segments, col("x") == segments["nid"]).select("g", "v", "x", "block", "keys").toDF("head_g", "head_v", "head", "head_block", "head_keys")

    def count(key, many: pa.Table, one: pa.Table) -> pa.Table:
        head = {(x, b): np.frombuffer(k.as_buffer(), np.uint64) for x, b, k in zip(one.column("head").to_pylist(), one.column("head_block").to_pylist(), one.column("head_keys"), strict=True)}
        out: list[list] = [[], [], []]
        for x, b, y, k in zip(*(many.column(c).to_pylist() for c in ("x", "block", "y")), many.column("keys"), strict=True):
            if (a := head.get((x, b))) is not None:
                both = np.concatenate((a, np.frombuffer(k.as_buffer(), np.uint64)))
                both.sort(kind="stable")
                for c, v in zip(out, (x, y, int((both[1:] == both[:-1]).sum())), strict=True):
                    c.append(v)
        return pa.table([pa.array(c, pa.int64()) for c in out], names=["x", "y", "common"])

    parts = leaves.groupBy("g", "v").cogroup(heads.groupBy("head_g", "head_v")).applyInArrow(count, "x long, y long, common long")
    return parts.groupBy("x", "y").agg(F.sum("common").alias("common"))


def _sketched(classes: DataFrame) -> DataFrame:
    """nid and how many shared n-grams it has in each hash class; the smaller counts of two bound their overlap."""

    def run(batches):
        for b in batches:
            out = [np.bincount((np.frombuffer(k.as_buffer(), np.uint64) % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH) for k in b.column(1)]
            yield pa.record_batch([b.column(0), pa.array([x.tolist() for x in out], pa.list_(pa.int32()))], names=["nid", "sketch"])

    return classes.select("nid", "keys").mapInArrow(run, "nid long, sketch array<int>")


def _other_pairs(placed: DataFrame, classes: DataFrame, percent: int, passes) -> DataFrame:
    """x, y of classes of different components that share a prefix n-gram and may reach the threshold."""
    col = F.col
    sketches = _sketched(classes.join(placed.select("nid"), "nid", "left_semi"))
    placed = written(placed.join(sketches, "nid"), "sketched")
    own = ("nid", "n", "pos", "label", "sketch")
    sizes = F.explode(F.array(*(col("size") + d for d in (-1, 0, 1)))).alias("size")
    a = placed.where("label <> main").select("gram", sizes, *(col(c).alias(f"a_{c}") for c in own))
    b = placed.select("gram", "size", *(col(c).alias(f"b_{c}") for c in own))
    most = F.aggregate(F.zip_with("a_sketch", "b_sketch", lambda x, y: F.least(x, y)), F.lit(0), lambda s, x: s + x)
    fits = 100 * most >= percent * (col("a_n") + col("b_n") - most)
    pairs = a.join(b, (a["gram"] == b["gram"]) & (a["size"] == b["size"]) & (col("a_label") != col("b_label")) & passes(col("a_n"), col("b_n"), col("a_pos"), col("b_pos")) & fits)
    return pairs.select(F.least("a_nid", "b_nid").alias("x"), F.greatest("a_nid", "b_nid").alias("y")).distinct()


def _links(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    size = classes.select("nid", "n")
    counted = _overlaps(pairs, classes).join(size.toDF("x", "n_x"), "x").join(size.toDF("y", "n_y"), "y")
    return counted.where(100 * F.col("common") >= percent * (F.col("n_x") + F.col("n_y") - F.col("common"))).select("x", "y")


def components(edges: DataFrame) -> DataFrame:
    """nid and label (the smallest nid reachable) of every end of an edge: least labels of neighbours, then of labels."""
    both = written(edges.union(edges.select("y", "x")).toDF("nid", "other").distinct(), "edges")
    labels = both.groupBy("nid").agg(F.least("nid", F.min("other")).alias("label"))
    labels = written(labels, "labels")
    while True:
        near = both.join(labels.toDF("other", "near"), "other").groupBy("nid").agg(F.min("near").alias("near"))
        step = labels.join(near, "nid").select("nid", F.least("label", "near").alias("next"), "label")
        jump = labels.toDF("next", "further")
        step = step.join(jump, "next", "left").select("nid", F.least("next", F.coalesce("further", "next")).alias("to"), "label")
        step = written(step, "labels")
        changed = step.where("`to` <> label").limit(1).count()
        discard(labels)
        labels = step.select("nid", F.col("to").alias("label"))
        if not changed:
            discard(both)
            return labels


def jaccard_components(docs: DataFrame, words: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id of every row.

    Two documents link when 100 * common n-grams >= percent * n-grams of either. Texts that
    are null or without words have no n-grams, link with nothing and are their own
    component. Rows with equal doc_id are separate documents of the same number. A null
    doc_id stays null and never names a component that has others.
    """
    bits = _fragments(docs).bit_length() - 1
    counted = written(_dealt(docs, words, bits).groupBy("frag").applyInArrow(lambda t: _count(t, bits), COUNTED_SQL), "counted")
    sets = written(counted.groupBy("batch").applyInArrow(_sets(bits, percent), SETS_SQL), "sets")
    discard(counted)
    some = sets.where("n > 0")
    classes = some.groupBy("sig").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n"))
    holders = some.where("prefix IS NOT NULL").select("sig", "doc_id", "prefix", "skip", "keys", "grades")
    # every batch that has a class has its n-grams: one of them is carried on, here and to the shuffle
    holders = holders.withColumn("at", F.coalesce("doc_id", F.lit(2**63 - 1)))
    first = holders.groupBy("sig").agg(F.min("at").alias("at"))
    holders = holders.join(first, ["sig", "at"], "left_semi").dropDuplicates(["sig"])
    classes = classes.join(holders.drop("doc_id", "at"), "sig", "left").withColumn("nid", F.monotonically_increasing_id())
    classes = written(classes, "classes")
    able = classes.where("prefix IS NOT NULL")

    grams = able.select("nid", "n", "skip", F.posexplode("prefix").alias("pos", "gram"))
    grams = grams.select("gram", "nid", "n", "skip", (F.col("skip") + F.col("pos")).alias("pos"))
    # the class with the fewest n-grams of its own is the likeliest source of the others
    many = grams.groupBy("gram").agg(F.count("*").alias("classes"), F.min_by(F.struct("nid", "n", "pos"), F.struct("skip", "nid")).alias("c")).where("classes > 1")
    grams = written(grams.join(many.select("gram", "c"), "gram").drop("skip"), "grams")

    def passes(n, m, i, j):
        most = 1 + F.least(n - i - 1, m - j - 1)
        return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (100 * most >= percent * (n + m - most))

    col = F.col
    stars = grams.where((col("nid") != col("c.nid")) & passes(col("n"), col("c.n"), col("pos"), col("c.pos")))
    stars = stars.groupBy(F.least("c.nid", "nid").alias("low"), F.greatest("c.nid", "nid").alias("high")).agg(F.min("c.nid").alias("x"))
    stars = written(stars.select("low", "high", "x", (col("low") + col("high") - col("x")).alias("y")), "stars")
    edges = written(_links(stars.select("x", "y"), able, percent), "links")
    labels = components(edges)
    placed = grams.join(labels, "nid", "left").withColumn("label", F.coalesce("label", "nid"))
    mixed = placed.groupBy("gram").agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a <> b").select("gram")
    # classes of unlike size never link: a size class meets itself and its neighbours only
    near = F.floor(F.log("n") / (1.001 * math.log(100 / min(percent, 99)))).cast("int")
    placed = placed.join(mixed, "gram", "left_semi").withColumn("size", near)
    # the component of the n-gram's first class needs no pairs within itself; all others meet all
    main = placed.where(col("nid") == col("c.nid")).select("gram", col("label").alias("main"))
    placed = written(placed.join(main, "gram").drop("c"), "placed")
    if placed.limit(1).count():
        more = written(_other_pairs(placed, able, percent, passes).join(stars.select(col("low").alias("x"), col("high").alias("y")), ["x", "y"], "left_anti"), "pairs")
        if more.limit(1).count():
            labels = components(written(_links(more, able, percent).union(edges), "links"))
        discard(more)
    for done in (grams, stars, placed):
        discard(done)

    named = classes.select("sig", "rep", "nid").join(labels, "nid", "left").withColumn("label", F.coalesce("label", "nid"))
    least = named.groupBy("label").agg(F.min("rep").alias("component_id"))
    named = named.join(least, "label").select("sig", "component_id")
    out = sets.select("doc_id", "n", "sig").join(named, "sig", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(col("n") > 0, col("component_id")).otherwise(col("doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """docs, all columns, with one row of each component: that of the smallest doc_id (null last), the first of equal ones.

    Rows with equal or null doc_id are told apart by a number of their own. Texts that are null
    or without words stay, all of them; an empty table gives an empty one.
    """
    ids = docs.groupBy("doc_id").count()
    if not ids.where("count > 1 OR doc_id IS NULL").limit(1).count():
        stay = jaccard_components(docs, words, percent).where("doc_id = component_id").select("doc_id")
        return docs.join(stay, "doc_id", "left_semi").select(docs.columns)
    names = [f"c{i}" for i in range(len(docs.columns))]
    own, text = (names[docs.columns.index(c)] for c in ("doc_id", "text"))
    rows = written(docs.toDF(*names).withColumn("row", F.monotonically_increasing_id()), "rows")
    found = jaccard_components(rows.select(F.col("row").alias("doc_id"), F.col(text).alias("text")), words, percent).select(F.col("doc_id").alias("row"), "component_id")
    turn = F.struct(F.col(own).isNull(), own, "row")
    stay = rows.select("row", own).join(found, "row").groupBy("component_id").agg(F.min_by("row", turn).alias("row"))
    return rows.join(stay, "row", "left_semi").select(*(F.col(n).alias(c) for n, c in zip(names, docs.columns, strict=True)))
