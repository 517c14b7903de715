"""BPE encoding and decoding with a contiguous rank array.

A short word is a row of parts (boundaries) beside the ranks of its adjacent pairs. The
row is scanned for the smallest rank, that boundary is deleted, the two neighbouring
ranks are looked up again, until no pair has a rank. numpy does this for all new words of
a batch at once; words beyond LONG bytes use a heap of pair ranks instead, since repeated
scans cost the square of the length.

Whole texts: no token of this vocabulary spans white space, so a text is cut there and
every chunk's ids are looked up in a bounded cache, one in each Python worker.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import re
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import id_text
from .words import SPACE as BYTE_SPACE
from .words import HashIndex, first_eight, hashes, joined, spans

LONG = 32
NO_RANK = np.int32(2**31 - 1)
CACHE_ENTRIES, CACHE_IDS = 700_000, 12_000_000
#: The vocabulary's splitting pattern, written with Unicode's own white space.
SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")
SPACE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")  # white space beyond ASCII
STOP, LETTER = np.zeros(256, bool), np.zeros(256, bool)
STOP[[ord("."), ord(",")]] = LETTER[ord("a") : ord("z") + 1] = True


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_chars() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, extra = {}, 0
    for b in range(256):
        if b in plain:
            out[b] = chr(b)
        else:
            out[b] = chr(256 + extra)
            extra += 1
    return [out[b] for b in range(256)]


class PairTable:
    """(left id, right id) -> rank, by open addressing in two flat arrays."""

    BITS = 20

    def __init__(self, keys: np.ndarray) -> None:
        size = 1 << self.BITS
        self.keys = np.full(size, -1, np.int64)
        self.ranks = np.full(size, NO_RANK, np.int32)
        todo, at = np.arange(len(keys)), self._slot(keys)
        while len(todo):
            free = self.keys[at] == -1
            first = np.unique(np.where(free, at, -1), return_index=True)
            won = first[1][first[0] >= 0]
            self.keys[at[won]] = keys[todo[won]]
            self.ranks[at[won]] = todo[won]
            lost = np.ones(len(todo), bool)
            lost[won] = False
            todo, at = todo[lost], at[lost]
            at = np.where(self.keys[at] == -1, at, (at + 1) & (size - 1))

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.BITS)).astype(np.int64)

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left.astype(np.int64) << 17) | right
        shape, keys = keys.shape, keys.ravel()
        at = self._slot(keys)
        there = self.keys[at]
        out = np.where(there == keys, self.ranks[at], NO_RANK)
        todo = np.flatnonzero((there != keys) & (there != -1))
        while len(todo):
            at[todo] = (at[todo] + 1) & ((1 << self.BITS) - 1)
            there = self.keys[at[todo]]
            hit = there == keys[todo]
            out[todo[hit]] = self.ranks[at[todo[hit]]]
            todo = todo[~hit & (there != -1)]
        return out.reshape(shape)


class WordBpe:
    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab = model["vocab"]
        end = model["end_of_word_suffix"] or ""
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.tokens = [""] * (1 + max([*vocab.values(), *(a["id"] for a in spec["added_tokens"])]))
        for token, i in vocab.items():
            self.tokens[i] = token
        for a in spec["added_tokens"]:
            self.tokens[a["id"]] = a["content"]
        if len(self.tokens) > 1 << 16:
            raise ValueError(f"{path}: {len(self.tokens)} tokens; ids are kept in 16 bits")
        self.special = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self.special_split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        chars = byte_chars()
        self.inner = np.array([vocab[c] for c in chars], np.int32)
        self.last = np.array([vocab[c + end] for c in chars], np.int32)
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        self.made = np.array([vocab[a + b] for a, b in merges], np.int32)
        self.pairs = PairTable((left << 17) | right)
        self.by_pair = {(int(a), int(b)): r for r, (a, b) in enumerate(zip(left, right, strict=True))}

    # -- words ---------------------------------------------------------------------

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, word after word, and the number of each word's."""
        raw = [w.encode("utf-8", "replace") for w in words]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        count = np.zeros(len(raw), np.int64)
        found: list[tuple[np.ndarray, np.ndarray]] = []  # words, and their ids in rows that end with -1
        low = 0
        for high in (6, 10, 16, LONG):
            which = np.flatnonzero((sizes > low) & (sizes <= high))
            low = high
            for start in range(0, len(which), 50_000):
                some = which[start : start + 50_000]
                self._scan([raw[i] for i in some], sizes[some], high, some, found, count)
        for i in np.flatnonzero(sizes > LONG):
            ids = self._heap(raw[i])
            count[i] = len(ids)
            found.append((np.array([i]), ids[None, :]))
        at = np.concatenate(([0], np.cumsum(count)))
        out = np.empty(at[-1], np.uint16)
        for rows, ids in found:
            for j in range(ids.shape[1]):
                there = np.flatnonzero(count[rows] > j)
                out[at[rows[there]] + j] = ids[there, j]
        return out, count

    def _scan(self, raw: list[bytes], sizes: np.ndarray, width: int, at: np.ndarray, found: list, total: np.ndarray) -> None:
        grid = np.frombuffer(b"".join(b.ljust(width, b"\0") for b in raw), np.uint8).reshape(-1, width)
        cols = np.arange(width)
        parts = np.where(cols == sizes[:, None] - 1, self.last[grid], self.inner[grid])
        parts[cols >= sizes[:, None]] = -1
        ranks = np.full(parts.shape, NO_RANK, np.int32)  # ranks[:, j]: parts j and j + 1
        there = parts[:, 1:] >= 0
        ranks[:, :-1][there] = self.pairs.get(parts[:, :-1][there], parts[:, 1:][there])
        rows, count = at, sizes.copy()
        while True:
            pos = ranks.argmin(1)
            best = ranks[np.arange(len(rows)), pos]
            live = best < NO_RANK
            if not live.all():
                total[rows[~live]] = count[~live]
                found.append((rows[~live], parts[~live]))
                if not live.any():
                    return
                rows, count, parts, ranks, pos, best = rows[live], count[live], parts[live], ranks[live], pos[live], best[live]
            n = np.arange(len(rows))
            width = int(count.max())  # what is left of the longest word
            cols = np.arange(width - 1)
            parts[n, pos] = self.made[best]
            parts = np.take_along_axis(parts[:, :width], cols + (cols > pos[:, None]), 1)
            ranks = np.take_along_axis(ranks[:, :width], cols + (cols >= pos[:, None]), 1)
            count = count - 1
            parts[cols >= count[:, None]] = -1
            ranks[cols >= count[:, None] - 1] = NO_RANK
            for shift in (0, -1):
                j = pos + shift
                ok = np.flatnonzero((j >= 0) & (j + 1 < count))
                ranks[ok, j[ok]] = self.pairs.get(parts[ok, j[ok]], parts[ok, j[ok] + 1])

    def _heap(self, raw: bytes) -> np.ndarray:
        part = self.inner[np.frombuffer(raw, np.uint8)].tolist()
        part[-1] = int(self.last[raw[-1]])
        n = len(part)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, i, part[i], part[i + 1]) for i in range(n - 1) if (r := self.by_pair.get((part[i], part[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if part[i] != a or j >= n or part[j] != b:
                continue
            part[i], part[j] = int(self.made[rank]), -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (r := self.by_pair.get((part[x], part[y]))) is not None:
                    heapq.heappush(heap, (r, x, part[x], part[y]))
        return np.array([p for p in part if p >= 0], np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """This vocabulary has no decoder of its own: tokens joined by one space."""
        return " ".join(map(self.tokens.__getitem__, ids.tolist()))


class TextEncoder:
    """Whole texts to ids, with a cache of chunks that is emptied when it is full."""

    def __init__(self, path: str) -> None:
        self.bpe = WordBpe(path)
        self._clear()

    def _clear(self) -> None:
        self.index = HashIndex(18)
        self.flat = np.empty(1 << 18, np.uint16)
        self.used = 0
        self.offset, self.size = np.empty(1 << 17, np.int64), np.empty(1 << 17, np.int64)

    def normal(self, text: str) -> str:
        """NFC, white space to spaces, each character lower-cased alone (no final sigma)."""
        if not text.isascii():
            text = SPACE.sub(" ", unicodedata.normalize("NFC", text)).replace("Σ", "σ")
        return text.lower()

    def _learn(self, key: np.ndarray, check: np.ndarray, chunks: list[bytes]) -> None:
        pieces = [(c.decode(),) if c.isalpha() else SPLIT.findall(c.decode("utf-8", "replace")) for c in chunks]
        words = list(dict.fromkeys(w for p in pieces for w in p))
        number = dict(zip(words, range(len(words)), strict=True))
        flat, count = self.bpe.encode_words(words)
        ids, sizes = gathered(flat, np.concatenate(([0], np.cumsum(count)))[:-1], count, np.array([number[w] for p in pieces for w in p], np.int64))
        upto = np.concatenate(([0], np.cumsum(sizes)))
        bounds = upto[np.concatenate(([0], np.cumsum([len(p) for p in pieces])))]
        k, n = self.index.n, len(chunks)
        while k + n > len(self.offset):
            self.offset, self.size = np.resize(self.offset, 2 * len(self.offset)), np.resize(self.size, 2 * len(self.size))
        while self.used + len(ids) > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        self.flat[self.used : self.used + len(ids)] = ids
        self.offset[k : k + n], self.size[k : k + n] = bounds[:-1] + self.used, np.diff(bounds)
        self.used += len(ids)
        self.index.add(key, check)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids as uint16 and where each text's begin (one more entry than texts)."""
        if self.bpe.special_split is not None and any(t and any(s in t for s in self.bpe.special) for t in texts):
            return self._with_special(texts)
        if self.index.n > CACHE_ENTRIES or self.used > CACHE_IDS:
            self._clear()
        buf, at = joined([self.normal(t).encode("utf-8", "replace") if t else b"" for t in texts])
        starts, ends = spans(~BYTE_SPACE[buf])
        # a full stop or comma that ends a chunk after a letter is a token of its own
        tail = np.flatnonzero((ends - starts > 1) & STOP[buf[ends - 1]] & LETTER[buf[ends - 2]])
        starts, ends = np.insert(starts, tail + 1, ends[tail] - 1), np.insert(ends, tail, ends[tail] - 1)
        key, check = hashes(buf, starts, ends), first_eight(buf, starts, ends)
        which = self.index.get(key, check)
        new = np.flatnonzero(which < 0)
        raw = buf.tobytes() if len(new) else b""
        while len(new):  # again only where two chunks have one hash
            _, first = np.unique(key[new], return_index=True)
            first = new[first]
            self._learn(key[first], check[first], [raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)])
            which[new] = self.index.get(key[new], check[new])
            new = new[which[new] < 0]
        ids, sizes = gathered(self.flat, self.offset, self.size, which)
        return ids, np.concatenate(([0], np.cumsum(sizes)))[np.searchsorted(starts, at)]

    def _with_special(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The same where special tokens may stand in a text: they are found before all else."""
        pieces = [(k, p) for k, t in enumerate(texts) if t for p in self.bpe.special_split.split(t)]
        plain = [p for _, p in pieces if p not in self.bpe.special]
        special, self.bpe.special_split = self.bpe.special_split, None
        try:
            ids, at = self.encode(plain)
        finally:
            self.bpe.special_split = special
        out, ends, done = [], np.zeros(len(texts) + 1, np.int64), 0
        for k, p in pieces:
            if p in self.bpe.special:
                out.append(np.array([self.bpe.special[p]], np.uint16))
            else:
                out.append(ids[at[done] : at[done + 1]])
                done += 1
            ends[k + 1] += len(out[-1])
        return np.concatenate(out) if out else np.empty(0, np.uint16), np.cumsum(ends)


def gathered(flat: np.ndarray, offset: np.ndarray, size: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of flat that which names, one after another, and their sizes."""
    sizes = size[which]
    upto = np.concatenate(([0], np.cumsum(sizes)))
    return flat[np.repeat(offset[which] - upto[:-1], sizes) + np.arange(upto[-1])], sizes


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> TextEncoder:
    """One per Python worker."""
    return TextEncoder(path)


def encoded(batches, path: str, most_chars: int = 2_000_000):
    """Of Arrow batches with doc_id and text: (doc ids, ids, offsets), at most about most_chars at once."""
    enc = encoder(path)
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1).to_pylist()
        start = 0
        while start < len(texts):
            stop, chars = start, 0
            while stop < len(texts) and (stop == start or chars + len(texts[stop] or "") <= most_chars):
                chars += len(texts[stop] or "")
                stop += 1
            yield ids[start:stop], *enc.encode(texts[start:stop])
            start = stop


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids (array of int) and decoded text of every whole text.

    Null text: empty, no ids, decoded ''. Repeated rows stay, each with its own result.
    An empty table gives an empty one. Other columns are ignored.
    """
    path = path or vocabulary_path()

    def run(batches):
        enc = encoder(path)
        for doc_ids, ids, at in encoded(batches, path):
            rows = [ids[a:b].astype(np.int32) for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.record_batch([doc_ids, pa.array(rows, pa.list_(pa.int32())), pa.array([enc.bpe.decode(r) for r in rows], pa.string())], names=["doc_id", "ids", "decoded"])

    return id_text(docs).mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def decode_documents(encoded_docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and the text of its ids (null ids: '')."""
    path = path or vocabulary_path()

    def run(batches):
        enc = encoder(path)
        for b in batches:
            texts = [enc.bpe.decode(np.asarray(x or [], np.int64)) for x in b.column(1).to_pylist()]
            yield pa.record_batch([b.column(0), pa.array(texts, pa.string())], names=["doc_id", "decoded"])

    return encoded_docs.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded string")


def document_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per document: doc_id, n_tokens, sha256 of its decimal ids and of the text decoded from them.

    Null text: empty, no tokens. Repeated rows and null ids each have their row; an empty
    table gives an empty one.
    """
    path = path or vocabulary_path()

    def run(batches):
        enc = encoder(path)
        decimal = [str(i) for i in range(len(enc.bpe.tokens))]
        for doc_ids, ids, at in encoded(batches, path):
            n, a, b = [], [], []
            for lo, hi in zip(at[:-1], at[1:], strict=True):
                own = ids[lo:hi]
                n.append(hi - lo)
                a.append(hashlib.sha256(" ".join(map(decimal.__getitem__, own.tolist())).encode()).hexdigest())
                b.append(hashlib.sha256(enc.bpe.decode(own).encode()).hexdigest())
            yield pa.record_batch([doc_ids, pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return id_text(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def ids_crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())
