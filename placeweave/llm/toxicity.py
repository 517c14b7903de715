"""Toxicity with noisy-channel deobfuscation.

Suspicious tokens (letters mixed with look-alike signs, characters spaced out, letters
repeated) become lattices of characters: a sign may stand for a letter, a repeated letter
for one, a separator for nothing or for the end of a word, each at a price. Viterbi decoding
under a trigram model of the characters of all documents and the learned words restores the
likeliest words. A token without signs, separators or doubled letters has one path, itself;
one with doubled letters is decoded where it could say a learned word, which then has the
same letters once repeats are taken out.

Restored and plain words give two figures: the sum of the log odds of strong words (whole
words, else their longest strong beginning), each once, and the mean log odds, of both
signs, of all words that the labelled rows know. A logistic model weighs the two. Both are
learned from at most MAX_TRAIN labelled rows, whose own part in the odds is left out when
the logistic model is fitted.
"""

from __future__ import annotations

import collections
import functools
import math
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, discard, id_text, in_slices, written
from .words import HashIndex, first_eight, hashes, joined, mix, spans

MAX_TRAIN = 8000
#: Word beginnings that serve as features, in bytes.
BEGINNINGS = (4, 5, 6, 7)
SURPRISE, LEAST_ODDS = 16.0, 1.0
#: Log odds of a word count up to here, and so do those of all strong words together: one sure word is enough.
SURE = 8.0
#: Entries of the decoder's memory, which is emptied when it is full.
REMEMBERED = 50_000
#: Characters of texts that are worked on at once.
SLICE = 500_000
#: Labelled rows that must have a word, for its odds of either sign to count.
KNOWN = 5
#: Signs and the letters that they may stand for.
LOOKALIKES = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "*": "aeiou"}
#: Signs of several characters, longest first; each becomes one private character.
DRAWN = {"\\/\\/": "w", "|-|": "h", "|_|": "u", "()": "o", "|<": "k", "/\\": "a", "\\/": "v"}
PRIVATE = {sign: chr(0xE010 + k) for k, sign in enumerate(DRAWN)}
LOOKALIKES |= {PRIVATE[sign]: letter for sign, letter in DRAWN.items()}
#: From here on scripts have no alphabet; their characters count as one in the character model.
ONE_CLASS = "\u2e80"
SEPARATORS = " .-_*~/,'\"^\n\r\t\v\f"
SWAP, SKIP_SEPARATOR, SKIP_REPEAT, KEEP_SIGN, END_WORD, LEARNED = 1.0, 0.3, 0.4, 6.0, 1.0, 0.5

WORD_BYTE = np.array([97 <= b <= 122 or b >= 128 for b in range(256)])
#: Signs that stand for letters; of those beyond ASCII the last byte.
SIGN_BYTE = np.isin(np.arange(256), [c.encode()[-1] for c in LOOKALIKES])
DOUBLED = re.compile(rb"([a-z])\1+")
FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_sign = re.escape("".join(LOOKALIKES))
_single = rf"(?:[^\W_]|[{_sign.replace(re.escape('*'), '')}])"
#: A run of letters and look-alike signs with at least one sign; three of one letter in a row; characters one by one.
MIXED = re.compile(rf"(?<![^\W_{_sign}])(?<![{_sign}])[^\W\d_]*+[{_sign}](?:[^\W_]|[{_sign}])*+")
REPEATED = re.compile(r"([^\W\d_])\1\1")
SPACED = re.compile(rf"(?<!{_single}){_single}(?:[{re.escape(SEPARATORS)}]++{_single}(?!{_single})){{2,}}+")
#: Signs that may be punctuation at a token's ends: first those that seldom stand for a letter there.
EDGES = "!|(+*", "".join(c for c in LOOKALIKES if not c.isdigit())


@dataclass
class CharModel:
    """Trigram log prices of characters, mixed with bigrams, '^' before and '$' after a word; learned words and beginnings as a tree."""

    counts: dict[str, int] = field(default_factory=dict)
    #: By node: the next nodes by character, its last two characters, whether a word and whether a beginning ends there.
    tree: list[tuple[dict[str, int], str, list[bool]]] = field(default_factory=lambda: [({}, "^", [False, False])])
    learned: int = 0
    #: Prices and restored tokens so far; memory only.
    prices: dict[str, float] = field(default_factory=dict, repr=False)
    said: dict[str, str] = field(default_factory=dict, repr=False)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"prices": {}, "said": {}}

    @functools.cached_property
    def sums(self) -> dict[str, int]:
        """Counts of pairs, and of the contexts of one and two characters (marked by a trailing space)."""
        out: dict[str, int] = collections.Counter()
        for t, n in self.counts.items():
            out[t[1:]] += n
            out[t[1] + " "] += n
            out[t[:2] + " "] += n
            if t[0] == "^":
                out[t[:2]] += n
                out["^ "] += n
        return dict(out)

    def learn(self, words: list[str]) -> None:
        """Words, and beginnings marked by a leading space, that the decoder knows as such."""
        for w in words:
            at = 0
            for c in w.strip():
                if c not in self.tree[at][0]:
                    self.tree[at][0][c] = len(self.tree)
                    self.tree.append(({}, self.tree[at][1][-1] + c, [False, False]))
                at = self.tree[at][0][c]
            self.tree[at][2][w.startswith(" ")] = True
        self.learned += len(words)

    def price(self, before: str, c: str) -> float:
        """Of c after one ('^') or two characters."""
        out = self.prices.get(before + c)
        if out is None:
            out = self.prices[before + c] = self._price("".join(min(x, ONE_CLASS) for x in before), min(c, ONE_CLASS))
        return out

    def _price(self, before: str, c: str) -> float:
        have = self.sums
        one = (have.get(before[-1] + c, 0) + 0.1) / (have.get(before[-1] + " ", 0) + 10.0)
        if len(before) < 2:
            return -math.log(one)
        return -math.log((self.counts.get(before + c, 0) + 4 * one) / (have.get(before + " ", 0) + 4))


def char_model(docs: DataFrame) -> CharModel:
    """Counts of three characters in a row in the words of all documents; what reaches the driver is bounded by the alphabets."""
    many = ord(ONE_CLASS) + 1

    def run(batches):
        letter = np.array([chr(c).isalpha() for c in range(many)])
        letter[-1] = True
        total = collections.Counter()
        for b in batches:
            texts = b.column(0).to_pylist()
            for low, high in in_slices(texts, SLICE):
                raw = "\n".join(["", *texts[low:high], ""]).lower().encode("utf-32-le", "replace")
                chars = np.minimum(np.frombuffer(raw, "<u4"), many - 1)
                chars = np.where(letter[chars], chars, 0)
                used = np.flatnonzero(np.bincount(chars, minlength=many))
                place = np.zeros(many, np.int64)
                place[used] = np.arange(len(used))
                at = place[chars]
                threes = ((at[:-2] * len(used) + at[1:-1]) * len(used) + at[2:])[chars[1:-1] > 0]
                if len(used) <= 120:
                    n = np.bincount(threes, minlength=len(used) ** 3)
                    threes = np.flatnonzero(n)
                    n = n[threes]
                else:
                    threes, n = np.unique(threes, return_counts=True)
                x, y, w = threes // len(used) ** 2, threes // len(used) % len(used), threes % len(used)
                for *key, k in zip(used[x].tolist(), used[y].tolist(), used[w].tolist(), n.tolist(), strict=True):
                    total[tuple(key)] += k
        cols = [pa.array([t[i] for t in total], pa.int32()) for i in range(3)]
        yield pa.record_batch([*cols, pa.array(list(total.values()), pa.int64())], names=["a", "b", "c", "n"])

    rows = id_text(docs).select("text").mapInArrow(run, "a int, b int, c int, n long").groupBy("a", "b", "c").agg(F.sum("n")).toArrow()
    return CharModel({(chr(x) if x else "^") + chr(y) + (chr(w) if w else "$"): n for x, y, w, n in zip(*(c.to_pylist() for c in rows.columns), strict=True)})


def restore(token: str, model: CharModel) -> str:
    """The cheapest words for a token; letters are kept, or dropped where they repeat the last one.

    A state is the last two characters of a word outside the tree, '^' before a word, or a node
    of the tree; a learned word costs the same whichever it is, and no more for its characters.
    Gaps wider than the token's narrowest end a word at no price.
    """
    token = token.lower()
    gaps = [len(g) for g in re.findall(rf"[{re.escape(SEPARATORS)}]+", token)]
    least, gap = min(gaps, default=0), iter(gaps)
    enter = LEARNED + math.log(max(model.learned, 1))
    best: dict[str | int, tuple[float, tuple | None]] = {"^": (0.0, None)}
    wide, between = False, False
    for ch in token:
        if ch in SEPARATORS:
            wide = wide if between else next(gap) > least
            between = True
        else:
            between = False
        choices = [(c, SWAP) for c in LOOKALIKES.get(ch, "")]
        if ch.isalpha():
            choices.append((ch, 0.0))
        elif ch not in SEPARATORS:
            choices.append((ch, KEEP_SIGN))
        after: dict[str | int, tuple[float, tuple | None]] = {}

        def put(state, price, trail, after=after):
            if state not in after or price < after[state][0]:
                after[state] = price, trail

        for state, (price, trail) in best.items():
            inside = isinstance(state, int)
            nexts, last, (whole, begins) = model.tree[state if inside else 0]
            last = last if inside else state
            for c, extra in choices:
                if not inside or begins:
                    put(last[-1] + c, price + extra + model.price(last, c), (trail, c))
                if c in nexts and (inside or state == "^"):
                    put(nexts[c], price + extra + (0.0 if inside else enter), (trail, c))
                if c == last[-1]:
                    put(state, price + extra + SKIP_REPEAT, trail)
            if ch in SEPARATORS:
                put(state, price + SKIP_SEPARATOR, trail)
                if state != "^" and (not inside or whole or begins):
                    ends = 0.0 if whole else model.price(last, "$")
                    put("^", price + ends + (0.0 if wide else END_WORD), (trail, " "))
        best = after or best
    ended = []
    for state, (price, trail) in best.items():
        _, last, (whole, begins) = model.tree[state if isinstance(state, int) else 0]
        if not isinstance(state, int):
            ended.append((price + (model.price(state, "$") if state != "^" else 0.0), str(state), trail))
        elif whole or begins:
            ended.append((price + (0.0 if whole else model.price(last, "$")), last, trail))
    trail, out = min(ended, key=lambda e: e[:2])[2], []
    while trail:
        trail, c = trail
        out.append(c)
    return "".join(reversed(out)).strip()


def fold(text: str) -> bytes:
    return (text if text.isascii() else text.lower()).encode("utf-8", "replace").translate(FOLD)


def suspects(buf: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which texts of a joined buffer may hold a suspicious token; the others are not searched."""
    letter, sign = WORD_BYTE[buf], SIGN_BYTE[buf]
    where = [np.flatnonzero((sign[:-1] & letter[1:]) | (letter[:-1] & sign[1:]))]
    where.append(np.flatnonzero(letter[2:] & (buf[2:] == buf[1:-1]) & (buf[1:-1] == buf[:-2])))
    where.append(np.flatnonzero((buf[4:] >= 128) & (buf[4:] == buf[2:-2]) & (buf[2:-2] == buf[:-4])))  # two bytes a letter
    starts, ends = spans((letter | sign) & (buf != 42))
    lead, size = buf[starts], ends - starts
    alone = (size == 1) | ((size == 2) & (lead >= 0xC2)) | ((size == 3) & (lead >= 0xE0))
    where.append(starts[:-2][alone[:-2] & alone[1:-1] & alone[2:]] if len(starts) > 2 else starts[:0])
    out = np.zeros(len(at) - 1, bool)
    out[np.searchsorted(at, np.concatenate(where), "right") - 1] = True
    return out


def candidates(text: str) -> list[str]:
    """The suspicious tokens of a text; one that may have punctuation around or inside it stands with and without."""
    out = [m[0] for m in SPACED.finditer(text) if any(map(str.isalpha, m[0]))]
    end = 0
    for m in MIXED.finditer(text):
        if any(map(str.isalpha, m[0])):
            out.extend(w for w in dict.fromkeys((m[0], *map(m[0].strip, EDGES))) if len(w) > 1 and not w.isalpha())
            if m.start() >= end:  # with what stands beside it up to the next space
                start, end = m.span()
                while start and not text[start - 1].isspace():
                    start -= 1
                while end < len(text) and not text[end].isspace():
                    end += 1
                if (start, end) != m.span():
                    out.append(text[start:end])
    end = 0
    for m in REPEATED.finditer(text):
        if m.start() >= end:
            start, end = m.span()
            while start and text[start - 1].isalpha():
                start -= 1
            while end < len(text) and text[end].isalpha():
                end += 1
            out.append(text[start:end])
    return out


def restored_words(text: str, model: CharModel) -> list[str]:
    """What the suspicious tokens of a text most likely say."""
    out = []
    if len(model.said) > REMEMBERED or len(model.prices) > REMEMBERED:
        model.said.clear()
        model.prices.clear()
    for c in dict.fromkeys(candidates(text)):
        if (w := model.said.get(c)) is None:
            w = restore(c, model)
            if len(c) < 64:
                model.said[c] = w
        if w and w != c.lower():
            out.append(w)
    return out


def squeezed(word: bytes) -> bytes:
    return DOUBLED.sub(rb"\1", word)


def spelled(text: str) -> str:
    """Signs of several characters as one private character each."""
    for sign, one in PRIVATE.items():
        if sign in text:
            text = text.replace(sign, one)
    return text


@dataclass
class Model:
    words: list[bytes]  # strong whole words, and beginnings marked by a leading space
    bad: np.ndarray  # labelled rows of either kind that have each
    good: np.ndarray
    known: tuple[np.ndarray, np.ndarray]  # hash and first eight bytes of every known word
    known_bad: np.ndarray
    known_good: np.ndarray
    rows: tuple[int, int]  # labelled rows: toxic, others
    weights: np.ndarray  # of the sum, of the mean, and the offset
    chars: CharModel

    def odds(self, bad: np.ndarray, good: np.ndarray, toxic: int | None = None) -> np.ndarray:
        """Log odds; toxic: without a row of that label that has the word."""
        a, b = (toxic == 1), (toxic == 0)
        return np.clip(np.log((np.maximum(bad - a, 0) + 0.5) / (self.rows[0] - a + 1)) - np.log((np.maximum(good - b, 0) + 0.5) / (self.rows[1] - b + 1)), -SURE, SURE)

    @functools.cached_property
    def lookup(self):
        whole = [w for w in self.words if not w.startswith(b" ")]
        buf, at = joined(whole)
        index = HashIndex()
        index.add(hashes(buf, at[:-1], at[1:] - 1), first_eight(buf, at[:-1], at[1:] - 1))
        number = self.number
        starts = {}
        for size in sorted(BEGINNINGS, reverse=True):
            mine = sorted((int.from_bytes(w[1:], "little"), number[w]) for w in self.words if w.startswith(b" ") and len(w) == size + 1)
            starts[size] = np.array([k for k, _ in mine], np.uint64), np.array([v for _, v in mine], np.int64)
        known = HashIndex(max(16, int(4 * len(self.known[0])).bit_length()))
        known.add(*self.known)
        return index, np.array([number[w] for w in whole], np.int64), starts, known

    @functools.cached_property
    def number(self) -> dict[bytes, int]:
        return {w: k for k, w in enumerate(self.words)}

    @functools.cached_property
    def plain(self) -> frozenset[bytes]:
        """Strong words and beginnings without repeats, beginnings as they stand in a word without repeats."""
        return frozenset(squeezed(w) for w in self.words)

    def figures(self, texts: list[str], toxic: list[int] | None = None) -> np.ndarray:
        """Two columns a text: the sum and the mean; toxic: labels of texts that were learned from."""
        out = []
        which = [None] if toxic is None else [0, 1]
        strong = {y: self.odds(self.bad, self.good, y) for y in which}
        weak = {y: self.odds(self.known_bad, self.known_good, y) for y in which}
        for a, z in in_slices(texts, SLICE):
            (doc, feature), (doc_k, feature_k) = hits(texts[a:z], self)
            label = np.full(z - a, -1) if toxic is None else np.array(toxic[a:z])
            total, mean = np.zeros(z - a), np.zeros(z - a)
            for y in which:
                mine = label == (-1 if y is None else y)
                total += np.where(mine, np.bincount(doc, strong[y][feature], z - a), 0.0)
                mean += np.where(mine, np.bincount(doc_k, weak[y][feature_k], z - a), 0.0)
            out.append(np.stack([np.clip(total, -SURE, SURE), mean / np.maximum(np.bincount(doc_k, minlength=z - a), 1)], 1))
        return np.concatenate(out) if out else np.empty((0, 2))

    def scores(self, texts: list[str]) -> np.ndarray:
        z = self.figures(texts) @ self.weights[:2] + self.weights[2]
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def hits(texts: list[str], m: Model) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """(text, number) of the strong features of each text's different words, and of every known word, restored words included."""
    texts = [spelled(t) for t in texts]
    raw = [fold(t) for t in texts]
    for k in np.flatnonzero(suspects(*joined(raw))).tolist():
        if more := restored_words(texts[k], m.chars):
            raw[k] += b"\n" + fold(" ".join(more))
    buf, at = joined(raw)
    index, numbers, beginnings, known = m.lookup
    starts, ends = spans(WORD_BYTE[buf])
    h, head = hashes(buf, starts, ends), first_eight(buf, starts, ends)
    whole = index.get(h, head)
    feature = np.where(whole >= 0, np.append(numbers, -1)[whole], -1)
    for size, (keys, values) in beginnings.items():  # longest first
        if len(keys):
            part = np.where((feature < 0) & (ends - starts >= size), head & np.uint64((1 << (8 * size)) - 1), np.uint64(0))
            k = np.minimum(np.searchsorted(keys, part), len(keys) - 1)
            feature = np.where(keys[k] == part, values[k], feature)
    doc = np.searchsorted(at, starts, "right") - 1
    twice = np.flatnonzero((buf[1:] == buf[:-1]) & (buf[1:] >= 97) & (buf[1:] <= 122))
    there = np.unique(np.searchsorted(starts, twice, "right") - 1)
    there = there[feature[there] < 0] if len(starts) else there
    _, first, inverse = np.unique(h[there], return_index=True, return_inverse=True)
    said = np.array([_doubled(buf[starts[i] : ends[i]].tobytes(), m) for i in there[first].tolist()], np.int64)
    feature[there] = said[inverse] if len(there) else feature[there]
    strong = np.flatnonzero(feature >= 0)
    once = np.unique(np.stack([doc[strong], feature[strong], h[strong].view(np.int64)]), axis=1) if len(strong) else np.empty((3, 0), np.int64)
    seen = known.get(h, head)
    some = np.flatnonzero(seen >= 0)
    return (once[0], once[1]), (doc[some], seen[some])


def _doubled(word: bytes, m: Model) -> int:
    """The strong feature of what a word with doubled letters most likely says, or -1."""
    short = squeezed(word)
    if short not in m.plain and not any(b" " + short[:k] in m.plain for k in range(2, max(BEGINNINGS) + 1)):
        return -1
    said = restore(word.decode("utf-8", "ignore"), m.chars).encode()
    for w in (said, *(b" " + said[:k] for k in sorted(BEGINNINGS, reverse=True) if len(said) >= k)):
        if w in m.number:
            return m.number[w]
    return -1


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN) -> Model:
    """Fit on documents joined with labels (doc_id, toxic 0 or 1); without both kinds: a model that scores 0.

    Labels with a null id or mark are left out; of several marks of an id the largest counts.
    At most max_rows labels are taken, by a hash of the id, so the tables' layout does not
    matter. Of near copies of one label one row counts.
    """
    turn = F.xxhash64(F.col("doc_id").cast("string"), F.lit("toxic"))
    marks = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    share = min(1.0, 1.1 * max_rows / max(marks.count(), 1))
    marks = marks.withColumn("turn", turn).where(F.pmod("turn", F.lit(1_000_000)) < int(share * 1_000_000)).orderBy("turn", "doc_id").limit(max_rows)
    rows = written(id_text(docs).join(F.broadcast(marks), "doc_id"), "labelled")  # at most max_rows pairs of numbers are sent

    def words(batches):
        for b in (b[low:high] for b in batches for low, high in in_slices(b.column(0).to_pylist(), SLICE)):
            out, kin = [], []
            for t in b.column(0).to_pylist():
                buf = np.frombuffer(fold(t) + b" ", np.uint8)
                s, e = spans(WORD_BYTE[buf])
                raw = buf.tobytes()
                h = hashes(buf, s, e)
                runs = h[2:] * np.uint64(3) + h[1:-1] * np.uint64(5) + h[:-2] if len(h) > 2 else h
                kin.append([int(mix(runs ^ np.uint64(seed)).min() >> np.uint64(1)) if len(runs) else 0 for seed in (1, 2, 3)] + [len(h) if len(h) < 3 else 3])
                out.append(sorted({raw[x:y] for x, y in zip(s.tolist(), e.tolist(), strict=True)}))
            yield pa.record_batch([b.column(1), b.column(2), pa.array(out, pa.list_(pa.binary())), pa.array(kin, pa.list_(pa.int64()))], names=["toxic", "turn", "words", "kin"])

    sets = rows.select("text", "toxic", "turn").mapInArrow(words, "toxic int, turn long, words array<binary>, kin array<long>")
    # near copies have the same least hashes of three words in a row, or are the same words where those are fewer
    sets = sets.groupBy("toxic", "kin").agg(F.min_by("words", F.struct("turn", "words")).alias("words"))
    sets = written(sets.withColumn("row", F.monotonically_increasing_id()), "words")
    n = {r["toxic"]: r["count"] for r in sets.groupBy("toxic").count().collect()}
    if not n.get(0) or not n.get(1):
        no = np.zeros(0)
        return Model([], no, no, (no.astype(np.uint64),) * 2, no, no, (0, 0), np.array([0.0, 0.0, -40.0]), CharModel())
    flat = sets.select("row", "toxic", F.explode("words").alias("word"))
    starts = [flat.where(F.length("word") >= k).select("row", "toxic", F.concat(F.lit(b" "), F.substring("word", 1, k)).alias("word")).distinct() for k in BEGINNINGS]
    both = functools.reduce(DataFrame.unionByName, [flat, *starts])
    tallies = written(both.groupBy("word").agg(F.sum("toxic").alias("bad"), F.count("*").alias("all")).where("all >= 3"), "tallies")
    # Strong: in at least 3 toxic rows, and more than chance gives among so many words: the rows' divergence from the
    # share of toxic ones exceeds SURPRISE.
    good = F.col("all") - F.col("bad")
    odds = F.log((F.col("bad") + 0.5) / (n[1] + 1)) - F.log((good + 0.5) / (n[0] + 1))
    base = n[1] / (n[0] + n[1])
    diverges = F.col("bad") * F.log(F.col("bad") / (F.col("all") * base)) + F.when(good > 0, good * F.log(good / (F.col("all") * (1 - base)))).otherwise(0.0)
    picked = tallies.where((F.col("bad") >= 3) & (odds >= LEAST_ODDS) & (diverges >= SURPRISE)).orderBy(F.desc("bad"), "word").toArrow()
    known = tallies.where((F.col("all") >= KNOWN) & (F.substring("word", 1, 1) != F.lit(b" "))).orderBy("word").toArrow()
    buf, at = joined(known["word"].to_pylist())
    keys = hashes(buf, at[:-1], at[1:] - 1), first_eight(buf, at[:-1], at[1:] - 1)
    count = lambda some, c: some[c].to_numpy().astype(float)
    model = Model(picked["word"].to_pylist(), count(picked, "bad"), count(picked, "all") - count(picked, "bad"), keys, count(known, "bad"), count(known, "all") - count(known, "bad"), (n[1], n[0]), np.zeros(3), char_model(docs))
    model.chars.learn([w.decode("utf-8", "ignore") for w in model.words])

    def numbers(batches):
        for b in batches:
            got = model.figures(b.column(0).to_pylist(), b.column(1).to_pylist())
            yield pa.record_batch([b.column(1), pa.array(got[:, 0]), pa.array(got[:, 1])], names=["toxic", "total", "mean"])

    got = rows.select("text", "toxic").mapInArrow(numbers, "toxic int, total double, mean double").orderBy("toxic", "total", "mean").toArrow()  # at most max_rows and repeated rows
    y, total, mean = (np.array(got[c].to_pylist(), float) for c in ("toxic", "total", "mean"))
    model.weights = logistic(np.stack([total, mean, np.ones(len(y))], 1), y)
    discard(rows)
    return model


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.01, rounds: int = 50) -> np.ndarray:
    """Weights by Newton's method; a ridge on all but the last, the offset; weights of the figures are not negative."""
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        slope = x.T @ (p - y) + penalty * w
        bend = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9)
        w = w - np.clip(np.linalg.solve(bend, slope), -1.0, 1.0)
    w[:-1] = np.maximum(w[:-1], 0.0)
    return w


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every whole text; null and empty texts get what a text without any known word gets.

    Null and repeated ids each have their row; an empty table has none.
    """

    def run(batches):
        for b in batches:
            yield pa.record_batch([b.column(0), pa.array(model.scores(b.column(1).to_pylist()), pa.float64())], names=["doc_id", "score"])

    return id_text(docs).mapInArrow(run, "doc_id long, score double")


def score_held_out(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Learn from labels outside fold 1 of 3 and score all documents: doc_id, held_out (null for a null id), score, predicted."""
    model = train(docs, labels.where(crc_mod(3) != 1))
    return score(docs, model).select("doc_id", (crc_mod(3) == 1).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """docs, all columns, without those that score threshold or more; null texts are scored as empty ones."""
    where = docs.columns.index("text")

    def run(batches):
        for b in batches:
            yield b.filter(pa.array(model.scores([t or "" for t in b.column(where).to_pylist()]) < threshold, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
