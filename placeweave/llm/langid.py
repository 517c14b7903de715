"""Language ID by sparse multinomial logistic regression on TF-IDF character n-grams.

Trained with follow-the-regularised-leader (per-coordinate rates, L1 and L2 penalties),
then one temperature is fitted on rows that training didn't see. Training takes at most
MAX_TRAIN labelled rows, chosen by a hash of their ids; prediction reads whole texts.
"""

from __future__ import annotations

import collections
import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, id_text

FEATURES = 1 << 13
MAX_TRAIN = 4000
#: Rows that the sample takes of a label, where it has as many.
LEAST = 50
ORDERS = (1, 2, 3)
UND = "und"


@functools.lru_cache(maxsize=1)
def letter_table() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def ngram_counts(text: str) -> np.ndarray | None:
    """Counts of hashed character n-grams, lower-cased, all but letters as one gap; None without a letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    letter = letter_table()[points]
    if not letter.any():
        return None
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # one gap after each run of letters
    c = np.where(letter, points, 32)[keep].astype(np.uint32)
    c = np.concatenate((np.array([32], np.uint32), c))
    out = np.zeros(FEATURES, np.int64)
    h = np.zeros(len(c), np.uint32)
    for n in range(1, max(ORDERS) + 1):
        m = len(c) - n + 1
        if m <= 0:
            break
        h = (h[:m] + c[n - 1 :]) * np.uint32(0x9E3779B1)
        h = h ^ (h >> np.uint32(15))
        if n in ORDERS:
            out += np.bincount(((h * np.uint32(0x85EBCA77)) >> np.uint32(32 - 13)).astype(np.int64), minlength=FEATURES)
    return out


@dataclass
class Model:
    classes: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float

    def vector(self, counts: np.ndarray) -> np.ndarray:
        return scaled(counts, self.idf)

    def predict(self, text: str) -> tuple[str, float]:
        counts = ngram_counts(text) if text else None
        if counts is None or not self.classes:
            return UND, 0.0
        p = softmax((self.vector(counts) @ self.weights + self.bias) / self.temperature)
        k = int(p.argmax())
        return self.classes[k], float(p[k])


def scaled(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts) * idf
    norm = np.sqrt((x * x).sum())
    return x / norm if norm else x


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, classes: int, epochs: int = 3, alpha: float = 1.0, beta: float = 1.0, l1: float = 0.02, l2: float = 0.5) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal on sparse rows (indices, values); the last feature is the bias, without penalty."""
    size = FEATURES + 1
    z, n = np.zeros((size, classes)), np.zeros((size, classes))
    one = np.ones(size)
    one[-1] = 0

    def weights(at: np.ndarray | slice) -> np.ndarray:
        penalty = l1 * one[at][:, None]
        w = -(z[at] - np.sign(z[at]) * penalty) / ((beta + np.sqrt(n[at])) / alpha + l2 * one[at][:, None])
        return np.where(np.abs(z[at]) <= penalty, 0.0, w)

    order = np.random.default_rng(7)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            at, x = rows[i]
            w = weights(at)
            p = softmax(x @ w)
            p[y[i]] -= 1
            g = x[:, None] * p
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - step * w
            n[at] += g * g
    w = weights(slice(None))
    return w[:-1], w[-1]


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the logits, 0.2 to 20, with the least log loss on rows that training didn't see."""
    if not len(y):
        return 1.0

    def loss(log_t: float) -> float:
        p = softmax(logits / np.exp(log_t))
        return -np.log(np.maximum(p[np.arange(len(y)), y], 1e-12)).mean()

    low, high, gold = np.log(0.2), np.log(20.0), (5**0.5 - 1) / 2
    for _ in range(60):
        a, b = high - gold * (high - low), low + gold * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def lists(column: pa.ChunkedArray) -> list[np.ndarray]:
    """A column of lists as views of one array, without a Python object for each number."""
    whole = column.combine_chunks()
    return np.split(whole.flatten().to_numpy(), np.cumsum(whole.value_lengths().to_numpy())[:-1])


def train(labelled: DataFrame, text_col: str = "text", label_col: str = "lang", id_col: str = "doc_id", max_rows: int = MAX_TRAIN) -> Model:
    """Fit on rows with a non-null label and a letter in the text; no such rows: a model that says und.

    At most max_rows are taken, by a hash of id and text, so the table's layout does not
    matter; rare labels get a larger share of theirs. Repeated rows count each time.
    """
    turn = F.xxhash64(F.col(f"`{id_col}`").cast("string"), F.col(f"`{text_col}`"), F.lit("train"))
    rows = labelled.select(F.col(f"`{text_col}`").cast("string").alias("text"), F.col(f"`{label_col}`").cast("string").alias("label"), turn.alias("turn"))
    rows = rows.where("label IS NOT NULL AND text IS NOT NULL")
    sizes = rows.groupBy("label").count()
    total = rows.count()
    share = F.greatest(F.lit(1.1 * max_rows / max(total, 1)), 1.1 * LEAST / F.col("count"))
    sizes = F.broadcast(sizes.select("label", (F.least(share, F.lit(1.0)) * 1_000_000).cast("long").alias("below")))  # one row a language
    rows = rows.join(sizes, "label").where(F.pmod("turn", F.lit(1_000_000)) < F.col("below"))

    def features(batches):
        for b in batches:
            at, n, label, turns = [], [], [], []
            for t, y, turn in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                c = ngram_counts(t)
                if c is not None:
                    k = np.flatnonzero(c)
                    at.append(k.astype(np.int16))
                    n.append(c[k].astype(np.int32))
                    label.append(y)
                    turns.append(turn)
            yield pa.record_batch([pa.array(at, pa.list_(pa.int16())), pa.array(n, pa.list_(pa.int32())), pa.array(label, pa.string()), pa.array(turns, pa.int64())], names=["at", "n", "label", "turn"])

    got = rows.select("text", "label", "turn").mapInArrow(features, "at array<short>, n array<int>, label string, turn long").orderBy("turn", "label").limit(max_rows).toArrow()
    labels = got["label"].to_pylist()
    classes = sorted(set(labels))
    if not classes:
        return Model([], np.zeros(FEATURES), np.zeros((FEATURES, 0)), np.zeros(0), 1.0)
    at, n = (lists(got[c]) for c in ("at", "n"))
    y = np.array([classes.index(x) for x in labels])
    alike = collections.Counter(key := [(x, k.tobytes()) for x, k in zip(labels, at, strict=True)])
    order = sorted(range(len(y)), key=lambda i: (*key[i], n[i].astype(np.float64).tobytes() if alike[key[i]] > 1 else b""))
    del key, alike
    y = y[order]
    seen = np.zeros(FEATURES)
    for k in at:
        seen[k] += 1
    idf = np.log((1 + len(at)) / (1 + seen)) + 1
    ends = np.cumsum([len(at[i]) + 1 for i in order])  # each row and its bias; all rows in one array, which goes as a whole
    which, values = np.full(ends[-1], FEATURES, np.int16), np.ones(ends[-1])
    rows = [(which[z - len(at[i]) - 1 : z], values[z - len(at[i]) - 1 : z]) for i, z in zip(order, ends.tolist(), strict=True)]
    for i, (k, x) in zip(order, rows, strict=True):
        k[:-1] = at[i]
        x[:-1] = np.log1p(n[i].astype(np.float64)) * idf[at[i]]
        x[:-1] /= np.sqrt((x[:-1] * x[:-1]).sum())
    del at, n, got
    kept = np.arange(len(rows)) % 5 != 4
    w, bias = ftrl([r for r, f in zip(rows, kept, strict=True) if f], y[kept], len(classes))
    logits = np.array([x[:-1] @ w[k[:-1]] + bias for (k, x), f in zip(rows, kept, strict=True) if not f]).reshape(-1, len(classes))
    return Model(classes, idf, w, bias, temperature(logits, y[~kept]))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score of every whole text; und and 0.0 where it is null or has no letter."""

    def run(batches):
        for b in batches:
            got = [model.predict(t) for t in b.column(1).to_pylist()]
            yield pa.record_batch([b.column(0), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())], names=["doc_id", "lang_pred", "score"])

    return id_text(docs).mapInArrow(run, "doc_id long, lang_pred string, score double")


def predict_held_out(docs: DataFrame) -> DataFrame:
    """Train on the rows outside fold 2 of 4 and predict all: doc_id, held_out, lang_pred, score.

    Null texts and texts without a letter are und with score 0. Null ids are in no fold that
    is held out (null there); repeated rows each have their row; an empty table has none.
    """
    model = train(docs.where(crc_mod(4) != 2))
    out = predict(docs, model)
    return out.select("doc_id", (crc_mod(4) == 2).alias("held_out"), "lang_pred", "score")


def keep_known(docs: DataFrame, model: Model, least: float = 0.4) -> DataFrame:
    """docs, all columns, without those whose language the model can't tell (und or a lower score).

    Null texts go, as they have no letter. Repeated rows stay or go together.
    """
    names = docs.columns

    def run(batches):
        where = names.index("text")
        for b in batches:
            got = [model.predict(t or "") for t in b.column(where).to_pylist()]
            yield b.filter(pa.array([lang != UND and score >= least for lang, score in got], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
