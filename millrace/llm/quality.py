"""Quality scores by positive-unlabelled learning.

Trusted positives are documents labelled good; the unlabelled text is a draw from all documents, labels
unseen. The classifier minimises the non-negative unbiased risk

    prior * E_pos[loss(+)] + max(0, E_unl[loss(-)] - prior * E_pos[loss(-)])

so the unlabelled text's hidden positives are taken out of the negative part, which never goes below
zero. The class prior is estimated from the labelled documents, taken as a random draw of the text; where
only positives are labelled, from a first classifier that tells positives from unlabelled text, both given
equal weight: after Elkan and Noto, its odds on positives tend to 1 / prior.

Features are statistics of the whole text, language-neutral: shares of kinds of characters, lengths and
endings of words, repetition of words, pairs and lines. Every document's features are computed; the
classifier is fitted on at most `most` positives and `most` unlabelled documents, those of smallest
hash, which reach the driver as short vectors. The bound is a parameter and doesn't depend on the input.

Defined results: null text counts as empty and is scored like any text; ties and repeated rows get equal
scores; with no labelled positive every score is 0.5; other columns pass through, and one named `score`
is replaced; rows that share a number are fitted on once, repeated labels count once; an empty table gives
an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import hash_words, list_array, mix, slices, texts, uid, with_columns

#: Documents of either kind that the classifier is fitted on, at most.
MOST = 20_000
HIDDEN, STEPS, RATE = 12, 400, 0.03
#: Weight decay: a floor, and more the fewer positives there are.
DECAY, DECAY_FEW = 1e-3, 2.0

_CLASS = np.zeros(256, np.int64)  # 0: other ASCII letters and controls
_CLASS[65:91] = 1
_CLASS[48:58] = 2
_CLASS[[*b".,;:?'\"()-"]] = 3
_CLASS[[c for c in range(33, 127) if not chr(c).isalnum() and c not in b".,;:?'\"()-"]] = 4
_CLASS[128:] = 5
_CLASS[[32, *range(9, 14)]] = 6

NAMES = ["log_words", "upper", "digit", "mark", "symbol", "wide", "space", "word_mean", "word_dev", "long_words", "short_words", "odd_ending", "marked_ending", "upper_words", "repeat_next", "repeat_two", "distinct", "distinct_pairs", "log_lines", "line_words", "repeated_lines", "top_word", "capital_share"]


def _per_doc(values: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(doc, values, n)


def _distinct(keys: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per document, the number of distinct keys and the count of the most frequent one."""
    order = np.lexsort((keys, doc))
    k, d = keys[order], doc[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (d[1:] != d[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.concatenate([first, [len(k)]]))
    top = np.zeros(n)
    np.maximum.at(top, d[first], count)
    return np.bincount(d[first], minlength=n), top


def features(strings: list[str]) -> np.ndarray:
    """A row for every text, in the order of NAMES."""
    n = len(strings)
    word, doc, start, end = hash_words(strings, fold=False)
    raw = [s.encode("utf-8", "surrogatepass") for s in strings]
    sizes = np.array([len(r) for r in raw]) + 1
    data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    kind = _CLASS[data]
    owner = np.repeat(np.arange(n), sizes)
    by_kind = np.bincount(owner * 7 + kind, minlength=7 * n).reshape(n, 7)
    by_kind[:, 6] -= 1  # the break that joins the texts
    total = np.maximum(by_kind.sum(axis=1), 1)
    words = np.bincount(doc, minlength=n)
    some = np.maximum(words, 1)
    length = (end - start).astype(float)
    mean = _per_doc(length, doc, n) / some
    dev = np.sqrt(np.maximum(_per_doc(length * length, doc, n) / some - mean * mean, 0))
    last, first = kind[end - 1], kind[start]
    same = np.flatnonzero(doc[1:] == doc[:-1])
    again = same[word[same + 1] == word[same]]
    two = np.flatnonzero(doc[2:] == doc[:-2]) if len(doc) > 2 else np.zeros(0, np.int64)
    skip = two[word[two + 2] == word[two]]
    distinct, top = _distinct(word, doc, n)
    pairs, _ = _distinct(mix(word[same] * np.uint64(3) + word[same + 1]), doc[same], n)
    # lines, by the words on them
    line = np.cumsum(data == 10)
    line_of = line[start]
    fresh = np.ones(len(start), bool)
    fresh[1:] = (line_of[1:] != line_of[:-1]) | (doc[1:] != doc[:-1])
    heads = np.flatnonzero(fresh)
    place = np.arange(len(start)) - np.repeat(heads, np.diff(np.concatenate([heads, [len(start)]])))
    line_hash = np.add.reduceat(mix(word + place.astype(np.uint64)), heads) if heads.size else word[:0]
    lines = np.bincount(doc[heads], minlength=n)
    unlike, _ = _distinct(line_hash, doc[heads], n)
    share = lambda mask: _per_doc(mask.astype(float), doc, n) / some
    all_upper = np.zeros(len(start), bool)
    if len(start):
        uppers = np.concatenate([[0], np.cumsum((kind == 1) | (kind >= 3) & (kind <= 5))])
        caps = np.concatenate([[0], np.cumsum(kind == 1)])
        all_upper = (uppers[end] - uppers[start] == end - start) & (caps[end] - caps[start] > 1)
    columns = [
        np.log1p(words), *(by_kind[:, k] / total for k in range(1, 7)), mean, dev, share(length > 14), share(length < 3), share(last == 4), share(last == 3), share(all_upper),
        np.bincount(doc[again], minlength=n) / some, np.bincount(doc[skip], minlength=n) / some, distinct / some, pairs / np.maximum(words - 1, 1),
        np.log1p(lines), words / np.maximum(lines, 1), 1 - unlike / np.maximum(lines, 1), top / some, share(first == 1),
    ]
    return np.stack(columns, axis=1)


def featured(df: DataFrame, column: str = "text", out: str = "features") -> DataFrame:
    """df with the features of a text column in place of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, column):
            x = features(texts(batch, column))
            yield with_columns(batch, (column,), **{out: list_array(x.ravel(), np.full(len(x), x.shape[1]))})

    kept = [f for f in df.schema.fields if f.name not in (column, out)]
    return df.mapInArrow(run, T.StructType([*kept, T.StructField(out, T.ArrayType(T.DoubleType()))]))


class Model:
    """A small network on standardised features; its output is the log odds of a good text."""

    def __init__(self, mean: np.ndarray, dev: np.ndarray, rng: np.random.Generator):
        self.mean, self.dev = mean, dev
        d = len(mean)
        self.p = [rng.standard_normal((d, HIDDEN)) / math.sqrt(d), np.zeros(HIDDEN), rng.standard_normal(HIDDEN) / math.sqrt(HIDDEN), np.zeros(1), np.zeros(d)]

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.dev, -6, 6)

    def forward(self, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = np.tanh(z @ self.p[0] + self.p[1])
        return h @ self.p[2] + self.p[3] + z @ self.p[4], h

    def grad(self, z: np.ndarray, h: np.ndarray, g: np.ndarray) -> list[np.ndarray]:
        back = g[:, None] * self.p[2] * (1 - h * h)
        return [z.T @ back, back.sum(0), h.T @ g, g.sum(keepdims=True), z.T @ g]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.forward(self.scaled(x))[0], -50, 50)))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def risk(model: Model, zp: np.ndarray, zu: np.ndarray, prior: float | None) -> tuple[float, float, list[np.ndarray]]:
    """The risk's positive and negative part on scaled rows, under the logistic loss, and the gradient to follow.

    Where the negative part falls below zero, its gradient alone is followed, backwards, as the method has it.
    Without a prior, it is the plain risk of telling the two kinds of rows apart.
    """
    (op, hp), (ou, hu) = model.forward(zp), model.forward(zu)
    if prior is None:
        grads = model.grad(zp, hp, (_sigmoid(op) - 1) / len(op)), model.grad(zu, hu, _sigmoid(ou) / len(ou))
        return np.logaddexp(0, -op).mean(), np.logaddexp(0, ou).mean(), [a + b for a, b in zip(*grads)]
    positive = prior * np.logaddexp(0, -op).mean()
    negative = np.logaddexp(0, ou).mean() - prior * np.logaddexp(0, op).mean()
    sign = 1.0 if negative >= 0 else -1.0
    gp = (prior * (_sigmoid(op) - 1) * (sign > 0) - sign * prior * _sigmoid(op)) / len(op)
    gu = sign * _sigmoid(ou) / len(ou)
    return positive, negative, [a + b for a, b in zip(model.grad(zp, hp, gp), model.grad(zu, hu, gu))]


def fit(pos: np.ndarray, unl: np.ndarray, prior: float | None, seed: int = 5) -> Model:
    """The minimiser of the non-negative risk under the logistic loss, by Adam on full batches."""
    everything = np.concatenate([pos, unl])
    model = Model(everything.mean(0), everything.std(0) + 1e-6, np.random.default_rng(seed))
    zp, zu = model.scaled(pos), model.scaled(unl)
    decay = DECAY + min(DECAY_FEW / len(pos), 0.1)
    m, v = [np.zeros_like(p) for p in model.p], [np.zeros_like(p) for p in model.p]
    for step in range(1, STEPS + 1):
        total = [g + decay * p for g, p in zip(risk(model, zp, zu, prior)[2], model.p)]
        for k, g in enumerate(total):
            m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g * g
            model.p[k] = model.p[k] - RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return model


def estimate_prior(pos: np.ndarray, unl: np.ndarray, n_pos: int, n_neg: int) -> float:
    """The share of good texts among all, a standard error on the low side: too high a share hides bad text."""
    if n_neg:
        share = n_pos / (n_pos + n_neg)
        return min(max(share - math.sqrt(share * (1 - share) / (n_pos + n_neg)), 0.02), 0.98)
    score = float(fit(pos, unl, None).score(pos).mean())
    return min(max((1 - score) / max(score, 1e-6), 0.02), 0.98)


def train(df: DataFrame, labels: DataFrame, key: str, column: str, most: int = MOST) -> Model | None:
    """A classifier for the texts of df, from labels (key, quality); None without a positive.

    The documents to fit on are picked by their numbers' hashes first, so only their features are made.
    """
    good = labels.filter("quality = 1").select(F.col(key).alias("_k")).distinct()
    n_pos, n_neg = labels.select(key, "quality").distinct().agg(F.count_if(F.col("quality") == 1), F.count_if(F.col("quality") == 0)).first()
    ids = df.select(key).distinct()
    first = lambda x: x.orderBy(uid(F.lit(11), F.col(key)), key).limit(most)
    pos, unl = first(ids.join(good, F.col(key) == F.col("_k"), "left_semi")), first(ids)
    # 2 * most numbers at the most
    chosen = pos.withColumn("_pos", F.lit(1)).join(unl.withColumn("_unl", F.lit(1)), key, "full")
    rows = df.select(key, column).join(F.broadcast(chosen), key)
    # of several texts with one number the smallest, so reruns agree
    rows = rows.groupBy(key).agg(F.min(F.coalesce(column, F.lit(""))).alias(column), F.max("_pos").alias("_pos"), F.max("_unl").alias("_unl"))
    got = featured(rows, column).orderBy(key).toPandas()
    x, is_pos, is_unl = got["features"], got["_pos"].notna().to_numpy(), got["_unl"].notna().to_numpy()
    if not is_pos.any():
        return None
    x = np.stack(x.to_numpy()).astype(float)
    return fit(x[is_pos], x[is_unl], estimate_prior(x[is_pos], x[is_unl], n_pos, n_neg))


def scored(df: DataFrame, model: Model | None, column: str = "text", keep_text: bool = True, default: float = 0.5, out: str = "score") -> DataFrame:
    """df with a score column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, column):
            s = model.score(features(texts(batch, column))) if model else np.full(batch.num_rows, default)
            yield with_columns(batch, () if keep_text else (column,), **{out: pa.array(s)})

    kept = [f for f in df.schema.fields if f.name != out and (keep_text or f.name != column)]
    return df.mapInArrow(run, T.StructType([*kept, T.StructField(out, T.DoubleType())]))


def learnable(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """The labels outside the held-out third: CRC-32 of the number as text, modulo 3, is not 1."""
    return labels.filter(F.crc32(F.col(key).cast("string").cast("binary")) % 3 != 1)
