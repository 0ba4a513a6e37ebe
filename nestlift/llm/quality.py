"""Supervised subword embeddings: a text's quality from averaged hashed vectors.

Every word gives hashed features: the word, its character n-grams with word
boundaries, and the bigram with the word before it (a word that follows itself
shares one feature, whatever the word). Each feature has a learned vector; a text
is the average over its words of the average vector of each word's features, and
a softmax over two classes gives the score. Vectors and output are trained by
stochastic gradient descent in numpy on a bounded, class-balanced sample; the
output bias is then set back to the classes' share among all training labels.

Scoring is one pass over the texts. A word's vector does not depend on the text,
so workers keep the projected vectors they have seen (bounded; speed only).
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestlift.llm.common import each, labelled_sample, worker_cache

BITS, DIM = 17, 8
GRAMS = (2, 3, 4)
SAMPLE_PER_CLASS, SAMPLE_CHARS = 1_500, 20_000
CACHE_WORDS = 300_000
REPEAT = zlib.crc32(b"= =") & ((1 << BITS) - 1)


def features(word: str) -> list[int]:
    """Hashed features of one word: itself and its character n-grams, boundaries marked."""
    w = f"<{word}>".encode("utf-8", "surrogatepass")
    out = [zlib.crc32(w, 1)]
    for n in GRAMS:
        out += [zlib.crc32(w[i: i + n]) for i in range(len(w) - n + 1)]
    mask = (1 << BITS) - 1
    return [x & mask for x in out]


def words(text: str | None) -> list[str]:
    return (text or "").split()


class Model:
    """Per feature the share it adds to the logit (its vector times the output), and the bias."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias
        self.repeat = float(weights[REPEAT])
        self.known = _Words(weights)

    def score(self, text: str | None) -> float:
        ws = words(text)
        if not ws:
            z = self.bias
        else:
            same = sum(map(str.__eq__, ws, ws[1:]))
            z = self.bias + (math.fsum(map(self.known.__getitem__, ws)) + same * self.repeat) / len(ws)
        return 1.0 / (1.0 + math.exp(-max(-500.0, min(500.0, z))))


class _Words(dict):
    """Word -> mean weight of its features, of bounded size."""

    def __init__(self, weights: np.ndarray):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        f = features(word)
        v = float(self.weights[f].sum()) / len(f)
        if len(self) >= CACHE_WORDS:
            self.clear()
        if len(word) <= 64:
            self[word] = v
        return v


def _rows(texts: Sequence[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text its distinct features and their shares of the average."""
    known: dict[str, tuple[list[int], float]] = {}
    out = []
    for text in texts:
        ws = words(text)
        ids: list[int] = []
        per: list[float] = []
        counts: dict[str, int] = {}
        for w in ws:
            counts[w] = counts.get(w, 0) + 1
        for w, c in counts.items():
            if w not in known:
                f = features(w)
                known[w] = f, 1.0 / len(f)
            f, one = known[w]
            ids += f
            per += [c * one / len(ws)] * len(f)
        same = sum(map(str.__eq__, ws, ws[1:]))
        if same:
            ids.append(REPEAT)
            per.append(same / len(ws))
        u, at = np.unique(np.asarray(ids, np.int64), return_inverse=True)
        share = np.bincount(at, np.asarray(per, float), len(u)) if len(u) else np.zeros(0)
        out.append((u.astype(np.int32), share.astype(np.float32)))
    return out


def train(texts: Sequence[str], labels: Sequence[int], prior: float | None = None, epochs: int = 8,
          rate: float = 1.0, boost: float = 5.0, seed: int = 3) -> Model:
    """``prior``: share of label 1 where the model is used; None: as in the sample.

    An average over hundreds of words leaves each vector a tiny share of the
    gradient; ``boost`` scales the vectors' steps up.
    """
    y = np.asarray(labels, int)
    n1, n0 = int(y.sum()), int(len(y) - y.sum())
    if not n1 or not n0:                            # one class only, or no label at all
        share = (n1 + 0.5) / (len(y) + 1)
        return Model(np.zeros(1 << BITS), math.log(share / (1 - share)))
    rng = np.random.default_rng(seed)
    rows = _rows(texts)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (1 << BITS, DIM)).astype(np.float32)
    output, bias = np.zeros((DIM, 2), np.float32), np.zeros(2, np.float32)
    steps, done = epochs * len(rows), 0
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            step = rate * (1 - done / steps)
            done += 1
            ids, share = rows[i]
            h = share @ vectors[ids] if len(ids) else np.zeros(DIM, np.float32)
            z = h @ output + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            e = p
            e[y[i]] -= 1
            back = output @ e
            output -= step * np.outer(h, e)
            bias -= 0.05 * step * e
            if len(ids):
                vectors[ids] -= (step * share)[:, None] * back[None, :] * boost
    d = output[:, 1] - output[:, 0]
    b = float(bias[1] - bias[0])
    if prior is not None:
        prior = min(max(prior, 1e-3), 1 - 1e-3)
        b += math.log(prior / (1 - prior)) - math.log(n1 / n0)
    return Model((vectors @ d).astype(np.float32), b)


def _model(weights: bytes, bias: float) -> Model:
    return worker_cache(("quality", weights, bias), lambda: Model(np.frombuffer(weights, np.float32), bias))


def score(text: Column, model: Model) -> Column:
    """Quality of a text, 0 to 1; texts without words, NULL included, score the bias alone."""
    weights, bias = model.weights.astype(np.float32).tobytes(), model.bias

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        m = _model(weights, bias)                   # kept by the worker from task to task
        return pa.array([m.score(t) for t in each(texts)], pa.float64())

    return scored(text)


def fit(docs: DataFrame, labels: DataFrame, train_rows: Column, per_class: int = SAMPLE_PER_CLASS,
        max_chars: int = SAMPLE_CHARS) -> Model:
    """A model from at most ``per_class`` labelled documents of each class, of up to ``max_chars`` characters.

    ``train_rows`` is a condition on doc_id that says which labels may be used.
    The share of label 1 is counted over all of these labels. Without any usable
    label every score is 0.5.
    """
    got = (labelled_sample(docs, labels, "quality", train_rows, per_class, max_chars)
           .orderBy("doc_id", "text").select("text", "y").collect())
    share = labels.where(train_rows & F.col("quality").isin(0, 1)).agg(F.avg("quality")).first()[0]
    return train([r["text"] for r in got], [r["y"] for r in got], share)


def score_quality(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """doc_id, score, predicted: one row per document, repeated and NULL ids included."""
    return (docs.select("doc_id", score(F.col("text"), model).alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))
