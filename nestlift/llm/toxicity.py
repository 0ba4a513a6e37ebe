"""Toxicity scores that do not move when only the group named in a text changes.

A text is the set of the hashed features of its words (the word itself and its
character n-grams with word boundaries); the classifier is logistic on them.

Training runs in numpy on a bounded sample. Features are screened first: of the
hashed space, those whose document frequency differs between the classes far
beyond chance are kept. On these, logistic loss + L2 + the counterfactual
penalty is minimised: for lines of labelled texts, an identity term is swapped
for another (or one is put in where there is none), and the squared change of
the logit is added to the loss. Terms that name groups thus get no weight of
their own, and neutral mentions are not taken for abuse.

Only the weights of the kept features leave the driver; scoring is one pass over
the texts, without a shuffle.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestlift.llm.common import each, labelled_sample, worker_cache

BITS = 18
GRAMS = (3, 4, 5, 6)
SAMPLE_PER_CLASS, SAMPLE_CHARS = 2_000, 20_000
CACHE_WORDS = 200_000
# terms that name groups; a parameter, in the languages of the corpus
IDENTITY = ("women", "men", "girls", "boys", "christians", "muslims", "jews", "hindus", "buddhists", "atheists",
            "immigrants", "refugees", "americans", "africans", "asians", "europeans", "gay", "straight", "lesbian",
            "transgender", "disabled", "deaf", "blind", "elderly", "teenagers", "black", "white", "latino",
            "frauen", "männer", "juden", "muslime", "christen", "mujeres", "hombres", "judíos", "musulmanes",
            "cristianos", "femmes", "hommes", "juifs", "musulmans", "chrétiens")
_WORD = re.compile(r"[^\W\d_]+")


def features(word: str) -> np.ndarray:
    """Distinct hashed features of a word: itself and its character n-grams, boundaries marked."""
    w = f"<{word}>".encode("utf-8", "surrogatepass")
    out = {zlib.crc32(w, 1) & ((1 << BITS) - 1)}
    for n in GRAMS:
        for i in range(len(w) - n + 1):
            out.add(zlib.crc32(w[i: i + n]) & ((1 << BITS) - 1))
    return np.fromiter(out, np.int32, len(out))


def words(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


class _Features(dict):
    """Word -> its features, of bounded size."""

    def __missing__(self, word: str) -> np.ndarray:
        f = features(word)
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = f
        return f


def text_features(text: str, known: dict) -> np.ndarray:
    found = [known[w] for w in words(text)]
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int32)


def counterfactuals(texts: Sequence[str], terms: Sequence[str], most: int, rng: np.random.Generator) -> list[tuple[str, str]]:
    """Up to ``most`` (line, line with another identity term) pairs; a line without one gets one put in."""
    lines = [line for t in texts for line in t.split("\n") if line.strip()]
    named = set(terms)
    pairs = []
    for i in rng.permutation(len(lines))[:most]:
        tokens = lines[i].split()
        at = [k for k, w in enumerate(tokens) if w.lower().strip(".,;:!?") in named]
        new = terms[int(rng.integers(len(terms)))]
        if at:
            swapped = [new if k in at else w for k, w in enumerate(tokens)]
        else:
            k = int(rng.integers(len(tokens) + 1))
            swapped = [*tokens[:k], new, *tokens[k:]]
        pairs.append((lines[i], " ".join(swapped)))
    return pairs


class Model:
    """bias and the weights of the kept features (ids sorted)."""

    def __init__(self, ids: np.ndarray, weights: np.ndarray, bias: float):
        self.ids, self.weights, self.bias = ids, weights, bias
        self.weight = dict(zip(ids.tolist(), weights.tolist(), strict=True))
        self.cache: dict[str, tuple[int, ...]] = {}

    def hits(self, word: str) -> tuple[int, ...]:
        f = self.cache.get(word)
        if f is None:
            f = tuple(x for x in features(word).tolist() if x in self.weight)
            self.hold(word, f)
        return f

    def hold(self, word: str, f: tuple[int, ...]) -> None:
        if len(self.cache) >= CACHE_WORDS:
            self.cache.clear()
        if len(word) <= 64:
            self.cache[word] = f

    def chunk(self, chunk: str) -> tuple[int, ...]:
        """Kept features of a run of characters without white space, in lower case."""
        f = self.cache.get(chunk)
        if f is None:
            f = self.hits(chunk) if chunk.isalpha() else tuple({x for w in _WORD.findall(chunk) for x in self.hits(w)})
            self.hold(chunk, f)
        return f

    def score(self, text: str | None) -> float:
        found = set().union(*map(self.chunk, set((text or "").lower().split())))
        z = self.bias + math.fsum(map(self.weight.__getitem__, found))
        return 1.0 / (1.0 + math.exp(-max(-500.0, min(500.0, z))))


def train(texts: Sequence[str], toxic: Sequence[int], prior: float | None = None, terms: Sequence[str] = IDENTITY,
          keep: int = 1_024, least_z: float = 4.0, l2: float = 2e-4, penalty: float = 1.0, pairs: int = 2_000,
          steps: int = 300, seed: int = 5) -> Model:
    """``prior``: share of toxic texts where the model is used (the sample is balanced); None: as in the sample."""
    y = np.asarray(toxic, float)
    n1, n0 = y.sum(), len(y) - y.sum()
    if not n1 or not n0:                            # one class only: its smoothed rate is all there is to say
        rate = (n1 + 0.01) / (len(y) + 1)
        return Model(np.zeros(0, np.int64), np.zeros(0), math.log(rate / (1 - rate)))
    known = _Features()
    rows = [text_features(t, known) for t in texts]
    df1, df0 = np.zeros(1 << BITS), np.zeros(1 << BITS)
    for f, v in zip(rows, y, strict=True):
        (df1 if v else df0)[f] += 1
    p = (df1 + df0 + 1) / (len(y) + 2)
    z = (df1 / n1 - df0 / n0) / np.sqrt(p * (1 - p) * (1 / n1 + 1 / n0))
    ids = np.sort(np.argsort(-np.abs(z), kind="stable")[:keep])
    ids = ids[np.abs(z[ids]) >= least_z]
    place = np.full(1 << BITS, -1)
    place[ids] = np.arange(len(ids))

    def matrix(found: list[np.ndarray]) -> np.ndarray:
        x = np.zeros((len(found), len(ids)), np.float32)
        for i, f in enumerate(found):
            at = place[f]
            x[i, at[at >= 0]] = 1
        return x

    x = matrix(rows)
    both = counterfactuals(texts, terms, pairs, np.random.default_rng(seed))
    change = matrix([text_features(b, known) for _, b in both]) - matrix([text_features(a, known) for a, _ in both])
    change = change[np.abs(change).sum(axis=1) > 0]
    w, b = np.zeros(len(ids), np.float32), 0.0
    m, v = np.zeros(len(ids) + 1), np.zeros(len(ids) + 1)
    for t in range(1, steps + 1):                   # full-batch Adam
        q = 1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30)))
        e = ((q - y) / len(y)).astype(np.float32)
        g = x.T @ e + l2 * w
        if len(change):
            g = g + 2 * penalty / len(both) * (change.T @ (change @ w))
        g = np.append(g, e.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = 0.05 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w, b = (w - step[:-1]).astype(np.float32), b - step[-1]
    if prior is not None:
        prior = min(max(prior, 1e-3), 1 - 1e-3)
        b += math.log(prior / (1 - prior)) - math.log(n1 / n0)
    return Model(ids, w.astype(float), float(b))


def _model(ids: bytes, weights: bytes, bias: float) -> Model:
    return worker_cache(("toxicity", ids, weights, bias),
                        lambda: Model(np.frombuffer(ids, np.int64), np.frombuffer(weights), bias))


def score(text: Column, model: Model) -> Column:
    """Toxicity of a text, 0 to 1; NULL and empty texts score the bias."""
    key = (model.ids.astype(np.int64).tobytes(), model.weights.astype(float).tobytes(), model.bias)

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        m = _model(*key)                            # kept by the worker from task to task
        return pa.array([m.score(t) for t in each(texts)], pa.float64())

    return scored(text)


def fit(docs: DataFrame, labels: DataFrame, train_rows: Column, per_class: int = SAMPLE_PER_CLASS,
        max_chars: int = SAMPLE_CHARS, terms: Sequence[str] = IDENTITY) -> Model:
    """A model from at most ``per_class`` labelled documents of each class, of up to ``max_chars`` characters.

    ``train_rows`` is a condition on doc_id that says which labels may be used.
    The share of toxic texts is counted over all of these labels. Without any
    usable label the score is 0.01.
    """
    got = (labelled_sample(docs, labels, "toxic", train_rows, per_class, max_chars)
           .orderBy("doc_id", "text").select("text", "y").collect())
    share = labels.where(train_rows & F.col("toxic").isin(0, 1)).agg(F.avg("toxic")).first()[0]
    return train([r["text"] for r in got], [r["y"] for r in got], share, terms)


def score_toxicity(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """doc_id, score, predicted: one row per document, repeated and NULL ids included."""
    return (docs.select("doc_id", score(F.col("text"), model).alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def drop_toxic(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """The documents that score below ``threshold``; the columns of ``docs``."""
    return docs.where(score(F.col("text"), model) < threshold)
