"""Rule filters whose cutoffs carry a joint guarantee on false rejections.

Each rule compares one ratio of a text with a cutoff. Labelled documents are a
holdout: for a stratum (language) and a set of cutoffs, one per rule or none, the
number of good documents that any of the rules would reject gives an exact binomial
(Clopper-Pearson) upper bound on the joint false rejection rate. A set is allowed if
the bound is at most ``risk``.

Multiple tests are corrected for. ``delta`` is divided by the number of strata that
have good labels (Bonferroni). Within a stratum the sets are tested in a fixed
sequence up to the first that fails, which needs no further division. The sequence
starts with every rule off and makes one rule stricter at a time: the step that
rejects most of the documents labelled bad for what it rejects of all others
without a good label, as long as that is a gain. So the order does not look at the
good labels that the tests use. With probability 1 - delta, no allowed set rejects
more than ``risk`` of the good documents of its stratum. The one taken gains most:
bad documents rejected less ``cost`` times the good ones. A stratum with fewer good
labels than the bound needs (436 at the defaults with four labelled strata) has no rules.

The counts are made by Spark over all documents; only one row per stratum, class
and combination of grid steps that occurs reaches the driver, at most
(grid + 1) to the number of rules, whatever the number of documents.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestlift.llm.common import each, stage

RISK, DELTA, COST = 0.01, 0.05, 20.0
STRATA = ("de", "en", "es", "fr")        # any other language is the stratum "other"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
# rule -> (ratio, grid of cutoffs from strict to loose); a text above the cutoff is rejected
_GRID = tuple(round(0.02 * 1.15 ** i, 6) for i in range(36))
RULES = {
    "symbols": ("n_symbols / n_words", _GRID),
    "dup_lines": ("n_dup_lines / n_lines", _GRID),
    "repeats": ("n_repeat_words / n_words", _GRID),
    "word_length": ("word_chars / n_words / 100", _GRID),
}
_BLANK = re.compile(rb"[ \t-\r]+")


def repeat_words(words: Sequence[bytes], n: int = WINDOW) -> int:
    """Words that lie in an ``n``-word window found twice or more in the text."""
    k = len(words) - n + 1
    if k < 2:
        return 0
    ids: dict[bytes, int] = {}
    w = np.fromiter((ids.setdefault(x, len(ids)) for x in words), np.uint64, len(words))
    mixed = w[:k].copy()
    for i in range(1, n):
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + w[i: k + i]
    if len(np.unique(mixed)) == k:
        return 0                                # different hashes: no window comes twice
    windows = list(zip(*(words[i: k + i] for i in range(n)), strict=True))
    seen = Counter(windows)
    at = np.fromiter((seen[x] > 1 for x in windows), bool, k)
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, np.flatnonzero(at), 1)
    np.add.at(cover, np.flatnonzero(at) + n, -1)
    return int((np.cumsum(cover)[:-1] > 0).sum())


def measures(text: Column) -> Column:
    """Struct of n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines of a text."""
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")

    @F.arrow_udf(", ".join(f"{n} long" for n in names))
    def measure(texts: pa.Array) -> pa.Array:
        out: list[list[int]] = [[] for _ in names]
        for text in each(texts):
            text = text or ""
            raw = text.encode("utf-8", "surrogatepass")
            words = raw.split()                 # bytes.split cuts at space and tab..carriage return only
            lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
            row = (len(words), len(text) - sum(map(text.count, " \t\n\x0b\x0c\r")),
                   sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeat_words(words), len(lines))
            for column, v in zip(out, row, strict=True):
                column.append(v)
        return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in out], list(names))

    return measure(text)


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for n draws of probability p: exact, summed in log space."""
    if k >= n:
        return 1.0
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)
            for i in range(k + 1)]
    top = max(logs)
    return min(1.0, math.exp(top) * math.fsum(math.exp(x - top) for x in logs))


def allowed(k: int, n: int, risk: float, level: float) -> bool:
    """Whether the exact upper bound on the rate, for k of n, is at most ``risk`` at ``level``."""
    # k is far below risk * n in every allowed case, so the sum is short where it matters
    return n > 0 and k <= risk * n and binomial_tail(k, n, risk) <= level


def _stratum(strata: Sequence[str]) -> Column:
    return F.when(F.col("lang").isin(*strata), F.col("lang")).otherwise("other")


def _above(counts: dict[tuple[int, ...], int]) -> tuple[np.ndarray, np.ndarray]:
    steps = np.array(list(counts), np.int64).reshape(len(counts), len(RULES))
    return steps, np.array(list(counts.values()), np.int64)


def cutoff_sequence(bad: dict[tuple[int, ...], int], rest: dict[tuple[int, ...], int]) -> list[tuple[int, ...]]:
    """Sets of cutoffs (a grid index per rule; its length: off), each stricter than the one before.

    ``bad`` and ``rest`` count documents by the number of cutoffs that they lie above, per rule.
    """
    sizes = [len(grid) for _, grid in RULES.values()]
    state, out = list(sizes), []
    (b, nb), (r, nr) = _above(bad), _above(rest)
    all_bad, all_rest = nb.sum(), nr.sum()
    while True:
        best = None
        for k, size in enumerate(sizes):
            # documents not rejected yet that cutoff i would reject: those above more than i cutoffs
            caught, lost = (np.bincount(x[:, k], w, size + 1)[::-1].cumsum()[::-1][1:] for x, w in ((b, nb), (r, nr)))
            for i in range(state[k] - 1, -1, -1):
                if caught[i]:
                    # one document more than there are lies anywhere on the grid, so no step is free
                    lift = (caught[i] / all_bad) / ((lost[i] + (state[k] - i) / size) / (all_rest + 1))
                    if lift > 1 and (best is None or (lift, caught[i]) > best[0]):
                        best = (lift, caught[i]), k, i
        if best is None:
            return out
        _, k, i = best
        state[k] = i
        out.append(tuple(state))
        (b, nb), (r, nr) = ((x[x[:, k] <= i], w[x[:, k] <= i]) for x, w in ((b, nb), (r, nr)))


def rejects(cutoffs: tuple[int, ...], counts: dict[tuple[int, ...], int]) -> int:
    """Documents that any rule rejects."""
    steps, n = _above(counts)
    return int(n[(steps > np.array(cutoffs)).any(axis=1)].sum())


def choose_cutoffs(measured: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA,
                   strata: Sequence[str] = STRATA, cost: float = COST) -> dict[tuple[str, str], float]:
    """(stratum, rule) -> cutoff, for the rules that are on."""
    truth = (labels.select(F.col("doc_id").alias("_id"), F.col("quality").alias("_good"))
             .where(F.col("_id").isNotNull() & F.col("_good").isin(0, 1))
             .groupBy("_id").agg(F.min("_good").alias("_good")))
    held = measured.where("n_words > 0").join(truth, F.col("doc_id") == F.col("_id"), "left")
    # the number of cutoffs a text lies above: all it is rejected by, as grids run from strict to loose
    steps = [sum((F.when(F.expr(ratio) > c, 1).otherwise(0) for c in grid), F.lit(0)) for ratio, grid in RULES.values()]
    rows = (held.select("stratum", F.coalesce("_good", F.lit(2)).alias("kind"), F.array(*steps).alias("above"))
            .groupBy("stratum", "kind", "above").count().collect())
    of: dict[tuple[str, int], dict[tuple[int, ...], int]] = {}
    for r in rows:
        of.setdefault((r["stratum"], r["kind"]), {})[tuple(r["above"])] = r["count"]
    labelled = [s for s in (*strata, "other") if of.get((s, 1))]
    out: dict[tuple[str, str], float] = {}
    for stratum in labelled:
        good, bad, rest = (of.get((stratum, kind), {}) for kind in (1, 0, 2))
        best, taken = 0.0, None
        for cutoffs in cutoff_sequence(bad, rest) if bad else ():
            lost = rejects(cutoffs, good)
            if not allowed(lost, sum(good.values()), risk, delta / len(labelled)):
                break
            gain = rejects(cutoffs, bad) - cost * lost
            if gain > best:
                best, taken = gain, cutoffs
        for (rule, (_, grid)), i in zip(RULES.items(), taken or (), strict=bool(taken)):
            if i < len(grid):
                out[stratum, rule] = grid[i]
    return out


def judge(docs: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA,
          strata: Sequence[str] = STRATA, cost: float = COST) -> DataFrame:
    """doc_id, n_words and the measures, base_failed, rejected_by (rule names), kept.

    Texts without words (NULL included) fail the base rule. One row per input
    row; ids labelled twice count with the lower label; labels of unknown
    documents and labels other than 0 and 1 are ignored; without labels every
    rule is off. Other columns are ignored.
    """
    measured = stage(docs.select("doc_id", _stratum(strata).alias("stratum"), measures(F.col("text")).alias("m"))
                     .select("doc_id", "stratum", "m.*"), "measures")
    cutoffs = choose_cutoffs(measured, labels, risk, delta, strata, cost)
    hits = [F.when((F.col("stratum") == s) & (F.expr(RULES[rule][0]) > c), F.lit(rule))
            for (s, rule), c in sorted(cutoffs.items())]
    rejected = F.array_compact(F.array(*hits)) if hits else F.array().cast("array<string>")
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    rejected = F.when(F.col("n_words") > 0, rejected).otherwise(F.array().cast("array<string>"))
    return (measured.withColumn("base_failed", base).withColumn("rejected_by", rejected)
            .withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0)))
