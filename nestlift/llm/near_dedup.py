"""Near-duplicate classes by ProbMinHash signatures, banding and exact verification.

Documents are bags of five-word shingles; a shingle's weight is its count. The
similarity is the probability Jaccard index of two bags,

    J(x, y) = sum over shingles s of both of 1 / sum_t max(x_t / x_s, y_t / y_s),

which equals the share of common shingles when all weights are equal.

1. Signatures. Every shingle is a Poisson process whose rate is its weight, with
   arrival times and registers drawn from the shingle's hash. A register keeps
   the shingle that arrived first; a document stops drawing when its next
   arrivals come later than its slowest register. Two signatures agree in a
   register with probability J.
2. Texts with the same words are one node from here on (their representative is
   a hash of the words), so large groups of exact copies cost one row.
3. Banding: nodes that agree in all registers of a band share a bucket.
4. Verification. In a bucket each node is compared with the bucket's leader only,
   never with all others. Verified pairs are linked and merged into classes; buckets
   whose nodes are all in one class are done. The others may get further leaders
   (``rounds``). Buckets of up to ``small`` nodes are then finished pair by pair
   across classes.
5. The nodes of larger buckets that still hold several classes are finished by an
   exact join (``near_pairs``): a near pair shares one of the rarest shingles of
   both, so texts that have only a frequent template in common do not meet, nor do
   texts whose own rare shingles already keep them below the threshold. All
   such pairs across classes are verified, and no partner is cut off by the size
   of its bucket.

Nothing is collected but counts; classes are built by distributed label passing.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from nestlift.llm.common import each, stage, worker_cache

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 25, 6
CACHE_WORDS = 300_000
ROUNDS = 1
SMALL_BUCKET = 32
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (public constants): well-spread bits from any integers."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        if len(self) >= CACHE_WORDS:
            self.clear()
        if len(word) <= 64:
            self[word] = h
        return h


def _hashes() -> _WordHashes:
    return worker_cache("near_dedup", _WordHashes)


def words_of(text: str | None) -> list[bytes]:
    """Words as UTF-8; bytes.split cuts at exactly space and tab..carriage return."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def bag(words: list[bytes], n: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted 64-bit hashes of the shingles and their counts; fewer than ``n`` words are one shingle."""
    if not words:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = np.fromiter(map(_hashes().__getitem__, words), np.uint64, len(words))
    k = min(n, len(words))
    out = h[: len(h) - k + 1].copy()
    for i in range(1, k):
        out = mix64(out * _STEP + h[i: len(h) - k + 1 + i])
    return np.unique(out, return_counts=True)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Probability Jaccard of two bags; 1 for two empty ones."""
    if not len(a[0]) or not len(b[0]):
        return float(len(a[0]) == len(b[0]))
    ids = np.union1d(a[0], b[0])
    x, y = np.zeros(len(ids)), np.zeros(len(ids))
    x[np.searchsorted(ids, a[0])], y[np.searchsorted(ids, b[0])] = a[1], b[1]
    both = (x > 0) & (y > 0)
    # sum_t max(x_t / x_s, y_t / y_s) depends on s only through x_s / y_s: sort once, use running sums
    with np.errstate(divide="ignore"):
        ratio = np.where(y > 0, x / np.where(y > 0, y, 1), np.inf)
    order = np.argsort(ratio, kind="stable")
    sx, sy, sr = x[order], y[order], ratio[order]
    x_above = np.concatenate([np.cumsum(sx[::-1])[::-1], [0.0]])   # sum of x where x_t/y_t is at least ...
    y_below = np.concatenate([[0.0], np.cumsum(sy)])
    at = np.searchsorted(sr, ratio[both], "left")
    return float(np.sum(1.0 / (x_above[at] / x[both] + y_below[at] / y[both])))


def signature(ids: np.ndarray, weights: np.ndarray, registers: int) -> np.ndarray:
    """ProbMinHash: per register the shingle whose Poisson process reached it first."""
    best = np.full(registers, np.inf)
    who = np.zeros(registers, np.uint64)
    if not len(ids):
        return who
    at, w = np.zeros(len(ids)), weights.astype(float)
    live, seed, drawn = ids, ids, 0
    expected = registers * (np.log(registers) + 1)
    while len(live):
        k = max(1, int(expected * 0.6 / len(live)))             # arrivals per shingle in this batch
        n = np.arange(drawn + 1, drawn + k + 1, dtype=np.uint64) * _STEP
        r = mix64(seed[:, None] + n[None, :])
        gap = -np.log(((r >> np.uint64(11)).astype(float) + 0.5) * 2.0 ** -53) / w[:, None]
        time = at[:, None] + np.cumsum(gap, axis=1)
        reg = (mix64(r) >> np.uint64(32)) * np.uint64(registers) >> np.uint64(32)
        t, g, s = time.ravel(), reg.ravel().astype(np.int64), np.repeat(live, k)
        top = best.max()
        if top < np.inf:                                        # early termination: too late for any register
            early = t < top
            t, g, s = t[early], g[early], s[early]
        order = np.lexsort((s, t))[::-1]                        # the earliest is written last and stays
        t, g, s = t[order], g[order], s[order]
        new, new_who = np.full(registers, np.inf), np.zeros(registers, np.uint64)
        new[g], new_who[g] = t, s
        better = new < best
        best[better], who[better] = new[better], new_who[better]
        at = time[:, -1]
        keep = at < best.max()
        live, seed, at, w = live[keep], seed[keep], at[keep], w[keep]
        drawn += k
    return who


def bands(sig: np.ndarray, n_bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band of ``rows`` registers."""
    s = sig.reshape(n_bands, rows)
    out = np.arange(1, n_bands + 1, dtype=np.uint64) * _STEP
    for i in range(rows):
        out = mix64(out ^ s[:, i]) + _STEP
    return out.view(np.int64)


NODE = T.StructType([T.StructField("node", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType()))])


def signed(text: Column, n_bands: int = BANDS, rows: int = ROWS) -> Column:
    """(node, bands) of each text: the hash of its words and its band keys (none without words)."""
    @F.arrow_udf(NODE)
    def sign(texts: pa.Array) -> pa.Array:
        nodes, keys = [], []
        for text in each(texts):
            words = words_of(text)
            nodes.append(hashlib.md5(b" ".join(words)).digest())
            keys.append(bands(signature(*bag(words), n_bands * rows), n_bands, rows) if words else [])
        return pa.StructArray.from_arrays([pa.array(nodes, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                                          ["node", "bands"])

    return sign(text)


@F.arrow_udf(T.DoubleType())
def text_similarity(a: pa.Array, b: pa.Array) -> pa.Array:
    """Exact similarity of two text columns. Pairs of one leader come together, so its bag is kept."""
    out, last, left = [], None, None
    for x, y in zip(each(a), each(b), strict=True):
        if left is None or x != last:
            last, left = x, bag(words_of(x))
        out.append(similarity(left, bag(words_of(y))))
    return pa.array(out, pa.float64())


def most_alike(before_a, all_a, kinds_a, at_a, before_b, all_b, kinds_b, at_b, greatest=max, least=min):
    """An upper bound of the similarity of two bags whose first common shingle, in an order of all, is known.

    at: the bag's shingles before it; before: their weight; kinds and all: its
    shingles and their weight. Those before it are not in the other bag, so at most
    ``common`` shingles are in both, and each of the rest weighs 1 or more. If u and v
    are the shares of the bags' weight outside each other, J <= (1 - u)(1 - v) / (1 - uv).
    """
    common = least(kinds_a - at_a, kinds_b - at_b)
    u = greatest(before_a, kinds_a - common) / all_a
    v = greatest(before_b, kinds_b - common) / all_b
    return (1 - u) * (1 - v) / (1 - u * v)


_BAG = T.ArrayType(T.StructType([T.StructField("shingle", T.LongType()), T.StructField("weight", T.LongType())]))


@F.arrow_udf(_BAG)
def _bags(texts: pa.Array) -> pa.Array:
    ids, weights, ends = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [0]
    for t in each(texts):
        own = bag(words_of(t))
        ids.append(own[0])
        weights.append(own[1])
        ends.append(ends[-1] + len(own[0]))
    rows = pa.StructArray.from_arrays([pa.array(np.concatenate(ids).view(np.int64)), pa.array(np.concatenate(weights))],
                                      ["shingle", "weight"])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows)


def near_pairs(nodes: DataFrame, threshold: float) -> DataFrame:
    """a, b: every pair of nodes of two classes that can be near. ``nodes``: node, label, text.

    With u, v as in ``most_alike``, J >= t needs u, v <= 1 - t, and the less of them
    <= (1 - t) / (1 + t). So in an order of all shingles, the first that two near bags
    have in common is among the first of either that outweigh 1 - t, and of one among
    the first that outweigh (1 - t) / (1 + t). The order begins with the shingles that only
    one class holds: nodes of two classes never have them in common, so they are not
    listed but only counted and weighed, node by node. The others follow by the number of nodes
    that hold them, the rarest first. Nodes meet on these prefixes if ``most_alike``
    allows the threshold at that place; the row of the first common shingle always
    does. A shingle's rows of its largest class meet only those of other classes.
    """
    # dealt evenly: the texts of a large group lie together otherwise, and their bags are the work here
    even = nodes.repartition(int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    bags = even.select("node", "label", _bags("text").alias("bag"))
    weight = F.aggregate("bag.weight", F.lit(0).cast("long"), lambda x, w: x + w)
    bags = bags.select("*", F.size("bag").alias("kinds"), weight.alias("all"))
    # outer: a plain explode is given a filter on the bags, which would make them a second time, before they are dealt
    own = stage(bags.select("node", "label", "kinds", "all", F.explode_outer("bag").alias("s")).where("s is not null")
                .select("node", "label", "kinds", "all", "s.*"), "shingles")
    seen = stage(own.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.min("label").alias("lo"), F.max("label").alias("hi"))
                 .where("lo < hi").select("shingle", "n"), "counts")
    every, order = Window.partitionBy("node"), Window.partitionBy("node").orderBy("n", "shingle")
    placed = (own.join(seen, "shingle")
              .withColumn("at", F.row_number().over(order) - 1 + F.col("kinds") - F.count(F.lit(1)).over(every))
              .withColumn("before", F.sum("weight").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("weight")
                          + F.col("all") - F.sum("weight").over(every)))
    share = F.col("before") / F.col("all") - 1e-9               # a rounding more, never one less
    rows = stage(placed.where(share <= 1 - threshold)
                 .select("shingle", "node", "label", "before", "all", "kinds", "at",
                         (share <= (1 - threshold) / (1 + threshold)).alias("short")), "prefixes")
    by_class = rows.groupBy("shingle", "label").agg(F.count(F.lit(1)).alias("n"))
    mixed = stage(by_class.groupBy("shingle").agg(F.max(F.struct("n", "label"))["label"].alias("most"), F.count(F.lit(1)).alias("k"))
                  .where("k > 1").select("shingle", "most"), "mixed")
    rows = stage(rows.join(mixed, "shingle"), "prefixes")
    side = lambda x: [F.col(c).alias(f"{c}_{x}") for c in ("node", "label", "before", "all", "kinds", "at", "short")]
    minor = rows.where("label <> most").select("shingle", *side("a"))
    bound = most_alike(*(F.col(f"{c}_{x}") for x in "ab" for c in ("before", "all", "kinds", "at")), F.greatest, F.least)
    met = minor.hint("merge").join(rows.select(F.col("shingle").alias("same"), *side("b")),
                                   (F.col("shingle") == F.col("same")) & (F.col("label_a") != F.col("label_b"))
                                   & (F.col("short_a") | F.col("short_b")) & (bound >= threshold - 1e-9))
    return (met.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).dropDuplicates())


def classes(links: DataFrame) -> DataFrame:
    """node, label: the least node of its connected component, by label passing with jumps.

    ``links`` has columns a, b. In each pass every node takes the least label
    among its neighbours', its old label (a node too) is hung under it, and
    labels jump to their labels. Every pass is written, and the loop ends when
    nothing changed. Nodes without links are not in the result.
    """
    both = stage(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
                 .where("a <> b").dropDuplicates(), "links")
    label = stage(both.groupBy("a").agg(F.least("a", F.min("b")).alias("label")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = (both.join(label.select(F.col("node").alias("b"), "label"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near")))
        seen = label.join(near, "node").select("node", "label", F.least("label", "near").alias("new"))
        none = F.lit(None).cast("binary")
        lower = (seen.select("node", "new", F.col("label").alias("was"))
                 .unionByName(seen.select(F.col("label").alias("node"), "new", none.alias("was")))
                 .groupBy("node").agg(F.min("new").alias("new"), F.max("was").alias("was")))
        hung = stage(lower, "labels")
        jump = hung.select(F.col("node").alias("new"), F.col("new").alias("jump"))
        changes = Observation()
        label = stage(hung.join(jump, "new", "left")
                      .select("node", F.least("new", F.coalesce("jump", "new")).alias("label"), "was")
                      .observe(changes, F.count_if(F.col("label") != F.col("was")).alias("n")).drop("was"), "labels")
        if not changes.get.get("n", 0):
            return label


def _row_key() -> list[Column]:
    """128 bits of hash that name a row by id and text; equal rows share it."""
    return [F.xxhash64("doc_id", "text").alias("_k1"), F.xxhash64(F.lit("row"), "text", "doc_id").alias("_k2")]


class _Linker:
    """Verified links so far, the classes they make, and the pairs already compared."""

    def __init__(self, texts: DataFrame, threshold: float):
        spark = texts.sparkSession
        self.texts, self.threshold = texts, threshold
        self.links = spark.createDataFrame([], "a binary, b binary, similarity double")
        self.label = spark.createDataFrame([], "node binary, label binary")
        self.tested = spark.createDataFrame([], "a binary, b binary")

    def compare(self, pairs: DataFrame) -> bool:
        """Verify the pairs not compared before; True if there were new links."""
        pairs = stage(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).dropDuplicates()
                      .join(self.tested, ["a", "b"], "left_anti"), "pairs")
        self.tested = self.tested.unionByName(pairs)
        text = self.texts
        both = (pairs.join(text.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b")
                .join(text.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a"))
        found = stage(both.withColumn("similarity", text_similarity(F.col("ta"), F.col("tb")))
                      .where(F.col("similarity") >= self.threshold).select("a", "b", "similarity"), "verified")
        if not found.limit(1).count():
            return False
        self.links = self.links.unionByName(found)
        self.merge(found)
        return True

    def merge(self, found: DataFrame) -> None:
        """Join the classes that new links connect; the old links are not looked at again."""
        name = lambda x: self.label.select(F.col("node").alias(x), F.col("label").alias(f"l{x}"))
        joined = classes(found.join(name("a"), "a", "left").join(name("b"), "b", "left")
                         .select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b")))
        to = joined.withColumnRenamed("label", "to").withColumnRenamed("node", "label")
        kept = self.label.join(to, "label", "left").select("node", F.coalesce("to", "label").alias("label"))
        alone = joined.join(self.label.select("node"), "node", "left_anti")
        self.label = stage(kept.unionByName(alone), "node-labels")

    def open(self, members: DataFrame) -> DataFrame:
        """The members of buckets that hold more than one class, with their class as ``label``."""
        known = stage(members.join(self.label, "node", "left").withColumn("label", F.coalesce("label", "node")), "labelled")
        mixed = known.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi"),
                                            F.count(F.lit(1)).alias("n")).where("lo < hi")
        return stage(known.join(mixed.select("bucket", "n"), "bucket"), "open")

    def rounds(self, buckets: DataFrame, most: int) -> DataFrame:
        """Compare each bucket's members with a leader of another class, ``most`` times or until nothing
        is found; the first leader is the node in most buckets. Returns the buckets still open."""
        done = 0
        while done < most and buckets.limit(1).count():
            draw = F.struct(F.col("rank") if not done else F.lit(0), F.xxhash64(F.lit(done), F.col("node")))
            leader = buckets.groupBy("bucket").agg(F.min(F.struct(draw.alias("draw"), "node", "label")).alias("l"))
            pairs = (buckets.join(leader, "bucket").where(F.col("l.label") != F.col("label"))
                     .select(F.col("l.node").alias("a"), F.col("node").alias("b")))
            done += 1
            if not self.compare(pairs):
                break
            buckets = self.open(buckets.drop("label", "n"))
        return buckets

    def finish(self, buckets: DataFrame) -> None:
        """Every pair of a bucket across classes that no round compared."""
        other = buckets.select("bucket", F.col("node").alias("b"), F.col("label").alias("other"))
        self.compare(buckets.join(other, "bucket").where((F.col("node") < F.col("b")) & (F.col("label") != F.col("other")))
                     .select(F.col("node").alias("a"), "b"))

    def finish_large(self, buckets: DataFrame) -> None:
        """Every near pair of the buckets' nodes across classes, by rare shingles."""
        nodes = buckets.select("node", "label").dropDuplicates(["node"])
        if nodes.limit(1).count():
            self.compare(near_pairs(stage(nodes.join(self.texts, "node"), "large"), self.threshold))


def _shared(members: DataFrame) -> DataFrame:
    """Members of buckets of two or more, with ``rank``: minus the number of such buckets of the node."""
    full = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    members = stage(members.join(full, "bucket"), "shared")
    return members.join(members.groupBy("node").agg((-F.count(F.lit(1))).alias("rank")), "node")


def verified_links(docs: DataFrame, nodes: DataFrame, threshold: float, rounds: int,
                   small: int) -> tuple[DataFrame, DataFrame]:
    """(links, labels): pairs of nodes at ``threshold`` or more, and the classes they make.

    ``nodes`` has one row per distinct word sequence: node, bands and ``first``,
    the row that lends its text.
    """
    members = stage(_shared(nodes.select("node", F.posexplode("bands").alias("band", "key"))
                            .select("node", F.xxhash64("band", "key").alias("bucket"))), "members")
    lenders = (nodes.join(members.select("node").distinct(), "node", "left_semi")
               .select("node", "first._k1", "first._k2"))
    # nodes in shared buckets grow with the corpus: dealt by row at every size
    texts = stage(docs.select(*_row_key(), "text").join(lenders.hint("shuffle_hash"), ["_k1", "_k2"])
                  .dropDuplicates(["node"]).select("node", "text"), "texts")
    linker = _Linker(texts, threshold)
    left = linker.rounds(members.withColumn("label", F.col("node")).withColumn("n", F.lit(0)), rounds)
    left = linker.open(left.drop("label", "n"))
    linker.finish(linker.open(left.where(F.col("n") <= small).select("bucket", "node")))
    linker.finish_large(linker.open(left.where(F.col("n") > small).drop("label", "n")))
    return linker.links, linker.label


def near_classes(docs: DataFrame, threshold: float = SIMILARITY, n_bands: int = BANDS, rows: int = ROWS,
                 rounds: int = ROUNDS, small: int = SMALL_BUCKET) -> DataFrame:
    """One row per input row: doc_id, class_id, kept, _k1, _k2.

    ``class_id`` is the least doc_id of the class (NULL only if no row of it has
    one); ``kept`` marks the row that stands for the class, the first by id and
    text hash (equal rows are all marked). Texts without words, NULL included,
    are copies of each other; texts of fewer than five words are near only to
    equal ones. Other columns are ignored; an empty table gives no rows.
    """
    one = stage(docs.select("doc_id", *_row_key(), signed(F.col("text"), n_bands, rows).alias("s"))
                .select("doc_id", "_k1", "_k2", "s.*"), "signed")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_k1", "_k2")
    nodes = stage(one.groupBy("node").agg(F.min(place).alias("first"), F.first("bands").alias("bands")), "nodes")
    _, label = verified_links(docs, nodes, threshold, rounds, small)
    of = nodes.join(label, "node", "left").select("node", F.coalesce("label", "node").alias("label"), "first")
    of = stage(of, "node-labels")
    heads = of.groupBy("label").agg(F.min("first").alias("head"))
    head = stage(of.join(heads, "label").select("node", "head"), "heads")
    return one.join(head, "node").select(
        "doc_id", F.col("head.doc_id").alias("class_id"),
        ((F.col("_k1") == F.col("head._k1")) & (F.col("_k2") == F.col("head._k2"))).alias("kept"), "_k1", "_k2")


def drop_near_duplicates(docs: DataFrame, **parameters) -> DataFrame:
    """The documents that stand for their classes, one row each; the columns of ``docs``."""
    keep = stage(near_classes(docs, **parameters).where("kept").select("_k1", "_k2").dropDuplicates(), "kept")
    # as many rows as documents: dealt by row at every size
    return (docs.select(F.struct("*").alias("_row"), *_row_key()).join(keep.hint("merge"), ["_k1", "_k2"])
            .dropDuplicates(["_k1", "_k2"]).select("_row.*"))
