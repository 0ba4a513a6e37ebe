import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from nestlift.llm.fingerprint import Digest, _ranged, edited, edited_fingerprints, likeness
from nestlift.llm.near_dedup import (bag, classes, drop_near_duplicates, mix64, most_alike, near_classes, near_pairs,
                                     signature, similarity, words_of)


def exact(x, y):
    s = 0.0
    for k in x:
        if k in y:
            s += 1 / sum(max(x.get(t, 0) / x[k], y.get(t, 0) / y[k]) for t in set(x) | set(y))
    return s


def test_similarity_and_signature_estimate_probability_jaccard():
    rng = np.random.default_rng(0)
    errors = []
    for _ in range(30):
        n = int(rng.integers(1, 40))
        ids = np.sort(mix64(rng.integers(1, 2**62, n).astype(np.uint64)))
        x = rng.integers(0, 4, n)
        y = np.where(rng.random(n) < .8, x, rng.integers(0, 4, n))
        a, b = (ids[x > 0], x[x > 0]), (ids[y > 0], y[y > 0])
        if len(a[0]) and len(b[0]):
            want = exact(dict(zip(*map(np.ndarray.tolist, a))), dict(zip(*map(np.ndarray.tolist, b))))
            assert similarity(a, b) == pytest.approx(want)
            errors.append(float((signature(*a, 1024) == signature(*b, 1024)).mean()) - want)
    assert abs(np.mean(errors)) < 0.02 and max(map(abs, errors)) < 0.08


def test_bags():
    assert [len(x) for x in bag([])] == [0, 0]
    ids, n = bag([b"a"] * 8)
    assert len(ids) == 1 and n.tolist() == [4]
    assert bag([b"a", b"b"])[1].tolist() == [1]        # fewer than five words: one shingle
    assert words_of("a\x85b\x0bc  d") == ["a\x85b".encode(), b"c", b"d"]


def brute_classes(rows):
    bags = [bag(words_of(t)) for _, t in rows]
    words = [words_of(t) for _, t in rows]
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if words[i] == words[j] or similarity(bags[i], bags[j]) >= .8:
                up[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return Counter((doc, least.get(find(i))) for i, (doc, _) in enumerate(rows))


def near_rows(seed):
    rnd = random.Random(seed)
    voc = [f"w{i}" for i in range(400)]
    rows = []
    for g in range(12):
        base = [rnd.choice(voc) for _ in range(rnd.choice([3, 6, 60, 150]))]
        for _ in range(rnd.choice([1, 2, 12])):
            t = list(base)
            for _ in range(rnd.choice([0, 0, 1, 2, 4])):
                t[rnd.randrange(len(t))] = rnd.choice(voc)
            rows.append((len(rows), rnd.choice([" ", "\n", "  "]).join(t)))
    hot = [rnd.choice(voc) for _ in range(140)]        # one large group, its copies at all distances
    for _ in range(60):
        t = list(hot)
        for _ in range(rnd.randint(0, 7)):
            t[rnd.randrange(len(t))] = rnd.choice(voc)
        rows.append((len(rows), " ".join(t)))
    return rows + [(900, ""), (901, None), (902, " \n"), (None, rows[0][1]), (3, rows[3][1]), (903, "lone"), (904, "lone")]


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_equal_brute_force(spark, seed):
    rows = near_rows(seed)
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING").withColumn("label", F.lit("x")).withColumn("bucket", F.lit(1))
    got = near_classes(docs, small=8).collect()
    assert Counter((r.doc_id, r.class_id) for r in got) == brute_classes(rows)
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({r.class_id for r in got})


def test_near_pairs_that_share_a_template(spark):
    rnd = random.Random(4)
    word = lambda: f"w{rnd.randrange(10**6)}"
    template, rows = [word() for _ in range(200)], []
    for i in range(400):                               # all are much alike (0.79), few pairs are near (0.83)
        own = [word() for _ in range(5)]
        for _ in range(2 if i % 50 == 0 else 1):
            rows.append((len(rows), " ".join([*template, *own, *(word() for _ in range(21))])))
    got = near_classes(spark.createDataFrame(rows, "doc_id LONG, text STRING"), small=2).collect()
    want = brute_classes(rows)
    assert len({c for _, c in want}) == 400
    assert Counter((r.doc_id, r.class_id) for r in got) == want


def test_first_common_shingle_bounds_the_similarity():
    rng, near, apart = np.random.default_rng(3), 0, 0
    for _ in range(3000):
        ids = np.sort(mix64(rng.integers(1, 2**62, 30).astype(np.uint64)))
        x = rng.integers(0, 9 if rng.random() < .5 else 2, 30) * (rng.random(30) < .95)
        y = np.where(rng.random(30) < rng.uniform(.3, 1), x * rng.integers(1, 3), rng.integers(0, 3, 30))
        a, b = (ids[x > 0], x[x > 0]), (ids[y > 0], y[y > 0])
        order = rng.permutation(30)                                 # any order of all shingles will do
        both = [i for i in order if x[i] > 0 and y[i] > 0]
        if not both:
            continue
        before = order[: list(order).index(both[0])]
        place = [f for z in (x, y) for f in (z[before].sum(), z.sum(), (z > 0).sum(), (z[before] > 0).sum())]
        bound, true = most_alike(*place), similarity(a, b)
        assert true <= bound + 1e-9
        apart += bound < .8
        if true >= .8:
            near += 1
            u, v = place[0] / place[1], place[4] / place[5]
            assert max(u, v) <= .2 + 1e-9 and min(u, v) <= .2 / 1.8 + 1e-9
    assert near > 100 and apart > 100


def test_near_pairs_find_every_near_pair_and_few_others(spark):
    rnd = random.Random(8)
    word = lambda: f"w{rnd.randrange(10**6)}"
    base, rows = [word() for _ in range(150)], []
    for i in range(300):                                            # one group of near copies with 0 to 12 edits
        t = list(base)
        for _ in range(rnd.randint(0, 12)):
            t[rnd.randrange(len(t))] = word()
        rows.append((f"{i:04d}".encode(), " ".join(t)))
    bags = {n: bag(words_of(t)) for n, t in rows}
    want = {(a, b) for a in bags for b in bags if a < b and similarity(bags[a], bags[b]) >= .8}
    alone = spark.createDataFrame([(n, n, t) for n, t in rows], "node binary, label binary, text string")
    got = {(bytes(r.a), bytes(r.b)) for r in near_pairs(alone, .8).collect()}
    assert want and want <= got
    # once the texts of up to three edits are one class, hardly any of the others can be near it
    one = {n: rows[0][0] if similarity(bags[n], bag([w.encode() for w in base])) >= .8 else n for n, _ in rows}
    classed = spark.createDataFrame([(n, one[n], t) for n, t in rows], "node binary, label binary, text string")
    left = {(bytes(r.a), bytes(r.b)) for r in near_pairs(classed, .8).collect()}
    assert {p for p in want if one[p[0]] != one[p[1]]} <= left and len(left) < 300


def test_shingles_of_one_class_come_first(spark):
    words = lambda x: " ".join(f"{x}{j}" for j in range(60))
    # pairs across two classes share a rare half, and each class has a frequent half of its own: none can be near
    rows = [(f"{c}{i:02d}".encode(), c.encode(), f"{words(c)} {words(f'own{i}_')}") for i in range(20) for c in "ab"]
    nodes = spark.createDataFrame(rows, "node binary, label binary, text string")
    assert near_pairs(nodes, .8).count() == 0
    # a lower threshold meets all of them
    assert near_pairs(nodes, .3).count() >= 20


def test_near_classes_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id LONG, text STRING")
    assert near_classes(docs).count() == 0 and drop_near_duplicates(docs).count() == 0


def test_components_of_long_chains(spark):
    chain = [(f"{i:04d}".encode(), f"{i + 1:04d}".encode()) for i in range(60)]
    random.Random(1).shuffle(chain)
    got = classes(spark.createDataFrame([*chain, (b"9000", b"9001"), (b"9001", b"9000")], "a BINARY, b BINARY")).collect()
    assert Counter(bytes(r.label) for r in got) == {b"0000": 61, b"9000": 2}


def test_edited_fingerprints_follow_the_next_document(spark):
    rows = [(i * 3 % 101, f"text {i} " * (i % 7) if i % 5 else None) for i in range(101)] + [(None, "last é")]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING").withColumn("h", F.lit(0)).repartition(7)
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    got = {r.doc_id: r for r in edited_fingerprints(docs).collect()}
    assert len(got) == len(rows)
    for i, (doc, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        new, r = edited(text, after), got[doc]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(new.encode()).hexdigest())
        assert r.fingerprint == str(Digest(text)) and r.edited_fingerprint == str(Digest(new))
        assert r.near_edited == likeness(Digest(text), Digest(new)) and r.near_next == likeness(Digest(text), Digest(after))


def test_hot_and_null_ids_are_cut_by_their_texts(spark):
    rnd = random.Random(11)
    rows = [(rnd.choice([None, None, 7, 7, rnd.randint(0, 30), 2**60 + rnd.randint(0, 9)]), f"text {i} " * (i % 5 + 1)) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING").repartition(5)
    counted = _ranged(docs, 32).groupBy("rng").agg(F.count(F.lit(1)).alias("n"), F.collect_set("doc_id").alias("ids"),
                                                   F.count_if(F.col("doc_id").isNull()).alias("null")).collect()
    assert sum(r.n for r in counted) == 900
    for hot in (lambda r: r.null, lambda r: r.ids == [7]):
        own = [r.n for r in counted if hot(r)]
        assert len(own) >= 6 and max(own) <= 100
    # the order of ranges is the order of (id, hash): each document is followed by the next one
    order = [r.text for r in docs.orderBy(F.col("doc_id").asc_nulls_last(), F.xxhash64("text")).collect()]
    want = Counter(hashlib.sha256(edited(t, order[(i + 1) % 900]).encode()).hexdigest() for i, t in enumerate(order))
    assert Counter(r.edited_sha256 for r in edited_fingerprints(docs).collect()) == want


def test_edges_of_the_order(spark):
    one = spark.createDataFrame([(5, "abcdefgh")], "doc_id LONG, text STRING")
    r = edited_fingerprints(one).first()
    assert r.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and r.near_next == 1.0
    assert edited_fingerprints(one.limit(0)).count() == 0
    assert edited_fingerprints(one.union(one)).count() == 2


def test_edits_stay_nearer_than_other_texts():
    rnd = random.Random(1)
    word = lambda: "".join(rnd.choice("etaoinshrdlu") for _ in range(rnd.randint(2, 9)))
    a, b = (" ".join(word() for _ in range(400)) for _ in range(2))
    assert likeness(Digest(a), Digest(a)) == 1.0
    assert likeness(Digest(a), Digest(edited(a, b))) > likeness(Digest(a), Digest(b)) >= 0.0
    assert 0.0 <= likeness(Digest(""), Digest(a)) <= 1.0 and str(Digest("ab")) != str(Digest("cd"))
