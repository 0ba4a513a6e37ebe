import heapq
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from nestlift.llm.line_dedup import _shortest_runs, dedup_lines, mark_runs
from nestlift.llm.mixing import apportion, mix, write_mix
from nestlift.llm.near_dedup import drop_near_duplicates

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_apportion_equals_highest_quotients(spark):
    rnd = random.Random(3)
    seats = {g: rnd.choice([0, 1, 7, 100, 3000]) for g in range(20)}
    rows = [(g, k, float(rnd.choice([0, 1, 3, rnd.randint(1, 10 ** rnd.randint(1, 6))])), seats[g])
            for g in seats for k in range(rnd.choice([1, 2, 5, 40]))]
    df = spark.createDataFrame(rows, "g INT, k INT, w DOUBLE, seats LONG")
    got = {(r.g, r.k): r.q for r in apportion(df, ["g"], ["k"], "w", "seats", "q").collect()}
    assert len(got) == len(rows)
    for g, n in seats.items():
        cells = [(k, w) for gg, k, w, _ in rows if gg == g and w > 0]
        q = {k: 0 for k, _ in cells}
        heap = [(-w, k, w) for k, w in cells]
        heapq.heapify(heap)
        for _ in range(n if cells else 0):
            _, k, w = heapq.heappop(heap)
            q[k] += 1
            heapq.heappush(heap, (-w / (2 * q[k] + 1), k, w))
        assert all(got[g, k] == v for k, v in q.items())


def targets(sizes, weights=(5, 2, 1), share=1.5, stop=2.0):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    left, rest, out = set(names), share * sum(sizes.values()), {}
    while left:
        total = sum(w[n] for n in left)
        cur = {n: rest * w[n] / total for n in left}
        over = [n for n in left if cur[n] > stop * sizes[n]]
        if not over:
            return {**out, **cur}
        for n in over:
            out[n] = stop * sizes[n]
            rest -= out[n]
            left.discard(n)
    return out


def test_mix_meets_targets(spark):
    rnd = random.Random(5)
    rows = [(i if i % 9 else None, " ".join("w" * rnd.randint(1, 3) for _ in range(rnd.choice([0, 1, 30, 400]))) if i % 11 else None,
             rnd.choice(["b", "a", "ä", None, "hot", "hot", "hot"]), "x") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, source STRING, target STRING").repartition(5)
    out = mix(docs, shard_words=3000)
    got = out.collect()
    assert len(got) == len(rows)
    size, taken, target = Counter(), Counter(), {}
    for r in got:
        size[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 2 * r.size
    want = targets(dict(size))
    for s, t in want.items():
        assert target[s] == pytest.approx(t) and all(r.source_size == size[s] for r in got if r.source == s)
        assert abs(taken[s] - t) <= 0.02 * size[s] + 64
    again = mix(docs.repartition(3, "source"), shard_words=3000).collect()
    key = lambda r: (str(r.doc_id), r.size, str(r.source), r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))          # reruns agree, however the rows are dealt
    assert mix(docs.limit(0)).count() == 0
    blank = mix(docs.select("doc_id", "source", F.lit(" \n").alias("text"))).agg(F.sum("taken"), F.max("target")).first()
    assert tuple(blank) == (0, 0.0)


def test_write_mix_keeps_columns_and_whole_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = write_mix(docs, block_words=256)
    assert out.columns == docs.columns
    texts = {r.doc_id: r.text for r in docs.collect()}
    times = Counter()
    for r in out.collect():
        assert texts[r.doc_id] == r.text
        times[r.doc_id] += 1
    assert max(times.values()) <= 2
    words = {k: len(WORD.findall(t)) for k, t in texts.items()}
    assert sum(words[k] * n for k, n in times.items()) == pytest.approx(1.5 * sum(words.values()), rel=0.15)


def test_small_sources_keep_their_share_in_parts(spark):
    rows = [(i, f"{i} " + "w " * 49, "large") for i in range(10_000)]
    rows += [(20_000 + i, f"{i} " + "x " * 49, "mid") for i in range(100)]
    rows += [(30_000 + i, f"{i} " + "y " * 49, "small") for i in range(10)] + [(40_000, "z " * 50, "tiny")]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, source STRING")
    taken, cut = Counter(), 0
    texts = {r[0]: r[1] for r in rows}
    for r in write_mix(docs, parts=True).collect():
        taken[r.source] += len(WORD.findall(r.text))
        cut += r.text != texts[r.doc_id]
    for s, t in targets({"large": 500_000, "mid": 5_000, "small": 500, "tiny": 50}).items():
        assert abs(taken[s] - t) <= 50 * (5 if s == "large" else 1), (s, taken[s], t)      # one document a shard
    assert cut <= 2 * (5 + 3)                            # two documents a shard


CLASHES = ("_key", "_doc", "_text", "_cut", "_k1", "_k2", "_row", "_times", "_copy", "_whole", "_rest", "_at", "shard", "label")


def test_columns_that_clash_with_helper_names_pass_through(spark):
    run = " ".join(f"w{i}" for i in range(60))
    rows = [(1, run, "a", 5), (2, run + "\nown words", "a", 5), (3, "other", "b", 5), (None, None, None, None), (4, "other", "b", 5)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, source STRING, n_chars LONG")
    docs = docs.select("*", *[F.lit(n).alias(n) for n in CLASHES])
    for out in (dedup_lines(docs, drop_emptied=True), write_mix(docs, parts=True), write_mix(docs), drop_near_duplicates(docs)):
        assert out.columns == docs.columns
        got = out.collect()
        assert got and all(r[n] == n for r in got for n in CLASHES)
    assert {r.doc_id for r in drop_near_duplicates(docs).collect()} == {1, 3, None}


def test_parts_meet_targets_with_a_very_long_document(spark):
    rnd = random.Random(6)
    rows = [(i, f" \n{i} " + "w\t " * rnd.randint(100, 500), "abc"[i % 3], 0) for i in range(600)]
    rows += [(1000, "x " * 200_000, "c", 0), (1001, "y  " * 30_000, "b", 0), (1002, None, "a", 0), (1003, " ", "a", 0)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, source STRING, n_chars LONG")
    got = write_mix(docs, parts=True).collect()
    size, texts = Counter(), {r[0]: r[1] for r in rows}
    for _, t, s, _ in rows:
        size[s] += len(WORD.findall(t or ""))
    taken, cut = Counter(), Counter()
    for r in got:
        taken[r.source] += len(WORD.findall(r.text or ""))
        if r.text != texts[r.doc_id]:
            cut[r.doc_id] += 1
            assert texts[r.doc_id].startswith(r.text) and r.n_chars == len(r.text)
    for s, t in targets(dict(size)).items():
        assert abs(taken[s] - t) <= 2 * 2048, (s, taken[s], t)
    assert cut[1000] == 1 and max(cut.values()) == 1 and {1002, 1003} <= {r.doc_id for r in got}


def brute(rows, least):
    """Texts without runs of `least` words or more that occur earlier: longest earlier match of every suffix."""
    order = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    lines = [[(p, x, len(WORD.findall(x))) for p, x in enumerate((t or "").split("\n")) if WORD.search(x)] for _, t, _ in order]
    active = {(d, i): x[1] for d, ls in enumerate(lines) for i, x in enumerate(ls)}
    longest, m = defaultdict(int), 1
    while active:
        first, n = {}, Counter(active.values())
        for at in sorted(active):
            if first.setdefault(active[at], at) != at:
                longest[at] = m
        active = {(d, i): (name, lines[d][i + m][1]) for (d, i), name in active.items() if n[name] > 1 and i + m < len(lines[d])}
        m += 1
    out = {}
    for d, (doc, t, h) in enumerate(order):
        gone = set()
        for i, (p, _, _) in enumerate(lines[d]):
            k = longest[d, i]
            if k and sum(x[2] for x in lines[d][i:i + k]) >= least:
                gone.update(range(p, lines[d][i + k - 1][0] + 1))
        for (p, _, _), (q, _, _) in zip(lines[d], lines[d][1:], strict=False):
            if p in gone and q in gone:
                gone.update(range(p, q))
        out[doc, t] = t if t is None else "\n".join(x for p, x in enumerate(t.split("\n")) if p not in gone)
    return out


@pytest.mark.parametrize("seed,least", [(1, 6), (2, 10), (3, 1), (4, 50)])
def test_line_runs_equal_brute_force(spark, seed, least):
    rnd = random.Random(seed)
    pool = [" ".join(f"w{rnd.randint(0, 50)}" for _ in range(rnd.randint(1, 9))) for _ in range(12)]
    rows = []
    for i in range(60):
        lines = [rnd.choice(pool) if rnd.random() < .7 else f"own {i} {k}" for k in range(rnd.randint(0, 12))]
        if rnd.random() < .3:
            lines.insert(rnd.randint(0, len(lines)), rnd.choice(["", "  ", "\t"]))
        rows.append((i, "\n".join(lines)))
    rows += [(100, rows[3][1]), (None, rows[4][1]), (200, None), (201, ""), (5, rows[5][1]), (202, "\n".join([pool[0]] * 40))]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING").withColumn("idx", F.lit("clash")).withColumn("n_chars", F.length("text"))
    hashed = [tuple(r) for r in docs.select("doc_id", "text", F.xxhash64("text")).collect()]
    want = brute(hashed, least)
    out = dedup_lines(docs, least)
    assert out.columns == docs.columns
    got = out.collect()
    assert Counter((r.doc_id, r.text, r.n_chars) for r in got) == Counter(
        (d, want[d, t], None if t is None else len(want[d, t])) for d, t in rows)
    kept = dedup_lines(docs, least, drop_emptied=True).collect()
    assert Counter((r.doc_id, r.text) for r in kept) == Counter(
        (d, want[d, t]) for d, t in rows if want[d, t] == t or WORD.search(want[d, t]))


def test_line_runs_of_nothing(spark):
    docs = spark.createDataFrame([(1, "a b\nc"), (2, "d")], "doc_id LONG, text STRING")
    assert [r.text for r in dedup_lines(docs, 1).orderBy("doc_id").collect()] == ["a b\nc", "d"]
    assert mark_runs(docs.limit(0)).count() == 0


def test_run_lengths_are_worked_out_once_per_line(spark):
    """A run's length is searched for in up to 50 lines: not again wherever its name uses it."""
    lines = spark.createDataFrame([], "ls array<struct<idx:int,pos:int,words:long,sum:long,r:array<long>>>")
    plan = lines.select(_shortest_runs(F.col("ls"), 50, 6).alias("w"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("array_position(") == 2
