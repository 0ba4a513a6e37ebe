import hashlib
import html
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from nestlift.llm import site_tree
from nestlift.llm.divergence import block_sums, divergence, terms_of
from nestlift.llm.site_tree import extract, main_text, page_facts, parse
from nestlift.llm.va_file import Cells, _packed, _unpacked, bounds, cell_edges, cluster, left, nearest

# ---------------------------------------------------------------- op11


def brute_divergence(rows, min_docs=3, ranks=200):
    docs = [(a or "", b or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", c or "")) for a, b, c in rows]
    docs = [(a, b, ["".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in t) for t in c]) for a, b, c in docs]
    out = set()
    for lang in {a for a, _, _ in docs}:
        mine = [(b, c) for a, b, c in docs if a == lang]
        df = Counter(t for _, c in mine for t in set(c))
        kept = [t for t in df if df[t] >= min_docs]
        count = {s: Counter(t for b, c in mine if b == s for t in c) for s in {b for b, _ in mine}}
        whole = Counter(t for _, c in mine for t in c)

        def p(counter):
            total = sum(counter[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (counter[t] + 1) // total for t in kept}

        q = p(whole)
        ps = {s: p(c) for s, c in count.items()}
        for s in count:
            pairs = [(sum((ps[s][t] - ps[o][t]) ** 2 // ps[o][t] for t in kept), o) for o in count if o != s]
            terms = [((ps[s][t] - q[t]) ** 2 // q[t], t) for t in kept if count[s][t] > 0 and ps[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, ranks)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, item, v, i + 1) for i, (v, item) in enumerate(found[:most])}
    return out


def test_terms_are_ascii_letters_and_all_beyond_ascii():
    assert terms_of("Don't ÀB_cd 1x y\tZ") == ["don".encode(), b"t", "Àb".encode(), b"cd", "x y".encode(), b"z"]


def test_divergence_equals_brute_force_with_hot_source_nulls_and_ties(spark):
    rng = random.Random(5)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)] + ["Über", "日本"]
    rows = [(rng.choice(["en", "en", None]), "hot" if rng.random() < .4 else rng.choice(["a", "b", "c", None, ""]),
             " ".join(rng.choices(words, k=rng.randint(0, 30)))) for _ in range(150)]
    rows += [("xx", "one", "rare"), ("xx", "two", None), ("yy", "lone", "x x"), ("en", "wordless", "12 !!")] + rows[:5]
    docs = spark.createDataFrame(rows, "lang string, source string, text string").select(
        "*", F.lit(1).alias("g"), F.lit(2).alias("n"), F.lit(3).alias("value"), F.lit(4).alias("cells"))
    got = [tuple(r) for r in divergence(docs).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_divergence(rows)
    few = {tuple(r) for r in divergence(docs, min_docs=1, ranks=3).collect()}
    assert few == brute_divergence(rows, 1, 3)
    assert divergence(docs.limit(0)).collect() == []


def test_run_boundaries_of_a_pair_give_the_sum_over_all_terms():
    rng = np.random.default_rng(1)
    counts = np.sort(rng.integers(0, 3, (4, 200)), axis=1)
    counts[3] = 10**12 * rng.integers(0, 2, 200)
    lengths = rng.integers(1, 10**6, 200)
    totals = [sum((int(c) + 1) * int(n) for c, n in zip(row, lengths)) for row in counts]
    got = block_sums(counts, lengths, totals)
    for a in range(4):
        for b in range(4):
            if a != b:
                p = [[1 + 10**9 * (int(x) + 1) // totals[g] for x in counts[g]] for g in (a, b)]
                assert got[a, b] == sum((x - y) ** 2 // y * int(n) for x, y, n in zip(*p, lengths))


def test_a_large_page_of_counts_is_read_in_blocks(spark, monkeypatch):
    from nestlift.llm import divergence as module
    rows = [("en", f"s{i % 7}", " ".join(f"{chr(97 + j % 26)}{chr(97 + (i * j) % 26)}" for j in range(40))) for i in range(60)]
    docs = spark.createDataFrame(rows, "lang string, source string, text string")
    monkeypatch.setattr(module, "BLOCK_CELLS", 50)
    monkeypatch.setattr(module, "HELD_TERMS", 30)
    assert {tuple(r) for r in divergence(docs).collect()} == brute_divergence(rows)


# ---------------------------------------------------------------- op12


def text_of(page):
    return main_text(parse(page), set())


@pytest.mark.parametrize("page, want", [
    ("", ""),
    ("plain &amp; text &am", "plain & text &am"),
    ("<p>a<p>b <b>c<i>d</b>\n e<br>f", "a\nb cd e f"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "a\nb\nc\nd"),
    ("<table><tr><td>a<td>b<tr><th>c</table>d", "a\nb\nc\nd"),
    ("<title>t</title><style>p{}</style><script>var x='</p>';</script><article>a<!-- c -->b</article><script>cut", "ab"),
    ("<nav><p>x</p></nav><header>h</header><article><header><h1>T</h1></header><p>b&nbsp; c</p>"
     "<footer>by</footer></article><footer>f</footer>", "T\nb c"),
    ("<main><p>a</p><div class='comments'><article>c</article></div><form><input>q</form></main>", "a"),
    ("<div class='has sidebar'><article><p>a</article><p>s</div>", "a"),
    ("<form><main><p>a</p></main>f</form>", "a"),
    ('<div class="post-header"><h1>T</h1></div><div class="ad">x</div><p title="a>b">p</p>', "T\np"),
    ('<p a="unclosed>text', "text"),
    ("a < b and c > d", "a < b and c > d"),
    ("<select><option>o</select><button>b</button><p>x<svg><text>s</text></svg>y</p>", "x\ny"),
    ("</p></div>a</article>b", "a\nb"),
])
def test_reading_a_page(page, want):
    assert text_of(page) == want


def test_very_deep_and_long_pages():
    deep = parse("<div>" * 5_000 + "x" + "</div>" * 5_000 + "<p>y</p>")
    assert [t for _, t, _, _ in deep.blocks] == ["x", "y"] and max(n.depth for n in deep.nodes.values()) == site_tree.DEPTH
    words = " ".join(f"w{i}" for i in range(200_000))
    assert text_of(f"<article><p>{words}</p></article>") == words
    assert text_of("<a '" * 20_000 + "<p>x</p>") is not None


def test_facts_hold_each_phrase_of_a_page_once():
    facts = page_facts(parse("<p>One two. One two.</p><p>One two. Three</p><nav>menu</nav>"))
    assert sum(kind == site_tree.PHRASE for _, kind, _, _ in facts) == 2
    assert len({(a, b, c) for a, b, c, _ in facts}) == len(facts)


def page_of(rng, host, words, boiler):
    body = "".join(f"<p>{' '.join(rng.choices(words, k=rng.randint(8, 40)))}.</p>" for _ in range(rng.randint(2, 9)))
    return (f"http://{host}/{rng.random()}",
            f"<html><body><div id='x1'>{boiler}</div><div class='text'>{body}</div><div id='x2'>{boiler[::-1]}</div></body></html>")


def test_trees_remove_what_a_site_repeats_and_keep_what_varies(spark):
    rng = random.Random(3)
    words = [f"word{i}" for i in range(3_000)]
    rows = [(i, *page_of(rng, f"h{i % 3}.example", words, f"Welcome to the site number {i % 3}")) for i in range(90)]
    got = {r["page_id"]: r["text"] for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i, _, page in rows:
        inner = page[page.index("<div class='text'>"): page.index("<div id='x2'>")]
        assert got[i] == "\n".join(re.findall("<p>(.*?)</p>", inner))


def test_copies_on_a_host_and_odd_rows_keep_their_text(spark):
    same = "<article><h1>T</h1><p>All pages of this host are equal. Word for word.</p></article>"
    rows = [(1, "http://a/x", same)] * 40 + [(None, None, None), (2, None, "<p>x &lt;</p>"), (3, "no host", ""), (4, "http://a/y", "<nav>m</nav>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").select(
        "*", F.lit("h").alias("host"), F.lit("z").alias("removed"), F.lit(1).alias("part"))
    got = extract(pages).collect()
    assert Counter(r["text"] for r in got) == {"T\nAll pages of this host are equal. Word for word.": 40, "": 3, "x <": 1}
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert extract(pages.limit(0)).collect() == []


def article_of(page):
    a = page[page.index("<article>") + 9: page.index("</article>")]
    blocks = (" ".join(html.unescape(re.sub(r"</?[a-zA-Z][^>]*>", "", b)).split()) for b in re.split(r"<(?:/?(?:p|h1)|br)>", a))
    return "\n".join(b for b in blocks if b)


def test_the_articles_of_all_test_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {r["page_id"]: article_of(r["html"]) for r in pages.collect()}
    got = extract(pages).collect()
    assert len(got) == len(want) and all(r["text"] == want[r["page_id"]] for r in got)


# ---------------------------------------------------------------- op13


def brute_clusters(rows, k, rounds, width=64, seed=2):
    kept = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == width and all(x is not None and np.isfinite(x) for x in v)]
    first = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), x) for i, x in kept if i is not None)[:k]
    c = [x for _, x in first]

    def assign():
        out = []
        for _, x in kept:
            d = [sum((a - b) ** 2 for a, b in zip(x, y)) for y in c]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        to = assign()
        for j in range(len(c)):
            mine = [x for (_, x), (a, _) in zip(kept, to) if a == j]
            if mine:
                c[j] = [sum(col) // len(mine) for col in zip(*mine)]
    to = assign()
    own = Counter()
    for a, d in to:
        own[a] += d
    return Counter((i, a, d, own[a], sum(own.values()), hashlib.sha256(",".join(map(str, c[a])).encode()).hexdigest())
                   for (i, _), (a, d) in zip(kept, to))


def test_clusters_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    centre = rng.normal(0, .3, (5, 64))
    rows = [(i, (centre[i % 5] + rng.normal(0, .1, 64)).astype(np.float32).tolist()) for i in range(300)]
    rows += rows[:40] + [(None, rows[7][1]), (900, [0.0] * 64), (901, [0.0] * 64), (902, [3e3] * 64)]        # ties, repeats, outlier
    bad = [(903, [0.0] * 63), (904, None), (905, [float("nan")] + [0.0] * 63), (906, [None] + [0.0] * 63), (907, [float("inf")] * 64)]
    frame = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>").select(
        "*", F.lit(0).alias("rid"), F.lit(0).alias("x"), F.lit(0).alias("cluster"))
    got = cluster(frame, k=12, rounds=3)
    assert Counter(tuple(r) for r in got.collect()) == brute_clusters(rows, 12, 3)
    few = frame.where("vec_id in (900, 901)")
    assert Counter(tuple(r) for r in cluster(few).collect()) == brute_clusters(rows[-3:-1], 40, 5)
    assert cluster(frame.limit(0)).collect() == [] and cluster(frame.where("vec_id is null")).collect() == []


def test_huge_components_are_held(spark):
    frame = spark.createDataFrame([(1, [1e30] * 64), (2, [-1e30] * 64), (3, [0.0] * 64)], "vec_id long, embedding array<float>")
    got = cluster(frame, k=2, rounds=1).collect()
    assert len(got) == 3 and all(r["distance"] >= 0 for r in got)


def test_intervals_hold_the_distances_and_leave_the_nearest_open(spark):
    rng = np.random.default_rng(2)
    x = rng.integers(-200, 200, (500, 8))
    x[0] = 10**6
    frame = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "rid long, x array<long>")
    cells: Cells = cell_edges(frame, 8, 6)
    centroids = rng.integers(-200, 200, (6, 8))
    tables = cells.tables(centroids)
    own = cells.of(x)
    lower, upper = bounds(own, tables)
    distance = ((x[:, None] - centroids) ** 2).sum(axis=2)
    own_part = ((x - np.rint(centroids.mean(axis=0)).astype(int)) ** 2).sum(axis=1)[:, None]
    assert (lower <= distance - own_part).all() and (distance - own_part <= upper).all()
    assert (_unpacked(_packed(own, 6), 8, 6) == own).all() and (_unpacked(_packed(own[:, :7] // 2, 5), 7, 5) == own[:, :7] // 2).all()
    open_ = left(own, tables)
    assert open_.sum() < 0.5 * open_.size            # the approximations decide something
    best, d = nearest(x, centroids, open_)
    assert (best == distance.argmin(axis=1)).all() and (d == distance.min(axis=1)).all()
