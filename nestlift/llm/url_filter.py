"""URL verdicts: host and path rules first, then a classifier on character n-grams.

A rule is a host with its subdomains and a path prefix; the longest that fits a
URL decides. Rules are matched by joining on candidates: a URL's host gives one
candidate per label it ends in, so any number of rules costs a hash join on the
host, not a scan of the rule list.

URLs without a rule are scored by logistic regression on hashed character
n-grams of host and path (kept apart), trained in numpy from a small labelled
URL table; a score of ``threshold`` or more blocks.
"""

from __future__ import annotations

import functools
import math
import random
import zlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


BITS = 16
GRAMS = (3, 4, 5)
CACHE_HOSTS = 100_000
LABELLED_ROWS = 20_000

# A labelled URL table of general names for a corpus without its own: 1 is unwanted (gambling, adult,
# pills, fast money, fakes, pirated, ads and link farms), 0 is wanted. Callers with labels pass their own.
UNWANTED = tuple("""
casino casinos online-casino vegas-slots slots slot-machine poker pokerstar blackjack baccarat bingo-cash bets betting bet
sportsbook bookmaker wager gamble gambling jackpot mega-jackpot lottery lotto-win lucky-spin spin-to-win scratchcards
xxx xxx-videos adult adult-videos adult-chat porn porno porntube sex sex-chat sexcams livesex sexy-girls nudes nude-pics
naked erotic erotica escort escorts hentai milf camgirls hookup hot-singles hot-girls fetish strip-show
pills diet-pills viagra buy-viagra cialis levitra tramadol xanax pharmacy-deals no-prescription discount-meds steroids
miracle-diet weight-loss-fast fat-burner male-enhancement payday-loans payday quick-loans fast-cash easy-money make-money
earn-cash get-rich forex-profit crypto-doubler bitcoin-profit binary-options instant-credit replica-watches replica-bags
fake-rolex cheap-rolex cheap-jerseys cheap-handbags outlet-sale discount-sale buy-followers buy-likes essay-cheap
crack-download crack keygen serial-keys warez torrents free-torrent nulled-scripts free-movies watch-free-hd free-mp3
cracked-games free-download-full ad-server adserver ads banner-ads popup-ads popunder track-click click-tracker click-here
affiliate-clicks seo-links backlinks link-farm link-exchange spam spam-mail spammers free-gift free-iphone free-prizes
claim-prize win-prizes win-big winner-bonus bonus-spins sweepstakes giveaway survey-rewards
""".split())
WANTED = tuple("""
news daily-news library libraries museum school schools university college science weather garden gardening recipes cooking
history travel-notes travel health-info hospital clinic city-council council open-data data docs documentation wiki journal
poetry maps astronomy physics chemistry biology maths geology ecology music orchestra theatre cinema-history painting
gallery photography design architecture engineering software developer opensource linux python-notes database network
cloud hosting mail calendar forum community diary magazine newspaper times herald tribune gazette press publisher
books bookshop reader writers stories novels language grammar dictionary translate courses lessons teacher students
research institute academy laboratory foundation charity church parish temple village town county region ministry
parliament court lawyers police fire-service post railway trains airport airlines harbour shipping cycling running
football tennis chess swimming climbing hiking mountains rivers ocean islands beach forest wildlife birds horses dogs
cats farm farmers bakery coffee tea kitchen restaurant hotel rooms furniture carpenter plumber builders roofing paint
tools machines motors cars bicycles garage energy solar wind-power water recycling climate bank insurance accounting
taxes economics markets statistics jobs careers family kids parents toys games puzzles fashion shoes textiles knitting
jewelry clocks watches pharmacy medicine nurses dentist optician anderson-sons brown miller garcia kowalski nakamura
hansen okafor ivanova berlin madrid lyon porto oslo kyoto nairobi quito acme omega vertex nimbus zenith bluebird
redwood greenfield stonebridge northwind riverside sunnyhill oakland westport abc kqed mit bbc nasa ieee w3 nhs
adelaide adult-education addison adventure cheshire farmland freedom freeland trackside winter window winston
clickable linked alphabet betty poland spartan sussex middlesex essex analysis cracker pillar
""".split())
COINED = 400
# of names held out from training (five folds): the least of 0.1, 0.15, ... that blocks at most 5 % of the neutral urls
THRESHOLD = 0.2


def coined(n: int, seed: int) -> list[str]:
    """Made-up neutral names of many shapes: syllables, clusters, short codes, two parts."""
    rnd = random.Random(seed)
    heads, vowels = "b c d f g h j k l m n p r s t v w z br ch cl dr gr ph pl qu sh sl st str th tr wh".split(), "a e i o u ai ea ee io ou".split()
    tails = ["", "", "", "n", "r", "s", "t", "l", "m", "nd", "ng", "st", "ck", "ble", "ns", "rt", "th", "sh"]
    syllable = lambda: (rnd.choice(heads) if rnd.random() < .85 else "") + rnd.choice(vowels) + rnd.choice(tails)
    word = lambda: "".join(syllable() for _ in range(rnd.randint(1, 4)))
    out = []
    for _ in range(n):
        kind = rnd.random()
        out.append("".join(rnd.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(rnd.randint(2, 8))) if kind < .15
                   else f"{word()}-{word()}" if kind < .4 else word())
    return out


def default_labels() -> list[tuple[str, int]]:
    """(url, label) rows from the name lists above: each as a host, a subdomain and a path."""
    return labelled_names([(n, 1) for n in UNWANTED] + [(n, 0) for n in (*WANTED, *coined(COINED, 1))])


def labelled_names(names: Sequence[tuple[str, int]]) -> list[tuple[str, int]]:
    """(url, label) rows of (name, label) pairs."""
    out = []
    for i, (name, label) in enumerate(names):
        top = ("com", "net", "org")[i % 3]
        lang = ("en", "de", "fr", "es")[i % 4]
        out += [(f"https://www.{name}.example.{top}/{lang}/{i * 37 % 1000}", label),
                (f"http://{name}.{top}/", label),
                (f"https://m.{name}.example.{top}/{lang}/{i * 53 % 1000}.html", label),
                (f"http://blog.{name}.example.{top}/{lang}/{i * 71 % 1000}?page=2", label),
                (f"https://www.example.{top}/{name}/{i}", label)]
    return out


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (after the first ``://``, ASCII letters in lower case) and path; empty without ``://`` or for NULL."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1),
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``urls`` (with _row, host, path) that a rule fits: _row, rule, allow (of the longest rule).

    ``rules`` has rule (host/path), allow. Ties in length go by text. Hosts that
    many URLs share are matched once per distinct host and path.
    """
    spec = rules.select(F.regexp_extract("rule", "^([^/]*)", 1).alias("_host"), F.regexp_extract("rule", "(?s)(/.*)$", 1).alias("_path"),
                        "rule", "allow").dropDuplicates()
    pages = urls.select("host", "path").where("host <> ''").dropDuplicates()
    labels = F.split("host", r"\.", -1)
    ends = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fits = (pages.select("host", "path", F.explode(ends).alias("_host")).join(spec, "_host")
            .where(F.expr("startswith(path, _path)")))
    best = F.max(F.struct(F.length("rule").alias("n"), "rule", "allow"))
    return fits.groupBy("host", "path").agg(best.alias("b")).select("host", "path", "b.rule", "b.allow")


def features(host: str, path: str) -> set[int]:
    """Hashed character n-grams of host and path, each with its own marks."""
    out = set()
    for mark, part in ((b"h", f"^{host}$"), (b"p", f"^{path}$")):
        raw = part.encode("utf-8", "surrogatepass")
        for n in GRAMS:
            for i in range(len(raw) - n + 1):
                out.add(zlib.crc32(mark + raw[i: i + n]) & ((1 << BITS) - 1))
    return out


def split_url(url: str | None) -> tuple[str, str]:
    """``host_and_path`` for one URL."""
    at = (url or "").find("://")
    if at < 0:
        return "", ""
    rest = url[at + 3:]
    ends = [i for c in "/?#" if (i := rest.find(c)) >= 0]
    k = min(ends, default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:k])
    ends = [i for c in "?#" if (i := rest.find(c, k)) >= 0]
    return host, rest[k: min(ends, default=len(rest))]


def train(rows: Sequence[tuple[str, int]], l2: float = 1e-5, steps: int = 400) -> tuple[np.ndarray, float]:
    """(weights, bias) by full-batch Adam; text without any label scores 0."""
    found = [np.fromiter(features(*split_url(u)), np.int64) for u, _ in rows]
    y = np.asarray([v for _, v in rows], float)
    if not len(y):
        return np.zeros(1 << BITS, np.float32), -500.0
    ids = np.unique(np.concatenate(found))
    at = np.searchsorted(ids, np.concatenate(found))
    row = np.repeat(np.arange(len(found)), [len(f) for f in found])
    norm = 1 / np.sqrt(np.maximum(1, np.bincount(row, minlength=len(found))))
    w, b = np.zeros(len(ids)), 0.0
    m, v = np.zeros(len(ids) + 1), np.zeros(len(ids) + 1)
    for t in range(1, steps + 1):
        z = np.bincount(row, w[at], len(found)) * norm + b
        e = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(y)
        g = np.append(np.bincount(at, (e * norm)[row], len(ids)) + l2 * w, e.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = 0.05 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    full = np.zeros(1 << BITS, np.float32)
    full[ids] = w
    return full, float(b)


@functools.lru_cache(maxsize=2)
def _weights(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.float32)


def score(host: Column, path: Column, weights: np.ndarray, bias: float) -> Column:
    """Probability that a page is unwanted."""
    raw = weights.astype(np.float32).tobytes()

    @F.arrow_udf("double")
    def scored(hosts: pa.Array, paths: pa.Array) -> pa.Array:
        w = _weights(raw)
        out = []
        for h, p in zip(hosts.to_pylist(), paths.to_pylist(), strict=True):
            f = sorted(features(h or "", p or ""))
            z = bias + (float(w[f].sum()) / math.sqrt(len(f)) if f else 0.0)
            out.append(1 / (1 + math.exp(-max(-500.0, min(500.0, z)))))
        return pa.array(out, pa.float64())

    return scored(host, path)


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, bool]] | DataFrame,
               labelled: DataFrame | Sequence[tuple[str, int]] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """page_id, host, path, rule, score, verdict: one row per page, repeated and NULL ids included.

    ``rules``: (rule, allow) rows, as a list or a frame. ``labelled``: (url,
    label) rows; of a frame the first ``LABELLED_ROWS`` by hash are used; None:
    ``default_labels()``. An empty host (NULL url, no ``://``) fits no rule and
    is judged by the classifier like any other. Other columns are ignored.
    """
    spark = pages.sparkSession
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame(list(rules), "rule string, allow boolean")
    if isinstance(labelled, DataFrame):
        labelled = [tuple(r) for r in labelled.where("url is not null and label in (0, 1)").select("url", "label")
                    .dropDuplicates().orderBy(F.xxhash64("url"), "url", "label").limit(LABELLED_ROWS).collect()]
    weights, bias = train(default_labels() if labelled is None else labelled)
    host, path = host_and_path(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    ruled = match_rules(urls, rules)
    judged = urls.join(ruled, ["host", "path"], "left").withColumn("score", score(F.col("host"), F.col("path"), weights, bias))
    block = F.when(F.col("allow").isNotNull(), ~F.col("allow")).otherwise(F.col("score") >= threshold)
    return judged.select("page_id", "host", "path", "rule", "score", F.when(block, "block").otherwise("allow").alias("verdict"))
