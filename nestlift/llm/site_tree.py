"""Main text of web pages by site style trees.

The pages of a host are merged into one tree. A node is an element with its path:
tag, class, id and role (without digits) under the node of its parent, as far as
``DEPTH`` levels; repeated siblings are one node. A node's importance comes from two
entropies over the host's pages:

* presentation: the entropy of the ways its children follow each other. A menu
  looks the same on every page; an article has other paragraphs each time;
* content: one minus the mean entropy of the phrases of its text. A phrase that n
  of the node's m pages hold has entropy log n / log m: 0 for a phrase of one page,
  1 for one that all pages repeat.

A node that holds text scores ``CONTENT`` parts content and the rest presentation of
the elements around it, the nearest counting most. Hosts with few pages lean on the
same node's score at all hosts, and nodes seen nowhere else on a neutral one, as if
``LEAN`` more pages had it. Elements of an article or main element get a little more,
text that mostly stands in links a little less. Branches below ``LEAST`` are removed
from each page.

What HTML or the page's author names as something else than the article (menus,
headers, footers, sidebars, notices, adverts, forms, reader comments) goes by that
name: comments differ on every page, so no entropy tells them from the article.

How it runs: pages are parsed in tasks; per host, node and phrase only hashes and
counts are shuffled, added up in each task first. The result per host is the short
list of nodes to remove. It is joined to the pages by host; hosts with more than a
thousandth of all pages are dealt over as many parts as they have thousandths.
"""

from __future__ import annotations

import functools
import html
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestlift.llm.common import each, stage, worker_cache
from nestlift.llm.url_filter import host_and_path

DEPTH = 24
CONTENT = 0.6
AROUND = 3
LEAN = 10
NEUTRAL = 0.6
IN_ARTICLE, IN_LINKS = 0.2, -0.2
LEAST = 0.5
PHRASE_WORDS = 16
CACHED_NODES = 20_000

# fixed values: HTML elements by what they are
BLOCKS = frozenset("""address article aside blockquote caption center dd details dialog dir div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol p pre search section summary table tbody td tfoot
    th thead tr ul""".split())
RAW = frozenset("iframe noembed noframes noscript script style template textarea title xmp".split())  # read to their end tag, no text
WIDGETS = frozenset("audio button canvas datalist object select svg video".split())             # their content is no text
CLOSES_P = BLOCKS - frozenset("caption dd dt legend summary tbody td tfoot th thead tr".split())
CLOSED_BY = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
             "tbody": {"tr", "td", "th", "thead", "tbody", "tfoot"}, "tfoot": {"tr", "td", "th", "thead", "tbody", "tfoot"},
             "thead": {"tr", "td", "th", "caption"}}
HOLDS = {"li": {"ul", "ol", "menu", "dir"}, "dd": {"dl"}, "dt": {"dl"}}   # where the search for an open one ends
CELLS = frozenset({"td", "th", "caption"})
TABLES = frozenset({"table", "tbody", "thead", "tfoot", "tr"}) | CELLS
NOT_ARTICLE = frozenset({"nav", "footer", "aside", "form", "dialog", "menu", "search"})
ARTICLE = frozenset({"article", "main"})
NOT_ARTICLE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar".split())
# words of a class or id that name a part outside the article
NOT_ARTICLE_NAMES = frozenset("""ad ads advert adverts advertisement advertising adsense sponsor sponsored promo banner nav navbar
    navigation menu breadcrumb breadcrumbs sidebar footer masthead cookie cookies consent gdpr notice popup modal overlay newsletter
    subscribe signup login search share sharing social related recommended widget pagination pager toolbar""".split())
COMMENT_NAMES = frozenset("comment comments commentlist disqus respond reply replies".split())

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>?"""
                    r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)[^>]*+>?""", re.S)
_ATTRIBUTE = re.compile(r"""(?:^|[\s"'])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PHRASE_END = re.compile(r"(?<=[.!?;:|·•…。])\s")


@dataclass(frozen=True)
class Node:
    """A node of a style tree: its key, and what its name says about it."""

    key: int
    depth: int
    parent: int                 # key of the element around it
    named: str                  # "": part of the page; "other": not the article; "comment"; "part": nav, footer, aside
    article: bool               # inside an article or main element


ROOT = Node(0, 0, 0, "", False)


def child_node(parent: Node, tag: str, attributes: str, by_name: bool = True) -> Node:
    """The node of an element below ``parent``."""
    found = {m[1].lower(): (m[2] or m[3] or m[4] or "").lower() for m in _ATTRIBUTE.finditer(attributes)} if attributes else {}
    looks = " ".join(f"{k}={' '.join(sorted(re.sub(r'[0-9]+', '', v).split()))}" for k, v in sorted(found.items()))
    names = set(re.split(r"[^a-z]+", f"{found.get('class', '')} {found.get('id', '')}"))
    role = found.get("role", "")
    article = parent.article
    if tag in ARTICLE or role in ("main", "article"):
        article = True
    if parent.named == "comment" or names & COMMENT_NAMES:
        named = "comment"
    elif parent.named == "part" or tag in NOT_ARTICLE - {"form"}:
        named = "part"
    elif names & NOT_ARTICLE_NAMES or role in NOT_ARTICLE_ROLES or tag == "form" or (
            not article and (tag == "header" or "header" in names and not names & {"article", "post", "entry", "story", "content"})):
        named = "other"
    elif tag in ARTICLE or role in ("main", "article"):
        named = ""              # a form, or a wrapper named after its sidebar, may hold the article
    else:
        named = parent.named
    if not by_name:
        named, article = "", False
    if parent.depth >= DEPTH:
        return parent
    key = xxhash.xxh64_intdigest(f"{parent.key}/{tag} {looks}") >> 1
    return Node(key, parent.depth + 1, parent.key, named, article)


class _Nodes(dict):
    """Nodes by parent key, tag and attributes; cleared when full."""

    def get_node(self, parent: Node, tag: str, attributes: str, by_name: bool) -> Node:
        at = (parent.key, parent.named, parent.article, tag, attributes, by_name)
        node = self.get(at)
        if node is None:
            node = child_node(parent, tag, attributes, by_name)
            if len(self) >= CACHED_NODES:
                self.clear()
            if len(attributes) < 200:
                self[at] = node
        return node


def _nodes() -> _Nodes:
    return worker_cache("site_tree", _Nodes)


@functools.lru_cache(maxsize=64)
def _raw_end(tag: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?|\Z", re.I)


@dataclass
class Page:
    """The blocks of a page in order, and how its elements follow each other."""

    blocks: list[tuple[Node, str, int, int]] = field(default_factory=list)      # node, text, characters, those in links
    children: dict[int, list[int]] = field(default_factory=dict)                # keys of child elements, per node
    nodes: dict[int, Node] = field(default_factory=dict)


def parse(source: str, by_name: bool = True) -> Page:
    """Read a page as browsers do where it matters: open paragraphs, items and cells close themselves."""
    page = Page()
    known = _nodes()
    stack: list[tuple[str, Node]] = []      # open elements
    node = ROOT
    text: list[str] = []
    linked, in_link, at, skip = 0, False, 0, 0

    def close_block() -> None:
        nonlocal linked
        if text:
            whole = " ".join("".join(text).split())
            if whole:
                page.blocks.append((node, whole, len(whole), min(linked, len(whole))))
                page.nodes.setdefault(node.key, node)
            text.clear()
        linked = 0

    def add(piece: str) -> None:
        nonlocal linked
        if "&" in piece:
            piece = html.unescape(piece)
        text.append(piece)
        if in_link:
            linked += len(piece)

    def shut(names, barrier=()) -> None:
        """Close the innermost open element of these names, with all inside it."""
        nonlocal node, skip
        for i in range(len(stack) - 1, -1, -1):
            tag = stack[i][0]
            if tag in names:
                skip -= sum(t in WIDGETS for t, _ in stack[i:])
                del stack[i:]
                node = stack[-1][1] if stack else ROOT
                return
            if tag in barrier:
                return

    while True:
        found = _TOKEN.search(source, at)
        if found is None:
            break
        if found.start() > at and not skip:
            add(source[at:found.start()])
        at = found.end()
        tag = found[2]
        if tag is None:
            continue
        tag = tag.lower()
        if found[1]:
            if tag == "a":
                in_link = False
            elif tag in BLOCKS or tag in WIDGETS:
                close_block()
                shut({tag}, () if tag in TABLES else CELLS)
            continue
        if tag in RAW:
            at = _raw_end(tag).search(source, at).end()
            continue
        if tag == "a":
            in_link = True
        elif tag in ("br", "wbr"):
            text.append(" " if tag == "br" else "")
        elif tag in BLOCKS or tag in WIDGETS:
            close_block()
            in_link = False
            if tag in CLOSES_P:
                shut({"p"}, CELLS)
            if tag in CLOSED_BY:
                shut(CLOSED_BY[tag], HOLDS.get(tag, {"table"}))
            if tag == "hr" or source[at - 2: at] == "/>" and tag in WIDGETS:
                continue
            inner = known.get_node(node, tag, found[3], by_name)
            if inner is not node and not inner.named:
                page.children.setdefault(node.key, []).append(inner.key)
                page.nodes.setdefault(inner.key, inner)
            stack.append((tag, inner))
            skip += tag in WIDGETS
            node = inner
    if at < len(source) and not skip:
        add(source[at:])
    close_block()
    return page


def phrases(text: str) -> Iterator[str]:
    """A text's parts between sentence ends, of at most PHRASE_WORDS words."""
    for part in _PHRASE_END.split(text):
        words = part.split()
        for i in range(0, len(words), PHRASE_WORDS):
            yield " ".join(words[i: i + PHRASE_WORDS])


# what a page adds to its host's tree, per node: its phrases, how its children follow each other, the characters of its
# text (all, and in links), the node around it, and whether an article holds it
PHRASE, LOOK, CHARACTERS, LINKED, PARENT, ARTICLE_TEXT = range(6)


def page_facts(page: Page) -> list[tuple[int, int, int, int]]:
    """(node, kind, value, count), each once."""
    out = []
    own: dict[int, set[str]] = {}
    sizes: dict[int, list[int]] = {}
    for node, text, n, linked in page.blocks:
        if not node.named:
            own.setdefault(node.key, set()).update(phrases(text))
            size = sizes.setdefault(node.key, [0, 0])
            size[0] += n
            size[1] += linked
    for key, found in own.items():
        out += [(key, PHRASE, xxhash.xxh64_intdigest(x) >> 1, 1) for x in found]
        out += [(key, CHARACTERS, 0, sizes[key][0]), (key, LINKED, 0, sizes[key][1])]
        if page.nodes[key].article:
            out.append((key, ARTICLE_TEXT, 0, 1))
    for key in page.nodes.keys() | {0}:
        look = np.array(page.children.get(key, ()), np.int64).tobytes()
        out.append((key, LOOK, xxhash.xxh64_intdigest(look) >> 1, 1))
        if key:
            out.append((key, PARENT, page.nodes[key].parent, 1))
    return out


def main_text(page: Page, removed: set[int]) -> str:
    """The blocks that stay. If the tree leaves nothing of an article, the article is kept whole."""
    named = [(node, text) for node, text, _, _ in page.blocks if not node.named]
    kept = [text for node, text in named if node.key not in removed]
    return "\n".join(kept or [text for node, text in named if node.article])


_FACTS = T.ArrayType(T.StructType([T.StructField("node", T.LongType()), T.StructField("kind", T.IntegerType()),
                                   T.StructField("value", T.LongType()), T.StructField("n", T.LongType())]))


def _facts(pages: Column, by_name: bool) -> Column:
    @F.arrow_udf(_FACTS)
    def see(sources: pa.Array) -> pa.Array:
        rows: list[tuple[int, int, int, int]] = []
        ends = [0]
        for source in each(sources):
            rows += page_facts(parse(source or "", by_name))
            ends.append(len(rows))
        node, kind, value, n = zip(*rows, strict=True) if rows else ((), (), (), ())
        fact = pa.StructArray.from_arrays([pa.array(node, pa.int64()), pa.array(kind, pa.int32()), pa.array(value, pa.int64()),
                                           pa.array(n, pa.int64())], ["node", "kind", "value", "n"])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), fact)

    return see(pages)


def _extracted(pages: Column, removed: Column, by_name: bool) -> Column:
    @F.arrow_udf(T.StringType())
    def take(sources: pa.Array, cuts: pa.Array) -> pa.Array:
        return pa.array([main_text(parse(source.as_py() or "", by_name), set(cut.as_py() or ()))
                         for source, cut in zip(sources, cuts, strict=True)], pa.string())

    return take(pages, removed)


def style_trees(pages: DataFrame, by_name: bool = True) -> DataFrame:
    """The nodes of all hosts' trees. ``pages``: host, html.

    host, node, parent, pages, looks (presentation importance), says (content
    importance, NULL without text), links (share of the text in links), article.
    """
    counted = (pages.select("host", F.explode(_facts(F.col("html"), by_name)).alias("f")).select("host", "f.*")
               .groupBy("host", "node", "kind", "value").agg(F.sum("n").alias("n")))

    def of(kind: int, value):
        return F.sum(F.when(F.col("kind") == kind, value))

    n = F.col("n").cast("double")
    sums = counted.groupBy("host", "node").agg(
        of(LOOK, F.col("n")).alias("pages"), of(LOOK, n * F.log(n)).alias("look_bits"),
        of(PHRASE, F.lit(1)).alias("phrases"), of(PHRASE, F.log(n)).alias("phrase_bits"),
        of(CHARACTERS, F.col("n")).alias("characters"), of(LINKED, F.col("n")).alias("linked"),
        F.max(F.when(F.col("kind") == PARENT, F.col("value"))).alias("parent"),
        F.max(F.col("kind") == ARTICLE_TEXT).alias("article"))
    m = F.log("pages")
    one = F.lit(1.0)
    return sums.select(
        "host", "node", "parent", "pages",
        F.when(F.col("pages") > 1, one - F.col("look_bits") / (F.col("pages") * m)).otherwise(one).alias("looks"),
        F.when(F.col("pages") > 1, one - F.col("phrase_bits") / (F.col("phrases") * m))
        .when(F.col("phrases").isNotNull(), one).alias("says"),
        F.coalesce(F.col("linked") / F.col("characters"), F.lit(0.0)).alias("links"), "article")


def removed_nodes(nodes: DataFrame) -> DataFrame:
    """host, node, importance of the nodes with text that go."""
    own = nodes.where(F.col("says").isNotNull()).select("*", F.col("parent").alias("outer"), F.lit(0.0).alias("around"),
                                                        F.lit(0.0).alias("weight"))
    for i in range(AROUND):     # presentation of the elements around it, the nearest with half the weight, the next with a quarter
        outer = nodes.select(F.col("host").alias("h"), F.col("node").alias("o"), F.col("parent").alias("next"), F.col("looks").alias("l"))
        part = F.when(F.col("l").isNotNull(), 0.5 ** (i + 1)).otherwise(0.0)
        own = (own.join(outer, (F.col("host") == F.col("h")) & (F.col("outer") == F.col("o")), "left")
               .withColumn("around", F.col("around") + part * F.coalesce("l", F.lit(0.0)))
               .withColumn("weight", F.col("weight") + part).withColumn("outer", F.col("next")).drop("h", "o", "next", "l"))
    looks = F.when(F.col("weight") > 0, F.col("around") / F.col("weight")).otherwise(0.0)
    own = own.withColumn("score", CONTENT * F.col("says") + (1 - CONTENT) * looks)
    # a host of one page tells nothing about repetition
    every = own.where("pages > 1").groupBy("node").agg(F.sum("pages").alias("all_pages"),
                                                       (F.sum(F.col("score") * F.col("pages")) / F.sum("pages")).alias("all_score"))
    lean = ((F.coalesce(F.col("all_score") * F.col("all_pages"), F.lit(0.0)) + LEAN * NEUTRAL)
            / (F.coalesce("all_pages", F.lit(0)) + LEAN))
    m = F.when(F.col("pages") > 1, F.col("pages")).otherwise(0)
    importance = ((m * F.col("score") + LEAN * lean) / (m + LEAN)
                  + F.when(F.col("article"), IN_ARTICLE).otherwise(0.0) + F.when(F.col("links") > 0.5, IN_LINKS).otherwise(0.0))
    return own.join(every, "node", "left").select("host", "node", importance.alias("importance")).where(F.col("importance") < LEAST)


def extract(pages: DataFrame, by_name: bool = True) -> DataFrame:
    """page_id, url, text, n_chars: the main text of each page.

    With ``by_name=False`` tags, classes and roles mean nothing and the trees decide alone.

    NULL html is an empty page; NULL urls are pages of one host without a name.
    Character references are decoded, white space in a block is one blank, blocks are
    joined by a line feed in page order. A page without main text has an empty one.
    Repeated rows each get a row (and count as pages of their own); other columns are
    ignored; an empty table gives no rows.
    """
    rows = pages.select("page_id", "url", "html", host_and_path(F.col("url"))[0].alias("host"))
    cut = removed_nodes(stage(style_trees(rows.select("host", "html"), by_name), "style-trees"))
    cuts = cut.groupBy("host").agg(F.collect_set("node").alias("removed"))
    # at most a thousand hosts have a thousandth of the pages: a broadcast list of bounded size
    total = rows.count()
    sizes = rows.groupBy("host").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") * 1000 > total)
    hot = pages.sparkSession.createDataFrame(
        [(r["host"], math.ceil(1000 * r["n"] / total)) for r in sizes.collect()], "host string, parts int")
    dealt = (rows.join(F.broadcast(hot), "host", "left")
             .withColumn("part", F.pmod(F.xxhash64("page_id", "url", "html"), F.coalesce("parts", F.lit(1)))))
    # written, so that its size is known when the join is planned
    copies = stage(cuts.join(F.broadcast(hot), "host", "left")
                   .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("parts", F.lit(1)).cast("long") - 1)))
                   .drop("parts"), "removed")
    return (dealt.join(copies, ["host", "part"], "left")
            .select("page_id", "url", _extracted(F.col("html"), F.col("removed"), by_name).alias("text"))
            .select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars")))
