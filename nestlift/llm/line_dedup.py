"""Deletes later copies of repeated line runs, by a suffix array over line ids.

Each document is a sequence of line ids (128 bits of hash; lines without a word
are skipped). The suffixes of all sequences are sorted by distributed prefix
doubling: a suffix's rank at depth 2h comes from the ranks at depth h of itself
and of the suffix h lines on. Suffixes of equal rank at depth h form an interval
whose longest common prefix is at least h lines. A suffix alone in its interval
repeats nothing at that depth and leaves the sort, so the work follows the
repeated lines, not the corpus.

A run counts as a passage from ``min_words`` words on. Since every line of the
sequence has a word, the shortest qualifying run from (or up to) a line has at
most ``min_words`` lines, so doubling stops at the largest power of two within
that; a run of m lines is named by the ranks of its first and last 2^k lines.
For each line the shortest qualifying run that starts there and the one that
ends there are looked up in their interval: if it has an earlier copy, the run
is deleted. Together these cover exactly all maximal repeated runs with an
earlier copy: a line of such a run is either within the shortest qualifying
prefix of the run, or ends a qualifying run inside it.

Only DataFrame functions; hot lines and passages are joined on their id with
partial aggregation on one side, which adaptive execution can split.

Defined results: the first copy by (doc_id, text hash, line) stays, NULL ids
last; rows equal in id and text count as one document and are trimmed alike;
blank lines between deleted lines go with them; NULL and empty texts stay as they
are; other columns are kept, and n_chars (if there) is the new text's length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from nestlift.llm.common import WORD, stage, word_count

MIN_WORDS = 50


def line_ids(docs: DataFrame) -> DataFrame:
    """_doc, _text, idx (place among the lines with words), pos (line number), words, h1, h2."""
    lines = F.transform(F.split("text", "\n", -1), lambda line, i: F.struct(
        i.alias("pos"), word_count(line).alias("words"), F.xxhash64(line).alias("h1"),
        F.xxhash64(F.lit("second half"), line).alias("h2")))
    return (docs.where(F.col("text").isNotNull())
            .select(F.col("doc_id").alias("_doc"), F.xxhash64("text").alias("_text"),
                    F.posexplode(F.filter(lines, lambda x: x["words"] > 0)).alias("idx", "line"))
            .select("_doc", "_text", "idx", "line.*"))


def _ranked(classes: DataFrame, key: list[str], out: str, kind: str) -> DataFrame:
    """Numbers that follow the sort order of ``key`` over all partitions; written, so they stay."""
    return stage(classes.select(*key).repartitionByRange(*key).sortWithinPartitions(*key)
                 .withColumn(out, F.monotonically_increasing_id()), kind)


def _within_doc():
    return Window.partitionBy("_doc", "_text").orderBy("idx")


def ranks(lines: DataFrame, min_words: int) -> tuple[DataFrame, int]:
    """Lines that occur twice or more, with ``r``: their ranks at depth 1, 2, 4, ... (NULL: alone)."""
    first = _ranked(lines.groupBy("h1", "h2").count().where("count > 1"), ["h1", "h2"], "rank", "lines-0")
    at = stage(lines.join(first, ["h1", "h2"]).drop("h1", "h2").dropDuplicates(["_doc", "_text", "idx"]), "lines-at-0")
    levels, depth, active = [at.select("_doc", "_text", "idx", F.lit(0).alias("k"), "rank", "pos", "words")], 1, at
    while 2 * depth <= min_words:
        nxt = F.lead(F.struct("idx", "rank"), depth).over(_within_doc())
        pairs = (active.select("_doc", "_text", "idx", F.col("rank").alias("a"), nxt.alias("n"))
                 .where(F.col("n.idx") == F.col("idx") + depth)
                 .select("_doc", "_text", "idx", "a", F.col("n.rank").alias("b")))
        classes = _ranked(pairs.groupBy("a", "b").count().where("count > 1"), ["a", "b"], "rank", f"lines-{2 * depth}")
        active = stage(pairs.join(classes, ["a", "b"]).drop("a", "b"), f"lines-at-{2 * depth}")
        levels.append(active.select("_doc", "_text", "idx", F.lit(len(levels)).alias("k"), "rank",
                                    F.lit(None).cast("int").alias("pos"), F.lit(None).cast("long").alias("words")))
        depth *= 2
    rows = levels[0]
    for x in levels[1:]:
        rows = rows.unionByName(x)
    rank = [F.max(F.when(F.col("k") == k, F.col("rank"))) for k in range(len(levels))]
    return (rows.groupBy("_doc", "_text", "idx")
            .agg(F.max("pos").alias("pos"), F.max("words").alias("words"), F.array(*rank).alias("r"))), len(levels)


def _window(lines: Column, s: Column, m: Column, levels: int) -> Column:
    """The run of ``m`` lines from array place ``s`` (from 0), named by its ranks; NULL if not repeated."""
    k = sum((F.when(m >= 2 ** i, 1).otherwise(0) for i in range(1, levels)), F.lit(0))
    a, z = F.get(lines, s), F.get(lines, s + m - 1)
    ra = F.get(a["r"], k)
    rb = F.get(F.get(lines, s + m - F.pow(F.lit(2), k).cast("int"))["r"], k)
    ok = (s >= 0) & (z["idx"] == a["idx"] + m - 1) & ra.isNotNull() & rb.isNotNull()
    return F.when(ok, F.struct(a["idx"].alias("idx"), a["pos"].alias("p0"), z["pos"].alias("p1"),
                               m.alias("m"), ra.alias("ra"), rb.alias("rb")))


def _shortest_runs(ls: Column, min_words: int, levels: int) -> Column:
    """The shortest qualifying runs that start and that end at each line of ``ls``, if they are repeated."""
    def runs(x: Column, t: Column) -> Column:
        ahead = F.slice(ls, t + 1, min_words)
        m_to = F.array_position(F.transform(ahead, lambda y: y["sum"] - x["sum"] + x["words"] >= min_words), True)
        start = F.greatest(F.lit(0), t - (min_words - 1))
        back = F.reverse(F.slice(ls, start + 1, t - start + 1))
        m_from = F.array_position(F.transform(back, lambda y: x["sum"] - y["sum"] + y["words"] >= min_words), True)
        # lengths first, names after: a lambda's argument is worked out once, an expression wherever it is named
        lengths = F.array(F.struct(m_to.cast("int").alias("m"), F.lit(0).alias("back")),
                          F.struct(m_from.cast("int").alias("m"), F.lit(1).alias("back")))
        return F.transform(F.filter(lengths, lambda n: n["m"] > 0),
                           lambda n: _window(ls, F.when(n["back"] == 1, t - n["m"] + 1).otherwise(t), n["m"], levels))

    return F.array_distinct(F.filter(F.flatten(F.transform(ls, runs)), lambda w: w.isNotNull()))


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Runs with an earlier copy: _doc, _text, idx, m (lines with words) and the line numbers p0 to p1 (both deleted)."""
    lines = stage(line_ids(docs), "lines")
    at, levels = ranks(lines, min_words)
    at = at.withColumn("sum", F.sum("words").over(_within_doc()))
    docs_at = (at.groupBy("_doc", "_text")
               .agg(F.sort_array(F.collect_list(F.struct("idx", "pos", "words", "sum", "r"))).alias("ls")))
    windows = stage(docs_at.select("_doc", "_text", F.explode(_shortest_runs(F.col("ls"), min_words, levels)).alias("w"))
                    .select("_doc", "_text", "w.*"), "line-runs")
    place = F.struct(F.col("_doc").isNull(), "_doc", "_text", "idx")
    firsts = (windows.groupBy("m", "ra", "rb").agg(F.min(place).alias("first"), F.max(place).alias("last"))
              .where("first < last").drop("last"))
    return windows.join(firsts, ["m", "ra", "rb"]).where(place > F.col("first")).select("_doc", "_text", "idx", "m", "p0", "p1")


def _merged(runs: DataFrame) -> DataFrame:
    """Runs that overlap or follow each other as one; ``_cut``: the document's runs in order."""
    w = Window.partitionBy("_doc", "_text").orderBy("idx", "m")
    reach = F.max(F.col("idx") + F.col("m")).over(w.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum(F.when(F.col("idx") > F.col("reach"), 1).otherwise(0)).over(w)
    return (runs.withColumn("reach", F.coalesce(reach, F.lit(-1))).withColumn("island", island)
            .groupBy("_doc", "_text", "island").agg(F.min("p0").alias("p0"), F.max("p1").alias("p1"))
            .groupBy("_doc", "_text").agg(F.sort_array(F.collect_list(F.struct("p0", "p1"))).alias("_cut")))


def _with_cuts(docs: DataFrame, min_words: int) -> DataFrame:
    """``_row``, the documents as structs (so that no name of theirs clashes), and ``_cut``."""
    cut = stage(_merged(repeated_runs(docs.select("doc_id", "text"), min_words)), "line-cuts")
    keyed = docs.select(F.struct("*").alias("_row"), F.xxhash64("text").alias("_key"))
    # the cuts grow with the corpus: dealt by document at every size, hashed per partition (texts are not sorted)
    return keyed.join(cut.hint("shuffle_hash"), F.col("_row.doc_id").eqNullSafe(F.col("_doc")) & (F.col("_key") == F.col("_text"))
                      & F.col("_row.text").isNotNull(), "left").select("_row", "_cut")


def mark_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with ``_cut``: the line runs to delete (p0 to p1), NULL if there are none."""
    return _with_cuts(docs.drop("_cut"), min_words).select("_row.*", "_cut")


def without(text: Column, cut: Column) -> Column:
    """``text`` without the line runs of ``cut`` (sorted, apart)."""
    lines = F.split(text, "\n", -1)
    n = F.size(cut)
    kept = F.transform(F.sequence(F.lit(0), n), lambda j: F.struct(
        F.when(j == 0, 0).otherwise(F.get(cut, j - 1)["p1"] + 1).alias("a"),
        F.when(j == n, F.size(lines)).otherwise(F.get(cut, j)["p0"]).alias("b")))
    return F.array_join(F.flatten(F.transform(kept, lambda x: F.slice(lines, x["a"] + 1, x["b"] - x["a"]))), "\n")


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, drop_emptied: bool = False) -> DataFrame:
    """The documents without later copies of repeated runs; the columns of ``docs``.

    ``drop_emptied`` leaves out documents of which no word is left; those that
    had none before stay.
    """
    marked, cut = _with_cuts(docs, min_words), F.col("_cut")
    text = F.when(cut.isNull(), F.col("_row.text")).otherwise(without(F.col("_row.text"), cut))
    out = marked.withColumn("_row", F.col("_row").withField("text", text))
    if drop_emptied:
        out = out.where(cut.isNull() | F.col("_row.text").rlike(WORD))
    if "n_chars" in docs.columns:
        n = F.when(cut.isNull(), F.col("_row.n_chars")).otherwise(F.length("_row.text").cast(docs.schema["n_chars"].dataType))
        out = out.withColumn("_row", F.col("_row").withField("n_chars", n))
    return out.select("_row.*")
