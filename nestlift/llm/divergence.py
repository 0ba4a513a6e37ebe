"""Source divergence audit by run-length columns.

Per language, a term's counts in the sources form a row of a table whose columns
are the groups (lang, source). The vocabulary is reordered so that equal counts
lie together, each column is run-length encoded, and two groups are compared by
cutting their columns at the boundaries of both: within a piece both counts are
constant, so the divergence f is computed once and multiplied by the piece's
length.

1. ``term_counts``: occurrences and documents per (lang, source, term). Each task
   adds up its own documents before anything is shuffled.
2. ``columns``: one row per kept term with its counts, then one row per distinct
   row of counts with the number of terms that share it. Most terms of a corpus
   share a few such rows, so this is the first and largest run-length step, and a
   row of counts that millions of terms share is one row.
3. ``pair_values``: the distinct rows, range partitioned and sorted, are read in
   blocks of a bounded size. In a block every group's column is encoded as runs, and
   each pair's boundaries are intersected. Blocks give partial sums per pair.

Only the groups (distinct lang and source) reach the driver and the tasks as a
list: the result holds their square, so they are few beside it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from nestlift.llm.common import each, stage

MIN_DOCS = 3
SCALE = 1_000_000_000
TERM_RANKS = 200
HELD_TERMS = 200_000        # counts a task holds before it hands them on
BLOCK_CELLS = 1 << 20       # counts of a block: groups x rows
SALTS = 32                  # parts of a group's terms that are ranked by themselves first

# term characters: letters A-Z a-z and everything beyond ASCII; the others become blanks, A-Z becomes a-z
_KEEP = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def terms_of(text: str) -> list[bytes]:
    """The terms of a text as UTF-8, in order."""
    return text.encode("utf-8", "surrogatepass").translate(_KEEP).split()


def groups_of(docs: DataFrame) -> dict[str, list[str]]:
    """The sources of each language, in UTF-8 order."""
    out: dict[str, list[str]] = {}
    for lang, source in docs.select("lang", "source").distinct().collect():
        out.setdefault(lang, []).append(source)
    return {lang: sorted(x, key=lambda s: s.encode("utf-8", "surrogatepass")) for lang, x in sorted(out.items())}


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)


def term_counts(docs: DataFrame, groups: dict[str, list[str]]) -> DataFrame:
    """lang, g (the source's place among the language's sources), term, n, docs: one row per group and term."""
    place = {lang: {s: i for i, s in enumerate(sources)} for lang, sources in groups.items()}
    schema = pa.schema([("lang", pa.string()), ("g", pa.int32()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int], dict[bytes, list[int]]] = {}
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            for (lang, g), terms in held.items():
                rows = list(terms.values())
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(rows), pa.string()), pa.array([g] * len(rows), pa.int32()),
                    pa.array(list(terms), pa.binary()).cast(pa.string()),
                    pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64())], schema=schema)

        for batch in batches:
            for lang, source, text in zip(*(each(batch.column(c)) for c in ("lang", "source", "text")), strict=True):
                own = held.setdefault((lang, place[lang][source]), {})
                size -= len(own)
                seen: dict[bytes, int] = {}
                for t in terms_of(text):
                    seen[t] = seen.get(t, 0) + 1
                for t, n in seen.items():
                    row = own.get(t)
                    if row is None:
                        own[t] = [n, 1]
                    else:
                        row[0] += n
                        row[1] += 1
                size += len(own)
                if size >= HELD_TERMS:
                    yield from out()
                    held, size = {}, 0
        yield from out()

    return (docs.select("lang", "source", "text").mapInArrow(count, "lang string, g int, term string, n long, docs long")
            .groupBy("lang", "g", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))


def columns(counts: DataFrame, min_docs: int) -> DataFrame:
    """lang, term, total, cells: each kept term with its counts, ordered by group."""
    return (counts.groupBy("lang", "term")
            .agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.array_sort(F.collect_list(F.struct("g", "n"))).alias("cells"))
            .where(F.col("docs") >= min_docs).drop("docs"))


def runs(column: np.ndarray) -> np.ndarray:
    """Where the runs of equal counts of a column start."""
    return np.concatenate([[0], np.flatnonzero(column[1:] != column[:-1]) + 1])


def _smoothed(column: np.ndarray, total: int, scale: int) -> np.ndarray:
    """p of each count, in exact integers."""
    value, back = np.unique(column, return_inverse=True)
    return np.array([1 + scale * (int(c) + 1) // total for c in value], np.int64)[back]


def block_sums(counts: np.ndarray, lengths: np.ndarray, totals: list[int], scale: int = SCALE) -> dict[tuple[int, int], int]:
    """Sum of f over a block for every ordered pair of groups.

    ``counts``: a row per group, a column per distinct row of counts; ``lengths``: the
    terms that each column stands for; ``totals``: N + V of each group.
    """
    starts = [runs(row) for row in counts]
    p = [_smoothed(row[s], t, scale) for row, s, t in zip(counts, starts, totals, strict=True)]
    before = np.concatenate([[0], np.cumsum(lengths)])
    out: dict[tuple[int, int], int] = {}
    for a in range(len(starts)):
        for b in range(a + 1, len(starts)):
            cut = np.union1d(starts[a], starts[b])
            length = np.diff(before[np.append(cut, len(lengths))])
            x = p[a][np.searchsorted(starts[a], cut, "right") - 1]
            y = p[b][np.searchsorted(starts[b], cut, "right") - 1]
            square = (x - y) ** 2                       # below 2^60
            for one, two, q in ((a, b, y), (b, a, x)):
                f = square // q
                # in two halves of 30 bits, so that no product with a length overflows
                out[one, two] = (int(np.dot(f >> 30, length)) << 30) + int(np.dot(f & ((1 << 30) - 1), length))
    return out


def pair_values(cells: DataFrame, groups: dict[str, list[str]], totals: dict[str, list[int]]) -> DataFrame:
    """lang, a, b, value: f summed over the kept terms for every ordered pair of a language's groups."""
    equal = stage(cells.groupBy("lang", "cells").agg(F.count(F.lit(1)).alias("terms")), "equal-counts")
    parts = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[str, int, int], int] = {}
        lang, rows, lengths = None, [], []

        def close() -> None:
            if rows:
                at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
                flat = [c for r in rows for c in r]
                counts = np.zeros((len(groups[lang]), len(rows)), np.int64)
                counts[[c["g"] for c in flat], at] = [c["n"] for c in flat]
                for (a, b), v in block_sums(counts, np.array(lengths, np.int64), totals[lang]).items():
                    total[lang, a, b] = total.get((lang, a, b), 0) + v
                rows.clear()
                lengths.clear()

        for batch in batches:
            for name, row, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "cells", "terms")), strict=True):
                if name != lang or len(rows) * len(groups[lang]) >= BLOCK_CELLS:
                    close()
                    lang = name
                rows.append(row)
                lengths.append(n)
        close()
        keys = list(total)
        for i in range(0, len(keys), 10_000):
            part = keys[i: i + 10_000]
            yield pa.RecordBatch.from_arrays([
                pa.array([k[0] for k in part], pa.string()), pa.array([k[1] for k in part], pa.int32()),
                pa.array([k[2] for k in part], pa.int32()),
                pa.array([str(total[k]) for k in part], pa.string())], names=["lang", "a", "b", "value"])

    return (equal.repartitionByRange(parts, "lang", "cells").sortWithinPartitions("lang", "cells")
            .mapInArrow(sums, "lang string, a int, b int, value string")
            .groupBy("lang", "a", "b").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")))


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, ranks: int = TERM_RANKS) -> DataFrame:
    """lang, source, part, item, value, rank: how far every group is from the others of its language.

    Part ``pair``: every other source of the language with f summed over the kept
    terms. Part ``term``: the group's terms that are likelier in it than in the
    language, the first ``ranks`` by f. Ranks go by value, then item in UTF-8 order.

    NULL text, lang and source are empty strings; repeated rows count as documents
    of their own. A group without terms is compared like any other. An empty table,
    and a language with one source and no likelier terms, give no rows. Other
    columns are ignored. A value that no long can hold is NULL.
    """
    spark = docs.sparkSession
    docs = docs.select(_text("lang"), _text("source"), _text("text"))
    groups = groups_of(docs)
    counts = term_counts(docs, groups)
    kept = stage(columns(counts, min_docs), "term-columns")
    cell = kept.select("lang", "term", "total", F.explode("cells").alias("c")).select("lang", "term", "total", "c.g", "c.n")
    seen = {(r["lang"], r["g"]): int(r["n"]) for r in cell.groupBy("lang", "g").agg(F.sum("n").alias("n")).collect()}
    terms = {r["lang"]: int(r["v"]) for r in kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v")).collect()}
    totals = {lang: [seen.get((lang, g), 0) + terms.get(lang, 0) for g in range(len(sources))] for lang, sources in groups.items()}

    table = spark.createDataFrame(
        [(lang, g, s, totals[lang][g], sum(totals[lang]) - (len(sources) - 1) * terms.get(lang, 0))
         for lang, sources in groups.items() for g, s in enumerate(sources)],
        "lang string, g int, source string, own long, whole long")
    named = table.select("lang", "g", "source")

    # every ordered pair, so that languages without kept terms have their rows of 0
    others = (named.withColumnRenamed("source", "item").withColumnRenamed("g", "b"))
    every = named.withColumnRenamed("g", "a").join(F.broadcast(others), "lang").where(F.col("a") != F.col("b"))
    found = pair_values(kept.select("lang", "cells"), groups, totals)
    zero = F.lit(0).cast("decimal(38,0)")
    pairs = (every.join(found, ["lang", "a", "b"], "left")
             .select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", zero).alias("value")))
    group = Window.partitionBy("lang", "source")
    best = [F.col("value").desc(), F.col("item")]
    pairs = pairs.withColumn("rank", F.row_number().over(group.orderBy(*best)))

    p = "1 + (CAST({} + 1 AS DECIMAL(20,0)) * 1000000000) div CAST({} AS DECIMAL(20,0))"
    likelier = (cell.join(F.broadcast(table), ["lang", "g"])
                .select("lang", "source", F.col("term").alias("item"), F.expr(p.format("n", "own")).alias("p"),
                        F.expr(p.format("total", "whole")).alias("q"))
                .where("p > q").select("lang", "source", "item", F.expr("(p - q) * (p - q) div q").alias("value")))
    # a group's terms are ranked in parts first, so that a large group is not one task
    part = Window.partitionBy("lang", "source", "salt").orderBy(*best)
    likelier = (likelier.withColumn("salt", F.pmod(F.xxhash64("item"), F.lit(SALTS)))
                .withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= ranks))
    top = (likelier.withColumn("rank", F.row_number().over(group.orderBy(*best))).where(F.col("rank") <= ranks)
           .select("lang", "source", F.lit("term").alias("part"), "item", F.col("value").cast("decimal(38,0)").alias("value"), "rank"))
    return pairs.unionByName(top).select("lang", "source", "part", "item", F.expr("try_cast(value AS BIGINT)").alias("value"), "rank")
