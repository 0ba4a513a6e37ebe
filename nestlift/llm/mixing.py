"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

Every source's words form a stream cut into shards (by seeded hash of the
document) and each shard into blocks of equal size. Blocks are apportioned twice
by highest quotients, first to the sources by their targets, then within each
source to its shards by their sizes, which gives an integer quota per shard. A
shard's quota is met by a seeded systematic choice among its blocks (all of
them once more for each full round of the quota). A document's ``taken`` is the
chosen part of the blocks it covers.

Only DataFrame functions. The number of shards follows the data, so a source
that holds a third of all words is spread over many tasks, and nothing but one
row per source or shard meets in a window without a shard key.

Defined results: NULL text counts 0 words; a NULL source is a source of its own,
last in order; sources without words have target 0; rows with the same id (NULL
included) are ordered by size, so equal rows share a stretch of blocks in either
order; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from nestlift.llm.common import WORD, stage, word_count

BLOCK_WORDS = 32
SHARD_WORDS = 100_000
WHOLE_BLOCK_WORDS = 2_048
MAX_SHARDS = 4096       # per source: only how finely a source is spread, not how much is taken


def seeded(seed: int, *cols: Column) -> Column:
    """A non-negative 60-bit number from md5: the same in any engine, on any run."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("null")) for c in cols])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def source_targets(sources: DataFrame, weights: Sequence[int], share: float, stop: float) -> DataFrame:
    """Adds ``weight`` and ``target`` to one row per source (``source``, ``source_size``).

    Targets are proportional to weight until they reach ``stop`` times the
    source's size; what the full ones cannot take is shared again. In closed
    form: sources fill up in the order of size per weight, and the level at which
    the rest shares out is the one no open source exceeds.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    fill = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    s = (sources.withColumn("weight", weight)
         .withColumn("most", F.lit(float(stop)) * F.col("source_size"))
         .withColumn("full_at", F.col("most") / F.col("weight"))
         .withColumn("budget", F.lit(float(share)) * F.sum("source_size").over(everything))
         .withColumn("full_before", F.coalesce(F.sum("most").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
         .withColumn("open_weight", F.sum("weight").over(fill.rowsBetween(0, Window.unboundedFollowing)))
         .withColumn("level", (F.col("budget") - F.col("full_before")) / F.col("open_weight")))
    # the first source in filling order whose own bound is above the level fixes it
    level = F.min(F.when(F.col("full_at") >= F.col("level"), F.struct("full_at", "level"))).over(everything)["level"]
    return (s.withColumn("final", level)
            .withColumn("target", F.when(F.col("final").isNull(), F.col("most"))
                        .otherwise(F.least(F.col("most"), F.col("final") * F.col("weight"))))
            .select("source", "source_size", "weight", "target"))


def apportion(cells: DataFrame, group: list[str], key: list[str], weight: str, seats: str, out: str) -> DataFrame:
    """Sainte-Laguë: give ``seats`` (a column, equal within ``group``) to cells by highest quotients.

    A cell that has k seats bids weight / (2k + 1). The seats nearest to each
    cell's exact share are safe; bids are only listed where the outcome can still
    change (the rounding of all cells, spread by share, bounds how far a cell can
    move), about four rows per cell. Ties go by key. Cells of weight 0 get none.
    """
    w = Window.partitionBy(*group) if group else Window.partitionBy()
    c = (cells.withColumn("_sum", F.sum(weight).over(w)).withColumn("_n", F.count(F.lit(1)).over(w))
         .withColumn("_part", F.when(F.col("_sum") > 0, F.col(weight) / F.col("_sum")).otherwise(0.0))
         .withColumn("_near", F.round(F.col("_part") * F.col(seats)).cast("long"))
         .withColumn("_span", (F.ceil(F.col("_n") / 2 * F.col("_part")) + 1).cast("long"))
         .withColumn("_safe", F.greatest(F.lit(0), F.col("_near") - F.col("_span"))))
    bids = (c.where(F.col(weight) > 0)
            .select("*", F.explode(F.sequence("_safe", F.col("_near") + F.col("_span"))).alias("_k"))
            .withColumn("_bid", F.col(weight) / (2 * F.col("_k") + 1))
            .withColumn("_open", F.col(seats) - F.sum(F.when(F.col("_k") == F.col("_safe"), F.col("_safe"))).over(w)))
    order = Window.partitionBy(*group) if group else Window.partitionBy()
    won = (bids.withColumn("_rank", F.row_number().over(
               order.orderBy(F.col("_bid").desc(), *[F.col(k).asc_nulls_last() for k in key], "_k")))
           .groupBy(*cells.columns).agg((F.max("_safe") + F.count_if(F.col("_rank") <= F.col("_open"))).alias(out)))
    return won.unionByName(c.where(~(F.col(weight) > 0)).select(*cells.columns, F.lit(0).cast("long").alias(out)))


def chosen_before(i: Column, blocks: Column, rest: Column, start: Column, together: bool) -> Column:
    """How many of a shard's first ``i`` blocks are chosen, of ``rest`` in all.

    Evenly spread from a seeded start: block j is chosen when floor((j + start) * rest / blocks)
    steps up after it. ``together``: the ``rest`` blocks from the start on, round the end.
    """
    if together:
        zero, stop = F.lit(0).cast("long"), start + rest
        return F.greatest(zero, F.least(i, stop) - start) + F.greatest(zero, F.least(i, stop - blocks))
    steps = lambda i: F.floor((i + start) * rest / blocks)
    return steps(i) - steps(F.lit(0))


def taken_before(x: Column, blocks: Column, quota: Column, start: Column, block_words: int, together: bool = False) -> Column:
    """Words taken from the first ``x`` words of a shard's stream.

    Every full round of the quota takes all blocks, and ``chosen_before`` says which ones
    its rest takes. All blocks but a shard's last have the same size.
    """
    j = F.floor(x / block_words)
    before, after = (chosen_before(i, blocks, quota % blocks, start, together) for i in (j, j + 1))
    return (F.floor(quota / blocks) * x + block_words * before + (after - before) * (x - j * block_words)).cast("long")


def mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, stop: float = 2.0,
        block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, seed: int = 11,
        keep: Sequence[Column] = (), together: bool = False) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies, source, shard, quota: one row per document.

    ``weights`` repeat over the sources in order; ``share`` is the mix's size in
    proportion to all words; ``stop`` bounds how often a source is repeated.
    ``copies`` is how often the block in which the document begins is taken (1
    for documents without words); ``keep`` are further columns to carry along.
    """
    raw = stage(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), *keep), "mix-sizes")
    kept = raw.columns[3:]
    sources = source_targets(raw.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, stop)
    sources = (sources.withColumn("blocks_wanted", F.round(F.sum("target").over(Window.partitionBy()) / block_words).cast("long"))
               .withColumn("shards", F.least(F.lit(MAX_SHARDS), F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)))))
    sources = stage(apportion(sources, [], ["source"], "target", "blocks_wanted", "source_quota"), "mix-sources")
    sharded = (raw.withColumnRenamed("source", "_s")
               .join(sources, F.col("_s").eqNullSafe(F.col("source"))).drop("_s")
               .withColumn("_at", seeded(seed, F.col("doc_id"))).withColumn("shard", F.pmod("_at", "shards")))
    shards = (sharded.groupBy("source", "shard", "source_quota").agg(F.sum("size").alias("shard_size")))
    shards = (apportion(shards, ["source"], ["shard"], "shard_size", "source_quota", "quota")
              .withColumn("blocks", F.ceil(F.col("shard_size") / block_words))
              # a block too many from rounding must not take a document beyond its bound
              .withColumn("quota", F.least("quota", F.floor(F.lit(float(stop)) * F.col("blocks"))))
              .withColumn("start", F.pmod(seeded(seed, F.col("source"), F.col("shard")), F.greatest(F.lit(1), "blocks"))))
    shards = stage(shards.select(F.col("source").alias("_s"), F.col("shard").alias("_h"), "quota", "blocks", "start"), "mix-shards")
    order = Window.partitionBy("source", "shard").orderBy("_at", "doc_id", "size")
    placed = (sharded.join(shards, F.col("_s").eqNullSafe(F.col("source")) & (F.col("_h") == F.col("shard")))
              .withColumn("_end", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("_begin", F.col("_end") - F.col("size")))
    before = lambda c: taken_before(c, F.col("blocks"), F.col("quota"), F.col("start"), block_words, together)
    taken = F.when(F.col("size") > 0, before(F.col("_end")) - before(F.col("_begin"))).otherwise(F.lit(0).cast("long"))
    first = F.floor(F.col("_begin") / block_words)
    rest, steps = F.col("quota") % F.col("blocks"), lambda i: F.floor((i + F.col("start")) * rest / F.col("blocks"))
    copies = F.when(F.col("size") > 0, F.floor(F.col("quota") / F.col("blocks")) + steps(first + 1) - steps(first))
    return placed.select("doc_id", "size", "source_size", "target", taken.alias("taken"),
                         F.coalesce(copies, F.lit(1)).cast("long").alias("copies"), "source", "shard", "quota", *kept)


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its ``n``-th word."""
    pieces = F.regexp_extract_all(text, F.lit(r"([\x20\x09-\x0D]*" + WORD + ")"), F.lit(1))
    return F.array_join(F.slice(pieces, F.lit(1), n.cast("int")), "")


def write_mix(docs: DataFrame, block_words: int | None = None, parts: bool = False, **parameters) -> DataFrame:
    """The mix as documents; the columns of ``docs``.

    Whole documents: each once for every time the block it begins in is taken,
    so nothing is cut, but a document longer than a block (of WHOLE_BLOCK_WORDS)
    counts as one block, and a source of less than a block can be left out.
    With ``parts``, the quotas are in blocks of BLOCK_WORDS, a shard's chosen blocks
    lie together, and a document is written whole as often as its ``taken`` words
    hold it, and once more up to the words that remain. So every source gets its
    quota of words however small it is or long its documents are, and a shard cuts
    two documents at most (``n_chars`` follows the text).
    Equal rows of a source are written equally often; with ``parts`` they share
    their taken words evenly.
    """
    key = [F.xxhash64("doc_id", "text", "source").alias("_k1"), F.xxhash64(F.lit("row"), "source", "text", "doc_id").alias("_k2")]
    mixed = mix(docs, block_words=block_words or (BLOCK_WORDS if parts else WHOLE_BLOCK_WORDS), keep=key, together=parts, **parameters)
    share = F.round(F.avg("taken")).cast("long")
    whole = F.when(F.max("size") > 0, F.floor(share / F.max("size"))).otherwise(F.lit(1)) if parts else F.min("copies")
    rest = F.when(F.max("size") > 0, share % F.max("size")) if parts else F.lit(0)
    times = stage(mixed.groupBy("_k1", "_k2").agg(whole.cast("long").alias("_whole"),
                                                  F.coalesce(rest, F.lit(0)).cast("long").alias("_rest")), "mix-copies")
    times = times.withColumn("_times", F.col("_whole") + (F.col("_rest") > 0).cast("long"))
    # as many rows as documents: dealt by row at every size, hashed per partition (texts are not sorted);
    # a document's own columns travel in one struct, so their names cannot clash
    out = (docs.select(F.struct("*").alias("_row"), *key).join(times.where("_times > 0").hint("shuffle_hash"), ["_k1", "_k2"])
           .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_times")))))
    if parts:
        cut = F.col("_copy") > F.col("_whole")
        text = F.when(cut, first_words(F.col("_row.text"), F.col("_rest"))).otherwise(F.col("_row.text"))
        out = out.withColumn("_row", F.col("_row").withField("text", text))
        if "n_chars" in docs.columns:
            n = F.when(cut, F.length("_row.text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("_row.n_chars"))
            out = out.withColumn("_row", F.col("_row").withField("n_chars", n))
    return out.select("_row.*")
