"""Quartile bucket digests of texts, and a bounded likeness between two digests.

A digest counts the text's hashed byte triplets in 256 buckets and keeps, per
bucket, the quartile its count falls in (2 bits), plus the length on a log scale
and how the quartiles lie to each other. Texts that share most of their content
keep most bucket codes; the difference score adds up how far the codes are apart
(opposite quartiles count double) and is bounded by what unrelated codes reach
on average, so the likeness runs from 0 to 1.

``edited_fingerprints`` also digests every text with its tail replaced by the
head of the next document in id order. Neighbours meet without a global sort in
one task: ids are cut into ranges, an id that fills several ranges (a NULL id too)
into parts by the hash that orders its texts; each range's first document is also
sent to the range before it as a guest, and a range is read in order, one document
held at a time.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from nestlift.llm.common import each

BUCKETS = 256
RANGES_PER_PARTITION = 4
MAX_RANGES = 20_000
# mean difference of two unrelated codes (0, 1, 2 or, for opposite quartiles, 6), over all buckets
UNRELATED = 1.625 * BUCKETS
_APART = np.array([0, 1, 2, 6], np.int64)


class Digest:
    """Quartile codes of a text's triplet counts, its length code and quartile ratios."""

    __slots__ = ("codes", "length", "low", "mid")

    def __init__(self, text: str):
        raw = np.frombuffer(b"\0\0" + text.encode("utf-8", "surrogatepass") + b"\0\0", np.uint8).astype(np.uint32)
        triplet = raw[:-2] << np.uint32(16) | raw[1:-1] << np.uint32(8) | raw[2:]
        counts = np.bincount((triplet * np.uint32(0x9E3779B1)) >> np.uint32(24), minlength=BUCKETS)
        q1, q2, q3 = np.partition(counts, (63, 127, 191))[[63, 127, 191]].tolist()
        self.codes = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
        self.length = min(255, int(16 * np.log2(1 + (len(raw) - 4) / 16)))
        self.low, self.mid = (q1 * 15 // q3, q2 * 15 // q3) if q3 else (0, 0)

    def __str__(self) -> str:
        packed = self.codes.reshape(-1, 4) @ np.array([64, 16, 4, 1], np.uint8)
        return f"{self.length:02x}{self.low:x}{self.mid:x}" + packed.astype(np.uint8).tobytes().hex()


def likeness(a: Digest, b: Digest) -> float:
    """1 for equal digests, 0 from the mean difference of unrelated ones on."""
    codes = _APART[np.abs(a.codes.astype(np.int64) - b.codes)].sum()
    rest = abs(a.length - b.length) + abs(a.low - b.low) + abs(a.mid - b.mid)
    return float(max(0.0, 1.0 - (codes + rest) / UNRELATED))


def edited(text: str, after: str) -> str:
    """``text`` with its last quarter (rounded down) replaced by the first as many characters of ``after``."""
    k = len(text) // 4
    return text[: len(text) - k] + after[:k]


_OUT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                  ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                  ("near_edited", pa.float64()), ("near_next", pa.float64())])
_ROWS_OUT = 2_000


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come ordered by range, documents before the guest; each is finished by the one after it."""
    out: list[tuple] = []
    held = None
    for batch in batches:
        for rng, guest, doc, text in zip(*(each(batch.column(c)) for c in ("rng", "guest", "doc_id", "text")),
                                         strict=True):
            text = text or ""
            digest = Digest(text)
            if held is not None and held[0] == rng:
                _, doc0, text0, digest0 = held
                new = edited(text0, text)
                d = digest0 if new == text0 else Digest(new)
                out.append((doc0, len(text0), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(),
                            str(digest0), str(d), likeness(digest0, d), likeness(digest0, digest)))
                if len(out) >= _ROWS_OUT:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _OUT, strict=True)], schema=_OUT)
                    out = []
            held = None if guest else (rng, doc, text, digest)
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _OUT, strict=True)], schema=_OUT)


def _ranged(docs: DataFrame, ranges: int) -> DataFrame:
    """``docs`` with ``h`` and ``rng``, the number of a row's range in the order of id (NULL last) and ``h``.

    Quantiles of the ids cut them. An id that several quantiles fall on is hot: its
    rows are cut once more by ``h``, evenly, since it is a hash, into as many parts.
    """
    rows = docs.withColumn("h", F.xxhash64("text")).withColumn("x", F.col("doc_id").cast("double"))
    at = [i / ranges for i in range(1, ranges)]
    cuts = rows.approxQuantile("x", at, 0.1 / ranges)
    bounds = sorted(set(cuts))
    # beyond 2^53 several ids are one double: these are not cut by hash
    parts = [cuts.count(x) if abs(x) < 2.0 ** 53 else 1 for x in bounds]
    seen = docs.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("doc_id").isNull()).alias("null")).first()
    null_parts = max(1, math.ceil(ranges * seen["null"] / max(1, seen["n"])))
    # range 0 lies below all bounds; range i begins with the parts of the id bounds[i - 1], the other ids follow
    first = [0]
    for n in [0, *parts]:
        first.append(first[-1] + n + 1)
    share = F.col("h").cast("double") / 2.0 ** 64 + 0.5

    def part(n: Column) -> Column:
        return F.least(F.floor(share * n), n - 1)

    def entry(values: list) -> Column:
        return F.element_at(F.array(*map(F.lit, values)), F.col("i").cast("int") + 1)

    cut = Bucketizer(splits=[float("-inf"), *(bounds or [0.0]), float("inf")], inputCol="x", outputCol="i", handleInvalid="keep")
    hot = entry([0, *(parts or [1])])
    rng = (F.when(F.col("x").isNull(), F.lit(first[-1] + 1) + part(F.lit(null_parts)))
           .otherwise(entry(first[: len(bounds) + 1] if bounds else [0, 0])
                      + F.when(F.col("x") == entry([float("-inf"), *(bounds or [0.0])]), part(hot)).otherwise(hot)))
    return cut.transform(rows).withColumn("rng", rng.cast("long")).drop("x", "i")


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Documents follow each other by id, then text hash; NULL ids come last and
    the last document is followed by the first (a lone one by itself). NULL text
    counts as empty. Repeated rows each get a row and follow each other. Other
    columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ranges = min(MAX_RANGES, RANGES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = _ranged(docs, ranges)
    # one row per range (their number is bounded above): its first document, and the range before it
    order = Window.orderBy("rng")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "h"))
    heads = (rows.groupBy("rng").agg(first.alias("first"))
             .withColumn("before", F.coalesce(F.lag("rng").over(order), F.max("rng").over(Window.partitionBy())))
             .select(F.col("rng").alias("of"), "before", F.col("first.doc_id").alias("d"), F.col("first.h").alias("g")))
    guests = (rows.join(F.broadcast(heads), (F.col("rng") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("d"))
                        & (F.col("h") == F.col("g")))
              .dropDuplicates(["of"]).select(F.col("before").alias("rng"), "doc_id", "text", "h", F.lit(1).alias("guest")))
    meet = (rows.withColumn("guest", F.lit(0)).unionByName(guests).repartition("rng")
            .sortWithinPartitions("rng", "guest", F.col("doc_id").asc_nulls_last(), "h"))
    return meet.select("rng", "guest", "doc_id", "text").mapInArrow(
        _rows, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
               "near_edited double, near_next double")
