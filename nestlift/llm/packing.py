"""Best-two-fit packing of tokenised documents into sequences of fixed length.

1. Each document becomes token ids plus one end id. Only documents longer than
   a sequence are cut: the first piece takes the remainder, the others are full.
2. The packing itself needs only how many pieces there are of each length, a
   table of at most ``max_len`` rows. On it, each bin is filled greedily (the
   longest piece that fits, again and again); if a gap is left, the bin's
   smallest piece is swapped for the two unpacked pieces that fill the expanded
   gap best, when they fill it more tightly. A filled bin is repeated as long as
   the counts allow, so the work depends on ``max_len``, not on the documents.
3. Pieces of one length are interchangeable: each gets its rank among those of
   its length (numbered within shards, plus the shard's first rank, so a length
   that many pieces share is numbered by many tasks) and the rank gives its bin.

Defined results: NULL text counts as empty (one end id); an empty table gives no
rows; repeated rows and NULL ids are packed like any others (which of two equal
pieces gets which place is open); other columns are ignored.
"""

from __future__ import annotations

import bisect
import os
import re
import zlib
from array import array
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from nestlift.llm.common import each, stage, worker_cache
from nestlift.llm.token_count import byte_symbols

CACHE_CHUNKS = 250_000
ROWS_PER_SHARD = 2_000
_DOUBLE = ("  ", "\n\n", " \n", "\n ")

PIECE = T.StructType([
    T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())])


class ChunkEncoder:
    """Token ids of whole texts, put together from cached chunks.

    The byte-level pre-tokenizer always cuts before a single space that a
    non-space follows, and around a single line break between non-spaces, so the
    ids of a text are those of its chunks in order. A chunk's pre-tokens go to the
    vocabulary's merge model one by one. Texts with other white space or with an
    added token are encoded whole. ``cache`` bounds what is kept (see ``_Recent``):
    fewer chunks take less memory of each Python worker and more time.
    """

    # fixed value: the pre-token pattern of byte-level vocabularies
    PRE = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def __init__(self, path: str, cache: int = CACHE_CHUNKS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.model = self.tok.model
        self.added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.pre = regex.compile(self.PRE)
        self.symbols = dict(enumerate(byte_symbols()))
        self.space = self.symbols[32]
        # any white space but a space or a line break (also what str methods take for it)
        self.odd = re.compile("[\t\x0b\x0c\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
        self.words = _Recent(self.word, cache)
        self.chunks = _Recent(self.chunk, cache)

    def raw(self, text: str) -> bytes:
        return np.asarray(self.tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def word(self, word: str) -> bytes:
        """Ids of one pre-token."""
        symbols = (word.replace(" ", self.space) if word.isascii() and word.isprintable()
                   else word.encode("utf-8").decode("latin-1").translate(self.symbols))
        return array("I", [t.id for t in self.model.tokenize(symbols)]).tobytes()

    def chunk(self, key: str | tuple[str]) -> bytes:
        """Ids of a chunk, without its leading space; a 1-tuple stands for a text's first chunk."""
        if isinstance(key, tuple):
            return b"".join(map(self.words.__getitem__, self.pre.findall(key[0])))
        if key.isalpha():                                   # one pre-token: letters after a space
            return self.word(" " + key)
        if key[-1] in ".," and key[:-1].isalpha():          # two
            return self.chunks[key[:-1]] + self.words[key[-1]]
        return b"".join(map(self.words.__getitem__, self.pre.findall(key if key[0] == "\n" else " " + key)))

    def ids(self, text: str) -> bytes:
        """Ids of ``text`` as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if (text[0] in " \n" or text[-1] in " \n" or any(a in text for a in _DOUBLE) or self.odd.search(text)
                or any(a in text for a in self.added)):
            return self.raw(text)
        parts = text.replace("\n", " \n").split(" ")
        return self.chunks[parts[0], ] + b"".join(map(self.chunks.__getitem__, parts[1:]))


class _Recent(dict):
    """Key -> ids as ``make`` gives them; what was looked up last stays, at most twice ``most``.

    When ``most`` are held they become the old ones and the old ones before them go: what
    comes again and again is not worked out anew, whatever the number of rare ones between.
    """

    def __init__(self, make: Callable[..., bytes], most: int):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, key) -> bytes:
        ids = self.old.get(key)
        if ids is None:
            ids = self.make(key)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        if len(ids) <= 256:
            self[key] = ids
        return ids


def _encoder(path: str, cache: int = CACHE_CHUNKS) -> ChunkEncoder:
    return worker_cache(("packing", path, cache), lambda: ChunkEncoder(path, cache))


def cuts(n: int, max_len: int) -> list[int]:
    """Piece lengths of a document of ``n`` tokens: the remainder first, then full ones."""
    full, rest = divmod(n, max_len)
    return ([rest] if rest else []) + [max_len] * full


def pieces(text: Column, path: str, max_len: int, end_id: int, cache: int = CACHE_CHUNKS) -> Column:
    """Array of PIECE structs of each text."""
    end = np.asarray([end_id], "<u4").tobytes()

    @F.arrow_udf(T.ArrayType(PIECE))
    def cut(texts: pa.Array) -> pa.Array:
        enc = _encoder(path, cache)
        out = []
        for text in each(texts):
            ids = enc.ids(text or "") + end
            at, row = 0, []
            for i, n in enumerate(cuts(len(ids) // 4, max_len)):
                row.append({"piece": i, "start": at, "length": n,
                            "ids_crc32": zlib.crc32(ids[4 * at:4 * (at + n)])})
                at += n
            out.append(row)
        return pa.array(out, pa.list_(pa.struct([("piece", pa.int32()), ("start", pa.int64()),
                                                 ("length", pa.int64()), ("ids_crc32", pa.int64())])))

    return cut(text)


def token_ids(text: Column, path: str, end_id: int = 0) -> Column:
    """The token ids themselves (array<long>), end id included."""
    @F.arrow_udf(T.ArrayType(T.LongType()))
    def encode(texts: pa.Array) -> pa.Array:
        enc = _encoder(path)
        return pa.array([np.frombuffer(enc.ids(t or ""), "<u4").tolist() + [end_id] for t in each(texts)],
                        pa.list_(pa.int64()))

    return encode(text)


def best_two_fit(counts: dict[int, int], cap: int) -> list[tuple[list[int], int]]:
    """Bins as (piece lengths, how many such bins) for ``counts`` pieces of each length <= cap."""
    left = {n: c for n, c in counts.items() if c > 0}
    lengths = sorted(left)

    def take(n: int) -> None:
        left[n] -= 1
        if not left[n]:
            del lengths[bisect.bisect_left(lengths, n)]

    def give(n: int) -> None:
        if not left[n]:
            bisect.insort(lengths, n)
        left[n] += 1

    bins: list[tuple[list[int], int]] = []
    while lengths:
        items, gap = [], cap
        while (k := bisect.bisect_right(lengths, gap)):
            items.append(lengths[k - 1])
            gap -= items[-1]
            take(items[-1])
        if gap and len(lengths) and items:
            room = gap + items[-1]              # the greedy fill is in falling order
            two = _two_fit(lengths, left, room)
            if two and sum(two) > items[-1]:
                give(items.pop())
                for n in two:
                    take(n)
                items = sorted(items + list(two), reverse=True)
        need = {n: items.count(n) for n in items}
        more = min(left[n] // m for n, m in need.items())
        if more:
            for n, m in need.items():
                left[n] -= more * m
                if not left[n]:
                    del lengths[bisect.bisect_left(lengths, n)]
        bins.append((items, more + 1))
    return bins


def _two_fit(lengths: list[int], left: dict[int, int], room: int) -> tuple[int, int] | None:
    """The two unpacked lengths of the largest sum within ``room``."""
    a = np.asarray(lengths)
    at = np.searchsorted(a, room - a, "right") - 1
    same = at == np.arange(len(a))
    single = np.asarray([left[n] for n in lengths]) < 2
    at = np.where(same & single, at - 1, at)
    ok = at >= 0
    if not ok.any():
        return None
    total = np.where(ok, a + a[np.maximum(at, 0)], -1)
    i = int(total.argmax())
    return (int(a[i]), int(a[at[i]])) if total[i] <= room else None


def slots(bins: list[tuple[list[int], int]]) -> dict[str, np.ndarray]:
    """For each length and rank range, where its pieces go; sorted by (length, first rank)."""
    rows, seen, base = [], {}, 0
    for items, times in bins:
        at = 0
        for n in sorted(set(items), reverse=True):
            m = items.count(n)
            rows.append((n, seen.get(n, 0), m, base, at))
            seen[n] = seen.get(n, 0) + m * times
            at += m * n
        base += times
    rows.sort()
    cols = np.asarray(rows, np.int64).reshape(-1, 5).T
    return {k: np.ascontiguousarray(v) for k, v in zip(("length", "first", "per_bin", "base", "at"), cols, strict=True)}


def place(length: Column, rank: Column, table: dict[str, np.ndarray]) -> Column:
    """(sequence_id, offset) of the piece with this length and rank."""
    keys = table["length"] * (1 << 44) + table["first"]

    @F.arrow_udf("sequence_id long, offset long")
    def find(lengths: pa.Array, ranks: pa.Array) -> pa.Array:
        n, r = lengths.to_numpy(zero_copy_only=False), ranks.to_numpy(zero_copy_only=False)
        at = np.searchsorted(keys, n * (1 << 44) + r, "right") - 1
        j, m = r - table["first"][at], table["per_bin"][at]
        return pa.StructArray.from_arrays([pa.array(table["base"][at] + j // m),
                                           pa.array(table["at"][at] + j % m * n)], ["sequence_id", "offset"])

    return find(length, rank)


def pack(docs: DataFrame, path: str, max_len: int = 2048, end_id: int = 0, cache: int = CACHE_CHUNKS) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece.

    Join ``token_ids`` on doc_id and slice by start and length for the sequences' ids.
    ``cache``: chunks that each Python worker keeps (see ``ChunkEncoder``); no result depends on it.
    """
    cut = stage(docs.select("doc_id", F.explode(pieces(F.col("text"), path, max_len, end_id, cache)).alias("p"))
                .select("doc_id", "p.*"), "pieces")
    counts = {r[0]: r[1] for r in cut.groupBy("length").count().collect()}  # at most max_len rows
    table = slots(best_two_fit(counts, max_len))
    shards = F.create_map(*[F.lit(x) for n, c in sorted(counts.items())
                            for x in (n, -(-c // ROWS_PER_SHARD))]) if counts else F.create_map().cast("map<bigint,int>")
    cut = cut.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"),
                                         F.coalesce(shards[F.col("length")], F.lit(1)).cast("long")))
    # rank = pieces of this length in earlier shards + place within the shard
    firsts = (cut.groupBy("length", "shard").count()
              .withColumn("first", F.sum("count").over(
                  Window.partitionBy("length").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)))
              .select("length", "shard", F.coalesce("first", F.lit(0)).cast("long").alias("first")))
    within = F.row_number().over(Window.partitionBy("length", "shard").orderBy("doc_id", "piece", "ids_crc32"))
    ranked = (cut.withColumn("within", within - 1).join(firsts, ["length", "shard"])
              .withColumn("slot", place(F.col("length"), F.col("first") + F.col("within"), table)))
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "slot.sequence_id", "slot.offset")
