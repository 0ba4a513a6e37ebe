"""Token counts without token ids: heap-and-linked-list byte-pair merging.

A text is cut at the vocabulary's special strings (one token each); the rest is
normalised (NFC, lower case) and cut into pre-tokens. Each pre-token starts as
one symbol per UTF-8 byte (the last one marked as the word's end); adjacent
pairs wait in a heap by merge rank, and the lowest is merged in a linked list
until none is left. The count is the initial symbols minus the merges.

A word's count does not depend on its neighbours, so each Python worker keeps
the counts it has seen in a dictionary of bounded size (cleared when full; that
changes speed only).
"""

from __future__ import annotations

import heapq
import json
import unicodedata

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestlift.llm.common import each, worker_cache

CACHE_WORDS = 300_000
# white space as the vocabulary's patterns see it (str.split also cuts at \x1c-\x1f)
_SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
_SEPARATORS = ("\x1c", "\x1d", "\x1e", "\x1f")


def byte_symbols() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte.

    Bytes that are printable Latin-1 stand for themselves; the others take the
    code points from 256 on, in byte order.
    """
    out, extra = [], 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            out.append(chr(b))
        else:
            out.append(chr(extra))
            extra += 1
    return out


class MergeCounter:
    """Counts tokens as the vocabulary file at ``path`` gives them."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, vocab = spec["model"], spec["model"]["vocab"]
        suffix = model.get("end_of_word_suffix") or ""
        symbols = byte_symbols()
        self.inner = [vocab[s] for s in symbols]
        self.last = [vocab[s + suffix] for s in symbols]
        # (left, right) -> rank and merged symbol, each packed into one integer
        self.merges: dict[int, int] = {}
        for rank, (a, b) in enumerate(model["merges"]):
            merged = a[: len(a) - len(suffix)] + b if suffix and a.endswith(suffix) else a + b
            self.merges.setdefault(vocab[a] << 20 | vocab[b], rank << 20 | vocab[merged])
        steps = spec["pre_tokenizer"]["pretokenizers"]
        pattern = next(s["pattern"]["Regex"] for s in steps if s["type"] == "Split")
        self.pre = regex.compile(pattern.replace(r"\s", _SPACE))
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.first = {s[0] for s in special}
        self.spaces = regex.compile(f"[{_SPACE}]+")
        self.words: dict[str, int] = {}
        self.chunks = _Chunks(self)

    def symbols_left(self, word: bytes) -> int:
        """Symbols of one pre-token after all merges."""
        n = len(word)
        if n < 2:
            return n
        sym = [self.inner[b] for b in word]
        sym[-1] = self.last[word[-1]]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pair = self.merges.get
        heap = []
        for i in range(n - 1):
            m = pair(sym[i] << 20 | sym[i + 1])
            if m is not None:
                heap.append((m >> 20) << 32 | i)
        heapq.heapify(heap)
        left = n
        while heap:
            top = heapq.heappop(heap)
            i = top & 0xFFFFFFFF
            j = after[i]
            if sym[i] < 0 or j >= n:
                continue
            m = pair(sym[i] << 20 | sym[j])
            if m is None or m >> 20 != top >> 32:
                continue  # the pair that waited here is gone
            sym[i], sym[j] = m & 0xFFFFF, -1
            left -= 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                m = pair(sym[i] << 20 | sym[k])
                if m is not None:
                    heapq.heappush(heap, (m >> 20) << 32 | i)
            h = before[i]
            if h >= 0:
                m = pair(sym[h] << 20 | sym[i])
                if m is not None:
                    heapq.heappush(heap, (m >> 20) << 32 | h)
        return left

    def chunk(self, chunk: str) -> int:
        """Tokens of a run of characters without white space or special strings."""
        if not chunk.isascii():
            # lower case goes letter by letter: no final-sigma rule
            chunk = unicodedata.normalize("NFC", chunk).replace("Σ", "σ")
        total, words = 0, self.words
        for w in self.pre.findall(chunk.lower()):
            n = words.get(w)
            if n is None:
                n = self.symbols_left(w.encode("utf-8"))
                if len(words) >= CACHE_WORDS:
                    words.clear()
                if len(w) <= 64:
                    words[w] = n
            total += n
        return total

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if self.special and any(c in text for c in self.first) and self.special.search(text):
            parts = self.special.split(text)
            return len(parts) - 1 + sum(self.count(p) for p in parts)
        if any(c in text for c in _SEPARATORS):
            words = self.spaces.split(text)
        else:
            words = text.split()
        return sum(map(self.chunks.__getitem__, words))


class _Chunks(dict):
    def __init__(self, counter: MergeCounter):
        super().__init__()
        self.counter = counter

    def __missing__(self, chunk: str) -> int:
        n = self.counter.chunk(chunk)
        if len(self) >= CACHE_WORDS:
            self.clear()
        if len(chunk) <= 64:
            self[chunk] = n
        return n


def _counter(path: str) -> MergeCounter:
    return worker_cache(("token_count", path), lambda: MergeCounter(path))


def token_count(text: Column, path: str) -> Column:
    """Tokens of ``text`` under the vocabulary at ``path`` (a file every worker can read).

    NULL and empty texts have 0 tokens. No begin, end or padding tokens; special
    strings inside a text count as one token each.
    """
    @F.arrow_udf("long")
    def count(texts: pa.Array) -> pa.Array:
        c = _counter(path)
        return pa.array([c.count(t) for t in each(texts)], pa.int64())

    return count(text)


def count_tokens(docs: DataFrame, path: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens) per document.

    Every input row gives a row, repeated and NULL ids included; no shuffle.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    return (docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"),
                        token_count(text, path).alias("n_tokens"))
            .withColumn("over_limit", F.col("n_tokens") > limit))
