"""From raw documents to packed training sequences.

STAGES are (name, function) pairs; a function takes (spark, docs, sf_dir) and
returns the next stage's documents (the last one: packed pieces). ``run`` writes
each stage's result as Parquet under the shared checkpoint folder and reads it
back, so a lost executor repeats a part of one stage at most.

1. toxicity: documents that the counterfactual-regularised classifier scores at
   0.3 or more go; it learns from the same labels as op6.
2. line_dedup: later copies of repeated line runs of 50 words or more are
   deleted; documents of which nothing is left go.
3. near_dedup: one document of each class of near duplicates stays.
4. mixing: each document is written as often as the mix takes it whole (never,
   once or twice); a part taken of it is a copy that ends after that many words.
   The mix takes each source's target, reached in equal blocks.
5. packing: the documents, copies included, become sequences of 2048 tokens.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nestlift.llm import toxicity
from nestlift.llm.common import fold, read, scratch
from nestlift.llm.line_dedup import dedup_lines
from nestlift.llm.mixing import write_mix
from nestlift.llm.near_dedup import drop_near_duplicates
from nestlift.llm.packing import pack
from nestlift.session import delete_path, scratch_path

# the executors' heaps are full from the stages before: the packing's workers keep fewer chunks
PACKING_CACHE = 60_000


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"), fold(F.col("doc_id"), 4) != 2)
    return toxicity.drop_toxic(docs, model)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return dedup_lines(docs, drop_emptied=True)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return write_mix(docs, parts=True)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), cache=PACKING_CACHE)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# tokenisation and the classifier cannot be said in SQL; tests/llm holds each stage against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Each stage's scratch and input go once its result is written."""
    docs, before = read(spark, sf_dir, "documents"), None
    for name, step in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        with scratch(spark):
            step(spark, docs, sf_dir).write.parquet(path)
        if before:
            delete_path(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
