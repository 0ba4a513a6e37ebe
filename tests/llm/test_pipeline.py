from collections import Counter

import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from nestlift.llm.near_dedup import bag, similarity, words_of

SF = "/root/testdata/sf0.001"


def test_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries() and [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line_dedup", "near_dedup", "mixing", "packing"]


def test_stages_keep_columns_and_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, step in corpus_pipeline.STAGES:
        out = step(spark, docs, SF)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen[name] = docs.collect()
        assert name == "packing" or docs.columns == columns
    ids = {name: {r.doc_id for r in rows} for name, rows in seen.items()}
    assert ids["packing"] == ids["mixing"] <= ids["near_dedup"] <= ids["line_dedup"] <= ids["toxicity"]
    assert all(r.n_chars == len(r.text) for r in seen["line_dedup"])
    bags = [bag(words_of(r.text)) for r in seen["near_dedup"]]
    assert all(similarity(bags[i], bags[j]) < .8 for i in range(len(bags)) for j in range(i))
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokens = Counter()
    for r in seen["mixing"]:
        tokens[r.doc_id] += len(tok.encode(r.text, add_special_tokens=False).ids) + 1
    packed = Counter()
    for r in seen["packing"]:
        packed[r.doc_id] += r.length
    assert packed == tokens


def test_run_leaves_only_its_result(spark):
    import glob

    from nestlift.session import shared_dir

    root = shared_dir(spark).removeprefix("file:") + "/nestlift"
    before = set(glob.glob(f"{root}/*/*"))
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and out.columns[:2] == ["doc_id", "piece"]
    assert [p.split("/")[-2] for p in set(glob.glob(f"{root}/*/*")) - before] == ["pipeline-packing"]


def small_tables(spark, folder, rows):
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG, _k1 STRING, _cut STRING")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (2, 0, 0), (None, 1, 1)], "doc_id LONG, quality INT, toxic INT").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def test_null_and_empty_rows_go_through_all_stages(spark, tmp_path):
    run = " ".join(f"w{i}" for i in range(60))
    rows = [(1, "clean words " * 20, "en", "a", 240, "k", "c"), (2, "some other words " * 10, None, None, None, None, None),
            (None, None, None, None, None, None, None), (None, None, None, None, None, None, None), (3, "", "en", "a", 0, "k", "c"),
            (None, "no id " * 30, "en", "b", 180, "k", "c"), (4, run, "en", "b", 200, "k", "c"), (5, "own line\n" + run, "de", "b", 9, "k", "c")]
    sf_dir = small_tables(spark, tmp_path, rows)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, docs, sf_dir)
        assert out.columns == docs.columns
        out.write.parquet(f"{sf_dir}/{name}")
        docs = spark.read.parquet(f"{sf_dir}/{name}")
        got = docs.collect()
        assert {1, 2, 4, None} <= {r.doc_id for r in got}, name
        assert all(r._k1 in (None, "k") and r._cut in (None, "c") for r in got)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in got} and sum(r.length for r in packed) > 0


def test_empty_table_goes_through_all_stages(spark, tmp_path):
    assert corpus_pipeline.run(spark, small_tables(spark, tmp_path, [])).count() == 0
