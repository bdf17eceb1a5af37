import hashlib
import re

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from marginfold.llm import pii, simhash
from marginfold.llm.byte_bpe import encoding
from marginfold.sources.scratch import written
from test_decontaminate import brute as brute_hits
from test_simhash import brute_components, brute_fingerprint

PHRASE = "seven quick tests of a planted benchmark phrase in the texts"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.where("doc_id < 70").collect()
    extra = [
        (1000, f"Before it {PHRASE} and after it more words.", "en", "x", 1), (1001, "Card 4539578763621486 here", "en", "x", 1),
        (1002, None, "en", "x", 1), (1003, "12345 !!", None, "x", 1), (1004, "", "de", None, None),
        (1005, rows[3]["text"], "en", "x", 1), (1006, rows[3]["text"] + "\n", "en", "x", 1), (rows[4]["doc_id"], rows[4]["text"], "en", "x", 1),
    ]
    spark.createDataFrame([tuple(r) for r in rows] + extra, docs.schema).coalesce(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, PHRASE), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def _pseudonymised(spark, texts):
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    return {r["doc_id"]: r["text"] for r in pii.pseudonymise(frame).collect()}


def test_stages(spark, folder):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "simhash", "decontamination", "pii", "byte_bpe"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, stages = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, folder))
        stages[name] = docs
        assert name == "byte_bpe" or docs.columns == columns
    texts = {name: [(r["doc_id"], r["text"]) for r in frame.collect()] for name, frame in stages.items() if name != "byte_bpe"}

    ids = {i for i, _ in texts["language_id"]}
    assert not ids & {1002, 1003, 1004} and len(ids) >= 70

    prints = {brute_fingerprint(t) for _, t in texts["language_id"]}
    roots = brute_components(prints)
    least = {}
    for i, t in texts["language_id"]:
        root = roots[brute_fingerprint(t)]
        least[root] = min(i, least.get(root, i))
    assert sorted(i for i, _ in texts["simhash"]) == sorted(least.values())

    clean = [i for i, *_, hit in brute_hits(texts["simhash"], [(1, PHRASE)]) if not hit]
    assert sorted(i for i, _ in texts["decontamination"]) == sorted(clean) and 1000 not in clean

    before, after = dict(texts["decontamination"]), dict(texts["pii"])
    assert after == _pseudonymised(spark, before)
    # The values themselves are held against brute force in the tests of that operator.
    assert after[1001] != before[1001] and re.fullmatch(r"Card \d{16} here", after[1001])
    assert all(r["n_chars"] == len(r["text"]) for r in stages["pii"].collect())

    encoder = encoding(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    expected = {
        (i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
        for i, t in after.items()
        for ids in [encoder.encode_ordinary(t)]
    }
    assert {tuple(r) for r in stages["byte_bpe"].collect()} == expected


def test_run_and_empty_table(spark, folder, tmp_path):
    assert corpus_pipeline.run(spark, folder).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_near_dedup_merges_the_exploded_index(spark, tmp_path, monkeypatch):
    plans = []

    def kept(frame, *args):
        plans.append(frame._jdf.queryExecution().sparkPlan().toString())
        return written(frame, *args)

    monkeypatch.setattr(simhash, "written", kept)
    spark.range(20).selectExpr("id AS doc_id", "concat('a b c d ', id) AS text").write.parquet(f"{tmp_path}/docs")
    corpus_pipeline.near_duplicate_stage(spark, spark.read.parquet(f"{tmp_path}/docs"), "")
    joined = [line for plan in plans for line in plan.splitlines() if "Join" in line and "bit_count" in line]
    assert joined and all("SortMergeJoin" in line for line in joined)
