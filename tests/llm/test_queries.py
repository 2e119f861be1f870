"""Registered queries against SQL, what they run in, and the pipeline against brute force of its stages."""

import re
from pathlib import Path

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from checks import compare
from cohortia.llm.queries import REGISTRY
from test_minhash import brute as brute_groups
from test_packing import check as check_pieces
from test_quality_mixing import measured
from test_substrings import brute_words

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables are not here")
NATIVE = ["op1_", "op2_", "op4_", "op9_"]


@pytest.mark.parametrize("name", sorted(n for n, (_, sql) in REGISTRY.items() if sql))
def test_query_equals_sql(spark, name):
    run, sql = REGISTRY[name]
    _, problem = compare.compare_frame(run(spark, SF), compare.engine(SF), sql)
    assert problem is None, problem


@pytest.mark.parametrize("name", sorted(n for n in REGISTRY if n.startswith(tuple(NATIVE))))
def test_native_queries_run_no_python(spark, name):
    text = REGISTRY[name][0](spark, SF)._jdf.queryExecution().toString()
    assert not re.search("BatchEvalPython|ArrowEvalPython|MapInArrow|MapInPandas|FlatMap|CartesianProduct|NestedLoopJoin", text)


def test_every_operator_and_the_pipeline_are_registered():
    names = set(entry.queries())
    assert {f"op{n}_" for n in range(1, 14)} <= {re.match(r"op\d+_|", n)[0] for n in names}
    assert "pipeline" in names


def test_licence_lines_of_documents_are_found(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    pattern = r"licensed under (the (GNU|Apache)|CC )|under the MIT License"
    lines = {(d.doc_id, k) for d in docs for k, line in enumerate(d.text.split("\n")) if re.search(pattern, line, re.I)}
    got = REGISTRY["op2_license_scan"][0](spark, SF).collect()
    assert {(r.doc_id, r.paragraph) for r in got if r.confirmed} == lines


def fails(text):
    n, chars, symbols, dups, again, letters, stutters = measured(text)
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        n < 10 or 100 * again > 20 * n or 10 * symbols > n or 100 * dups > 40 * len(lines) or 100 * letters < 55 * n
        or 100 * stutters > 30 * n or chars > 20 * n
    )


def test_pipeline_stage_by_stage(spark, folder):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    frames, columns = [docs], docs.columns
    for name, stage in corpus_pipeline.STAGES:
        path = f"{folder}/{name.replace(' ', '-')}"
        stage(spark, frames[-1], SF).write.parquet(path)
        frames.append(spark.read.parquet(path))
    assert all(f.columns == columns for f in frames[1:-1])
    given, judged, unique, cut, mixed, pieces = [f.collect() for f in frames]

    assert {r.doc_id for r in judged} == {r.doc_id for r in given if not fails(r.text)}
    groups = brute_groups([(r.doc_id, r.text) for r in judged], 5, 80)
    assert sorted(r.doc_id for r in unique) == sorted(i for i, _, least in groups if i == least)
    words = lambda text: " ".join(re.findall(r"[^\x20\x09-\x0D]+", text))
    without = {i: kept for i, _, _, kept in brute_words([(r.doc_id, r.text) for r in unique])}
    before = {r.doc_id: r for r in unique}
    for r in cut:
        assert words(r.text) == without[r.doc_id] and r.n_chars == len(r.text) and r.source == before[r.doc_id].source
        if without[r.doc_id] == words(before[r.doc_id].text):
            assert r.text == before[r.doc_id].text
    texts = {r.doc_id: r.text for r in cut}
    assert len(cut) == len(unique) and all(r.text == texts[r.doc_id] for r in mixed)
    assert max(map([r.doc_id for r in mixed].count, texts)) <= 2

    import public_tokenizers
    from tokenizers import Tokenizer

    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    from cohortia.llm import packing

    whole = packing.pack(frames[-2], public_tokenizers.path("byte_bpe_50k.tiktoken")).collect()
    check_pieces([(r.doc_id, r.text) for r in mixed], whole, reference)
    key = lambda r: (r.doc_id, r.start, r.length, r.doc_tokens)
    assert sorted(map(key, whole)) == sorted(map(key, pieces))


def test_pipeline_of_no_documents(spark, folder):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("1 = 0")
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0
