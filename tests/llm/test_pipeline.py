"""Queries and stages over odd tables: nothing crashes, columns stay, decisions take effect."""
from collections import Counter

import pytest

import corpus_pipeline
from tests.llm.conftest import EXTRA, SF, by_id
from tillwork.llm import bpe, langid, licenses, lines, lm, mixing, quality, queries, sharding, simhash

OPERATORS = {
    "mix": mixing.mix, "quality": quality.assess, "licenses": lambda d: licenses.digest(licenses.scan(d)),
    "lines": lambda d: lines.digest(lines.dedup(d)), "bpe": bpe.tokenize, "lm": lm.score, "shards": sharding.place,
    "simhash": simhash.classes, "languages": langid.identify,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_operators_take_any_table(name, odd, odd_wide, none):
    op = OPERATORS[name]
    found = op(odd_wide)
    assert Counter(r["doc_id"] for r in found.collect()) == Counter(r["doc_id"] for r in odd.collect())
    empty = op(none)
    assert empty.count() == 0 and empty.columns == found.columns


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_take_any_table(name, stage, spark, odd_wide, none):
    docs = odd_wide
    found = stage(spark, docs, SF)
    if stage is not corpus_pipeline.STAGES[-1][1]:
        assert found.columns == docs.columns
        assert {r["doc_id"] for r in found.collect()} <= {r["doc_id"] for r in docs.collect()}
        assert all(r[c] == "x" for r in found.collect() for c in EXTRA)
    assert stage(spark, none, SF).count() == 0


def test_stage_decisions(spark, odd, documents):
    kept = {r["doc_id"] for r in corpus_pipeline.language_id(spark, odd, SF).collect()}
    assert not kept & {100, 101, 104, 105} and {0, 1, 2, 102, 103} <= kept
    one = [r["doc_id"] for r in corpus_pipeline.near_dedup(spark, odd, SF).collect()]
    assert one.count(200) == 1 and 201 not in one
    classes = {r["doc_id"]: r["component_id"] for r in simhash.classes(documents).collect()}
    kept = sorted(r["doc_id"] for r in corpus_pipeline.near_dedup(spark, documents, SF).collect())
    assert kept == sorted(set(classes.values()))
    takes = {r["doc_id"]: (r["taken"], r["size"]) for r in mixing.mix(documents).collect()}
    times = Counter(r["doc_id"] for r in corpus_pipeline.source_mix(spark, documents, SF).collect())
    assert all(abs(times[d] - taken / size) <= 0.5 for d, (taken, size) in takes.items() if size)


def test_pipeline_runs(spark, documents):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() > 100
    assert by_id(corpus_pipeline.run(spark, SF), *out.columns) == by_id(out, *out.columns)


def test_names():
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{i}" for i in range(1, 14)]


def test_sql_of_shards(spark, documents):
    import duckdb
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = db.execute(queries.ORACLE["op8_hash_tree"])
    names = [c[0] for c in want.description]
    assert sorted(map(tuple, want.fetchall())) == sorted(map(tuple, sharding.place(documents).select(*names).collect()))
