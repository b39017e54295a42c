import re

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from tests.compare import connect, difference
from tillwright.llm import common, decontamination, exact, queries, simhash, toxicity
from tillwright.llm.common import read_table, written

QUERIES = queries.queries()


def test_all_are_registered():
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_equals_sql(spark, folder, name):
    assert difference(QUERIES[name](spark, folder), connect(folder), queries.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", ["op1_toxicity", "op4_token_counts", "op7_quality", "op8_simhash", "op12_line_dedup"])
def test_one_row_per_document(spark, folder, name):
    found = [r.doc_id for r in QUERIES[name](spark, folder).collect()]
    assert sorted(found) == sorted(r.doc_id for r in read_table(spark, folder, "documents").collect())


def test_pipeline_sends_no_keys_of_fingerprints_through_the_driver(spark, docs, monkeypatch):
    """A fingerprint has 35 keys, but Spark sizes their table as that of the fingerprints."""
    plans = {}

    def noted(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return written(df, name)

    monkeypatch.setattr(common, "written", noted)
    rows = [(i, f"some words of text number {i // 2} and more of them") for i in range(40)]
    assert corpus_pipeline.drop_near_copies(spark, docs(rows), "").count() <= 20
    assert "SortMergeJoin" in plans["shared-keys"] and "BroadcastExchange" not in plans["shared-keys"]


def test_pipeline_against_its_operators_rules(spark, folder):
    from tests.llm.test_decontamination import plain as leaks
    from tests.llm.test_simhash import plain_components, plain_print

    docs = read_table(spark, folder, "documents")
    model = toxicity.train(docs, read_table(spark, folder, "labels"))
    left = [r for r in docs.collect() if model.score(r.text) < 0.5]
    seen, kept = set(), []
    for r in sorted(left, key=lambda r: r.doc_id):
        text = re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "")
        if text not in seen:
            seen.add(text)
            kept.append(r)
    groups = plain_components({r.doc_id: plain_print(r.text) for r in kept}, 4)
    kept = [r for r in kept if groups[r.doc_id] == r.doc_id]
    items = [tuple(r) for r in read_table(spark, folder, "benchmark").select("item_id", "text").collect()]
    bad = {d for d, _ in leaks([(r.doc_id, r.text) for r in kept], items)}
    kept = {r.doc_id for r in kept} - bad
    rows = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = written(stage(spark, rows, folder), name)
        assert rows.columns == docs.columns
    assert {r.doc_id for r in rows.collect()} == kept
    mixed = corpus_pipeline.run(spark, folder)
    assert {r.doc_id for r in mixed.collect()} <= kept
    assert set(docs.columns) <= set(mixed.columns)
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "exact_dedup", "simhash_dedup", "decontamination", "mixing"
    ]
    assert exact and simhash and decontamination
