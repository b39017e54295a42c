import hashlib
import re
from collections import defaultdict

from tillwright.llm import exact

ODD = [
    (5, "a  b"), (3, "a b"), (9, "a\t\n b"), (None, "a b"), (2, None), (4, ""), (4, ""), (7, "a b"), (7, "a b"),
    (8, "a b"), (None, "only"), (None, "only"), (1, " a b"), (6, "x" * 200_000), (10, "x" * 200_000),
]


def plain(rows):
    """doc_id, keep_id, group_size, kept, digest by brute force."""
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(doc_id)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known, default=None)
        found = False
        for i in ids:
            kept = i == keep and not found
            found = found or kept
            out.append((i, keep, len(ids), kept, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_groups_against_brute_force(docs):
    assert rows_of(exact.exact_groups(docs(ODD))) == plain(ODD)


def test_any_number_of_runs_gives_the_same(docs):
    for runs, fan in ((1, 2), (3, 2), (27, 3), (64, 64)):
        assert rows_of(exact.exact_groups(docs(ODD), runs, fan)) == plain(ODD)


def test_clashing_columns(clashing):
    assert rows_of(exact.exact_groups(clashing(ODD))) == plain(ODD)
    df = clashing(ODD)
    kept = exact.deduplicate(df)
    assert kept.columns == df.columns
    assert kept.count() == sum(r[3] for r in plain(ODD))


def test_empty_table(docs):
    assert exact.exact_groups(docs([])).collect() == []
    assert exact.deduplicate(docs([])).collect() == []


def test_deduplicate_keeps_one_row_of_each(docs):
    kept = exact.deduplicate(docs(ODD + [(2, None, "other")])).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept) == [
        (False, 1), (False, 2), (False, 3), (False, 6), (False, 8), (True, 0)
    ]


def test_no_python_in_the_plan(docs):
    from tests.compare import plan_text

    assert not re.search("Python|Pandas|Arrow", plan_text(exact.exact_groups(docs(ODD))))


def test_a_hot_text_meets_few_rows_per_merge(docs):
    rows = [(i, "hot") for i in range(3000)] + [(i, f"t{i}") for i in range(3000, 6000)]
    entries = exact.digests(docs(rows).repartition(4), 64)
    first, merged = exact.merge_runs(entries, 64, 8)
    assert first.groupBy("text_sha256").count().agg({"count": "max"}).first()[0] <= 64
    assert merged.filter("group_size = 3000").select("keep_id").collect()[0][0] == 0


def test_runs_are_merged_in_sorted_order_and_verified(spark):
    import pytest
    from pyspark.errors import PySparkException

    from tests.compare import plan_text

    schema = "doc_id BIGINT, row BIGINT, run INT, text_sha256 STRING, proof STRING"
    good = spark.createDataFrame([(i, i, i % 4, f"{i % 3}", "p") for i in range(40)], schema)
    _, merged = exact.merge_runs(good, 4, 2)
    assert sorted((r.text_sha256, r.keep_id, r.group_size) for r in merged.collect()) == [("0", 0, 14), ("1", 1, 13), ("2", 2, 13)]
    plan = plan_text(merged)
    assert "HashAggregate" not in plan and plan.count("SortAggregate") >= 6 and "Python" not in plan
    bad = good.unionAll(spark.createDataFrame([(99, 99, 3, "1", "q")], schema))
    with pytest.raises(PySparkException, match="one SHA-256, different texts"):
        exact.merge_runs(bad, 4, 2)[1].collect()


def test_a_third_of_the_rows_with_null_or_repeated_ids_and_one_text(spark):
    from pyspark.sql import functions as F

    n = 30_000
    third = F.col("id") % 3
    docs = spark.range(n).select(
        F.when(third == 0, None).when(third == 1, -5).otherwise(F.col("id")).alias("doc_id"),
        F.when(third < 2, "the same").otherwise(F.concat(F.lit("text "), F.col("id"))).alias("text"),
    )
    entries = exact.digests(docs, 64).where("text_sha256 = sha2('the same', 256)")
    most = entries.groupBy("run").count().agg(F.max("count")).first()[0]
    assert most < 2 * (2 * n // 3) / 64  # spread over all runs, null ids and the repeated one alike
    found = exact.exact_groups(docs).where("group_size > 1")
    one = found.agg(F.count("*"), F.count_if("kept"), F.min("keep_id"), F.max("keep_id"), F.max("group_size")).first()
    assert tuple(one) == (2 * n // 3, 1, -5, -5, 2 * n // 3)
    assert "Window" not in found._jdf.queryExecution().optimizedPlan().toString()
