from pyspark.sql import functions as F

from tillwright.llm import common, quality, toxicity

LABELS = "doc_id BIGINT, quality INT, toxic INT"


def sample(spark, docs, rows, labels, most_rows=100, most_bytes=10_000, out="false"):
    found = common.labelled_sample(
        docs(rows), spark.createDataFrame(labels, LABELS), "toxic", F.expr(out), most_rows, most_bytes
    )
    return sorted((r.doc_id, r.text, r.label) for r in found.collect())


def test_one_text_of_each_labelled_id(spark, docs):
    rows = [(1, "a"), (1, "a"), (1, "b"), (2, None), (None, "x"), (3, "c"), (4, "d"), (5, "held")]
    labels = [(1, 1, 0), (1, 1, 1), (2, 1, 0), (None, 1, 1), (3, 1, None), (9, 1, 1), (5, 1, 1)]
    found = sample(spark, docs, rows, labels, out="doc_id = 5")
    assert [(i, label) for i, _, label in found] == [(1, 1), (2, 0)]
    assert found[0][1] in "ab" and found[1][1] == ""
    assert found == sample(spark, docs, rows[::-1], labels[::-1], out="doc_id = 5")
    assert sample(spark, docs, [], labels) == sample(spark, docs, rows, []) == []


def test_an_id_on_very_many_rows_is_one_text(spark, docs):
    """20,000 rows of one labelled id, and long texts: rows and bytes stay bounded."""
    rows = docs([(1, "hot")]).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(20_000)))).drop("n")
    rows = rows.withColumn("text", F.concat("text", F.rand(1).cast("string"))).repartition(4)
    long = docs([(i, "word " * 1_000_000) for i in (2, 3)] + [(i, f"short {i}") for i in range(4, 60)])
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(1, 60)], LABELS)
    found = common.labelled_sample(rows.union(long), labels, "toxic", F.lit(False), 40, 1 << 20)
    got = found.collect()
    assert len(got) <= 40 and len({r.doc_id for r in got}) == len(got)
    assert sum(len(r.text) for r in got) <= 1 << 20
    assert not {2, 3} & {r.doc_id for r in got}
    for train in (toxicity.train, lambda *a, **k: quality.train(*a, epochs=1, **k)):
        train(rows.union(long), labels, train_rows=40, train_bytes=1 << 16)
