import pytest

DOCS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text[, source]); other columns are filled."""

    def build(rows: list[tuple]):
        full = [
            (r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows
        ]
        return spark.createDataFrame(full, DOCS)

    return build


@pytest.fixture
def clashing(docs):
    """The same documents with columns whose names the operators might use, or differ in case only."""
    from pyspark.sql import functions as F

    names = [
        "TEXT", "keep_id", "kept", "size", "fp", "score", "run", "number", "digest", "_c0", "_id", "_row", "a.b",
        "copies", "DOC_ID", "component_id", "held_out", "words",
    ]

    def build(rows: list[tuple]):
        df = docs(rows)
        return df.select("*", *[F.lit(i).alias(n) for i, n in enumerate(names)])

    return build
