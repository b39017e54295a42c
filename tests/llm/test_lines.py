import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.compare import plan_text
from tillwright.llm import common, lines

LONG = "This line is long enough to count."
ODD = [
    (1, f"{LONG}\none\n{LONG}"), (2, f"  {LONG.upper()}\t\ntwo\n"), (3, f"{LONG}\n\nthree"), (4, None), (5, ""),
    (6, "short\nshort"), (7, "short"), (8, "short"), (None, f"null\n{LONG}"), (None, f"null\n{LONG}"),
    (9, "x" * 300_000 + "\n" + "äÖ" * 10 + "\n" + "é" * 19), (10, "ÄÖ" * 10 + "\n" + "é" * 19),
    (11, "äÖ" * 10 + "\r\n" + "é" * 19), (12, "\x0bäÖ" * 10 + "\n" + "é" * 19), (13, "\x0b" + "äÖ" * 10),
    (3, "again\n" + LONG), (3, "again\n" + LONG), (14, "\n\n"), (15, "y" * 20), (15, "y" * 20), (15, "y" * 20),
]


def plain_key(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))


def plain(rows, least_chars=20, least_docs=3):
    """(doc_id, kept text, lines, dropped) by brute force."""
    holders = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(plain_key(line)) >= least_chars:
                holders[plain_key(line)].add(doc_id)
    out = []
    for doc_id, text in rows:
        parts = (text or "").split("\n")
        kept = []
        for line in parts:
            found = holders[plain_key(line)]
            best = max((i for i in found if i is not None), default=None)
            if len(found) < least_docs or doc_id == best:
                kept.append(line)
        out.append((doc_id, "\n".join(kept), len(parts), len(parts) - len(kept)))
    return out


def expected(rows, **options):
    return sorted(
        ((i, n, gone, hashlib.sha256(t.encode()).hexdigest()) for i, t, n, gone in plain(rows, **options)), key=str
    )


def found(df):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in df.collect()), key=str)


def test_against_brute_force(docs):
    assert any(gone for *_, gone in plain(ODD))
    assert found(lines.line_counts(docs(ODD))) == expected(ODD)


@pytest.mark.parametrize("least_chars, least_docs", [(0, 1), (0, 2), (1, 2), (5, 3), (20, 4)])
def test_other_thresholds(docs, least_chars, least_docs):
    rows = [r for r in ODD if r[0] != 9]
    options = {"least_chars": least_chars, "least_docs": least_docs}
    assert found(lines.line_counts(docs(rows), **options)) == expected(rows, **options)


def test_random_tables(docs):
    dice = random.Random(5)
    pool = [f"{c * 12} {i} {'tail' * (i % 4)}" for i, c in enumerate("abcdefghijklmnop")]
    rows = [
        (dice.choice([None, *range(60)]), "\n".join(dice.choices(pool, k=dice.randint(0, 12)))) for _ in range(150)
    ]
    assert found(lines.line_counts(docs(rows).repartition(5))) == expected(rows)


def test_texts_and_other_columns(clashing):
    df = clashing(ODD)
    cleaned = lines.drop_lines(df)
    assert cleaned.columns == df.columns
    got = sorted(((r[0], r[1]) for r in cleaned.collect()), key=str)
    assert got == sorted(((i, t) for i, t, *_ in plain(ODD)), key=str)
    assert found(lines.line_counts(df)) == expected(ODD)


def test_empty_table(docs):
    assert lines.line_counts(docs([])).collect() == []
    assert lines.drop_lines(docs([])).collect() == []


def test_dropping_many_lines_of_a_long_text_is_linear(docs):
    shared = [f"a line that many documents share, number {i}" for i in range(20_000)]
    own = [f"a line of its own, number {i}, and no other" for i in range(20_000)]
    mixed = "\n".join(x for pair in zip(shared, own) for x in pair)
    rows = [(1, mixed), (2, "\n".join(shared)), (3, "\n".join(shared))]
    got = {r.doc_id: r.text for r in lines.drop_lines(docs(rows)).collect()}
    assert got == {1: "\n".join(own), 2: "", 3: rows[2][1]}


def test_hot_lines_and_repeated_rows_are_spread(spark, docs, monkeypatch):
    """A third of the lines are one line, a third of the rows are one row without an id."""
    rows = [(i, f"{LONG}\nown line of document number {i}") for i in range(1500)] + [(None, f"{LONG}\nb")] * 1500
    df = docs(rows).repartition(4)
    assert found(lines.line_counts(df)) == expected(rows)
    hashed = lines.line_hashes(df, 20)
    counts = hashed.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_rows"))
    heavy = common.heavy_keys(counts, hashed.count())
    assert heavy.count() == 1
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        met = common.spread_join(hashed, counts.drop("n_rows"), ["h1", "h2"], heavy, "inner")
        sizes = [r["count"] for r in met.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == hashed.count()
    assert max(sizes) < 0.5 * sum(sizes)


def test_no_python_in_the_plan(docs):
    assert not re.search("Python|Pandas|Arrow", plan_text(lines.line_counts(docs(ODD))))
