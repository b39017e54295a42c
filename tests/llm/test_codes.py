import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tillwright.llm import codes

VECTORS = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT"


def plain(rows, parts=4, entries=256, rounds=4, scale=1024):
    """(vec_id, code, error, label_error, digest) by plain rounds in integers."""
    kept = []
    for vec_id, vector, label in rows:
        if vector and all(x is not None and np.isfinite(x) for x in vector):
            kept.append((vec_id, [int(np.floor(np.float64(np.float32(x)) * scale)) for x in vector], label))
    if not kept:
        return []
    x = np.array([k[1] for k in kept], np.int64).reshape(len(kept), parts, -1)
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, kept[i][1]))[:entries]
    books = [x[order, p] for p in range(parts)]

    def nearest(p):
        return ((x[:, p, None] - books[p][None]) ** 2).sum(axis=2).argmin(axis=1)

    for _ in range(rounds):
        for p in range(parts):
            own = nearest(p)
            books[p] = np.array([
                x[own == e, p].sum(axis=0) // (own == e).sum() if (own == e).any() else books[p][e]
                for e in range(len(books[p]))
            ])
    own = np.array([nearest(p) for p in range(parts)]).T
    errors = sum(((x[:, p] - books[p][own[:, p]]) ** 2).sum(axis=1) for p in range(parts))
    totals = {}
    for (_, _, label), e in zip(kept, errors):
        totals[label] = totals.get(label, 0) + int(e)
    digest = hashlib.sha256(",".join(str(v) for b in books for v in b.reshape(-1)).encode()).hexdigest()
    return sorted(
        ((k[0], "".join(f"{c:02x}" for c in o), int(e), totals[k[2]], digest) for k, o, e in zip(kept, own, errors)),
        key=str,
    )


def found(df):
    return sorted(
        ((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in df.collect()), key=str
    )


def clustered(n, dim=8, seed=3):
    dice = np.random.default_rng(seed)
    centres = dice.normal(size=(12, dim))
    return [
        (i, (centres[i % 12] + 0.05 * dice.normal(size=dim)).astype(np.float32).tolist(), i % 5 or None)
        for i in range(n)
    ]


@pytest.mark.parametrize("n, entries, listed", [(300, 256, 16), (300, 8, 3), (300, 8, 1), (5, 256, 16), (1, 4, 2)])
def test_against_plain_rounds(spark, n, entries, listed):
    rows = clustered(n)
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    assert found(codes.vector_codes(df, entries=entries, listed=listed)) == plain(rows, entries=entries)


def test_odd_rows(spark):
    good = clustered(40)
    nan, inf = float("nan"), float("inf")
    odd = [
        (100, None, 1), (101, [None] + good[0][1][1:], 1), (102, [nan] * 8, 1), (103, [inf] + good[0][1][1:], None),
        (104, [], 2), (0, good[0][1], 7), (0, good[0][1], 7), (None, good[3][1], 7), (None, good[4][1], None),
        (105, [-inf] * 8, 1), (106, [0.0] * 8, 1), (107, [-0.0] * 8, 1), (108, [-1e-30] * 8, 1),
    ]
    rows = good + odd
    df = spark.createDataFrame(rows, VECTORS)
    assert found(codes.vector_codes(df, entries=16)) == plain(rows, entries=16)
    # Vectors of another length are left out; huge components saturate.
    more = spark.createDataFrame([(200, [1.0] * 4, 1), (201, [1.0] * 7, 1)], VECTORS)
    assert found(codes.vector_codes(df.union(more), entries=16)) == plain(rows, entries=16)
    huge = spark.createDataFrame([(1, [3e38] * 8, 1), (2, [-3e38] * 8, 1)] * 400, VECTORS)
    assert {r.error for r in codes.vector_codes(huge, entries=2).collect()} == {0}


def test_other_columns_and_empty_tables(spark):
    from pyspark.sql import functions as F

    rows = clustered(30)
    df = spark.createDataFrame(rows, VECTORS)
    wide = df.select("*", *[F.lit(1).alias(n) for n in ("LABEL", "near", "low", "need", "ints", "n_rows", "_part")])
    assert found(codes.vector_codes(wide, entries=4)) == plain(rows, entries=4)
    empty = codes.vector_codes(df.where("false"))
    assert empty.collect() == []
    assert empty.columns == codes.vector_codes(df, entries=4).columns


def test_bounds_spare_comparisons_and_lists_shrink(spark):
    rows = clustered(3000, dim=16)
    df = spark.createDataFrame(rows, VECTORS)
    assigned, books, history = codes.refine(df, 4, 64, 4, 1024, 16)
    last = history[-1]
    # Most parts need no comparison but with their own entry, few all entries.
    assert last[0] > 0.4 * last.sum()
    assert last[-1] < 0.1 * last.sum()
    assert len(last) < len(history[0])
    assert found(codes.vector_codes(df, entries=64)) == plain(rows, entries=64)
    assert len(assigned.first().near) == 4 * codes.adapted(last, len(last) - 1)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 9), st.integers(1, 6), st.integers(0, 40))
def test_bounds_hold_after_any_moves(seed, k, b, spread):
    dice = np.random.default_rng(seed)
    b = min(b, k)
    x = dice.integers(-20, 20, (50, 3)).astype(float)
    book = dice.integers(-20, 20, (k, 3)).astype(float)
    near, low = codes.search(x, book, b)
    for _ in range(4):
        new = book + dice.integers(-spread, spread + 1, book.shape) * (dice.random((k, 1)) < 0.5)
        moved = np.sqrt(((new - book) ** 2).sum(axis=1)) * (1 + codes.ROOM)
        stored = np.nextafter(low.astype(np.float32), np.float32(-np.inf))
        near, low, need = codes.follow(x, near, stored, new, moved)
        book = new
        squared = ((x[:, None] - book[None]) ** 2).sum(axis=2)
        assert (near[:, 0] == squared.argmin(axis=1)).all()
        away = np.sqrt(squared)
        for row in range(len(x)):
            listed = near[row]
            assert len(set(listed)) == b
            assert (low[row, :b - 1] <= away[row, listed[1:]] + 1e-9).all()
            rest = np.delete(away[row], listed)
            assert (low[row, b - 1] <= rest + 1e-9).all()


def test_any_number_of_tasks_gives_the_same(spark):
    rows = clustered(200)
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, VECTORS)
    assert found(codes.vector_codes(df.repartition(1), entries=32)) == found(
        codes.vector_codes(df.repartition(7), entries=32)
    )
