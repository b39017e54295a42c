import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillwright.llm import negatives

VECTORS = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT"


def plain(rows, every=100, scale=256, positives=5, count=10, least=30, most=90):
    kept = [
        (i, v, [int(np.floor(np.float64(np.float32(x)) * scale)) for x in v], label) for i, v, label in rows
        if i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v)
    ]
    x = np.array([k[2] for k in kept], np.int64).reshape(len(kept), -1)
    out = []
    for at, (anchor, _, _, label) in enumerate(kept):
        if anchor % every:
            continue
        scores = x @ x[at]
        order = sorted(range(len(kept)), key=lambda i: (-scores[i], kept[i][0]))
        best = [i for i in order if i != at and kept[i][3] == label][:positives]
        for p in best:
            fits = [
                i for i in order
                if kept[i][3] != label and least * scores[p] <= 100 * scores[i] <= most * scores[p]
            ][:count]
            for rank, i in enumerate(fits, 1):
                out.append((anchor, kept[p][0], rank, kept[i][0], int(scores[p]), int(scores[i])))
    return sorted(out)


def found(df):
    return sorted(
        (r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in df.collect()
    )


def clustered(n, dim=8, spread=0.2, seed=3):
    dice = np.random.default_rng(seed)
    centres = dice.normal(size=(12, dim))
    return [
        (i, (centres[i % 12] + spread * dice.normal(size=dim)).astype(np.float32).tolist(), int(dice.integers(4)))
        for i in range(n)
    ]


@pytest.mark.parametrize("n, block, chunk, every", [(900, 100, 7, 10), (900, 8192, 256, 50), (40, 3, 2, 3)])
def test_against_brute_force(spark, n, block, chunk, every):
    rows = clustered(n)
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    expected = plain(rows, every)
    assert expected
    assert found(negatives.hard_negatives(df, every=every, block=block, chunk=chunk)) == expected


def test_odd_rows(spark):
    rows = clustered(80)
    v = rows[0][1]
    odd = [
        (100, None, 1), (100, v, None), (None, v, 1), (200, [float("nan")] + v[1:], 1), (300, [None] + v[1:], 1),
        (400, [float("inf")] + v[1:], 1), (500, [], 1), (0, v, rows[0][2]), (0, v, rows[0][2]), (0, v, 9),
        (600, [0.0] * 8, 1), (700, [-x for x in v], rows[0][2]), (7, v, 8), (-100, v, 9),
    ]
    df = spark.createDataFrame(rows + odd, VECTORS)
    assert found(negatives.hard_negatives(df, block=30)) == plain(rows + odd)
    # Vectors of another length than most are left out; huge components saturate.
    more = spark.createDataFrame([(1000, [1.0] * 5, 1), (1100, [3e38] * 8, 2), (1101, [3e38] * 8, 2)], VECTORS)
    assert found(negatives.hard_negatives(df.union(more), block=30))


def test_ties_and_a_very_common_vector(spark):
    """A third of the rows hold one vector; the smallest ids of equal scores come first."""
    rows = clustered(600)
    v = rows[5][1]
    rows = [(i, v if i % 3 == 0 else w, label) for i, w, label in rows]
    df = spark.createDataFrame(rows, VECTORS).repartition(4)
    assert found(negatives.hard_negatives(df, block=64, most=100)) == plain(rows, most=100)


def test_other_columns_and_empty_tables(spark):
    rows = clustered(150)
    df = spark.createDataFrame(rows, VECTORS)
    wide = df.select("*", *[F.lit(1).alias(n) for n in ("LABEL", "row", "ints", "slot", "low", "rank", "id")])
    assert found(negatives.hard_negatives(wide)) == plain(rows)
    empty = negatives.hard_negatives(df.where("false"))
    assert empty.collect() == []
    assert empty.columns == negatives.hard_negatives(df).columns
    assert negatives.hard_negatives(df.where("vec_id % 100 != 0")).collect() == []
    assert negatives.hard_negatives(df.withColumn("label", F.lit(1))).collect() == []


def tree_of(x, most=None):
    n = np.arange(len(x))
    return negatives.Tree.build(n, n, n % 3, x, float((x ** 2).sum(axis=1).max()) if most is None else most)


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 400), st.integers(1, 6), st.sampled_from([1, 3, 30, 3000]))
def test_trees_cover_and_separate(seed, n, dim, spread):
    x = np.random.default_rng(seed).integers(-spread, spread + 1, (n, dim)).astype(float)
    tree = tree_of(x)
    assert sorted(tree.ids.tolist()) == list(range(n))
    whole = np.concatenate(
        [tree.vectors, np.sqrt(np.maximum(0, tree.most - (tree.vectors ** 2).sum(axis=1)))[:, None]], axis=1
    )
    for node in range(len(tree.center)):
        a, b = tree.start[node], tree.stop[node]
        away = np.sqrt(((whole[a:b] - whole[tree.center[node]]) ** 2).sum(axis=1))
        assert a <= tree.center[node] < b or tree.children[node] == 0
        assert (away <= tree.radius[node] + 1e-3).all()
        if tree.children[node]:
            kids = slice(tree.child[node], tree.child[node] + tree.children[node])
            assert tree.start[kids][0] == a and tree.stop[kids][-1] == b
            half = 2.0 ** np.ceil(np.log2(away.max())) / 2
            centers = whole[tree.center[kids]]
            gaps = negatives.distances(centers, centers)
            np.fill_diagonal(gaps, np.inf)
            assert (gaps > half - 1e-3).all()


def test_balls_spare_points():
    """On clustered rows the descent scores a part of the points only, and still finds the best."""
    x = np.array([r[1] for r in clustered(6000, dim=8, spread=0.02)])
    x = np.floor(x * 256)
    tree = tree_of(x)
    q = x[:20]
    big = np.iinfo(np.int64).max
    anchors = negatives.Anchors(
        np.arange(20), np.arange(20) % 3, q, np.full((20, 1), -big), np.full((20, 1), big)
    )
    got = negatives.Found(20, 1, 5)
    scored = negatives.descend(tree, anchors, got, True)
    assert scored < 0.5 * 20 * len(x)
    for i in range(20):
        scores = (x @ q[i]).astype(int)
        order = [j for j in np.lexsort((np.arange(len(x)), -scores)) if j != i and j % 3 == i % 3][:5]
        assert got.scores[i, 0].tolist() == scores[order].tolist()
        assert got.ids[i, 0].tolist() == order
