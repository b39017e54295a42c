import random
import zlib

import numpy as np

from tillwright.llm import toxicity

LABELS = "doc_id BIGINT, quality INT, toxic INT"
NEUTRAL = [f"n{i}" for i in range(200)]


def corpus(seed=2, rows=600):
    """Groups are named in toxic texts far more often than in others, so that naming them looks toxic."""
    dice = random.Random(seed)
    texts, labels = [], []
    for i in range(rows):
        toxic = dice.random() < 0.4
        own = dice.choices(NEUTRAL, k=dice.randint(5, 60))
        if toxic:
            own += dice.choices(["scum", "idiots", "worthless"], k=2)
        if dice.random() < (0.8 if toxic else 0.05):
            own.append(dice.choice(["muslim", "women", "gay"]))
        dice.shuffle(own)
        texts.append((i, " ".join(own)))
        labels.append((i, 1, int(toxic)))
    return texts, labels


def test_held_out_accuracy(spark, docs):
    texts, labels = corpus()
    df = docs(texts)
    model = toxicity.train(df, spark.createDataFrame(labels, LABELS))
    found = {r.doc_id: r for r in toxicity.score(df, model).collect()}
    out = [i for i, *_ in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert {i for i, r in found.items() if r.held_out} == set(out)
    assert np.mean([found[i].predicted == labels[i][2] for i in out]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found.values())


def test_swaps_bring_the_scores_of_groups_together(spark, docs):
    texts, labels = corpus()
    df, known = docs(texts), spark.createDataFrame(labels, LABELS)
    plain = toxicity.train(df, known, counterfactual=0.0)
    model = toxicity.train(df, known, counterfactual=5.0)

    def spread(m):
        return max(
            abs(m.logit(f"n1 n2 {a}") - m.logit(f"n1 n2 {b}"))
            for a, b in (("muslim", "christian"), ("women", "men"), ("gay", "straight"))
        )

    assert spread(model) < 0.5 * spread(plain)
    assert model.score("n1 n2 n3 muslim n4") < 0.5 and model.score("n1 scum worthless n2") > 0.5


def test_swaps_stay_within_a_kind():
    assert toxicity.swaps({"a", "women"}) == [{"a", "men"}]
    assert {frozenset(s) for s in toxicity.swaps({"girl", "man"})} == {frozenset({"boy", "woman"})}
    assert len(toxicity.swaps({"hindu"})) == 5 and toxicity.swaps({"plain"}) == []


def test_odd_rows(spark, clashing):
    rows = [(1, None), (2, ""), (None, "scum"), (4, "n1 " * 40_000), (4, "n1 " * 40_000), (5, "\x00 \n")]
    df = clashing(rows)
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, None), (None, 1, 1), (4, 1, 1), (4, 1, 0), (77, 0, 1)], LABELS)
    found = toxicity.score(df, toxicity.train(df, labels)).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    assert [r.held_out for r in found if r.doc_id is None] == [False]
    model = toxicity.Model(np.zeros(toxicity.PLACES, np.float32), -1.0)
    assert toxicity.reject_toxic(df, model).columns == df.columns
    assert toxicity.reject_toxic(df, model).count() == len(rows)
    model.bias = 1.0
    assert toxicity.reject_toxic(df, model).count() == 0


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], LABELS)
    assert toxicity.score(docs([]), toxicity.train(docs([]), none)).collect() == []
    assert [r.score for r in toxicity.score(docs([(1, "a")]), toxicity.train(docs([(1, "a")]), none)).collect()] == [0.5]
