import random
import zlib

import numpy as np

from tillwright.llm import quality

LABELS = "doc_id BIGINT, quality INT, toxic INT"


def corpus(rows=500, seed=4):
    dice = random.Random(seed)
    words = ["that", "other", "reason", "éléments", "of", "in", "stone", "water."]
    texts, labels = [], []
    for i in range(rows):
        good = dice.random() < 0.6
        own = dice.choices(words, k=dice.randint(10, 300))
        texts.append((i, " ".join(own if good else [w.upper() + "!!" for w in own])))
        labels.append((i, int(good), 0))
    return texts, labels


def test_held_out_accuracy(spark, docs):
    texts, labels = corpus()
    df = docs(texts)
    net = quality.train(df, spark.createDataFrame(labels, LABELS), epochs=4)
    found = {r.doc_id: r for r in quality.score(df, net).collect()}
    out = [i for i, *_ in labels if zlib.crc32(str(i).encode()) % 4 == 2]
    assert {i for i, r in found.items() if r.held_out} == set(out)
    assert np.mean([found[i].predicted == labels[i][1] for i in out]) > 0.95
    assert all(r.predicted == int(r.score >= 0.7) for r in found.values())


def plain_score(net, text):
    """The network spelled out for one text."""
    data = np.zeros(quality.blocks_of(len(text)) * quality.BLOCK + quality.WIDTH, np.uint8)
    data[quality.LEAD:quality.LEAD + len(text)] = np.frombuffer(text, np.uint8)
    blocks = []
    for b in range((len(data) - quality.WIDTH) // quality.BLOCK):
        answers = []
        for at in range(b * quality.BLOCK, (b + 1) * quality.BLOCK, quality.STRIDE):
            answers.append(quality.TABLE[data[at:at + quality.WIDTH]].reshape(-1) @ net.filters + net.filter_bias)
        blocks.append(np.maximum(np.max(answers, axis=0), 0))
    pooled, start = [], 0
    while True:
        pooled.append(np.max(blocks[start:start + quality.CHUNK], axis=0))
        if start + quality.CHUNK >= len(blocks):
            break
        start += quality.STEP
    summary = np.concatenate([np.mean(pooled, axis=0), np.max(pooled, axis=0)])
    return quality.head(net, summary[None, :].astype(np.float32))[0][0]


def test_scores_are_those_of_the_network_spelled_out():
    net = quality.Network.fresh(3)
    net.filter_bias += np.linspace(-1, 1, quality.FILTERS).astype(np.float32)
    dice = np.random.default_rng(1)
    texts = [bytes(dice.integers(0, 256, n, dtype=np.uint8)) for n in (0, 1, 55, 56, 57, 200, 248, 249, 313, 5000, 70_000)]
    assert np.allclose(quality.predict(net, texts), [plain_score(net, t) for t in texts], atol=1e-4)


def test_gradients_are_those_of_the_loss():
    net = quality.Network.fresh(5)
    texts, labels, weights = [b"some text here" * 9, b"OTHER!! " * 50], np.array([1.0, 0.0]), np.array([1.0, 2.0])

    def loss():
        p = quality.predict(net, texts)
        return float(-(weights * (labels * np.log(p) + (1 - labels) * np.log(1 - p))).mean())

    for part, gradient in zip(net.parts(), quality.gradients(net, texts, labels, weights)):
        flat, g = part.reshape(-1), np.asarray(gradient).reshape(-1)
        at = int(np.abs(g).argmax())
        old, step = flat[at], 1e-2
        flat[at] = old + step
        up = loss()
        flat[at] = old - step
        down = loss()
        flat[at] = old
        assert abs((up - down) / (2 * step) - g[at]) <= 0.15 * abs(g[at]) + 1e-3


def test_odd_rows_and_empty_tables(spark, clashing, docs):
    rows = [(1, None), (2, ""), (None, "x"), (4, "long text " * 30_000), (4, "long text " * 30_000), (5, "\x00")]
    df = clashing(rows)
    labels = spark.createDataFrame([(1, 1, 0), (2, None, 0), (None, 1, 1), (4, 0, 0), (4, 1, 0)], LABELS)
    found = quality.score(df, quality.train(df, labels, epochs=1)).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    assert len({r.score for r in found if r.doc_id in (1, 2)}) == 1
    none = spark.createDataFrame([], LABELS)
    assert quality.score(docs([]), quality.train(docs([]), none)).collect() == []
