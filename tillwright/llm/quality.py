"""A byte-level convolutional quality classifier in numpy.

A text's UTF-8 bytes become vectors of fixed byte properties. Learned filters of `WIDTH` bytes run over
the whole text at every second byte; their rectified answers are max-pooled over blocks of 64 bytes and
then over overlapping chunks of four blocks, two apart. The mean and the maximum of the chunks' answers go
through one hidden layer into one probability. Nothing is cut off: a text of any length is scored from
all its chunks, piece by piece.

The network is trained with Adam on at most `train_rows` labelled texts, whole as well, taken by a hash
of the id. The model is a few thousand numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .toxicity import held_out

BLOCK = 64  # bytes that are pooled first
CHUNK, STEP = 4, 2  # blocks of a chunk, blocks from chunk to chunk
WIDTH, STRIDE = 6, 2  # bytes under a filter, bytes from place to place (pairs of bytes: see `pair_answers`)
LEAD = 8  # padding before each text, wider than a filter
FILTERS, HIDDEN = 24, 16
#: Bytes that go through the filters at once.
PIECE = 1 << 15


def byte_table() -> np.ndarray:
    """256 x 13: kind of the byte, its low five bits, and 0 throughout for the padding byte."""
    code = np.arange(256)
    kinds = [
        (code >= 97) & (code <= 122), (code >= 65) & (code <= 90), (code >= 48) & (code <= 57),
        code == 32, (code >= 9) & (code <= 13), code >= 128, code > 0,
    ]
    kinds.append((code > 32) & (code < 127) & ~(kinds[0] | kinds[1] | kinds[2]))
    bits = [np.where(code >> b & 1, 0.5, -0.5) for b in range(5)]
    table = np.stack([*[k.astype(float) for k in kinds], *bits], axis=1)
    table[0] = 0
    return table.astype(np.float32)


TABLE = byte_table()
DEPTH = TABLE.shape[1]


@dataclass
class Network:
    filters: np.ndarray  # WIDTH * DEPTH x FILTERS
    filter_bias: np.ndarray
    hidden: np.ndarray  # 2 * FILTERS x HIDDEN
    hidden_bias: np.ndarray
    out: np.ndarray  # HIDDEN
    out_bias: np.ndarray  # 1

    @staticmethod
    def fresh(seed: int = 7) -> Network:
        dice = np.random.default_rng(seed)
        normal = lambda a, b: (dice.standard_normal((a, b)) / np.sqrt(a)).astype(np.float32)
        return Network(
            normal(WIDTH * DEPTH, FILTERS), np.zeros(FILTERS, np.float32), normal(2 * FILTERS, HIDDEN),
            np.zeros(HIDDEN, np.float32), normal(HIDDEN, 1)[:, 0], np.zeros(1, np.float32),
        )

    def parts(self) -> list[np.ndarray]:
        return [self.filters, self.filter_bias, self.hidden, self.hidden_bias, self.out, self.out_bias]


def blocks_of(length: int) -> int:
    """Blocks of a text of so many bytes and the padding before it, which filters see of the text's neighbour."""
    return -(-(length + LEAD) // BLOCK)


def padded(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts one after the other on whole blocks, and the blocks of each."""
    counts = np.array([blocks_of(len(t)) for t in texts], np.int64)
    data = np.zeros(int(counts.sum()) * BLOCK + WIDTH, np.uint8)
    at = 0
    for text, n in zip(texts, counts.tolist()):
        data[at + LEAD:at + LEAD + len(text)] = np.frombuffer(text, np.uint8)
        at += n * BLOCK
    return data, counts


def windows(data: np.ndarray) -> np.ndarray:
    """The embedded bytes under the filter at every place of whole blocks: places x WIDTH * DEPTH."""
    embedded = TABLE[data].reshape(-1)
    places = (len(data) - WIDTH) // STRIDE
    size = embedded.strides[0]
    return np.ascontiguousarray(np.lib.stride_tricks.as_strided(
        embedded, (places, WIDTH * DEPTH), (size * STRIDE * DEPTH, size), writeable=False
    ))


def pair_answers(net: Network) -> list[np.ndarray]:
    """What each two bytes add to each filter's answer at the three places under it: 65,536 x FILTERS each.

    Filters step by two bytes, so an answer is a sum of three rows, the same as the product of `windows`.
    """
    first, second = TABLE[np.arange(65536) & 255], TABLE[np.arange(65536) >> 8]
    parts = net.filters.reshape(WIDTH, DEPTH, FILTERS)
    return [first @ parts[i] + second @ parts[i + 1] for i in range(0, WIDTH, 2)]


def block_answers(net: Network, data: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
    """Largest rectified answer of each filter in each block, a piece at a time."""
    blocks = (len(data) - WIDTH) // BLOCK
    answers = np.empty((blocks, FILTERS), np.float32)
    pairs, step, each = data.view("<u2"), PIECE // BLOCK, BLOCK // STRIDE
    for a in range(0, blocks, step):
        b = min(blocks, a + step)
        found = tables[0][pairs[a * each:b * each]]
        for i in (1, 2):
            found += tables[i][pairs[a * each + i:b * each + i]]
        answers[a:b] = found.reshape(b - a, each, FILTERS).max(axis=1)
    return np.maximum(answers + net.filter_bias, 0)


def chunk_starts(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First block, blocks and text of every chunk; the last chunk of a text may be shorter."""
    firsts = np.cumsum(counts) - counts
    # The last chunk starts where the text's end is reached for the first time.
    per_text = np.maximum(1, -(-(counts - CHUNK) // STEP) + 1)
    text = np.repeat(np.arange(len(counts)), per_text)
    nth = np.arange(per_text.sum()) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    start = firsts[text] + nth * STEP
    return start, np.minimum(CHUNK, firsts[text] + counts[text] - start), text


def summary(answers: np.ndarray, counts: np.ndarray):
    """Per text the mean and the maximum over its chunks of the largest answers, and what made them."""
    start, size, text = chunk_starts(counts)
    member = start[:, None] + np.minimum(np.arange(CHUNK)[None, :], size[:, None] - 1)
    inside = answers[member]
    chunk_max = inside.max(axis=1)
    per_text = np.bincount(text, minlength=len(counts))
    edges = np.cumsum(per_text) - per_text
    mean = np.add.reduceat(chunk_max, edges, axis=0) / per_text[:, None]
    top = np.maximum.reduceat(chunk_max, edges, axis=0)
    return np.concatenate([mean, top], axis=1).astype(np.float32), (member, inside, chunk_max, text, per_text)


def head(net: Network, pooled: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hidden = np.maximum(pooled @ net.hidden + net.hidden_bias, 0)
    logits = hidden @ net.out + net.out_bias[0]
    return 1.0 / (1.0 + np.exp(-np.clip(logits.astype(np.float64), -30, 30))), hidden


def predict(net: Network, texts: list[bytes]) -> np.ndarray:
    """One probability per text; texts share the filters' passes but not each other's chunks."""
    found, at, tables = np.empty(len(texts)), 0, pair_answers(net)
    while at < len(texts):
        stop, size = at, 0
        while stop < len(texts) and (stop == at or size + len(texts[stop]) <= 16 * PIECE):
            size += len(texts[stop])
            stop += 1
        data, counts = padded(texts[at:stop])
        pooled, _ = summary(block_answers(net, data, tables), counts)
        found[at:stop] = head(net, pooled)[0]
        at = stop
    return found


def gradients(net: Network, texts: list[bytes], labels: np.ndarray, weights: np.ndarray) -> list[np.ndarray]:
    """Of the weighted log loss, through the places that won the pooling."""
    data, counts = padded(texts)
    seen = windows(data)
    raw = (seen @ net.filters).reshape(-1, BLOCK // STRIDE, FILTERS)
    winner = raw.argmax(axis=1)
    answers = np.maximum(np.take_along_axis(raw, winner[:, None, :], 1)[:, 0] + net.filter_bias, 0)
    pooled, (member, inside, chunk_max, text, per_text) = summary(answers, counts)
    scores, hidden = head(net, pooled)
    slope = (weights * (scores - labels) / len(texts)).astype(np.float32)
    d_hidden = slope[:, None] * net.out[None, :] * (hidden > 0)
    d_pooled = d_hidden @ net.hidden.T
    top = pooled[:, FILTERS:]
    share = chunk_max == top[text]
    ties = np.add.reduceat(share, np.cumsum(per_text) - per_text, axis=0)
    d_chunk = d_pooled[text, :FILTERS] / per_text[text][:, None] + d_pooled[text, FILTERS:] * share / ties[text]
    block = np.take_along_axis(member, inside.argmax(axis=1), 1)  # chunk x filter -> block that won
    d_answer = np.zeros_like(answers)
    np.add.at(d_answer, (block, np.arange(FILTERS)[None, :]), d_chunk)
    d_answer *= answers > 0
    hit, filt = np.nonzero(d_answer)
    place = hit * (BLOCK // STRIDE) + winner[hit, filt]
    values = d_answer[hit, filt][:, None] * seen[place]
    d_filters = np.zeros((FILTERS, WIDTH * DEPTH), np.float32)
    np.add.at(d_filters, filt, values)
    return [
        d_filters.T, d_answer.sum(axis=0), pooled.T @ d_hidden, d_hidden.sum(axis=0), hidden.T @ slope,
        np.array([slope.sum()], np.float32),
    ]


def fit(texts: list[bytes], labels: np.ndarray, epochs: int = 10, batch: int = 32, rate: float = 4e-3, seed: int = 7, balance: float = 0.0) -> Network:
    """Adam over shuffled batches, steps shrinking to a tenth; `balance` 1 lets both classes weigh the same."""
    net, dice = Network.fresh(seed), np.random.default_rng(seed)
    if not len(texts):
        return net
    share = min(max(float(labels.mean()), 1e-3), 1 - 1e-3)
    weights = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)) ** balance
    first = [np.zeros_like(p) for p in net.parts()]
    second = [np.zeros_like(p) for p in net.parts()]
    steps, step = epochs * -(-len(texts) // batch), 0
    for _ in range(epochs):
        order = dice.permutation(len(texts))
        for a in range(0, len(order), batch):
            own = order[a:a + batch]
            step += 1
            pace = rate * (1 - 0.9 * step / steps)
            for p, g, m, v in zip(net.parts(), gradients(net, [texts[i] for i in own], labels[own], weights[own]), first, second):
                m += 0.1 * (g - m)
                v += 0.002 * (g * g - v)
                p -= (pace * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.998**step)) + 1e-8)).astype(np.float32)
    return net


def train(
    docs: DataFrame, labels: DataFrame, folds: int = 4, fold: int = 2, train_rows: int = 4000,
    train_bytes: int = 64 << 20, epochs: int = 8,
) -> Network:
    """A network trained on at most `train_rows` labelled texts of `train_bytes` together, outside the held-out fold.

    `common.labelled_sample` says which; an id on many rows, or with many labels, is one text. Texts are trained on
    whole, null ones as empty. Without labels the network is as it begins.
    """
    sample = common.labelled_sample(
        docs, labels, "quality", held_out(F.col("doc_id"), folds, fold), train_rows, train_bytes
    ).select("doc_id", F.col("text").cast("binary").alias("text"), "label").toArrow().sort_by([("doc_id", "ascending")])
    return fit(sample["text"].to_pylist(), sample["label"].to_numpy().astype(float), epochs)


def score(docs: DataFrame, net: Network, folds: int = 4, fold: int = 2, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of `docs`.

    Only the text is scored; null texts count as empty, and empty ones are scored from padding alone.
    Repeated rows are scored each, null ids are not held out, other columns are ignored, an empty
    table gives an empty result.
    """
    out = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Rounded, as the last digits may depend on which texts share a pass.
            scores = predict(shared.value, batch.column("text").to_pylist()).round(4)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64()),
                 pa.array((scores >= threshold).astype(np.int32))], schema=out)

    plain = common.pick(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"), common.whole_text().cast("binary").alias("text"),
        held_out(F.col("doc_id"), folds, fold).alias("held_out"),
    )
    return common.in_arrow(plain, rate, "doc_id BIGINT, held_out BOOLEAN, score DOUBLE, predicted INT")
