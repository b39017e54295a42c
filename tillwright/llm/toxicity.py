"""A toxicity classifier with counterfactual regularisation.

A linear model over the distinct words of a text, each with its prefixes (insults are inflected), is
fitted to labelled texts. For every labelled text that names a group, the group's name is swapped for
others of its kind, and the squared change of the score is a penalty beside the loss: what a text says
must count, not whom it mentions. An L1 penalty leaves ordinary words without weight, so a long
harmless text gathers no score.

The model is fitted on at most `train_rows` labelled texts, taken by a hash of the id; their features
are computed on the executors. Scoring is one pass over whole texts without any exchange.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

# Names of groups, by kind. A swap stays within a kind.
GROUPS = (
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("women", "men"), ("woman", "man"), ("girl", "boy"),
    ("gay", "lesbian", "straight", "bisexual", "transgender", "queer"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("immigrants", "refugees", "foreigners", "citizens"),
    ("disabled", "deaf", "blind"),
    ("old", "young"),
)
WORD = re.compile(r"\w+")
PREFIXES = (4, 5, 6)
#: Features are hashed into so many places.
PLACES = 1 << 20
#: A worker remembers the weights of so many words.
REMEMBERED = 300_000


def word_features(word: str) -> list[int]:
    """The word itself and its prefixes, hashed."""
    names = [word] + [f"{word[:n]}~" for n in PREFIXES if len(word) >= n]
    return [zlib.crc32(n.encode()) % PLACES for n in names]


def distinct_words(text: str | None) -> set[str]:
    return set(WORD.findall((text or "").lower()))


def swaps(words: set[str], groups=GROUPS) -> list[set[str]]:
    """The text's words with every group name turned into another of its kind, one set per turn."""
    kinds = {name: kind for kind in groups for name in kind}
    named = [w for w in words if w in kinds]
    turns = max((len(kinds[w]) for w in named), default=1)
    return [
        (words - set(named)) | {kinds[w][(kinds[w].index(w) + turn) % len(kinds[w])] for w in named}
        for turn in range(1, turns)
    ]


def features(words: set[str]) -> list[int]:
    return [f for w in words for f in word_features(w)]


@dataclass
class Model:
    """score = sigmoid(bias + the summed weights of the distinct words)."""

    weights: np.ndarray
    bias: float
    known: dict[str, float] = field(default_factory=dict, repr=False)

    def of_word(self, word: str) -> float:
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            found = self.known[word] = float(self.weights[word_features(word)].sum())
        return found

    def logit(self, text: str | None) -> float:
        # Sorted: a sum in the order of a set would differ from run to run in the last digit.
        return self.bias + float(np.sum(np.sort([self.of_word(w) for w in distinct_words(text)])))

    def score(self, text: str | None) -> float:
        return float(1.0 / (1.0 + np.exp(-np.clip(self.logit(text), -30.0, 30.0))))


def _products(rows: np.ndarray, places: np.ndarray, values: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(rows, values * weights[places], minlength=n)


def fit(
    rows: np.ndarray, places: np.ndarray, labels: np.ndarray, changes: list[tuple[list[int], list[int]]],
    counterfactual: float = 1.0, l1: float = 2e-4, steps: int = 150, seen: int = 3,
) -> Model:
    """Accelerated proximal gradient descent on log loss + swap penalty + L1.

    Text `rows[i]` has feature `places[i]`; `changes` lists, for every swap, the features it brings
    and those it takes. Features of fewer than `seen` words of the sample are left out.
    """
    model = Model(np.zeros(PLACES, np.float32), 0.0)
    if not len(labels):
        return model
    n_pairs = len(changes)
    lengths = [len(brought) + len(taken) for brought, taken in changes]
    pairs = np.repeat(np.arange(n_pairs), lengths).astype(np.int64)
    pair_places = np.array([f for change in changes for side in change for f in side], np.int64)
    pair_values = np.array([x for b, t in changes for x in [1.0] * len(b) + [-1.0] * len(t)])
    counts = np.bincount(places, minlength=PLACES)
    used = np.flatnonzero(counts >= min(seen, counts.max()))
    small = np.full(PLACES, -1, np.int64)
    small[used] = np.arange(len(used))
    keep = small[places] >= 0
    rows, places = rows[keep], small[places[keep]]
    values = np.ones(len(rows))
    keep = small[pair_places] >= 0 if n_pairs else np.zeros(0, bool)
    pairs, pair_places, pair_values = pairs[keep], small[pair_places[keep]], pair_values[keep]
    share = min(max(labels.mean(), 1e-3), 1 - 1e-3)
    balance = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))
    n, w, bias = len(labels), np.zeros(len(used)), 0.0
    # Features that most texts have would force tiny steps; scaled by how common they are, all move alike.
    scale = 1.0 / np.sqrt(np.maximum(np.bincount(places, minlength=len(used)), 1) / n)
    values = values * scale[places]
    pair_values = pair_values * scale[pair_places] if n_pairs else pair_values
    v = np.ones(len(used)) / np.sqrt(len(used))
    for _ in range(12):  # largest curvature, by power iteration
        u = np.bincount(places, values * (0.25 * balance / n * _products(rows, places, values, v, n))[rows], minlength=len(used))
        if n_pairs:
            u += counterfactual / n_pairs * np.bincount(
                pair_places, pair_values * _products(pairs, pair_places, pair_values, v, n_pairs)[pairs], minlength=len(used))
        norm = float(np.linalg.norm(u)) or 1.0
        v = u / norm
    step = 0.9 / (norm + 0.5)
    penalty = l1 * scale
    at, last, t = w.copy(), w.copy(), 1.0
    for _ in range(steps):
        scores = 1 / (1 + np.exp(-np.clip(_products(rows, places, values, at, n) + bias, -30, 30)))
        slope = balance * (scores - labels) / n
        gradient = np.bincount(places, values * slope[rows], minlength=len(used))
        if n_pairs:
            change = _products(pairs, pair_places, pair_values, at, n_pairs)
            gradient += counterfactual / n_pairs * np.bincount(pair_places, pair_values * change[pairs], minlength=len(used))
        moved = at - step * gradient
        w = np.sign(moved) * np.maximum(np.abs(moved) - step * penalty, 0)
        bias -= slope.sum()
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        at, last = w + (before - 1) / t * (w - last), w
    model.weights[used] = w * scale
    model.bias = float(bias)
    return model


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves `fold` when divided by `folds`; null ids are not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def train(
    docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0, train_rows: int = 4000,
    train_bytes: int = 64 << 20, counterfactual: float = 1.0, groups=GROUPS,
) -> Model:
    """A model fitted on at most `train_rows` labelled texts of `train_bytes` together, outside the held-out fold.

    `common.labelled_sample` says which; an id on many rows, or with many labels, is one text. Only features reach the
    driver. Null and empty texts have none. Without labels the model scores every text the same.
    """
    texts = common.labelled_sample(
        docs, labels, "toxic", held_out(F.col("doc_id"), folds, fold), train_rows, train_bytes
    ).withColumnRenamed("label", "toxic")
    schema = "doc_id BIGINT, own ARRAY<INT>, swapped ARRAY<ARRAY<ARRAY<INT>>>, toxic INT"
    out = pa.schema([
        ("doc_id", pa.int64()), ("own", pa.list_(pa.int32())),
        ("swapped", pa.list_(pa.list_(pa.list_(pa.int32())))), ("toxic", pa.int32()),
    ])

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, swapped = [], []
            for text in batch.column("text"):
                words = distinct_words(text.as_py())
                own.append(sorted(features(words)))
                # Only what a swap changes is sent: the rest of the score stays as it is.
                swapped.append([
                    [sorted(features(other - words)), sorted(features(words - other))]
                    for other in swaps(words, groups)
                ])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(own, out[1].type), pa.array(swapped, out[2].type),
                 batch.column("toxic")], schema=out)

    sample = common.in_arrow(texts, extract, schema).toArrow().sort_by([("doc_id", "ascending")]).combine_chunks()
    own = sample["own"]
    lengths = pc.list_value_length(own).to_numpy()
    return fit(
        np.repeat(np.arange(len(own)), lengths), pc.list_flatten(own).to_numpy().astype(np.int64),
        sample["toxic"].to_numpy().astype(float),
        [tuple(change) for changes in sample["swapped"] for change in changes.as_py()], counterfactual,
    )


def score(docs: DataFrame, model: Model, folds: int = 5, fold: int = 0, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of `docs`.

    Only the text is scored; null and empty texts get the score of no words. Repeated rows are
    scored each, null ids are not held out, other columns are ignored, an empty table gives an empty
    result. The model is some megabytes whatever the input (`PLACES` weights).
    """
    out = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in batches:
            scores = [own.score(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64()),
                 pa.array([int(s >= threshold) for s in scores], pa.int32())], schema=out)

    plain = common.pick(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", held_out(F.col("doc_id"), folds, fold).alias("held_out")
    )
    return common.in_arrow(plain, rate, "doc_id BIGINT, held_out BOOLEAN, score DOUBLE, predicted INT")


def reject_toxic(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of `docs` that score below the threshold, columns unchanged and nothing exchanged."""
    names, at = docs.columns, common.position(docs, "text")
    rows = common.numbered(docs)
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in batches:
            keep = [own.score(t.as_py()) < threshold for t in batch.column(at)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return common.in_arrow(rows, clean, rows.schema).toDF(*names)
