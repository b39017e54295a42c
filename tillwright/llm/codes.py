"""Vector compression by product codes, with adaptive distance bounds.

A vector's components become integers and are cut into parts; every part position has a codebook, refined in
rounds: each part is assigned to its nearest entry, each entry becomes the mean of its parts, rounded down. All
distances that decide are squared distances of integers, which float64 holds exactly.

Between rounds each part keeps its `b` closest entries with lower bounds in ascending order, and one outer bound for all
entries that are not listed (Drake and Hamerly). When the entries have moved, each bound shrinks by the
move of its own entry, the outer one by the largest move. A part whose distance to its entry lies below all bounds stays
without another comparison; else the listed entries whose bounds it reaches are compared in integers; only
where it reaches the outer bound all entries are. `b` adapts: after a round it is the least length that
would have spared all but one in `SEARCHED` parts the whole search, but at least half of what it was.

The rows with their lists and bounds are a written table per round. The driver sees the codebooks, their sums and a
histogram of lengths: bounded by entries x components, whatever the number of rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, LongType, ShortType, StringType, StructField, StructType

from . import common

#: Lists are kept long enough for all but one in so many parts.
SEARCHED = 100
#: Rows compared with all entries at once.
SLICE = 2048
#: Relative room for rounding in bounds; stored bounds are 32-bit.
ROOM = 1e-6


def largest(width: int) -> int:
    """Integers saturate here, so that squared distances of `width` components stay below 2^53."""
    return 1 << max(1, (53 - max(1, width - 1).bit_length()) // 2 - 1)


def usable(vectors: DataFrame, parts: int) -> DataFrame:
    """(vec_id, label, vector) of the rows whose vector is complete, finite and of the table's length.

    That is the most frequent length that `parts` divides; the longer of equally frequent ones.
    """
    rows = common.pick(vectors, "vec_id", "embedding", "label").withColumnRenamed("embedding", "vector")
    size = F.size("vector")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    whole = rows.where(F.col("vector").isNotNull() & (size > 0) & (size % parts == 0) & finite)
    most = whole.groupBy(size.alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return whole.where(size == (most["n"] if most else 0)).select("vec_id", "label", "vector")


def integers(vectors: DataFrame, parts: int, scale: int) -> DataFrame:
    """`vector` as `ints`: floor(scale * x), between the limits of `largest`."""
    width = F.size("vector") / parts
    bits = F.floor((F.lit(53) - F.ceil(F.log2(F.greatest(width, F.lit(1.0))))) / 2) - 1
    most = F.pow(F.lit(2.0), F.greatest(bits, F.lit(1)))
    scaled = F.transform(
        "vector", lambda x: F.floor(F.greatest(-most, F.least(most, x.cast("double") * F.lit(scale)))).cast("int")
    )
    return vectors.select("vec_id", "label", scaled.alias("ints"))


def ordered(low: np.ndarray) -> np.ndarray:
    """Lower bounds made ascending: each is at most all that follow it."""
    return np.minimum.accumulate(low[:, ::-1], axis=1)[:, ::-1]


def search(x: np.ndarray, book: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray]:
    """(the b nearest entries in order, bounds of all but the first and of the rest) by comparing with all."""
    k = len(book)
    near, low = np.empty((len(x), b), np.int64), np.empty((len(x), b))
    norms = (book * book).sum(axis=1)
    for at in range(0, len(x), SLICE):
        part = x[at:at + SLICE]
        squared = (part * part).sum(axis=1)[:, None] - 2.0 * (part @ book.T) + norms
        keys = np.sort(squared.astype(np.int64) * k + np.arange(k), axis=1)[:, :b + 1]
        near[at:at + SLICE] = keys[:, :b] % k
        away = np.sqrt((keys // k).astype(float))
        low[at:at + SLICE, :b - 1] = away[:, 1:b]
        low[at:at + SLICE, b - 1] = away[:, b] if k > b else np.inf
    return near, low


def follow(
    x: np.ndarray, near: np.ndarray, low: np.ndarray, book: np.ndarray, moved: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(near, low, need) after the entries moved; `need` is how many bounds the part reached."""
    b, k = near.shape[1], len(book)
    near, low = near.copy(), low.astype(float)
    low[:, :b - 1] -= moved[near[:, 1:]]
    low[:, b - 1] -= moved.max()
    low = ordered(low - ROOM * np.abs(np.where(np.isfinite(low), low, 0)) - ROOM * moved.max())
    own = ((x - book[near[:, 0]]) ** 2).sum(axis=1)
    need = (low <= (np.sqrt(own) * (1 + ROOM))[:, None]).sum(axis=1)
    for m in np.unique(need[(need > 0) & (need < b)]):
        rows = np.flatnonzero(need == m)
        listed = near[rows, :m + 1]
        squared = ((x[rows, None, :] - book[listed]) ** 2).sum(axis=2).astype(np.int64)
        keys = np.sort(squared * k + listed, axis=1)
        near[rows, :m + 1] = keys % k
        low[rows, :m] = np.sqrt((keys[:, 1:] // k).astype(float))
    far = np.flatnonzero(need == b)
    if len(far):
        near[far], low[far] = search(x[far], book, b)
    return near, ordered(low), need


class Codebooks:
    """Entries per part position, as float64 holding integers: (parts, entries, width)."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.parts, self.k, self.width = entries.shape

    def moves_to(self, other: Codebooks) -> np.ndarray:
        return np.sqrt(((self.entries - other.entries) ** 2).sum(axis=2)) * (1 + ROOM)

    def digest(self) -> str:
        text = ",".join(str(int(v)) for v in self.entries.reshape(-1))
        return hashlib.sha256(text.encode()).hexdigest()

    def cut(self, column: pa.Array) -> np.ndarray:
        """(rows, parts, width) of an Arrow column of lists."""
        return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(
            len(column), self.parts, self.width
        )


def first_codebooks(rows: DataFrame, parts: int, entries: int) -> Codebooks | None:
    """The parts of the smallest ids; rows with the same id, or without one, in the order of their components."""
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "ints").limit(entries).select("ints").collect()
    if not first:
        return None
    whole = np.array([r.ints for r in first], float)
    return Codebooks(whole.reshape(len(whole), parts, -1).transpose(1, 0, 2).copy())


def lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A row of numbers as an Arrow list per row."""
    ends = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.reshape(-1), kind))


def assign(rows: DataFrame, books: Codebooks, b: int, moved: np.ndarray | None) -> DataFrame:
    """The rows with their lists, bounds and `need`s; without `moved` every part is compared with all entries."""
    kept = [rows.schema[name] for name in ("vec_id", "label", "ints")]
    schema = StructType([
        *kept, StructField("near", ArrayType(ShortType())), StructField("low", ArrayType(FloatType())),
        StructField("need", ArrayType(ShortType())),
    ])

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = books.cut(batch.column("ints"))
            near = np.empty((len(x), books.parts, b), np.int64)
            low = np.empty((len(x), books.parts, b))
            need = np.full((len(x), books.parts), b)
            if moved is not None:
                shape = (len(x), books.parts, -1)
                old = batch.column("near").flatten().to_numpy(zero_copy_only=False).reshape(shape)[:, :, :b]
                bound = batch.column("low").flatten().to_numpy(zero_copy_only=False).reshape(shape)[:, :, :b]
            for p in range(books.parts):
                part, book = np.ascontiguousarray(x[:, p]), books.entries[p]
                if moved is None:
                    near[:, p], low[:, p] = search(part, book, b)
                else:
                    near[:, p], low[:, p], need[:, p] = follow(
                        part, old[:, p].astype(np.int64), bound[:, p], book, moved[p]
                    )
            stored = np.nextafter(low.astype(np.float32), np.float32(-np.inf))
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(f.name) for f in kept],
                    lists(near.reshape(len(x), -1), pa.int16()),
                    lists(stored.reshape(len(x), -1), pa.float32()),
                    lists(need, pa.int16()),
                ],
                names=schema.names,
            )

    return common.in_arrow(rows, compute, schema)


def sums(assigned: DataFrame, books: Codebooks, b: int) -> tuple[Codebooks, np.ndarray]:
    """(the entries after a round, how many parts had each `need`): sums per task, added up by Spark."""
    parts, k, width = books.entries.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, k, width + 1), np.int64)
        needs = np.zeros(b + 1, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = books.cut(batch.column("ints")).astype(np.int64)
            own = batch.column("near").flatten().to_numpy(zero_copy_only=False).reshape(len(x), parts, -1)[:, :, 0]
            for p in range(parts):
                np.add.at(total[p, :, :width], own[:, p], x[:, p])
                total[p, :, width] += np.bincount(own[:, p], minlength=k)
            needs += np.bincount(batch.column("need").flatten().to_numpy(zero_copy_only=False), minlength=b + 1)
        if needs.any():
            at = np.flatnonzero(total)
            values = [*total.reshape(-1)[at].tolist(), *needs.tolist()]
            cells = [*at.tolist(), *range(-b - 1, 0)]
            yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int64()), pa.array(values, pa.int64())],
                                             names=["cell", "value"])

    found = common.in_arrow(assigned.select("ints", "near", "need"), add, "cell BIGINT, value BIGINT")
    total, needs = np.zeros(parts * k * (width + 1), np.int64), np.zeros(b + 1, np.int64)
    # At most entries x (components + parts) and b + 1 rows.
    for cell, value in found.groupBy("cell").agg(F.sum("value")).collect():
        if cell < 0:
            needs[cell + b + 1] = value
        else:
            total[cell] = value
    total = total.reshape(parts, k, width + 1)
    n = total[:, :, width:]
    means = np.where(n > 0, total[:, :, :width] // np.maximum(n, 1), books.entries.astype(np.int64))
    return Codebooks(means.astype(float)), needs


def adapted(needs: np.ndarray, b: int) -> int:
    """The least length from b / 2 to b at which one part in `SEARCHED` would be compared with all entries."""
    reached = needs[::-1].cumsum()[::-1]  # reached[m]: parts that reached at least m bounds
    for length in range(-(-b // 2), b):
        if reached[length] * SEARCHED <= reached[0]:
            return length
    return b


def refine(
    vectors: DataFrame, parts: int, entries: int, rounds: int, scale: int, listed: int
) -> tuple[DataFrame, Codebooks, list[np.ndarray]] | None:
    """(rows with their final lists, final codebooks, histogram of `need` per assignment); None without rows."""
    rows = common.written(integers(usable(vectors, parts), parts, scale), "integers")
    books = first_codebooks(rows, parts, entries)
    if books is None:
        return None
    b, moved, history = min(listed, books.k), None, []
    for _ in range(rounds):
        rows = common.written(assign(rows, books, b, moved), "assigned")
        following, needs = sums(rows, books, b)
        history.append(needs)
        if moved is not None:
            b = adapted(needs, b)
        moved, books = books.moves_to(following), following
    return assign(rows, books, b, moved), books, history


def codes(rows: DataFrame, books: Codebooks) -> DataFrame:
    """(vec_id, label, code, error) of assigned rows."""
    kept = [rows.schema[name] for name in ("vec_id", "label")]
    schema = StructType([*kept, StructField("code", StringType()), StructField("error", LongType())])

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = books.cut(batch.column("ints"))
            own = batch.column("near").flatten().to_numpy(zero_copy_only=False).reshape(
                len(x), books.parts, -1
            )[:, :, 0].astype(np.int64)
            error = sum(((x[:, p] - books.entries[p][own[:, p]]) ** 2).sum(axis=1) for p in range(books.parts))
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(f.name) for f in kept],
                    pa.array([bytes(row).hex() for row in own.astype(np.uint8)], pa.string()),
                    pa.array(error.astype(np.int64)),
                ],
                names=schema.names,
            )

    return common.in_arrow(rows.select("vec_id", "label", "ints", "near"), compute, schema)


def vector_codes(
    vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024, listed: int = 16
) -> DataFrame:
    """One row per usable vector: vec_id, code, error, label_error, codebooks_sha256.

    `vectors` has vec_id, embedding and label; other columns are ignored. Rows whose vector is null or empty, holds a null or
    non-finite component, or has another length than most (see `usable`) are left out. Components become
    floor(scale * x), saturated at 2^23 for parts of 16 (see `largest`), far beyond scaled unit vectors. A code is two
    hex digits per part. `error` is the squared distance to the coded vector, `label_error` its sum over equal labels,
    null labels together (null itself beyond a long). Null ids come last among the first entries. Repeated rows count
    each, and equal entries leave all their parts to the first. Fewer rows than entries make
    smaller codebooks. An empty table gives an empty result.
    """
    if not 1 <= entries <= 256 or parts < 1 or rounds < 0 or listed < 1:
        raise ValueError("entries must be 1 to 256, parts and listed at least 1, rounds at least 0")
    found = refine(vectors, parts, entries, rounds, scale, listed)
    if found is None:
        empty = common.pick(vectors, "vec_id").where(F.lit(False))
        return empty.select("vec_id", *[F.lit(None).cast(t).alias(n) for n, t in (
            ("code", "string"), ("error", "long"), ("label_error", "long"), ("codebooks_sha256", "string"))])
    rows, books, _ = found
    coded = common.written(codes(rows, books), "codes").select(
        "vec_id", "code", "error", F.col("label").isNull().alias("_null"),
        F.coalesce(F.col("label").cast("string"), F.lit("")).alias("_label"),
    )
    by_label = ["_null", "_label"]
    labels = coded.groupBy(*by_label).agg(F.try_sum("error").alias("label_error"), F.count(F.lit(1)).alias("n_rows"))
    heavy = common.heavy_keys(labels.select(*by_label, "n_rows"), coded.count())
    return common.spread_join(coded, labels.drop("n_rows"), by_label, heavy, "inner").select(
        "vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256")
    )
