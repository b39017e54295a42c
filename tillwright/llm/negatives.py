"""Hard-negative mining over cover trees of norm-augmented candidates.

A row's score for an anchor is the inner product of their integer vectors. With M the greatest norm, a candidate y gets one
more component sqrt(M^2 - |y|^2), an anchor q gets 0; then |q' - y'|^2 = |q|^2 + M^2 - 2 q.y, so a ball around a tree
node bounds the inner products of all it holds from above and below.

Rows are dealt into blocks of neighbours, and every block becomes a cover tree, one row of a written table: a
node's children are a net of its points, more than half its level's radius apart and within that of all points, and a node
knows the distance to its farthest point. Anchors come to each block in chunks. Nodes are opened best first, by the
highest score any anchor of the chunk may still find there; anchors for which a node lies outside their windows, or
below what they have found, are left out. Points are scored exactly, in integers that float64 holds.

Two descents: the best rows of the anchor's own label are its positives, and each positive's score opens a window in which the
best rows of other labels are wanted. The anchors are a stated query set against all rows in blocks: a block reads
them as a stream, keeps one chunk and its own tree in memory, and returns at most k rows per anchor and window.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType

from . import common
from .codes import integers, usable

#: Rows of a tree, anchors of a chunk, rows of a leaf, points compared at once while a net is chosen.
BLOCK, CHUNK, LEAF, BATCH = 8192, 256, 32, 256
#: Rows around which blocks gather; they decide how well balls bound, not what is found.
PIVOTS = 64
#: Relative room for rounding in distances and bounds.
ROOM = 1e-9
NEVER, EVER = np.iinfo(np.int64).min, np.iinfo(np.int64).max


class Tree:
    """A cover tree over rows: ids, labels, row numbers, vectors, in an order in which each node's rows are neighbours.

    Nodes are parallel arrays: `center` (a row's place), `radius`, `start` and `stop` (its rows), `child` and
    `children` (its first child and their number; 0 for a leaf). Node 0 is the root.
    """

    FIELDS = ("center", "radius", "start", "stop", "child", "children")

    def __init__(self, rows, ids, labels, vectors, nodes: dict[str, np.ndarray], most: float):
        self.rows, self.ids, self.labels, self.vectors = rows, ids, labels, vectors
        self.most = most
        for name in self.FIELDS:
            setattr(self, name, nodes[name])

    @classmethod
    def build(cls, rows, ids, labels, vectors: np.ndarray, most: float) -> Tree:
        x = np.concatenate([vectors, np.sqrt(np.maximum(0, most - (vectors ** 2).sum(axis=1)))[:, None]], axis=1)
        nodes: list[list] = [[0, 0.0, 0, len(x), 0, 0]]
        order = np.arange(len(x))
        waiting = [0]
        while waiting:
            node = nodes[waiting.pop()]
            center, start, stop = node[0], node[2], node[3]
            members = order[start:stop]
            away = np.sqrt(((x[members] - x[center]) ** 2).sum(axis=1))
            node[1] = away.max() * (1 + ROOM) if len(members) > 1 else 0.0
            # `distances` is off by 1e-8 of the norm; balls not far beyond that are not divided.
            if len(members) <= LEAF or node[1] <= 1e-6 * np.sqrt(most):
                continue
            # From the distance itself: the farthest point then lies outside the first center's ball.
            level = 2.0 ** np.ceil(np.log2(away.max()))
            centers, owner = net(x, members, center, away, level / 2)
            order[start:stop] = members[np.argsort(owner, kind="stable")]
            edges = start + np.concatenate([[0], np.bincount(owner, minlength=len(centers)).cumsum()])
            node[4], node[5] = len(nodes), len(centers)
            for c, a, b in zip(centers, edges[:-1].tolist(), edges[1:].tolist()):
                if b - a > 1:
                    waiting.append(len(nodes))
                nodes.append([int(c), 0.0, a, b, 0, 0])
        place = np.empty(len(x), np.int64)
        place[order] = np.arange(len(x))
        columns = {name: np.array([n[i] for n in nodes]) for i, name in enumerate(cls.FIELDS)}
        columns["center"] = place[columns["center"]]
        return cls(rows[order], ids[order], labels[order], vectors[order], columns, most)


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    squared = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1) - 2 * (x @ y.T)
    return np.sqrt(np.maximum(squared, 0))


def net(x: np.ndarray, members: np.ndarray, center: int, away: np.ndarray, radius: float):
    """(centers, the center each member belongs to): centers are more than `radius` apart and that near to all.

    The parent's center is the first one. The others are taken in the members' order, `BATCH` candidates at a time.
    """
    centers, owner = [center], np.where(away <= radius, 0, -1)
    left = np.flatnonzero(owner < 0)
    while len(left):
        some = members[left[:BATCH]]
        near = distances(x[some], x[some]) <= radius
        np.fill_diagonal(near, True)
        covered = np.zeros(len(some), bool)
        chosen = []
        for i in range(len(some)):
            if not covered[i]:
                chosen.append(i)
                covered |= near[i]
        gaps = distances(x[members[left]], x[some[chosen]])
        gaps[chosen, np.arange(len(chosen))] = -1
        best = gaps.argmin(axis=1)
        inside = gaps[np.arange(len(left)), best] <= radius
        # A candidate that another one covers may measure a hair beyond; it belongs to the nearest then.
        inside[:len(some)] = True
        owner[left[inside]] = len(centers) + best[inside]
        centers.extend(some[chosen].tolist())
        left = left[~inside]
    return centers, owner


class Found:
    """The best `k` (score, id) per anchor and window: higher scores first, then smaller ids."""

    def __init__(self, anchors: int, windows: int, k: int):
        self.k = k
        self.scores = np.full((anchors, windows, k), NEVER)
        self.ids = np.full((anchors, windows, k), EVER)

    def worst(self) -> np.ndarray:
        return self.scores[:, :, -1]

    def add(self, anchor: int, window: int, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(scores) > self.k:
            enough = scores >= np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            scores, ids = scores[enough], ids[enough]
        scores = np.concatenate([self.scores[anchor, window], scores])
        ids = np.concatenate([self.ids[anchor, window], ids])
        first = np.lexsort((ids, -scores.astype(float)))[:self.k]
        self.scores[anchor, window], self.ids[anchor, window] = scores[first], ids[first]


class Anchors:
    """A chunk of anchors with windows of wanted scores, `low` to `high`, both included: (anchors, windows)."""

    def __init__(self, rows, labels, vectors, low, high):
        self.rows, self.labels, self.vectors, self.low, self.high = rows, labels, vectors, low, high
        self.norms = (vectors ** 2).sum(axis=1)


def descend(tree: Tree, anchors: Anchors, found: Found, same: bool) -> int:
    """Add the tree's rows of the same label (or of others) to what is found; returns the points scored."""
    scored = 0

    def wanted(who: np.ndarray, above: np.ndarray, below: np.ndarray) -> np.ndarray:
        """For which of these anchors some window may still take a score between the two bounds."""
        floor = np.maximum(anchors.low[who], found.worst()[who])
        return ((above[:, None] >= floor) & (below[:, None] <= anchors.high[who])).any(axis=1)

    def verify(who: np.ndarray, scores: np.ndarray, at: np.ndarray) -> None:
        nonlocal scored
        scored += scores.size
        exact = scores.astype(np.int64)
        fits = tree.labels[at] == anchors.labels[who][:, None]
        fits = (fits & (tree.rows[at] != anchors.rows[who][:, None])) if same else ~fits
        for j in range(anchors.low.shape[1]):
            floor = np.maximum(anchors.low[who, j], found.worst()[who, j])
            takes = fits & (exact >= floor[:, None]) & (exact <= anchors.high[who, j][:, None])
            for i in np.flatnonzero(takes.any(axis=1)):
                found.add(who[i], j, exact[i, takes[i]], tree.ids[at[takes[i]]])

    everyone = np.arange(len(anchors.rows))
    heap: list[tuple] = []
    number = 0

    def push(node: int, who: np.ndarray, scores: np.ndarray) -> None:
        """Keep a node with the anchors that may find something in its ball around the scored center."""
        nonlocal number
        size = anchors.norms[who] + tree.most
        away = np.sqrt(np.maximum(size - 2 * scores, 0))
        room = ROOM * size + 1e-6
        above = (size - np.maximum(away - tree.radius[node], 0) ** 2) / 2 + room
        below = (size - (away + tree.radius[node]) ** 2) / 2 - room
        alive = wanted(who, above, below)
        if alive.any():
            number += 1
            heapq.heappush(heap, (-above[alive].max(), number, node, who[alive], above[alive], below[alive]))

    push(0, everyone, anchors.vectors @ tree.vectors[tree.center[0]])
    while heap:
        _, _, node, who, above, below = heapq.heappop(heap)
        who = who[wanted(who, above, below)]
        if not len(who):
            continue
        if not tree.children[node]:
            at = np.arange(tree.start[node], tree.stop[node])
            verify(who, anchors.vectors[who] @ tree.vectors[at].T, at)
            continue
        below_it = np.arange(tree.child[node], tree.child[node] + tree.children[node])
        centers = tree.center[below_it]
        scores = anchors.vectors[who] @ tree.vectors[centers].T
        single = tree.stop[below_it] - tree.start[below_it] == 1
        if single.any():
            verify(who, scores[:, single], centers[single])
        for i in np.flatnonzero(~single):
            push(int(below_it[i]), who, scores[:, i])
    return scored


#: A tree or a chunk of anchors, on its way to a block.
PARCEL = StructType([
    StructField("slot", IntegerType()),
    StructField("kind", IntegerType()),
    *[StructField(n, ArrayType(LongType())) for n in ("rows", "ids", "labels")],
    StructField("vectors", ArrayType(IntegerType())),
    *[StructField(n, ArrayType(LongType())) for n in ("low", "high", "center")],
    StructField("radius", ArrayType(DoubleType())),
    *[StructField(n, ArrayType(LongType())) for n in ("start", "stop", "child", "children")],
])
PARCEL_ARROW = {f.name: {LongType(): pa.int64(), IntegerType(): pa.int32(), DoubleType(): pa.float64()}[
    f.dataType.elementType] for f in PARCEL[2:]}
TREE, CHUNKED = 0, 1


def parcel(slot: int, kind: int, **arrays: np.ndarray) -> pa.RecordBatch:
    """One row of PARCEL; columns that are not given are empty."""
    columns = [pa.array([slot], pa.int32()), pa.array([kind], pa.int32())]
    for name, of in PARCEL_ARROW.items():
        values = pa.array(np.asarray(arrays.get(name, [])).reshape(-1)).cast(of)
        columns.append(pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values))
    return pa.RecordBatch.from_arrays(columns, names=PARCEL.names)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, width)


def gathered(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """The rows of a task in tables of `most` rows."""
    held, n = [], 0
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            part = batch.slice(at, most - n)
            held.append(part)
            n, at = n + part.num_rows, at + part.num_rows
            if n == most:
                yield pa.Table.from_batches(held).combine_chunks()
                held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks()


def column(table: pa.Table, name: str) -> pa.Array:
    return table.column(name).combine_chunks()


def plant(rows: DataFrame, width: int, most: float, block: int) -> DataFrame:
    """Trees, as parcels: rows near the same pivot come together, in tasks of about `block` rows."""
    total = rows.count()
    first = rows.orderBy(F.xxhash64("row"), "row").limit(PIVOTS).select("ints").collect()
    pivots = np.array([r.ints for r in first], float)
    squares = (pivots ** 2).sum(axis=1)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("ints"), width)
            own = (squares - 2 * (x @ pivots.T)).argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own.astype(np.int32))], names=placed.names)

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot = TaskContext.get().partitionId()
        for table in gathered(batches, block):
            tree = Tree.build(
                column(table, "row").to_numpy(), column(table, "vec_id").to_numpy(), column(table, "label").to_numpy(),
                matrix(column(table, "ints"), width), most,
            )
            yield parcel(
                slot, TREE, rows=tree.rows, ids=tree.ids, labels=tree.labels, vectors=tree.vectors.astype(np.int32),
                **{name: getattr(tree, name) for name in Tree.FIELDS},
            )

    placed = StructType([*rows.schema, StructField("pivot", IntegerType())])
    # The row number divides a pivot that very many rows are nearest to.
    neighbours = common.in_arrow(rows, nearest, placed).repartitionByRange(-(-total // block), "pivot", "row")
    return common.written(common.in_arrow(neighbours, grow, PARCEL), "trees")


def descents(
    trees: DataFrame, anchors: DataFrame, width: int, most: float, k: int, same: bool, chunk: int
) -> DataFrame:
    """(anchor, place, rank, id, score): the best k rows per anchor and window; `place` is the window's place.

    `anchors` has row, label, ints, low and high (as many windows for each anchor as it likes).
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in gathered(batches, chunk):
            low, high = column(table, "low").to_pylist(), column(table, "high").to_pylist()
            n = max(len(w) for w in low)
            # Anchors with fewer windows get some that nothing fits into.
            yield parcel(
                0, CHUNKED, rows=column(table, "row").to_numpy(), labels=column(table, "label").to_numpy(),
                vectors=column(table, "ints").flatten().to_numpy(),
                low=np.array([w + [1] * (n - len(w)) for w in low], np.int64),
                high=np.array([w + [0] * (n - len(w)) for w in high], np.int64),
            )

    out = pa.schema([(n, pa.int64()) for n in ("anchor", "place", "id", "score")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot, grove = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                value = {n: row.column(n).flatten().to_numpy(zero_copy_only=False) for n in PARCEL_ARROW}
                vectors = matrix(row.column("vectors"), width)
                if row.column("slot")[0].as_py() != slot:
                    slot, grove = row.column("slot")[0].as_py(), []
                if row.column("kind")[0].as_py() == TREE:
                    grove.append(Tree(
                        value["rows"], value["ids"], value["labels"], vectors,
                        {n: value[n] for n in Tree.FIELDS}, most,
                    ))
                    continue
                n = len(value["rows"])
                chunked = Anchors(value["rows"], value["labels"], vectors,
                                  value["low"].reshape(n, -1), value["high"].reshape(n, -1))
                found = Found(n, chunked.low.shape[1], k)
                for tree in grove:
                    descend(tree, chunked, found, same)
                who, place, at = np.nonzero(found.scores != NEVER)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v.astype(np.int64)) for v in (
                        value["rows"][who], place, found.ids[who, place, at], found.scores[who, place, at])],
                    schema=out,
                )

    slots = trees.agg(F.max("slot")).first()[0] + 1
    chunks = common.in_arrow(anchors.select("row", "label", "ints", "low", "high"), pack, PARCEL)
    to_all = chunks.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
    # A block's trees come before the anchors: sorted, they are a stream.
    stream = trees.unionByName(to_all.select(*trees.columns)).repartition(slots, "slot").sortWithinPartitions(
        "slot", "kind"
    )
    found = common.in_arrow(stream, run, "anchor BIGINT, place BIGINT, id BIGINT, score BIGINT")
    best = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "anchor", "place", "rank", "id", "score"
    )


def hard_negatives(
    vectors: DataFrame, every: int = 100, scale: int = 256, positives: int = 5, negatives: int = 10,
    least: int = 30, most: int = 90, block: int = BLOCK, chunk: int = CHUNK,
) -> DataFrame:
    """One row per anchor, positive and negative: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    `vectors` has vec_id, embedding and label; other columns are ignored. Anchors are the rows whose vec_id `every` divides.
    Components become floor(scale * x), saturated at 2^22 for 64 components (`codes.largest`). An anchor's positives are the
    `positives` best other rows of its label; for each, the `negatives` best rows of other labels whose score is from
    `least` to `most` per cent of the positive's are ranked from 1. Higher scores come first, then smaller ids.

    Rows without id, label or vector, with a null or non-finite component, an empty vector, or another
    length than most (`codes.usable`) take no part. Rows that repeat an id are rows of their own, as anchors too. A positive with a
    negative score has no negatives. An empty table, or one without anchors, gives an empty result.
    """
    kept = integers(usable(vectors, 1), 1, scale).where(F.col("vec_id").isNotNull() & F.col("label").isNotNull())
    plain = kept.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), "ints")
    rows = common.written(plain.withColumn("row", F.monotonically_increasing_id()), "candidates")
    norm = F.aggregate("ints", F.lit(0).cast("long"), lambda total, x: total + x.cast("long") * x)
    size = rows.agg(F.max(norm).alias("most"), F.max(F.size("ints")).alias("width")).first()
    if size["most"] is None:
        return rows.select(*[F.lit(0).cast(t).alias(n) for n, t in (
            ("anchor_id", "long"), ("positive_id", "long"), ("rank", "int"), ("negative_id", "long"),
            ("positive_score", "long"), ("negative_score", "long"))]).where(F.lit(False))
    width, greatest = size["width"], float(size["most"])
    trees = plant(rows, width, greatest, block)
    anchors = rows.where(F.col("vec_id") % every == 0)
    anywhere = anchors.withColumns({
        "low": F.array(F.lit(NEVER + 1)), "high": F.array(F.lit(EVER))
    })
    matches = common.written(
        descents(trees, anywhere, width, greatest, positives, True, chunk).select(
            F.col("anchor").alias("row"), F.col("rank").alias("nth"), F.col("id").alias("positive_id"),
            F.col("score").alias("positive_score"),
        ).where("positive_score >= 0"),
        "positives",
    )
    wanted = matches.withColumns({
        "low": F.expr(f"({least} * positive_score + 99) div 100"), "high": F.expr(f"{most} * positive_score div 100")
    })
    windows = wanted.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("nth", "low", "high"))).alias("w"))
    aimed = anchors.join(windows, "row").select("row", "label", "ints", "w.low", "w.high")
    mined = descents(trees, aimed, width, greatest, negatives, False, chunk).select(
        F.col("anchor").alias("row"), (F.col("place") + 1).cast("int").alias("nth"), "rank",
        F.col("id").alias("negative_id"), F.col("score").alias("negative_score"),
    )
    named = anchors.select("row", F.col("vec_id").alias("anchor_id"))
    return mined.join(matches, ["row", "nth"]).join(named, "row").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
