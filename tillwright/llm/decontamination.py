"""Benchmark decontamination by spaced-seed hashing.

A mask names the positions of a stretch of words that count; the others may hold anything. Words under a
mask are hashed at every position of benchmark items and documents, equal hashes are joined, and the
documents' words around every hit are compared with the item position by position. Substitutions are
tolerated up to the stated share; an overlap counts if, in some stretch of `window` words (the whole of
a shorter item), at least `least` of the words agree.

The masks below find every stretch of 20 words with up to 4 substitutions, wherever they are (a test
tries all of them). Items shorter than that use unbroken masks short enough to do the same.

The benchmark is the small side, but it is not taken to be small: it is cut into blocks of at most
`block_words` words, and each block is joined with all documents in one pass over them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

# Spaced masks, 1 for a word that counts.
MASKS = ("1111011", "1110100011", "1110111")
WORD = re.compile(r"\w+")
FOUND = "doc_id BIGINT, item_id BIGINT, start BIGINT, stop BIGINT, matched BIGINT, compared BIGINT, overlap DOUBLE"

#: Seed hits formed at once, and words compared at once.
HITS = 1 << 18
CELLS = 1 << 20
#: Bits of a position beside the item's row.
ROOM = 36


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def masks_for(length: int, window: int, least: float) -> tuple[str, ...]:
    """Masks that find every tolerated overlap of an item of so many words."""
    size = min(length, window)
    substitutions = size - needed(size, least)
    if size >= 20 and substitutions <= size // 5:
        return MASKS
    return ("1" * max(1, -(-(size - substitutions) // (substitutions + 1))),)


def needed(size: int, least: float) -> int:
    """Words of a stretch that must agree."""
    return int(np.ceil(least * size - 1e-9))


def masked_hashes(ids: np.ndarray, mask: str) -> np.ndarray:
    """A 64-bit hash of the words under the mask, for every position where it fits."""
    count = len(ids) - len(mask) + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    hashes = np.full(count, xxhash.xxh64_intdigest(mask.encode()), np.uint64)
    for at, use in enumerate(mask):
        if use == "1":
            hashes ^= ids[at:at + count]
            hashes *= np.uint64(0x9E3779B97F4A7C15)
            hashes ^= hashes >> np.uint64(29)
    return hashes


class Block:
    """The hashed seeds of some benchmark items, and the comparison of a document with them."""

    def __init__(self, items: list[tuple[int, list[str]]], window: int, least: float):
        self.window, self.least = window, least
        self.numbers = [number for number, _ in items]
        self.ids: dict[str, int] = {}
        self.items = []
        found: dict[str, list[tuple[np.ndarray, int]]] = {}
        for row, (_, words) in enumerate(items):
            for word in words:
                if word not in self.ids:
                    self.ids[word] = xxhash.xxh64_intdigest(word.encode()) | 1
            own = np.array([self.ids[w] for w in words], np.uint64)
            self.items.append(own)
            for mask in masks_for(len(words), window, least):
                found.setdefault(mask, []).append((masked_hashes(own, mask), row))
        self.seeds = {}
        for mask, parts in found.items():
            hashes = np.concatenate([h for h, _ in parts])
            rows = np.concatenate([np.full(len(h), row) for h, row in parts])
            places = np.concatenate([np.arange(len(h)) for h, _ in parts])
            # A place whose neighbour before it has the same hash comes after those without, hash by hash.
            inner = np.zeros(len(hashes), bool)
            inner[1:] = (hashes[1:] == hashes[:-1]) & (rows[1:] == rows[:-1])
            order = np.lexsort((inner, hashes))
            hashes, rows, places, inner = hashes[order], rows[order], places[order], inner[order]
            seen = np.zeros(1 << 22, bool)
            seen[hashes >> np.uint64(42)] = True
            self.seeds[mask] = hashes, rows, places, np.concatenate([[0], np.cumsum(~inner)]), seen

    def diagonals(self, ids: np.ndarray) -> np.ndarray:
        """Packed (item row, document position that faces the item's first word) of all seed hits, in order, each once.

        A hit whose neighbour before it, in text and item, is one as well is on the same diagonal. Such hits inside a
        repeated word are not formed; others are formed `HITS` at a time (or those of one position) and united.
        """
        found = np.zeros(0, np.int64)
        for mask, (hashes, rows, places, first_ones, seen) in self.seeds.items():
            own = masked_hashes(ids, mask)
            at = np.flatnonzero(seen[own >> np.uint64(42)])
            if not len(at):
                continue
            repeats = (at > 0) & (own[at] == own[at - 1])
            low, high = np.searchsorted(hashes, own[at], "left"), np.searchsorted(hashes, own[at], "right")
            counts = np.where(repeats, first_ones[high] - first_ones[low], high - low)
            ends = np.cumsum(counts)
            start = 0
            while start < len(at):
                stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + HITS, "right")))
                n = counts[start:stop]
                hit = np.repeat(at[start:stop], n)
                first = np.repeat(low[start:stop] - np.cumsum(n) + n, n) + np.arange(n.sum())
                # Positions before the text are negative; half of the room is theirs.
                packed = (rows[first] << ROOM) + (hit - places[first]) + (1 << ROOM - 1)
                found = np.union1d(found, packed)
                start = stop
        return found

    def best(self, padded: np.ndarray, row: int, shifts: np.ndarray) -> tuple[int, int, int, int] | None:
        """(start, stop, matched, compared) of the widest tolerated overlap on the best of these diagonals, or None.

        `padded` is the text with as many unknown words on either side as the item has words.
        """
        item = self.items[row]
        length, size = len(item), min(len(item), self.window)
        found = None
        step = max(1, CELLS // length)
        for at in range(0, len(shifts), step):
            some = shifts[at:at + step]
            equal = padded[(some + length)[:, None] + np.arange(length)] == item
            sums = np.zeros((len(some), length + 1), np.int32)
            np.cumsum(equal, axis=1, out=sums[:, 1:])
            good = sums[:, size:] - sums[:, :-size] >= needed(size, self.least)
            some, sums, good = (part[good.any(axis=1)] for part in (some, sums, good))
            if not len(some):
                continue
            starts = np.maximum(np.maximum(0, -some), good.argmax(axis=1))
            ends = good.shape[1] - 1 - good[:, ::-1].argmax(axis=1) + size
            stops = np.minimum(np.minimum(length, len(padded) - 2 * length - some), ends)
            each = np.arange(len(some))
            matched = sums[each, stops] - sums[each, starts]
            top = np.lexsort((some, some + starts, -matched))[0]
            one = tuple(int(v) for v in (
                some[top] + starts[top], some[top] + stops[top], matched[top], stops[top] - starts[top]
            ))
            if found is None or (-one[2], one[0]) < (-found[2], found[0]):
                found = one
        return found

    def overlaps(self, text: str | None) -> dict[int, tuple[int, int, int, int]]:
        """For every item that the text overlaps: the best stretch, most words agreeing, then the first."""
        ids = np.array([self.ids.get(w, 0) for w in words_of(text)], np.uint64)
        packed = self.diagonals(ids)
        rows, firsts = np.unique(packed >> ROOM, return_index=True)
        best: dict[int, tuple[int, int, int, int]] = {}
        for row, a, b in zip(rows.tolist(), firsts, [*firsts[1:], len(packed)]):
            none = np.zeros(len(self.items[row]), np.uint64)
            shifts = (packed[a:b] & (1 << ROOM) - 1) - (1 << ROOM - 1)
            one = self.best(np.concatenate([none, ids, none]), row, shifts)
            if one:
                best[row] = one
        return best


def blocks(items: DataFrame, window: int, least: float, block_words: int) -> Iterator[Block]:
    """The benchmark in blocks of at most `block_words` words, or one item."""
    plain = common.pick(items, "item_id", "text").select(
        F.col("item_id").cast("long").alias("item_id"), "text"
    )
    part, size = [], 0
    for row in plain.toLocalIterator():
        words = words_of(row["text"])
        if not words:
            continue
        if part and size + len(words) > block_words:
            yield Block(part, window, least)
            part, size = [], 0
        part.append((row["item_id"], words))
        size += len(words)
    if part:
        yield Block(part, window, least)


def find_overlaps(
    docs: DataFrame, items: DataFrame, window: int = 20, least: float = 0.8, block_words: int = 500_000
) -> DataFrame:
    """One row per document row and benchmark item that overlap: doc_id, item_id, start, stop, matched, compared, overlap.

    start and stop count words (runs of letters, digits and underscores, lower-cased) of the
    document, matched those that agree of the compared ones. Null and empty texts overlap nothing,
    on either side. Of several overlaps with one item the one with most agreeing words is named,
    then the first. Repeated rows are answered each; ids may be null. Empty tables give an empty
    result. Other columns are ignored.
    """
    spark = docs.sparkSession
    plain = common.pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64())] + [
        (c, pa.int64()) for c in ("start", "stop", "matched", "compared")
    ] + [("overlap", pa.float64())])
    result = None
    for block in blocks(items, window, least, block_words):
        shared = spark.sparkContext.broadcast(block)

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            block = shared.value
            for batch in batches:
                rows = [
                    (doc_id, block.numbers[row], *one, one[2] / one[3])
                    for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"))
                    for row, one in block.overlaps(text.as_py()).items()
                ]
                columns = list(zip(*rows)) or [[]] * len(schema)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
                )

        found = common.in_arrow(plain, search, FOUND)
        result = found if result is None else result.union(found)
    return spark.createDataFrame([], FOUND) if result is None else result


def decontaminate(
    docs: DataFrame, items: DataFrame, window: int = 20, least: float = 0.8, block_words: int = 500_000
) -> DataFrame:
    """The rows of `docs` that overlap no benchmark item, columns unchanged and nothing exchanged."""
    names, at = docs.columns, common.position(docs, "text")
    rows = common.numbered(docs)
    for block in blocks(items, window, least, block_words):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def clean(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            block = shared.value
            for batch in batches:
                keep = [not block.overlaps(text.as_py()) for text in batch.column(at)]
                yield batch.filter(pa.array(keep, pa.bool_()))

        rows = common.in_arrow(rows, clean, rows.schema)
    return rows.toDF(*names)
