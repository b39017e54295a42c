"""SimHash near-deduplication with pigeonring candidates.

Fingerprints link when they differ in at most `distance` of 64 bits. The 64 bits form a ring of
`segments` parts. If a pair differs in at most d bits over m segments, then from some segment on every chain of l
consecutive segments differs in at most l * d / m bits. So some `m - d` segments agree, in a pattern that
fits those budgets, and the pair meets under the key of that pattern. Of the pairs that meet, those
without such a chain are dropped before the full Hamming check.

A key that more than `crowd` fingerprints share (near copies by the thousand) is not compared pair by
pair: its fingerprints are joined through midpoints instead. Two fingerprints are within d bits if and
only if some 64-bit word is within d/2 (rounded up) of the one and d/2 (rounded down) of the other, so each lists
the words around it and links to the least fingerprint that lists the same word. That is exact, and
linear in the fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .components import components

#: Seed of the shingle hash.
SEED = 42
#: Shingles are counted in blocks of so many.
BLOCK = 8192


def shingle_hashes(text: bytes, words: int) -> np.ndarray:
    """XXH64 of every shingle of a UTF-8 text, repeats included."""
    found = text.lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    digest, joined = xxhash.xxh64_intdigest, b" ".join(found)
    if len(found) <= words:
        return np.array([digest(joined, SEED)], np.uint64)
    ends = np.cumsum([len(w) + 1 for w in found])
    starts = [0, *ends[:-1].tolist()]
    stops = (ends - 1).tolist()
    return np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(starts, stops[words - 1:])),
        np.uint64, len(found) - words + 1,
    )


def fingerprint(text: bytes, words: int) -> int:
    """Each bit is 1 if more than half of the shingle hashes have it, as a signed 64-bit number."""
    hashes = shingle_hashes(text, words)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), BLOCK):
        part = hashes[at:at + BLOCK].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, fp) for every row; null texts count as empty and get 0."""
    out = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py(), words) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.int64())], schema=out)

    plain = common.pick(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"), common.whole_text().cast("binary").alias("text")
    )
    return common.in_arrow(plain, compute, "doc_id BIGINT, fp BIGINT")


def ring(segments: int) -> list[int]:
    """Masks of the segments, as signed 64-bit numbers."""
    edges = [round(i * 64 / segments) for i in range(segments + 1)]
    masks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def patterns(segments: int, distance: int) -> list[frozenset[int]]:
    """The sets of segments that may have to agree: chains that keep to the budgets, from every start."""
    budgets = [length * distance // segments for length in range(1, segments + 1)]
    found = []
    for start in range(segments):
        for agree in combinations(range(segments), segments - distance):
            differing = np.cumsum([i not in agree for i in range(segments)])
            if all(n <= budget for n, budget in zip(differing, budgets)):
                one = frozenset((start + i) % segments for i in agree)
                if one not in found:
                    found.append(one)
    return found


def _bits(word: Column, mask: int) -> Column:
    return F.bit_count(word.bitwiseAND(F.lit(mask)))


def chained(differing: Column, segments: int, distance: int) -> Column:
    """Whether some chain around the ring keeps to its budget at every length."""
    counts = [_bits(differing, mask) for mask in ring(segments)]
    chains = []
    for start in range(segments):
        sums, total = [], F.lit(0)
        for length in range(1, segments + 1):
            total = total + counts[(start + length - 1) % segments]
            sums.append(total <= length * distance // segments)
        chains.append(reduce(Column.__and__, sums))
    return reduce(Column.__or__, chains)


def _keyed(prints: DataFrame, segments: int, distance: int) -> DataFrame:
    """(key, part, fp): one row per fingerprint and pattern; `part` is the pattern's number."""
    masks, one = ring(segments), F.col("fp")
    rows = [
        F.struct(F.lit(i).alias("part"), one.bitwiseAND(F.lit(sum(masks[s] for s in sorted(agree)))).alias("key"))
        for i, agree in enumerate(patterns(segments, distance))
    ]
    return prints.select("fp", F.inline(F.array(*rows)))


def _first_pattern(differing: Column, segments: int, distance: int) -> Column:
    """The number of the first pattern in which a pair agrees, so that it is taken up under one key only."""
    agreeing = reduce(
        Column.__add__,
        [F.when(_bits(differing, m) == 0, 1 << i).otherwise(0) for i, m in enumerate(ring(segments))],
    )
    known = patterns(segments, distance)
    table = []
    for z in range(1 << segments):
        have = {i for i in range(segments) if z >> i & 1}
        table.append(next((i for i, agree in enumerate(known) if agree <= have), -1))
    return F.element_at(F.array(*[F.lit(i) for i in table]), agreeing + 1)


def midpoint_links(prints: DataFrame, distance: int) -> DataFrame:
    """(u, v) that connect exactly the fingerprints within `distance`, by way of words between them."""
    def around(radius: int) -> list[int]:
        found = [sum(1 << b for b in bits) for n in range(radius + 1) for bits in combinations(range(64), n)]
        return [x - (1 << 64) if x >> 63 else x for x in found]

    masks = around(-(-distance // 2))
    # Odd distances: a word found in the wide ball of both would join fingerprints one bit too far apart.
    near = distance // 2
    listed = prints.select(
        "fp", F.explode(F.array(*[F.lit(m) for m in masks])).alias("_mask")
    ).select("fp", F.col("fp").bitwiseXOR(F.col("_mask")).alias("word"), (F.bit_count("_mask") <= near).alias("close"))
    least = listed.filter("close").groupBy("word").agg(F.min("fp").alias("v"))
    return listed.join(least.hint("merge"), "word").filter("fp <> v").select(F.col("fp").alias("u"), "v")


def shared_keys(prints: DataFrame, segments: int, distance: int) -> DataFrame:
    """(part, key, fp, n): the keys that several fingerprints have; `n` is how many."""
    keyed = _keyed(prints, segments, distance)
    sizes = keyed.groupBy("part", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return keyed.join(sizes.hint("merge"), ["part", "key"])


def near_links(prints: DataFrame, distance: int, segments: int, crowd: int) -> DataFrame:
    """(u, v) between distinct fingerprints such that chains of links are those of all pairs within `distance`."""
    shared = common.written(shared_keys(prints, segments, distance), "shared-keys")
    few = shared.filter(F.col("n") <= crowd)
    differing = F.col("a.fp").bitwiseXOR(F.col("b.fp"))
    pairs = few.alias("a").join(
        few.hint("merge").alias("b"),
        (F.col("a.part") == F.col("b.part")) & (F.col("a.key") == F.col("b.key")) & (F.col("a.fp") < F.col("b.fp"))
        & (_first_pattern(differing, segments, distance) == F.col("a.part"))
        & chained(differing, segments, distance) & (F.bit_count(differing) <= distance),
    ).select(F.col("a.fp").alias("u"), F.col("b.fp").alias("v"))
    crowded = shared.filter(F.col("n") > crowd).select("fp").distinct()
    # A pair's first key may be crowded while it also meets under another: it is linked by midpoints then.
    return pairs.union(midpoint_links(crowded, distance))


def near_groups(
    docs: DataFrame, words: int = 4, distance: int = 4, segments: int = 7, crowd: int = 1000
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id for every row of `docs`.

    Texts are lower-cased in A-Z only and split at ASCII white space; a text of up to `words` words
    is one shingle, null and empty ones have fingerprint zero and link like any other. component_id
    is the smallest doc_id that chains of links reach, itself included; null ids lose against others,
    and a component of null ids only has a null component_id. Repeated rows count each. An empty
    table gives an empty result. Other columns are ignored.
    """
    if not 0 < distance < segments <= 64:
        raise ValueError("distance must be at least 1 and below the number of segments")
    rows = common.written(fingerprints(docs, words), "fingerprints")
    groups = common.written(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    roots = components(near_links(groups.select("fp"), distance, segments, crowd))
    homes = groups.join(roots, groups["fp"] == roots["u"], "left").select(
        "fp", "least", F.coalesce("v", "fp").alias("root")
    )
    ids = homes.groupBy("root").agg(F.min("least").alias("component_id"))
    named = homes.join(ids, "root").select("fp", "component_id")
    return rows.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def deduplicate(docs: DataFrame, **options) -> DataFrame:
    """The rows of `docs` whose id is the smallest of its component; rows with one id are one document."""
    kept = near_groups(docs, **options).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    return common.keep_ids(docs, kept.select("doc_id").distinct())
