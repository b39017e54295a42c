"""Mixing sources to target weights by systematic sampling.

Every document of a source is expected target / size times, where both are words. Along the source's
documents, ordered by size and then by a hash of the id, the expected copies are summed up; one offset
is added, and a document is taken once per whole number its stretch of the sum crosses. Along that order the words
taken follow the expected words to within about the longest document.

The running sum is never taken over a whole source in one task. Documents are counted per
(source, size, slot), where a slot is one of 4,096 parts by the hash; the counts are summed
along slots, then sizes, and a document only ranks itself inside its own slot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

WORD = r"[^\x20\x09-\x0D]+"


def word_count(column: str) -> Column:
    """Number of runs of characters other than ASCII white space."""
    return F.regexp_count(common.whole_text(column), F.lit(WORD)).cast("long")


def source_targets(
    sizes: DataFrame, weights: Sequence[float], share: float, most: float
) -> DataFrame:
    """One row per source: source, source_size, target.

    `sizes` has source and source_size, one row per source. A target is min(most x size, level x weight), the level
    at which the targets add up to share x all sizes. That is where handing the excess of full
    sources to the others ends. Sources fill up in the order of most x size / weight, so the level
    follows from sums along that order. The table has one row per source and is small.
    """
    every = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"),
    )
    ranked = sizes.select("source", "source_size", weight.alias("weight")).withColumn(
        "cap", F.lit(float(most)) * F.col("source_size")
    )
    filling = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    rest = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (
        F.lit(float(share)) * F.sum("source_size").over(every)
        - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    ) / F.sum("weight").over(rest)
    return ranked.withColumn("_level", level).withColumn(
        # The first source that stays below its cap at its own level fixes the level for the rest.
        "_final", F.min(F.when(F.col("_level") * F.col("weight") <= F.col("cap"),
                               F.struct(F.col("cap") / F.col("weight"), F.col("_level")))).over(every)
    ).select(
        "source", "source_size",
        F.when(F.col("_final").isNull(), F.col("cap")).otherwise(
            F.least(F.col("cap"), F.col("_final._level") * F.col("weight"))
        ).alias("target"),
    )


def offset(source: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on the source and the seed only."""
    text = F.concat(F.lit(seed), F.coalesce(source, F.lit("\x00null")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("double") / 4294967296.0


def copies(
    docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0,
    seed: str = "mix",
) -> DataFrame:
    """One row per row of `docs`: doc_id, size, source, source_size, target, copies, taken.

    Size is the number of words; null texts have none. Sources, in code-point order with null last,
    weigh `weights` in turn and share `share` x all words, each at most `most` x its own. `copies` is
    how often a document is taken, `taken` its words in the mix. Documents that repeat an id are
    documents of their own. Null ids rank after the others. A source without words takes nothing. An empty table gives an empty
    result. Other columns are ignored. The result depends on rows, parameters and seed only.
    """
    narrow = common.pick(docs, "doc_id", "source", "text").select(
        "doc_id", F.col("source").cast("string").alias("source"), word_count("text").alias("size"),
        F.substring(F.md5(F.col("doc_id").cast("string").cast("binary")), 1, 3).alias("slot"),
    ).withColumn("slot", F.coalesce("slot", F.lit("~")))
    return _spread(common.written(narrow, "sizes"), weights, share, most, seed)


def _spread(narrow, weights, share, most, seed):
    counted = narrow.groupBy("source", "size", "slot").agg(F.count(F.lit(1)).alias("n"))
    slots = counted.withColumn(
        "before_slot",
        F.sum("n").over(
            Window.partitionBy("source", "size").orderBy("slot")
        ) - F.col("n"),
    )
    lengths = narrow.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    along = lengths.select(
        "source", "size",
        (F.sum("n").over(Window.partitionBy("source").orderBy("size")) - F.col("n")).alias("before_size"),
    )
    sources = lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = source_targets(sources, weights, share, most)
    same = lambda a, b: F.col(f"{a}.source").eqNullSafe(F.col(f"{b}.source"))
    sized = along.alias("a").join(targets.alias("t"), same("a", "t")).select(
        "a.source", "a.size", "a.before_size", "t.source_size", "t.target"
    )
    slotted = slots.alias("s").join(
        sized.alias("z"), same("s", "z") & (F.col("s.size") == F.col("z.size"))
    ).select(
        "s.source", "s.size", "s.slot",
        (F.col("before_slot") + F.col("before_size")).alias("before"), "source_size", "target",
    )
    inside = Window.partitionBy("source", "size", "slot").orderBy(F.col("doc_id").asc_nulls_last())
    ranked = narrow.withColumn("rank", F.row_number().over(inside))
    placed = ranked.alias("r").join(
        slotted.alias("p"),
        same("r", "p") & (F.col("r.size") == F.col("p.size")) & (F.col("r.slot") == F.col("p.slot")),
    ).select("r.doc_id", "r.size", "r.source", "source_size", "target",
             (F.col("before") + F.col("rank")).alias("end"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    crossed = lambda end: F.floor(end * rate + offset(F.col("source"), seed))
    taken = (crossed(F.col("end")) - crossed(F.col("end") - 1)).cast("long")
    return placed.withColumn("copies", taken).select(
        "doc_id", "size", "source", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every row of `docs` as often as it is taken, columns unchanged.

    Rows with the same id, source and size share one decision: the sum of their copies is dealt over
    them in the order of a hash of their columns.
    """
    names = docs.columns
    at, source, text = (f"_c{common.position(docs, c)}" for c in ("doc_id", "source", "text"))
    decided = copies(docs, **options).groupBy("doc_id", "source", "size").agg(
        F.sort_array(F.collect_list("copies")).alias("_copies")
    ).select(
        F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("size").alias("_words"),
        "_copies",
    ).filter("array_max(_copies) > 0")
    rows = common.numbered(docs).withColumn("_size", word_count(text))
    rest = [c for c in rows.columns if c not in (at, source, "_size")]
    order = Window.partitionBy(at, source, "_size").orderBy(F.xxhash64(*rest))
    return rows.join(
        decided,
        F.col(at).eqNullSafe(F.col("_id")) & F.col(source).eqNullSafe(F.col("_source"))
        & (F.col("_size") == F.col("_words")),
    ).withColumn("_n", F.get("_copies", F.row_number().over(order) - 1)).filter("_n > 0").select(
        *[c for c in rows.columns if c != "_size"], F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("_copy"),
    ).drop("_copy").toDF(*names)
