"""Line deduplication: lines that stand in many documents go, but for the document with the largest id.

Lines are exploded with their position, normalised and hashed; documents are counted per hash; lines
over the threshold are dropped, and the rest is reassembled by position. Only hashes travel until the last
step, in which every text meets the positions it loses. Lines met fewer times than the threshold cannot be in that
many documents, so documents are counted only for the others.

A line, or one document repeated, may hold a third of all rows: `common.spread_join` deals their rows over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: ASCII white space, as characters.
STRIPPED = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(STRIPPED)), UPPER, LOWER)


def split_lines(text: Column) -> Column:
    return F.split(text, "\n")


def line_hashes(docs: DataFrame, least_chars: int) -> DataFrame:
    """(doc_id, d1, d2, pos, h1, h2) per line of at least `least_chars` code points.

    d1 and d2 stand for id and text, so rows repeated in full are one document here as they are in the result.
    """
    d1, d2 = common.hash_pair(F.col("doc_id"), F.col("text"))
    exploded = common.pick(docs, "doc_id", "text").select("doc_id", common.whole_text().alias("text")).select(
        "doc_id", d1.alias("d1"), d2.alias("d2"), F.posexplode(split_lines(F.col("text"))).alias("pos", "line")
    )
    # A one-element explode makes the key a column of its own; else each hash would work it out again.
    keyed = exploded.where(F.length("line") >= least_chars).select(
        "doc_id", "d1", "d2", "pos", F.explode(F.array(line_key(F.col("line")))).alias("key")
    )
    h1, h2 = common.hash_pair(F.col("key"))
    return keyed.where(F.length("key") >= least_chars).select(
        "doc_id", "d1", "d2", "pos", h1.alias("h1"), h2.alias("h2")
    )


def dropped_lines(docs: DataFrame, least_chars: int, least_docs: int) -> tuple[DataFrame, DataFrame]:
    """((d1, d2, gone): positions a document loses, in order; heavy documents (d1, d2))."""
    lines = common.written(line_hashes(docs, least_chars), "lines")
    total = lines.count()
    met = common.written(
        lines.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") >= least_docs),
        "met",
    )
    often = common.written(
        common.spread_join(lines, met.drop("n_rows"), ["h1", "h2"], common.heavy_keys(met, total), "inner"), "often"
    )
    # All null ids are one document, less than any other.
    n_docs = F.count_distinct("doc_id") + F.max(F.col("doc_id").isNull().cast("int"))
    common_lines = common.written(
        often.groupBy("h1", "h2").agg(
            n_docs.alias("n_docs"), F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n_rows")
        ).where(F.col("n_docs") >= least_docs).drop("n_docs"),
        "common_lines",
    )
    lost = common.spread_join(
        often, common_lines.drop("n_rows"), ["h1", "h2"], common.heavy_keys(common_lines, total), "inner"
    ).where(~F.col("doc_id").eqNullSafe(F.col("keep_id")))
    gone = lost.groupBy("d1", "d2").agg(F.sort_array(F.collect_set("pos")).alias("gone"))
    # Repeated rows give a position as often as they are repeated.
    repeated = lines.groupBy("d1", "d2", "pos").agg(F.count(F.lit(1)).alias("n_rows")).groupBy("d1", "d2").agg(
        F.max("n_rows").alias("n_rows")
    )
    return gone, repeated


def without(lines: Column, gone: Column) -> Column:
    """The lines at other positions than `gone` (ascending), as slices between them: linear in the lines."""
    start = F.concat(F.array(F.lit(0)), F.transform(gone, lambda at: at + 1))
    end = F.concat(gone, F.array(F.size(lines)))
    return F.flatten(F.transform(F.arrays_zip(start.alias("a"), end.alias("b")),
                                 lambda cut: F.slice(lines, cut["a"] + 1, cut["b"] - cut["a"])))


def _cleaned(docs: DataFrame, doc_id: str, text: str, least_chars: int, least_docs: int) -> DataFrame:
    """The rows of `docs` with `_lines`, `_gone` and `_kept`."""
    if least_docs < 1:
        raise ValueError("least_docs must be at least 1")
    gone, repeated = dropped_lines(docs, least_chars, least_docs)
    total = common.pick(docs, "doc_id").count()
    d1, d2 = common.hash_pair(F.col(doc_id), common.whole_text(text))
    rows = docs.withColumns({"d1": d1, "d2": d2})
    met = common.spread_join(rows, gone, ["d1", "d2"], common.heavy_keys(repeated, total), "left")
    lines = split_lines(common.whole_text(text))
    return met.withColumn("_lines", lines).withColumn(
        "_kept",
        F.when(F.col("gone").isNull(), common.whole_text(text)).otherwise(
            F.array_join(without(F.col("_lines"), F.col("gone")), "\n")
        ),
    ).withColumn("_gone", F.coalesce(F.size("gone"), F.lit(0))).drop("d1", "d2", "gone")


def line_counts(docs: DataFrame, least_chars: int = 20, least_docs: int = 3) -> DataFrame:
    """One row per row of `docs`: doc_id, n_lines, n_dropped, kept_sha256 (of the lines that stay).

    A line's key is the line without ASCII white space at its ends and with A-Z in lower case. Keys of at least
    `least_chars` code points found in at least `least_docs` documents lose their lines in all documents but the one with
    the largest id. A document is an id: rows that share one count once, and all of them keep or lose the line.
    Null ids together are one document, less than any other. Null and empty texts are one empty line. A
    document whose lines all go has an empty text. An empty table gives an empty result.
    Other columns are ignored.
    """
    plain = common.pick(docs, "doc_id", "text")
    return _cleaned(plain, "doc_id", "text", least_chars, least_docs).select(
        "doc_id",
        F.size("_lines").cast("long").alias("n_lines"),
        F.col("_gone").cast("long").alias("n_dropped"),
        F.sha2("_kept", 256).alias("kept_sha256"),
    )


def drop_lines(docs: DataFrame, least_chars: int = 20, least_docs: int = 3) -> DataFrame:
    """`docs` with the lines gone that `line_counts` drops; other columns unchanged, null texts empty."""
    names = docs.columns
    doc_id, text = (f"_c{common.position(docs, name)}" for name in ("doc_id", "text"))
    rows = common.numbered(docs).withColumnsRenamed({doc_id: "doc_id", text: "text"})
    cleaned = _cleaned(rows, "doc_id", "text", least_chars, least_docs)
    plain = [{doc_id: "doc_id", text: "_kept"}.get(f"_c{i}", f"_c{i}") for i in range(len(names))]
    return cleaned.select(*plain).toDF(*names)
