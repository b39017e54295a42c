"""Exact deduplication by a tree-merge of sorted digest runs.

Every document is reduced to the digest of its normalised text, its doc_id and a proof (a second independent hash and
the byte length). Rows are dealt over `runs` runs; a run is sorted by digest and holds one entry per digest with the
smallest id. Runs then meet in binomial rounds: in each round the runs whose numbers agree without their last
base-`fan` digit merge, several ways at once, into the one whose digit is zero. A merge brings the runs into one sorted
order and unites neighbours (Spark's sort aggregation, as the entries carry ids and proofs that no hash
aggregation buffers); it keeps the smallest id and fails if entries of one digest differ in their proof. A digest that a third
of all rows share is one entry per task before the first exchange and at most `fan` entries per merge after it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

KEY = "text_sha256"


def digests(docs: DataFrame, runs: int) -> DataFrame:
    """(doc_id, row, run, text_sha256, proof) for every row; `row` tells rows apart, so write this before using it twice.

    Runs are dealt by row, so that neither a null id nor a repeated one fills a run.
    """
    plain = common.pick(docs, "doc_id", "text").select(
        "doc_id", F.regexp_replace(common.whole_text(), common.BLANKS, " ").alias("text"),
        F.monotonically_increasing_id().alias("row"),
    )
    return plain.select(
        "doc_id",
        "row",
        F.pmod(F.xxhash64("row"), F.lit(runs)).cast("int").alias("run"),
        F.sha2("text", 256).alias(KEY),
        F.concat_ws("-", F.hex(F.xxhash64("text")), F.octet_length("text")).alias("proof"),
    )


def united(entries: DataFrame) -> DataFrame:
    """One entry per run and digest, in sorted order: the least id and row, the number of rows, the proof they agree in."""
    merged = entries.groupBy("run", KEY).agg(
        F.min("least").alias("least"), F.sum("group_size").alias("group_size"), F.min("proof").alias("proof"), F.max("proof").alias("other"),
    )
    differ = F.concat(F.lit("one SHA-256, different texts: "), KEY)
    return merged.select(
        "run", KEY, "least", "group_size",
        F.when(F.col("proof") == F.col("other"), F.col("proof")).otherwise(F.raise_error(differ).cast("string")).alias("proof"),
    )


def merge_runs(entries: DataFrame, runs: int, fan: int) -> tuple[DataFrame, DataFrame]:
    """(the first runs, their merge): per digest the smallest id as keep_id, its row, the rows as group_size, the proof."""
    # Null ids come last.
    least = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    first = united(entries.select("run", KEY, "proof", least.alias("least"), F.lit(1).cast("long").alias("group_size")))
    level, left = first, runs
    while left > 1:
        level = united(level.withColumn("run", F.floor(F.col("run") / fan).cast("int")))
        left = -(-left // fan)
    return first, level.select(KEY, F.col("least.doc_id").alias("keep_id"), "least.row", "group_size", "proof")


def exact_groups(docs: DataFrame, runs: int = 64, fan: int = 8) -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical after every run of ASCII white space has become one
    blank. Null texts count as empty, and all empty texts are one group. Ids that are null lose
    against any other; a group of null ids only has a null keep_id. Of rows repeated with the same
    id and an equal text one is kept. An empty table gives an empty result. Other columns are ignored.
    """
    if runs < 1 or fan < 2:
        raise ValueError("runs must be at least 1 and fan at least 2")
    entries = common.written(digests(docs, runs), "digests")
    first, merged = merge_runs(entries, runs, fan)
    # Back down the tree: a digest meets its group once per run, then a document the group in its run.
    homes = first.select("run", KEY).join(merged.withColumnRenamed("row", "keep_row"), KEY)
    return entries.select("doc_id", "row", "run", KEY).join(homes, [KEY, "run"]).select(
        "doc_id",
        "keep_id",
        # The proof is asked for, or nothing would be verified.
        F.when(F.col("proof").isNotNull(), F.col("group_size")).alias("group_size"),
        (F.col("row") == F.col("keep_row")).alias("kept"),
        KEY,
    )


def deduplicate(docs: DataFrame, runs: int = 64, fan: int = 8) -> DataFrame:
    """The rows of `docs` that `exact_groups` keeps, columns unchanged.

    Rows that repeat an id with an equal text but differ elsewhere: the one with the smallest hash of
    its other columns stays.
    """
    names = docs.columns
    at, text = f"_c{common.position(docs, 'doc_id')}", f"_c{common.position(docs, 'text')}"
    kept = exact_groups(docs, runs, fan).filter("kept").select(
        F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_kept_digest")
    )
    rows = common.numbered(docs).withColumn(
        "_digest",
        F.sha2(F.regexp_replace(common.whole_text(text), common.BLANKS, " "), 256),
    )
    rest = [c for c in rows.columns if c not in (at, "_digest")]
    order = Window.partitionBy(at, "_digest").orderBy(F.xxhash64(*rest) if rest else F.lit(0))
    return rows.join(
        kept,
        F.col(at).eqNullSafe(F.col("_id")) & (F.col("_digest") == F.col("_kept_digest")),
        "left_semi",
    ).withColumn("_row", F.row_number().over(order)).filter("_row = 1").drop(
        "_digest", "_row"
    ).toDF(*names)
