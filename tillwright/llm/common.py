"""Helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sinks import folders

# ASCII white space: blank, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = r"[\x20\x09-\x0D]+"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def numbered(df: DataFrame, prefix: str = "_c") -> DataFrame:
    """The same columns under unique names `_c0`, `_c1`, ...; whatever they were called, nothing clashes."""
    return df.toDF(*[f"{prefix}{i}" for i in range(len(df.columns))])


def position(df: DataFrame, name: str) -> int:
    """Where the column with exactly this name stands (the first, if it is there twice)."""
    try:
        return df.columns.index(name)
    except ValueError:
        raise ValueError(f"no column {name!r} among {df.columns}") from None


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only these columns, chosen by exact name, so that `TEXT` beside `text` is no ambiguity."""
    plain = numbered(df)
    return plain.select([F.col(f"_c{position(df, name)}").alias(name) for name in names])


def whole_text(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table into the cluster's shared folder and read it back.

    What is read later has no lineage: a lost executor costs a task, and steps that use the table
    more than once neither repeat the work nor see other rows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Whether the shuffle files of a query go when it ends, not when the driver happens to collect its garbage.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def tidily_written(df: DataFrame, name: str) -> DataFrame:
    """`written`, and the shuffle files of this step go with its end, so that steps do not add up on disk."""
    conf = df.sparkSession.conf
    before = conf.get(TIDY, None)
    conf.set(TIDY, "true")
    try:
        return written(df, name)
    finally:
        if before is None:
            conf.unset(TIDY)
        else:
            conf.set(TIDY, before)


def discard(*tables: DataFrame) -> None:
    """Delete tables that `written` has returned and that no later step reads."""
    for table in tables:
        for folder in {file.rpartition("/")[0] for file in table.inputFiles()}:
            folders.delete(table.sparkSession, folder)


#: Bytes of one Arrow batch at most, but for a single longer row. A task holds several batches on either side.
ARROW_BYTES = 4 << 20


def in_arrow(df: DataFrame, function, schema) -> DataFrame:
    """`mapInArrow` over batches of at most `ARROW_BYTES` bytes.

    The limit is a setting of the session and stays set, as plans are made only when they run.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{ARROW_BYTES}b")
    return df.mapInArrow(function, schema)


def keep_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of `docs` whose doc_id (null included) is among `ids.doc_id`, columns unchanged."""
    names, at = docs.columns, position(docs, "doc_id")
    wanted = ids.select(F.col("doc_id").alias("_wanted"))
    return numbered(docs).join(
        wanted, F.col(f"_c{at}").eqNullSafe(F.col("_wanted")), "left_semi"
    ).toDF(*names)


def drop_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of `docs` whose doc_id is not among `ids.doc_id`, columns unchanged."""
    names, at = docs.columns, position(docs, "doc_id")
    unwanted = ids.select(F.col("doc_id").alias("_unwanted"))
    return numbered(docs).join(
        unwanted, F.col(f"_c{at}").eqNullSafe(F.col("_unwanted")), "left_anti"
    ).toDF(*names)


def hash_pair(*columns: Column) -> tuple[Column, Column]:
    """Two 64-bit hashes with different seeds; nulls change neither."""
    return F.xxhash64(*columns), F.xxhash64(F.lit("second"), *columns)


#: A key is heavy with more than one in so many of all rows.
HEAVY = 1000
#: Tasks over which the rows of a heavy key are dealt.
PARTS = 256


def spread_join(rows: DataFrame, single: DataFrame, keys: list[str], heavy: DataFrame, how: str) -> DataFrame:
    """`rows` joined with `single`, which has one row per key; the rows of heavy keys are dealt over `PARTS`.

    `heavy` holds the keys, as `heavy_keys` finds them. A key with more than one row in `HEAVY` is heavy, so there are
    fewer than `HEAVY` of them whatever the size of the table, and their list can be broadcast.
    """
    marked = F.broadcast(heavy.select(*keys, F.lit(True).alias("_heavy")))
    part = F.when(
        F.col("_heavy"), F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(PARTS)).cast("int")
    ).otherwise(0)
    parts = F.when(F.col("_heavy"), F.sequence(F.lit(0), F.lit(PARTS - 1))).otherwise(F.array(F.lit(0)))
    left = rows.join(marked, keys, "left").withColumn("_part", part).drop("_heavy")
    right = single.join(marked, keys, "left").withColumn("_part", F.explode(parts)).drop("_heavy")
    return left.join(right, [*keys, "_part"], how).drop("_part")


def heavy_keys(counts: DataFrame, total: int) -> DataFrame:
    """Of (keys, n_rows) those that hold more than one in `HEAVY` of `total` rows."""
    return counts.where(F.col("n_rows") * HEAVY > total).drop("n_rows")


def labelled_sample(
    docs: DataFrame, labels: DataFrame, target: str, held_out: Column, rows: int, most_bytes: int
) -> DataFrame:
    """(doc_id, text, label): at most `rows` labelled texts of at most `most_bytes` UTF-8 bytes together.

    Labels that are null, have no id or are `held_out` (a condition on doc_id) are left out; of several labels of an id the
    greatest counts. The ids with the smallest hashes are taken, for each the text with the smallest hash of the rows that
    have the id, however many those are. Beyond `most_bytes` the longest texts go. Null texts are empty. Both bounds hold
    before anything reaches the driver.
    """
    chosen = pick(labels, "doc_id", target).filter(
        F.col(target).isNotNull() & F.col("doc_id").isNotNull() & ~held_out
    ).groupBy("doc_id").agg(F.max(target).cast("int").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = pick(docs, "doc_id", "text").join(F.broadcast(chosen), "doc_id").select(
        F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"), "label"
    )
    one_each = texts.groupBy("doc_id", "label").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    picked = written(one_each, "labelled")
    # At most `rows` ids and lengths pass this window.
    short = picked.select("doc_id", F.octet_length("text").alias("n")).select(
        "doc_id", F.sum("n").over(Window.orderBy("n", "doc_id")).alias("so_far")
    ).where(F.col("so_far") <= most_bytes).select("doc_id")
    return picked.join(F.broadcast(short), "doc_id")
