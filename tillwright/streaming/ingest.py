"""Streaming ingest of transactions, alerts and unreadable messages, into files or a database."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import date, datetime, timedelta, timezone
import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..schemas import schema
from ..sinks import folders
from ..sinks.database import write_table
from ..sources.database import hash_predicates, read_split
from . import messages as M

DAY = "transaction_date"
BUCKET = "bucket"
BLOCK = "block"

#: Micro-batches whose alerts and unreadable messages share a folder.
BLOCK_BATCHES = 1000

# What the folders of a table are merged by, once a day or a block of micro-batches is closed.
PARTS = {"transactions": DAY, "fraud_alerts": BLOCK, "quarantine": BLOCK}

#: So many times as large as what is merged, an older merged folder stays as it is.
LARGER = 2

# Keyed state on the executors' disks; a checkpoint holds what a micro-batch changed, not all keys.
STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def stored_schema() -> StructType:
    """Transactions as stored: keyed by uuid, with the two partition columns."""
    fields = [f for f in schema("transactions") if f.name != "transaction_id"]
    return StructType(fields).add(DAY, "date").add("batch_id", "long")


TABLES = {
    "fraud_alerts": "transaction_uuid STRING, alert_type STRING, risk_level STRING, alert_message STRING,"
                    f" is_resolved BOOLEAN, created_at TIMESTAMP, {BLOCK} BIGINT, batch_id BIGINT",
    "quarantine": f"value BINARY, {BLOCK} BIGINT, batch_id BIGINT",
    "keys": f"transaction_uuid STRING, {BUCKET} INT, batch_id BIGINT",
}


def table_schema(table: str) -> StructType:
    return stored_schema() if table == "transactions" else StructType.fromDDL(TABLES[table])


class FileStore:
    """Parquet folders; transactions by event day and micro-batch, alerts and quarantine by micro-batch.

    A micro-batch owns the files under its batch number, and writing replaces exactly those. So a
    batch that is replayed after a failure, even one that failed between the tables, ends in the
    same state as one that ran once.

    `compact` merges the folders of closed days (for alerts and quarantine, of closed blocks of batches) into one, and with
    it those merged before that are not `LARGER` times as large. So a row is merged again only when its folder has grown
    by a share of its size, and a day keeps few merged folders, each much larger than the next.
    What counts is a mark per day with the numbers of its merged folders, the last of them `upto`: the day's rows of batches
    up to it are those of these folders, and all others are in batch folders. The mark appears in one step after the merged
    files. Reading, writing and clearing away go by it: a batch folder that is still there does not count twice, a replay of
    a merged batch writes nothing to that day, and merged files without their mark are not there.

    For `store_batch` uuids are kept a second time, alone, in `buckets` parts by their hash; a batch is compared
    with the parts its own uuids fall into, as stored by other batches. The number of parts is fixed
    when a store is begun.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.spark, self.root, self.buckets = spark, root, buckets

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _read(self, path: str, columns: StructType, below: str = "") -> DataFrame:
        reader = self.spark.read.schema(columns).option("basePath", path)
        try:
            return reader.parquet(f"{path}{below}")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return self.spark.createDataFrame([], columns)
            raise

    def read(self, table: str, below: str = "") -> DataFrame:
        """A table of the store, or the partitions under a path below it; empty before the first write."""
        columns = table_schema(table)
        written = self._read(self.path(table), columns, below)
        marks = self.marks(table) if table in PARTS else {}
        if not marks:
            return written
        # One row per closed day or block: bounded by the calendar, so it may be broadcast.
        marked = F.broadcast(self._marks_table(table, marks))
        part = PARTS[table]
        return written.join(marked, part, "left").where("upto IS NULL OR batch_id > upto").select(
            columns.names
        ).unionAll(self._merged(table, marks).select(columns.names))

    def _merged(self, table: str, marks: dict[str, list[int]]) -> DataFrame:
        """The rows of these merged folders of each day or block."""
        merged = self._read(self.path(f"merged/{table}"), StructType([*table_schema(table)]).add("upto", "long"))
        parts = F.broadcast(self._marks_table(table, marks).select(PARTS[table], F.explode("folders").alias("upto")))
        return merged.join(parts, [PARTS[table], "upto"], "left_semi")

    def marks(self, table: str) -> dict[str, list[int]]:
        """The merged folders of each closed day or block, ascending; the last tells up to which batch it is merged."""
        try:
            rows = self.spark.read.schema("part STRING, upto BIGINT, folders ARRAY<BIGINT>").json(
                self.path(f"marks/{table}")
            ).collect()
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return {}
            raise
        # A mark without folders is of a store that kept one.
        return {row["part"]: row["folders"] or [row["upto"]] for row in rows}

    def _marks_table(self, table: str, marks: dict[str, list[int]]) -> DataFrame:
        of = table_schema(table)[PARTS[table]].dataType
        rows = self.spark.createDataFrame(
            [(part, kept[-1], kept) for part, kept in marks.items()], f"{PARTS[table]} STRING, upto BIGINT, folders ARRAY<BIGINT>"
        )
        return rows.withColumn(PARTS[table], F.col(PARTS[table]).cast(of))

    def write(self, rows: DataFrame, table: str, batch_id: int, by: tuple[str, ...] = ()) -> None:
        """Replace the batch's files; rebalancing keeps them few, however many tasks made the rows."""
        if PARTS.get(table) == BLOCK:
            rows, by = rows.withColumn(BLOCK, F.lit(batch_id // BLOCK_BATCHES).cast("bigint")), (BLOCK,)
        marks = self.marks(table) if table in PARTS else {}
        merged = {part: kept for part, kept in marks.items() if kept[-1] >= batch_id}
        if merged:  # a replay: what the batch stored there is in the merged folder
            rows = rows.join(F.broadcast(self._marks_table(table, merged)), PARTS[table], "left_anti")
        (
            rows.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
            .hint("rebalance", *by)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*by, "batch_id")
            .parquet(self.path(table))
        )

    def folders(self, table: str) -> dict[str, dict[int, str]]:
        """The batch folders of each day or block."""
        found: dict[str, dict[int, str]] = {}
        for path in folders.matching(self.spark, f"{self.path(table)}/{PARTS[table]}=*/batch_id=*"):
            part, batch = (piece.split("=", 1)[1] for piece in path.split("/")[-2:])
            found.setdefault(part, {})[int(batch)] = path
        return found

    def compact(self, before_batch: int, before_day: date, least: int = 2) -> dict[str, list[str]]:
        """Merge what batches below `before_batch` left in at least `least` folders of a closed day or block.

        Days before `before_day` are closed, and blocks that end below `before_batch`. The batches must be
        finished: batch `before_batch` may be running or replayed, no earlier one. Returns the days and
        blocks per table. A run that was stopped anywhere is completed by the next one.
        """
        done = {}
        for table, part in PARTS.items():
            self.clear(table)

            def closed(value: str) -> bool:
                if part == DAY:
                    return value < before_day.isoformat()
                return (int(value) + 1) * BLOCK_BATCHES <= before_batch

            upto = before_batch - 1
            due = {}
            for value, batches in self.folders(table).items():
                paths = [path for batch, path in batches.items() if batch <= upto]
                if closed(value) and len(paths) >= least:
                    due[value] = paths
            done[table] = list(due)
            if not due:
                continue
            marks = self.marks(table)
            kept, again = {}, {}
            for value, paths in due.items():
                kept[value], again[value] = self._layers(table, value, marks.get(value, []), paths)
            of = table_schema(table)[part].dataType
            columns = table_schema(table).names
            # What a mark covers was cleared away above, so all rows of these batches are to be merged.
            rows = self._read(self.path(table), table_schema(table)).where(
                F.col(part).isin([F.lit(value).cast(of) for value in due]) & (F.col("batch_id") <= upto)
            ).select(columns)
            older = {value: numbers for value, numbers in again.items() if numbers}
            if older:
                rows = rows.unionAll(self._merged(table, older).select(columns))
            (
                rows.withColumn("upto", F.lit(upto).cast("bigint"))
                .hint("rebalance", part)
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy(part, "upto")
                .parquet(self.path(f"merged/{table}"))
            )
            for value in due:
                folders.commit(
                    self.spark, self.path(f"marks/{table}/{value}.json"),
                    json.dumps({"part": value, "upto": upto, "folders": [*kept[value], upto]}),
                )
            self.clear(table)
        return done

    def _merged_folder(self, table: str, value: str, number: int | str) -> str:
        return f"{self.path('merged')}/{table}/{PARTS[table]}={value}/upto={number}"

    def _layers(self, table: str, value: str, merged: list[int], paths: list[str]) -> tuple[list[int], list[int]]:
        """The merged folders of a day or block that stay as they are, and those to be merged with these batch folders."""
        if not merged:
            return [], []
        size, at = sum(folders.size(self.spark, path) for path in paths), len(merged)
        while at and (older := folders.size(self.spark, self._merged_folder(table, value, merged[at - 1]))) < LARGER * size:
            size, at = size + older, at - 1
        return merged[:at], merged[at:]

    def clear(self, table: str) -> None:
        """Delete batch folders that a mark covers, and merged folders that are no longer the marked ones."""
        marks, written = self.marks(table), self.folders(table)
        for part, kept in marks.items():
            for batch, path in written.get(part, {}).items():
                if batch <= kept[-1]:
                    folders.delete(self.spark, path)
            for path in folders.matching(self.spark, self._merged_folder(table, part, "*")):
                number = int(path.rsplit("=", 1)[1])
                if number < kept[-1] and number not in kept:
                    folders.delete(self.spark, path)

    def bucketed(self, rows: DataFrame) -> DataFrame:
        part = F.pmod(F.xxhash64("transaction_uuid"), F.lit(self.buckets))
        return rows.withColumn(BUCKET, part.cast("int"))

    def unseen(self, rows: DataFrame, batch_id: int) -> DataFrame:
        """Rows whose uuid no other batch has stored."""
        own = self.bucketed(rows)
        touched = [str(row[0]) for row in own.select(BUCKET).distinct().collect()]  # `buckets` at most
        if not touched:
            return rows
        known = self.read("keys", f"/{BUCKET}={{{','.join(touched)}}}").where(F.col("batch_id") != batch_id)
        return own.join(known, [BUCKET, "transaction_uuid"], "left_anti").select(rows.columns)


#: Whether plans change as they run; without it Spark leaves out `rebalance`, and every task writes a file per folder.
ADAPTIVE = "spark.sql.adaptive.enabled"


@contextmanager
def adaptive(batch: DataFrame) -> Iterator[None]:
    """What a foreachBatch function does with its micro-batch is planned like any batch work.

    A stream's own session plans without AQE, which may not change the partitions of the state. The micro-batch
    itself is planned before the function is called, and the next one finds the session as it was.
    """
    conf = batch.sparkSession.conf
    before = conf.get(ADAPTIVE)
    conf.set(ADAPTIVE, "true")
    try:
        yield
    finally:
        conf.set(ADAPTIVE, before)


def _quarantined(parsed: DataFrame) -> DataFrame:
    return M.malformed(parsed).select(F.col("value").cast("binary").alias("value"))


def store_batch(
    store: FileStore, now: Callable[[], datetime] = utc_now
) -> Callable[[DataFrame, int], None]:
    """The foreachBatch function for a FileStore."""

    def run(batch: DataFrame, batch_id: int) -> None:
        with adaptive(batch):
            parsed = M.parse(M.numbered(batch)).persist()
            rows = (
                M.first_deliveries(M.decode(parsed, now()))
                .withColumn(DAY, F.to_date("transaction_timestamp"))
                .persist()
            )
            # Compared with other batches only, so these are the same rows whenever they are made again.
            fresh = store.unseen(rows, batch_id).persist()
            try:
                store.write(_quarantined(parsed), "quarantine", batch_id)
                store.write(fresh, "transactions", batch_id, (DAY,))
                keys = store.bucketed(fresh).select("transaction_uuid", BUCKET)
                store.write(keys, "keys", batch_id, (BUCKET,))
                store.write(M.high_value_alerts(fresh), "fraud_alerts", batch_id)
            finally:
                for frame in (fresh, rows, parsed):
                    frame.unpersist()

    return run


def store_new(
    store: FileStore, now: Callable[[], datetime] = utc_now, compact_every: int = 100, open_days: int = 2
) -> Callable[[DataFrame, int], None]:
    """The foreachBatch function for a stream `with_new_uuids` over a FileStore.

    Nothing that earlier batches stored is read. Every `compact_every` batches closed days are merged;
    today and the `open_days` before it stay open.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        with adaptive(batch):
            # Kept, so that the state operator below runs once for all that follows.
            whole = M.numbered(batch).persist()
            parsed = M.parse(whole.where(F.col(M.NEW).isNull()).drop(M.NEW))
            markers = whole.where(F.col(M.NEW).isNotNull()).select(F.col(M.NEW).alias("transaction_uuid"))
            fresh = (
                M.first_deliveries(M.decode(parsed, now()))
                .join(markers, "transaction_uuid", "left_semi")
                .withColumn(DAY, F.to_date("transaction_timestamp"))
                .persist()
            )
            try:
                store.write(_quarantined(parsed), "quarantine", batch_id)
                store.write(fresh, "transactions", batch_id, (DAY,))
                store.write(M.high_value_alerts(fresh), "fraud_alerts", batch_id)
                if batch_id and batch_id % compact_every == 0:
                    store.compact(batch_id, now().date() - timedelta(days=open_days))
            finally:
                fresh.unpersist()
                whole.unpersist()

    return run


def start_unique_ingest(
    messages: DataFrame,
    store: FileStore,
    checkpoint: str,
    now: Callable[[], datetime] = utc_now,
    compact_every: int = 100,
    **options,
) -> StreamingQuery:
    """Ingest with the known uuids as keyed state of the stream; a uuid is stored once.

    The state lives in the checkpoint, so a store and its checkpoint belong together: a new checkpoint over
    a store that has transactions is refused. The number of shuffle partitions at the first start
    is that of the state for good. Several streams into one store need `store_batch` instead.
    """
    spark = messages.sparkSession
    if not folders.exists(spark, f"{checkpoint}/offsets") and folders.exists(spark, store.path("transactions")):
        raise ValueError(f"{store.root} has transactions, but {checkpoint} does not know their uuids")
    for key, value in STATE.items():
        spark.conf.set(key, value)
    return start_ingest(M.with_new_uuids(messages), store_new(store, now, compact_every), checkpoint, **options)


class TableStore:
    """Tables of a database that numbers transactions itself.

    `read(table)` gives the columns of `COMPARED_COLUMNS` of all stored rows and `append(table, rows)`
    adds rows. Appends cannot be replaced, so a replayed batch is compared with what its first
    attempt stored: transactions by uuid, alerts by transaction and type. Alerts are raised on
    what is stored under the batch's uuids, not on what a later delivery of them says.
    """

    def __init__(
        self, read: Callable[[str], DataFrame], append: Callable[[str, DataFrame], None]
    ):
        self.read = read
        self.append = append

    def store(self, rows: DataFrame) -> None:
        uuids = rows.select("transaction_uuid")
        known = self.read("transactions").select("transaction_uuid").join(
            uuids, "transaction_uuid", "left_semi"
        )
        self.append("transactions", rows.drop(DAY).join(known, "transaction_uuid", "left_anti"))
        stored = self.read("transactions").join(uuids, "transaction_uuid", "left_semi")
        numbered = M.with_stored_ids(M.high_value_alerts(stored), stored)
        raised = self.read("fraud_alerts").select("transaction_id", "alert_type")
        self.append(
            "fraud_alerts",
            numbered.drop("transaction_uuid").join(
                raised, ["transaction_id", "alert_type"], "left_anti"
            ),
        )


COMPARED_COLUMNS = {
    "transactions": "transaction_id, transaction_uuid, amount",
    "fraud_alerts": "transaction_id, alert_type",
}


def database_store(
    spark: SparkSession, url: str, properties: dict[str, str] | None = None, connections: int = 16
) -> TableStore:
    """A TableStore over JDBC; keys are read over `connections` connections, in parts by the id."""

    def read(table: str) -> DataFrame:
        return read_split(spark, url, *keys_query(table, connections), properties)

    def append(table: str, rows: DataFrame) -> None:
        write_table(rows, url, table, "append", properties, connections)

    return TableStore(read, append)


def keys_query(table: str, parts: int) -> tuple[str, list[str]]:
    """(SQL for a table's keys, conditions that split it evenly by transaction id)."""
    return (
        f"(SELECT {COMPARED_COLUMNS[table]} FROM {table}) AS compared",
        hash_predicates("transaction_id", parts),
    )


def store_batch_in_tables(
    store: TableStore,
    quarantine: Callable[[DataFrame], None],
    now: Callable[[], datetime] = utc_now,
) -> Callable[[DataFrame, int], None]:
    """The foreachBatch function for a TableStore."""

    def run(batch: DataFrame, batch_id: int) -> None:
        with adaptive(batch):
            parsed = M.parse(M.numbered(batch)).persist()
            rows = (
                M.first_deliveries(M.decode(parsed, now()))
                .withColumn(DAY, F.to_date("transaction_timestamp"))
                .persist()
            )
            try:
                quarantine(_quarantined(parsed).withColumn("batch_id", F.lit(batch_id)))
                store.store(rows)
            finally:
                rows.unpersist()
                parsed.unpersist()

    return run


def start_ingest(
    messages: DataFrame,
    process: Callable[[DataFrame, int], None],
    checkpoint: str,
    available_now: bool = False,
    interval: str = "10 seconds",
) -> StreamingQuery:
    """Run a stream of messages (`value`) through a batch function; the checkpoint keeps offsets."""
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return (
        messages.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(process)
        .trigger(**trigger)
        .start()
    )
