"""Message format: encoding, decoding, deduplication, alerts. All work on batch and stream alike."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..operators.cleaning import conform_defaults
from ..operators.keys import first_per_key

# Fields of the JSON message. Metadata keeps whatever keys it has, as JSON text.
MESSAGE_SCHEMA = """
    transaction_id STRING, merchant_id BIGINT, customer_id BIGINT, amount DECIMAL(15,2),
    currency STRING, payment_type STRING, transaction_status STRING, customer_ip STRING,
    timestamp STRING, gateway_id INT, metadata STRING"""
# End of fixed values.

# Fields a message must have, if only as null; metadata may be missing.
REQUIRED_FIELDS = (
    "transaction_id", "merchant_id", "customer_id", "gateway_id", "amount", "currency",
    "transaction_status", "payment_type", "customer_ip", "timestamp",
)
# End of fixed values.

CORRUPT = "_corrupt"

# Where a message stands in its source; sources add it, and earlier means delivered earlier.
POSITION = "_position"


def message_key(customer_id: Column) -> Column:
    return F.concat(F.lit(rules.MESSAGE_KEY_PREFIX), customer_id.cast("string"))


def encode(transactions: DataFrame) -> DataFrame:
    """Rows as (key, value); the key keeps a customer's messages in one topic partition, in order."""
    at = F.date_format("transaction_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    body = F.struct(
        F.col("transaction_uuid").alias("transaction_id"),
        "merchant_id",
        "customer_id",
        "amount",
        "currency",
        "payment_type",
        "transaction_status",
        "customer_ip",
        at.alias("timestamp"),
        "gateway_id",
        F.try_parse_json("metadata").alias("metadata"),
    )
    return transactions.select(
        message_key(F.col("customer_id")).alias("key"), F.to_json(body, {"ignoreNullFields": "false"}).alias("value")
    )


def numbered(batch: DataFrame) -> DataFrame:
    """A micro-batch whose positions also tell the lines of one file apart, by their order in a task."""
    if POSITION not in batch.columns:
        return batch
    place = F.struct(F.col(POSITION).alias("source"), F.monotonically_increasing_id().alias("row"))
    return batch.withColumn(POSITION, place)


def parse(messages: DataFrame) -> DataFrame:
    """Messages with their parsed fields in `m` and whether they can be stored in `is_usable`.

    A message that lacks a field (metadata apart), or has no id, amount, status or readable time, is
    no transaction row; it is kept for quarantine instead of stopping the stream. A field that is
    there and null is a null.
    """
    schema = f"{MESSAGE_SCHEMA}, {CORRUPT} STRING"
    text = F.col("value").cast("string")
    # One-element explode: a row still gives one row, but the parsed value becomes a real column.
    # Without it every later use of a field would parse the text again.
    parsed = F.explode(
        F.array(F.from_json(text, schema, {"columnNameOfCorruptRecord": CORRUPT}))
    )
    at = F.col("m.timestamp").try_cast("timestamp")
    required = F.array(*[F.lit(name) for name in REQUIRED_FIELDS])
    # A second, cheap look at the text: the parsed value no longer tells a missing field from a null.
    lacking = F.size(F.array_except(required, F.json_object_keys(text)))
    usable = (
        F.col(f"m.{CORRUPT}").isNull()
        & (lacking == 0)
        & F.col("m.transaction_id").isNotNull()
        & F.col("m.amount").isNotNull()
        & F.col("m.transaction_status").isNotNull()
        & at.isNotNull()
    )
    return messages.withColumn("m", parsed).withColumn("is_usable", F.coalesce(usable, F.lit(False)))


def malformed(parsed: DataFrame) -> DataFrame:
    return parsed.where(~F.col("is_usable")).drop("m", "is_usable")


def decode(parsed: DataFrame, now: datetime) -> DataFrame:
    """Usable messages as transaction rows, columns the message lacks filled with defaults.

    There is no transaction_id: numbering belongs to the database, and a file store keys on the
    uuid. A 64-bit hash would repeat at this table's size.
    """
    position = tuple(c for c in parsed.columns if c == POSITION)
    rows = parsed.where("is_usable").select(
        *position,
        F.col("m.transaction_id").alias("transaction_uuid"),
        "m.merchant_id",
        "m.customer_id",
        F.lit(rules.STREAM_METHOD_ID).alias("payment_method_id"),
        "m.gateway_id",
        "m.amount",
        "m.currency",
        "m.transaction_status",
        "m.payment_type",
        "m.customer_ip",
        F.col("m.timestamp").try_cast("timestamp").alias("transaction_timestamp"),
        F.coalesce("m.metadata", F.lit("{}")).alias("metadata"),
    )
    return conform_defaults("transactions", rows, now, position).drop("transaction_id")


def first_deliveries(rows: DataFrame) -> DataFrame:
    """One row per uuid, the one delivered first; for a batch or one micro-batch.

    That is the one with the least position in the source, whatever its event time, so the outcome
    does not depend on where a batch ends. Rows without a position, or with the same one, are told
    apart by a hash of their content, which at least repeats.
    """
    position = [F.col(c) for c in rows.columns if c == POSITION]
    content = F.xxhash64(*[c for c in rows.columns if c != POSITION])
    return first_per_key(rows, "transaction_uuid", [*position, content]).drop(POSITION)


def deduplicate_stream(rows: DataFrame, horizon: str = "1 day") -> DataFrame:
    """First delivery per uuid with bounded state.

    Like any watermark it also drops rows more than `horizon` late. Use it where that is wanted;
    ingest compares with the store instead and loses nothing.
    """
    return rows.drop(POSITION).withWatermark("transaction_timestamp", horizon).dropDuplicatesWithinWatermark(
        ["transaction_uuid"]
    )


# The uuid of a marker row: the stream has not had it before this micro-batch.
NEW = "_new_uuid"


def with_new_uuids(messages: DataFrame) -> DataFrame:
    """A stream's messages as they are, and beside them one marker row per uuid that was never there before.

    Which uuids are known is the state of `dropDuplicates`: a key per uuid and nothing else, kept by
    its hash. A micro-batch looks up its own uuids, whatever was stored before. The markers do not say which
    delivery counts, as the operator keeps any; `first_deliveries` chooses among the messages.
    """
    uuids = parse(messages).where("is_usable").select(F.col("m.transaction_id").alias(NEW)).dropDuplicates([NEW])
    empty = [F.lit(None).cast(field.dataType).alias(field.name) for field in messages.schema]
    return messages.withColumn(NEW, F.lit(None).cast("string")).unionByName(uuids.select(*empty, NEW))


def high_value_alerts(rows: DataFrame, above: float = rules.HIGH_AMOUNT) -> DataFrame:
    """An alert per transaction above the amount, from the row itself: no lookup is needed."""
    return rows.where(F.col("amount") > above).select(
        "transaction_uuid",
        F.lit(rules.ALERT_TYPE).alias("alert_type"),
        F.lit(rules.ALERT_RISK).alias("risk_level"),
        F.lit(rules.ALERT_MESSAGE).alias("alert_message"),
        F.lit(False).alias("is_resolved"),
        F.current_timestamp().alias("created_at"),
    )


def with_stored_ids(alerts: DataFrame, transactions: DataFrame) -> DataFrame:
    """Alerts with the id their transaction got in the store."""
    ids = transactions.select("transaction_uuid", "transaction_id")
    return alerts.join(ids, "transaction_uuid")
