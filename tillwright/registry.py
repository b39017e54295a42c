"""Every query by name, over the payment tables derived from a folder of given Parquet tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date, datetime, timedelta
from functools import partial
from inspect import signature

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegerType, TimestampType

from . import fixtures
from .operators import cleaning, keys, quality, risk
from .plans import batch, partials, reports
from .session import apply_settings, scratch_path
from .sinks import database, files as file_sinks
from .sources import catalog, files as file_sources
from .streaming import ingest, messages, sources as message_sources

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = date(2024, 1, 31)
COHORT_AS_OF = date(1996, 1, 1)


def comparable(df: DataFrame) -> DataFrame:
    """The types both engines have in common: bigint, double, zoneless timestamp."""
    columns = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, IntegerType):
            column = column.cast("bigint")
        elif isinstance(field.dataType, TimestampType):
            column = column.cast("timestamp_ntz")
        columns.append(column.alias(field.name))
    return df.select(columns)


def over_clean(report: Callable[[Mapping[str, DataFrame]], DataFrame]) -> Query:
    return lambda spark, folder: report(fixtures.clean_tables(spark, folder))


def over_raw(report: Callable[[Mapping[str, DataFrame]], DataFrame]) -> Query:
    return lambda spark, folder: report(fixtures.raw_tables(spark, folder))


# Cleaning and reports.

def _cleaners() -> dict[str, Query]:
    def cleaned(name: str) -> Query:
        return over_clean(lambda tables: tables[name])

    named = {f"clean_{name}": cleaned(name) for name in cleaning.CLEANERS}
    named["conform_defaults"] = over_clean(
        lambda t: cleaning.conform_defaults(
            "transactions",
            t["transactions"].drop("currency", "transaction_timestamp"),
            datetime(2024, 1, 31),
        )
    )
    return named


def _reports() -> dict[str, Query]:
    def dated(report) -> Query:
        # The days a report looks back are its own default; nothing older is read.
        days = signature(report).parameters.get("days")
        since = AS_OF - timedelta(days=days.default) if days else None
        return lambda spark, folder: report(fixtures.clean_tables(spark, folder, since), AS_OF)

    named = {name: dated(report) for name, report in batch.DATED_REPORTS.items()}
    named |= {name: over_clean(report) for name, report in batch.REPORTS.items()}
    named["cohort_retention"] = lambda spark, folder: reports.cohort_retention(
        {"transactions": fixtures.long_range_transactions(spark, folder)}, COHORT_AS_OF
    )
    return named


def _risk() -> dict[str, Query]:
    return {
        "fraud_patterns": over_clean(lambda t: risk.fraud_patterns(t["transactions"])),
        "suspicious_transactions": over_clean(
            lambda t: risk.suspicious_transactions(t["transactions"])
        ),
        "suspicious_count": over_clean(lambda t: risk.suspicious_count(t["transactions"])),
    }


# Data quality. Raw tables keep the defects that cleaning would repair.

def _quality() -> dict[str, Query]:
    def nulls(t):
        return quality.combine([
            quality.check_nulls(t["customers"], "customers", ("customer_id", "phone_number")),
            quality.check_nulls(
                t["payment_methods"], "payment_methods", ("payment_type", "card_brand")
            ),
            quality.check_nulls(t["transactions"], "transactions", ("amount", "processed_timestamp")),
        ])

    def duplicates(t):
        return quality.combine([
            quality.check_duplicates(t["merchants"], "merchants", ("merchant_id", "merchant_email")),
            quality.check_duplicates(t["customers"], "customers", ("customer_email", "phone_number")),
            quality.check_duplicates(
                t["transactions"], "transactions", ("transaction_uuid", "customer_id")
            ),
        ])

    def types(spark, folder):
        expected = {
            "transaction_id": "bigint", "amount": "decimal",
            "transaction_timestamp": "timestamp", "metadata": "struct",
        }
        path = scratch_path(spark, "types")
        file_sinks.write_parquet_tables({"transactions": fixtures.raw_tables(spark, folder)["transactions"]}, path)
        return quality.check_stored_types(spark, f"{path}/transactions", "transactions", expected)

    def ranges(t):
        return quality.combine([
            quality.check_value_ranges(t[name], name, limits)
            for name, limits in quality.VALUE_RANGES.items()
        ])

    def referential(t):
        return quality.combine([
            quality.check_referential_integrity(
                t[child], t[parent], child_key, parent_key, f"{child} -> {parent}"
            )
            for child, child_key, parent, parent_key in quality.REFERENCES
        ])

    def gates(spark, folder):
        raw, clean = fixtures.raw_tables(spark, folder), fixtures.clean_tables(spark, folder)
        suite = quality.Suite(required={
            "customers": ("customer_id", "phone_number"),
            "transactions": ("amount", "processed_timestamp"),
        })
        tables = {"customers": raw["customers"], "transactions": clean["transactions"]}
        return quality.config_gates(tables, suite)

    return {
        "dq_nulls": over_raw(nulls),
        "dq_duplicates": over_raw(duplicates),
        "dq_types": types,
        "dq_ranges": over_raw(ranges),
        "dq_referential": over_raw(referential),
        "dq_orphan_merchants": over_clean(
            lambda t: keys.orphan_keys(t["transactions"], "merchant_id", t["merchants"], "merchant_id")
        ),
        "dq_nonpositive_amount": over_raw(
            lambda t: quality.tally(t["transactions"], "transactions", [quality.nonpositive_amount()])
        ),
        "dq_excess_refund": over_clean(quality.check_excess_refunds),
        "dq_future_timestamp": over_clean(
            lambda t: quality.tally(
                t["transactions"], "transactions", [quality.future_timestamp(date(2024, 1, 25))]
            )
        ),
        "dq_invalid_risk": over_raw(
            lambda t: quality.tally(t["customers"], "customers", [quality.invalid_risk()])
        ),
        "dq_success_unprocessed": over_clean(
            lambda t: quality.tally(t["transactions"], "transactions", [quality.success_unprocessed()])
        ),
        "anomaly_high_amount": over_clean(
            lambda t: quality.high_amounts(t["transactions"]).select(
                "transaction_id", "customer_id", "amount"
            )
        ),
        "anomaly_failed_customers": over_clean(
            lambda t: quality.failed_customers(t["transactions"])
        ),
        "anomaly_odd_hours": over_clean(
            lambda t: quality.odd_hour_transactions(t["transactions"]).select(
                "transaction_id", "customer_id", "transaction_timestamp"
            )
        ),
        "dq_report": over_clean(lambda t: quality.check(t, AS_OF)),
        "dq_is_valid": over_clean(lambda t: quality.verdict(quality.check(t, AS_OF))),
        "dq_config_gates": gates,
    }


# Sources and sinks: write to the shared folder, read back.

def csv_scan(spark: SparkSession, folder: str, table: str = "transactions") -> DataFrame:
    path = scratch_path(spark, "raw")
    raw = fixtures.raw_tables(spark, folder)[table]
    file_sinks.write_csv_tables({table: raw}, path, processed=False)
    rows = file_sources.read_csv_tables(spark, path, (table,))[table]
    times = [f.name for f in raw.schema if f.dataType.simpleString() in file_sources.RAW_TEXT_TYPES]
    return rows.withColumns({name: F.col(name).cast(raw.schema[name].dataType) for name in times})


def csv_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Transactions as CSV, and failed ones again in damaged lines: with a word for the amount, or with a field too many."""
    path = scratch_path(spark, "damaged")
    raw = fixtures.raw_tables(spark, folder)["transactions"]
    file_sinks.write_csv_tables({"transactions": raw}, path, processed=False)
    amount = F.when(F.col("transaction_id") % 2 == 0, "unknown").otherwise(F.concat(F.col("amount").cast("string"), F.lit(",1")))
    # Written without quotes, so that the comma in the amount begins another field.
    raw.where("transaction_status = 'failed'").withColumns({
        "amount": amount, "metadata": F.lit(None).cast("string"), "transaction_uuid": F.lit("again"),
    }).select(*raw.columns).write.mode("append").options(header=True, quote="").csv(f"{path}/transactions.csv")
    good, bad = file_sources.read_csv_apart(spark, f"{path}/transactions.csv", "transactions")
    # The id is the first field of the line as it stands.
    first = F.split_part("line", F.lit(","), F.lit(raw.columns.index("transaction_id") + 1))
    return good.select("transaction_id", "amount", F.lit(False).alias("is_unreadable")).unionAll(
        bad.select(first.cast("bigint"), F.lit(None).cast("decimal(15,2)"), F.lit(True))
    )


def csv_sink(spark: SparkSession, folder: str, table: str = "transactions") -> DataFrame:
    path = scratch_path(spark, "processed")
    file_sinks.write_csv_tables({table: fixtures.clean_tables(spark, folder)[table]}, path)
    return file_sources.read_csv_tables(spark, path, (table,), processed=True)[table]


def _stored_months(spark: SparkSession, folder: str) -> str:
    """A store written in two runs; the second replaces a month and leaves the others."""
    path = scratch_path(spark, "months")
    rows = fixtures.clean_tables(spark, folder)["transactions"].drop(*database.DERIVED_TRANSACTION_COLUMNS)
    file_sinks.write_months(rows, path)
    late = F.col("transaction_timestamp") >= F.lit("2024-01-01").cast("timestamp")
    file_sinks.write_months(rows.where(late), path)
    return path


def kept_sums(report: str) -> Query:
    """A view from day sums kept by month: of a store with too few rows in late months, then of the corrected one."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        rows = fixtures.clean_tables(spark, folder)["transactions"]
        store, sums = scratch_path(spark, "months"), scratch_path(spark, "sums")
        late = F.col("transaction_timestamp") >= F.lit("2024-01-01").cast("timestamp")
        file_sinks.write_months(rows.where(~late | (F.col("transaction_status") == "failed")), store)
        partials.refresh(spark, store, sums)
        file_sinks.write_months(rows.where(late), store)
        partials.refresh(spark, store, sums)
        week = partials.read_sums(spark, store, sums, AS_OF - timedelta(days=7))
        return partials.all_reports(partials.read_sums(spark, store, sums), week, AS_OF)[report]

    return run


def monthly_partitioned_sink(spark: SparkSession, folder: str) -> DataFrame:
    return file_sources.read_months(spark, _stored_months(spark, folder), since=date(2024, 1, 10))


def monthly_store(spark: SparkSession, folder: str) -> DataFrame:
    return file_sources.read_months(spark, _stored_months(spark, folder))


def dated_backup(spark: SparkSession, folder: str, table: str = "refunds") -> DataFrame:
    path = scratch_path(spark, "backups")
    file_sinks.write_backup({table: fixtures.clean_tables(spark, folder)[table]}, path, AS_OF)
    return spark.read.parquet(f"{path}/backup_date={AS_OF}/{table}")


def _loaded(spark: SparkSession, folder: str) -> tuple[str, list[str]]:
    """The ordered load with a file writer in place of a database: (folder, tables in order)."""
    path = scratch_path(spark, "load")
    return path, database.load_tables(
        fixtures.clean_tables(spark, folder),
        lambda name, df: df.write.parquet(f"{path}/{name}"),
    )


def load_order(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per table as loaded, and the columns it was loaded with."""
    path, loaded = _loaded(spark, folder)
    counts = []
    for place, name in enumerate(loaded, 1):
        rows = spark.read.parquet(f"{path}/{name}")
        counts.append(rows.agg(
            F.lit(name).alias("table_name"),
            F.lit(place).cast("bigint").alias("position"),
            F.count("*").alias("row_count"),
            F.lit(",".join(sorted(rows.columns))).alias("columns"),
        ))
    return quality.combine(counts)


def load(spark: SparkSession, folder: str, table: str = "transactions") -> DataFrame:
    """Every value of a table as the ordered load wrote it."""
    path, _ = _loaded(spark, folder)
    return spark.read.parquet(f"{path}/{table}")


def sql_query_scan(spark: SparkSession, folder: str) -> DataFrame:
    since = AS_OF - timedelta(days=7)
    catalog.publish({"transactions": fixtures.clean_tables(spark, folder, since)["transactions"]})
    return catalog.run_sql(
        spark,
        """SELECT to_date(transaction_timestamp) AS date, count(*) AS total_transactions,
                  sum(CASE WHEN transaction_status = 'success' THEN amount ELSE 0 END) AS revenue
           FROM transactions
           WHERE transaction_timestamp >= CAST(:as_of AS DATE) - INTERVAL 7 DAY
           GROUP BY 1 ORDER BY 1 DESC""",
        as_of=str(AS_OF),
    )


def gateway_literals(spark: SparkSession, folder: str) -> DataFrame:
    tables = fixtures.clean_tables(spark, folder)
    per_gateway = tables["transactions"].groupBy("gateway_id").agg(
        F.count("transaction_id").alias("transaction_count")
    )
    return (
        tables["payment_gateways"]
        .drop("created_at")
        .join(per_gateway, "gateway_id", "left")
        .fillna(0, subset=["transaction_count"])
    )


def table_views(spark: SparkSession, folder: str) -> DataFrame:
    catalog.publish(fixtures.clean_tables(spark, folder))
    return catalog.run_sql(
        spark,
        """SELECT transaction_date, count(*) AS merchants, sum(total_transactions) AS transactions,
                  sum(total_revenue) AS revenue,
                  (SELECT count(*) FROM high_risk_customers) AS high_risk_customers
           FROM daily_transaction_summary GROUP BY transaction_date ORDER BY transaction_date""",
    )


# Streaming.

STREAM_COLUMNS = (
    "transaction_uuid", "merchant_id", "customer_id", "payment_method_id", "gateway_id", "amount",
    "currency", "transaction_status", "payment_type", "transaction_timestamp", "metadata",
    "is_test_transaction",
)


def _to_send(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = fixtures.clean_tables(spark, folder)["transactions"]
    return cleaning.conform_defaults("transactions", cleaned, datetime(2024, 1, 31))


def _redelivered(spark: SparkSession, folder: str) -> DataFrame:
    """Second deliveries of failed transactions, with other amounts and on another day."""
    failed = _to_send(spark, folder).where("transaction_status = 'failed'")
    return failed.withColumns({
        "amount": F.col("amount") + 1000,
        "transaction_timestamp": F.col("transaction_timestamp") - F.expr("INTERVAL 40 DAYS"),
    })


def _incomplete(spark: SparkSession, folder: str) -> DataFrame:
    """Messages that are JSON but lack fields, and event texts that are no messages at all."""
    events = fixtures.given(spark, folder, "events")
    return events.where("event_type = 'error'").select(F.col("props").alias("value")).unionAll(
        events.where("event_type = 'signup'").select(
            F.format_string('{"transaction_id":"part-%d","amount":5,"currency":null}', "event_id").alias("value")
        )
    )


def _decoded(encoded: DataFrame) -> DataFrame:
    return messages.decode(messages.parse(encoded), datetime(2024, 1, 31))


def decode_transactions(spark: SparkSession, folder: str) -> DataFrame:
    return _decoded(messages.encode(_to_send(spark, folder))).select(*STREAM_COLUMNS)


def stream_dedup(spark: SparkSession, folder: str) -> DataFrame:
    deliveries = [
        messages.encode(rows).withColumn(messages.POSITION, F.lit(place))
        for place, rows in enumerate((_to_send(spark, folder), _redelivered(spark, folder)))
    ]
    received = _decoded(quality.combine(deliveries))
    return messages.first_deliveries(received).select(*STREAM_COLUMNS)


def stream_fraud_alerts(spark: SparkSession, folder: str) -> DataFrame:
    received = _decoded(messages.encode(_to_send(spark, folder)))
    return messages.high_value_alerts(received).drop("created_at")


def stream_alert_lookup(spark: SparkSession, folder: str) -> DataFrame:
    stored = _to_send(spark, folder)
    alerts = messages.high_value_alerts(_decoded(messages.encode(stored)))
    return messages.with_stored_ids(alerts, stored).select(
        "transaction_id", "transaction_uuid", "alert_type"
    )


def stream_publish(spark: SparkSession, folder: str) -> DataFrame:
    """The published key, and fields of the published JSON."""
    return messages.encode(_to_send(spark, folder)).select(
        "key",
        F.get_json_object("value", "$.transaction_id").alias("transaction_uuid"),
        F.get_json_object("value", "$.amount").cast("decimal(15,2)").alias("amount"),
        F.get_json_object("value", "$.metadata").alias("metadata"),
    )


def stream_probe(spark: SparkSession, folder: str) -> DataFrame:
    return message_sources.probe(messages.encode(_to_send(spark, folder)))


#: Whether Spark makes as many partitions as there are cores before it goes by their size.
BY_CORES = "spark.sql.adaptive.coalescePartitions.parallelismFirst"


def _ingested(spark: SparkSession, folder: str, compact_every: int = 100) -> ingest.FileStore:
    """Run the stream to its end: all messages, then second deliveries and unusable ones."""
    root = scratch_path(spark, "stream")
    sent = messages.encode(_to_send(spark, folder)).select("value")
    again = messages.encode(_redelivered(spark, folder)).select("value")
    # Files by size, whatever number of tasks makes them or cores there are: every two of them are a micro-batch.
    by_cores = spark.conf.get(BY_CORES)
    spark.conf.set(BY_CORES, "false")
    try:
        for part in (sent, again, _incomplete(spark, folder)):
            part.hint("rebalance").write.mode("append").text(f"{root}/inbox")
    finally:
        spark.conf.set(BY_CORES, by_cores)
    store = ingest.FileStore(spark, f"{root}/store")
    stream = message_sources.file_stream(spark, f"{root}/inbox", max_files=2)
    ingest.start_unique_ingest(
        stream, store, f"{root}/checkpoint", lambda: datetime(2024, 1, 31), compact_every, available_now=True
    ).awaitTermination()
    return store


def stream_ingest(spark: SparkSession, folder: str) -> DataFrame:
    store = _ingested(spark, folder)
    alerted = store.read("fraud_alerts").select("transaction_uuid", F.lit(True).alias("has_alert"))
    return (
        store.read("transactions")
        .select(*STREAM_COLUMNS)
        .join(alerted, "transaction_uuid", "left")
        .fillna(False, subset=["has_alert"])
    )


def stream_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    return _ingested(spark, folder).read("quarantine").groupBy(
        F.col("value").cast("string").alias("value")
    ).agg(F.count("*").alias("messages"))


def stream_compaction(spark: SparkSession, folder: str) -> DataFrame:
    """Days as stored after merging, while the stream runs and at its end; all days are closed then."""
    store = _ingested(spark, folder, compact_every=1)
    last = max(batch for batches in store.folders("transactions").values() for batch in batches)
    store.compact(last + 1, date(9999, 12, 31), least=1)
    left = {day: len(batches) for day, batches in store.folders("transactions").items()}
    return store.read("transactions").groupBy(ingest.DAY).agg(
        F.count("*").alias("transactions"),
        F.sum("amount").alias("amount"),
        F.lit(max(left.values(), default=0)).alias("batch_folders"),
    )


KEPT_REPORTS = ("daily_transaction_summary", "run_metrics", "summary_report", "weekly_report", "weekly_report_totals")

FUNCTIONS = (
    csv_scan, csv_quarantine, csv_sink, monthly_partitioned_sink, monthly_store, dated_backup, load_order, load,
    sql_query_scan,
    gateway_literals, table_views, decode_transactions, stream_dedup, stream_fraud_alerts,
    stream_alert_lookup, stream_publish, stream_probe, stream_ingest, stream_quarantine,
    stream_compaction,
)


def queries() -> dict[str, Query]:
    named = {**_cleaners(), **_reports(), **_risk(), **_quality()}
    named |= {function.__name__: function for function in FUNCTIONS}
    named |= {f"kept_{report}": kept_sums(report) for report in KEPT_REPORTS}
    # The file queries take one table at a time; the plain names stand for their default table.
    usual_tables = {csv_scan: "transactions", csv_sink: "transactions", load: "transactions", dated_backup: "refunds"}
    for query, usual in usual_tables.items():
        others = [table for table in fixtures.RAW_TABLES if table != usual]
        named |= {f"{query.__name__}_{table}": partial(query, table=table) for table in others}

    def registered(query: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return comparable(query(apply_settings(spark), folder))

        return run

    return {name: registered(query) for name, query in named.items()}
