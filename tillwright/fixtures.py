"""Payment tables derived from the benchmark's star-schema Parquet tables.

`raw_tables` are deliberately untidy cleaner inputs; `clean_tables` went through the cleaners.
Everything is a lazy projection of the given files, so work grows with them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from datetime import date, datetime, timedelta
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.cleaning import CLEANERS
from .sources.catalog import payment_gateways

LOADED_AT = datetime(2024, 1, 1)
REFUND_DAYS = 12

# Columns of the given files that are used; naming them saves a look into every file.
GIVEN_COLUMNS = {
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "nation": "n_nationkey INT, n_name STRING",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT",
    "events": """event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING,
                 value DOUBLE, props STRING""",
    "orders": """o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,
                 o_orderdate TIMESTAMP_NTZ""",
}


def given(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(GIVEN_COLUMNS[name]).parquet(f"{folder}/{name}.parquet")


def pick(index: str, *values: str) -> str:
    """SQL for the value at a 0-based index; beyond the end the last one."""
    cases = " ".join(f"WHEN {i} THEN '{value}'" for i, value in enumerate(values[:-1]))
    return f"CASE {index} {cases} ELSE '{values[-1]}' END"


def payment_type(index: str) -> str:
    return pick(index, "credit_card", "debit_card", "wallet", "upi", "net_banking")


def merchants_raw(spark: SparkSession, folder: str) -> DataFrame:
    suppliers, nations = given(spark, folder, "supplier"), given(spark, folder, "nation")
    return suppliers.join(nations, suppliers["s_nationkey"] == nations["n_nationkey"]).selectExpr(
        "s_suppkey AS merchant_id",
        "concat('  ', s_name, ' ') AS merchant_name",
        "concat('Sales', CAST(s_suppkey AS STRING), '@Example.org') AS merchant_email",
        "concat('trade ', CAST(s_suppkey % 6 AS STRING)) AS business_type",
        "n_name AS country",
        "upper(substr(n_name, 1, 3)) AS currency",
        "CAST(s_acctbal / 800 AS DECIMAL(5,2)) AS commission_rate",
        "s_suppkey % 4 <> 0 AS is_verified",
        "TIMESTAMP '2022-06-01 00:00:00' AS created_at",
    )


def customers_raw(spark: SparkSession, folder: str) -> DataFrame:
    customers, nations = given(spark, folder, "customer"), given(spark, folder, "nation")
    return customers.join(nations, customers["c_nationkey"] == nations["n_nationkey"]).selectExpr(
        "c_custkey AS customer_id",
        "concat(' Cust', CAST(c_custkey AS STRING), '@Example.org ') AS customer_email",
        "concat(c_name, ' ') AS customer_name",
        """CASE WHEN c_custkey % 7 <> 0
                THEN concat('+1-555-', CAST(10000 + c_custkey AS STRING)) END AS phone_number""",
        "n_name AS country",
        "DATE '2021-01-01' AS customer_since",
        "CAST((c_custkey * 37) % 121 - 10 AS INT) AS risk_score",
        "(c_custkey * 37) % 121 - 10 > 85 AS is_blocked",
        "TIMESTAMP '2021-01-01 00:00:00' AS created_at",
    )


def payment_methods_raw(spark: SparkSession, folder: str) -> DataFrame:
    numbered = given(spark, folder, "customer").selectExpr(
        "c_custkey", "explode(sequence(0L, c_custkey % 3)) AS i"
    )
    is_card = "(c_custkey + i) % 5 < 2"
    return numbered.selectExpr(
        "c_custkey * 3 + i AS payment_method_id",
        "c_custkey AS customer_id",
        f"{payment_type('(c_custkey + i) % 5')} AS payment_type",
        f"CASE WHEN {is_card} THEN CAST(1000 + c_custkey % 9000 AS STRING) END AS card_last_4",
        f"CASE WHEN {is_card} THEN concat('brand ', CAST(c_custkey % 3 AS STRING)) END AS card_brand",
        "i = 0 AS is_default",
        "(c_custkey + i) % 4 <> 0 AS is_active",
        "TIMESTAMP '2022-01-01 00:00:00' AS created_at",
    )


def transactions_raw(spark: SparkSession, folder: str, since: date | None = None) -> DataFrame:
    """One charge per event; every fiftieth event is charged again 30 seconds later.

    `since` reads events from a day before that date on only: reports over the last days put it on
    the time as given, so the files' statistics skip the rest. What is too much they drop themselves.
    """
    events = given(spark, folder, "events")
    if since is not None:
        events = events.where(F.col("ts") >= F.lit(f"{since - timedelta(days=1)}").cast("timestamp_ntz"))
    merchants = given(spark, folder, "supplier").agg(F.count("*")).scalar()
    is_pending = "(event_type = 'signup' AND event_id % 3 = 0)"
    charged = events.selectExpr(
        "*",
        "explode(CASE WHEN event_id % 50 = 1 THEN array(0, 1) ELSE array(0) END) AS b",
        "CAST(ts AS TIMESTAMP) AS at",
    ).withColumn("merchants", merchants)
    return charged.selectExpr(
        "event_id * 2 + b AS transaction_id",
        "concat('tx-', CAST(event_id AS STRING), '-', CAST(b AS STRING)) AS transaction_uuid",
        """CASE WHEN event_id % 499 = 0 THEN -1L
                ELSE (event_id * 7 + user_id) % merchants END AS merchant_id""",
        """CASE WHEN event_id % 3 = 0 THEN user_id
                ELSE user_id * 10 + event_id % 10 END AS customer_id""",
        "CAST(1 + event_id % 4 AS INT) AS gateway_id",
        """CAST(CASE WHEN event_id % 97 = 0 THEN -1 ELSE 1 END
                * CAST(round(value * 10, 2) AS DECIMAL(15,2)) AS DECIMAL(15,2)) AS amount""",
        "'USD' AS currency",
        f"""CASE WHEN event_type IN ('purchase', 'view') THEN ' Success'
                 WHEN event_type = 'click' AND event_id % 5 = 0 THEN 'REFUNDED '
                 WHEN {is_pending} THEN 'pending'
                 WHEN event_type IN ('click', 'signup') THEN 'success'
                 ELSE 'Failed' END AS transaction_status""",
        f"{payment_type('event_id % 5')} AS payment_type",
        "at + b * INTERVAL '30' SECOND AS transaction_timestamp",
        f"""CASE WHEN event_id % 211 = 0 OR {is_pending} THEN NULL
                 ELSE at + (b * 30 + 1 + event_id % 30) * INTERVAL '1' SECOND
            END AS processed_timestamp""",
        "props AS metadata",
    )


def fraud_alerts_raw(spark: SparkSession, folder: str, since: date | None = None) -> DataFrame:
    level = pick(
        "CAST(floor(transaction_id / 20) AS BIGINT) % 4", "LOW", "Medium", "high", "critical"
    )
    numbered = transactions_raw(spark, folder, since).where("transaction_id % 20 = 6").selectExpr(
        "transaction_id",
        "transaction_timestamp",
        "explode(CASE WHEN transaction_id % 40 = 6 THEN array(0, 1) ELSE array(0) END) AS j",
    )
    return numbered.selectExpr(
        "transaction_id * 2 + j AS alert_id",
        "transaction_id",
        "concat('alert ', CAST(transaction_id % 3 AS STRING)) AS alert_type",
        f"{level} AS risk_level",
        "transaction_id % 7 < 4 AS is_resolved",
        "CASE WHEN transaction_id % 7 < 3 THEN 'analyst' END AS resolved_by",
        "transaction_timestamp AS created_at",
        """CASE WHEN transaction_id % 7 < 4
                THEN transaction_timestamp + (1 + transaction_id % 48) * INTERVAL '1' HOUR
           END AS resolved_at""",
    )


def refunds_raw(spark: SparkSession, folder: str, since: date | None = None) -> DataFrame:
    """Refunds are asked for up to `REFUND_DAYS` days after the transaction."""
    paid = None if since is None else since - timedelta(days=REFUND_DAYS)
    status = pick("transaction_id % 3", "Processed", "pending", "rejected")
    returned = transactions_raw(spark, folder, paid).where(
        "lower(trim(transaction_status)) = 'refunded'"
    )
    return returned.selectExpr(
        "transaction_id AS refund_id",
        "transaction_id",
        """CAST(CASE WHEN transaction_id % 50 = 0 THEN abs(amount) * 3
                     WHEN transaction_id % 7 = 0 THEN -abs(amount)
                     ELSE abs(amount) END AS DECIMAL(15,2)) AS refund_amount""",
        "concat('reason ', CAST(transaction_id % 4 AS STRING)) AS refund_reason",
        f"{status} AS refund_status",
        "transaction_timestamp + (transaction_id % 13) * INTERVAL '1' DAY AS requested_at",
        "transaction_timestamp + (transaction_id % 17) * INTERVAL '1' DAY AS processed_at",
    )


RAW_TABLES = {
    "merchants": merchants_raw,
    "customers": customers_raw,
    "payment_methods": payment_methods_raw,
    "transactions": transactions_raw,
    "fraud_alerts": fraud_alerts_raw,
    "refunds": refunds_raw,
}


class LazyTables(Mapping):
    """Tables that are planned when first asked for, since opening files takes time."""

    def __init__(self, makers: Mapping[str, Callable[[], DataFrame]]):
        self._makers = makers
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._makers[name]()
        return self._made[name]

    def __contains__(self, name: object) -> bool:
        return name in self._makers

    def __iter__(self) -> Iterator[str]:
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)


#: Tables that hold dated facts; the others are read whole.
DATED = ("transactions", "fraud_alerts", "refunds")


def _raw(spark: SparkSession, folder: str, name: str, since: date | None) -> DataFrame:
    make = RAW_TABLES[name]
    return make(spark, folder, since) if name in DATED else make(spark, folder)


def raw_tables(spark: SparkSession, folder: str) -> LazyTables:
    return LazyTables({name: partial(_raw, spark, folder, name, None) for name in RAW_TABLES})


def clean_tables(spark: SparkSession, folder: str, since: date | None = None) -> LazyTables:
    """`since`: no report over these tables asks for facts before that date."""
    makers = {
        name: lambda name=name: CLEANERS[name](_raw(spark, folder, name, since)) for name in RAW_TABLES
    }
    makers["payment_gateways"] = lambda: payment_gateways(spark, LOADED_AT)
    return LazyTables(makers)


def long_range_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as transactions: several years, for the cohort report."""
    return given(spark, folder, "orders").selectExpr(
        "o_orderkey AS transaction_id",
        "o_custkey AS customer_id",
        "CAST(o_orderdate AS TIMESTAMP) AS transaction_timestamp",
        """CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'failed'
                ELSE 'pending' END AS transaction_status""",
        "CAST(o_totalprice AS DECIMAL(15,2)) AS amount",
    )
