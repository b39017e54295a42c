"""Inline literals, published views and SQL strings."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from ..functions import rules
from ..operators.cleaning import conform_defaults
from ..plans import summaries


def payment_gateways(spark: SparkSession, now: datetime) -> DataFrame:
    """The gateway dimension.

    Written as VALUES: Spark then knows its exact size and can broadcast it without a hint.
    """
    rows = ", ".join(str(row) for row in rules.GATEWAYS)
    listed = spark.sql(
        f"SELECT * FROM VALUES {rows} AS g(gateway_id, gateway_name, gateway_type, api_version)"
    )
    return conform_defaults("payment_gateways", listed, now)


def publish(tables: Mapping[str, DataFrame]) -> None:
    """Register every table, and the two summary views, for SQL users."""
    for name, table in tables.items():
        table.createOrReplaceTempView(name)
    if "transactions" in tables:
        summaries.daily_transaction_summary(tables).createOrReplaceTempView(
            "daily_transaction_summary"
        )
    if {"customers", "transactions", "fraud_alerts"} <= tables.keys():
        summaries.high_risk_customers(tables).createOrReplaceTempView("high_risk_customers")


def run_sql(spark: SparkSession, query: str, **parameters) -> DataFrame:
    """A SQL string over the published views; named markers (`:name`) take the parameters."""
    return spark.sql(query, args=parameters or None)
