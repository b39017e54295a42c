"""Transaction profiles: success by merchant and type, hours, customer value."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import expressions as X
from ..functions import rules
from .common import Tables, hour

AMOUNT = "amount"


def success_rate_by_merchant_type(tables: Tables) -> DataFrame:
    """The ids end the sort key: rates tie in masses, and ties on one key cannot be range-split."""
    return (
        tables["transactions"]
        .groupBy("merchant_id", "payment_type")
        .agg(
            F.count("*").alias("total_transactions"),
            X.orders().alias("successful"),
            F.count_if(X.has_status(rules.FAILED)).alias("failed"),
            X.mean(F.sum(AMOUNT), F.count(AMOUNT)).alias("avg_transaction_amount"),
            X.percent(X.orders(), F.count("*")).alias("success_rate"),
        )
        .orderBy(F.desc("success_rate"), "merchant_id", "payment_type")
    )


def hourly_patterns(tables: Tables) -> DataFrame:
    """Revenue here is the amount of all statuses."""
    return (
        tables["transactions"]
        .groupBy(hour().alias("hour"))
        .agg(
            F.count("*").alias("transaction_count"),
            F.sum(AMOUNT).alias("total_revenue"),
            X.mean(F.sum(AMOUNT), F.count(AMOUNT)).alias("avg_amount"),
        )
        .orderBy("hour")
    )


def customer_clv_success_only(tables: Tables) -> DataFrame:
    return (
        tables["transactions"]
        .where(X.succeeded())
        .groupBy("customer_id")
        .agg(
            F.count("*").alias("total_transactions"),
            F.sum(AMOUNT).alias("lifetime_value"),
            X.mean(F.sum(AMOUNT), F.count(AMOUNT)).alias("avg_transaction_value"),
            F.max("transaction_timestamp").alias("last_transaction"),
            F.min("transaction_timestamp").alias("first_transaction"),
        )
        .withColumn("customer_segment", X.segment(F.col("lifetime_value")))
        .orderBy(F.desc("lifetime_value"), "customer_id")
    )
