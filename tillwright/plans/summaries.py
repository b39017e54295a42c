"""The two published views and the metrics of a run."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import expressions as X
from ..functions import rules
from .common import Tables, day, recent


def daily_transaction_summary(tables: Tables) -> DataFrame:
    return (
        tables["transactions"]
        .groupBy(day().alias("transaction_date"), "merchant_id")
        .agg(
            F.count("*").alias("total_transactions"),
            X.orders().alias("successful_transactions"),
            F.count_if(X.has_status(rules.FAILED)).alias("failed_transactions"),
            X.revenue().alias("total_revenue"),
            X.mean(X.revenue(), X.orders()).alias("avg_transaction_value"),
        )
    )


def high_risk_customers(tables: Tables) -> DataFrame:
    """Customers above the risk score or blocked, with their transactions and alerts.

    A failed transaction counts once per alert on it, as in a chain of left joins, and repeated
    transaction ids count once but fail each time. Few customers qualify, so their ids thin out the
    transactions first (a runtime filter does it at the scan where that pays), and only those left
    move: to one row per transaction, which meets its alerts by id, and then to one per customer.
    """
    people = (
        tables["customers"]
        .where((F.col("risk_score") > rules.HIGH_RISK_SCORE) | F.col("is_blocked"))
        .select("customer_id", "customer_email", "customer_name", "risk_score")
    )
    alerts = tables["fraud_alerts"].groupBy("transaction_id").agg(
        F.count("*").alias("alert_rows"), F.count_distinct("alert_id").alias("alerts")
    )
    own = (
        tables["transactions"]
        .select("customer_id", "transaction_id", X.has_status(rules.FAILED).alias("is_failed"))
        .join(people.select("customer_id"), "customer_id", "left_semi")
        .groupBy("customer_id", "transaction_id")
        .agg(F.count_if("is_failed").alias("failures"))
    )
    activity = (
        own.join(alerts, "transaction_id", "left")
        .groupBy("customer_id")
        .agg(
            F.count("transaction_id").alias("total_transactions"),
            F.sum(F.coalesce("alerts", F.lit(0))).alias("fraud_alerts_count"),
            F.sum(F.col("failures") * F.coalesce("alert_rows", F.lit(1))).alias("failed_transactions"),
        )
    )
    return people.join(activity, "customer_id", "left").fillna(
        0, subset=["total_transactions", "fraud_alerts_count", "failed_transactions"]
    )


def metric_columns() -> list[Column]:
    """Totals over transactions; empty sums are 0, empty means are null."""
    refunded = X.amount_where(X.has_status(rules.REFUNDED))
    return [
        F.count("*").alias("total_transactions"),
        _zero_if_empty(X.revenue()).alias("total_revenue"),
        X.mean(X.revenue(), X.orders()).alias("avg_transaction_value"),
        X.percent(X.orders(), F.count("*")).alias("success_rate"),
        _zero_if_empty(refunded).alias("total_refunded"),
    ]


def run_metrics(tables: Tables) -> DataFrame:
    """One row of totals."""
    return tables["transactions"].agg(*metric_columns())


def summary_report(tables: Tables, generated_at: date | datetime) -> DataFrame:
    """The metrics as display text."""
    return as_text(run_metrics(tables), generated_at)


def as_text(metrics: DataFrame, generated_at: date | datetime) -> DataFrame:
    rounded = F.format_string
    return metrics.select(
        F.date_format(X.instant(generated_at), "yyyy-MM-dd HH:mm:ss").alias("report_date"),
        F.format_number("total_transactions", 0).alias("total_transactions"),
        F.concat(F.lit("$"), F.format_number("total_revenue", 2)).alias("total_revenue"),
        rounded("%s%%", F.col("success_rate").cast("decimal(9,2)")).alias("success_rate"),
        rounded("$%s", F.col("avg_transaction_value").cast("decimal(17,2)")).alias(
            "average_transaction"
        ),
    )


def weekly_report(tables: Tables, as_of: date, days: int = 7) -> DataFrame:
    """Daily totals; the mean covers all statuses."""
    amount = F.col("amount")
    return (
        recent(tables, as_of, days)
        .groupBy(day().alias("date"))
        .agg(
            F.count("*").alias("total_transactions"),
            X.revenue().alias("revenue"),
            X.mean(F.sum(amount), F.count(amount)).alias("avg_transaction"),
        )
        .orderBy(F.desc_nulls_first("date"))
    )


def weekly_report_totals(tables: Tables, as_of: date, days: int = 7) -> DataFrame:
    return totals_of_days(weekly_report(tables, as_of, days))


def totals_of_days(daily: DataFrame) -> DataFrame:
    transactions = F.col("total_transactions")
    return daily.agg(
        _zero_if_empty(F.sum("revenue")).alias("total_revenue"),
        X.mean(F.sum(transactions), F.count(transactions)).alias("average_daily_transactions"),
    )


def _zero_if_empty(total):
    return F.coalesce(total, F.lit(0).cast("decimal(25,2)"))
