"""The ten business reports.

Facts are aggregated on the join key before they meet a dimension. Partial aggregation runs before
the shuffle, so a merchant, customer or gateway that owns a third of all rows reaches the join as
one row, and no dimension has to fit into a broadcast.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import expressions as X
from ..functions import rules
from ..operators.bitmaps import by_bucket, counted, distinct_ids
from .common import Tables, day, hour, recent, since


def daily_revenue(tables: Tables, as_of: date, days: int = 30) -> DataFrame:
    """Totals per day, with distinct customers and merchants, from one scan.

    A row becomes two narrow ones, one per counted id, and only the first carries the totals. They are grouped by
    day, id column and bucket of 32,768 ids; a group is a bitmap of 4 KB however many rows it has, so a merchant with a
    third of all rows is a bit. Bitmaps count exactly; null ids have no bucket and no bit.
    """
    dated = recent(tables, as_of, days).withColumn("transaction_date", day())
    parts = by_bucket(
        dated, ["transaction_date"], ["customer_id", "merchant_id"], ["amount", "transaction_status"],
        {
            "rows": counted(),
            "revenue": X.revenue(),
            "orders": X.orders(),
            "failed": F.count_if(X.has_status(rules.FAILED)),
            "refunded": X.amount_where(X.has_status(rules.REFUNDED)),
        },
    )
    return (
        parts.groupBy("transaction_date")
        .agg(
            F.sum("rows").alias("total_transactions"),
            distinct_ids(0).alias("unique_customers"),
            distinct_ids(1).alias("unique_merchants"),
            F.sum("revenue").alias("total_revenue"),
            F.sum("failed").alias("failed_count"),
            F.sum("refunded").alias("refunded_amount"),
            X.mean2(F.sum("revenue"), F.sum("orders")).alias("avg_transaction_value"),
            X.percent2(F.sum("orders"), F.sum("rows")).alias("success_rate_pct"),
        )
        .orderBy(F.desc_nulls_first("transaction_date"))
    )


def top_merchants(
    tables: Tables, as_of: date, days: int = 30, min_transactions: int = 10, limit: int = 20
) -> DataFrame:
    totals = (
        recent(tables, as_of, days)
        .groupBy("merchant_id")
        .agg(
            F.count("transaction_id").alias("total_transactions"),
            X.revenue().alias("total_revenue"),
            X.mean2(X.revenue(), X.orders()).alias("avg_order_value"),
            X.percent2(X.orders(), F.count("*")).alias("success_rate_pct"),
            F.count_distinct("customer_id").alias("unique_customers"),
        )
        .where(F.col("total_transactions") >= min_transactions)
    )
    names = tables["merchants"].select("merchant_id", "merchant_name", "business_type")
    return (
        totals.join(names, "merchant_id")
        .select(
            "merchant_id", "merchant_name", "business_type", "total_transactions",
            "total_revenue", "avg_order_value", "success_rate_pct", "unique_customers",
        )
        .orderBy(F.desc_nulls_first("total_revenue"), "merchant_id")
        .limit(limit)
    )


def customer_lifetime_value(tables: Tables, as_of: date, limit: int = 100) -> DataFrame:
    """Top customers by successful spend.

    Customers without a transaction never qualify, so an inner join gives the left join's result.
    """
    spending = (
        tables["transactions"]
        .groupBy("customer_id")
        .agg(
            F.count("transaction_id").alias("total_transactions"),
            X.revenue().alias("lifetime_value"),
            X.mean2(X.revenue(), X.orders()).alias("avg_transaction_value"),
            F.max("transaction_timestamp").alias("last_transaction_date"),
        )
        .where("total_transactions > 0")
    )
    people = tables["customers"].select(
        "customer_id", "customer_name", "customer_email", "risk_score"
    )
    idle_days = X.interval_part("DAY", X.midnight(as_of), F.col("last_transaction_date"))
    return (
        spending.join(people, "customer_id")
        .select(
            "customer_id", "customer_name", "customer_email", "total_transactions",
            "lifetime_value", "avg_transaction_value", "risk_score",
            X.segment(F.col("lifetime_value")).alias("customer_segment"),
            "last_transaction_date",
            X.activity(idle_days).alias("activity_status"),
        )
        .orderBy(F.desc_nulls_first("lifetime_value"), "customer_id")
        .limit(limit)
    )


def payment_method_performance(tables: Tables, as_of: date, days: int = 30) -> DataFrame:
    refunded = F.count_if(X.has_status(rules.REFUNDED))
    return (
        recent(tables, as_of, days)
        .groupBy("payment_type")
        .agg(
            F.count("*").alias("transaction_count"),
            X.revenue().alias("total_revenue"),
            X.mean2(X.revenue(), X.orders()).alias("avg_transaction_value"),
            X.percent2(X.orders(), F.count("*")).alias("success_rate_pct"),
            F.count_if(X.has_status(rules.FAILED)).alias("failed_count"),
            X.percent2(refunded, X.orders()).alias("refund_rate_pct"),
        )
        .orderBy(F.desc_nulls_first("total_revenue"), "payment_type")
    )


def fraud_alert_analysis(tables: Tables, as_of: date, days: int = 30) -> DataFrame:
    """Alerts by level and type, with the transaction's amount counted once per alert.

    Alerts are combined per transaction first: a transaction with very many alerts joins as one row.
    """
    hours = X.interval_part("HOUR", F.col("resolved_at"), F.col("created_at"))
    alerts = (
        since(tables["fraud_alerts"], "created_at", as_of, days)
        .groupBy("transaction_id", "risk_level", "alert_type")
        .agg(
            F.count("*").alias("alerts"),
            F.count_if(F.col("is_resolved")).alias("resolved"),
            F.count_if(~F.col("is_resolved")).alias("pending"),
            F.sum(hours).alias("hours"),
            F.count(hours).alias("timed"),
        )
    )
    amounts = tables["transactions"].select("transaction_id", "amount")
    return (
        alerts.join(amounts, "transaction_id")
        .groupBy("risk_level", "alert_type")
        .agg(
            F.sum("alerts").alias("alert_count"),
            F.count_distinct("transaction_id").alias("affected_transactions"),
            F.sum(F.col("amount") * F.col("alerts")).alias("total_amount_at_risk"),
            F.sum("resolved").alias("resolved_count"),
            F.sum("pending").alias("pending_count"),
            X.mean2(F.sum("hours"), F.sum("timed")).alias("avg_resolution_hours"),
        )
        .orderBy(F.desc_nulls_first("total_amount_at_risk"), "risk_level", "alert_type")
    )


def hourly_patterns_sql(tables: Tables, as_of: date, days: int = 7) -> DataFrame:
    return (
        recent(tables, as_of, days)
        .groupBy(hour().alias("hour_of_day"))
        .agg(
            F.count("*").alias("transaction_count"),
            X.revenue().alias("revenue"),
            X.mean2(X.revenue(), X.orders()).alias("avg_value"),
            X.percent2(X.orders(), F.count("*")).alias("success_rate_pct"),
        )
        .orderBy("hour_of_day")
    )


def geographic(tables: Tables, as_of: date, days: int = 30) -> DataFrame:
    per_customer = (
        recent(tables, as_of, days)
        .groupBy("customer_id")
        .agg(
            F.count("transaction_id").alias("transactions"),
            X.revenue().alias("revenue"),
            X.orders().alias("orders"),
        )
    )
    home = tables["customers"].select("customer_id", "country")
    return (
        per_customer.join(home, "customer_id")
        .groupBy("country")
        .agg(
            # One row per customer is left, so counting rows counts distinct customers.
            F.count("*").alias("customer_count"),
            F.sum("transactions").alias("transaction_count"),
            F.sum("revenue").alias("total_revenue"),
            X.mean2(F.sum("revenue"), F.sum("orders")).alias("avg_transaction_value"),
            X.percent2(F.sum("orders"), F.sum("transactions")).alias("success_rate_pct"),
        )
        .orderBy(F.desc_nulls_first("total_revenue"), "country")
    )


def refund_analysis(tables: Tables, as_of: date, days: int = 30) -> DataFrame:
    waited = X.interval_part("DAY", F.col("processed_at"), F.col("requested_at"))
    amount = F.col("refund_amount")
    return (
        since(tables["refunds"], "requested_at", as_of, days)
        .groupBy("refund_reason")
        .agg(
            F.count("*").alias("refund_count"),
            F.sum(amount).alias("total_refund_amount"),
            X.mean2(F.sum(amount), F.count(amount)).alias("avg_refund_amount"),
            F.count_if(F.col("refund_status") == "processed").alias("processed_count"),
            F.count_if(F.col("refund_status") == rules.PENDING).alias("pending_count"),
            X.mean2(F.sum(waited), F.count(waited)).alias("avg_processing_days"),
        )
        .orderBy(F.desc_nulls_first("total_refund_amount"), "refund_reason")
    )


# Months of one mask word; below 63, so that a word is never negative.
MASK_MONTHS = 60


def cohort_retention(tables: Tables, as_of: date, months: int = 6) -> DataFrame:
    """Distinct buyers per first-purchase month and activity month.

    A customer is one row per five years: a mask with a bit per active month, set by `bit_or` before any shuffle.
    Months count from the oldest cohort, and earlier ones are all word -1, which excludes the customer.
    The first month is the lowest bit of the lowest word; no window, and any span of time.
    """
    oldest = F.add_months(F.lit(str(as_of)).cast("date"), -months)
    # A cohort counts from the first whole month on; a month in its middle is before it.
    first = F.when(F.trunc(oldest, "month") == oldest, oldest).otherwise(F.add_months(F.trunc(oldest, "month"), 1))
    at = F.col("transaction_timestamp")
    number = (F.year(at) - F.year(first)) * 12 + F.month(at) - F.month(first)
    word = F.when(number < 0, -1).otherwise(F.floor(number / MASK_MONTHS))
    active = (
        tables["transactions"]
        .where(X.succeeded() & F.col("customer_id").isNotNull() & at.isNotNull())
        .select("customer_id", word.cast("int").alias("word"), F.pmod(number, F.lit(MASK_MONTHS)).alias("bit"))
        .groupBy("customer_id", "word")
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("bit"))).alias("mask"))
    )
    lowest = F.bit_count(F.col("mask").bitwiseAND(-F.col("mask")) - 1)
    buyers = active.groupBy("customer_id").agg(
        F.min(F.col("word") * MASK_MONTHS + lowest).alias("cohort"),
        F.collect_list(F.struct("word", "mask")).alias("words"),  # one per five years of the calendar
    ).where("cohort >= 0")

    def month(number: Column) -> Column:
        return F.add_months(first, number).cast("timestamp")

    each = buyers.select("cohort", F.inline("words")).select(
        "cohort", "word", "mask", F.explode(F.sequence(F.lit(0), F.lit(MASK_MONTHS - 1))).alias("bit")
    ).where(F.getbit("mask", "bit") == 1)
    return (
        each.groupBy("cohort", (F.col("word") * MASK_MONTHS + F.col("bit")).alias("active"))
        .agg(F.count("*").alias("active_customers"))
        .select(
            month(F.col("cohort")).alias("cohort_month"), month(F.col("active")).alias("activity_month"),
            "active_customers", ((F.col("active") - F.col("cohort")) % 12).cast("int").alias("months_since_first_purchase"),
        )
        .orderBy("cohort_month", "activity_month")
    )


def gateway_performance(tables: Tables, as_of: date, days: int = 30) -> DataFrame:
    took = X.interval_part(
        "SECOND", F.col("processed_timestamp"), F.col("transaction_timestamp")
    )
    totals = (
        recent(tables, as_of, days)
        .groupBy("gateway_id")
        .agg(
            F.count("transaction_id").alias("total_transactions"),
            X.revenue().alias("total_revenue"),
            X.percent2(X.orders(), F.count("*")).alias("success_rate_pct"),
            X.mean2(F.sum(took), F.count(took)).alias("avg_processing_seconds"),
            F.count_if(X.has_status(rules.FAILED)).alias("failed_count"),
        )
    )
    names = tables["payment_gateways"].select("gateway_id", "gateway_name")
    return (
        totals.join(names, "gateway_id")
        .orderBy(F.desc_nulls_first("total_revenue"), "gateway_id")
        .select(
            "gateway_name", "total_transactions", "total_revenue", "success_rate_pct",
            "avg_processing_seconds", "failed_count",
        )
    )
