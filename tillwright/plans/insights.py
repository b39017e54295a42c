"""The executive summary's figures and the data behind its charts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import expressions as X
from ..functions import rules
from .common import Tables, day, hour


def key_metrics(tables: Tables) -> DataFrame:
    return tables["transactions"].agg(
        F.count("*").alias("total_transactions"),
        X.orders().alias("successful_transactions"),
        F.coalesce(X.revenue(), F.lit(0).cast("decimal(25,2)")).alias("total_revenue"),
        X.mean(X.revenue(), X.orders()).alias("avg_transaction_value"),
        X.percent(X.orders(), F.count("*")).alias("success_rate"),
    )


def status_distribution(tables: Tables) -> DataFrame:
    return _distribution(
        tables["transactions"], "transaction_status", X.capitalize, "status"
    )


def payment_type_distribution(tables: Tables) -> DataFrame:
    return _distribution(tables["transactions"], "payment_type", X.title_label, "payment_method")


def _distribution(rows: DataFrame, column: str, label, name: str) -> DataFrame:
    """Rows per value and their share of all rows; nulls have no line but stay in the whole.

    The whole is a sum of its own over the finished groups, so they need not meet in one task, however
    many values there are.
    """
    counted = rows.groupBy(column).agg(F.count("*").alias("count"))
    whole = counted.agg(F.sum("count")).scalar()
    return (
        counted.withColumn("pct", X.percent(F.col("count"), whole))
        .where(F.col(column).isNotNull())
        .select(label(F.col(column)).alias(name), "count", "pct")
        .orderBy(F.desc("count"), name)
    )


def _merchant_leaders(tables: Tables, limit: int) -> DataFrame:
    """Merchants by successful revenue. The join comes after the cut, on `limit` rows."""
    leaders = (
        tables["transactions"]
        .where(X.succeeded() & F.col("merchant_id").isNotNull())
        .groupBy("merchant_id")
        .agg(F.sum("amount").alias("revenue"))
        .orderBy(F.desc("revenue"), "merchant_id")
        .limit(limit)
    )
    names = tables["merchants"].select("merchant_id", "merchant_name")
    return leaders.join(names, "merchant_id", "left")


def top5_merchants(tables: Tables, limit: int = 5) -> DataFrame:
    """Ranked merchants; one that is missing from the dimension keeps its place without a name."""
    place = F.row_number().over(Window.orderBy(F.desc("revenue"), "merchant_id"))
    return (
        _merchant_leaders(tables, limit)
        .select(place.alias("rank"), "merchant_id", "merchant_name", "revenue")
        .orderBy("rank")
    )


def top10_merchants_labelled(tables: Tables, limit: int = 10, width: int = 30) -> DataFrame:
    return (
        _merchant_leaders(tables, limit)
        .select("merchant_id", X.shorten(F.col("merchant_name"), width).alias("label"), "revenue")
        .orderBy(F.desc("revenue"), "merchant_id")
    )


def customer_insights(tables: Tables) -> DataFrame:
    """One row; the distinct count over transactions enters as a scalar subquery."""
    active = tables["transactions"].agg(F.count_distinct("customer_id")).scalar()
    high_risk = F.count_if(F.col("risk_score") > rules.HIGH_RISK_SCORE)
    people = tables["customers"].agg(
        F.count("*").alias("total_customers"),
        high_risk.alias("high_risk_customers"),
        X.percent(high_risk, F.count("*")).alias("high_risk_pct"),
    )
    return people.withColumn("active_customers", active)


def fraud_summary(tables: Tables) -> DataFrame:
    return tables["fraud_alerts"].agg(
        F.count("*").alias("total_alerts"),
        F.count_if(F.col("is_resolved")).alias("resolved_alerts"),
        F.count_if(~F.col("is_resolved")).alias("pending_alerts"),
    )


def risk_level_distribution(tables: Tables) -> DataFrame:
    return (
        tables["fraud_alerts"]
        .where(F.col("risk_level").isNotNull())
        .groupBy(X.capitalize(F.col("risk_level")).alias("risk_level"))
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), "risk_level")
    )


def daily_volume(tables: Tables) -> DataFrame:
    return _volume(tables, day(), "transaction_date")


def hourly_volume(tables: Tables) -> DataFrame:
    return _volume(tables, hour(), "hour")


def _volume(tables: Tables, part: Column, name: str) -> DataFrame:
    return (
        tables["transactions"]
        .where(F.col("transaction_timestamp").isNotNull())
        .groupBy(part.alias(name))
        .agg(F.count("*").alias("transaction_count"))
        .orderBy(name)
    )


def revenue_by_payment_type(tables: Tables) -> DataFrame:
    return (
        tables["transactions"]
        .where(X.succeeded() & F.col("payment_type").isNotNull())
        .groupBy("payment_type")
        .agg(F.sum("amount").alias("revenue"))
        .select("payment_type", X.title_label(F.col("payment_type")).alias("label"), "revenue")
        .orderBy(F.desc("revenue"), "payment_type")
    )


def risk_score_histogram(tables: Tables, bins: int = 20) -> DataFrame:
    """Equal-width bins from the lowest to the highest score; the last bin includes the highest.

    Customers are counted per score first; scores are whole numbers, so all later steps see no more
    rows than there are scores, and bin numbers come out of exact integer division.
    """
    score, everyone = F.col("risk_score"), Window.partitionBy()
    per_score = (
        tables["customers"]
        .where(score.isNotNull())
        .groupBy(score.cast("bigint").alias("risk_score"))
        .agg(F.count("*").alias("n"))
        .withColumn("low", F.min("risk_score").over(everyone))
        .withColumn("high", F.max("risk_score").over(everyone))
    )
    position = F.expr(f"(risk_score - low) * {bins} div nullif(high - low, 0) + 1")
    # With a single score the range is one unit wide and centred on it.
    bin_number = F.least(F.coalesce(position, F.lit(bins // 2 + 1)), F.lit(bins))
    filled = per_score.groupBy(bin_number.cast("int").alias("bin"), "low", "high").agg(
        F.sum("n").alias("n")
    )
    margin = F.when(F.col("low") == F.col("high"), 0.5).otherwise(0.0)
    whole = filled.agg(
        (F.min("low") - F.max(margin)).alias("start"),
        (F.max("high") + F.max(margin)).alias("end"),
        F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("counts"),
    )
    width = (F.col("end") - F.col("start")) / F.lit(float(bins))
    return (
        whole.select("start", "end", "counts", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
        .select(
            "bin",
            (F.col("start") + (F.col("bin") - 1) * width).alias("bin_start"),
            (F.col("start") + F.col("bin") * width).alias("bin_end"),
            F.coalesce(F.try_element_at("counts", F.col("bin")), F.lit(0)).alias("customer_count"),
            F.lit(rules.HIGH_RISK_SCORE).alias("high_risk_threshold"),
        )
        .orderBy("bin")
    )


def customer_segmentation(tables: Tables) -> DataFrame:
    """Spend per buyer, rounded half-even to 2 digits before the segment is chosen."""
    amount = F.col("amount")
    return (
        tables["transactions"]
        .where(X.succeeded() & F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            F.sum(amount).alias("total_spent"),
            X.mean2_half_even(F.sum(amount), F.count(amount)).alias("avg_transaction"),
            F.count(amount).alias("transaction_count"),
        )
        .withColumn("segment", X.segment(F.col("total_spent")))
    )


def segment_summary(tables: Tables) -> DataFrame:
    """Segments from most to least valuable, only those with customers."""
    names = F.array(*[F.lit(name) for name in rules.SEGMENT_ORDER])
    average = F.col("avg_transaction")
    return (
        customer_segmentation(tables)
        .groupBy("segment")
        .agg(
            F.count("*").alias("customers"),
            F.sum("total_spent").alias("total_revenue"),
            X.mean2_half_even(F.sum(average), F.count(average)).alias("avg_transaction"),
        )
        .orderBy(F.array_position(names, F.col("segment")))
    )
