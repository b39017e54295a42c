"""Day sums of the monthly store, kept by month: a replaced month costs itself, not the whole history.

A month's sums are stored under the version of the month they were taken from. The version is made of the names of
the month's files, which no two writes share, so nothing has to be written down when a month is replaced, and a run
that ends between the two steps leaves sums that nobody reads. `refresh` computes the months whose version has no sums.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import expressions as X
from ..functions import rules
from ..schemas import MONTH
from ..sinks import folders
from . import summaries
from .common import day

VERSION = "version"
#: The month of rows without a time, in a version's name.
NO_MONTH = "none"
MONEY = "decimal(25,2)"


#: Columns of the sums.
SUMS = (
    f"transaction_date DATE, merchant_id BIGINT, transactions BIGINT, "
    f"successes BIGINT, failures BIGINT, revenue {MONEY}, refunded {MONEY}, amount {MONEY}, amounts BIGINT"
)


class StaleSums(RuntimeError):
    """The store holds months whose sums have not been computed."""


def _files(spark: SparkSession, path: str) -> DataFrame:
    """A row per data file with the columns of its folders; no file is opened."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)


def versions(spark: SparkSession, store: str) -> dict[str, date | None]:
    """Version -> month of all months in the store, one row each to the driver.

    The files are listed and their names hashed by Spark; the hash does not depend on their order.
    """
    name = F.xxhash64(F.element_at(F.split("path", "/"), -1))
    files = _files(spark, store)
    if MONTH not in files.columns:
        return {}  # nothing was ever written
    month = F.col(MONTH).cast("date")
    found = files.groupBy(month.alias(MONTH)).agg(
        F.hex(F.bit_xor(name)).alias("names"), F.count("*").alias("files")
    ).select(
        MONTH, F.concat_ws("_", F.coalesce(F.col(MONTH).cast("string"), F.lit(NO_MONTH)), "files", "names").alias(VERSION)
    )
    return {row[VERSION]: row[MONTH] for row in found.collect()}


def known_versions(spark: SparkSession, sums: str) -> set[str]:
    """Versions that have sums: folders appear by one rename each, so a listed one is whole."""
    return {path.rsplit("=", 1)[1] for path in folders.matching(spark, f"{sums}/{VERSION}=*")}


def day_sums(transactions: DataFrame) -> DataFrame:
    """Per stored month, day and merchant what the views and metrics add up; nulls are groups of their own."""
    return transactions.groupBy(MONTH, day().alias("transaction_date"), "merchant_id").agg(
        F.count("*").alias("transactions"),
        X.orders().alias("successes"),
        F.count_if(X.has_status(rules.FAILED)).alias("failures"),
        X.revenue().cast(MONEY).alias("revenue"),
        X.amount_where(X.has_status(rules.REFUNDED)).cast(MONEY).alias("refunded"),
        F.sum("amount").cast(MONEY).alias("amount"),
        F.count("amount").alias("amounts"),
    )


def _is_one_of(months: list[date | None]) -> Column:
    """A condition on the partition column alone: other months are not opened."""
    named = [F.lit(str(m)).cast("date") for m in months if m is not None]
    wanted = F.col(MONTH).isin(named) if named else F.lit(False)
    return (wanted | F.col(MONTH).isNull()) if None in months else wanted


def refresh(spark: SparkSession, store: str, sums: str) -> list[date | None]:
    """Compute the sums of all months that were written since the last refresh, and no others; says which.

    A month replaced while this runs gets another version, and the next refresh computes it again. Sums of versions
    that are gone stay until `clear`, for readers that have begun.
    """
    current, known = versions(spark, store), known_versions(spark, sums)
    stale = {version: month for version, month in current.items() if version not in known}
    if not stale:
        return []
    months = list(stale.values())
    rows = spark.read.parquet(store).where(_is_one_of(months))
    names = F.create_map(*[F.lit(text) for v, m in stale.items() for text in (str(m or NO_MONTH), v)])
    (
        day_sums(rows)
        .withColumn(VERSION, names[F.coalesce(F.col(MONTH).cast("string"), F.lit(NO_MONTH))])
        .drop(MONTH)
        .hint("rebalance", VERSION)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(VERSION)
        .parquet(sums)
    )
    return months


def clear(spark: SparkSession, store: str, sums: str) -> list[str]:
    """Delete sums of versions that the store no longer holds."""
    gone = sorted(known_versions(spark, sums) - set(versions(spark, store)))
    for version in gone:
        folders.delete(spark, f"{sums}/{VERSION}={version}")
    return gone


def read_sums(spark: SparkSession, store: str, sums: str, since: date | None = None) -> DataFrame:
    """The sums of the store as it is now, of days from `since` on; refuses if a month's sums are missing.

    Days before the month of `since` are in folders that are not opened.
    """
    current = versions(spark, store)
    if since is not None:
        current = {v: m for v, m in current.items() if m is not None and m >= since.replace(day=1)}
    missing = sorted(set(current) - known_versions(spark, sums))
    if missing:
        raise StaleSums(f"no sums of {', '.join(missing)}: call refresh")
    if not current:
        return spark.createDataFrame([], SUMS)
    rows = spark.read.parquet(sums).where(F.col(VERSION).isin(list(current))).drop(VERSION)
    return rows if since is None else rows.where(F.col("transaction_date") >= F.lit(str(since)).cast("date"))


# The views and metrics from day sums: the same columns and types as over transactions.

def daily_transaction_summary(sums: DataFrame) -> DataFrame:
    """A projection: every (day, merchant) is one row of the sums already."""
    return sums.select(
        "transaction_date",
        "merchant_id",
        F.col("transactions").alias("total_transactions"),
        F.col("successes").alias("successful_transactions"),
        F.col("failures").alias("failed_transactions"),
        F.col("revenue").alias("total_revenue"),
        X.mean(F.col("revenue"), F.col("successes")).alias("avg_transaction_value"),
    )


def run_metrics(sums: DataFrame) -> DataFrame:
    zero = F.lit(0).cast(MONEY)
    total, orders, revenue = F.sum("transactions"), F.sum("successes"), F.sum("revenue")
    return sums.agg(
        F.coalesce(total, F.lit(0)).alias("total_transactions"),
        F.coalesce(revenue.cast(MONEY), zero).alias("total_revenue"),
        X.mean(revenue, orders).alias("avg_transaction_value"),
        X.percent(orders, total).alias("success_rate"),
        F.coalesce(F.sum("refunded").cast(MONEY), zero).alias("total_refunded"),
    )


def summary_report(sums: DataFrame, generated_at: date | datetime) -> DataFrame:
    return summaries.as_text(run_metrics(sums), generated_at)


def weekly_report(sums: DataFrame) -> DataFrame:
    """Daily totals of sums read since the first day of the report."""
    return sums.groupBy(F.col("transaction_date").alias("date")).agg(
        F.sum("transactions").alias("total_transactions"),
        F.sum("revenue").cast(MONEY).alias("revenue"),
        X.mean(F.sum("amount"), F.sum("amounts")).alias("avg_transaction"),
    ).orderBy(F.desc_nulls_first("date"))


def weekly_report_totals(sums: DataFrame) -> DataFrame:
    return summaries.totals_of_days(weekly_report(sums))


def all_reports(sums: DataFrame, week: DataFrame, as_of: date) -> Mapping[str, DataFrame]:
    """Every report that day sums answer; `week` are the sums of the last seven days."""
    return {
        "daily_transaction_summary": daily_transaction_summary(sums),
        "run_metrics": run_metrics(sums),
        "summary_report": summary_report(sums, as_of),
        "weekly_report": weekly_report(week),
        "weekly_report_totals": weekly_report_totals(week),
    }
