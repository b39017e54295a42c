"""The batch run: read, clean, store, check, report."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession

from ..operators import quality, risk
from ..operators.cleaning import clean_all
from ..schemas import MONTH
from ..sinks.files import write_backup, write_months, write_parquet_tables
from ..sources.catalog import payment_gateways
from ..sources.files import read_csv_tables, read_csv_tables_apart, read_parquet_tables
from . import insights, profiles, reports, summaries
from .common import Tables

# Reports over the tables as of a date.
DATED_REPORTS = {
    "daily_revenue": reports.daily_revenue,
    "top_merchants": reports.top_merchants,
    "customer_lifetime_value": reports.customer_lifetime_value,
    "payment_method_performance": reports.payment_method_performance,
    "fraud_alert_analysis": reports.fraud_alert_analysis,
    "hourly_patterns_sql": reports.hourly_patterns_sql,
    "geographic": reports.geographic,
    "refund_analysis": reports.refund_analysis,
    "cohort_retention": reports.cohort_retention,
    "gateway_performance": reports.gateway_performance,
    "weekly_report": summaries.weekly_report,
    "weekly_report_totals": summaries.weekly_report_totals,
    "summary_report": summaries.summary_report,
}

# Reports over all of the tables.
REPORTS = {
    "daily_transaction_summary": summaries.daily_transaction_summary,
    "high_risk_customers": summaries.high_risk_customers,
    "run_metrics": summaries.run_metrics,
    "success_rate_by_merchant_type": profiles.success_rate_by_merchant_type,
    "hourly_patterns": profiles.hourly_patterns,
    "customer_clv_success_only": profiles.customer_clv_success_only,
    "key_metrics": insights.key_metrics,
    "status_distribution": insights.status_distribution,
    "top5_merchants": insights.top5_merchants,
    "customer_insights": insights.customer_insights,
    "fraud_summary": insights.fraud_summary,
    "risk_level_distribution": insights.risk_level_distribution,
    "payment_type_distribution": insights.payment_type_distribution,
    "daily_volume": insights.daily_volume,
    "revenue_by_payment_type": insights.revenue_by_payment_type,
    "hourly_volume": insights.hourly_volume,
    "top10_merchants_labelled": insights.top10_merchants_labelled,
    "risk_score_histogram": insights.risk_score_histogram,
    "customer_segmentation": insights.customer_segmentation,
    "segment_summary": insights.segment_summary,
}


METRICS = (
    "total_transactions", "total_revenue", "avg_transaction_value", "success_rate", "total_refunded",
)


class InvalidData(RuntimeError):
    """The quality gate failed."""


@dataclass
class Stored:
    """What was counted while the tables were stored: row checks by table, and the run's totals."""

    counts: dict[str, list[int]]
    metrics: dict[str, object]


def store_processed(
    cleaned: Tables, folder: str, tallies: Mapping[str, list[quality.Tally]] | None = None
) -> Stored:
    """Cleaned tables as Parquet, transactions by month; `tallies` and the totals are taken in the same pass.

    The counts belong to the tasks that write: they look at rows after the last exchange, and Spark adds up
    each such task once, however often it was tried.
    """
    tallies = tallies or {}
    seen: dict[str, Observation] = {}

    def watch(name: str, rows: DataFrame) -> DataFrame:
        columns = [t.bad.alias(f"n{i}") for i, t in enumerate(tallies.get(name, ()))]
        if name == "transactions":
            columns += summaries.metric_columns()
        if not columns:
            return rows
        seen[name] = Observation()
        return rows.observe(seen[name], *columns)

    others = {name: table for name, table in cleaned.items() if name != "transactions"}
    write_parquet_tables(others, folder, watch)
    write_months(
        cleaned["transactions"], f"{folder}/transactions", whole_store=True,
        watch=lambda rows: watch("transactions", rows),
    )
    found = {name: observation.get for name, observation in seen.items()}
    return Stored(
        {name: [found[name][f"n{i}"] for i in range(len(tallies[name]))] for name in found if name in tallies},
        {key: value for key, value in found["transactions"].items() if key in METRICS},
    )


def read_processed(spark: SparkSession, folder: str, as_of: date) -> Tables:
    tables = read_parquet_tables(spark, folder)
    tables["payment_gateways"] = payment_gateways(spark, as_of)
    return tables


def all_reports(tables: Tables, as_of: date) -> dict[str, DataFrame]:
    """Every report, unevaluated."""
    frames = {name: report(tables, as_of) for name, report in DATED_REPORTS.items()}
    frames |= {name: report(tables) for name, report in REPORTS.items()}
    frames["fraud_patterns"] = risk.fraud_patterns(tables["transactions"].drop(MONTH))
    return frames


def transaction_analysis(transactions: DataFrame) -> dict[str, DataFrame]:
    """The four large-scale transaction analyses together, unevaluated."""
    tables = {"transactions": transactions}
    return {
        "success_rate": profiles.success_rate_by_merchant_type(tables),
        "hourly_patterns": profiles.hourly_patterns(tables),
        "fraud_patterns": risk.fraud_patterns(transactions),
        "customer_clv": profiles.customer_clv_success_only(tables),
    }


def run_batch(
    spark: SparkSession,
    raw_folder: str,
    output_folder: str,
    as_of: date,
    suite: quality.Suite = quality.Suite(),
    stop_on_errors: bool = True,
    backup: bool = False,
    quarantine: bool = False,
) -> dict[str, str]:
    """The whole run from raw CSV files; returns the path of every result.

    Cleaned tables are written once and read back: each result then scans only its columns from
    Parquet, and a lost executor costs a task, not a recomputation from text. The checks that count
    rows, and the run's totals, are taken while the tables are written.

    With `quarantine` rows that cannot be read are stored apart, by table, and the others are loaded; otherwise a value
    of a wrong type is read as null.
    """
    processed, paths = f"{output_folder}/processed", {}
    if quarantine:
        raw, unreadable = read_csv_tables_apart(spark, raw_folder)
        paths["quarantine"] = f"{output_folder}/quarantine"
        unreadable.write.mode("overwrite").partitionBy("table_name").parquet(paths["quarantine"])
    else:
        raw = read_csv_tables(spark, raw_folder)
    cleaned = clean_all(raw)
    stored = store_processed(cleaned, processed, quality.row_tallies(cleaned, as_of, suite))
    tables = read_processed(spark, processed, as_of)

    paths["quality"] = f"{output_folder}/quality"
    quality.check(tables, as_of, suite, stored.counts).write.mode("overwrite").parquet(paths["quality"])
    outcome = quality.verdict(spark.read.parquet(paths["quality"])).first()
    if stop_on_errors and not outcome["is_valid"]:
        raise InvalidData(f"{outcome['total_errors']} checks failed, see {paths['quality']}")

    reported = all_reports(tables, as_of)
    if "run_metrics" in reported:
        columns = reported["run_metrics"].schema
        reported["run_metrics"] = spark.createDataFrame([tuple(stored.metrics[c] for c in columns.names)], columns)
    for name, frame in reported.items():
        paths[name] = f"{output_folder}/reports/{name}"
        frame.write.mode("overwrite").parquet(paths[name])
    if backup:
        tables["transactions"] = tables["transactions"].drop(MONTH)
        write_backup(tables, f"{output_folder}/backups", as_of)
    return paths
