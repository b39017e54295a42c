"""File writers. None of them gathers rows into one task."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import MONTH


def write_csv_tables(tables: Mapping[str, DataFrame], folder: str, processed: bool = True) -> None:
    """Every table as `<table>_processed.csv` (`<table>.csv` if raw).

    Quoted so that JSON text survives a read, and with the blanks values begin or end with, which
    Spark's writer would strip.
    """
    ending = "_processed.csv" if processed else ".csv"
    for name, table in tables.items():
        (
            table.write.mode("overwrite")
            .options(header=True, quote='"', escape='"')
            .options(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
            .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
            .csv(f"{folder}/{name}{ending}")
        )


def write_parquet_tables(
    tables: Mapping[str, DataFrame], folder: str, watch: Callable[[str, DataFrame], DataFrame] | None = None
) -> None:
    """`watch(name, rows)` may look at the rows of a table on their way into the files."""
    for name, table in tables.items():
        (watch(name, table) if watch else table).write.mode("overwrite").parquet(f"{folder}/{name}")


def write_months(
    transactions: DataFrame,
    path: str,
    whole_store: bool = False,
    watch: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Transactions in one folder per calendar month.

    Months among the rows are replaced, others stay; `whole_store` leaves nothing of what was there.

    The rebalance hint groups rows by month and lets AQE cut a large month into several tasks and
    join small ones, so a month is neither one huge file nor a file from every task. Rows are in
    time order inside a file, which lets a date filter skip row groups within a month.
    """
    month = F.trunc("transaction_timestamp", "month")
    rows = (
        transactions.withColumn(MONTH, month)
        .hint("rebalance", MONTH)
        .sortWithinPartitions(MONTH, "transaction_timestamp")
    )
    (
        (watch(rows) if watch else rows)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if whole_store else "dynamic")
        .partitionBy(MONTH)
        .parquet(path)
    )


def write_backup(tables: Mapping[str, DataFrame], folder: str, run_date: date) -> None:
    """A gzip-compressed copy of every table under the run date; a rerun replaces its own date."""
    for name, table in tables.items():
        (
            table.write.mode("overwrite")
            .option("compression", "gzip")
            .parquet(f"{folder}/backup_date={run_date}/{name}")
        )
