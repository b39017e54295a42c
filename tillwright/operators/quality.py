"""Data quality checks.

Every check yields rows of (check, table, column, severity, bad_count, detail); a bad_count of 0 is a
pass. Checks that only count rows of one table share one pass over it; in a suite, so do its duplicates, orphans
and failing customers. The joined rule needs its own key-wise pass.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import expressions as X
from ..functions import rules
from .keys import orphan_keys

ERROR, WARNING, INFO = "error", "warning", "info"

# What the standard suite checks.
REQUIRED_COLUMNS = {
    "merchants": ("merchant_id", "merchant_name", "merchant_email"),
    "customers": ("customer_id", "customer_email"),
    "transactions": ("transaction_id", "transaction_uuid", "amount", "transaction_status"),
}
UNIQUE_COLUMNS = {
    "merchants": ("merchant_id", "merchant_email"),
    "customers": ("customer_id", "customer_email"),
    "transactions": ("transaction_id", "transaction_uuid"),
}
VALUE_RANGES = {
    "customers": {"risk_score": rules.RISK_RANGE},
    "transactions": {"amount": rules.AMOUNT_RANGE},
}
REFERENCES = (
    ("transactions", "merchant_id", "merchants", "merchant_id"),
    ("transactions", "customer_id", "customers", "customer_id"),
    ("payment_methods", "customer_id", "customers", "customer_id"),
)
# End of fixed values.


@dataclass(frozen=True)
class Suite:
    """What to check; the defaults are the standard suite."""

    required: Mapping[str, Iterable[str]] = field(default_factory=lambda: REQUIRED_COLUMNS)
    unique: Mapping[str, Iterable[str]] = field(default_factory=lambda: UNIQUE_COLUMNS)
    ranges: Mapping[str, Mapping[str, tuple]] = field(default_factory=lambda: VALUE_RANGES)
    references: tuple = REFERENCES
    detect_anomalies: bool = True
    max_null_percentage: float = rules.MAX_NULL_PERCENTAGE
    min_success_rate: float = rules.MIN_SUCCESS_RATE


@dataclass(frozen=True)
class Tally:
    """One aggregate over a table, to be reported as a check row."""

    check: str
    column: str
    severity: str
    bad: Column
    detail: str


def _text(value: str) -> str:
    """A SQL string literal."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _report_line(
    check: str, table: str, column: str, severity: str, count: str, detail: str
) -> str:
    """SQL for one check row; `count` is a column with its bad rows."""
    return (
        f"named_struct('check', {_text(check)}, 'table', {_text(table)}, "
        f"'column', {_text(column)}, 'severity', {_text(severity)}, "
        f"'bad_count', coalesce(CAST({count} AS BIGINT), 0L), 'detail', {_text(detail)})"
    )


# Columns of a report.
CHECK_ROW = "`check` STRING, `table` STRING, `column` STRING, severity STRING, bad_count BIGINT, detail STRING"


def no_checks(session: SparkSession) -> DataFrame:
    """The report of nothing: no rows, with the columns of any other."""
    return session.createDataFrame([], CHECK_ROW)


def tally(df: DataFrame, table: str, tallies: list[Tally]) -> DataFrame:
    """All tallies of a table in one aggregation, one output row each."""
    if not tallies:
        return no_checks(df.sparkSession)
    counts = df.agg(*[t.bad.alias(f"n{i}") for i, t in enumerate(tallies)])
    lines = ", ".join(
        _report_line(t.check, table, t.column, t.severity, f"n{i}", t.detail)
        for i, t in enumerate(tallies)
    )
    return counts.selectExpr(f"inline(array({lines}))")


def combine(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, frames)


def _line(counted: DataFrame, check, table, column, severity, detail) -> DataFrame:
    """A one-row, one-column count as a check row."""
    (count,) = counted.columns
    line = _report_line(check, table, column, severity, f"`{count}`", detail)
    return counted.selectExpr(f"inline(array({line}))")


# Tallies of single-table checks.

def null_tallies(df: DataFrame, columns: Iterable[str]) -> list[Tally]:
    return [
        Tally("nulls", c, ERROR, F.count_if(F.col(c).isNull()), "null values")
        for c in columns
        if c in df.columns
    ]


def range_tallies(df: DataFrame, ranges: Mapping[str, tuple]) -> list[Tally]:
    return [
        Tally(
            "ranges", c, WARNING, F.count_if((F.col(c) < low) | (F.col(c) > high)),
            f"values outside [{low}, {high}]",
        )
        for c, (low, high) in ranges.items()
        if c in df.columns
    ]


def nonpositive_amount() -> Tally:
    return Tally(
        "nonpositive_amount", "amount", ERROR, F.count_if(F.col("amount") <= 0),
        "amounts not above zero",
    )


def future_timestamp(as_of: date | datetime) -> Tally:
    late = F.col("transaction_timestamp") > X.instant(as_of)
    return Tally(
        "future_timestamp", "transaction_timestamp", ERROR, F.count_if(late), "times after the run"
    )


def invalid_risk() -> Tally:
    low, high = rules.RISK_RANGE
    score = F.col("risk_score")
    return Tally(
        "invalid_risk", "risk_score", ERROR, F.count_if((score < low) | (score > high)),
        "risk scores out of bounds",
    )


def success_unprocessed() -> Tally:
    missing = X.succeeded() & F.col("processed_timestamp").isNull()
    return Tally(
        "success_unprocessed", "processed_timestamp", WARNING, F.count_if(missing),
        "successes without a processed time",
    )


def odd_hours() -> Tally:
    at_night = F.hour("transaction_timestamp").isin(*rules.NIGHT_HOURS)
    return Tally(
        "odd_hours", "transaction_timestamp", INFO, F.count_if(at_night), "transactions at night"
    )


def null_gate_tallies(df: DataFrame, columns: Iterable[str], percentage: float) -> list[Tally]:
    """Null counts of columns whose share of nulls is above the gate."""
    tallies = []
    for c in columns:
        if c in df.columns:
            nulls = F.count_if(F.col(c).isNull())
            over = nulls * 100 > F.count("*") * percentage
            tallies.append(
                Tally(
                    "null_gate", c, WARNING, F.when(over, nulls).otherwise(0),
                    f"nulls above {percentage}%",
                )
            )
    return tallies


def success_gate(rate: float) -> Tally:
    """Unsuccessful rows, when the success rate is below the gate."""
    below = X.orders() * 100 < F.count("*") * rate
    return Tally(
        "success_gate", "transaction_status", WARNING,
        F.when(below, F.count("*") - X.orders()).otherwise(0), f"success rate below {rate}%",
    )


# Checks as frames.

def check_nulls(df: DataFrame, table: str, columns: Iterable[str]) -> DataFrame:
    return tally(df, table, null_tallies(df, columns))


def check_value_ranges(df: DataFrame, table: str, ranges: Mapping[str, tuple]) -> DataFrame:
    return tally(df, table, range_tallies(df, ranges))


def check_duplicates(df: DataFrame, table: str, columns: Iterable[str]) -> DataFrame:
    """Rows beyond the first of each value; nulls are equal to each other.

    One narrow pass per column: several distinct counts in one pass would multiply every row.
    """
    frames = [no_checks(df.sparkSession)]
    for c in columns:
        if c in df.columns:
            extra = df.groupBy(c).agg((F.count("*") - 1).alias("n")).agg(F.sum("n"))
            frames.append(_line(extra, "duplicates", table, c, ERROR, "repeated values"))
    return combine(frames)


def check_data_types(df: DataFrame, table: str, expected: Mapping[str, str]) -> DataFrame:
    """1 for a column whose type's name does not contain the expected one, whatever its rows hold.

    A question about the table's schema, so no row is read.
    """
    rows = []
    for c, wanted in expected.items():
        if c in df.columns:
            actual = df.schema[c].dataType.simpleString()
            rows.append(("types", table, c, WARNING, int(wanted not in actual), f"expected {wanted}, found {actual}"))
    return df.sparkSession.createDataFrame(rows, CHECK_ROW)


def check_stored_types(session: SparkSession, path: str, table: str, expected: Mapping[str, str]) -> DataFrame:
    """Rows stored under a type whose name does not contain the expected one.

    The types are those in the footers of all of the table's files, read by a Spark job; files that contradict each
    other fail the read. An empty table with a wrong type counts as one.
    """
    stored = session.read.option("mergeSchema", "true").parquet(path)
    tallies = []
    for c, wanted in expected.items():
        if c in stored.columns:
            actual = stored.schema[c].dataType.simpleString()
            wrong = F.greatest(F.count("*"), F.lit(1)) if wanted not in actual else F.lit(0)
            tallies.append(Tally("types", c, WARNING, wrong, f"expected {wanted}, found {actual}"))
    return tally(stored, table, tallies)


def check_keys(
    tables: Mapping[str, DataFrame], table: str, unique: Iterable[str], references: Iterable[tuple], failing: bool = False
) -> DataFrame:
    """Duplicates, keys without a parent and customers with many failures, in one pass over the table.

    A row becomes one narrow row per key column, and these are counted per column and key before they
    meet the parents' keys; a key of a third of all rows is one row per task. Nulls are equal to each other as
    duplicates and no orphans. Whole-number keys travel as numbers, others as text.
    """
    rows = tables[table]
    unique = [c for c in unique if c in rows.columns]
    references = list(references)
    columns = list(dict.fromkeys([*unique, *[r[1] for r in references], *(["customer_id"] if failing else [])]))
    if not columns:
        return no_checks(rows.sparkSession)

    def key(frame: DataFrame, column: str, which: int) -> Column:
        whole = frame.schema[column].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint")
        number, text = (F.col(column), F.lit(None)) if whole else (F.lit(None), F.col(column))
        return F.struct(
            F.lit(which).alias("which"), number.cast("bigint").alias("number"), text.cast("string").alias("text")
        )

    failed = X.has_status(rules.FAILED) if failing else F.lit(False)
    per_key = (
        rows.select(failed.alias("failed"), F.inline(F.array([key(rows, c, i) for i, c in enumerate(columns)])))
        .groupBy("which", "number", "text")
        .agg(F.count("*").alias("n"), F.count_if("failed").alias("failed"))
    )
    is_null = F.col("number").isNull() & F.col("text").isNull()
    counts, lines = [], []
    for c in unique:
        counts.append(F.sum(F.when(F.col("which") == columns.index(c), F.col("n") - 1)))
        lines.append(("duplicates", table, c, ERROR, "repeated values"))
    for i, (child, child_key, parent, parent_key) in enumerate(references):
        of = columns.index(child_key)
        known = tables[parent].select(F.inline(F.array(key(tables[parent], parent_key, of)))).distinct()
        per_key = per_key.join(
            known.select(*[F.col(c).alias(f"_{c}") for c in known.columns], F.lit(True).alias(f"known{i}")),
            (F.col("which") == F.col("_which")) & (F.coalesce("number", F.lit(0)) == F.coalesce("_number", F.lit(0)))
            & (F.coalesce("text", F.lit("")) == F.coalesce("_text", F.lit(""))) & ~is_null
            & (F.col("_number").isNotNull() | F.col("_text").isNotNull()),
            "left",
        ).drop("_which", "_number", "_text")
        counts.append(F.count_if((F.col("which") == of) & ~is_null & F.col(f"known{i}").isNull()))
        lines.append(("referential", f"{child} -> {parent}", child_key, ERROR, "keys without a parent"))
    if failing:
        many = (F.col("which") == columns.index("customer_id")) & ~is_null & (
            F.col("failed") > rules.MAX_FAILED_PER_CUSTOMER
        )
        counts.append(F.count_if(many))
        lines.append(("failed_customers", table, "customer_id", WARNING, "customers with many failures"))
    counted = per_key.agg(*[count.alias(f"n{i}") for i, count in enumerate(counts)])
    inlined = ", ".join(
        _report_line(check, of, column, severity, f"n{i}", detail)
        for i, (check, of, column, severity, detail) in enumerate(lines)
    )
    return counted.selectExpr(f"inline(array({inlined}))")


def check_referential_integrity(
    child: DataFrame, parent: DataFrame, child_key: str, parent_key: str, relationship: str
) -> DataFrame:
    """Distinct keys without a parent, whatever the number of rows that use them."""
    orphans = orphan_keys(child, child_key, parent, parent_key).agg(F.count("*").alias("n"))
    return _line(orphans, "referential", relationship, child_key, ERROR, "keys without a parent")


def check_excess_refunds(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Refunds above the amount of their transaction.

    Equal refunds of one transaction are counted before the join, so that a transaction with very
    many refunds does not meet the join row by row.
    """
    refunds = tables["refunds"].groupBy("transaction_id", "refund_amount").agg(
        F.count("*").alias("refunds")
    )
    amounts = tables["transactions"].select("transaction_id", "amount")
    above = (
        refunds.join(amounts, "transaction_id")
        .where("refund_amount > amount")
        .agg(F.sum("refunds").alias("n"))
    )
    return _line(
        above, "excess_refund", "refunds", "refund_amount", ERROR, "refunds above the amount paid"
    )


# Anomalies as rows.

def amount_threshold(transactions: DataFrame) -> DataFrame:
    """One row: mean plus three sample deviations."""
    amount = F.col("amount").cast("double")
    limit = F.avg(amount) + rules.OUTLIER_DEVIATIONS * F.stddev_samp(amount)
    return transactions.agg(limit.alias("threshold"))


def high_amounts(transactions: DataFrame) -> DataFrame:
    """Transactions above the threshold, which enters the plan as a scalar subquery."""
    limit = amount_threshold(transactions).scalar()
    return transactions.where(F.col("amount").cast("double") > limit)


def failed_customers(
    transactions: DataFrame, more_than: int = rules.MAX_FAILED_PER_CUSTOMER
) -> DataFrame:
    return (
        transactions.where(X.has_status(rules.FAILED) & F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(F.count("*").alias("failed_count"))
        .where(F.col("failed_count") > more_than)
    )


def odd_hour_transactions(transactions: DataFrame) -> DataFrame:
    return transactions.where(F.hour("transaction_timestamp").isin(*rules.NIGHT_HOURS))


def high_amount_tally(transactions: DataFrame) -> Tally:
    above = F.col("amount").cast("double") > amount_threshold(transactions).scalar()
    return Tally(
        "high_amount", "amount", WARNING, F.count_if(above), "amounts above the outlier threshold"
    )


def check_failed_customers(transactions: DataFrame) -> DataFrame:
    many = failed_customers(transactions).agg(F.count("*").alias("n"))
    return _line(
        many, "failed_customers", "transactions", "customer_id", WARNING,
        "customers with many failures",
    )


# The suite.

def row_tallies(
    tables: Mapping[str, DataFrame], as_of: date | datetime, suite: Suite = Suite()
) -> dict[str, list[Tally]]:
    """What the suite counts row by row, per table: one look at each row is enough."""
    tallies = {
        name: null_tallies(tables[name], suite.required.get(name, ())) + range_tallies(
            tables[name], suite.ranges.get(name, {})
        )
        for name in ("merchants", "customers", "transactions")
    }
    tallies["customers"].append(invalid_risk())
    tallies["transactions"] += [nonpositive_amount(), future_timestamp(as_of), success_unprocessed()]
    if suite.detect_anomalies:
        tallies["transactions"].append(odd_hours())
    return tallies


def counted_lines(session: SparkSession, table: str, tallies: list[Tally], counts: list[int]) -> DataFrame:
    """The report of tallies whose counts are known already."""
    return session.createDataFrame(
        [(t.check, table, t.column, t.severity, n or 0, t.detail) for t, n in zip(tallies, counts)], CHECK_ROW
    )


def check(
    tables: Mapping[str, DataFrame],
    as_of: date | datetime,
    suite: Suite = Suite(),
    counts: Mapping[str, list[int]] | None = None,
) -> DataFrame:
    """The whole suite. `counts` are those of `row_tallies` where they were taken before, by table."""
    counts = counts or {}
    frames = []
    for name, tallies in row_tallies(tables, as_of, suite).items():
        outliers = suite.detect_anomalies and name == "transactions"
        if name in counts:
            frames.append(counted_lines(tables[name].sparkSession, name, tallies, counts[name]))
            tallies = []
        if outliers:  # against a threshold that all amounts decide, so never in the pass that stores them
            tallies = [*tallies, high_amount_tally(tables[name])]
        frames.append(tally(tables[name], name, tallies))
    frames.append(check_excess_refunds(tables))
    for name in dict.fromkeys([*suite.unique, *[r[0] for r in suite.references], "transactions"]):
        references = [r for r in suite.references if r[0] == name]
        failing = suite.detect_anomalies and name == "transactions"
        frames.append(check_keys(tables, name, suite.unique.get(name, ()), references, failing))
    return combine(frames)


def config_gates(tables: Mapping[str, DataFrame], suite: Suite = Suite()) -> DataFrame:
    """Configured limits on null shares and on the success rate."""
    frames = [no_checks(next(iter(tables.values())).sparkSession)]
    for name, columns in suite.required.items():
        tallies = null_gate_tallies(tables[name], columns, suite.max_null_percentage)
        if name == "transactions":
            tallies.append(success_gate(suite.min_success_rate))
        frames.append(tally(tables[name], name, tallies))
    return combine(frames)


def verdict(report: DataFrame) -> DataFrame:
    """One row: failing errors, failing warnings, and whether the data may be used."""
    failing = F.col("bad_count") > 0
    errors = F.count_if(failing & (F.col("severity") == ERROR))
    return report.agg(
        errors.alias("total_errors"),
        F.count_if(failing & (F.col("severity") == WARNING)).alias("total_warnings"),
        (errors == 0).alias("is_valid"),
    )
