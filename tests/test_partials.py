"""Day sums by month: a replaced month changes its own sums only, and every report equals the one over all rows."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tillwright.plans import partials, summaries
from tillwright.session import scratch_path
from tillwright.sinks import files, folders

AS_OF = date(2024, 3, 6)
DDL = (
    "transaction_id BIGINT, merchant_id BIGINT, amount DECIMAL(15,2), transaction_status STRING,"
    " transaction_timestamp TIMESTAMP"
)
ROWS = [
    (1, 1, "10.00", "success", "2024-01-05 10:00:00"), (2, 1, "5.50", "failed", "2024-01-05 11:00:00"),
    (3, 2, None, "success", "2024-01-31 23:59:59"), (4, None, "7.00", "refunded", "2024-02-01 00:00:00"),
    (5, 1, "99999999.99", "success", "2024-02-29 12:00:00"), (6, 2, "3.33", None, "2024-03-01 00:00:00"),
    (7, 2, "1.00", "success", "2024-03-05 08:00:00"), (8, 3, "2.00", "success", None), (9, 3, "2.00", "failed", None),
]


@pytest.fixture
def places(spark):
    return scratch_path(spark, "store"), scratch_path(spark, "sums")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def assert_equal_to_full(spark, store, sums):
    tables = {"transactions": spark.read.parquet(store).drop("transaction_month_start")}
    full = {
        "daily_transaction_summary": summaries.daily_transaction_summary(tables),
        "run_metrics": summaries.run_metrics(tables),
        "summary_report": summaries.summary_report(tables, AS_OF),
        "weekly_report": summaries.weekly_report(tables, AS_OF),
        "weekly_report_totals": summaries.weekly_report_totals(tables, AS_OF),
    }
    week = partials.read_sums(spark, store, sums, AS_OF - timedelta(days=7))
    kept = partials.all_reports(partials.read_sums(spark, store, sums), week, AS_OF)
    assert set(kept) == set(full)
    for name, frame in full.items():
        assert rows_of(kept[name]) == rows_of(frame), name
        assert kept[name].dtypes == frame.dtypes, name


def test_replacing_a_month_changes_its_sums_only(spark, make, places):
    store, sums = places
    files.write_months(make(DDL, ROWS), store)
    assert sorted(map(str, partials.refresh(spark, store, sums))) == ["2024-01-01", "2024-02-01", "2024-03-01", "None"]
    assert_equal_to_full(spark, store, sums)
    assert partials.refresh(spark, store, sums) == []
    before = {path: folders.matching(spark, f"{path}/*") for path in folders.matching(spark, f"{sums}/version=*")}

    files.write_months(make(DDL, [(10, 4, "8.00", "success", "2024-02-10 00:00:00")]), store)
    with pytest.raises(partials.StaleSums):
        partials.read_sums(spark, store, sums)
    partials.read_sums(spark, store, sums, date(2024, 3, 1))  # needs March only
    assert partials.refresh(spark, store, sums) == [date(2024, 2, 1)]
    assert_equal_to_full(spark, store, sums)
    after = {path: folders.matching(spark, f"{path}/*") for path in folders.matching(spark, f"{sums}/version=*")}
    assert {path: after[path] for path in before} == before
    assert len(after) == len(before) + 1


def test_a_refresh_reads_the_replaced_months_only(spark, make, places):
    store, sums = places
    files.write_months(make(DDL, ROWS), store)
    rows = spark.read.parquet(store).where(partials._is_one_of([date(2024, 2, 1)]))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "transaction_month_start" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert {r.transaction_id for r in rows.collect()} == {4, 5}
    none = spark.read.parquet(store).where(partials._is_one_of([None]))
    assert {r.transaction_id for r in none.collect()} == {8, 9}


def test_a_month_that_is_gone_no_longer_counts_and_is_cleared(spark, make, places):
    store, sums = places
    files.write_months(make(DDL, ROWS), store)
    partials.refresh(spark, store, sums)
    files.write_months(make(DDL, ROWS[:2]), store, whole_store=True)
    partials.refresh(spark, store, sums)
    assert_equal_to_full(spark, store, sums)
    assert len(partials.clear(spark, store, sums)) == 4
    assert_equal_to_full(spark, store, sums)
    assert partials.clear(spark, store, sums) == []


def test_sums_of_a_month_replaced_meanwhile_are_not_read(spark, make, places, monkeypatch):
    store, sums = places
    files.write_months(make(DDL, ROWS), store)
    listed = partials.versions(spark, store)
    files.write_months(make(DDL, [(10, 4, "8.00", "success", "2024-02-10 00:00:00")]), store)
    with monkeypatch.context() as patch:
        patch.setattr(partials, "versions", lambda *_: listed)
        partials.refresh(spark, store, sums)
    with pytest.raises(partials.StaleSums):
        partials.read_sums(spark, store, sums)
    assert partials.refresh(spark, store, sums) == [date(2024, 2, 1)]
    assert_equal_to_full(spark, store, sums)


def test_hot_merchant(spark, places):
    store, sums = places
    rows = spark.range(30_000).select(
        F.col("id").alias("transaction_id"), F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("merchant_id"),
        (F.col("id") % 100).cast("decimal(15,2)").alias("amount"),
        F.when(F.col("id") % 4 == 0, "failed").otherwise("success").alias("transaction_status"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 200).alias("transaction_timestamp"),
    )
    files.write_months(rows, store)
    partials.refresh(spark, store, sums)
    assert_equal_to_full(spark, store, sums)


def test_empty_store(spark, make, places):
    store, sums = places
    files.write_months(make(DDL, []), store)
    assert partials.refresh(spark, store, sums) == []
    empty = partials.read_sums(spark, store, sums)
    assert empty.collect() == []
    assert partials.run_metrics(empty).first().total_transactions == 0
