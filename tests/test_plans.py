"""Plans as a cluster would get them: no dimension small enough to broadcast on its own."""

from datetime import date

import pytest

from tests.compare import plan_text
from tillwright import fixtures
from tillwright.operators import keys, quality, risk
from tillwright.plans import batch, insights, reports, summaries
from tillwright.schemas import MONTH
from pyspark.sql import functions as F

AS_OF = date(2024, 1, 31)


@pytest.fixture(scope="module")
def stored(spark, folder, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans"))
    clean = fixtures.clean_tables(spark, folder)
    batch.store_processed({name: clean[name] for name in fixtures.RAW_TABLES}, path)
    return batch.read_processed(spark, path, AS_OF)


@pytest.fixture(autouse=True)
def large(spark):
    keys_ = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for key in keys_:
        spark.conf.set(key, "-1")
    yield
    for key in keys_:
        spark.conf.unset(key)


def shuffles(plan: str) -> int:
    return plan.count("Exchange hashpartitioning")


def scanned(plan: str) -> list[set[str]]:
    """Columns of each scan, without the partition column."""
    schemas = [part.split(">")[0] for part in plan.split("ReadSchema: struct<")[1:]]
    return [{c.split(":")[0] for c in schema.split(",") if ":" in c} for schema in schemas]


def all_frames(stored):
    frames = batch.all_reports(stored, AS_OF)
    frames["quality"] = quality.check(stored, AS_OF)
    return frames


def test_nothing_leaves_the_jvm_or_multiplies_rows(stored):
    for name, frame in all_frames(stored).items():
        plan = plan_text(frame)
        for forbidden in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "BroadcastHashJoin"):
            assert forbidden not in plan, (name, forbidden)


def test_dated_reports_prune_months_and_push_the_time(stored):
    for report in (reports.daily_revenue, reports.top_merchants, summaries.weekly_report):
        plan = plan_text(report(stored, AS_OF))
        partition = plan.split("PartitionFilters: [")[1].split("]")[0]
        pushed = plan.split("PushedFilters: [")[1].split("]")[0]
        assert MONTH in partition
        assert "GreaterThanOrEqual(transaction_timestamp" in pushed


def test_only_needed_columns_are_read(stored):
    (columns,) = scanned(plan_text(reports.hourly_patterns_sql(stored, AS_OF)))
    assert columns == {"amount", "transaction_status", "transaction_timestamp"}
    (columns,) = scanned(plan_text(insights.daily_volume(stored)))
    assert columns == {"transaction_timestamp"}
    assert {"customer_id", "transaction_timestamp"} in scanned(
        plan_text(risk.suspicious_count(stored["transactions"]))
    )


def test_facts_shrink_before_a_dimension_join(stored):
    """Under the join with the dimension there is an aggregate, not a scan of the facts."""
    for frame in (
        reports.top_merchants(stored, AS_OF),
        reports.customer_lifetime_value(stored, AS_OF),
        reports.geographic(stored, AS_OF),
        reports.gateway_performance(stored, AS_OF),
    ):
        below = plan_text(frame).split("SortMergeJoin")[1]
        above_facts = below[: below.index("FileScan")]
        assert "partial_sum" in above_facts


def test_no_window_of_the_risk_plan_sees_rows(stored):
    plan = plan_text(risk.fraud_patterns(stored["transactions"]))
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 2 and all("lag(_at" in w or "lag(_last" in w for w in windows)
    left = plan[plan.index("SortMergeJoin"):]
    left = left[:left.index("FileScan")]
    assert left.count("Exchange") == 1 and "hashpartitioning(_who" in left


def test_only_transactions_of_risky_customers_meet_alerts(stored):
    plan = plan_text(summaries.high_risk_customers(stored))
    joined = plan[plan.index("hashpartitioning(transaction_id"):]
    assert "LeftSemi" in joined[:joined.index("fraud_alerts")] if "fraud_alerts" in joined else "LeftSemi" in joined
    assert "risk_score" in joined[joined.index("LeftSemi"):]


def test_dated_queries_put_the_time_on_the_scan(spark, folder):
    from tillwright import registry

    dated = (
        "daily_revenue", "top_merchants", "payment_method_performance", "fraud_alert_analysis",
        "hourly_patterns_sql", "geographic", "refund_analysis", "gateway_performance", "weekly_report",
        "weekly_report_totals", "sql_query_scan",
    )
    for name in dated:
        plan = plan_text(registry.queries()[name](spark, folder))
        scans = [line for line in plan.splitlines() if "FileScan" in line and "event_id" in line]
        assert scans and all("GreaterThanOrEqual(ts," in line for line in scans), name


def test_repeated_keys_are_cut_before_the_shuffle(spark, folder):
    rows = fixtures.clean_tables(spark, folder)["transactions"]
    plan = plan_text(keys.first_per_key(rows, "transaction_uuid", [F.col("transaction_timestamp")]))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_orphans_are_distinct_before_the_join(stored):
    plan = plan_text(
        keys.orphan_keys(stored["transactions"], "merchant_id", stored["merchants"], "merchant_id")
    )
    assert "LeftAnti" in plan
    assert plan.index("HashAggregate") > plan.index("LeftAnti")


def test_top_reports_do_not_sort_everything(stored):
    for frame in (reports.top_merchants(stored, AS_OF), insights.top5_merchants(stored)):
        assert "TakeOrderedAndProject" in plan_text(frame)


def test_single_table_checks_share_one_scan(stored):
    suite = quality.Suite(unique={}, references=(), detect_anomalies=False)
    plan = plan_text(quality.check(stored, AS_OF, suite))
    # One pass per table, and two for the refund rule's join.
    assert plan.count("FileScan parquet") == 5


def test_daily_revenue_reads_its_rows_once(stored):
    plan = plan_text(reports.daily_revenue(stored, AS_OF))
    assert plan.count("FileScan parquet") == 1 and "Join" not in plan
    assert "bitmap_construct_agg" in plan


def test_cohorts_need_no_window(stored):
    plan = plan_text(reports.cohort_retention(stored, AS_OF))
    assert "Window" not in plan and plan.count("FileScan parquet") == 1
    assert shuffles(plan) == 3 and "partial_bit_or" in plan


def test_the_suite_reads_transactions_four_times(stored):
    """Tallies, the outlier threshold they need, keys, and the refund rule."""
    plan = plan_text(quality.check(stored, AS_OF))
    reads = [part for part in plan.split("FileScan parquet")[1:] if "/transactions]" in part.split("\n")[0]]
    assert len(reads) <= 4
