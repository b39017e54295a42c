from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillwright import fixtures
from tillwright.plans import insights, reports, summaries

AS_OF = date(2024, 1, 31)


def test_dated_reports_have_no_upper_bound(sales):
    rows = sales([
        (1, 1, 10, "success", "2024-01-01 00:00:00"),
        (2, 1, 10, "success", "2023-12-31 23:59:59"),
        (3, 1, 10, "success", "2024-06-01 00:00:00"),
    ]).withColumn("merchant_id", F.lit(1))
    report = reports.daily_revenue({"transactions": rows}, AS_OF).collect()
    assert [r["transaction_date"] for r in report] == [date(2024, 6, 1), date(2024, 1, 1)]


def test_daily_revenue_without_success(make):
    rows = make(
        "customer_id BIGINT, merchant_id BIGINT, amount DECIMAL(15,2), transaction_status STRING,"
        " transaction_timestamp TIMESTAMP",
        [
            (1, 1, "5.00", "failed", "2024-01-30 10:00:00"),
            (None, 2, "7.00", "refunded", "2024-01-30 11:00:00"),
        ],
    )
    (row,) = reports.daily_revenue({"transactions": rows}, AS_OF).collect()
    assert (row["total_transactions"], row["unique_customers"], row["unique_merchants"]) == (2, 1, 2)
    assert (row["total_revenue"], row["refunded_amount"]) == (0, Decimal("7.00"))
    assert row["avg_transaction_value"] is None and row["success_rate_pct"] == 0.0


def test_refund_rate_without_success_is_null(make):
    rows = make(
        "payment_type STRING, amount DECIMAL(15,2), transaction_status STRING,"
        " transaction_timestamp TIMESTAMP",
        [("upi", 1, "refunded", "2024-01-30 00:00:00")],
    )
    (row,) = reports.payment_method_performance({"transactions": rows}, AS_OF).collect()
    assert row["refund_rate_pct"] is None and row["success_rate_pct"] == 0.0


def _alerts(make, rows):
    return make(
        "alert_id BIGINT, transaction_id BIGINT, alert_type STRING, risk_level STRING,"
        " is_resolved BOOLEAN, created_at TIMESTAMP, resolved_at TIMESTAMP",
        rows,
    )


def test_resolution_hours_are_the_hour_component(make, sales):
    alerts = _alerts(make, [
        (1, 1, "t", "high", True, "2024-01-30 00:00:00", "2024-01-31 06:00:00"),
        (2, 1, "t", "high", False, "2024-01-30 00:00:00", None),
        (3, 9, "t", "high", False, "2024-01-30 00:00:00", None),
    ])
    tables = {
        "fraud_alerts": alerts,
        "transactions": sales([(1, 1, "2.50", "success", "2024-01-30 00:00:00")]),
    }
    (row,) = reports.fraud_alert_analysis(tables, AS_OF).collect()
    assert row["avg_resolution_hours"] == 6
    assert (row["alert_count"], row["affected_transactions"]) == (2, 1)
    assert row["total_amount_at_risk"] == Decimal("5.00")
    assert (row["resolved_count"], row["pending_count"]) == (1, 1)


def test_cohort_months_wrap_after_a_year(sales):
    rows = sales([
        (1, 1, 1, "success", "2023-12-15 00:00:00"),
        (2, 1, 1, "success", "2025-01-15 00:00:00"),
        (3, 1, 1, "failed", "2023-08-15 00:00:00"),
        (4, None, 1, "success", "2023-12-15 00:00:00"),
        (5, 2, 1, "success", "2023-01-15 00:00:00"),
    ])
    report = reports.cohort_retention({"transactions": rows}, AS_OF).collect()
    names = ("cohort_month", "activity_month", "active_customers", "months_since_first_purchase")
    december = datetime(2023, 12, 1)
    assert [tuple(r[n] for n in names) for r in report] == [
        (december, december, 1, 0), (december, datetime(2025, 1, 1), 1, 1),
    ]


def test_months_of_any_span_and_sign(sales):
    """Eleven years of one buyer, first months on both sides of a mask word, and a buyer from before."""
    months = [(y, m) for y in range(2023, 2034) for m in range(1, 13)][7:]  # from August 2023 on
    rows = [(i, 1, 1, "success", f"{y}-{m:02d}-15 00:00:00") for i, (y, m) in enumerate(months)]
    rows += [(900, 2, 1, "success", "1969-05-01 00:00:00"), (901, 2, 1, "success", "2024-01-01 00:00:00")]
    rows += [(902, 3, 1, "success", "2028-06-30 23:59:59"), (903, 3, 1, "success", "2028-07-01 00:00:00")]
    rows += [(904, 4, 1, "success", "2028-07-31 00:00:00"), (905, 4, 1, "success", "2033-12-01 00:00:00")]
    report = reports.cohort_retention({"transactions": sales(rows)}, AS_OF).collect()
    found = {(r["cohort_month"], r["activity_month"]): r["active_customers"] for r in report}
    expected = {(datetime(2023, 8, 1), datetime(y, m, 1)): 1 for y, m in months}
    expected |= {(datetime(2028, 6, 1), datetime(2028, m, 1)): 1 for m in (6, 7)}
    expected |= {(datetime(2028, 7, 1), datetime(2028, 7, 1)): 1, (datetime(2028, 7, 1), datetime(2033, 12, 1)): 1}
    assert found == expected
    assert all(r["months_since_first_purchase"] == (
        (r["activity_month"].year - r["cohort_month"].year) * 12 + r["activity_month"].month - r["cohort_month"].month
    ) % 12 for r in report)


def test_daily_distinct_counts_take_any_id(make):
    ids = [None, 0, -1, -32768, -32769, 32767, 32768, 32769, 5, 5, -5, 10**15, -(10**15)]
    rows = make(
        "transaction_id BIGINT, customer_id BIGINT, merchant_id INT, amount DECIMAL(15,2),"
        " transaction_status STRING, transaction_timestamp TIMESTAMP",
        [(i, c, i % 4 or None, 2, "success" if i % 2 else None, "2024-01-30 00:00:00") for i, c in enumerate(ids)]
        + [(99, None, None, None, None, "2024-01-29 00:00:00")],
    )
    one, other = reports.daily_revenue({"transactions": rows}, AS_OF).collect()
    assert (one["total_transactions"], one["unique_customers"], one["unique_merchants"]) == (13, 11, 3)
    assert (one["total_revenue"], one["avg_transaction_value"], one["success_rate_pct"]) == (12, 2, 46.15)
    assert (other["total_transactions"], other["unique_customers"], other["unique_merchants"]) == (1, 0, 0)


def test_top_merchants_ties_minimum_and_limit(make):
    rows = make(
        "transaction_id BIGINT, merchant_id BIGINT, customer_id BIGINT, amount DECIMAL(15,2),"
        " transaction_status STRING, transaction_timestamp TIMESTAMP",
        [(10 * m + i, m, i, 5, "success", "2024-01-30 00:00:00") for m in (3, 1, 2) for i in range(10)]
        + [(900 + i, 4, i, 500, "success", "2024-01-30 00:00:00") for i in range(9)]
        + [(950 + i, 5, i, 500, "success", "2024-01-30 00:00:00") for i in range(10)],
    )
    merchants = make(
        "merchant_id BIGINT, merchant_name STRING, business_type STRING",
        [(m, f"m{m}", "Food") for m in (1, 2, 3, 4)],
    )
    tables = {"transactions": rows, "merchants": merchants}
    report = reports.top_merchants(tables, AS_OF, limit=2).collect()
    assert [r["merchant_id"] for r in report] == [1, 2]


def test_lifetime_value_activity(make, sales):
    people = make(
        "customer_id BIGINT, customer_name STRING, customer_email STRING, risk_score INT",
        [(1, "a", "a", 1), (2, "b", "b", 1), (3, "c", "c", 1), (4, "d", "d", 1)],
    )
    rows = sales([
        (1, 1, "5000.01", "success", "2023-12-31 00:00:00"),
        (2, 2, "5000.00", "success", "2023-12-30 23:00:00"),
        (3, 3, "1.00", "failed", "2023-11-01 00:00:00"),
    ])
    report = reports.customer_lifetime_value(
        {"customers": people, "transactions": rows}, AS_OF
    ).collect()
    assert [(r["customer_id"], r["customer_segment"], r["activity_status"]) for r in report] == [
        (1, "VIP", "Inactive"), (2, "Premium", "Inactive"), (3, "New", "At Risk"),
    ]
    assert report[2]["avg_transaction_value"] is None


@pytest.mark.parametrize("status, expected", [("failed", 2), ("success", 0), (None, 0)])
def test_failed_transaction_counts_once_per_alert(make, sales, status, expected):
    tables = {
        "customers": make(
            "customer_id BIGINT, customer_email STRING, customer_name STRING, risk_score INT,"
            " is_blocked BOOLEAN",
            [(1, "a", "a", 71, False), (2, "b", "b", 70, False), (3, "c", "c", 1, True)],
        ),
        "transactions": sales([(1, 1, 5, status, "2024-01-01 00:00:00")]),
        "fraud_alerts": _alerts(make, [
            (1, 1, "t", "high", False, "2024-01-01 00:00:00", None),
            (2, 1, "t", "high", False, "2024-01-01 00:00:00", None),
        ]),
    }
    rows = {r["customer_id"]: r for r in summaries.high_risk_customers(tables).collect()}
    assert set(rows) == {1, 3}
    assert rows[1]["failed_transactions"] == expected
    assert (rows[1]["total_transactions"], rows[1]["fraud_alerts_count"]) == (1, 2)
    assert (rows[3]["total_transactions"], rows[3]["failed_transactions"]) == (0, 0)


def test_repeated_transaction_ids_count_once_but_fail_twice(make, sales):
    tables = {
        "customers": make(
            "customer_id BIGINT, customer_email STRING, customer_name STRING, risk_score INT,"
            " is_blocked BOOLEAN",
            [(1, "a", "a", 99, False)],
        ),
        "transactions": sales([(7, 1, 5, "failed", "2024-01-01 00:00:00")] * 2),
        "fraud_alerts": _alerts(make, [
            (n, 7, "t", "high", False, "2024-01-01 00:00:00", None) for n in (1, 2, 3)
        ]),
    }
    (row,) = summaries.high_risk_customers(tables).collect()
    assert (row["total_transactions"], row["fraud_alerts_count"], row["failed_transactions"]) == (1, 3, 6)


def test_metrics_of_an_empty_table(sales):
    (row,) = summaries.run_metrics({"transactions": sales([])}).collect()
    assert (row["total_transactions"], row["total_revenue"], row["total_refunded"]) == (0, 0, 0)
    assert row["avg_transaction_value"] is None and row["success_rate"] is None


def test_summary_text(sales):
    rows = sales([
        (1, 1, "1234567.80", "success", "2024-01-01 00:00:00"),
        (2, 1, "5", None, "2024-01-01 00:00:00"),
        (3, 1, "5", "failed", "2024-01-01 00:00:00"),
    ])
    (row,) = summaries.summary_report({"transactions": rows}, AS_OF).collect()
    assert row["report_date"] == "2024-01-31 00:00:00"
    assert row["total_transactions"] == "3"
    assert row["total_revenue"] == "$1,234,567.80"
    assert row["success_rate"] == "33.33%"
    assert row["average_transaction"] == "$1234567.80"


def test_daily_counts_add_up(spark, folder):
    tables = fixtures.clean_tables(spark, folder)
    total = insights.daily_volume(tables).agg(F.sum("transaction_count")).first()[0]
    assert total == tables["transactions"].count()
