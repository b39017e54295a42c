import random
from decimal import ROUND_HALF_EVEN, Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillwright.plans import insights, profiles


def histogram(make, scores):
    customers = make("risk_score INT", [(s,) for s in scores])
    rows = insights.risk_score_histogram({"customers": customers}).collect()
    assert [r["bin"] for r in rows] == list(range(1, 21))
    return rows


@pytest.mark.parametrize("scores", [
    [0, 100, 50, 5, 4, 95, 99], [7] * 4, [1, 2], list(range(-10, 111)), [0, 119, 60, 59],
    random.Random(3).choices(range(101), k=500),
])
def test_histogram_equals_numpy(make, scores):
    rows = histogram(make, scores + [None])
    expected, edges = np.histogram(scores, bins=20)
    assert [r["customer_count"] for r in rows] == expected.tolist()
    assert [r["bin_start"] for r in rows] == pytest.approx(edges[:-1].tolist())
    assert [r["bin_end"] for r in rows] == pytest.approx(edges[1:].tolist())


def test_status_share_counts_nulls_in_the_whole(sales):
    rows = sales([(n, 1, 1, s, "2024-01-01 00:00:00") for n, s in enumerate(
        ["success", "success", "failed", None]
    )])
    report = insights.status_distribution({"transactions": rows}).collect()
    assert [tuple(r) for r in report] == [("Success", 2, 50.0), ("Failed", 1, 25.0)]


def test_unknown_merchant_keeps_its_place(make):
    rows = make(
        "merchant_id BIGINT, amount DECIMAL(15,2), transaction_status STRING",
        [(9, 100, "success"), (1, 50, "success"), (2, 50, "success"), (3, 99, "failed")],
    )
    merchants = make("merchant_id BIGINT, merchant_name STRING", [(1, "one"), (2, "t" * 31)])
    tables = {"transactions": rows, "merchants": merchants}
    top = insights.top5_merchants(tables).collect()
    assert [(r["rank"], r["merchant_id"], r["merchant_name"]) for r in top] == [
        (1, 9, None), (2, 1, "one"), (3, 2, "t" * 31),
    ]
    labels = [r["label"] for r in insights.top10_merchants_labelled(tables).collect()]
    assert labels == [None, "one", "t" * 30 + "..."]


def test_segmentation_rounds_half_even_then_averages(sales):
    data, n = [], 0
    picked = random.Random(5)
    for customer in range(40):
        for _ in range(picked.randrange(1, 9)):
            n += 1
            data.append((n, customer, f"{picked.randrange(1, 200000) / 100:.2f}", "success", "2024-01-01"))
    tables = {"transactions": sales(data)}
    spent: dict[int, list[Decimal]] = {}
    for _, customer, amount, _, _ in data:
        spent.setdefault(customer, []).append(Decimal(amount))
    cent = Decimal("0.01")
    for row in insights.customer_segmentation(tables).collect():
        amounts = spent[row["customer_id"]]
        assert row["total_spent"] == sum(amounts)
        expected = (sum(amounts) / len(amounts)).quantize(cent, ROUND_HALF_EVEN)
        assert row["avg_transaction"] == expected
        assert row["transaction_count"] == len(amounts)
    summary = insights.segment_summary(tables).collect()
    order = [r["segment"] for r in summary]
    assert order == [s for s in ("VIP", "Premium", "Regular", "New") if s in order]
    assert sum(r["customers"] for r in summary) == len(spent)
    assert sum(r["total_revenue"] for r in summary) == sum(map(sum, spent.values()))


def test_segments_partition_the_buyers(spark, folder):
    from tillwright import fixtures

    tables = fixtures.clean_tables(spark, folder)
    buyers = tables["transactions"].where("transaction_status = 'success'")
    total = insights.segment_summary(tables).agg(F.sum("customers")).first()[0]
    assert total == buyers.select("customer_id").distinct().count()


def test_customer_insights_counts_active_ids(make, sales):
    tables = {
        "customers": make("customer_id BIGINT, risk_score INT", [(1, 71), (2, 70), (3, None)]),
        "transactions": sales([
            (1, 1, 1, "failed", "2024-01-01"), (2, 1, 1, "failed", "2024-01-01"),
            (3, 8, 1, "failed", "2024-01-01"), (4, None, 1, "failed", "2024-01-01"),
        ]),
    }
    row = insights.customer_insights(tables).first()
    assert (row["total_customers"], row["active_customers"], row["high_risk_customers"]) == (3, 2, 1)
    assert row["high_risk_pct"] == pytest.approx(100 / 3)


def test_success_rate_is_sorted_and_unrounded(make):
    rows = make(
        "merchant_id BIGINT, payment_type STRING, amount DECIMAL(15,2), transaction_status STRING",
        [(2, "upi", 1, "success"), (1, "upi", 1, "success"), (1, "upi", 2, "failed"),
         (1, "upi", None, "pending")],
    )
    report = profiles.success_rate_by_merchant_type({"transactions": rows}).collect()
    assert [r["merchant_id"] for r in report] == [2, 1]
    assert report[1]["success_rate"] == 1 / 3 * 100
    assert report[1]["avg_transaction_amount"] == 1.5


def test_empty_tables(make, sales):
    tables = {"transactions": sales([]), "customers": make("customer_id BIGINT, risk_score INT", [])}
    assert insights.key_metrics(tables).first()["total_revenue"] == 0
    assert insights.customer_insights(tables).first()["total_customers"] == 0
    assert insights.status_distribution(tables).count() == 0
    assert insights.segment_summary(tables).count() == 0
