from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillwright import fixtures
from tillwright.operators import cleaning

NOW = datetime(2024, 5, 1, 12, 0)


def test_merchants(make):
    raw = make(
        "merchant_id BIGINT, merchant_name STRING, merchant_email STRING,"
        " commission_rate DECIMAL(5,2), created_at STRING",
        [
            (1, " \tShop ", " A@B.C", "-0.01", "2024-01-01 00:00:00"),
            (2, None, None, "0", "2024-01-01"),
            (3, "x", "x", "10.01", None),
            (4, "x", "x", None, "2024-01-01T01:02:03"),
        ],
    )
    rows = cleaning.clean_merchants(raw).orderBy("merchant_id").collect()
    assert rows[0]["merchant_name"] == "Shop"
    assert rows[0]["merchant_email"] == " a@b.c"
    assert [r["commission_rate"] for r in rows] == [0, 0, Decimal("10.00"), None]
    assert [r["updated_at"] for r in rows] == [r["created_at"] for r in rows]
    assert rows[3]["created_at"] == datetime(2024, 1, 1, 1, 2, 3)


def test_customers(make):
    raw = make(
        "customer_id BIGINT, customer_email STRING, customer_name STRING, phone_number STRING,"
        " customer_since STRING, risk_score INT, created_at STRING",
        [
            (1, " A@B.C ", " n ", None, "2021-02-03", -1, "2021-02-03 04:05:06"),
            (2, "a", "b", "1", None, 100, None),
            (3, "a", "b", "1", None, 101, None),
            (4, "a", "b", "1", None, None, None),
        ],
    )
    rows = cleaning.clean_customers(raw).orderBy("customer_id").collect()
    assert (rows[0]["customer_email"], rows[0]["customer_name"]) == ("a@b.c", "n")
    assert [r["phone_number"] for r in rows] == ["Not provided", "1", "1", "1"]
    assert rows[0]["customer_since"] == date(2021, 2, 3)
    assert [r["risk_score"] for r in rows] == [0, 100, 100, None]


def test_transactions(make):
    raw = make(
        "transaction_id BIGINT, amount DECIMAL(15,2), transaction_status STRING,"
        " transaction_timestamp STRING, processed_timestamp STRING",
        [
            (1, "-5.50", " SUCCESS\n", "2024-01-01 23:59:59.5", "2024-01-02 00:00:01"),
            (2, "5", "failed", "2024-01-07 00:00:00", "garbage"),
            (3, None, None, "2024-12-31 00:00:00", None),
        ],
    )
    first, second, third = cleaning.clean_transactions(raw).orderBy("transaction_id").collect()
    assert (first["amount"], first["transaction_status"]) == (Decimal("5.50"), "success")
    assert first["processing_time_seconds"] == 1.5
    assert (first["transaction_hour"], first["transaction_day_of_week"]) == (23, 0)
    assert second["processed_timestamp"] is None and second["processing_time_seconds"] is None
    assert second["transaction_day_of_week"] == 6
    assert third["transaction_month"] == 12 and third["amount"] is None


def test_bad_required_time_stops_the_job(make):
    raw = make(
        "amount DECIMAL(15,2), transaction_status STRING, transaction_timestamp STRING,"
        " processed_timestamp STRING",
        [("1", "success", "garbage", None)],
    )
    with pytest.raises(Exception, match="not a timestamp"):
        cleaning.clean_transactions(raw).collect()


def test_payment_methods(make):
    raw = make(
        "payment_method_id BIGINT, card_last_4 STRING, card_brand STRING, created_at STRING",
        [(1, None, None, "2022-01-01"), (2, "0042", "Visa", "2022-01-01")],
    )
    rows = cleaning.clean_payment_methods(raw).orderBy("payment_method_id").collect()
    assert [(r["card_last_4"], r["card_brand"]) for r in rows] == [("", ""), ("0042", "Visa")]


def test_fraud_alerts(make):
    raw = make(
        "alert_id BIGINT, risk_level STRING, is_resolved BOOLEAN, resolved_by STRING,"
        " created_at STRING, resolved_at STRING",
        [(1, " HIGH", True, None, "2024-01-01", "nonsense"), (2, "Low", False, "x", "2024-01-01", "")],
    )
    first, second = cleaning.clean_fraud_alerts(raw).orderBy("alert_id").collect()
    assert (first["risk_level"], first["resolved_by"], first["resolved_at"]) == (" high", "Pending", None)
    assert (second["risk_level"], second["resolved_by"], second["resolved_at"]) == ("low", "x", None)


def test_refunds(make):
    raw = make(
        "refund_id BIGINT, refund_amount DECIMAL(15,2), refund_status STRING,"
        " requested_at STRING, processed_at STRING",
        [(1, "-3.25", "Processed", "2024-01-01", "bad")],
    )
    row = cleaning.clean_refunds(raw).first()
    assert (row["refund_amount"], row["refund_status"]) == (Decimal("3.25"), "processed")
    assert row["processed_at"] is None


@pytest.mark.parametrize("name", sorted(cleaning.CLEANERS))
def test_cleaning_twice_changes_nothing(spark, folder, name):
    once = cleaning.CLEANERS[name](fixtures.RAW_TABLES[name](spark, folder))
    twice = cleaning.CLEANERS[name](once)
    assert twice.columns == once.columns
    assert once.exceptAll(twice).count() == 0
    assert once.count() == fixtures.RAW_TABLES[name](spark, folder).count()


def test_clean_all_hands_on_other_tables(spark, folder):
    raw = dict(fixtures.raw_tables(spark, folder))
    raw["extra"] = spark.range(3)
    cleaned = cleaning.clean_all(raw)
    assert set(cleaned) == set(raw)
    assert cleaned["extra"] is raw["extra"]


def test_defaults_fill_absent_columns_only(make):
    row = cleaning.conform_defaults(
        "customers",
        make("customer_id BIGINT, customer_email STRING, risk_score INT", [(1, "a", None)]),
        NOW,
    ).first()
    assert row["risk_score"] is None
    assert (row["total_transactions"], row["total_spent"]) == (0, Decimal("0.00"))
    assert row["is_blocked"] is False
    assert (row["customer_since"], row["created_at"]) == (date(2024, 5, 1), NOW)


def test_defaults_of_every_table_fit_their_schema(spark):
    from tillwright.schemas import COLUMN_DEFAULTS, TABLE_DDL, schema

    for table in TABLE_DDL:
        filled = cleaning.conform_defaults(table, spark.range(1).select(F.lit(1).alias("_")), NOW)
        assert filled.columns == schema(table).names
        row = filled.first()
        for column in COLUMN_DEFAULTS.get(table, {}):
            assert row[column] is not None
