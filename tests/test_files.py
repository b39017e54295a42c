from datetime import date
from decimal import Decimal

import pytest

from tillwright import fixtures
from tillwright.operators.cleaning import clean_transactions
from tillwright.sinks import files as sinks
from tillwright.sources import files as sources

from tests.compare import plan_text


def write(path, text):
    path.write_text(text, encoding="utf-8")


def test_csv_keeps_json_and_leading_zeros(spark, tmp_path):
    write(
        tmp_path / "transactions.csv",
        "transaction_id,amount,gateway_response_code,processed_timestamp,metadata,extra\n"
        '1,10.50,00,,"{""device_type"": ""mobile"", ""browser"": ""Chrome""}",x\n'
        "2,,05,garbage,,y\n",
    )
    first, second = sources.read_csv(
        spark, str(tmp_path / "transactions.csv"), "transactions"
    ).orderBy("transaction_id").collect()
    assert first["metadata"] == '{"device_type": "mobile", "browser": "Chrome"}'
    assert (first["gateway_response_code"], first["amount"]) == ("00", Decimal("10.50"))
    assert (second["amount"], second["processed_timestamp"], second["extra"]) == (None, "garbage", "y")


def test_csv_columns_go_by_name(spark, tmp_path):
    write(
        tmp_path / "payment_methods.csv",
        "payment_method_id,customer_id,payment_type,is_default,card_last_4\n7,3,upi,True,0042\n",
    )
    rows = sources.read_csv(spark, str(tmp_path / "payment_methods.csv"), "payment_methods")
    row = rows.first()
    assert (row["customer_id"], row["is_default"], row["card_last_4"]) == (3, True, "0042")
    assert dict(rows.dtypes)["customer_id"] == "bigint"


def test_csv_line_breaks_inside_values(spark, tmp_path):
    write(tmp_path / "t.csv", 'transaction_id,description\n1,"two\nlines"\n2,one\n')
    rows = sources.read_csv(spark, str(tmp_path / "t.csv"), "transactions", multiline=True)
    assert {r["description"] for r in rows.collect()} == {"two\nlines", "one"}


@pytest.mark.parametrize("table", sorted(fixtures.RAW_TABLES))
def test_processed_csv_round_trip(spark, folder, tmp_path, table):
    cleaned = fixtures.clean_tables(spark, folder)[table]
    sinks.write_csv_tables({table: cleaned}, str(tmp_path))
    back = sources.read_csv_tables(spark, str(tmp_path), (table,), processed=True)[table]
    assert back.columns == cleaned.columns
    assert dict(back.dtypes) == dict(cleaned.dtypes)
    if table == "payment_methods":  # an empty text and a missing one are the same in CSV
        back = back.fillna("", subset=["card_last_4", "card_brand"])
    assert back.exceptAll(cleaned).count() == cleaned.exceptAll(back).count() == 0


def test_parquet_round_trip_and_backup(spark, folder, tmp_path):
    refunds = fixtures.clean_tables(spark, folder)["refunds"]
    sinks.write_parquet_tables({"refunds": refunds}, str(tmp_path))
    back = sources.read_parquet_tables(spark, str(tmp_path), ("refunds",))["refunds"]
    assert back.exceptAll(refunds).count() == 0 and back.count() == refunds.count()
    for _ in range(2):
        sinks.write_backup({"refunds": refunds}, str(tmp_path / "b"), date(2024, 1, 31))
    names = [p.name for p in (tmp_path / "b/backup_date=2024-01-31/refunds").glob("*.parquet")]
    assert names and all(".gz." in name for name in names)
    assert spark.read.parquet(str(tmp_path / "b")).count() == refunds.count()


@pytest.fixture
def months(spark, sales, tmp_path):
    rows = sales([
        (1, 1, 1, "success", "2026-03-31 23:59:59.999999"),
        (2, 1, 1, "success", "2026-04-01 00:00:00"),
        (3, 1, 1, "success", "2026-04-30 23:59:59"),
        (4, 1, 1, "success", "2026-05-01 00:00:00"),
    ])
    sinks.write_months(rows, str(tmp_path / "months"))
    return str(tmp_path / "months")


def test_months_are_half_open(spark, months):
    april = sources.read_months(spark, months, date(2026, 4, 1), date(2026, 5, 1))
    assert {r["transaction_id"] for r in april.collect()} == {2, 3}
    stored = spark.read.parquet(months)
    assert {str(r[0]) for r in stored.select("transaction_month_start").distinct().collect()} == {
        "2026-03-01", "2026-04-01", "2026-05-01",
    }


def test_month_filter_opens_those_months_only(spark, months):
    rows = sources.read_months(spark, months, date(2026, 4, 15))
    filters = plan_text(rows).split("PartitionFilters: [")[1].split("]")[0]
    assert "transaction_month_start" in filters and "2026-04-01" in filters
    assert {r["transaction_id"] for r in rows.collect()} == {3, 4}


def test_raw_csv_set_can_be_cleaned(spark, tmp_path):
    write(
        tmp_path / "transactions.csv",
        "transaction_id,amount,transaction_status,transaction_timestamp,processed_timestamp\n"
        "1,-3.5, SUCCESS ,2024-01-01 10:00:00.5,\n2,4,failed,2024-01-01T11:00:00,not a time\n",
    )
    raw = sources.read_csv_tables(spark, str(tmp_path), ("transactions",))["transactions"]
    rows = clean_transactions(raw).orderBy("transaction_id").collect()
    assert [r["amount"] for r in rows] == [Decimal("3.50"), Decimal("4.00")]
    assert [r["processed_timestamp"] for r in rows] == [None, None]
    assert rows[0]["transaction_status"] == "success"


def test_files_with_another_column_order_fail(spark, tmp_path):
    folder = tmp_path / "refunds.csv"
    folder.mkdir()
    (folder / "a.csv").write_text("refund_id,transaction_id,refund_reason\n1,2,x\n")
    (folder / "b.csv").write_text("refund_id,refund_reason,transaction_id\n3,y,4\n")
    with pytest.raises(Exception, match="header"):
        sources.read_csv(spark, str(folder), "refunds").collect()


def test_blanks_empty_texts_and_nulls_survive(spark, tmp_path):
    rows = [(1, "  padded  "), (2, ""), (3, None), (4, "\ttab"), (5, '"q" , x')]
    df = spark.createDataFrame(rows, "refund_id BIGINT, refund_reason STRING")
    sinks.write_csv_tables({"refunds": df}, str(tmp_path))
    back = sources.read_csv_tables(spark, str(tmp_path), ("refunds",), processed=True)["refunds"]
    assert sorted((r[0], r[1]) for r in back.collect()) == rows


def test_months_are_replaced_one_by_one(spark, tmp_path):
    def month(amount, *days):
        return spark.createDataFrame(
            [(amount, day) for day in days], "amount INT, at STRING"
        ).selectExpr("amount", "CAST(at AS TIMESTAMP) AS transaction_timestamp")

    path = str(tmp_path / "months")
    sinks.write_months(month(1, "2026-01-05", "2026-01-06"), path)
    sinks.write_months(month(2, "2026-02-01"), path)
    sinks.write_months(month(3, "2026-02-02"), path)
    assert sorted(r["amount"] for r in sources.read_months(spark, path).collect()) == [1, 1, 3]
    sinks.write_months(month(4, "2026-03-01"), path, whole_store=True)
    assert [r["amount"] for r in sources.read_months(spark, path).collect()] == [4]


REFUNDS = "refund_id,transaction_id,refund_amount,refund_reason,refund_status"


def _refunds(tmp_path, lines, header=REFUNDS):
    (tmp_path / "refunds.csv").mkdir()
    (tmp_path / "refunds.csv" / "part.csv").write_text("\n".join([header, *lines]) + "\n")
    return f"{tmp_path}/refunds.csv"


def test_unreadable_rows_are_set_apart_and_the_others_load(spark, tmp_path):
    wrong = ["2,11,ten,late,done", "3,11,1.00,late,done,more", "x,11,1.00,late,done", "5,11"]
    right = ["1,10,5.25,broken,done", '4,,,"a, ""b""",', "6,12,7.00, blank ,done"]
    path = _refunds(tmp_path, [right[0], *wrong, *right[1:]])
    good, bad = sources.read_csv_apart(spark, path, "refunds")
    assert sorted(r.refund_id for r in good.collect()) == [1, 4, 6]
    assert sorted(r.line for r in bad.collect()) == sorted(wrong)
    assert {r.table_name for r in bad.collect()} == {"refunds"} and bad.first().file.endswith("part.csv")
    # What is asked for does not change which rows count.
    assert good.count() == 3 and bad.count() == 4
    assert sorted(r[0] for r in good.select("refund_reason").collect()) == [" blank ", 'a, "b"', "broken"]
    assert good.schema == sources.read_csv(spark, path, "refunds").schema


def test_a_table_without_bad_rows_or_without_rows(spark, tmp_path):
    good, bad = sources.read_csv_apart(spark, _refunds(tmp_path, []), "refunds")
    assert good.collect() == bad.collect() == []


def test_a_column_may_have_the_name_of_the_line(spark, tmp_path):
    path = _refunds(tmp_path, ["1,a", "x,b"], "refund_id,_line")
    good, bad = sources.read_csv_apart(spark, path, "refunds")
    assert [tuple(r) for r in good.collect()] == [(1, "a")]
    assert [r.line for r in bad.collect()] == ["x,b"]
