import json
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillwright import fixtures
from tillwright.operators.cleaning import conform_defaults
from tillwright.streaming import ingest, messages, sources

NOW = datetime(2024, 6, 1)


def message(uuid="u1", amount=10.0, at="2024-05-01T10:00:00.123456", **changes):
    body = {
        "transaction_id": uuid, "merchant_id": 5, "customer_id": 7, "amount": amount,
        "currency": "USD", "payment_type": "upi", "transaction_status": "success",
        "customer_ip": "10.0.0.1", "timestamp": at, "gateway_id": 2,
        "metadata": {"device_type": "mobile", "browser": "Chrome"},
    }
    body.update(changes)
    return json.dumps({k: v for k, v in body.items() if v is not ...})


@pytest.fixture
def received(spark):
    """Messages in the order they were delivered."""
    return lambda *texts: spark.createDataFrame(
        list(enumerate(texts)), f"{messages.POSITION} INT, value STRING"
    ).select("value", messages.POSITION)


@pytest.fixture
def parsed(received):
    return lambda *texts: messages.parse(received(*texts))


def test_decode(parsed):
    (row,) = messages.decode(parsed(message()), NOW).collect()
    assert (row["transaction_uuid"], row["merchant_id"], row["customer_id"]) == ("u1", 5, 7)
    assert row["payment_method_id"] == 1 and row["gateway_id"] == 2
    assert row["amount"] == Decimal("10.00")
    assert row["transaction_timestamp"] == datetime(2024, 5, 1, 10, 0, 0, 123456)
    assert json.loads(row["metadata"]) == {"device_type": "mobile", "browser": "Chrome"}
    assert row["is_test_transaction"] is False and row["processed_timestamp"] is None


def test_metadata_may_be_missing_or_have_other_keys(parsed):
    rows = messages.decode(
        parsed(message(metadata=...), message("u2", metadata={"x": [1, {"y": "z"}]})), NOW
    ).orderBy("transaction_uuid").collect()
    assert rows[0]["metadata"] == "{}"
    assert json.loads(rows[1]["metadata"]) == {"x": [1, {"y": "z"}]}


@pytest.mark.parametrize("text", [
    "not json", "", "{", "[1]", "null", message(uuid=...), message(amount=...),
    message(amount="much"), message(transaction_status=None), message(at="yesterday-ish"),
    message(merchant_id="abc"), message(amount=1e20), message(merchant_id=...), message(currency=...),
    message(gateway_id=...), message(customer_ip=...), message(payment_type=...), message(customer_id=...),
])
def test_unusable_messages_are_kept_apart(parsed, text):
    both = parsed(text, message())
    assert [r["value"] for r in messages.malformed(both).collect()] == [text]
    assert messages.decode(both, NOW).count() == 1


def test_a_field_that_is_null_is_there(parsed):
    (row,) = messages.decode(parsed(message(merchant_id=None, customer_ip=None)), NOW).collect()
    assert row["merchant_id"] is None and row["customer_ip"] is None


def test_first_delivery_wins(parsed):
    rows = messages.decode(
        parsed(
            message("a", 1, "2024-05-01T10:00:01"), message("a", 2, "2024-05-01T10:00:00"),
            message("b", 3), message("b", 3),
        ),
        NOW,
    )
    kept = {r["transaction_uuid"]: r["amount"] for r in messages.first_deliveries(rows).collect()}
    assert kept == {"a": 1, "b": 3}


def test_alert_limit_is_strict(parsed):
    rows = messages.decode(parsed(message("a", 1500.00), message("b", 1500.01)), NOW)
    (alert,) = messages.high_value_alerts(rows).collect()
    assert alert["transaction_uuid"] == "b"
    assert (alert["alert_type"], alert["risk_level"]) == ("High value transaction", "high")
    assert alert["alert_message"] == "Transaction amount exceeds threshold"
    assert alert["is_resolved"] is False and alert["created_at"] is not None


def test_encode_then_decode_gives_the_rows_back(spark, folder):
    rows = conform_defaults("transactions", fixtures.clean_tables(spark, folder)["transactions"], NOW)
    sent = messages.encode(rows)
    assert sent.columns == ["key", "value"]
    back = messages.decode(messages.parse(sent), NOW)
    columns = [
        "transaction_uuid", "merchant_id", "customer_id", "gateway_id", "amount", "currency",
        "transaction_status", "payment_type", "transaction_timestamp",
    ]
    assert messages.POSITION not in back.columns
    assert back.select(columns).exceptAll(rows.select(columns)).count() == 0
    assert back.count() == rows.count()


def test_message_key(spark):
    assert spark.range(7, 8).select(messages.message_key(F.col("id"))).first()[0] == "customer_7"


def test_probe(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x\n" * 25)
    found = sources.file_batch(spark, str(tmp_path))
    assert sources.require_messages(found) == 10
    assert sources.require_messages(found, sample=50) == 25
    with pytest.raises(RuntimeError):
        sources.require_messages(found.where("value = 'y'"))


def test_a_slow_probe_is_given_up(spark):
    slow = spark.range(0, 10**12, 1, 4).where("hash(id) = 1 AND hash(id + 1) = 2").selectExpr("CAST(id AS STRING) AS value")
    with pytest.raises(TimeoutError):
        sources.require_messages(slow, seconds=1)
    assert spark.range(3).count() == 3


def test_kafka_options():
    assert sources.kafka_options("h:1", maxOffsetsPerTrigger=500, group=None) == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "payment-transactions",
        "startingOffsets": "earliest", "maxOffsetsPerTrigger": "500",
    }
    stream = sources.stream_options("h:1")
    assert stream["kafka.group.id"] == "transaction-processor-group"
    assert int(stream["maxOffsetsPerTrigger"]) > 0
    assert "maxOffsetsPerTrigger" not in sources.stream_options("h:1", maxOffsetsPerTrigger=None)
    probe = sources.probe_options("h:1")
    assert "kafka.group.id" not in probe and "maxOffsetsPerTrigger" not in probe
    assert sources.probe_options("h:1", group="own")["kafka.group.id"] == "own"


@pytest.fixture
def run(spark, tmp_path):
    """Ingest whatever lies in the inbox, as one process run."""
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    store = ingest.FileStore(spark, str(tmp_path / "store"))

    def go(texts=None, name="m"):
        if texts is not None:
            (inbox / name).write_text("\n".join(texts) + "\n")
        stream = sources.file_stream(spark, str(inbox))
        ingest.start_ingest(
            stream, ingest.store_batch(store, lambda: NOW), str(tmp_path / "checkpoint"),
            available_now=True,
        ).awaitTermination()

    go.store = store
    return go


def amounts(store):
    return sorted((r["transaction_uuid"], float(r["amount"])) for r in store.read("transactions").collect())


def alerts(spark, store):
    return sorted(r["transaction_uuid"] for r in store.read("fraud_alerts").collect())


def test_ingest_end_to_end(spark, run):
    run([message("a", 10), message("b", 2000), message("b", 2000), "broken"], "1")
    run([message("b", 2000), message("c", 1501, "2024-05-02T00:00:00")], "2")
    run()
    assert amounts(run.store) == [("a", 10.0), ("b", 2000.0), ("c", 1501.0)]
    assert alerts(spark, run.store) == ["b", "c"]
    bad = run.store.read("quarantine").collect()
    assert [bytes(r["value"]) for r in bad] == [b"broken"]


def test_late_rows_are_not_dropped(run):
    run([message("a", at="2024-05-20T00:00:00")], "1")
    run([message("b", at="2020-01-01T00:00:00")], "2")
    assert [uuid for uuid, _ in amounts(run.store)] == ["a", "b"]


def test_batch_of_unusable_messages_only(spark, run):
    run(["x", "y"], "1")
    assert amounts(run.store) == [] and alerts(spark, run.store) == []
    assert run.store.read("quarantine").count() == 2
    run([message("a")], "2")
    assert amounts(run.store) == [("a", 10.0)]


def test_replayed_batch_changes_nothing(spark, tmp_path):
    store = ingest.FileStore(spark, str(tmp_path))
    batch = spark.createDataFrame(
        [(message("a", 1600),), (message("b", 5),), ("bad",)], "value STRING"
    )
    process = ingest.store_batch(store, lambda: NOW)
    process(batch, 0)
    before = (amounts(store), alerts(spark, store))
    process(batch, 0)
    assert (amounts(store), alerts(spark, store)) == before
    process(batch, 1)
    assert (amounts(store), alerts(spark, store)) == before


def test_batch_that_failed_between_tables_is_completed(spark, tmp_path, monkeypatch):
    store = ingest.FileStore(spark, str(tmp_path))
    batch = spark.createDataFrame([(message("a", 1600),)], "value STRING")
    process = ingest.store_batch(store, lambda: NOW)

    def lost(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(ingest.M, "high_value_alerts", lost)
    with pytest.raises(RuntimeError, match="lost"):
        process(batch, 0)
    monkeypatch.undo()
    process(batch, 0)
    assert amounts(store) == [("a", 1600.0)]
    assert alerts(spark, store) == ["a"]


def test_nothing_to_read_before_the_first_batch(spark, tmp_path):
    store = ingest.FileStore(spark, str(tmp_path))
    for table in ("transactions", "fraud_alerts", "quarantine", "keys"):
        assert store.read(table).collect() == []


@pytest.mark.parametrize("buckets", [1, 7, 64])
def test_a_uuid_is_stored_once_however_it_returns(received, spark, tmp_path, buckets):
    """Within a batch, in a later one, under another day, with another amount: the first arrival stays."""
    deliveries = [
        message("a", 20, "2024-05-02T00:00:00"), message("b", 1600), message("a", 10, "2024-05-01T00:00:00"),
        message("b", 5, "2020-01-01T00:00:00"), message("c", 7), message("a", 1900, "2025-01-01T00:00:00"),
        message("c", 1800), message("d", 1501), message("d", 3),
    ]
    for cuts in ((9,), (2, 9), (1, 3, 5, 9), tuple(range(1, 10))):
        store = ingest.FileStore(spark, str(tmp_path / f"{len(cuts)}"), buckets)
        process = ingest.store_batch(store, lambda: NOW)
        for number, (a, b) in enumerate(zip((0, *cuts), cuts)):
            process(received(*deliveries[a:b]), number)
        assert amounts(store) == [("a", 20.0), ("b", 1600.0), ("c", 7.0), ("d", 1501.0)]
        assert alerts(spark, store) == ["b", "d"]


def test_many_rows_in_two_overlapping_batches(spark, tmp_path):
    store = ingest.FileStore(spark, str(tmp_path))
    process = ingest.store_batch(store, lambda: NOW)
    texts = [message(str(n), 1400 + n, f"2024-05-{n % 4 + 1:02d}T00:00:00") for n in range(120)]
    for number, part in enumerate((texts[:80], texts[40:])):
        process(spark.createDataFrame([(t,) for t in part], "value STRING"), number)
    assert len(amounts(store)) == 120
    assert len(alerts(spark, store)) == 19


def test_files_are_read_in_the_order_they_came(run):
    run([message("a", 1), message("a", 2), message("b", 3, "2024-05-09T00:00:00"), message("b", 4)], "1")
    run([message("b", 5), message("c", 6), message("c", 7)], "2")
    assert amounts(run.store) == [("a", 1.0), ("b", 3.0), ("c", 6.0)]


def test_bounded_state_deduplication(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    for number, texts in enumerate(([message("a"), message("a")], [message("a"), message("b")])):
        (inbox / str(number)).write_text("\n".join(texts) + "\n")
    stream = sources.file_stream(spark, str(inbox), max_files=1)
    unique = messages.deduplicate_stream(messages.decode(messages.parse(stream), NOW))
    (
        unique.writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True).start().awaitTermination()
    )
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted(r["transaction_uuid"] for r in rows) == ["a", "b"]


def test_stream_equals_batch(spark, folder, run, tmp_path):
    rows = conform_defaults("transactions", fixtures.clean_tables(spark, folder)["transactions"], NOW)
    messages.encode(rows).select("value").coalesce(3).write.text(str(tmp_path / "sent"))
    for part in (tmp_path / "sent").glob("part-*"):
        (tmp_path / "inbox" / part.name).write_text(part.read_text())
    run()
    batch = messages.first_deliveries(messages.decode(messages.parse(messages.encode(rows)), NOW))
    stored = run.store.read("transactions").select(batch.columns)
    assert stored.exceptAll(batch).count() == batch.exceptAll(stored).count() == 0
    expected = sorted(r[0] for r in messages.high_value_alerts(batch).select("transaction_uuid").collect())
    assert alerts(spark, run.store) == expected


class Tables:
    """A database in miniature: append-only Parquet, ids given on insert."""

    def __init__(self, spark, root):
        self.spark, self.root, self.next_id = spark, root, 1

    def read(self, table):
        ddl = {
            "transactions": "transaction_id BIGINT, transaction_uuid STRING, amount DECIMAL(15,2),"
                            " transaction_timestamp TIMESTAMP",
            "fraud_alerts": "transaction_id BIGINT, alert_type STRING, risk_level STRING",
        }[table]
        (self.root / table).mkdir(exist_ok=True)
        return self.spark.read.schema(ddl).parquet(str(self.root / table))

    def append(self, table, rows):
        if table == "transactions":
            assert "transaction_id" not in rows.columns and "transaction_date" not in rows.columns
            rows = rows.withColumn("transaction_id", F.monotonically_increasing_id() + self.next_id)
            self.next_id += 1_000_000_000_000
        rows.write.mode("append").parquet(str(self.root / table))


def test_database_store(spark, tmp_path):
    tables, kept = Tables(spark, tmp_path), []
    process = ingest.store_batch_in_tables(
        ingest.TableStore(tables.read, tables.append),
        lambda bad: kept.extend(bytes(r["value"]).decode() for r in bad.collect()),
        lambda: NOW,
    )
    first = spark.createDataFrame(
        [(message("a", 1600),), (message("b", 5),), (message("a", 1600),), ("bad",)], "value STRING"
    )
    second = spark.createDataFrame([(message("a", 1600),), (message("c", 9999),)], "value STRING")
    for batch, number in ((first, 0), (first, 0), (second, 1)):
        process(batch, number)
    rows = {r["transaction_uuid"]: r["transaction_id"] for r in tables.read("transactions").collect()}
    assert set(rows) == {"a", "b", "c"} and len(set(rows.values())) == 3
    alerted = [r["transaction_id"] for r in tables.read("fraud_alerts").collect()]
    assert sorted(alerted) == sorted([rows["a"], rows["c"]])
    assert kept == ["bad", "bad"]


def test_alerts_missing_after_a_failure_are_added(spark, tmp_path):
    tables = Tables(spark, tmp_path)
    append = tables.append

    def failing(table, rows):
        if table == "fraud_alerts":
            raise RuntimeError("lost")
        append(table, rows)

    batch = spark.createDataFrame([(message("a", 1600),)], "value STRING")
    for act in (failing, append):
        process = ingest.store_batch_in_tables(
            ingest.TableStore(tables.read, act), lambda bad: None, lambda: NOW
        )
        if act is failing:
            with pytest.raises(RuntimeError, match="lost"):
                process(batch, 0)
        else:
            process(batch, 0)
    assert tables.read("transactions").count() == 1
    assert tables.read("fraud_alerts").count() == 1


def test_alerts_follow_what_is_stored(received, spark, tmp_path):
    tables = Tables(spark, tmp_path)
    process = ingest.store_batch_in_tables(
        ingest.TableStore(tables.read, tables.append), lambda bad: None, lambda: NOW
    )
    process(received(message("a", 100)), 0)
    process(received(message("a", 2000), message("b", 1700), message("b", 3)), 1)
    stored = {r["transaction_uuid"]: float(r["amount"]) for r in tables.read("transactions").collect()}
    assert stored == {"a": 100.0, "b": 1700.0}
    assert tables.read("fraud_alerts").count() == 1


def test_keys_are_read_in_parts(spark):
    table, parts = ingest.keys_query("fraud_alerts", 4)
    assert table == "(SELECT transaction_id, alert_type FROM fraud_alerts) AS compared"
    rows = spark.createDataFrame([(i,) for i in [*range(-9, 30), None]], "transaction_id BIGINT")
    counts = [rows.where(part).count() for part in parts]
    assert len(parts) == 4 and sum(counts) == 40 and min(counts) > 0
