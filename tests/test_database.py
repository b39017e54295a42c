"""Options and order only: no database is started here."""

from datetime import date

import pytest

from tillwright.schemas import LOAD_ORDER
from tillwright.sinks import database as sinks
from tillwright.sources import database as sources


class Recorder:
    """Stands in for a DataFrame reader or writer and keeps what it is told."""

    def __init__(self):
        self.calls = {}

    def __getattr__(self, name):
        def call(*args, **kwargs):
            self.calls[name] = kwargs or args
            return self

        return call


class Session:
    def __init__(self):
        self.read = Recorder()


def test_parallel_read_options():
    session = Session()
    sources.read_table(
        session, "jdbc:x", "transactions", {"user": "u"}, "transaction_id", (0, 1000), 8
    )
    assert session.read.calls["format"] == ("jdbc",)
    assert session.read.calls["options"] == {
        "url": "jdbc:x", "user": "u", "dbtable": "transactions", "fetchsize": "10000",
        "partitionColumn": "transaction_id", "lowerBound": "0", "upperBound": "1000",
        "numPartitions": "8",
    }


def test_plain_read_has_no_partition_options():
    session = Session()
    sources.read_table(session, "jdbc:x", "customers")
    assert set(session.read.calls["options"]) == {"url", "dbtable", "fetchsize"}


def test_half_given_partitioning_is_refused():
    with pytest.raises(ValueError):
        sources.read_table(Session(), "jdbc:x", "t", column="id")


def test_query_is_pushed_to_the_database():
    session = Session()
    sources.read_query(session, "jdbc:x", "SELECT 1")
    assert session.read.calls["options"] == {"url": "jdbc:x", "query": "SELECT 1"}


def test_month_predicates_cover_every_row_once(spark):
    conditions = sources.month_predicates("at", date(2023, 11, 5), date(2024, 2, 1))
    assert len(conditions) == 4
    rows = spark.sql(
        "SELECT * FROM VALUES ('2020-01-01'), ('2023-11-30'), ('2023-12-01'), ('2024-01-31'),"
        " ('2024-02-01'), ('2030-01-01'), (NULL) AS t(at)"
    )
    counts = [rows.where(c).count() for c in conditions]
    assert counts == [3, 1, 1, 2]
    assert sources.month_predicates("at", date(2024, 1, 1), date(2024, 1, 9)) == ["1 = 1"]


@pytest.mark.parametrize("given, mode", [("replace", "overwrite"), ("append", "append")])
def test_write_modes(given, mode):
    class Frame:
        write = Recorder()

    sinks.write_table(Frame, "jdbc:x", "refunds", given, connections=4)
    assert Frame.write.calls["mode"] == (mode,)
    assert Frame.write.calls["options"] == {
        "url": "jdbc:x", "dbtable": "refunds", "numPartitions": "4", "batchsize": "10000",
        "truncate": "true",
    }


def test_load_goes_parents_first_without_derived_columns(spark, folder):
    from tillwright import fixtures

    clean = dict(fixtures.clean_tables(spark, folder))
    seen = {}
    shuffled = {name: clean[name] for name in sorted(clean, reverse=True)}
    assert tuple(sinks.load_tables(shuffled, lambda n, df: seen.update({n: df.columns}))) == LOAD_ORDER
    assert tuple(seen) == LOAD_ORDER
    assert "transaction_hour" in clean["transactions"].columns
    assert not {"transaction_hour", "transaction_day_of_week", "transaction_month",
                "processing_time_seconds"} & set(seen["transactions"])


def test_load_some_tables(spark):
    frames = {"transactions": spark.range(1), "merchants": spark.range(1)}
    assert sinks.load_tables(frames, lambda n, df: None) == ["merchants", "transactions"]


def test_replacing_everything_truncates_through_references(monkeypatch):
    from tillwright.sinks import database

    seen = []

    class Frame:
        def drop(self, *columns):
            return self

    monkeypatch.setattr(database, "write_table", lambda *a, **k: seen.append((a[2], a[3], k["cascade"])))
    database.load_database({name: Frame() for name in LOAD_ORDER}, "jdbc:x")
    assert seen == [(name, "replace", True) for name in LOAD_ORDER]
    seen.clear()
    database.load_database({"merchants": Frame()}, "jdbc:x")
    assert seen == [("merchants", "replace", False)]


def test_cascade_is_asked_for_only_when_replacing():
    class Frame:
        write = Recorder()

    for mode, wanted in (("replace", "true"), ("append", None)):
        sinks.write_table(Frame, "jdbc:x", "merchants", mode, cascade=True)
        assert Frame.write.calls["options"].get("cascadeTruncate") == wanted


def test_hash_parts_cover_every_row_once(spark):
    parts = sources.hash_predicates("id", 5)
    rows = spark.createDataFrame([(i,) for i in [*range(-20, 50), None]], "id BIGINT")
    assert sum(rows.where(p).count() for p in parts) == 71
