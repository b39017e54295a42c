from datetime import date

import pytest

from tillwright import fixtures
from tillwright.operators import quality
from tillwright.plans import batch, reports
from tillwright.session import scratch_path, shared_folder
from tillwright.sources import catalog

AS_OF = date(2024, 1, 31)


@pytest.fixture(scope="module")
def raw_folder(spark, folder, tmp_path_factory):
    """The raw tables as the CSV files a run starts from."""
    path = str(tmp_path_factory.mktemp("raw"))
    for name, table in fixtures.raw_tables(spark, folder).items():
        (
            table.write.options(header=True, quote='"', escape='"')
            .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .csv(f"{path}/{name}.csv")
        )
    return path


def test_run_from_csv_equals_direct_reports(spark, folder, raw_folder, tmp_path):
    paths = batch.run_batch(
        spark, raw_folder, str(tmp_path), AS_OF, stop_on_errors=False, backup=True
    )
    direct = batch.all_reports(fixtures.clean_tables(spark, folder), AS_OF)
    assert set(paths) == set(direct) | {"quality"}
    for name in direct:
        stored, frame = spark.read.parquet(paths[name]), direct[name]
        assert stored.columns == frame.columns, name
        assert stored.exceptAll(frame).count() == frame.exceptAll(stored).count() == 0, name
    backup = spark.read.parquet(f"{tmp_path}/backups/backup_date=2024-01-31/transactions")
    assert backup.count() == fixtures.clean_tables(spark, folder)["transactions"].count()


def test_quality_gate_stops_the_run(spark, raw_folder, tmp_path):
    with pytest.raises(batch.InvalidData, match="checks failed"):
        batch.run_batch(spark, raw_folder, str(tmp_path), AS_OF)
    report = spark.read.parquet(str(tmp_path / "quality"))
    failing = {r["check"] for r in report.where("severity = 'error' AND bad_count > 0").collect()}
    assert failing == {"referential", "excess_refund"}
    assert not (tmp_path / "reports").exists()


def test_a_chosen_suite_lets_the_run_pass(spark, raw_folder, tmp_path, monkeypatch):
    monkeypatch.setattr(batch, "all_reports", lambda tables, as_of: {})
    suite = quality.Suite(references=())
    with pytest.raises(batch.InvalidData, match="1 checks failed"):
        batch.run_batch(spark, raw_folder, str(tmp_path), AS_OF, suite)


def test_transaction_analysis(spark, folder):
    rows = fixtures.clean_tables(spark, folder)["transactions"]
    results = batch.transaction_analysis(rows)
    assert set(results) == {"success_rate", "hourly_patterns", "fraud_patterns", "customer_clv"}
    assert results["fraud_patterns"].count() == rows.count()


def test_views_answer_sql(spark, folder):
    tables = fixtures.clean_tables(spark, folder)
    catalog.publish(tables)
    assert catalog.run_sql(spark, "SELECT count(*) FROM customers").first()[0] == tables["customers"].count()
    total = catalog.run_sql(spark, "SELECT sum(total_transactions) FROM daily_transaction_summary")
    assert total.first()[0] == tables["transactions"].count()
    risky = catalog.run_sql(
        spark, "SELECT count(*) FROM high_risk_customers WHERE risk_score > :limit", limit=90
    )
    assert risky.first()[0] == tables["customers"].where("risk_score > 90").count()


def test_gateway_rows(spark):
    rows = catalog.payment_gateways(spark, AS_OF).orderBy("gateway_id").collect()
    assert [r["gateway_id"] for r in rows] == [1, 2, 3, 4]
    assert all(r["is_active"] and r["created_at"] is not None for r in rows)


def test_nothing_is_read_before_it_is_asked_for(spark, folder):
    tables = fixtures.clean_tables(spark, folder)
    reports.refund_analysis(tables, AS_OF)
    assert set(tables._made) == {"refunds"}


def test_shared_folder_is_the_configured_one():
    class Session:
        class conf:
            @staticmethod
            def get(key, default):
                return "/shared/folder/" if key == "spark.checkpoint.dir" else default

    assert shared_folder(Session) == "/shared/folder"
    assert scratch_path(Session, "x").startswith("/shared/folder/x-")
    assert scratch_path(Session, "x") != scratch_path(Session, "x")


def test_shared_folder_of_a_cluster_must_be_configured():
    class Session:
        class conf:
            @staticmethod
            def get(key, default):
                return default

        class sparkContext:
            master = "yarn"

            @staticmethod
            def getCheckpointDir():
                return None

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session)


def test_counts_taken_while_storing_equal_a_second_look(spark, folder, tmp_path):
    """The raw tables, which fail some checks; the suite then reads transactions for what rows alone cannot tell."""
    from tests.compare import plan_text
    from tillwright.plans import summaries

    tables = fixtures.raw_tables(spark, folder)
    tallies = quality.row_tallies(tables, AS_OF)
    found = batch.store_processed(tables, str(tmp_path), tallies)
    stored = batch.read_processed(spark, str(tmp_path), AS_OF)
    plain = quality.check(stored, AS_OF)
    given = quality.check(stored, AS_OF, counts=found.counts)
    assert sorted(map(tuple, given.collect())) == sorted(map(tuple, plain.collect()))
    assert sum(sum(counts) for counts in found.counts.values()) > 0
    assert found.metrics == summaries.run_metrics(stored).first().asDict()
    assert plan_text(given).count("FileScan parquet") <= plan_text(plain).count("FileScan parquet") - 2


def test_a_task_that_is_tried_again_counts_once(tmp_path):
    """Tasks fail after their last row: for customers the writing task itself, for transactions the one before it."""
    import subprocess
    import sys
    import textwrap

    script = textwrap.dedent("""
        import sys
        from pyspark import TaskContext
        from tillwright.operators import quality
        from tillwright.plans import batch
        from tillwright.session import build_session

        spark = build_session("retry", "local[2,2]", spark__ui__enabled="false", spark__sql__shuffle__partitions="3")
        spark.sparkContext.setLogLevel("OFF")

        def once(batches):
            yield from batches
            if TaskContext.get().attemptNumber() == 0:
                raise RuntimeError("first attempt, after its last row")

        rows = spark.range(0, 100, 1, 3).selectExpr(
            "id AS transaction_id", "CAST(id AS DECIMAL(15,2)) AS amount", "'success' AS transaction_status",
            "TIMESTAMP '2024-01-01' AS transaction_timestamp",
        )
        rows = rows.mapInArrow(once, rows.schema)
        tallies = {"transactions": quality.null_tallies(rows, ["amount"]) + [quality.nonpositive_amount()]}
        tallies["customers"] = tallies["transactions"]
        found = batch.store_processed({"transactions": rows, "customers": rows}, sys.argv[1], tallies)
        print("found", found.counts["transactions"], found.counts["customers"], found.metrics["total_transactions"])
    """)
    from pathlib import Path

    done = subprocess.run(
        [sys.executable, "-c", script, str(tmp_path / "out")], capture_output=True, text=True, timeout=300,
        cwd=Path(__file__).resolve().parent.parent,
    )
    assert "found [0, 1] [0, 1] 100" in done.stdout, done.stderr[-2000:]


def test_a_run_may_set_unreadable_rows_apart(spark, raw_folder, tmp_path, monkeypatch):
    import shutil

    monkeypatch.setattr(batch, "all_reports", lambda tables, as_of: {})
    raw = shutil.copytree(raw_folder, tmp_path / "raw")
    header = spark.read.option("header", True).csv(f"{raw}/customers.csv").columns
    (raw / "customers.csv" / "late.csv").write_text(
        ",".join(header) + "\n" + "\n".join([",".join(["unknown"] * len(header)), "1,2"]) + "\n"
    )
    paths = batch.run_batch(spark, str(raw), str(tmp_path / "out"), AS_OF, stop_on_errors=False, quarantine=True)
    apart = spark.read.parquet(paths["quarantine"])
    assert [(r.table_name, r.file.rsplit("/", 1)[1]) for r in apart.collect()] == [("customers", "late.csv")] * 2
    stored = spark.read.parquet(str(tmp_path / "out/processed/customers"))
    assert stored.count() == spark.read.option("header", True).csv(f"{raw_folder}/customers.csv").count()
