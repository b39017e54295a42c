import os
import sys
import time
from pathlib import Path

os.environ["TZ"] = "UTC"
time.tzset()
sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import pytest  # noqa: E402

from tillwright.session import build_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions="4",
        spark__driver__memory="6g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return DATA


@pytest.fixture
def make(spark):
    """Small tables from rows; timestamps may be given as text."""

    def build(ddl: str, rows: list[tuple]):
        from pyspark.sql import types as T

        schema = T.StructType.fromDDL(ddl)
        plain = T.StructType([
            T.StructField(f.name, T.StringType()) for f in schema
        ])
        texts = [tuple(None if v is None else str(v) for v in row) for row in rows]
        df = spark.createDataFrame(texts, plain)
        return df.select([df[f.name].cast(f.dataType).alias(f.name) for f in schema])

    return build


@pytest.fixture
def sales(make):
    """Transactions as (id, customer, amount, status, time)."""

    def build(rows: list[tuple]):
        return make(
            "transaction_id BIGINT, customer_id BIGINT, amount DECIMAL(15,2),"
            " transaction_status STRING, transaction_timestamp TIMESTAMP",
            rows,
        )

    return build
