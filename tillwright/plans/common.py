"""Steps that several reports share."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import expressions as X
from ..schemas import MONTH

Tables = Mapping[str, DataFrame]


def since(rows: DataFrame, column: str, as_of: date, days: int) -> DataFrame:
    """Rows from the last `days` days. There is no upper bound: later rows pass."""
    return rows.where(F.col(column) >= X.midnight(as_of, days))


def recent(tables: Tables, as_of: date, days: int) -> DataFrame:
    """Transactions of the last `days` days; a monthly store is asked for those months only."""
    rows = since(tables["transactions"], "transaction_timestamp", as_of, days)
    if MONTH in rows.columns:
        first_month = F.trunc(X.midnight(as_of, days), "month")
        rows = rows.where(F.col(MONTH) >= first_month)
    return rows


def day() -> Column:
    return F.to_date("transaction_timestamp")


def hour() -> Column:
    return F.hour("transaction_timestamp")
