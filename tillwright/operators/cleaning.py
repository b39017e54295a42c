"""One cleaner per table. Columns not named pass through; nothing is shuffled."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from ..functions import expressions as X
from ..functions import rules
from ..schemas import COLUMN_DEFAULTS, schema


def clean_merchants(merchants: DataFrame) -> DataFrame:
    created = _time(merchants, "created_at")
    return merchants.withColumns({
        "merchant_name": X.strip(F.col("merchant_name")),
        "merchant_email": F.lower("merchant_email"),
        "commission_rate": _bounded(merchants, "commission_rate", rules.COMMISSION_RANGE),
        "created_at": created,
        "updated_at": created,
    })


def clean_customers(customers: DataFrame) -> DataFrame:
    return customers.withColumns({
        "customer_email": X.strip(F.lower("customer_email")),
        "customer_name": X.strip(F.col("customer_name")),
        "risk_score": _bounded(customers, "risk_score", rules.RISK_RANGE),
        "customer_since": _time(customers, "customer_since").cast("date"),
        "created_at": _time(customers, "created_at"),
        "phone_number": F.coalesce("phone_number", F.lit(rules.NO_PHONE)),
    })


def clean_transactions(transactions: DataFrame) -> DataFrame:
    """Also derives the hour, Monday-based weekday, month and processing time."""
    typed = transactions.withColumns({
        "transaction_timestamp": _time(transactions, "transaction_timestamp"),
        "processed_timestamp": _time(transactions, "processed_timestamp", X.lenient_timestamp),
        "amount": F.abs("amount"),
        "transaction_status": X.strip(F.lower("transaction_status")),
    })
    at = F.col("transaction_timestamp")
    return typed.withColumns({
        "transaction_hour": F.hour(at),
        "transaction_day_of_week": F.weekday(at),
        "transaction_month": F.month(at),
        "processing_time_seconds": X.seconds_between(F.col("processed_timestamp"), at),
    })


def clean_payment_methods(methods: DataFrame) -> DataFrame:
    typed = methods.withColumn("created_at", _time(methods, "created_at"))
    return typed.fillna("", subset=["card_last_4", "card_brand"])


def clean_fraud_alerts(alerts: DataFrame) -> DataFrame:
    return alerts.withColumns({
        "created_at": _time(alerts, "created_at"),
        "resolved_at": _time(alerts, "resolved_at", X.lenient_timestamp),
        "risk_level": F.lower("risk_level"),
        "resolved_by": F.coalesce("resolved_by", F.lit(rules.UNRESOLVED_BY)),
    })


def clean_refunds(refunds: DataFrame) -> DataFrame:
    return refunds.withColumns({
        "requested_at": _time(refunds, "requested_at"),
        "processed_at": _time(refunds, "processed_at", X.lenient_timestamp),
        "refund_amount": F.abs("refund_amount"),
        "refund_status": F.lower("refund_status"),
    })


CLEANERS = {
    "merchants": clean_merchants,
    "customers": clean_customers,
    "payment_methods": clean_payment_methods,
    "transactions": clean_transactions,
    "fraud_alerts": clean_fraud_alerts,
    "refunds": clean_refunds,
}


def clean_all(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Clean every table that has a cleaner; hand on the others."""
    return {name: CLEANERS[name](df) if name in CLEANERS else df for name, df in tables.items()}


def conform_defaults(
    table: str, rows: DataFrame, now: datetime, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Give rows the table's columns: an absent column gets its default, a present null stays null.

    Columns named in `keep` stay behind the table's own.
    """
    defaults = COLUMN_DEFAULTS.get(table, {})
    columns = []
    for field in schema(table):
        if field.name in rows.columns:
            value = F.col(field.name)
        else:
            value = _default(defaults.get(field.name), now)
        columns.append(value.cast(field.dataType).alias(field.name))
    return rows.select(*columns, *keep)


def _default(value, now: datetime) -> Column:
    if value == "now":
        return X.instant(now)
    if value == "today":
        return X.instant(now).cast("date")
    return F.lit(value)


def _time(
    df: DataFrame, column: str, parse: Callable[[Column], Column] = X.strict_timestamp
) -> Column:
    """A column as a timestamp. One that already is stays bare, so filters on it reach the scan."""
    value = F.col(column)
    return value if isinstance(df.schema[column].dataType, TimestampType) else parse(value)


def _bounded(df: DataFrame, column: str, bounds: tuple[int, int]) -> Column:
    """Clip and keep the column's type."""
    return X.clip(F.col(column), *bounds).cast(df.schema[column].dataType)
