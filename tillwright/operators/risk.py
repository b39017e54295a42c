"""Fraud indicators that look at a customer's previous transaction."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules


def with_previous_time(transactions: DataFrame, slot: str = "minute") -> DataFrame:
    """Add `prev_transaction_time`, the time of the customer's transaction just before.

    A plain lag over the customer sorts all rows of a customer in one task, which fails when one
    customer owns a large part of the table. Here no window sees a row: customers' distinct times are
    combined in each task first, with the lowest id at each. A time's predecessor comes from a lag
    inside (customer, time slot), or for a slot's first time from the last time of the customer's slot
    before, so a customer costs one narrow row per slot of calendar time in any one task, however
    many rows share an instant. The rows then look their own time up in a plain join, which adaptive
    execution splits where one customer and instant is very frequent. Of rows with equal times the one
    with the lowest id takes the earlier time, the others their own.
    """
    at = F.col("transaction_timestamp")
    # A null customer is a group of its own, as in a window partition.
    who = {"_who": F.coalesce("customer_id", F.lit(0).cast("bigint")), "_nobody": F.col("customer_id").isNull()}
    group = [*who, "_slot"]
    times = (
        transactions.where(at.isNotNull())
        .withColumns(who | {"_slot": F.date_trunc(slot, at)})
        .groupBy(*group, at.alias("_at"))
        .agg(F.min("transaction_id").alias("_first"))
    )
    inside = Window.partitionBy(*group).orderBy("_at")
    across = Window.partitionBy(*who).orderBy("_slot")
    carried = times.groupBy(*group).agg(F.max("_at").alias("_last")).select(
        *group, F.lag("_last").over(across).alias("_carried")
    )
    earlier = times.withColumn("_inside", F.lag("_at").over(inside)).join(carried, group).select(
        *who, "_at", "_first", F.coalesce("_inside", "_carried").alias("_earlier")
    )
    # Rows without a time have no previous one whatever their group, so they are spread by id.
    spread = who | {"_who": F.when(at.isNull(), F.col("transaction_id")).otherwise(who["_who"])}
    rows = transactions.withColumns(spread | {"_at": at})
    return (
        rows.join(earlier, [*who, "_at"], "left")
        .withColumn(
            "prev_transaction_time",
            F.when(F.col("transaction_id").eqNullSafe(F.col("_first")), F.col("_earlier")).otherwise(F.col("_at")),
        )
        .select(*transactions.columns, "prev_transaction_time")
    )


def fraud_patterns(
    transactions: DataFrame,
    rapid_seconds: int = rules.RAPID_SECONDS,
    high_amount: float = rules.HIGH_AMOUNT,
    night_hours: tuple[int, ...] = rules.NIGHT_HOURS,
    slot: str = "minute",
) -> DataFrame:
    """All rows with the previous time, the whole seconds since and whether the row is suspicious."""
    at = F.col("transaction_timestamp")
    gap = F.unix_timestamp(at) - F.unix_timestamp("prev_transaction_time")
    suspicious = (
        (F.col("time_diff_seconds") < rapid_seconds)
        | (F.col("amount") > high_amount)
        | F.hour(at).isin(*night_hours)
    )
    return (
        with_previous_time(transactions, slot)
        .withColumn("time_diff_seconds", gap)
        .withColumn("is_suspicious", F.coalesce(suspicious, F.lit(False)))
    )


def suspicious_transactions(transactions: DataFrame, **thresholds) -> DataFrame:
    return fraud_patterns(transactions, **thresholds).where("is_suspicious")


def suspicious_count(transactions: DataFrame, **thresholds) -> DataFrame:
    return fraud_patterns(transactions, **thresholds).agg(
        F.count_if("is_suspicious").alias("suspicious_count")
    )
