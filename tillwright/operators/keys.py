"""Key operators: first row per key and keys without a parent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(rows: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """The first row of every key value.

    The filter on row_number lets Spark keep one row per key in each map task before the shuffle
    (WindowGroupLimit), so a key repeated in a third of all rows costs one row per task.
    """
    by_key = Window.partitionBy(key).orderBy(*order)
    return rows.withColumn("_nth", F.row_number().over(by_key)).where("_nth = 1").drop("_nth")


def orphan_keys(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Distinct non-null child keys that no parent row has.

    Distinct comes first: it combines on the map side, so a hot key reaches the join as one row.
    """
    wanted = child.where(F.col(child_key).isNotNull()).select(F.col(child_key).alias("key")).distinct()
    known = parent.select(F.col(parent_key).alias("key"))
    return wanted.join(known, "key", "left_anti")
