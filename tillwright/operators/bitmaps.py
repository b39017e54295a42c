"""Exact distinct counts of several id columns in the pass that sums the other figures.

Ids fall into buckets of 32,768 consecutive numbers, and a (group, column, bucket) is a bitmap of 4 KB. That pays
where a group holds a good part of a bucket's ids, as days do; for many small groups, such as merchants,
pairs of group and id are smaller.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHICH, ID, BITS = "_which", "_id", "_bits"


def by_bucket(
    rows: DataFrame, groups: Sequence[str], ids: Sequence[str], used: Sequence[str], totals: dict[str, Column]
) -> DataFrame:
    """One row per group, id column and bucket, with its bitmap and its share of the totals.

    Every row becomes one per id column, and all but the first of them have nulls for the columns `used` by the
    totals; `counted` counts a row once. Ids are whole numbers, negative ones too. A null id has no bit.
    """
    narrow = rows.select(
        *groups, *used, F.posexplode(F.array([F.col(c).cast("bigint") for c in ids])).alias(WHICH, ID)
    ).withColumns({c: F.when(F.col(WHICH) == 0, F.col(c)) for c in used})
    return narrow.groupBy(*groups, WHICH, F.bitmap_bucket_number(ID).alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(ID)).alias(BITS),
        *[total.alias(name) for name, total in totals.items()],
    )


def counted() -> Column:
    """Rows, in the totals of `by_bucket`."""
    return F.count_if(F.col(WHICH) == 0)


def distinct_ids(which: int) -> Column:
    """Distinct ids of the id column with this number, over the rows of `by_bucket`."""
    ones = F.when(F.col(WHICH) == which, F.bitmap_count(BITS))
    return F.coalesce(F.sum(ones), F.lit(0).cast("bigint"))
