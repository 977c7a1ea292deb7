"""A seeded shuffle of rows with gapless ranks, without a window over a whole group.

The rank of a row in its group is the number of rows in earlier hash buckets of
the group plus its rank in its own bucket.  Buckets are sized from the number of
rows, so a group that holds a third of all rows is dealt over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: rows in a bucket, about
BUCKET_ROWS = 20_000


def buckets_for(rows: int, bucket_rows: int = BUCKET_ROWS) -> int:
    """Number of hash buckets: at least 64, so that small tables too use all cores."""
    return max(64, -(-rows // bucket_rows))


def shuffled(df: DataFrame, group: Sequence[str], tie: Sequence[str | Column], seed: int, buckets: int, weight: str | None = None) -> DataFrame:
    """df with `before`: the rows (or their weight) that come earlier in their group.

    The order is that of a hash of the tie columns and the seed, then of the tie
    columns themselves; rows equal in all of them are interchangeable.  The group
    columns must not be null.
    """
    value = F.lit(1).cast("long") if weight is None else F.col(weight)
    keyed = df.withColumn("_h", F.xxhash64(*tie, F.lit(seed)))
    keyed = keyed.withColumn("_b", F.expr(f"pmod(_h, {buckets})"))
    sums = keyed.groupBy(*group, "_b").agg(F.sum(value).alias("_s"))
    over = Window.partitionBy(*group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*group, "_b", F.coalesce(F.sum("_s").over(over), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(*group, "_b").orderBy("_h", *tie).rowsBetween(Window.unboundedPreceding, -1)
    ranked = keyed.withColumn("_in", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    # the window has dealt the rows by these very keys, so the join does not move them again
    joined = ranked.join(sums, [*group, "_b"])
    return joined.withColumn("before", F.col("_base") + F.col("_in")).drop("_h", "_b", "_in", "_base")
