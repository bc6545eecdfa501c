"""Global order without a global sort in one task.

Rows are put in buckets by a pure, order-preserving expression. The counts of the
buckets give each bucket's offset, and rows are numbered inside their bucket only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def bucket_offsets(df: DataFrame, by: list[str], n: Column | None = None) -> DataFrame:
    """(…by, _bucket, _n, _before): rows in each bucket and in all lower ones."""
    counts = df.groupBy(*by, "_bucket").agg((F.count("*") if n is None else F.sum(n)).alias("_n"))
    over = (
        Window.partitionBy(*(by or [F.lit(0)]))
        .orderBy("_bucket")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return counts.withColumn("_before", F.coalesce(F.sum("_n").over(over), F.lit(0)))


def with_rank(
    df: DataFrame,
    bucket: Column,
    order_by: list[str | Column],
    output: str = "rank",
    by: list[str] | None = None,
) -> DataFrame:
    """Add the 1-based position in the order (bucket, *order_by), within `by` if given.

    `bucket` must not decrease along order_by, and should split the rows finely.
    """
    by = by or []
    work = df.withColumn("_bucket", bucket)
    offsets = bucket_offsets(work, by).select(*by, "_bucket", "_before")
    inside = Window.partitionBy(*by, "_bucket").orderBy(*order_by)
    return (
        work.withColumn("_turn", F.row_number().over(inside))
        .join(offsets, [*by, "_bucket"])
        .withColumn(output, F.col("_before") + F.col("_turn"))
        .drop("_bucket", "_turn", "_before")
    )


def smallest_n(df: DataFrame, n: int, bucket: Column, order_by: list[str | Column]) -> DataFrame:
    """The first n rows in the order (bucket, *order_by); n may be large.

    Counts by bucket, a pass over the columns of `bucket` only, give the bucket in which the
    n-th row falls. One filter over the rows follows; the rows that pass it, about n, are
    numbered inside their buckets, and the cut is made in that one bucket.
    """
    work = df.withColumn("_bucket", bucket)
    reached = bucket_offsets(work, []).filter(F.col("_before") < n)
    edge = reached.agg(F.max(F.struct("_bucket", "_before"))).scalar()
    turn = F.row_number().over(Window.partitionBy("_bucket").orderBy(*order_by))
    lower = F.col("_bucket") < edge["_bucket"]
    return (
        work.filter(F.col("_bucket") <= edge["_bucket"])
        .withColumn("_turn", turn)
        .filter(lower | (F.col("_turn") <= n - edge["_before"]))
        .drop("_bucket", "_turn")
    )
