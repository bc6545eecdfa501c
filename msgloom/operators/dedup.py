"""Duplicates: first or newest row of a key, and reports about them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _one_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    # A filter on row_number = 1 keeps one row of a key in each map task before the
    # shuffle, so that a key with a third of all rows still sends few of them.
    turn = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_turn", turn).filter(F.col("_turn") == 1).drop("_turn")


def first_per_key(df: DataFrame, keys: list[str], order_by: str | list[str | Column] = "row_seq") -> DataFrame:
    """Drop duplicates of the key columns, keeping the row that comes first."""
    order = [order_by] if isinstance(order_by, str) else order_by
    return _one_per_key(df, keys, [F.col(c).asc() if isinstance(c, str) else c.asc() for c in order])


def newest_known(df: DataFrame, keys: list[str] | None = None, order_by: str = "id") -> DataFrame:
    """The newest row of each hash, the last of `keys`, without the rows that have none."""
    keys = keys or ["md5_hash"]
    return _one_per_key(df.filter(F.col(keys[-1]).isNotNull()), keys, [F.desc(order_by)])


def newest_per_hash(df: DataFrame, hash_col: str = "md5_hash", order_by: str = "id") -> DataFrame:
    """Drop older rows of the same hash; rows without a hash all stay."""
    return newest_known(df, [hash_col], order_by).unionByName(df.filter(F.col(hash_col).isNull()))


def duplicate_report(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their counts, most frequent first."""
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("n"))
        .filter("n > 1")
        .orderBy(F.desc("n"), *keys)
    )


def dedup_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: rows before, rows after and rows dropped by first_per_key."""
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("n"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("n_before"),
            F.count("*").alias("n_after"),
            F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_dropped"),
        )
    )


def label_distribution(df: DataFrame, label_col: str = "label") -> DataFrame:
    """(label, n) in descending order of n."""
    return (
        df.groupBy(F.col(label_col).alias("label"))
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "label")
    )
