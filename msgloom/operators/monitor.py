"""Quality of live predictions over time, from the prediction log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def intent_events(logs: DataFrame) -> DataFrame:
    """(ts, intent, role, correct): each judged log row once as predicted and once as actual.

    One pass emits both roles, where a union would read the log twice.
    """
    def event(intent: str, role: str) -> Column:
        return F.struct(
            F.col("ts"), F.col(intent).alias("intent"), F.lit(role).alias("role"), F.col("correct")
        )

    return (
        logs.filter("correct is not null")
        .select(F.inline(F.array(event("pred", "predicted"), event("actual", "actual"))))
        .filter("intent is not null")
    )


def count_outcomes() -> list[Column]:
    """tp, fp and fn over intent events."""
    def hits(role: str, correct: int) -> Column:
        return F.count_if((F.col("role") == role) & (F.col("correct") == correct))

    return [
        hits("predicted", 1).alias("tp"),
        hits("predicted", 0).alias("fp"),
        hits("actual", 0).alias("fn"),
    ]


def daily_counts(logs: DataFrame) -> DataFrame:
    """(day, intent, tp, fp, fn)."""
    return (
        intent_events(logs)
        .groupBy(F.to_date("ts").alias("day"), "intent")
        .agg(*count_outcomes())
    )


def with_precision_recall(counts: DataFrame) -> DataFrame:
    """Add precision and recall as decimals of nine digits, null where undefined; rows
    without any outcome are left out.

    The counts are cast to a decimal wide enough for any number of rows.
    """
    def ratio(part: Column) -> Column:
        whole = F.nullif(F.col("tp") + part, F.lit(0).cast("bigint"))
        return (F.col("tp").cast("decimal(20,5)") / whole).cast("decimal(12,9)")

    return counts.filter(F.col("tp") + F.col("fp") + F.col("fn") > 0).withColumns(
        {"precision": ratio(F.col("fp")), "recall": ratio(F.col("fn"))}
    )


def daily_precision_recall(logs: DataFrame) -> DataFrame:
    """(day, intent, precision, recall) in the order of day and intent."""
    return (
        with_precision_recall(daily_counts(logs))
        .select("day", "intent", "precision", "recall")
        .orderBy("day", "intent")
    )


def judge(logs: DataFrame, truth: DataFrame, key: str = "row_seq") -> DataFrame:
    """Fill `actual` and `correct` of logged predictions from (key, actual) labels."""
    known = truth.select(key, F.col("actual").alias("_actual"))
    return (
        logs.join(known, key, "left")
        .withColumn("actual", F.coalesce("_actual", "actual"))
        .withColumn(
            "correct",
            F.when(F.col("actual").isNotNull(), (F.col("actual") == F.col("pred")).cast("int")),
        )
        .drop("_actual")
    )


def least_confident(df: DataFrame, n: int = 10, tie: str | None = None) -> DataFrame:
    """The n rows with the lowest confidence."""
    return df.orderBy("confidence", *([tie] if tie else [])).limit(n)
