"""Audits of prepared data: conflicts, collisions, placeholders, weights, ablation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from msgloom.functions import placeholders as P
from msgloom.operators.bounded import SALTS, computed_once, salted_join, small
from msgloom.operators.dedup import label_distribution


def conflict_keys(df: DataFrame) -> DataFrame:
    """(text_model, n_labels): model texts that carry more than one label."""
    return (
        df.groupBy("text_model")
        .agg(F.countDistinct("label").alias("n_labels"))
        .filter("n_labels > 1")
    )


def text_conflicts(df: DataFrame, limit: int | None = None) -> DataFrame:
    """(text, text_model, label, n) of the model texts with more than one label; n counts
    the rows.

    A hot model text is reduced to its distinct rows before the join, which is salted.
    `limit` gives an example table of that size.
    """
    columns = [c for c in ("text", "text_model", "label") if c in df.columns]
    # Both sides of the join start from the same grouped rows and share their shuffle. For
    # that, filters inferred for one side must stay above the grouping (computed_once), and
    # the other side must need n: the test on its sum holds for any conflict.
    rows = df.groupBy(*columns).agg(F.count("*").alias("n"))
    rows = computed_once(rows, {"text_model": F.col("text_model")})
    keys = (
        rows.groupBy("text_model")
        .agg(F.min("label").alias("low"), F.max("label").alias("high"), F.sum("n").alias("total"))
        .filter("low <> high and total > 1")
        .select("text_model")
    )
    # An inner join with unique keys: a semi-join would move below the grouping, and a hot
    # row would then meet the join with all its copies.
    found = salted_join(rows, keys, ["text_model"], columns).select(*columns, "n")
    return found if limit is None else found.orderBy(*columns).limit(limit)


def _raw_pairs(df: DataFrame, raw_col: str, order_by: str) -> DataFrame:
    pairs = df.groupBy("text_model", F.col(raw_col).alias("text_raw")).agg(
        F.min(order_by).alias("first_seq")
    )
    # The salt of a join is made of the raw text, and a filter inferred for it must stay above the
    # grouping as well, or the two sides of the join share no shuffle and the texts are prepared twice.
    return computed_once(pairs, {c: F.col(c) for c in ("text_model", "text_raw")})


def collision_rows(
    df: DataFrame, raw_col: str = "text_raw", order_by: str = "row_seq", salts: int = SALTS
) -> DataFrame:
    """(text_model, n_unique_raw, text_raw): every raw text of every model text that has more than one."""
    pairs = _raw_pairs(df, raw_col, order_by)
    counts = pairs.groupBy("text_model").agg(F.count("*").alias("n_unique_raw")).filter("n_unique_raw > 1")
    found = salted_join(pairs, counts, ["text_model"], ["text_raw"], salts=salts)
    return found.select("text_model", "n_unique_raw", "text_raw")


def collisions(
    df: DataFrame,
    raw_col: str = "text_raw",
    keys: int = 200,
    examples: int = 10,
    order_by: str = "row_seq",
) -> DataFrame:
    """A sample of collision_rows: the `keys` largest model texts (on a tie the one seen
    first), each with its first `examples` raw texts.

    Counts are over all rows. Only the wanted keys, at most `keys` of them, are joined
    back, and each is cut to its examples before the shuffle. The grouped pairs serve both
    sides from one shuffle.
    """
    pairs = _raw_pairs(df, raw_col, order_by)
    wanted = (
        pairs.groupBy("text_model")
        .agg(F.count("*").alias("n_unique_raw"), F.min("first_seq").alias("seen"))
        .filter("n_unique_raw > 1")
        .orderBy(F.desc("n_unique_raw"), "seen")
        .limit(keys)
        .drop("seen")
    )
    turn = F.row_number().over(Window.partitionBy("text_model").orderBy("first_seq"))
    return (
        pairs.join(F.broadcast(wanted), "text_model")
        .withColumn("turn", turn)
        .filter(F.col("turn") <= examples)
        .groupBy("text_model", "n_unique_raw")
        .agg(
            F.transform(
                F.sort_array(F.collect_list(F.struct("turn", "text_raw"))),
                lambda e: e["text_raw"],
            ).alias("examples_raw")
        )
    )


def collision_count(df: DataFrame, raw_col: str = "text_raw") -> DataFrame:
    """One row: how many model texts come from more than one raw text."""
    return (
        df.groupBy("text_model")
        .agg(F.countDistinct(raw_col).alias("n"))
        .agg(F.count_if(F.col("n") > 1).alias("n_collisions"))
    )


def placeholder_by_label(
    df: DataFrame, text_col: str = "text_model", label_col: str = "label"
) -> DataFrame:
    """(label, placeholder, n, support): occurrences of each placeholder by label.

    Labels without any placeholder don't appear. Rows and placeholders are counted in one
    pass: each row also emits one null placeholder, whose count is the support. Supports are
    one row for each label and are joined by broadcast, so that no task holds a label whole.
    """
    keys = F.concat(P.placeholder_keys(F.col(text_col)), F.array(F.lit(None).cast("string")))
    counts = (
        df.select(F.col(label_col).alias("label"), F.explode(keys).alias("placeholder"))
        .groupBy("label", "placeholder")
        .agg(F.count("*").alias("n"))
    )
    counts = computed_once(counts, {"placeholder": F.col("placeholder")})
    # The test on n keeps the count where a caller drops the support, so that both sides of the
    # join have the same columns and share one shuffle; else the texts are prepared twice.
    support = counts.filter("placeholder is null and n > 0").select(
        F.col("label").alias("_label"), F.col("n").alias("support")
    )
    found = counts.filter("placeholder is not null")
    support = small(support, what="labels")
    joined = found.join(support, found["label"].eqNullSafe(support["_label"]))
    return joined.select("label", "placeholder", "n", "support")


def placeholder_matrix(long: DataFrame, placeholders: list[str]) -> DataFrame:
    """placeholder_by_label with one column for each of the given placeholders."""
    return (
        long.groupBy("label", "support")
        .pivot("placeholder", placeholders)
        .agg(F.sum("n"))
        .na.fill(0, placeholders)
    )


def top_placeholders(long: DataFrame, k: int = 5) -> DataFrame:
    """The k most frequent placeholders of each label, with their rank."""
    turn = F.row_number().over(
        Window.partitionBy("label").orderBy(F.desc("n"), F.asc("placeholder"))
    )
    return long.withColumn("rank", turn).filter(F.col("rank") <= k).select(
        "label", "placeholder", "n", "rank"
    )


def labels_with_placeholder(
    df: DataFrame, name: str, text_col: str = "text_model", label_col: str = "label"
) -> DataFrame:
    """Label distribution of the rows in which [name] occurs."""
    return label_distribution(df.filter(P.has_placeholder(F.col(text_col), name)), label_col)


def weights_check(weights: DataFrame, mapping: DataFrame) -> DataFrame:
    """Weights (label, weight) against the mapping (label, id): one row for each label in
    either, and whether both sides have it."""
    return (
        mapping.select("label", "id")
        .join(weights.select("label", "weight"), "label", "full_outer")
        .withColumn("matched", F.col("id").isNotNull() & F.col("weight").isNotNull())
    )
