"""Class-balancing samples, reproducible because draws are hashes and not random numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from msgloom import constants as C
from msgloom.functions.text import hash_number
from msgloom.operators.features import class_counts, with_sample_weight
from msgloom.operators.ranking import smallest_n, with_rank

DRAWS = 1 << 32


def uniform_draw(key: Column, seed: int) -> Column:
    """A number strictly between 0 and 1 for each key."""
    drawn = hash_number(F.concat(F.lit(f"{seed}|"), key.cast("string")))
    return (drawn + 0.5) / float(DRAWS)


def weighted_sample(
    df: DataFrame,
    n: int | None,
    label_col: str = "label",
    key: str = "row_seq",
    seed: int = C.SEED,
) -> DataFrame:
    """n rows without replacement, a row's weight being 1 / rows of its class.

    A row's sort key is -ln(u) / weight, and the n smallest keys win. With n equal to the
    number of rows, or None, this is every row.
    """
    keyed = with_sample_weight(df, label_col).withColumn(
        "sample_key", -F.ln(uniform_draw(F.col(key), seed)) / F.col("sample_weight")
    )
    if n is None:
        return keyed
    bucket = F.floor(F.ln("sample_key") * 4096)
    return smallest_n(keyed, n, bucket, ["sample_key", key])


def weighted_sample_with_replacement(
    df: DataFrame,
    n: int,
    label_col: str = "label",
    key: str = "row_seq",
    seed: int = C.SEED,
) -> DataFrame:
    """n draws with replacement: each draw takes a class evenly, then a row of it evenly.

    That is the same as weights of 1 / class size. Rows are numbered inside their class and
    joined with the draws by (class, number), a key that is unique among the rows.
    """
    counts = class_counts(df, label_col)
    every = F.row_number().over(_all().orderBy("label"))
    classes = counts.select("label", "n", (every - 1).alias("class_no"), F.count("*").over(_all()).alias("k"))
    draws = (
        df.sparkSession.range(n)
        .withColumnRenamed("id", "draw")
        .withColumn("u_class", uniform_draw(F.concat(F.lit("class|"), F.col("draw")), seed))
        .withColumn("u_row", uniform_draw(F.concat(F.lit("row|"), F.col("draw")), seed))
    )
    k = classes.agg(F.max("k")).scalar()
    picked = (
        draws.withColumn("class_no", F.floor(F.col("u_class") * k).cast("int"))
        .join(F.broadcast(classes), "class_no")
        .select("draw", F.col("label").alias(label_col), (F.floor(F.col("u_row") * F.col("n")) + 1).alias("_no"))
    )
    shuffled = hash_number(F.concat(F.lit(f"{seed}|order|"), F.col(key).cast("string")))
    numbered = with_rank(
        df.withColumn("_h", shuffled), F.shiftright("_h", 16), ["_h", key], "_no", [label_col]
    )
    picked = picked.withColumnsRenamed({label_col: "_label", "_no": "_at"})
    same = numbered[label_col].eqNullSafe(picked["_label"]) & (numbered["_no"] == picked["_at"])
    return picked.join(numbered, same).drop("_no", "_h", "_label", "_at")


def _all():
    from pyspark.sql import Window

    return Window.partitionBy(F.lit(0))
