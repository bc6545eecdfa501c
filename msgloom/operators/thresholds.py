"""Per-class confidence thresholds from the precision-recall curve."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from msgloom import constants as C
from msgloom.operators.bounded import bounded, computed_once, small

# Scores are put in buckets of equal width in log-odds, where softmax outputs spread out.
# A class has at most 2 * ODDS_LIMIT * BUCKETS_PER_UNIT + 1 of them.
ODDS_LIMIT = 40
BUCKETS_PER_UNIT = 1024


def _bucket(score: Column) -> Column:
    """Order-preserving bucket of a probability; a pure function of it."""
    limit = F.lit(float(ODDS_LIMIT))
    odds = (
        F.when(score <= 0, -limit)
        .when(score >= 1, limit)
        .otherwise(F.least(F.greatest(F.ln(score / (1.0 - score)), -limit), limit))
    )
    return F.floor(odds * BUCKETS_PER_UNIT).cast("int")


def class_thresholds(
    df: DataFrame,
    mapping: DataFrame,
    min_threshold: float = C.DEFAULT_THRESHOLD,
    default: float = C.NO_POSITIVES_THRESHOLD,
    shift: int = 1,
    true_col: str = "true_id",
    probs_col: str = "probs",
    score_digits: int | None = None,
) -> DataFrame:
    """(label, id, best_f1, threshold): the score at which a class reaches its best F1.

    The lowest such score wins a tie, and no threshold is below min_threshold. A class
    without positive rows gets `default`. shift=1 judges a threshold by the point of the
    next higher score, i.e. by rows scored strictly above it; shift=0 by rows at or above.

    Suffix sums over all scores of a class don't run in one task: rows are first counted
    by (class, score), then summed inside narrow score buckets, and each bucket adds the
    total of the buckets above it. score_digits rounds scores to have fewer of them.
    """
    score = F.col("score") if score_digits is None else F.round("score", score_digits)
    points = (
        df.select(
            F.col(true_col).alias("true_id"), F.posexplode(probs_col).alias("id", "score")
        )
        .groupBy("id", score.alias("score"))
        .agg(
            F.count("*").alias("n_all"),
            F.count_if(F.col("true_id") == F.col("id")).alias("n_pos"),
        )
    )
    # Both uses below share the shuffle of the counted points.
    points = computed_once(points, {"id": F.col("id"), "bucket": _bucket(F.col("score"))})
    above = (
        Window.partitionBy("id")
        .orderBy(F.desc("bucket"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    whole = Window.partitionBy("id")
    buckets = (
        points.groupBy("id", "bucket")
        .agg(F.sum("n_all").alias("b_all"), F.sum("n_pos").alias("b_pos"))
        .select(
            "id",
            "bucket",
            F.coalesce(F.sum("b_all").over(above), F.lit(0)).alias("above_all"),
            F.coalesce(F.sum("b_pos").over(above), F.lit(0)).alias("above_pos"),
            F.sum("b_pos").over(whole).alias("class_pos"),
        )
    )
    within = Window.partitionBy("id", "bucket").orderBy(F.desc("score"))
    ahead = within.rowsBetween(Window.unboundedPreceding, -1 if shift else 0)
    curve = (
        points.select(
            "id",
            "bucket",
            "score",
            F.coalesce(F.sum("n_all").over(ahead), F.lit(0)).alias("in_all"),
            F.coalesce(F.sum("n_pos").over(ahead), F.lit(0)).alias("in_pos"),
        )
        .join(buckets, ["id", "bucket"])
        .withColumn("tp", F.col("in_pos") + F.col("above_pos"))
        .withColumn("taken", F.col("in_all") + F.col("above_all"))
    )
    # Beyond the highest score precision is 1 and recall 0, hence F1 is 0.
    precision = F.coalesce(F.try_divide("tp", "taken"), F.lit(1.0))
    recall = F.coalesce(F.try_divide("tp", "class_pos"), F.lit(0.0))
    f1 = F.coalesce(
        F.try_divide(2.0 * precision * recall, precision + recall), F.lit(0.0)
    )
    best = (
        curve.withColumn("f1", f1)
        .groupBy("id")
        .agg(
            F.max("class_pos").alias("class_pos"),
            F.max(F.struct("f1", (-F.col("score")).alias("neg"))).alias("top"),
        )
    )
    found = best.select(
        "id",
        F.col("top.f1").alias("best_f1"),
        F.when(
            F.col("class_pos") > 0, F.greatest(-F.col("top.neg"), F.lit(min_threshold))
        ).alias("found"),
    )
    return (
        mapping.select("label", F.col("id").cast("int").alias("id"))
        .join(small(found, what="class thresholds"), "id", "left")
        .select(
            "label",
            "id",
            F.when(F.col("found").isNotNull(), F.col("best_f1")).alias("best_f1"),
            F.coalesce("found", F.lit(default)).alias("threshold"),
        )
    )


def thresholds_json(thresholds: DataFrame) -> DataFrame:
    """One row: the thresholds as one JSON object {label: threshold}."""
    pairs = F.sort_array(F.collect_list(F.struct("label", "threshold")))
    return bounded(thresholds, what="thresholds").agg(F.to_json(F.map_from_entries(pairs)).alias("thresholds"))
