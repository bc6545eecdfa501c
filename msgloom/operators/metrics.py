"""Classification metrics, confusions and error listings.

Everything starts from the counts of (true, pred) cells: one pass over the predictions
with partial aggregation, after which there are at most classes² rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from msgloom import constants as C
from msgloom.functions import vectors as V
from msgloom.operators.bounded import small


def confusion_cells(
    df: DataFrame, true_col: str = "true_id", pred_col: str = "pred_id"
) -> DataFrame:
    """(true, pred, n) for every pair that occurs."""
    return df.groupBy(F.col(true_col).alias("true"), F.col(pred_col).alias("pred")).agg(
        F.count("*").alias("n")
    )


def confusion_matrix(
    df: DataFrame,
    labels: list,
    true_col: str = "true_id",
    pred_col: str = "pred_id",
    names: list[str] | None = None,
) -> DataFrame:
    """Rows are true labels, columns predicted ones; labels that don't occur give zeros."""
    names = names or [str(x) for x in labels]
    cells = confusion_cells(df, true_col, pred_col)
    every = F.explode(F.array(*[F.lit(x) for x in labels])).alias("true")
    rows = df.sparkSession.range(1).select(every)
    wide = cells.groupBy("true").agg(
        *[F.sum(F.when(F.col("pred") == x, F.col("n")).otherwise(0)).alias(n)
          for x, n in zip(labels, names)]
    )
    return rows.join(wide, "true", "left").na.fill(0, names)


def frequent_pairs(
    df: DataFrame,
    k: int | None = 50,
    min_count: int | None = None,
    true_col: str = "true_id",
    pred_col: str = "pred_id",
) -> DataFrame:
    """Most frequent (true, pred) pairs, correct ones included: the top k of them, or all
    with at least min_count rows."""
    cells = confusion_cells(df, true_col, pred_col)
    if min_count is not None:
        cells = cells.filter(F.col("n") >= min_count)
    cells = cells.orderBy(F.desc("n"), "true", "pred")
    return cells if k is None else cells.limit(k)


def top_confusions(
    df: DataFrame, true_col: str = "true_id", pred_col: str = "pred_id"
) -> DataFrame:
    """The most frequent wrong prediction of each true class; classes without one skipped."""
    wrong = confusion_cells(df, true_col, pred_col).filter(F.col("true") != F.col("pred"))
    turn = F.row_number().over(Window.partitionBy("true").orderBy(F.desc("n"), F.asc("pred")))
    return (
        wrong.withColumn("turn", turn)
        .filter("turn = 1")
        .drop("turn")
        .orderBy(F.desc("n"), "true")
    )


def _ratio(a: Column, b: Column) -> Column:
    """a / b, and 0 when b is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def class_scores(
    df: DataFrame,
    true_col: str = "true_id",
    pred_col: str = "pred_id",
    labels: DataFrame | None = None,
) -> DataFrame:
    """(label, tp, n_pred, support, precision, recall, f1) for each class.

    Classes are those seen as true or predicted, or the ones of `labels` (label).
    """
    roles = confusion_cells(df, true_col, pred_col).select(
        F.inline(
            F.array(
                F.struct(
                    F.col("true").alias("label"),
                    F.when(F.col("true") == F.col("pred"), F.col("n")).otherwise(0).alias("tp"),
                    F.lit(0).cast("bigint").alias("n_pred"),
                    F.col("n").alias("support"),
                ),
                F.struct(
                    F.col("pred").alias("label"),
                    F.lit(0).cast("bigint").alias("tp"),
                    F.col("n").alias("n_pred"),
                    F.lit(0).cast("bigint").alias("support"),
                ),
            )
        )
    )
    if labels is not None:
        zero = F.lit(0).cast("bigint")
        roles = roles.unionByName(
            labels.select("label", zero.alias("tp"), zero.alias("n_pred"), zero.alias("support"))
        )
    sums = roles.groupBy("label").agg(
        F.sum("tp").alias("tp"), F.sum("n_pred").alias("n_pred"), F.sum("support").alias("support")
    )
    scored = sums.withColumns(
        {
            "precision": _ratio(F.col("tp"), F.col("n_pred")),
            "recall": _ratio(F.col("tp"), F.col("support")),
        }
    )
    p, r = F.col("precision"), F.col("recall")
    return scored.withColumn("f1", _ratio(2 * p * r, p + r))


def classification_report(
    df: DataFrame,
    true_col: str = "true_id",
    pred_col: str = "pred_id",
    labels: DataFrame | None = None,
) -> DataFrame:
    """(metric, precision, recall, f1, support): one row for each class, then accuracy,
    macro avg and weighted avg.

    A rollup gives the class rows and the totals in one pass.
    """
    classes = class_scores(df, true_col, pred_col, labels)
    weight = F.col("support")
    rolled = classes.rollup("label").agg(
        F.grouping("label").alias("is_total"),
        F.sum("support").alias("support"),
        F.sum("tp").alias("tp"),
        *[F.avg(m).alias(m) for m in ("precision", "recall", "f1")],
        *[F.sum(F.col(m) * weight).alias(f"w_{m}") for m in ("precision", "recall", "f1")],
    )
    accuracy = _ratio(F.col("tp"), F.col("support"))

    def line(name: Column, precision: Column, recall: Column, f1: Column) -> Column:
        return F.struct(
            name.alias("metric"),
            precision.alias("precision"),
            recall.alias("recall"),
            f1.alias("f1"),
            F.col("support"),
        )

    averages = [F.col("precision"), F.col("recall"), F.col("f1")]
    weighted = [_ratio(F.col(f"w_{m}"), F.col("support")) for m in ("precision", "recall", "f1")]
    totals = F.array(
        line(F.lit("accuracy"), accuracy, accuracy, accuracy),
        line(F.lit("macro avg"), *averages),
        line(F.lit("weighted avg"), *weighted),
    )
    own = F.array(line(F.col("label").cast("string"), *averages))
    return rolled.select(F.inline(F.when(F.col("is_total") == 1, totals).otherwise(own)))


def accuracy_macro_f1(
    df: DataFrame, true_col: str = "true_id", pred_col: str = "pred_id"
) -> DataFrame:
    """One row: accuracy and the mean F1 of the classes."""
    return class_scores(df, true_col, pred_col).agg(
        _ratio(F.sum("tp"), F.sum("support")).alias("accuracy"), F.avg("f1").alias("macro_f1")
    )


def confidence_stats(
    df: DataFrame,
    mapping: DataFrame | None = None,
    true_col: str = "true_id",
    pred_col: str = "pred_id",
    probs_col: str = "probs",
) -> DataFrame:
    """Per class: rows that are it, rows predicted as it, and the mean probability when
    predicted, of the class itself on its true rows, and on wrong predictions.

    The true class is looked up in `probs` by its id: from the mapping (label, id) when the
    class columns hold labels, else by the class value itself.
    """
    rows = df.select(
        F.col(true_col).alias("true"), F.col(pred_col).alias("pred"), F.col(probs_col).alias("probs")
    )
    if mapping is not None:
        ids = mapping.select(F.col("label").alias("true"), F.col("id").alias("true_pos"))
        rows = rows.join(small(ids, what="label mapping"), "true", "left")
    else:
        rows = rows.withColumn("true_pos", F.col("true"))
    cells = (
        rows.withColumns(
            {
                "top": F.array_max("probs"),
                "own": V.entry(F.col("probs"), F.col("true_pos")),
            }
        )
        .groupBy("true", "pred")
        .agg(
            F.count("*").alias("n"),
            F.count("top").alias("n_top"),
            F.sum("top").alias("sum_top"),
            F.count("own").alias("n_own"),
            F.sum("own").alias("sum_own"),
        )
    )
    wrong = F.col("true") != F.col("pred")
    none, zero = F.lit(None).cast("double"), F.lit(0).cast("bigint")
    roles = cells.select(
        F.inline(
            F.array(
                F.struct(
                    F.col("true").alias("label"),
                    F.col("n").alias("support_true"),
                    zero.alias("support_pred"),
                    zero.alias("n_top"),
                    none.alias("sum_top"),
                    F.col("n_own"),
                    F.col("sum_own"),
                    zero.alias("n_wrong"),
                    none.alias("sum_wrong"),
                ),
                F.struct(
                    F.col("pred").alias("label"),
                    zero.alias("support_true"),
                    F.col("n").alias("support_pred"),
                    F.col("n_top"),
                    F.col("sum_top"),
                    zero.alias("n_own"),
                    none.alias("sum_own"),
                    F.when(wrong, F.col("n_top")).otherwise(0).alias("n_wrong"),
                    F.when(wrong, F.col("sum_top")).alias("sum_wrong"),
                ),
            )
        )
    )
    mean = lambda s, n: F.try_divide(F.sum(s), F.sum(n))
    return (
        roles.groupBy("label")
        .agg(
            F.sum("support_true").alias("support_true"),
            F.sum("support_pred").alias("support_pred"),
            mean("sum_top", "n_top").alias("mean_prob_when_predicted"),
            mean("sum_own", "n_own").alias("mean_prob_on_true_rows"),
            mean("sum_wrong", "n_wrong").alias("mean_prob_on_wrong_predictions"),
        )
        .orderBy(F.desc("support_true"), "label")
    )


def low_f1_classes(
    df: DataFrame, k: int = 3, true_col: str = "true_id", pred_col: str = "pred_id"
) -> DataFrame:
    """The k classes with the lowest F1; on a tie the first label."""
    return class_scores(df, true_col, pred_col).select("label", "f1").orderBy("f1", "label").limit(k)


# --- Error listings -------------------------------------------------------------------


def with_label_names(
    df: DataFrame,
    mapping: DataFrame,
    pairs: dict[str, str],
    default: str | None = C.INVALID_LABEL,
) -> DataFrame:
    """Add label columns for id columns, as {id column: label column}.

    An id that the mapping lacks gives `default`, or the id as text if default is None.
    """
    for id_col, label_col in pairs.items():
        names = mapping.select(F.col("id").alias(id_col), F.col("label").alias("_label"))
        fallback = F.col(id_col).cast("string") if default is None else F.lit(default)
        df = (
            df.join(small(names, what="label mapping"), id_col, "left")
            .withColumn(label_col, F.coalesce("_label", fallback))
            .drop("_label")
        )
    return df


def misclassified(df: DataFrame, true_col: str = "true_id", pred_col: str = "pred_id") -> DataFrame:
    return df.filter(F.col(true_col) != F.col(pred_col))


def first_errors(df: DataFrame, n: int = 200, order_by: str = "row_seq", **columns) -> DataFrame:
    """The first n wrong predictions."""
    return misclassified(df, **columns).orderBy(order_by).limit(n)


def low_f1_errors(
    df: DataFrame,
    k: int = 3,
    per_class: int = 10,
    order_by: str = "row_seq",
    true_col: str = "true_id",
    pred_col: str = "pred_id",
) -> DataFrame:
    """The first wrong predictions of each of the k classes with the lowest F1."""
    low = low_f1_classes(df, k, true_col, pred_col).select(F.col("label").alias(true_col))
    turn = F.row_number().over(Window.partitionBy(true_col).orderBy(order_by))
    return (
        misclassified(df, true_col, pred_col)
        .join(F.broadcast(low), true_col, "left_semi")
        .withColumn("turn", turn)
        .filter(F.col("turn") <= per_class)
    )


def drill_down(
    df: DataFrame,
    true,
    pred,
    n: int = 50,
    order_by: str = "row_seq",
    true_col: str = "true_id",
    pred_col: str = "pred_id",
) -> DataFrame:
    """The first n rows of one cell of the confusion matrix."""
    cell = (F.col(true_col) == true) & (F.col(pred_col) == pred)
    return df.filter(cell).orderBy(order_by).limit(n)


def inspect_class(
    df: DataFrame,
    label,
    n: int = 20,
    order_by: str = "row_seq",
    true_col: str = "true_id",
    pred_col: str = "pred_id",
) -> DataFrame:
    """The first n errors of a class each way: `missed` and `false_alarm`."""
    direction = F.when(F.col(true_col) == label, "missed").when(
        F.col(pred_col) == label, "false_alarm"
    )
    turn = F.row_number().over(Window.partitionBy("direction").orderBy(order_by))
    return (
        misclassified(df, true_col, pred_col)
        .withColumn("direction", direction)
        .filter("direction is not null")
        .withColumn("turn", turn)
        .filter(F.col("turn") <= n)
        .drop("turn")
    )


# --- Losses ---------------------------------------------------------------------------


def losses(
    df: DataFrame,
    weights: DataFrame | None = None,
    gamma: float = C.FOCAL_GAMMA,
    true_col: str = "true_id",
    probs_col: str = "probs",
) -> DataFrame:
    """One row: mean weighted cross-entropy and mean focal loss of a scored table.

    `weights` is (id, weight); without it every class weighs 1. Cross-entropy divides by
    the sum of the weights, the focal loss by the number of rows.
    """
    rows = df.select(
        F.col(true_col).alias("id"), V.entry(F.col(probs_col), F.col(true_col)).alias("p")
    )
    if weights is not None:
        rows = rows.join(small(weights.select("id", "weight"), what="class weights"), "id", "left")
    else:
        rows = rows.withColumn("weight", F.lit(1.0))
    entropy = -F.col("weight") * F.ln("p")
    return rows.agg(
        (F.sum(entropy) / F.sum("weight")).alias("cross_entropy"),
        F.avg(F.pow(1.0 - F.col("p"), F.lit(gamma)) * entropy).alias("focal_loss"),
        F.count("*").alias("n"),
    )


def score_delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """Per class F1 of two scorings of the same rows and the change between them."""
    left = class_scores(before).select("label", F.col("f1").alias("f1_before"), "support")
    right = class_scores(after).select("label", F.col("f1").alias("f1_after"))
    zero = F.lit(0.0)
    return (
        left.join(right, "label", "full_outer")
        .withColumn("f1_before", F.coalesce("f1_before", zero))
        .withColumn("f1_after", F.coalesce("f1_after", zero))
        .withColumn("f1_change", F.col("f1_after") - F.col("f1_before"))
    )
