from __future__ import annotations

import bisect
import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from checks import fixtures as X
from msgloom.functions import text as T
from msgloom.operators import (
    audit, dedup, features, metrics, monitor, sampling, scoring, splits, thresholds, upsert,
)
from msgloom.operators.bounded import bounded, salted_join
from msgloom.operators.ranking import smallest_n, with_rank

SF = "/root/testdata/sf0.001"


# --- Helpers --------------------------------------------------------------------------


def test_bounded(spark):
    assert bounded(spark.range(5), 5).count() == 5
    with pytest.raises(Exception, match="more than 4 rows"):
        bounded(spark.range(5), 4, "ids").collect()


def test_salted_join_on_a_hot_key(spark):
    left = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    right = spark.createDataFrame([("hot", 1), ("4", 2)], "k string, v int")
    for how in ("inner", "left", "left_semi", "left_anti"):
        a = salted_join(left, right, ["k"], ["id"], how)
        b = left.join(right, "k", how)
        assert sorted(a.select("id").collect()) == sorted(b.select("id").collect())


def test_rank_and_smallest(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice([0.0, 0.5, rng.random()])) for i in range(500)]
    df = spark.createDataFrame(rows, "id int, x double")
    order = sorted(rows, key=lambda r: (r[1], r[0]))
    ranked = with_rank(df, F.floor(F.col("x") * 10), ["x", "id"])
    assert {r["id"]: r["rank"] for r in ranked.collect()} == {r[0]: n for n, r in enumerate(order, 1)}
    for n in (0, 1, 137, 499, 500, 900):
        got = smallest_n(df, n, F.floor(F.col("x") * 10), ["x", "id"]).collect()
        assert sorted(r["id"] for r in got) == sorted(r[0] for r in order[:n])


def scans(df) -> tuple[int, str]:
    """File scans in the physical plan, and the plan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("FileScan"), plan


def test_smallest_reads_the_rows_once(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(1000).select("id", F.rand(1).alias("x"), F.lit("long").alias("text")).write.parquet(path)
    df = spark.read.parquet(path)
    got = smallest_n(df, 300, F.floor(F.col("x") * 10), ["x", "id"])
    plan = scans(got)[1]
    read = re.findall(r"ReadSchema: (\S+)", plan)
    assert read.count("struct<id:bigint,x:double,text:string>") == 1
    assert set(read) == {"struct<id:bigint,x:double,text:string>", "struct<x:double>"}
    assert not re.search(r"\bUnion\b|NestedLoop", plan)


# --- Upsert ---------------------------------------------------------------------------


def test_upsert_is_idempotent(spark, tmp_path):
    target, staging = X.upsert_target(spark, SF), upsert.stage(X.upsert_rows(spark, SF))
    first = upsert.upsert_summary(target, staging).first()
    assert first["n_updated"] > 0 and first["n_inserted"] > 0 and first["n_removed"] > 0
    path = str(tmp_path / "messages")
    upsert.upsert(target, staging).drop("action").write.parquet(path)
    loaded = spark.read.parquet(path)
    second = upsert.upsert_summary(loaded, staging).first()
    assert (second["n_updated"], second["n_inserted"], second["n_removed"]) == (0, 0, 0)
    assert loaded.count() == loaded.select("md5_hash").distinct().count()
    assert loaded.select("id").distinct().count() == loaded.count()
    again = upsert.upsert(loaded, staging)
    assert again.filter("action <> 'kept'").count() == 0
    sparse = upsert.upsert(target, staging, dense_ids=False)
    assert sparse.select("id").distinct().count() == sparse.count()
    columns = ["text_raw", "text", "label", "md5_hash", "action"]
    dense = upsert.upsert(target, staging)
    assert sparse.select(columns).exceptAll(dense.select(columns)).count() == 0
    assert sparse.count() == dense.count()


def test_sparse_order_numbers_make_few_buckets(spark):
    ids = spark.range(100_000).select((F.col("id") * 86_028_157_000).alias("row_seq")).repartition(9)
    bounds = upsert.range_bounds(ids)
    got = upsert.assign_ids(ids, F.lit(10).cast("bigint"), bounds=bounds)
    assert got.filter(F.col("id") != F.col("row_seq") / 86_028_157_000 + 11).count() == 0
    assert got.agg(F.min("id"), F.max("id"), F.countDistinct("id")).first()[:] == (11, 100_010, 100_000)
    cuts = ids.select(bounds.alias("b")).first()["b"]
    assert len(cuts) < upsert.ID_BUCKETS
    sizes = [0] * (len(cuts) + 1)
    for r in ids.collect():
        sizes[bisect.bisect_left(cuts, r[0])] += 1
    assert max(sizes) < 2000
    assert upsert.assign_ids(ids.limit(0), F.lit(0).cast("bigint")).count() == 0


def test_upsert_edge_cases(spark):
    import datetime

    now = datetime.datetime(2024, 1, 1)
    schema = "id long, text_raw string, text string, label string, md5_hash string, created_at timestamp, updated_at timestamp"
    h = lambda s: __import__("hashlib").md5(s.encode()).hexdigest()
    target = spark.createDataFrame(
        [
            (1, "a", "a", "x", h("a"), now, None),
            (2, "a", "a", "y", h("a"), now, None),
            (3, "b", "b", None, "", now, None),
            (4, None, "z", "x", None, now, None),
            (5, None, "z", "x", None, now, None),
        ],
        schema,
    )
    rows = spark.createDataFrame([(7, "a", "a", "y"), (8, "b", "b", "x"), (9, "c", "C", "x"), (6, "d", "d", "x")], "row_seq long, text_raw string, text string, label string")
    got = {(r["id"], r["text"], r["label"], r["action"]) for r in upsert.upsert(target, upsert.stage(rows)).collect()}
    assert got == {
        (2, "a", "y", "kept"), (3, "b", "x", "updated"), (4, "z", "x", "kept"), (5, "z", "x", "kept"),
        (6, "d", "x", "inserted"), (7, "C", "x", "inserted"),
    }
    s = upsert.upsert_summary(target, upsert.stage(rows)).first()
    assert (s["n_updated"], s["n_inserted"], s["n_removed"]) == (2, 2, 1)
    empty = spark.createDataFrame([], schema)
    assert upsert.upsert(empty, upsert.stage(rows)).agg(F.min("id"), F.max("id")).first()[:] == (1, 4)


def test_a_load_by_ranges_comes_out_where_its_joins_read_it(spark):
    schema = "id long, text_raw string, text string, label string, md5_hash string, created_at timestamp, updated_at timestamp"
    old = [(i, f"Text {i}", f"text {i}", "x", None, None, None) for i in range(1, 200)] + [(900, "Text 7", "old", "x", None, None, None)]
    target = spark.createDataFrame([*old, (901, None, "none", "x", None, None, None), (902, "t", "t", "x", "no hex", None, None)], schema)
    rows = [(i, f"Text {i}", f"text {i}", "xy"[i % 2]) for i in range(100, 400)] + [(500, None, "n", "x")]
    staging = upsert.stage(spark.createDataFrame(rows, "row_seq long, text_raw string, text string, label string"))
    now = F.lit("2024-01-01 00:00:00").cast("timestamp")
    plain, dealt = (upsert.upsert(target, staging, now, ranges=n) for n in (None, 5))
    assert sorted(map(str, dealt.collect())) == sorted(map(str, plain.collect()))
    at = dealt.filter("action <> 'kept' and md5_hash is not null").select(F.spark_partition_id().alias("p"), T.hash_range(F.col("md5_hash"), 5).alias("r"))
    assert sorted(r["n"] for r in at.groupBy("r").agg(F.countDistinct("p").alias("n")).collect()) == [1] * 5
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_range" not in plan and "passthrough" in plan


def test_rows_decided_by_digests_are_those_of_an_upsert(spark):
    schema = "id long, text_raw string, text string, label string, md5_hash string, created_at timestamp, updated_at timestamp"
    old = [(i, f"Text {i}", f"text {i}", "x", None, None, None) for i in range(1, 60)]
    odd = [(70, "odd", "o", "x", hashlib.md5(b"Text 80").hexdigest(), None, None), (71, "Text 50", None, "x", None, None, None)]
    target = upsert.backfill_hash(spark.createDataFrame([*old, *odd], schema))
    # Two rows with the same number and raw text, rows without a raw text, a text or a label.
    more = [(80, "Text 80", "b", "x"), (80, "Text 80", "a", "x"), (90, None, "n", "x"), (91, None, "m", "x"), (20, "Text 50", None, "y"), (92, "no text", None, None)]
    rows = spark.createDataFrame([*[(i, f"Text {i}", f"text {i}", "xy"[i % 2]) for i in range(30, 70)], *more], "row_seq long, text_raw string, text string, label string")
    keys = upsert.stage_digests(rows)
    assert dict(keys.dtypes)["text"] == "binary" and keys.filter("text_raw is not null").isEmpty()  # texts are neither moved nor held
    now, top = F.lit("2024-01-01 00:00:00").cast("timestamp"), F.lit(71).cast("bigint")
    made = upsert.with_texts(upsert.upsert(upsert.target_digests(target), keys, now, top_id=top).filter("action <> 'kept'"), rows)
    staged = upsert.stage(rows.filter("text <> 'a' or text is null"))
    again = upsert.stage(rows.filter("text <> 'b' or text is null"))
    wanted = [upsert.upsert(target, s, now, top_id=top).filter("action <> 'kept'").select(*made.columns) for s in (staged, again)]
    assert sorted(map(str, made.collect())) in [sorted(map(str, w.collect())) for w in wanted]
    assert made.filter("id = 70 and text_raw = 'odd'").count() == 1


def test_newest_plan_limits_before_the_shuffle(spark):
    plan = dedup.newest_per_hash(X.upsert_target(spark, SF))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


# --- Splits ---------------------------------------------------------------------------


def test_split_keeps_groups_together(spark):
    df = spark.range(5000).select(F.col("id").alias("row_seq"), (F.col("id") % 700).cast("string").alias("group_key"))
    for split in (splits.split_by_group, splits.split_exact):
        out = split(df)
        assert out.groupBy("group_key").agg(F.countDistinct("split").alias("n")).filter("n > 1").count() == 0
        overlap = splits.split_overlap(out, ["group_key"]).first()
        assert (overlap["train_val"], overlap["train_test"], overlap["val_test"]) == (0, 0, 0)
        assert overlap["val_rows_seen"] == 0
    sizes = {r["split"]: r["n"] for r in splits.split_exact(df).groupBy("split").agg(F.countDistinct("group_key").alias("n")).collect()}
    assert sizes["test"] == math.ceil(0.15 * 700)
    assert sizes["val"] == math.ceil((700 - 105) * (0.15 / 0.85))


def test_empty_train_raises(spark):
    df = spark.createDataFrame([("a", "test")], "k string, split string")
    with pytest.raises(ValueError, match="train"):
        splits.require_rows(df)
    assert splits.require_rows(df, "test").count() == 1


def test_overlap_finds_leaks(spark):
    df = spark.createDataFrame(
        [("a", "train"), ("a", "val"), ("b", "val"), ("a", "test"), ("b", "test"), ("c", "test"), (None, "train")],
        "text string, split string",
    )
    r = splits.split_overlap(df, ["text"]).first()
    assert (r["distinct_train"], r["distinct_val"], r["distinct_test"]) == (2, 2, 3)
    assert (r["train_val"], r["train_test"], r["val_test"]) == (1, 1, 2)
    assert (r["val_rows_seen"], r["test_rows_seen"]) == (1, 2)


def test_overlap_sketches_merge_and_stay_within_their_bound(spark):
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "train").when(F.col("id") % 3 == 1, "val").otherwise("test").alias("split"),
        (F.col("id") % 25_000).cast("string").alias("many"),
        F.when(F.col("id") % 2 == 0, (F.col("id") % 50).cast("string")).alias("few"),
    )
    loads = [splits.overlap_sketches(rows.filter(F.col("many").cast("int") % 2 == i), ["many", "few"]) for i in (0, 1)]
    merged = splits.merge_sketches(loads[0].unionByName(loads[1]))
    assert merged.agg(F.sum("n_rows")).first()[0] == 120_000
    got = {r["column"]: r.asDict() for r in splits.sketch_overlap(merged).collect()}
    want = {r["column"]: r.asDict() for r in splits.split_overlap(rows, ["many", "few"]).collect()}
    names = [c for c in got["few"] if c != "column"]
    assert all(got["few"][c] == want["few"][c] for c in names) and want["few"]["distinct_train"] == 26
    for c in names:
        error = 4 * 40_000 / 2**6
        assert abs(got["many"][c] - want["many"][c]) <= error and want["many"][c] > 10_000
    alone = splits.sketch_overlap(splits.overlap_sketches(rows.filter("split = 'train'"), ["few"])).first()
    assert (alone["distinct_train"], alone["distinct_val"], alone["train_val"]) == (26, 0, 0)
    assert splits.sketch_overlap(splits.overlap_sketches(rows.limit(0), ["few"])).count() == 0


# --- Features -------------------------------------------------------------------------


def test_class_weights(spark):
    df = spark.createDataFrame([("a",)] * 6 + [("b",)] * 3 + [("c",)], "label string")
    got = {r["label"]: round(r["weight"], 4) for r in features.class_weights(df).collect()}
    assert got == {"a": 0.5556, "b": 1.1111, "c": 3.3333}


def test_token_rows(spark):
    df = spark.createDataFrame([(1, "Hi [ORDER_PRESENT] hi"), (2, ""), (3, " ".join(["w"] * 100))], "row_seq long, text_model string")
    vocab = features.vocabulary(df, vocab_size=2)
    assert [(r["token"], r["token_id"]) for r in vocab.orderBy("token_id").collect()] == [("w", 4), ("hi", 5)]
    rows = features.encode_tokens(df, vocab).orderBy("row_seq").collect()
    assert rows[0]["input_ids"][:6] == [2, 5, 1, 5, 3, 0] and sum(rows[0]["attention_mask"]) == 5
    assert rows[1]["input_ids"][:3] == [2, 3, 0]
    assert rows[2]["input_ids"] == [2] + [4] * 62 + [3]
    assert all(len(r["input_ids"]) == len(r["attention_mask"]) == 64 for r in rows)


def test_token_ids_move_no_rows(spark, tmp_path):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(3000)]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 90))) for _ in range(300)] + [None, "", "É [A B] [X_1]"]
    path = str(tmp_path / "rows")
    spark.createDataFrame([(i % 200, t) for i, t in enumerate(texts)], "row_seq long, text_model string").write.parquet(path)
    df = spark.read.parquet(path)
    vocab = features.vocabulary(df, vocab_size=2500)
    made = features.encode_tokens(df, vocab)
    assert not re.search("Exchange|Join|Python", scans(made)[1])
    ids = {r["token"]: r["token_id"] for r in vocab.collect()}
    want = []
    for i, t in enumerate(texts):
        body = [ids.get(w, 1) for w in re.findall(r"\[[^\]\s]+\]|[a-z0-9]+", (t or "").lower())[:62]]
        want.append((i % 200, t or "", [2, *body, 3] + [0] * (62 - len(body))))
    assert sorted((r["row_seq"], r["text_model"] or "", r["input_ids"]) for r in made.collect()) == sorted(want)
    with pytest.raises(Exception, match="vocabulary has more"):
        features.encode_tokens(df, vocab, max_vocab=100)


def test_samples(spark):
    df = spark.range(300).select(F.col("id").alias("row_seq"), F.when(F.col("id") < 270, "big").otherwise("small").alias("label"))
    assert sampling.weighted_sample(df, 300).count() == 300
    half = {r["label"]: r["n"] for r in sampling.weighted_sample(df, 60).groupBy("label").agg(F.count("*").alias("n")).collect()}
    assert sum(half.values()) == 60 and half["small"] > 15
    draws = sampling.weighted_sample_with_replacement(df, 2000)
    counts = {r["label"]: r["n"] for r in draws.groupBy("label").agg(F.count("*").alias("n")).collect()}
    assert sum(counts.values()) == 2000 and abs(counts["small"] - 1000) < 120


# --- Metrics --------------------------------------------------------------------------


def preds(spark, pairs):
    return spark.createDataFrame([(i, t, p) for i, (t, p) in enumerate(pairs)], "row_seq int, true_id int, pred_id int")


def test_report(spark):
    df = preds(spark, zip([0, 0, 1, 1, 2], [0, 1, 1, 1, 0]))
    rows = {r["metric"]: r for r in metrics.classification_report(df).collect()}
    f1 = {k: round(r["f1"], 4) for k, r in rows.items()}
    assert f1 == {"0": 0.5, "1": 0.8, "2": 0.0, "accuracy": 0.6, "macro avg": 0.4333, "weighted avg": 0.52}
    assert rows["1"]["precision"] == pytest.approx(2 / 3) and rows["accuracy"]["support"] == 5
    labels = spark.createDataFrame([(i,) for i in range(4)], "label int")
    full = {r["metric"]: r["f1"] for r in metrics.classification_report(df, labels=labels).collect()}
    assert full["3"] == 0 and full["macro avg"] == pytest.approx(1.3 / 4)


def test_report_matches_ml_evaluator(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    df = X.predictions(spark, SF)
    ours = metrics.accuracy_macro_f1(df).first()
    both = df.select(F.col("true_id").cast("double"), F.col("pred_id").cast("double"))
    ev = lambda name: MulticlassClassificationEvaluator(labelCol="true_id", predictionCol="pred_id", metricName=name).evaluate(both)
    assert ours["accuracy"] == pytest.approx(ev("accuracy"))
    weighted = {r["metric"]: r["f1"] for r in metrics.classification_report(df).collect()}["weighted avg"]
    assert weighted == pytest.approx(ev("f1"))


def test_report_support_equals_matrix_rows(spark):
    df = X.predictions(spark, SF)
    matrix = metrics.confusion_matrix(df, list(range(10)))
    sums = {r["true"]: sum(r[str(i)] for i in range(10)) for r in matrix.collect()}
    support = {int(r["label"]): r["support"] for r in metrics.class_scores(df).collect()}
    assert sums == support


def best_threshold(rows, c, floor, shift):
    """Plain search over the precision-recall points of one class."""
    pos = sum(t == c for t, _ in rows)
    if not pos:
        return 0.75
    scores = sorted({p[c] for _, p in rows})
    points = []
    for s in scores:
        taken = [t for t, p in rows if p[c] >= s]
        tp = sum(t == c for t in taken)
        points.append((tp / len(taken), tp / pos))
    points.append((1.0, 0.0))
    best, best_f1 = scores[0], -1.0
    for i, s in enumerate(scores):
        p, r = points[i + shift]
        f1 = 0.0 if p + r == 0 else 2.0 * p * r / (p + r)
        if f1 > best_f1:
            best, best_f1 = s, f1
    return max(best, floor)


@pytest.mark.parametrize("shift", [0, 1])
@pytest.mark.parametrize("floor", [0.0, 0.8])
def test_thresholds_against_search(spark, shift, floor):
    rng = random.Random(11)
    rows = []
    for _ in range(120):
        z = [rng.choice([0.0, 1.0, 2.5, rng.uniform(0, 6)]) for _ in range(4)]
        s = sum(math.exp(v) for v in z)
        rows.append((rng.choice([0, 0, 1, 2]), [math.exp(v) / s for v in z]))
    rows += [(0, [1.0, 0.0, 0.0, 0.0]), (1, [0.0, 1.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "true_id int, probs array<double>")
    mapping = spark.createDataFrame([(f"c{i}", i) for i in range(4)], "label string, id int")
    got = {r["id"]: r["threshold"] for r in thresholds.class_thresholds(df, mapping, floor, shift=shift).collect()}
    for c in range(4):
        assert got[c] == pytest.approx(best_threshold(rows, c, floor, shift), abs=1e-12)
    assert got[3] == 0.75


def test_thresholds_json(spark):
    import json

    df = spark.createDataFrame([("b", 0.9), ("a", 0.8)], "label string, threshold double")
    assert json.loads(thresholds.thresholds_json(df).first()[0]) == {"a": 0.8, "b": 0.9}


def test_top_confusions_ties_and_clean_classes(spark):
    df = preds(spark, [(0, 2), (0, 1), (0, 0), (1, 1), (2, 0), (2, 0)])
    got = [(r["true"], r["pred"], r["n"]) for r in metrics.top_confusions(df).collect()]
    assert got == [(2, 0, 2), (0, 1, 1)]


def test_losses(spark):
    df = spark.createDataFrame([(0, [0.5, 0.5]), (1, [0.25, 0.75])], "true_id int, probs array<double>")
    w = spark.createDataFrame([(0, 1.0), (1, 3.0)], "id int, weight double")
    r = metrics.losses(df, w).first()
    a, b = -math.log(0.5), -math.log(0.75)
    assert r["cross_entropy"] == pytest.approx((a + 3 * b) / 4)
    assert r["focal_loss"] == pytest.approx((0.25 * a + 0.0625 * 3 * b) / 2)
    assert metrics.losses(df).first()["cross_entropy"] == pytest.approx((a + b) / 2)


def test_softmax_and_gate(spark):
    df = spark.createDataFrame([(1, [1000.0, 0.0]), (2, [1.0, 1.0]), (3, [0.0, 3.0])], "row_seq int, logits array<double>")
    scored = scoring.with_prediction(scoring.with_probabilities(df))
    rows = scored.orderBy("row_seq").collect()
    assert [r["pred_id"] for r in rows] == [0, 0, 1]
    assert all(sum(r["probs"]) == pytest.approx(1.0) for r in rows)
    mapping = spark.createDataFrame([("x", 0)], "label string, id int")
    named = metrics.with_label_names(scored, mapping, {"pred_id": "pred_label"})
    limits = spark.createDataFrame([("x", 0.4)], "label string, threshold double")
    out = {r["row_seq"]: (r["pred_label"], r["threshold"], r["intent"]) for r in scoring.gate(named, limits).collect()}
    assert out == {1: ("x", 0.4, "x"), 2: ("x", 0.4, "x"), 3: ("INVALID_LABEL", 0.8, "INVALID_LABEL")}
    assert scoring.gate(named).filter("intent = 'other'").count() == 1


def test_batch_scorer(spark):
    import numpy as np

    def make():
        return lambda lengths: np.stack([lengths, 5.0 - lengths], axis=1)

    df = spark.createDataFrame([(1, 1.0), (2, 4.0)], "row_seq int, size double")
    out = scoring.batch_scorer(make, ["size"], 32)(df).orderBy("row_seq").collect()
    assert [r["pred_id"] for r in out] == [1, 0]


def test_daily_quality(spark):
    rows = [
        ("2024-01-01 10:00:00", "a", "a", 1), ("2024-01-01 11:00:00", "a", "b", 0),
        ("2024-01-01 23:59:59", "b", None, None), ("2024-01-02 00:00:00", "b", "a", 0),
    ]
    df = spark.createDataFrame(rows, "ts string, pred string, actual string, correct int").withColumn("ts", F.col("ts").cast("timestamp"))
    got = [(str(r["day"]), r["intent"], r["precision"], r["recall"]) for r in monitor.daily_precision_recall(df).collect()]
    assert [(d, i, None if p is None else float(p), None if r is None else float(r)) for d, i, p, r in got] == [
        ("2024-01-01", "a", 0.5, 1.0), ("2024-01-01", "b", None, 0.0),
        ("2024-01-02", "a", None, 0.0), ("2024-01-02", "b", 0.0, None),
    ]


def test_conflicts_and_collisions_with_a_hot_text(spark):
    rows = [(i, f"raw {i}", "same", "x" if i % 2 else "y") for i in range(400)] + [(900, "u", "own", "x")]
    df = spark.createDataFrame(rows, "row_seq int, text_raw string, text_model string, label string")
    assert audit.text_conflicts(df).count() == 2
    assert audit.text_conflicts(df, limit=1).count() == 1
    r = audit.collisions(df).collect()
    assert len(r) == 1 and r[0]["n_unique_raw"] == 400
    assert r[0]["examples_raw"] == [f"raw {i}" for i in range(10)]
    assert audit.collision_count(df).first()[0] == 1


def test_conflict_branches_share_a_shuffle(spark):
    df = spark.range(1000).selectExpr("id row_seq", "cast(id as string) text", "cast(id % 7 as string) text_model", "cast(id % 3 as string) label")
    named = df.withColumnRenamed("text", "text_raw")
    scores = df.selectExpr("cast(row_seq % 3 as int) true_id", "array(rand(1), 0.5d, 0.1d) probs")
    mapping = spark.createDataFrame([(f"c{i}", i) for i in range(3)], "label string, id int")
    for out in (audit.text_conflicts(df), audit.collisions(named), thresholds.class_thresholds(scores, mapping)):
        out.collect()
        assert "ReusedExchange" in out._jdf.queryExecution().executedPlan().toString()


def test_weights_check(spark):
    weights = spark.createDataFrame([("a", 1.0), ("z", 2.0)], "label string, weight double")
    mapping = spark.createDataFrame([("a", 0), ("b", 1)], "label string, id int")
    got = {r["label"]: r["matched"] for r in audit.weights_check(weights, mapping).collect()}
    assert got == {"a": True, "b": False, "z": False}


def test_train_picks_by_macro_f1(spark):
    rows = [(i, "pay the bill" if i % 2 else "track my order", "bill" if i % 2 else "order", i % 2, "val" if i % 5 == 0 else "train") for i in range(60)]
    df = spark.createDataFrame(rows, "row_seq int, text_model string, label string, encoded_label int, split string")
    candidates = [scoring.classifier(max_iter=1, reg=100.0), scoring.classifier(max_iter=10)]
    model = scoring.train(df, candidates)
    out = scoring.predict(model, df)
    assert out.filter("pred_id <> encoded_label").count() == 0


def test_top_placeholders_count_the_texts_once(spark):
    """The support isn't selected, but both sides of its join still share one shuffle."""
    rows = [("a [X_1] [Y]", "p"), ("[Y]", "p"), ("none", "q"), ("[Y=1]", None)]
    df = spark.createDataFrame(rows, "text_model string, label string")
    top = audit.top_placeholders(audit.placeholder_by_label(df), 1)
    assert {tuple(r) for r in top.collect()} == {("p", "Y", 2, 1), (None, "Y=1", 1, 1)}
    plan = top._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in plan and plan.count("Generate explode") == 1


def test_load_moves_texts_once(spark, tmp_path):
    """New ids and the dry run shuffle hashes, not texts; a staged row without a hash is kept."""
    spark.createDataFrame(
        [(1, "a", "a", "x", None), (4, "b", "b", "y", None), (7, "b", "b", "z", "")],
        "id long, text_raw string, text string, label string, md5_hash string",
    ).withColumns({c: F.lit(None).cast("timestamp") for c in ("created_at", "updated_at")}).write.parquet(f"{tmp_path}/t")
    rows = [(9, "c", "c", "x"), (3, "d", None, "x"), (5, None, "e", "x"), (6, "b", "b", "z"), (8, "a", "A", "x")]
    staged = upsert.stage(spark.createDataFrame(rows, "row_seq long, text_raw string, text string, label string"))
    staged.write.parquet(f"{tmp_path}/s")
    target, staging = spark.read.parquet(f"{tmp_path}/t"), spark.read.parquet(f"{tmp_path}/s")
    loaded, counts = upsert.upsert(target, staging), upsert.upsert_summary(target, staging)
    got = {r["id"]: (r["text_raw"], r["text"], r["label"], r["action"]) for r in loaded.collect()}
    assert got == {
        1: ("a", "A", "x", "updated"), 7: ("b", "b", "z", "kept"),
        8: ("d", None, "x", "inserted"), 9: (None, "e", "x", "inserted"), 10: ("c", "c", "x", "inserted"),
    }
    assert counts.first()[:] == (2, 3, 1)

    def moved(df):
        def walk(node):
            inner = [node.children().apply(i) for i in range(node.children().size())]
            wide = [c.name() for c in (node.output().apply(i) for i in range(node.output().size()))]
            return ([wide] if "Exchange" in node.nodeName() else []) + [w for c in inner for w in walk(c)]

        plan = df._jdf.queryExecution().executedPlan()
        shuffles = walk(plan.initialPlan() if "Adaptive" in plan.nodeName() else plan)
        return [w for w in shuffles if "text_raw" in w]

    assert len(moved(loaded)) == 2, moved(loaded)  # target and staging, once each


def test_collision_rows_prepare_texts_once(spark):
    """Both sides of the salted join read one shuffle of the grouped pairs."""
    rows = [(1, "a", "A "), (2, "a", "a"), (3, "b", "b"), (4, "a", "a")]
    df = spark.createDataFrame(rows, "row_seq long, text_model string, text_raw string").repartition(2, "row_seq")
    found = audit.collision_rows(df)
    assert sorted(tuple(r) for r in found.collect()) == [("a", 2, "A "), ("a", 2, "a")]
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReusedExchange" in plan, plan
