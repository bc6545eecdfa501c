"""The registered queries: each takes (spark, sf_dir) and returns plain columns.

Doubles are rounded to six digits here, at the output, and nowhere before.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as X
from checks.examples import EXAMPLES
from msgloom import constants as C
from msgloom.functions import placeholders as P
from msgloom.functions import text as T
from msgloom.functions import vectors as V
from msgloom.operators import (
    audit,
    dedup,
    entities,
    features,
    focal,
    gazetteer,
    metrics,
    monitor,
    sampling,
    scoring,
    splits,
    thresholds,
    upsert,
)
from msgloom.operators.bounded import computed_once
from msgloom.plans import ingest, prepare
from msgloom.sources import readers, workspace, writers
from msgloom.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def r6(c: Column | str) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.clean_messages(X.messages_raw(spark, sf_dir))


def modelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.model_rows(cleaned(spark, sf_dir))


def prepared(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    folder = workspace.new_folder(spark, "prepared")
    return prepare.prepare(cleaned(spark, sf_dir), folder=folder, **options).rows


# --- Monitoring -----------------------------------------------------------------------


@query
def daily_precision_recall(spark, sf_dir):
    df = monitor.daily_precision_recall(X.logs(spark, sf_dir))
    return df.select(
        F.col("day").cast("string").alias("day"),
        "intent",
        r6(F.col("precision").cast("double")).alias("precision"),
        r6(F.col("recall").cast("double")).alias("recall"),
    )


@query
def low_confidence_top(spark, sf_dir):
    df = monitor.least_confident(X.logs(spark, sf_dir), 10, "event_id")
    return df.select("event_id", r6("confidence").alias("confidence"))


@query
def judged_logs(spark, sf_dir):
    raw = X.logs(spark, sf_dir)
    unjudged = raw.withColumn("actual", F.lit(None).cast("string")).drop("correct")
    truth = raw.filter("actual is not null").select("event_id", "actual")
    return monitor.judge(unjudged, truth, "event_id").select("event_id", "actual", "correct")


# --- Text functions -------------------------------------------------------------------


@query
def clean_text(spark, sf_dir):
    return X.messages_raw(spark, sf_dir).select(
        "row_seq", T.clean_text(F.col("text")).alias("text_clean")
    )


@query
def label_normalise(spark, sf_dir):
    untidy = F.concat(F.lit(" \t"), F.upper("label"), F.lit(" \n"))
    return X.messages_raw(spark, sf_dir).select(
        "row_seq", T.normalise_label(untidy).alias("label_norm")
    )


@query
def sanitize_token(spark, sf_dir):
    return X.messages_raw(spark, sf_dir).select(
        "row_seq",
        T.sanitize_token(T.clean_text(F.col("text"))).alias("token"),
        T.readable_value(T.clean_text(F.col("text"))).alias("readable"),
    )


@query
def export_key(spark, sf_dir):
    return X.messages_raw(spark, sf_dir).select(
        "row_seq",
        T.export_key(F.col("label")).alias("label_key"),
        T.export_key(F.col("text")).alias("text_key"),
        T.export_key_per_char(F.col("text")).alias("text_key_per_char"),
    )


@query
def amount_bins(spark, sf_dir):
    orders = X.table(spark, sf_dir, "orders")
    price = F.concat(F.lit("USD "), F.floor(F.col("o_totalprice") / 100))
    return orders.select(
        "o_orderkey",
        r6(T.parse_amount(price)).alias("amount"),
        T.amount_bin(T.parse_amount(price)).alias("amount_bin"),
    )


@query
def recency_bins(spark, sf_dir):
    n = X.H(F.col("o_orderkey"))
    word = X.pick([*C.NUMBER_WORDS, "thirteen"], n % 13)
    return X.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        T.recency_bin(n % 40).alias("recency_bin"),
        T.number_word(word).alias("spelled"),
    )


@query
def date_tokens(spark, sf_dir):
    n = X.H(F.col("o_orderkey"))
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    phrases = [
        F.concat(n % 40, F.lit(" months ago")),
        F.concat(X.pick(C.NUMBER_WORDS, F.floor(n / 16) % 12), F.lit(" months ago")),
        F.lit("Last month"),
        F.concat(n % 5, F.lit(" years ago")),
        F.concat(F.lit("in "), X.pick(C.MONTH_NAMES, F.floor(n / 16) % 12), F.lit(" 2023")),
        day,
        F.concat(n % 12, F.lit("/"), n % 28, F.lit("/23")),
        F.concat(F.lit("What hours on "), day),
        (n % 3000).cast("string"),
        F.lit("a month ago"),
        F.lit("2100"),
        F.lit(" "),
    ]
    phrase = F.element_at(F.array(*phrases), (n % 12 + 1).cast("int"))
    return X.table(spark, sf_dir, "orders").select(
        "o_orderkey", phrase.alias("phrase"), T.date_token(phrase).alias("date_token")
    )


@query
def id_mask(spark, sf_dir):
    key = F.col("o_orderkey").cast("string")
    text = F.concat(
        F.lit("see [ord-"), key, F.lit("] or [ref "), F.md5(key), F.lit("] or [no "),
        F.col("o_totalprice").cast("decimal(15,2)"), F.lit("] or [person_hash] or [order "),
        key, F.lit("] or [gold] or "), key,
    )
    return X.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        T.collapse(P.mask_id_like(text)).alias("masked"),
        T.collapse(P.mask_leftover_ids(text)).alias("masked_strict"),
    )


@query
def strip_label_words(spark, sf_dir):
    text = F.concat(F.lit("i want "), F.col("label"), F.lit(" now: "), F.col("text"))
    return X.messages_raw(spark, sf_dir).select(
        "row_seq", P.drop_label_words(text).alias("stripped")
    )


@query
def ablate_placeholders(spark, sf_dir):
    return modelled(spark, sf_dir).select(
        "row_seq",
        P.remove_placeholders(F.col("text_model")).alias("ablated"),
        P.has_placeholder(F.col("text_model"), "INVOICE_PRESENT").alias("has_invoice"),
    )


@query
def ablation_labels(spark, sf_dir):
    return audit.labels_with_placeholder(modelled(spark, sf_dir), "INVOICE_PRESENT")


# --- Entities -------------------------------------------------------------------------


def _exploded(df: DataFrame, spans: str) -> DataFrame:
    s = computed_once(df.select("row_seq", spans), {spans: F.col(spans)})
    s = s.select("row_seq", F.explode(spans).alias("s"))
    return s.select(
        "row_seq",
        F.col("s.start").alias("start_pos"),
        F.col("s.end").alias("end_pos"),
        F.col("s.ph").alias("placeholder"),
        F.col("s.value").alias("value"),
    )


@query
def entity_spans(spark, sf_dir):
    raw = X.messages_raw(spark, sf_dir).select(
        "row_seq", T.clean_text(F.col("text")).alias("text_clean")
    )
    return _exploded(entities.with_spans(raw), "spans")


@query
def merged_spans(spark, sf_dir):
    raw = X.messages_raw(spark, sf_dir).withColumnRenamed("text", "text_raw")
    return _exploded(entities.normalise_placeholders(raw, keep_spans=True), "kept")


@query
def normalised_messages(spark, sf_dir):
    return cleaned(spark, sf_dir).select("row_seq", F.col("text").alias("text_norm"), "label")


@query
def slot_values(spark, sf_dir):
    raw = X.messages_raw(spark, sf_dir).withColumnRenamed("text", "text_raw")
    slots = entities.extract_slots(raw)
    through_json = T.parse_mappings(F.to_json("mappings"))
    return slots.select("row_seq", F.explode(through_json).alias("placeholder", "values")).select(
        "row_seq", "placeholder", F.posexplode("values").alias("pos", "value")
    )


@query
def gazetteer_spans(spark, sf_dir):
    raw = X.messages_raw(spark, sf_dir).select(
        "row_seq", T.clean_text(F.col("text")).alias("text_clean")
    )
    known = X.gazetteer(spark, sf_dir)
    folder = workspace.new_folder(spark, "gazetteer-words")
    return _exploded(gazetteer.gazetteer_spans(raw, known, folder=folder), "gazetteer_spans")


# --- Features -------------------------------------------------------------------------


@query
def placeholder_flags(spark, sf_dir):
    flat = features.flatten_flags(modelled(spark, sf_dir))
    return flat.select(
        "row_seq",
        *features.FLAGS,
        F.col("account_type_val").alias("account_type"),
        F.col("ph_info.refund_amt_bin").alias("refund_amt_bin"),
        F.col("ph_info.date_bin").alias("date_bin"),
        F.size("ph_info.other_placeholders").alias("n_other"),
    )


@query
def model_text(spark, sf_dir):
    return modelled(spark, sf_dir).select("row_seq", "text_model")


@query
def model_text_bins(spark, sf_dir):
    df = prepare.model_rows(cleaned(spark, sf_dir), keep_bins=True)
    return df.select("row_seq", "text_model")


@query
def group_keys(spark, sf_dir):
    df = modelled(spark, sf_dir)
    by_entity = features.with_group_key(df).withColumnRenamed("group_key", "entity_key")
    both = features.with_group_key(by_entity, "presence")
    return both.select("row_seq", "entity_key", F.col("group_key").alias("presence_key"))


@query
def label_ids(spark, sf_dir):
    return features.label_ids(X.messages_raw(spark, sf_dir))


@query
def encoded_labels(spark, sf_dir):
    raw = X.messages_raw(spark, sf_dir)
    encoded = features.encode_labels(raw, features.label_ids(raw))
    return encoded.select("row_seq", "label", "encoded_label")


@query
def class_weights(spark, sf_dir):
    df = features.class_weights(X.messages_raw(spark, sf_dir))
    return df.select("label", "n", r6("weight").alias("weight"))


@query
def sample_weights(spark, sf_dir):
    df = features.with_sample_weight(X.messages_raw(spark, sf_dir))
    return df.select("row_seq", F.round("sample_weight", 9).alias("sample_weight"))


@query
def vocabulary(spark, sf_dir):
    turns = X.table(spark, sf_dir, "conversations")
    return features.vocabulary(turns, "text")


def _encoded(spark, sf_dir) -> DataFrame:
    turns = X.table(spark, sf_dir, "conversations").withColumn(
        "row_seq", F.concat_ws("-", "conv_id", "turn")
    )
    vocab = features.vocabulary(turns, "text")
    return features.encode_tokens(turns, vocab, "text")


@query
def token_ids(spark, sf_dir):
    return _encoded(spark, sf_dir).select(
        "conv_id",
        "turn",
        F.array_join("input_ids", ",").alias("input_ids"),
        F.array_join("attention_mask", ",").alias("attention_mask"),
    )


# --- Duplicates and upsert ------------------------------------------------------------


@query
def dedup_first(spark, sf_dir):
    docs = X.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return dedup.first_per_key(docs, ["text"], "doc_id")


@query
def duplicate_report(spark, sf_dir):
    return dedup.duplicate_report(X.messages_raw(spark, sf_dir), ["text"])


@query
def dedup_counts(spark, sf_dir):
    return dedup.dedup_counts(X.messages_raw(spark, sf_dir), ["text"])


def _tables(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Message table and staging rows as stored tables, as a load finds them."""
    folder = workspace.new_folder(spark, "upsert")
    X.upsert_target(spark, sf_dir).write.parquet(f"{folder}/messages")
    upsert.stage(X.upsert_rows(spark, sf_dir)).write.parquet(f"{folder}/staging")
    return spark.read.parquet(f"{folder}/messages"), spark.read.parquet(f"{folder}/staging")


@query
def upsert_result(spark, sf_dir):
    result = upsert.upsert(*_tables(spark, sf_dir))
    return result.select(
        "id", "md5_hash", "text", "label", "action",
        F.col("updated_at").isNotNull().alias("was_updated"),
    )


@query
def upsert_summary(spark, sf_dir):
    return upsert.upsert_summary(X.upsert_target(spark, sf_dir), upsert.stage(X.upsert_rows(spark, sf_dir)))


@query
def table_load(spark, sf_dir):
    """The newest version of a message table after a load that copies the touched hash prefixes."""
    folder = workspace.new_folder(spark, "table-load")
    table = ingest.message_table(spark, f"{folder}/messages", digits=1)
    ingest.start_table(table, X.upsert_target(spark, sf_dir))
    staged = upsert.stage(X.upsert_rows(spark, sf_dir)).select(*ingest.STAGED)
    staged.write.option("compression", ingest.CODEC).parquet(f"{folder}/staging")
    ingest.load_staged(table, spark.read.parquet(f"{folder}/staging"))
    return table.read().select("id", "md5_hash", "text", "label")


@query
def newest_per_hash(spark, sf_dir):
    return dedup.newest_per_hash(X.upsert_target(spark, sf_dir)).select("id", "md5_hash", "label")


@query
def hash_backfill(spark, sf_dir):
    return upsert.backfill_hash(X.upsert_target(spark, sf_dir)).select("id", "md5_hash")


# --- Splits and audits ----------------------------------------------------------------


@query
def group_split(spark, sf_dir):
    return prepared(spark, sf_dir).select("row_seq", "group_key", "encoded_label", "split")


@query
def group_split_exact(spark, sf_dir):
    turns = X.table(spark, sf_dir, "conversations")
    return splits.split_exact(turns, "conv_id").select("conv_id", "turn", "split")


@query
def split_overlap(spark, sf_dir):
    return splits.split_overlap(prepared(spark, sf_dir), ["text_model", "text_raw", "text"])


@query
def group_overlap(spark, sf_dir):
    return splits.split_overlap(prepared(spark, sf_dir), ["group_key"])


@query
def turn_overlap(spark, sf_dir):
    turns = splits.split_by_group(X.table(spark, sf_dir, "conversations"), "turn")
    return splits.split_overlap(turns, ["conv_id", "role", "text"])


@query
def overlap_sketch(spark, sf_dir):
    """Exact overlaps, and whether sketches of two loads, merged, estimate them all within their bound."""
    df, columns = prepared(spark, sf_dir), ["text_model", "text_raw", "text"]
    first = F.pmod(F.hash("row_seq"), F.lit(2)) == 0
    loads = splits.overlap_sketches(df.filter(first), columns).unionByName(
        splits.overlap_sketches(df.filter(~first), columns)
    )
    found = splits.sketch_overlap(splits.merge_sketches(loads))
    exact = splits.split_overlap(df, columns).drop("val_rows_seen", "test_rows_seen")
    names = [c for c in exact.columns if c != "column"]
    size = {f"distinct_{s}": F.col(f"distinct_{s}") for s in splits.SPLITS}
    size |= {f"{a}_{b}": size[f"distinct_{a}"] + size[f"distinct_{b}"] for a, b in splits.PAIRS}
    near = [F.abs(F.col(c) - F.col(f"_{c}")) <= splits.overlap_error(size[c]) for c in names]
    found = found.withColumnsRenamed({c: f"_{c}" for c in names})
    return exact.join(found, "column").select(*exact.columns, F.array_min(F.array(*near)).alias("holds"))


@query
def token_overlap(spark, sf_dir):
    return splits.token_overlap(splits.split_by_group(_encoded(spark, sf_dir), "turn"))


@query
def leak_tokens(spark, sf_dir):
    return splits.leak_tokens(prepared(spark, sf_dir))


@query
def text_conflicts(spark, sf_dir):
    return audit.text_conflicts(modelled(spark, sf_dir))


@query
def conflict_keys(spark, sf_dir):
    return audit.conflict_keys(modelled(spark, sf_dir))


@query
def collisions(spark, sf_dir):
    df = audit.collisions(modelled(spark, sf_dir))
    return df.select(
        "text_model", "n_unique_raw", F.posexplode("examples_raw").alias("pos", "example_raw")
    )


@query
def entity_examples(spark, sf_dir):
    """Spans in hand-written messages, one for each order, against hand-written spans."""
    texts = list(EXAMPLES)
    turn = F.col("o_orderkey") % len(texts)
    df = X.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("row_seq"), X.pick(texts, turn).alias("text_clean")
    )
    found = entities.with_spans(df).select("row_seq", F.inline(entities.merge_spans(F.col("spans"))))
    return found.select("row_seq", "start", "ph", "value")


@query
def collisions_all(spark, sf_dir):
    return audit.collision_rows(modelled(spark, sf_dir))


@query
def collision_count(spark, sf_dir):
    return audit.collision_count(modelled(spark, sf_dir))


@query
def label_distribution(spark, sf_dir):
    return dedup.label_distribution(
        features.drop_missing(X.messages_raw(spark, sf_dir))
    )


@query
def rated_labels(spark, sf_dir):
    docs = X.table(spark, sf_dir, "documents").join(
        X.table(spark, sf_dir, "labels"), "doc_id", "left"
    )
    rated = features.drop_missing(docs, ("text", "quality"))
    return dedup.label_distribution(rated, "quality")


@query
def placeholder_by_label(spark, sf_dir):
    return audit.placeholder_by_label(modelled(spark, sf_dir))


@query
def placeholder_matrix(spark, sf_dir):
    long = audit.placeholder_by_label(modelled(spark, sf_dir))
    names = [f.upper() for f in features.FLAGS] + ["ID_PRESENT"]
    return audit.placeholder_matrix(long, names)


@query
def top_placeholders(spark, sf_dir):
    return audit.top_placeholders(audit.placeholder_by_label(modelled(spark, sf_dir)))


@query
def weights_check(spark, sf_dir):
    rows = prepared(spark, sf_dir)
    weights = features.class_weights(rows.filter("split = 'train'"))
    df = audit.weights_check(weights, features.label_ids(rows))
    return df.select("label", "id", r6("weight").alias("weight"), "matched")


@query
def weighted_sample(spark, sf_dir):
    raw = X.messages_raw(spark, sf_dir)
    return sampling.weighted_sample(raw, 300).select("row_seq", "label")


@query
def weighted_sample_all(spark, sf_dir):
    raw = X.messages_raw(spark, sf_dir)
    return sampling.weighted_sample(raw, None).select("row_seq", "label")


@query
def weighted_draws(spark, sf_dir):
    raw = X.messages_raw(spark, sf_dir)
    return sampling.weighted_sample_with_replacement(raw, 300).select("draw", "row_seq", "label")


# --- Predictions and metrics ----------------------------------------------------------


@query
def softmax_probs(spark, sf_dir):
    df = X.predictions(spark, sf_dir)
    return df.select("row_seq", F.posexplode("probs").alias("class", "prob")).withColumn(
        "prob", r6("prob")
    )


@query
def gated_predictions(spark, sf_dir):
    df = X.predictions(spark, sf_dir).drop("text")
    mapping = X.class_mapping(spark, sf_dir)
    named = metrics.with_label_names(df, mapping, {"pred_id": "pred_label"})
    limits = thresholds.class_thresholds(X.predictions(spark, sf_dir), mapping, 0.0)
    return scoring.gate(named, limits).select(
        "row_seq", "pred_label", r6("confidence").alias("confidence"),
        r6("threshold").alias("threshold"), "intent",
    )


@query
def prediction_table(spark, sf_dir):
    known = X.class_mapping(spark, sf_dir).filter("id <> 3")
    df = scoring.prediction_table(X.predictions(spark, sf_dir), known)
    parsed = T.parse_probabilities(F.to_json("probs"))
    return df.select(
        "row_seq", "text", "true_id", "pred_id", "true", "pred",
        r6(F.array_max(parsed)).alias("top_prob"),
    )


@query
def attached_predictions(spark, sf_dir):
    rows = X.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("row_seq"), "label")
    return scoring.attach_predictions(rows, X.predictions(spark, sf_dir))


@query
def confusion_matrix(spark, sf_dir):
    names = [f"p{i}" for i in range(10)]
    return metrics.confusion_matrix(X.predictions(spark, sf_dir), list(range(10)), names=names)


@query
def confusion_pairs(spark, sf_dir):
    return metrics.confusion_cells(X.predictions(spark, sf_dir))


@query
def top_confusions(spark, sf_dir):
    return metrics.top_confusions(X.predictions(spark, sf_dir))


@query
def top_pairs(spark, sf_dir):
    return metrics.frequent_pairs(X.predictions(spark, sf_dir), 50)


@query
def frequent_pairs(spark, sf_dir):
    return metrics.frequent_pairs(X.predictions(spark, sf_dir), None, min_count=5)


def _rounded_report(df: DataFrame) -> DataFrame:
    return df.select("metric", *[r6(m).alias(m) for m in ("precision", "recall", "f1")], "support")


@query
def classification_report(spark, sf_dir):
    return _rounded_report(metrics.classification_report(X.predictions(spark, sf_dir)))


@query
def accuracy_macro_f1(spark, sf_dir):
    df = metrics.accuracy_macro_f1(X.predictions(spark, sf_dir))
    return df.select(r6("accuracy").alias("accuracy"), r6("macro_f1").alias("macro_f1"))


def _thresholds(spark, sf_dir, floor: float, shift: int) -> DataFrame:
    df = thresholds.class_thresholds(
        X.predictions(spark, sf_dir), X.class_mapping(spark, sf_dir), floor, shift=shift
    )
    return df.select("label", "id", r6("best_f1").alias("best_f1"), r6("threshold").alias("threshold"))


@query
def class_thresholds(spark, sf_dir):
    return _thresholds(spark, sf_dir, 0.0, 1)


@query
def class_thresholds_floor(spark, sf_dir):
    return _thresholds(spark, sf_dir, 0.80, 1)


@query
def class_thresholds_unshifted(spark, sf_dir):
    return _thresholds(spark, sf_dir, 0.0, 0)


@query
def confidence_stats(spark, sf_dir):
    df = metrics.confidence_stats(X.predictions(spark, sf_dir))
    return df.select(
        "label", "support_true", "support_pred",
        *[
            r6(m).alias(m)
            for m in (
                "mean_prob_when_predicted",
                "mean_prob_on_true_rows",
                "mean_prob_on_wrong_predictions",
            )
        ],
    )


@query
def low_f1_classes(spark, sf_dir):
    df = metrics.low_f1_classes(X.predictions(spark, sf_dir))
    return df.select("label", r6("f1").alias("f1"))


@query
def low_f1_errors(spark, sf_dir):
    df = metrics.low_f1_errors(X.predictions(spark, sf_dir))
    known = X.class_mapping(spark, sf_dir).filter("id <> 3")
    named = metrics.with_label_names(df, known, {"pred_id": "pred_label"}, default=None)
    return named.select("true_id", "turn", "row_seq", "text", "pred_id", "pred_label")


@query
def first_errors(spark, sf_dir):
    return metrics.first_errors(X.predictions(spark, sf_dir)).select(
        "row_seq", "text", "true_id", "pred_id"
    )


@query
def drill_down(spark, sf_dir):
    return metrics.drill_down(X.predictions(spark, sf_dir), 1, 2).select("row_seq", "text")


@query
def inspect_class(spark, sf_dir):
    return metrics.inspect_class(X.predictions(spark, sf_dir), 5).select(
        "direction", "row_seq", "true_id", "pred_id"
    )


@query
def loss_table(spark, sf_dir):
    preds = X.predictions(spark, sf_dir)
    weights = features.class_weights(preds, "true_id").select(F.col("label").alias("id"), "weight")
    df = metrics.losses(preds, weights)
    return df.select(r6("cross_entropy").alias("cross_entropy"), r6("focal_loss").alias("focal_loss"), "n")


@query
def ablation_delta(spark, sf_dir):
    """Both texts of a row are scored in one pass, and the small rows of scores are kept for the two sides."""
    rows = modelled(spark, sf_dir).select("row_seq", "label", "text_model")
    whole = F.struct(F.lit(False).alias("ablated"), F.col("text_model").alias("scored_text"))
    cut = F.struct(F.lit(True).alias("ablated"), P.ablated_text(F.col("text_model")).alias("scored_text"))
    score = scoring.column_scorer(X.word_logits(C.INTENT_LABELS), "scored_text")
    scored = score(rows.select("row_seq", "label", F.inline(F.array(whole, cut))))
    ids = F.array_position(F.array(*map(F.lit, C.INTENT_LABELS)), F.col("label")) - 1
    folder = workspace.new_folder(spark, "ablation")
    scored.select("row_seq", "ablated", ids.cast("int").alias("true_id"), "pred_id", "confidence").write.parquet(folder)
    stored = spark.read.parquet(folder)
    df = metrics.score_delta(stored.filter("not ablated"), stored.filter("ablated"))
    return df.select(
        "label", "support", *[r6(c).alias(c) for c in ("f1_before", "f1_after", "f1_change")]
    )


def _fixed_mapping(spark) -> DataFrame:
    return spark.createDataFrame(
        [(label, i) for i, label in enumerate(C.INTENT_LABELS)], "label string, id int"
    )


@query
def scored_messages(spark, sf_dir):
    score = scoring.column_scorer(X.word_logits(C.INTENT_LABELS))
    df = scoring.score_messages(
        X.messages_raw(spark, sf_dir), score, _fixed_mapping(spark)
    )
    return df.select("row_seq", "pred_label", r6("confidence").alias("confidence"), "intent")


@query
def ml_predictions(spark, sf_dir):
    rows = prepared(spark, sf_dir).select(
        "row_seq", "text_model", "label", "encoded_label", "split"
    )
    model = scoring.train(rows, [scoring.classifier(max_iter=10)])
    scored = scoring.predict(model, rows.filter("split = 'test'"))
    return scored.select("row_seq", "label", "encoded_label", "pred_id", "confidence")


@query
def focal_gradient(spark, sf_dir):
    """Loss and gradient of the weighted focal loss where all weights are zero."""
    fit = focal.FocalClassifier(slots=2048)
    train = prepared(spark, sf_dir).filter("split = 'train'")
    weights = features.class_weights(train).select("label", F.col("weight").alias("class_weight"))
    rows = fit.rows(train.join(F.broadcast(weights), "label"))
    classes = rows.agg(F.max("id")).first()[0] + 1
    zero = np.zeros((classes, fit.slots))
    loss, by_slot, by_bias = focal.loss_and_gradient(rows, zero, zero[:, 0])
    made = [(focal.LOSS, 0, loss), *[(focal.BIAS, c, float(g)) for c, g in enumerate(by_bias)]]
    made += [(s, c, float(by_slot[c, s])) for c in range(classes) for s in range(fit.slots) if by_slot[c, s]]
    df = spark.createDataFrame(made, "slot int, class int, value double")
    return df.select("slot", "class", (r6("value") + 0.0).alias("value")).filter("value <> 0")


@query
def ml_quality(spark, sf_dir):
    """The best of two candidates by macro F1: sound on rows that no fit has seen, and its
    weighted loss on the train rows below that of equal scores for all classes."""
    rows = prepared(spark, sf_dir).select("row_seq", "text_model", "label", "encoded_label", "split")
    model = scoring.train(rows, [scoring.classifier(max_iter=10), focal.FocalClassifier()])
    scored = scoring.predict(model, rows.filter("split = 'test'"))
    sound = (F.col("confidence") > 0) & (F.col("confidence") <= 1) & (F.abs(V.total(F.col("probs")) - 1) < 1e-6)
    checked = scored.agg(F.count("*").alias("n"), F.bool_and(sound).alias("sound"))
    train = rows.filter("split = 'train'")
    weights = features.class_weights(train, "encoded_label").select(F.col("label").alias("id"), "weight")
    loss = metrics.losses(scoring.predict(model, train), weights, true_col="encoded_label")
    least = F.ln(weights.agg(F.count("*")).scalar())
    return checked.withColumn("lowers_loss", loss.select("cross_entropy").scalar() < least)


# --- Streams --------------------------------------------------------------------------


@query
def stream_scores(spark, sf_dir):
    root = workspace.new_folder(spark, "stream-scores")
    score = scoring.column_scorer(X.word_logits(C.INTENT_LABELS))
    jobs.score_stream(
        X.messages_raw(spark, sf_dir, stream=True),
        score,
        _fixed_mapping(spark),
        None,
        f"{root}/logs",
        f"{root}/low_conf",
        f"{root}/checkpoint",
        "ts",
        parts=2 * spark.sparkContext.defaultParallelism,
    ).awaitTermination()
    logged = jobs.read_batches(spark, f"{root}/logs")
    low = jobs.read_batches(spark, f"{root}/low_conf").select("row_seq", F.lit(True).alias("low"))
    return logged.join(low, "row_seq", "left").select(
        "row_seq",
        F.col("pred").alias("intent"),
        r6("confidence").alias("confidence"),
        F.coalesce("low", F.lit(False)).alias("low"),
    )


@query
def stream_daily(spark, sf_dir):
    root = workspace.new_folder(spark, "stream-daily")
    jobs.write_daily_quality(
        X.logs(spark, sf_dir, stream=True), f"{root}/days", f"{root}/checkpoint"
    ).awaitTermination()
    df = jobs.read_daily_quality(spark, f"{root}/days")
    return df.select(
        F.col("day").cast("string").alias("day"),
        "intent",
        r6(F.col("precision").cast("double")).alias("precision"),
        r6(F.col("recall").cast("double")).alias("recall"),
    )


@query
def stream_dedup(spark, sf_dir):
    root = workspace.new_folder(spark, "stream-dedup")
    messages = X.messages_raw(spark, sf_dir, stream=True).withColumnRenamed("text", "text_raw")
    jobs.write_first_seen(
        messages, f"{root}/rows", f"{root}/checkpoint", delay="2 days"
    ).awaitTermination()
    return jobs.read_batches(spark, f"{root}/rows").select("md5_hash", "text_raw")


@query
def stream_upsert(spark, sf_dir):
    root = workspace.new_folder(spark, "stream-upsert")
    jobs.upsert_stream(
        X.upsert_rows(spark, sf_dir, stream=True),
        X.upsert_target(spark, sf_dir),
        f"{root}/messages",
        f"{root}/checkpoint",
    ).awaitTermination()
    return jobs.current_messages(spark, f"{root}/messages").select("id", "md5_hash", "text", "label")


@query
def stream_never_seen(spark, sf_dir):
    """Messages whose text is neither in the message table nor earlier in the stream."""
    root = workspace.new_folder(spark, "stream-never-seen")
    known = ingest.message_table(spark, f"{root}/messages", digits=1)
    ingest.start_table(known, X.upsert_target(spark, sf_dir))
    messages = X.messages_raw(spark, sf_dir, stream=True).withColumnRenamed("text", "text_raw")
    jobs.write_never_seen(messages, known, f"{root}/log", f"{root}/checkpoint", digits=1).awaitTermination()
    return jobs.seen_table(spark, f"{root}/log", 1).read().select("row_seq", "md5_hash", "text_raw")


# --- Sources and sinks ----------------------------------------------------------------


@query
def source_roundtrip(spark, sf_dir):
    folder = workspace.new_folder(spark, "roundtrip")
    raw = X.messages_raw(spark, sf_dir).select(
        "row_seq", F.col("text").alias("query"), F.col("label").alias("intent")
    )
    writers.write_cleaned(raw, f"{folder}/messages", "csv")
    df = readers.first_available(
        lambda: readers.read_messages_csv(spark, f"{folder}/absent"),
        lambda: readers.read_messages_csv(spark, f"{folder}/messages"),
        required=["text", "label"],
    )
    return readers.keep_present(df, ["row_seq", "text", "label", "mappings"])


@query
def snapshot_roundtrip(spark, sf_dir):
    folder = workspace.new_folder(spark, "snapshots")
    writers.write_snapshots(prepared(spark, sf_dir), folder)
    return spark.read.parquet(folder).groupBy("split").agg(
        F.count("*").alias("n"), F.countDistinct("group_key").alias("n_groups")
    )


@query
def error_partitions(spark, sf_dir):
    folder = workspace.new_folder(spark, "errors")
    preds = scoring.prediction_table(X.predictions(spark, sf_dir), X.class_mapping(spark, sf_dir))
    errors = metrics.misclassified(preds)
    pairs = metrics.top_confusions(preds, "true", "pred")
    writers.write_errors_by_pair(errors, pairs, folder)
    return spark.read.parquet(folder).groupBy("true_label", "pred_label").agg(
        F.count("*").alias("n")
    )


@query
def report_roundtrip(spark, sf_dir):
    folder = workspace.new_folder(spark, "report")
    writers.write_wide(metrics.classification_report(X.predictions(spark, sf_dir)), folder)
    return _rounded_report(readers.read_report(spark, folder)).withColumn(
        "support", F.col("support").cast("bigint")
    )


@query
def matrix_roundtrip(spark, sf_dir):
    folder = workspace.new_folder(spark, "matrix")
    matrix = metrics.confusion_matrix(X.predictions(spark, sf_dir), list(range(10)))
    writers.write_wide(matrix, folder)
    return readers.read_matrix(spark, folder)


@query
def strings_read(spark, sf_dir):
    """All columns of a CSV as strings, nulls as empty text."""
    folder = workspace.new_folder(spark, "strings")
    docs = X.table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"))
    writers.write_cleaned(docs, folder, "csv")
    return readers.read_csv_strings(spark, folder, multi_line=False)


@query
def table_read(spark, sf_dir):
    """Columns of a catalog table."""
    X.table(spark, sf_dir, "documents").createOrReplaceTempView("documents_in_catalog")
    return readers.read_table(spark, "documents_in_catalog", ["doc_id", "source"])


@query
def roles(spark, sf_dir):
    """True and predicted labels by the roles of a log's columns."""
    df = X.predictions(spark, sf_dir)
    found = readers.resolve_roles(df, ["true", "pred"])
    return df.select(F.col(found["true"]).alias("true"), F.col(found["pred"]).alias("pred")).groupBy("true", "pred").agg(F.count("*").alias("n"))


@query
def previews(spark, sf_dir):
    return X.table(spark, sf_dir, "documents").select("doc_id", T.preview(F.col("text"), 80).alias("preview"))


@query
def token_list(spark, sf_dir):
    """The sorted token list, written as text and read back."""
    folder = workspace.new_folder(spark, "tokens")
    names = features.tokens(F.col("text"))
    tokens = X.table(spark, sf_dir, "documents").select(F.explode(names).alias("token")).distinct()
    writers.write_token_list(tokens, folder)
    return spark.read.text(folder).withColumnRenamed("value", "token")


@query
def thresholds_json(spark, sf_dir):
    df = thresholds.class_thresholds(
        X.predictions(spark, sf_dir), X.class_mapping(spark, sf_dir)
    )
    folder = workspace.new_folder(spark, "thresholds")
    writers.write_json(thresholds.thresholds_json(df), folder)
    back = spark.read.text(folder).select(
        F.explode(F.from_json("value", "map<string,double>")).alias("label", "threshold")
    )
    return back.withColumn("threshold", r6("threshold"))
