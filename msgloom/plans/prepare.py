"""Cleaned messages to split, labelled and grouped training rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msgloom import constants as C
from msgloom.functions import text as T
from msgloom.operators import audit, dedup, features, splits
from msgloom.sources.readers import keep_present


@dataclass
class Prepared:
    """Lazy tables of one preparation. Persist or write `rows` before using several."""

    rows: DataFrame
    mapping: DataFrame
    conflicts: DataFrame


def model_rows(cleaned: DataFrame, keep_bins: bool = False) -> DataFrame:
    """Rows with text_model and ph_info, before duplicates are dropped."""
    rows = keep_present(cleaned, ["row_seq", "text", "label", "text_raw", "mappings"])
    rows = features.drop_missing(rows).withColumns(
        {"text": T.strip(F.col("text")), "label": T.strip(F.col("label"))}
    )
    return features.with_model_text(rows, keep_bins=keep_bins)


def prepare(
    cleaned: DataFrame,
    group_by: str = "entity",
    test_ratio: float = C.TEST_RATIO,
    valid_ratio: float = C.VALID_RATIO,
    seed: int = C.SEED,
    exact: bool = False,
    keep_bins: bool = False,
    folder: str | None = None,
) -> Prepared:
    """Model text, conflicts, dedup by model text, group key, label ids and split.

    The label ids need a pass over the rows of their own. With a `folder` (shared by all
    executors) the rows are written there first, so that the text work is done once, and an
    empty train split is an error.
    """
    modelled = model_rows(cleaned, keep_bins)
    unique = dedup.first_per_key(modelled, ["text_model"])
    grouped = features.with_group_key(unique, group_by)
    if folder:
        grouped.write.mode("overwrite").parquet(folder)
        grouped = cleaned.sparkSession.read.parquet(folder)
    mapping = features.label_ids(grouped)
    encoded = features.encode_labels(grouped, mapping)
    split = splits.split_exact if exact else splits.split_by_group
    rows = split(encoded, "group_key", test_ratio, valid_ratio, seed)
    if folder:
        rows = splits.require_rows(rows)
    return Prepared(rows, mapping, audit.text_conflicts(modelled))


def encode(prepared: DataFrame, vocab_size: int = 30_000) -> DataFrame:
    """Token ids for all splits; the vocabulary comes from the train split only."""
    vocab = features.vocabulary(prepared.filter("split = 'train'"), vocab_size=vocab_size)
    return features.encode_tokens(prepared, vocab)
