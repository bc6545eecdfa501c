"""Everything derived from one table of predictions with probabilities."""

from __future__ import annotations

from pyspark.sql import DataFrame

from msgloom import constants as C
from msgloom.operators import metrics, thresholds


def evaluate(
    predictions: DataFrame, mapping: DataFrame, min_threshold: float = C.DEFAULT_THRESHOLD
) -> dict[str, DataFrame]:
    """Lazy tables by name. Persist `predictions` before using several of them."""
    return {
        "report": metrics.classification_report(predictions),
        "cells": metrics.confusion_cells(predictions),
        "top_confusions": metrics.top_confusions(predictions),
        "confidence": metrics.confidence_stats(predictions),
        "thresholds": thresholds.class_thresholds(predictions, mapping, min_threshold),
        "first_errors": metrics.first_errors(predictions),
        "low_f1_errors": metrics.low_f1_errors(predictions),
    }
