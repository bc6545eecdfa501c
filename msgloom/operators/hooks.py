"""Place for a user's own entity model; everything else works without Python workers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msgloom.schema import SPANS


def with_model_spans(
    df: DataFrame,
    load: Callable[[], Callable[[str], list[dict]]],
    text_col: str = "text_clean",
    output: str = "model_spans",
) -> DataFrame:
    """Add spans found by a model, for normalise_placeholders(extra_spans=[output]).

    `load` runs once for each task and returns a function from a text to span dicts with
    start, end, ph, value and score. Texts arrive in Arrow batches.
    """
    @F.pandas_udf(SPANS)
    def detect(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        find = load()
        for texts in batches:
            yield texts.map(lambda t: find(t) if t else [])

    return df.withColumn(output, detect(F.col(text_col)))
