"""All checks of one preparation together."""

from __future__ import annotations

from pyspark.sql import DataFrame

from msgloom.operators import audit, dedup, features, splits
from msgloom.plans.prepare import Prepared


def audit_rows(
    modelled: DataFrame, prepared: Prepared, encoded: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Lazy tables by name: eight checks of modelled rows and of their preparation.

    Prepare with a folder, so that the checks read written rows. Token overlap needs the
    encoded rows.
    """
    rows = prepared.rows
    weights = features.class_weights(rows.filter("split = 'train'"))
    checks = {
        "label_distribution": dedup.label_distribution(modelled),
        "text_conflicts": prepared.conflicts,
        "text_overlap": splits.split_overlap(rows, ["text_raw", "text_model"]),
        "group_overlap": splits.split_overlap(rows, ["group_key"]),
        "leak_tokens": splits.leak_tokens(rows),
        "placeholders": audit.placeholder_by_label(rows),
        "weights": audit.weights_check(weights, prepared.mapping),
        "collisions": audit.collision_rows(modelled),
    }
    if encoded is not None:
        checks["token_overlap"] = splits.token_overlap(encoded)
    return checks
