"""Upsert of staged messages into the message table by content hash."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from msgloom.functions import text as T
from msgloom.operators.dedup import first_per_key, newest_known
from msgloom.operators.ranking import with_rank

PAYLOAD = ["text", "label"]
#: Buckets in which new rows are numbered, cut by a quantile sketch of their order.
ID_BUCKETS, SKETCH = 256, 20_000


def with_hash(df: DataFrame, text_col: str = "text_raw", hash_col: str = "md5_hash") -> DataFrame:
    return df.withColumn(hash_col, T.md5_text(F.col(text_col)))


def backfill_hash(
    df: DataFrame, text_col: str = "text_raw", hash_col: str = "md5_hash"
) -> DataFrame:
    """Fill a missing or empty hash from the raw text."""
    missing = F.col(hash_col).isNull() | (F.col(hash_col) == "")
    return df.withColumn(
        hash_col, F.when(missing, T.md5_text(F.col(text_col))).otherwise(F.col(hash_col))
    )


def stage(df: DataFrame, order_by: str = "row_seq") -> DataFrame:
    """Rows to load: one for each hash of the raw text, the first in order."""
    return first_per_key(with_hash(df), ["md5_hash"], order_by)


def _text_digest() -> Column:
    return F.unhex(F.md5("text"))


def stage_digests(df: DataFrame) -> DataFrame:
    """The rows of `stage` with a digest for the text and none for the raw text, for `upsert`."""
    rows = with_hash(df).select("row_seq", F.lit(None).cast("string").alias("text_raw"), _text_digest().alias("text"), "label", "md5_hash")
    return first_per_key(rows, ["md5_hash"], ["row_seq", "label", "text"])


def target_digests(target: DataFrame) -> DataFrame:
    """The hashed rows of a message table with a digest for the text, for `upsert`; raw texts only where they aren't of the hash."""
    own = F.md5("text_raw").eqNullSafe(F.col("md5_hash"))
    return target.filter("md5_hash is not null").withColumns({"text_raw": F.when(~own, F.col("text_raw")), "text": _text_digest()})


def with_texts(decided: DataFrame, df: DataFrame) -> DataFrame:
    """Rows to write, decided by digests, with the texts of the staged rows df: these are shuffled once."""
    named = lambda rows: rows.withColumn("md5_hash", F.coalesce("md5_hash", F.lit("")))
    # Of rows that share row_seq too, the one that stage_digests took.
    texts = first_per_key(named(with_hash(df)), ["md5_hash"], ["row_seq", "label", _text_digest()])
    d, s = named(decided).alias("d"), texts.alias("s")
    return d.join(s, "md5_hash").select(
        "d.id", F.coalesce("d.text_raw", "s.text_raw").alias("text_raw"), "s.text", "s.label",
        F.nullif("md5_hash", F.lit("")).alias("md5_hash"), "d.created_at", "d.updated_at",
    )


def _changed(left: str, right: str) -> Column:
    same = [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in PAYLOAD]
    return ~(same[0] & same[1])


def unmatched(target: DataFrame, staging: DataFrame) -> DataFrame:
    """Staged rows whose hash the target doesn't hold."""
    known = target.select("md5_hash").filter("md5_hash is not null").distinct()
    return staging.join(known, "md5_hash", "left_anti")


def range_bounds(df: DataFrame, order_by: str = "row_seq", buckets: int = ID_BUCKETS) -> Column:
    """Ascending values that cut df into at most `buckets` ranges of about equal size, read once."""
    shares = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    bounds = F.percentile_approx(order_by, shares, F.lit(SKETCH))
    return df.agg(F.coalesce(F.array_distinct(bounds), F.array().cast("array<bigint>"))).scalar()


def assign_ids(df: DataFrame, start: Column, order_by: str = "row_seq", bounds: Column | None = None) -> DataFrame:
    """Add consecutive ids after `start`, in the order of a unique number, however sparse it is.

    Rows are numbered inside the ranges between `bounds` and after those before; bounds of any
    rows of like order will do.
    """
    bounds = range_bounds(df, order_by) if bounds is None else bounds
    # Its place among the bounds; a scalar subquery can't stand in a lambda.
    bucket = F.array_position(F.sort_array(F.array_append(bounds, F.col(order_by))), F.col(order_by))
    ranked = with_rank(df, bucket, [order_by], output="_rank")
    return ranked.withColumn("id", start + F.col("_rank")).drop("_rank")


def upsert(
    target: DataFrame,
    staging: DataFrame,
    now: Column | None = None,
    dense_ids: bool = True,
    top_id: Column | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """The target after the load.

    Matched rows take the staged text and label if either differs; staged rows without a
    match get new ids in the order of row_seq; of several rows with one hash only the one
    with the highest id stays. `staging` must be unique by hash, as `stage` leaves it.

    Consecutive ids need the unmatched rows found and numbered apart, by hash and order alone.
    dense_ids=False takes the next id plus row_seq instead: unique and in order, with gaps, and
    the whole load is one join.

    `top_id` is the highest id in use, where `target` is only the part of the table whose
    hashes occur in the staging rows. `action` tells what became of a row: kept, updated or
    inserted.

    With `ranges` the rows of each of so many ranges of hashes come out of one task, so that a writer
    that splits them by hash prefix needn't shuffle the texts once more.
    """
    now = F.current_timestamp() if now is None else now
    target = backfill_hash(target)
    # Target rows without a hash stay out of the join: beside them the others would lose the
    # partitioning by hash, and be shuffled again.
    keys = ["md5_hash"] if ranges is None else ["_range", "md5_hash"]

    def dealt(df: DataFrame) -> DataFrame:
        if ranges is None:
            return df
        # Each side is dealt out by the number of the range itself, which the joins on it then keep.
        return df.withColumn("_range", T.hash_range(F.col("md5_hash"), ranges)).repartitionById(ranges, "_range")

    t, staging_rows = newest_known(dealt(target.filter("md5_hash is not null")), keys), dealt(staging)
    t, s = t.alias("t"), staging_rows.alias("s")
    # The highest id is one number, read once, however many rows use it.
    if top_id is None:
        top_id = target.agg(F.max("id")).scalar()
    top_id = F.coalesce(top_id, F.lit(0).cast("bigint"))
    same_hash = reduce(and_, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys])
    staged, known = F.col("s.row_seq").isNotNull(), F.col("t.id").isNotNull()
    changed = staged & known & _changed("t", "s")
    new_id = top_id + 1 + F.col("s.row_seq")
    if dense_ids:
        # Ids are given to hashes and order alone, and join the staged rows in the shuffle by hash
        # that the load needs anyway. Only one staged row may have no hash; it takes part in no join.
        new = unmatched(target, staging.select("md5_hash", "row_seq"))
        new = assign_ids(new, top_id, bounds=range_bounds(staging)).select("md5_hash", F.col("id").alias("_new"))
        lone = new.filter("md5_hash is null").agg(F.max("_new")).scalar()
        s = staging_rows.join(dealt(new), keys, "left").alias("s")
        new_id = F.when(F.col("s.md5_hash").isNull(), lone).otherwise(F.col("s._new"))
    merged = t.join(s, same_hash, "full_outer").select(
        F.coalesce("t.id", new_id).alias("id"),
        F.coalesce("t.text_raw", "s.text_raw").alias("text_raw"),
        *[F.when(staged, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in PAYLOAD],
        F.coalesce("t.md5_hash", "s.md5_hash").alias("md5_hash"),
        F.when(known, F.col("t.created_at")).otherwise(now).alias("created_at"),
        F.when(changed, now).otherwise(F.col("t.updated_at")).alias("updated_at"),
        F.when(~known, "inserted").when(changed, "updated").otherwise("kept").alias("action"),
    )
    unhashed = target.filter("md5_hash is null").withColumn("action", F.lit("kept"))
    return merged.unionByName(unhashed.select(*merged.columns))


def upsert_summary(target: DataFrame, staging: DataFrame) -> DataFrame:
    """One row: updated, inserted and removed rows. Writes nothing, so it is the dry run.

    Every target row that differs counts as updated, older copies too, because the update
    comes before their removal.
    """
    # Texts are compared by md5, so that none travels.
    digests = [_text_digest().alias("text"), "label"]
    copies = (
        backfill_hash(target)
        .filter("md5_hash is not null")
        .select("md5_hash", *digests)
        .groupBy("md5_hash", *PAYLOAD)
        .agg(F.count("*").alias("n"))
    )
    per_hash = (
        copies.alias("t")
        .join(staging.select("md5_hash", *digests).alias("s"), F.col("t.md5_hash") == F.col("s.md5_hash"), "full_outer")
        .select(
            F.coalesce("t.md5_hash", "s.md5_hash").alias("md5_hash"),
            F.coalesce("t.n", F.lit(0)).alias("n"),
            F.when(
                F.col("t.md5_hash").isNotNull()
                & F.col("s.md5_hash").isNotNull()
                & _changed("t", "s"),
                F.col("t.n"),
            )
            .otherwise(0)
            .alias("updated"),
        )
        .groupBy("md5_hash")
        .agg(F.sum("n").alias("n"), F.sum("updated").alias("updated"))
    )
    return per_hash.agg(
        F.coalesce(F.sum("updated"), F.lit(0)).alias("n_updated"),
        F.count_if(F.col("n") == 0).alias("n_inserted"),
        F.coalesce(F.sum(F.greatest(F.col("n") - 1, F.lit(0))), F.lit(0)).alias("n_removed"),
    )
