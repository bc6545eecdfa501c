"""Raw messages to the cleaned table, and its load into the message table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from msgloom.functions import text as T
from msgloom.operators import dedup, entities, features, upsert
from msgloom.schema import MESSAGES
from msgloom.sources import readers, workspace
from msgloom.sources.versions import CODEC, DIGITS, UNHASHED, Folder, VersionedTable, prefix_of

#: Rows of a load for each of its tasks, at least.
RANGE_ROWS = 10_000
STAGED = ["row_seq", "text_raw", "text", "label", "md5_hash"]


def clean_messages(raw: DataFrame, **options) -> DataFrame:
    """(…, text_raw, text, label, mappings) from raw rows; one pass without a shuffle."""
    rows = features.drop_missing(raw).withColumn("text_raw", F.col("text").cast("string"))
    return entities.normalise_placeholders(rows, **options).withColumn(
        "label", T.normalise_label(F.col("label"))
    )


def load_messages(target: DataFrame, cleaned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(new message table, summary) of loading cleaned rows into the target.

    The summary alone is the dry run. Write the table to a new path, and only then make
    readers use it: a path can't be overwritten while it's read.
    """
    readers.require_columns(cleaned, ["text", "label", "text_raw"])
    staging = upsert.stage(cleaned)
    return upsert.upsert(target, staging), upsert.upsert_summary(target, staging)


def message_table(spark: SparkSession, base: str, digits: int = DIGITS) -> VersionedTable:
    return VersionedTable(spark, base, MESSAGES, "md5_hash", digits)


def message_version(spark: SparkSession, base: str, version: int | None = None) -> DataFrame:
    """One committed version of the message table, the newest by default; version 0 is the empty table."""
    return message_table(spark, base).read(version)


def load_staged(
    table: VersionedTable, staging: DataFrame, now: Column | None = None, dry_run: bool = False
) -> DataFrame:
    """Load stored staging rows (row_seq, text_raw, text, label, md5_hash; unique by hash); gives the summary.

    Only the hash prefixes of staged rows, and of rows whose hash is filled now, are read, merged and
    written anew; the new version's manifest names the old folders of all others. A load that dies
    leaves readers on the version they had. Of two loads at a time the second one to commit fails
    with CommitConflict, and is simply run again.
    """
    version = table.current()
    known = table.by_prefix(version)
    prefixes = lambda df: {r[0] for r in df.select(prefix_of(F.col("md5_hash"), table.digits)).distinct().collect()}
    touched = prefixes(staging)  # at most one short string for each prefix
    if UNHASHED in known:
        waiting = upsert.backfill_hash(table.read(version, [UNHASHED])).filter("md5_hash is not null")
        filled = prefixes(waiting)
        touched |= filled | {UNHASHED} if filled else set()
    target = table.read(version, touched)
    counts = upsert.upsert_summary(target, staging).first()
    summary = table.spark.createDataFrame([tuple(counts)], "n_updated long, n_inserted long, n_removed long")
    if dry_run or not any(counts):
        return summary
    top_id = F.lit(table.top_id(version)).cast("bigint")
    rows = sum(part["n_rows"] for p in touched & set(known) for part in known[p]) + counts["n_inserted"]
    # A small load makes few files, a large one has Spark's usual number of tasks.
    ranges = max(1, min(rows // RANGE_ROWS, int(table.spark.conf.get("spark.sql.shuffle.partitions"))))
    loaded = upsert.upsert(target, staging, now, top_id=top_id, ranges=ranges).select(*MESSAGES.fieldNames())
    written = table.write_parts(loaded, version + 1, dealt=True)
    kept = [part for p, parts in known.items() if p not in touched for part in parts]
    table.commit(kept + written, version + 1)
    return summary


def start_table(table: VersionedTable, rows: DataFrame) -> int:
    """The first version of the table: rows with their hashes filled, the newest of each hash."""
    return table.replace(dedup.newest_per_hash(upsert.backfill_hash(rows)))


def load(
    spark: SparkSession, base: str, cleaned: DataFrame, dry_run: bool = False, digits: int = DIGITS
) -> DataFrame:
    """Load cleaned rows into the newest version of the message table as the next one; gives the summary.

    The staging rows are written once to the shared folder, as the load reads them several times,
    and go when it ends. A dry run writes nothing else.
    """
    readers.require_columns(cleaned, ["text", "label", "text_raw"])
    folder = workspace.new_folder(spark, "staging")
    try:
        upsert.stage(cleaned).select(*STAGED).write.option("compression", CODEC).parquet(folder)
        return load_staged(message_table(spark, base, digits), spark.read.parquet(folder), dry_run=dry_run)
    finally:
        Folder(spark, folder).delete("")


def load_report(cleaned: DataFrame) -> DataFrame:
    """Raw texts that occur more than once in the rows to load."""
    return dedup.duplicate_report(cleaned, ["text_raw"])
