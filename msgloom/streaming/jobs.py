"""Streams: scoring with two sinks, daily quality, dedup and upsert.

Sinks are folders with one sub-folder for each micro-batch, written in overwrite mode. A
batch that runs again after a failure replaces its own output, so each row lands once. Where a
batch goes to two sinks, one commit record names it when both are written, and readers of either
take committed batches only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from msgloom.functions import text as T
from msgloom.operators import monitor, scoring, upsert
from msgloom.operators.dedup import first_per_key
from msgloom.plans import ingest
from msgloom.schema import SEEN
from msgloom.sources.readers import spread
from msgloom.sources.versions import DIGITS, Folder, VersionedTable, prefix_of

BATCH = "batch_id"
#: Rows of a batch whose hashes are broadcast, at most.
SMALL_BATCH = 100_000


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")


def read_batches(spark: SparkSession, path: str, commits: str | None = None) -> DataFrame:
    """All rows of a batched sink with their batch_id; of the batches that `commits` names, if given."""
    if commits is None:
        return spark.read.parquet(path)
    done = committed(spark, commits)
    # Folders of other batches are not listed. An empty list gives no rows of the same columns.
    paths = [f"{path}/{BATCH}={i}" for i in done if Folder(spark, path).exists(f"{BATCH}={i}")]
    return spark.read.option("basePath", path).parquet(*paths) if paths else spark.read.parquet(path).limit(0)


def committed(spark: SparkSession, commits: str) -> list[int]:
    """Numbers of the batches whose sinks are all written."""
    return sorted(int(n) for n in Folder(spark, commits).names("") if n.isdigit())


def _start(stream: DataFrame, checkpoint: str, each_batch, mode: str, trigger: dict | None) -> StreamingQuery:
    return (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(each_batch)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def score_stream(
    messages: DataFrame,
    scorer: scoring.Scorer,
    mapping: DataFrame,
    thresholds: DataFrame | None,
    logs_path: str,
    low_conf_path: str,
    checkpoint: str,
    ts_col: str | None = None,
    trigger: dict | None = None,
    key: str = "row_seq",
    parts: int | None = None,
    commits: str | None = None,
) -> StreamingQuery:
    """Score and gate messages; all go to the log, those below their threshold also to the
    low-confidence log. Both come from one persisted micro-batch, dealt over `parts` partitions if given.

    With `commits`, a folder, a batch is named there after both logs are written: read_batches with
    that folder shows a batch that died in between in neither log, and a batch that is named
    already isn't written again under its readers.
    """

    spark = messages.sparkSession

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        if commits is not None and Folder(spark, commits).exists(str(batch_id)):
            return
        ts = F.current_timestamp() if ts_col is None else F.col(ts_col)
        rows = spread(batch, key, parts)
        scored = scoring.score_messages(rows, scorer, mapping, thresholds)
        # Only what the two logs need is held.
        needed = [key, "text", "intent", "confidence", "threshold", "slots"]
        scored = scored.select(*needed, *([ts_col] if ts_col else [])).persist()
        try:
            write_batch(scoring.log_rows(scored, ts), logs_path, batch_id)
            write_batch(scoring.low_confidence_rows(scored, ts), low_conf_path, batch_id)
            if commits is not None:
                Folder(spark, commits).create(str(batch_id))
        finally:
            scored.unpersist()

    return _start(messages, checkpoint, each_batch, "append", trigger)


def daily_quality_stream(logs: DataFrame, delay: str = "1 day") -> DataFrame:
    """Streaming (window_start, day, intent, tp, fp, fn): one-day windows under a watermark.

    Windows start at midnight UTC. The day is that of the session's time zone, so away from
    UTC a day is in two windows, which read_daily_quality adds up.
    """
    windows = (
        monitor.intent_events(logs.withWatermark("ts", delay))
        .groupBy(F.window("ts", "1 day"), F.to_date("ts").alias("day"), "intent")
        .agg(*monitor.count_outcomes())
    )
    return windows.select(
        F.col("window.start").alias("window_start"), "day", "intent", "tp", "fp", "fn"
    )


def write_daily_quality(
    logs: DataFrame, path: str, checkpoint: str, delay: str = "1 day", trigger: dict | None = None
) -> StreamingQuery:
    """Write the windows that a micro-batch changed."""
    return _start(
        daily_quality_stream(logs, delay),
        checkpoint,
        lambda batch, batch_id: write_batch(batch, path, batch_id),
        "update",
        trigger,
    )


def read_daily_quality(spark: SparkSession, path: str) -> DataFrame:
    """(day, intent, precision, recall) from the newest version of each window."""
    window = Window.partitionBy("window_start", "day", "intent").orderBy(F.desc(BATCH))
    newest = (
        read_batches(spark, path).withColumn("turn", F.row_number().over(window)).filter("turn = 1")
    )
    counts = newest.groupBy("day", "intent").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn")])
    return monitor.with_precision_recall(counts).select("day", "intent", "precision", "recall")


def first_seen(messages: DataFrame, ts_col: str = "ts", delay: str = "1 day") -> DataFrame:
    """Stream of messages without repeats of the same raw text within the delay."""
    hashed = messages.withColumn("md5_hash", T.md5_text(F.col("text_raw")))
    return hashed.withWatermark(ts_col, delay).dropDuplicatesWithinWatermark(["md5_hash"])


def seen_table(spark: SparkSession, path: str, digits: int = DIGITS) -> VersionedTable:
    return VersionedTable(spark, path, SEEN, "md5_hash", digits)


def write_never_seen(
    messages: DataFrame,
    known: VersionedTable,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    max_parts: int = 8,
    digits: int = DIGITS,
) -> StreamingQuery:
    """Add messages (row_seq, text_raw) to the log at `path` whose text is in neither `known` nor the log.

    No watermark ends the memory: what was seen is the message table's hashes and the log's own,
    in folders by hash prefix, of which a batch reads those of its own hashes and only that column.
    Of equal texts in a batch the one with the smallest row_seq stays. A batch that died shows in
    no version of the log, one that runs again after its commit is left out.
    """
    log = seen_table(messages.sparkSession, path, digits)

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        if batch_id <= log.last_batch():
            return
        rows = batch.select(F.lit(None).cast("long").alias("id"), "row_seq", T.md5_text(F.col("text_raw")).alias("md5_hash"), "text_raw")
        first = new = first_per_key(rows.filter("md5_hash is not null"), ["md5_hash"]).persist()
        try:
            for table in (known, log):
                keys = [k[0] for k in first.select(prefix_of(F.col("md5_hash"), table.digits)).distinct().collect()]
                new = new.join(table.read(prefixes=keys).select("md5_hash"), "md5_hash", "left_anti")
            log.append(new, batch_id)
            log.compact(max_parts + 1)
        finally:
            first.unpersist()

    return _start(messages, checkpoint, each_batch, "append", trigger)


def write_first_seen(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    ts_col: str = "ts",
    delay: str = "1 day",
    trigger: dict | None = None,
) -> StreamingQuery:
    return _start(
        first_seen(messages, ts_col, delay),
        checkpoint,
        lambda batch, batch_id: write_batch(batch, path, batch_id),
        "append",
        trigger,
    )


def current_messages(spark: SparkSession, path: str) -> DataFrame:
    """The message table kept by upsert_stream: the newest row of each hash in the last committed version."""
    return ingest.message_version(spark, path)


def upsert_stream(
    messages: DataFrame,
    target: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    max_parts: int = 8,
    digits: int = DIGITS,
) -> StreamingQuery:
    """Upsert each micro-batch of cleaned messages (row_seq, text_raw, text, label).

    A batch reads only the folders of its own hash prefixes, takes the highest id from the manifest,
    and adds only the rows it inserts or changes as a new version. A batch that died shows in no
    version, one that runs again after its commit is left out. When a prefix has more than
    max_parts folders, it is made one again. The target is the first version, written once.

    A batch's rows are read twice: once for their digests, and once for the texts of the rows to write.
    """
    table = ingest.message_table(target.sparkSession, path, digits)
    if not table.current():
        ingest.start_table(table, target)

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        if batch_id <= table.last_batch():
            return
        # What becomes of a row is decided without texts, by their digests; only these rows are held.
        keys = upsert.stage_digests(batch).persist()
        try:
            prefixes = keys.select(prefix_of(F.col("md5_hash"), digits)).distinct().collect()
            # The hashes of a small batch select rows of the table in place; those of a large one join by a
            # shuffle, as Spark sizes what is held too low and would broadcast it.
            hashes = keys.select("md5_hash")
            hashes = F.broadcast(hashes) if keys.count() <= SMALL_BATCH else hashes.hint("merge")
            table_rows = upsert.target_digests(table.read(prefixes=[k[0] for k in prefixes]))
            touched = table_rows.join(hashes, "md5_hash", "left_semi")
            top_id = F.lit(table.top_id()).cast("bigint")
            decided = upsert.upsert(touched, keys, top_id=top_id).filter("action <> 'kept'")
            table.append(upsert.with_texts(decided, batch), batch_id)
            table.compact(max_parts + 1)
        finally:
            keys.unpersist()

    return _start(messages, checkpoint, each_batch, "append", trigger)
