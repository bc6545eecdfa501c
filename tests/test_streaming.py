from __future__ import annotations

import hashlib
from collections import Counter

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from checks import fixtures as X
from msgloom import constants as C
from msgloom.operators import monitor, scoring, upsert
from msgloom.plans import ingest
from msgloom.schema import MESSAGES
from msgloom.sources.versions import VersionedTable
from msgloom.streaming import jobs

SF = "/root/testdata/sf0.001"


def split_files(spark, df, path, n=5, key="event_id"):
    for i in range(n):
        df.filter(F.col(key) % n == i).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_daily_stream_equals_batch(spark, tmp_path):
    logs = X.logs(spark, SF)
    stream = split_files(spark, logs, str(tmp_path / "in"))
    # Files hold days in mixed order, so nothing may be taken as late.
    jobs.write_daily_quality(stream, str(tmp_path / "out"), str(tmp_path / "cp"), "60 days").awaitTermination()
    assert jobs.read_batches(spark, str(tmp_path / "out")).select("batch_id").distinct().count() >= 5
    got = jobs.read_daily_quality(spark, str(tmp_path / "out"))
    want = monitor.daily_precision_recall(logs)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_late_rows_are_left_out_in_append_mode(spark, tmp_path):
    schema = "ts timestamp, pred string, actual string, correct int"
    days = ["2024-01-01 10:00:00", "2024-01-05 10:00:00", "2024-01-02 10:00:00", "2024-01-09 10:00:00"]
    path = str(tmp_path / "in")
    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    frames = [spark.createDataFrame([(d, "a", "a", 1)], "ts string, pred string, actual string, correct int").withColumn("ts", F.col("ts").cast("timestamp")) for d in days]
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")
    for frame in frames:
        frame.coalesce(1).write.mode("append").parquet(path)
        (
            jobs.daily_quality_stream(stream, "1 day").writeStream.outputMode("append")
            .format("parquet").option("path", out).option("checkpointLocation", cp)
            .trigger(availableNow=True).start().awaitTermination()
        )
    got = sorted(str(r["day"]) for r in spark.read.parquet(out).collect())
    assert got == ["2024-01-01", "2024-01-05"]


def test_scores_equal_batch_and_replay_is_idempotent(spark, tmp_path):
    raw = X.messages_raw(spark, SF)
    mapping = spark.createDataFrame([(v, i) for i, v in enumerate(C.INTENT_LABELS)], "label string, id int")
    score = scoring.column_scorer(X.word_logits(C.INTENT_LABELS))
    limits = spark.createDataFrame([("review", 0.2)], "label string, threshold double")
    stream = split_files(spark, raw, str(tmp_path / "in"), 3, "row_seq")
    logs, low = str(tmp_path / "logs"), str(tmp_path / "low")
    for cp in ("cp1", "cp2"):  # the second run replays the same batches from the start
        jobs.score_stream(stream, score, mapping, limits, logs, low, str(tmp_path / cp), "ts").awaitTermination()
    got = jobs.read_batches(spark, logs)
    want = scoring.score_messages(raw, score, mapping, limits)
    assert got.count() == raw.count()
    assert got.select("row_seq", "pred").exceptAll(want.select("row_seq", "intent")).count() == 0
    assert jobs.read_batches(spark, low).count() == want.filter("confidence < threshold").count()
    allowed = {*C.INTENT_LABELS, "other"}
    assert {r[0] for r in got.select("pred").distinct().collect()} <= allowed


def test_first_seen(spark, tmp_path):
    rows = [(1, "2024-01-01 00:00:00", "a"), (2, "2024-01-01 01:00:00", "a"), (3, "2024-01-01 02:00:00", "b"), (4, "2024-01-01 03:00:00", "a")]
    df = spark.createDataFrame(rows, "row_seq long, ts string, text_raw string").withColumn("ts", F.col("ts").cast("timestamp"))
    path = str(tmp_path / "in")
    for r in rows:
        df.filter(F.col("row_seq") == r[0]).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)
    jobs.write_first_seen(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = jobs.read_batches(spark, str(tmp_path / "out"))
    assert sorted(r["row_seq"] for r in got.collect()) == [1, 3]


def test_upsert_stream(spark, tmp_path):
    rows, target = X.upsert_rows(spark, SF), X.upsert_target(spark, SF)
    stream = split_files(spark, rows, str(tmp_path / "in"), 1, "row_seq")
    out = str(tmp_path / "out")
    jobs.upsert_stream(stream, target, out, str(tmp_path / "cp")).awaitTermination()
    got = jobs.current_messages(spark, out).select("id", "md5_hash", "text", "label")
    want = upsert.upsert(target, upsert.stage(rows)).select("id", "md5_hash", "text", "label")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    # The same rows again, as a second stream batch: nothing new is written.
    rows.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    jobs.upsert_stream(stream, target, out, str(tmp_path / "cp")).awaitTermination()
    assert jobs.current_messages(spark, out).count() == want.count()
    assert ingest.message_table(spark, out).versions() == [1, 2]


def test_upsert_stream_over_several_batches(spark, tmp_path):
    """Later batches change and extend the table; ids stay unique and consecutive."""
    schema = "row_seq long, text_raw string, text string, label string"
    path = str(tmp_path / "in")
    target = spark.createDataFrame(
        [(5, "a", "a", "x", None), (6, "b", "b", "x", None), (7, None, "n", "x", None)],
        "id long, text_raw string, text string, label string, md5_hash string",
    ).withColumns({"created_at": F.current_timestamp(), "updated_at": F.lit(None).cast("timestamp")})
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")
    for rows in (
        [(1, "a", "a", "y"), (2, "c", "c", "x")],
        [(3, "c", "c", "z"), (4, "d", "d", "x"), (5, "b", "b", "x")],
    ):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
        stream = spark.readStream.schema(schema).parquet(path)
        jobs.upsert_stream(stream, target, out, cp).awaitTermination()
    got = {(r["id"], r["text"], r["label"]) for r in jobs.current_messages(spark, out).collect()}
    assert got == {(5, "a", "y"), (6, "b", "x"), (7, "n", "x"), (8, "c", "z"), (9, "d", "x")}
    table = ingest.message_table(spark, out)
    written = Counter()
    for part in table.parts():
        written[part["seq"]] += part["n_rows"]
    assert written == {1: 3, 2: 2, 3: 2}
    assert table.last_batch() == 1 and table.top_id() == 9


def _many_batches(spark, tmp_path, n, **options):
    """n batches over the same 40 texts, then the table and what it should hold."""
    schema = "row_seq long, text_raw string, text string, label string"
    path, out, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))
    target = spark.createDataFrame([], MESSAGES)
    want = {}
    for i in range(n):
        rows = [(100 * i + j, f"t{k}", f"t{k}", f"l{i}") for j, k in enumerate(range(i, i + 40))]
        want |= {r[1]: r[3] for r in rows}
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
        stream = spark.readStream.schema(schema).parquet(path)
        jobs.upsert_stream(stream, target, out, cp, digits=1, **options).awaitTermination()
    return ingest.message_table(spark, out), want


def test_upsert_stream_compacts(spark, tmp_path):
    table, want = _many_batches(spark, tmp_path, 5, max_parts=2)
    assert max(map(len, table.by_prefix().values())) <= 2
    rows = table.read().collect()
    assert {r["text"]: r["label"] for r in rows} == want and len(rows) == len(want)
    assert sorted(r["id"] for r in rows) == list(range(1, len(want) + 1))
    assert table.last_batch() == 4
    version = table.current()
    table.compact()
    assert all(len(p) == 1 for p in table.by_prefix().values()) and table.last_batch() == 4
    assert table.read().exceptAll(table.read(version)).count() == 0 and table.read().count() == len(want)


def test_a_batch_reads_its_prefixes_and_a_dead_one_shows_nowhere(spark, tmp_path, monkeypatch):
    table, want = _many_batches(spark, tmp_path, 2)
    schema = "row_seq long, text_raw string, text string, label string"
    spark.createDataFrame([(900, "t3", "t3", "new")], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    start = lambda: jobs.upsert_stream(stream, table.read(), table.base, str(tmp_path / "cp"), digits=1)
    seen = []
    plain = upsert.upsert
    monkeypatch.setattr(upsert, "upsert", lambda rows, *a, **k: seen.append(rows.inputFiles()) or plain(rows, *a, **k))
    version = table.current()
    with monkeypatch.context() as m:
        m.setattr(VersionedTable, "commit", lambda *a: (_ for _ in ()).throw(OSError("killed")))
        with pytest.raises(StreamingQueryException):
            start().awaitTermination()
    assert table.current() == version and {r["text"]: r["label"] for r in table.read().collect()} == want
    start().awaitTermination()
    assert table.current() == version + 1
    assert {r["text"]: r["label"] for r in table.read().collect()} == want | {"t3": "new"}
    own = hashlib.md5(b"t3").hexdigest()[0]
    assert {f.split("prefix=")[1][0] for files in seen for f in files if "prefix=" in f} == {own}


def test_a_half_written_base_is_not_taken(spark, tmp_path):
    table = ingest.message_table(spark, str(tmp_path / "out"))
    rows = spark.createDataFrame([(1, "a", "a", "x", None)], "id long, text_raw string, text string, label string, md5_hash string")
    rows = rows.withColumns({"created_at": F.current_timestamp(), "updated_at": F.lit(None).cast("timestamp")})
    table.write_parts(rows, 1)  # died before the commit
    assert table.current() == 0 and table.read().count() == 0
    assert ingest.start_table(table, rows) == 1 and table.read().first()["md5_hash"] is not None


def test_a_batch_that_dies_between_two_sinks_shows_in_neither(spark, tmp_path, monkeypatch):
    raw = X.messages_raw(spark, SF).limit(60)
    mapping = spark.createDataFrame([(v, i) for i, v in enumerate(C.INTENT_LABELS)], "label string, id int")
    score = scoring.column_scorer(X.word_logits(C.INTENT_LABELS))
    stream = split_files(spark, raw, str(tmp_path / "in"), 2, "row_seq")
    logs, low, done = (str(tmp_path / n) for n in ("logs", "low", "done"))
    run = lambda: jobs.score_stream(stream, score, mapping, None, logs, low, str(tmp_path / "cp"), "ts", commits=done)
    plain = jobs.write_batch

    def dies(df, path, batch_id):
        if path == low and batch_id == 1:
            raise OSError("killed")
        plain(df, path, batch_id)

    with monkeypatch.context() as m:
        m.setattr(jobs, "write_batch", dies)
        with pytest.raises(StreamingQueryException):
            run().awaitTermination()
    assert jobs.committed(spark, done) == [0]
    assert spark.read.parquet(logs).select("batch_id").distinct().count() == 2  # the dead batch wrote one log
    first = jobs.read_batches(spark, logs, done)
    assert {r[0] for r in first.select("batch_id").distinct().collect()} == {0}
    assert {r[0] for r in jobs.read_batches(spark, low, done).select("batch_id").distinct().collect()} <= {0}
    run().awaitTermination()
    assert jobs.committed(spark, done) == [0, 1]
    assert jobs.read_batches(spark, logs, done).count() == raw.count()
    assert jobs.read_batches(spark, logs, str(tmp_path / "nothing")).count() == 0


def test_never_seen_catches_repeats_of_any_age(spark, tmp_path):
    old = [(1, "known", "known", "x", None)]
    target = spark.createDataFrame(old, "id long, text_raw string, text string, label string, md5_hash string")
    target = target.withColumns({"created_at": F.current_timestamp(), "updated_at": F.lit(None).cast("timestamp")})
    known = ingest.message_table(spark, str(tmp_path / "messages"))
    ingest.start_table(known, target)
    path, log = str(tmp_path / "in"), str(tmp_path / "log")
    schema = "row_seq long, text_raw string, ts string"
    batches = [
        [(2, "known", "2024-01-01"), (3, "a", "2024-01-01"), (4, "a", "2024-01-01"), (5, None, "2024-01-01")],
        [(6, "b", "2024-05-01"), (7, "a", "2024-05-01")],  # months after any watermark's delay
        [(8, "known", "2025-01-01"), (9, "a", "2025-01-01"), (10, "c", "2025-01-01"), (11, "b", "2023-01-01")],
    ]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
        stream = spark.readStream.schema(schema).parquet(path)
        jobs.write_never_seen(stream, known, log, str(tmp_path / "cp"), max_parts=1, digits=1).awaitTermination()
    table = jobs.seen_table(spark, log, 1)
    assert sorted((r["row_seq"], r["text_raw"]) for r in table.read().collect()) == [(3, "a"), (6, "b"), (10, "c")]
    assert table.last_batch() == 2 and max(map(len, table.by_prefix().values())) == 1
    jobs.write_never_seen(stream, known, log, str(tmp_path / "again"), digits=1).awaitTermination()  # replayed from the start
    assert table.read().count() == 3
