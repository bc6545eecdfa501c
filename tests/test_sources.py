from __future__ import annotations

import hashlib
import os
import re

import pytest

from pyspark.sql import functions as F

from msgloom.operators import gazetteer, metrics, upsert
from msgloom.plans import evaluate, ingest, prepare
from msgloom.sources import readers, workspace, writers
from msgloom.sources.versions import CommitConflict, Folder, VersionedTable


def csv(tmp_path, text, name="in.csv"):
    path = tmp_path / name
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_raw_csv(spark, tmp_path):
    path = csv(tmp_path, 'query,intent,extra\n"a, ""quoted""\nline",Review ,1\nNA,x,2\nhi,,3\nlast,complaint,4\n')
    df = readers.read_messages_csv(spark, path)
    rows = df.orderBy("row_seq").collect()
    assert df.columns == ["text", "label", "extra", "row_seq"]
    assert [(r["text"], r["label"]) for r in rows] == [('a, "quoted"\nline', "Review "), ("last", "complaint")]
    assert readers.read_messages_csv(spark, path, null_tokens=[""]).count() == 3
    strings = readers.read_csv_strings(spark, path)
    assert strings.filter("intent = ''").count() == 1 and strings.dtypes[2][1] == "string"


def test_missing_inputs(spark, tmp_path):
    from pyspark.errors import AnalysisException

    with pytest.raises(AnalysisException):
        readers.read_messages_csv(spark, str(tmp_path / "absent.csv"))
    with pytest.raises(KeyError, match="label"):
        readers.read_messages_csv(spark, csv(tmp_path, "text,x\na,b\n"))
    with pytest.raises(KeyError, match="text_raw"):
        ingest.load_messages(spark.range(1), spark.createDataFrame([("a", "b")], "text string, label string"))


def test_first_available(spark, tmp_path):
    good = csv(tmp_path, "text,label\na,b\n")

    def broken():
        raise ConnectionError("no database")

    df = readers.first_available(
        broken,
        lambda: readers.read_table(spark, "no_such_table"),
        lambda: readers.read_csv_strings(spark, good),
        required=["text", "label"],
    )
    assert df.count() == 1
    with pytest.raises(RuntimeError, match="no database"):
        readers.first_available(broken)
    load = lambda p: readers.read_csv_strings(spark, p)
    assert readers.load_with(load, str(tmp_path / "none.csv"), good).count() == 1


def test_roles_and_columns(spark):
    df = spark.createDataFrame([("a", "b", 1)], "my_text_model string, RAW_TEXT_RAW string, pred_id int")
    assert readers.text_columns(df) == {"text_model": "my_text_model", "text_raw": "RAW_TEXT_RAW"}
    assert readers.resolve_roles(df, ["pred", "true"]) == {"pred": "pred_id"}
    assert readers.keep_present(df, ["pred_id", "nope"]).columns == ["pred_id"]


def test_jdbc_options():
    o = readers.jdbc_options("jdbc:x", "messages", ("id", 1, 100, 4), {"user": "u"})
    assert o["partitionColumn"] == "id" and o["numPartitions"] == "4" and o["user"] == "u"
    assert "numPartitions" not in readers.jdbc_options("jdbc:x", "messages")


def test_catalog_table(spark):
    spark.createDataFrame([("a", "b")], "text string, label string").createOrReplaceTempView("messages_view")
    assert readers.read_table(spark, "messages_view", ["text"]).columns == ["text"]


def test_cleaned_csv_and_parquet(spark, tmp_path):
    raw = spark.createDataFrame([(1, "order ORD-12 \"x\"\ny", " Review")], "row_seq long, text string, label string")
    cleaned = ingest.clean_messages(raw)
    writers.write_cleaned(cleaned, str(tmp_path / "c"), "csv")
    back = readers.read_csv_strings(spark, str(tmp_path / "c"))
    row = back.first()
    assert row["mappings"] == '{"[ORDER_ID]":["order ORD-12"]}' and row["label"] == "review"
    writers.write_cleaned(cleaned, str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).first()["mappings"] == {"[ORDER_ID]": ["order ORD-12"]}


def test_prepare_outputs(spark, tmp_path):
    from checks import fixtures as X

    raw = X.messages_raw(spark, "/root/testdata/sf0.001")
    made = prepare.prepare(ingest.clean_messages(raw), folder=str(tmp_path / "rows"))
    writers.write_snapshots(made.rows, str(tmp_path / "snap"))
    snap = spark.read.parquet(str(tmp_path / "snap"))
    assert {r["split"] for r in snap.select("split").distinct().collect()} == {"train", "val", "test"}
    writers.write_encoded(prepare.encode(snap), str(tmp_path / "enc"))
    enc = spark.read.parquet(str(tmp_path / "enc"))
    assert enc.count() == snap.count() and enc.filter("size(input_ids) <> 64").count() == 0
    lazily = prepare.prepare(ingest.clean_messages(raw)).rows
    columns = ["row_seq", "text_model", "group_key", "encoded_label", "split"]
    assert lazily.select(columns).exceptAll(snap.select(columns)).count() == 0


def test_error_folders(spark, tmp_path):
    rows = [(i, f"t{i}", "a/b" if i % 3 else "c", "c" if i % 3 else "d") for i in range(30)] + [(99, "x", "c", "a/b")]
    errors = spark.createDataFrame(rows, "row_seq int, text string, true string, pred string")
    writers.write_errors_by_label(errors, str(tmp_path / "by_label"))
    by_label = spark.read.parquet(str(tmp_path / "by_label"))
    assert {r["true_label"] for r in by_label.select("true_label").distinct().collect()} == {"a_b", "c"}
    pairs = metrics.top_confusions(errors, "true", "pred")
    writers.write_errors_by_pair(errors, pairs, str(tmp_path / "by_pair"), k=1)
    assert spark.read.parquet(str(tmp_path / "by_pair")).count() == 20


def test_reports_tokens_and_logs(spark, tmp_path):
    df = spark.createDataFrame([(0, 0, 0), (1, 0, 1), (2, 1, 1)], "row_seq int, true_id int, pred_id int")
    writers.write_wide(metrics.classification_report(df), str(tmp_path / "r"))
    report = {r["metric"]: r["f1"] for r in readers.read_report(spark, str(tmp_path / "r")).collect()}
    assert report["accuracy"] == pytest.approx(2 / 3)
    writers.write_wide(metrics.confusion_matrix(df, [0, 1]), str(tmp_path / "m"))
    cells = {(r["true"], r["pred"]): r["n"] for r in readers.read_matrix(spark, str(tmp_path / "m")).collect()}
    assert cells == {("0", "0"): 1, ("0", "1"): 1, ("1", "0"): 0, ("1", "1"): 1}
    tokens = spark.createDataFrame([("b",), ("a",)], "token string")
    writers.write_token_list(tokens, str(tmp_path / "t"))
    assert [r[0] for r in spark.read.text(str(tmp_path / "t")).collect()] == ["a", "b"]
    for _ in range(2):
        writers.append_logs(df, df.filter("pred_id = 0"), str(tmp_path / "l"), str(tmp_path / "low"))
    assert spark.read.parquet(str(tmp_path / "l")).count() == 6
    assert spark.read.parquet(str(tmp_path / "low")).count() == 2
    mapping = spark.createDataFrame([("a", 0)], "label string, id int")
    writers.write_wide(mapping, str(tmp_path / "map"))
    assert readers.read_label_mapping(spark, str(tmp_path / "map")).first()[:] == ("a", 0)


def test_evaluate(spark):
    from checks import fixtures as X

    sf = "/root/testdata/sf0.001"
    out = evaluate.evaluate(X.predictions(spark, sf), X.class_mapping(spark, sf))
    assert out["report"].count() == 13 and out["thresholds"].count() == 10


def test_audit_job(spark, tmp_path):
    from msgloom.plans import audit

    rows = [(i, f"order {i % 7} is late, refund ${i}", ["complaint", "review"][i % 2]) for i in range(60)]
    df = spark.createDataFrame([(i, t, label, t) for i, t, label in rows], "row_seq long, text string, label string, text_raw string")
    modelled = prepare.model_rows(df)
    checks = audit.audit_rows(modelled, prepare.prepare(df, folder=str(tmp_path / "rows"), group_by="presence"))
    assert len(checks) == 8
    assert checks["label_distribution"].count() == 2 and checks["collisions"].count() >= 0
    with pytest.raises(ValueError):
        prepare.prepare(df.limit(0), folder=str(tmp_path / "none"))


def test_shared_folder(spark):
    assert workspace.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert workspace.new_folder(spark, "x") != workspace.new_folder(spark, "x")


def test_spread(spark):
    one = spark.range(10).coalesce(1)
    assert readers.spread(one, "id", 16).rdd.getNumPartitions() == 16
    assert readers.spread(one, "id", None) is one


def test_building_a_frame_starts_no_job(spark):
    broken = spark.range(10).groupBy("id").count().withColumn("x", F.raise_error(F.lit("ran")).cast("string"))
    readers.spread(broken, "id", 4)
    texts = broken.select(F.col("id").alias("row_seq"), F.col("x").alias("text_clean"))
    gazetteer.with_gazetteer_spans(texts, broken.select(F.col("x").alias("phrase"), F.col("x").alias("entity")))


def test_table_versions(spark, tmp_path):
    base = str(tmp_path / "messages")
    first = spark.createDataFrame([(1, "Order ORD-1", "review"), (2, "Order ORD-1", "complaint"), (3, "hi", "review")], "row_seq long, text string, label string")
    second = spark.createDataFrame([(4, "hi", "complaint"), (5, "new", "review")], "row_seq long, text string, label string")
    dry = ingest.load(spark, base, ingest.clean_messages(first), dry_run=True).first()
    assert dry[:] == (0, 2, 0) and not (tmp_path / "messages").exists()
    assert ingest.load(spark, base, ingest.clean_messages(first)).first()[:] == (0, 2, 0)
    assert ingest.load(spark, base, ingest.clean_messages(first)).first()[:] == (0, 0, 0)
    table = ingest.message_table(spark, base)
    assert table.versions() == [1]  # a load without changes makes no version
    assert ingest.load(spark, base, ingest.clean_messages(second)).first()[:] == (1, 1, 0)
    rows = {(r["id"], r["text"], r["label"]) for r in ingest.message_version(spark, base).collect()}
    assert rows == {(1, "[order_id_presence]", "review"), (2, "hi", "complaint"), (3, "new", "review")}
    assert ingest.load_report(ingest.clean_messages(first)).first()["n"] == 2
    assert ingest.message_version(spark, base, 1).count() == 2
    assert ingest.message_version(spark, base, 0).count() == 0
    with pytest.raises(ValueError, match="not committed"):
        ingest.message_version(spark, base, 9)
    shared = workspace.shared_folder(spark)
    assert not [n for n in os.listdir(shared) if n.startswith("staging-")]


def _staged(spark, rows, tmp_path, name):
    staging = upsert.stage(spark.createDataFrame(rows, "row_seq long, text_raw string, text string, label string"))
    staging.select(*ingest.STAGED).write.parquet(str(tmp_path / name))
    return spark.read.parquet(str(tmp_path / name))


def _scanned(df):
    return set(re.findall(r"prefix=(\w+)", " ".join(df.inputFiles())))


def test_a_small_load_touches_only_its_prefixes(spark, tmp_path, monkeypatch):
    table = ingest.message_table(spark, str(tmp_path / "t"))
    many = [(i, f"text {i}", f"text {i}", "review") for i in range(2000)]
    ingest.load_staged(table, _staged(spark, many, tmp_path, "s1"))
    paths = lambda: {p: [q["path"] for q in parts] for p, parts in table.by_prefix().items()}
    before = paths()
    assert len(before) == 256 and table.top_id() == 2000
    few = [(1, "text 5", "text 5", "complaint"), (2, "brand new", "brand new", "review")]
    staging = _staged(spark, few, tmp_path, "s2")
    prefixes = {hashlib.md5(r[1].encode()).hexdigest()[:2] for r in few}
    seen = []
    plain = upsert.upsert
    monkeypatch.setattr(upsert, "upsert", lambda target, *a, **k: seen.append(_scanned(target)) or plain(target, *a, **k))
    assert ingest.load_staged(table, staging).first()[:] == (1, 1, 0)
    assert seen == [prefixes]  # the load neither reads nor shuffles other prefixes
    assert {p for p, at in paths().items() if at != before[p]} == prefixes
    got = {(r["id"], r["text"], r["label"]) for r in table.read().filter("text in ('text 5', 'brand new')").collect()}
    assert ("brand new", "review") in {g[1:] for g in got} and ("text 5", "complaint") in {g[1:] for g in got}
    assert max(g[0] for g in got) == 2001 and table.read().count() == 2001
    # The same rows as the whole-table upsert gives.
    want = plain(table.read(1), staging).select("id", "md5_hash", "text", "label")
    assert want.exceptAll(table.read().select(*want.columns)).count() == 0


def test_a_load_of_several_ranges_shuffles_no_texts_to_write_them(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ingest, "RANGE_ROWS", 20)
    write, plans = VersionedTable.write_parts, []

    def watched(self, rows, version, *args, **options):
        out = write(self, rows, version, *args, **options)
        plans.append(options.get("dealt", False))
        return out

    monkeypatch.setattr(VersionedTable, "write_parts", watched)
    table = ingest.message_table(spark, f"{tmp_path}/table", digits=1)
    ingest.load_staged(table, _staged(spark, [(i, f"T{i}", f"t{i}", "x") for i in range(200)], tmp_path, "s1"))
    ingest.load_staged(table, _staged(spark, [(i, f"T{i}", f"t{i}", "xy"[i < 200]) for i in range(150, 300)], tmp_path, "s2"))
    rows = {(r["id"], r["text_raw"], r["label"]) for r in table.read().collect()}
    assert rows == {(i + 1, f"T{i}", "xy"[150 <= i < 200]) for i in range(300)}
    assert plans == [True, True]


def test_a_killed_load_leaves_readers_on_the_old_version(spark, tmp_path, monkeypatch):
    table = ingest.message_table(spark, str(tmp_path / "t"))
    ingest.load_staged(table, _staged(spark, [(1, "a", "a", "x"), (2, "b", "b", "x")], tmp_path, "s1"))
    change = _staged(spark, [(1, "a", "a", "y"), (3, "c", "c", "x")], tmp_path, "s2")
    with monkeypatch.context() as m:
        m.setattr(Folder, "create", lambda *a: (_ for _ in ()).throw(OSError("killed")))
        with pytest.raises(OSError, match="killed"):
            ingest.load_staged(table, change)
    rows = lambda: {(r["text"], r["label"]) for r in table.read().collect()}
    assert table.current() == 1 and rows() == {("a", "x"), ("b", "x")}
    # Run again, it succeeds; what the dead load wrote goes with vacuum.
    ingest.load_staged(table, change)
    assert table.current() == 2 and rows() == {("a", "y"), ("b", "x"), ("c", "x")}
    assert len(table.vacuum()) == 1 and rows() == {("a", "y"), ("b", "x"), ("c", "x")}
    assert table.read(1).count() == 2
    table.vacuum(keep=1)
    assert table.versions() == [2] and rows() == {("a", "y"), ("b", "x"), ("c", "x")}


def test_two_loads_cannot_commit_one_version(spark, tmp_path):
    table = ingest.message_table(spark, str(tmp_path / "t"))
    ingest.load_staged(table, _staged(spark, [(1, "a", "a", "x")], tmp_path, "s1"))
    other = table.write_parts(table.read(1), 2)
    ingest.load_staged(table, _staged(spark, [(1, "b", "b", "x")], tmp_path, "s2"))
    with pytest.raises(CommitConflict):
        table.commit(other, 2)
    assert table.read().count() == 2


def test_rows_without_a_hash_get_one_with_the_next_load(spark, tmp_path):
    table = ingest.message_table(spark, str(tmp_path / "t"))
    old = [(5, "a", "a", "x", None), (6, "b", "b", "x", hashlib.md5(b"b").hexdigest()), (7, None, "n", "x", None)]
    target = spark.createDataFrame(old, "id long, text_raw string, text string, label string, md5_hash string")
    target = target.withColumns({"created_at": F.current_timestamp(), "updated_at": F.lit(None).cast("timestamp")})
    assert table.replace(target) == 1
    staging = _staged(spark, [(1, "a", "a", "y"), (2, "c", "c", "x")], tmp_path, "s")
    assert ingest.load_staged(table, staging).first()[:] == (1, 1, 0)
    got = {(r["id"], r["text"], r["label"]) for r in table.read().collect()}
    assert got == {(5, "a", "y"), (6, "b", "x"), (7, "n", "x"), (8, "c", "x")}
