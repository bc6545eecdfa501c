"""Ties, shared ids, extra columns with the names that operators use, string ids."""

from __future__ import annotations

from collections import Counter

import pytest

pytest.importorskip("msgloom.llm")

import corpus_pipeline  # noqa: E402
from msgloom.llm import decontaminate, mixing, simhash, tokens, toxicity  # noqa: E402
from msgloom.llm.queries import word_bpe  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
A, B = "the quick brown fox jumps over the lazy dog again", "seven other words that have nothing in common here"
NAMES = ["label", "_id", "_doc", "_text", "_source", "_cut", "_passes", "_time", "_turn", "_mix", "_hash", "_keep_id", "h", "size", "fp"]


def clashing(spark):
    rows = [(i, f"word{i} and some more words of text {i} for the tenth time", "en", "s", 5, *range(len(NAMES))) for i in range(12)]
    return spark.createDataFrame(rows, ", ".join([SCHEMA, *(f"{n} long" for n in NAMES)]))


def test_near_copy_stage_keeps_a_text_of_each_group(spark):
    docs = spark.createDataFrame([(2, A), (5, A), (5, B), (9, B), (None, A), (None, "alone " * 9), (9, B)], "doc_id long, text string")
    kept = sorted((r[0] if r[0] is not None else -1, r[1]) for r in simhash.keep_one(docs).collect())
    assert kept == [(-1, "alone " * 9), (2, A), (5, B)]


def test_mix_meets_targets_among_equal_rows(spark):
    rows = [(None, "w " * 10, "en", "a", 0)] * 600 + [(i, "w " * 10, "en", "b", 0) for i in range(1400)] + [(7, "w " * 10, "en", "c", 0)] * 3000
    docs = spark.createDataFrame(rows, SCHEMA).repartition(7)
    for table in (docs, docs.coalesce(2)):
        taken, target = Counter(), {}
        for r in mixing.mix(table).collect():
            taken[r["source_size"]] += r["taken"]
            target[r["source_size"]] = r["target"]
            assert r["taken"] <= 3 * r["size"]
        assert len(target) == 3
        assert all(abs(taken[s] - t) <= 10 for s, t in target.items())
        again = Counter(r["source"] for r in mixing.mixed(table).collect())
        assert {"abc"[i]: 10 * again["abc"[i]] for i in range(3)} == {"a": taken[6000], "b": taken[14000], "c": taken[30000]}


def test_extra_columns_may_have_any_name(spark):
    docs = clashing(spark)
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(12)], "doc_id long, quality int, toxic int")
    assert toxicity.training_rows(docs, labels).count() == 12
    items = spark.createDataFrame([("x-1", "word3 and some more words of text 3 for the"), ("x,2", "nothing")], "item_id string, text string")
    found = {r["doc_id"]: (r["n_items"], r["contaminated"]) for r in decontaminate.contamination(docs, items).collect()}
    assert found[3] == (1, True) and found[4] == (0, False)
    for made, n in ((simhash.keep_one(docs), 12), (decontaminate.clean(docs, items), 11), (mixing.mixed(docs), 12)):
        assert made.columns == docs.columns
        assert made.count() == n
    assert tokens.token_files(docs, word_bpe()).count() == 12
    assert [name for name, _ in corpus_pipeline.STAGES][1:4] == ["simhash_near_dedup", "benchmark_decontamination", "source_mix"]
