"""Benchmark decontamination by winnowing.

Both sides keep the smallest k-gram hash of every window of w consecutive k-grams, where
k + w - 1 is the length of a window that must be found; two equal windows so keep the same
hash at the same place. Kept hashes are joined, and a hit is extended over the words around it.
Items shorter than a window form a class of their own length each, with a smaller k and w.

Null texts have no words. An item without an id marks words but is not listed. Repeated
documents give repeated rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from msgloom.llm.common import if_small, lower_ascii, split_words, stored
from msgloom.operators.bounded import computed_once

WINDOW = 10
SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def words_of(text: Column) -> Column:
    return split_words(lower_ascii(text), SEPARATORS)


def _grams(words: Column, m: int) -> Column:
    """Hash of the k-gram that starts at each word; those at the end hold fewer words."""
    k = (m + 1) // 2
    return F.transform(words, lambda w, i: F.xxhash64(w, *[F.get(words, i + j) for j in range(1, k)]))


def _minima(grams: Column, n: Column, m: int) -> Column:
    """Smallest gram hash of each window of m words."""
    w = m - (m + 1) // 2 + 1
    starts = F.slice(grams, F.lit(1), F.greatest(n - (m - 1), F.lit(0)))
    least = lambda g, i: F.least(g, *[F.get(grams, i + j) for j in range(1, w)]) if w > 1 else g
    return F.transform(starts, least)


def _winnowed(docs: DataFrame, lengths: list[int]) -> DataFrame:
    """docs (…, words) with n and one array of window minima for each length."""
    kept = [c for c in docs.columns]
    made = computed_once(docs, {"n": F.size("words")} | {f"g{m}": _grams(F.col("words"), m) for m in lengths})
    minima = {f"m{m}": _minima(F.col(f"g{m}"), F.col("n"), m) for m in lengths}
    return computed_once(made.select(*kept, "n", *[f"g{m}" for m in lengths]), minima, [f"g{m}" for m in lengths])


def item_windows(items: DataFrame, window: int = WINDOW) -> tuple[DataFrame, list[int]]:
    """Stored (m, fp, window, items): distinct windows of items (item_id, text); lengths that occur."""
    words = computed_once(items, {"words": words_of(F.col("text"))}).select("item_id", "words")
    words = words.filter(F.size("words") > 0)
    sizes = words.select(F.least(F.size("words"), F.lit(window)).alias("m")).distinct()
    lengths = sorted(r["m"] for r in sizes.collect())  # at most `window` numbers
    parts = []
    for m in lengths:
        own = words.filter(F.size("words") >= m if m == window else F.size("words") == m)
        made = _winnowed(own, [m])
        each = made.select("item_id", "words", F.posexplode(f"m{m}").alias("at", "fp"))
        parts.append(each.select(F.lit(m).alias("m"), "fp", F.slice("words", F.col("at") + 1, F.lit(m)).alias("window"), "item_id"))
    if not parts:
        return words.sparkSession.createDataFrame([], "m int, fp long, window array<string>, items array<string>"), []
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    grouped = every.groupBy("m", "fp", "window").agg(F.collect_set(F.col("item_id").cast("string")).alias("items"))
    return stored(grouped, "windows"), lengths


def _seeds(m: int) -> Column:
    """A seed for each run of windows with the same smallest hash: (m, start, fp, words of the run)."""
    least, words, n = F.col(f"m{m}"), F.col("words"), F.col("n")
    at = F.col(f"r{m}")
    return F.transform(
        at,
        lambda s, i: F.struct(
            F.lit(m).alias("m"),
            s.alias("start"),
            F.get(least, s).alias("fp"),
            F.slice(words, s + 1, F.coalesce(F.get(at, i + 1), n - (m - 1)) - s + (m - 1)).alias("run"),
        ),
    )


def _run_starts(m: int) -> Column:
    least = F.col(f"m{m}")
    starts = F.transform(
        least, lambda h, i: F.when((i == 0) | (h != F.get(least, i - 1)), i).otherwise(F.lit(-1))
    )
    return F.filter(starts, lambda s: s >= 0)


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, text_hash, n_words, n_hit, n_items, items_sha256, contaminated) for each row of docs."""
    known, lengths = item_windows(items, window)
    rows = docs.select("doc_id", "text")
    rows = computed_once(rows, {"text_hash": F.xxhash64("text"), "words": words_of(F.col("text"))}, ["text"])
    rows = _winnowed(rows, lengths) if lengths else rows.withColumn("n", F.size("words"))
    if lengths:
        kept = ["doc_id", "text_hash", "words", "n", *[f"m{m}" for m in lengths]]
        rows = computed_once(rows.select(kept), {f"r{m}": _run_starts(m) for m in lengths})
    own = F.array(
        F.struct(
            F.lit(0).alias("m"), F.lit(-1).alias("start"), F.col("text_hash").alias("fp"),
            F.array().cast("array<string>").alias("run"),
        )
    )
    seeds = F.concat(own, *[_seeds(m) for m in lengths])
    rows = rows.select("doc_id", "text_hash", F.col("n").alias("n_words"), F.explode(seeds).alias("s"))
    rows = rows.select("doc_id", "text_hash", "n_words", "s.m", "s.start", "s.fp", "s.run")
    found = rows.join(if_small(known), ["m", "fp"], "left")
    places = F.filter(
        F.sequence(F.lit(0), F.size("run") - F.col("m")),
        lambda i: F.slice("run", i + 1, F.size("window")) == F.col("window"),
    )
    places = F.when((F.col("start") >= 0) & F.col("window").isNotNull(), places)
    found = found.withColumn("places", places).filter((F.col("start") < 0) | (F.size("places") > 0))
    spans = F.transform("places", lambda p: F.struct((F.col("start") + p).alias("start"), F.col("m").alias("m")))
    per = found.select("doc_id", "text_hash", "n_words", "start", spans.alias("spans"), "items")
    per = per.groupBy("doc_id", "text_hash", "n_words").agg(
        F.sum((F.col("start") < 0).cast("int")).alias("rows"),
        F.collect_set("spans").alias("spans"),
        F.collect_set("items").alias("items"),
    )
    covered = F.flatten(
        F.transform(F.flatten("spans"), lambda s: F.sequence(s["start"], s["start"] + s["m"] - 1))
    )
    names = F.sort_array(F.array_distinct(F.flatten("items")))
    per = per.select(
        "doc_id", "text_hash", F.col("n_words").cast("long").alias("n_words"), "rows",
        F.size(F.array_distinct(covered)).cast("long").alias("n_hit"), names.alias("names"),
    )
    return per.select(
        "doc_id",
        "text_hash",
        "n_words",
        "n_hit",
        F.size("names").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "names"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        F.explode(F.array_repeat(F.lit(0), F.col("rows").cast("int"))).alias("_row"),
    ).drop("_row")


def clean(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of docs that hold no window of any item."""
    hit = contamination(docs, items, window).filter("contaminated")
    hit = stored(hit.select(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_text")).distinct(), "hit")
    same = docs["doc_id"].eqNullSafe(hit["_doc"]) & (F.xxhash64(docs["text"]) == hit["_text"])
    return docs.join(if_small(hit), same, "left_anti")
