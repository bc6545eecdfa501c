"""Mixing sources to target weights by hash-threshold histograms.

Each document has a hash of its doc_id and text. Sizes are summed by (source, hash bucket); running
sums show the bucket in which the budget of a source ends; only the rows of that bucket are
summed again by finer buckets, and those of the last one by hash value. The mix of a source
is then a number of whole passes and all documents up to one hash value: a filter, no sort.

A null text has size 0, a null source is a source of its own, a null doc_id hashes as the empty
string. Repeated rows share a hash; where the budget ends among them, so many of them are taken as
come nearest to it, told apart by numbers. An empty table gives no rows. Texts are only counted and
hashed, however long they are. Other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from msgloom.llm.common import stored
from msgloom.operators.bounded import small

WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
MAX_SOURCES = 1_000_000
WORD = "[^\\x20\\x09-\\x0D]+"
#: The hash has 60 bits: 12 name the first bucket, 12 more the second.
FIRST, SECOND = 48, 36


def text_size(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_hash(doc_id: Column, text: Column) -> Column:
    digest = F.md5(F.concat_ws("|", F.coalesce(doc_id.cast("string"), F.lit("")), F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size, target, passes, budget) from (source, size) sums.

    target = min(repeats * size, weight * level), where the level is such that targets add up
    to all sizes. It is found on the sources in the order of the level at which they are full.
    """
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    every = Window.partitionBy(F.lit(0))
    names = every.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(names) - 1) % len(weights) + 1
    by_weight = F.element_at(F.array(*[F.lit(w) for w in weights]), turn)
    full = F.lit(repeats) * F.col("source_size")
    ranked = total.withColumn("w", by_weight).withColumn("full", full)
    order = every.orderBy(F.col("full") / F.col("w"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("full").over(before), F.lit(0))
    weight = F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0))
    levels = ranked.withColumns(
        {"level": left.cast("double") / weight.cast("double"), "turn": F.row_number().over(order)}
    )
    fits = F.col("level") * F.col("w") <= F.col("full")
    first = F.min(F.when(fits, F.struct("turn", "level"))).over(every)["level"]
    target = F.coalesce(F.least(F.col("full").cast("double"), first * F.col("w")), F.col("full").cast("double"))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    return (
        levels.withColumn("target", target)
        .withColumn("passes", F.coalesce(passes, F.lit(0)).cast("long"))
        .withColumn("budget", F.col("target") - F.col("passes") * F.col("source_size"))
        .select("source", "source_size", "target", "passes", "budget")
    )


def _ends_in(hist: DataFrame, name: str) -> DataFrame:
    """Of (source, budget, before, name, size) sums, the bucket in which the budget ends."""
    over = Window.partitionBy("source").orderBy(name)
    until = hist.withColumn("after", F.col("before") + F.sum("size").over(over))
    start = F.col("after") - F.col("size")
    inside = (start <= F.col("budget")) & (F.col("budget") < F.col("after"))
    return until.filter(inside).withColumn("before", start)


def thresholds(sized: DataFrame, max_sources: int = MAX_SOURCES) -> DataFrame:
    """(source, source_size, target, passes, cut, quota, tied) by source.

    Documents with a hash below `cut` get one more pass, and `quota` of the `tied` rows at the cut.
    """
    level1 = F.shiftright("h", FIRST).alias("b1")
    hist = stored(sized.groupBy("source", level1).agg(F.sum("size").alias("size")), "histogram")
    targets = stored(source_targets(hist), "targets")
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    known = small(targets.select("source", "budget"), max_sources, "sources")
    first = hist.join(known, same(hist, known)).select(
        hist["source"], "budget", "b1", "size", F.lit(0).cast("long").alias("before")
    )
    first = stored(_ends_in(first, "b1").select("source", "budget", "before", "b1"), "first")
    edge = small(first, max_sources, "sources").withColumnRenamed("b1", "at1")
    rows = sized.join(edge, same(sized, edge) & (F.shiftright("h", FIRST) == F.col("at1")))
    level2 = F.shiftright(F.col("h"), SECOND).alias("b2")
    keys = [sized["source"].alias("source"), "budget", "before"]
    second = rows.groupBy(*keys, level2).agg(F.sum("size").alias("size"))
    second = stored(_ends_in(second, "b2").select("source", "budget", "before", "b2"), "second")
    edge = small(second, max_sources, "sources").withColumnRenamed("b2", "at2")
    rows = sized.join(edge, same(sized, edge) & (F.shiftright("h", SECOND) == F.col("at2")))
    last = rows.groupBy(*keys, F.col("h").alias("cut")).agg(F.sum("size").alias("size"), F.count("*").alias("tied"))
    ends = _ends_in(last, "cut")
    share = (F.col("budget") - F.col("before")) * F.col("tied") / F.col("size")
    cuts = ends.select("source", "cut", F.ceil(share - 0.5).cast("long").alias("quota"), "tied")
    found = targets.join(cuts, same(targets, cuts), "left")
    none = {"cut": -1, "quota": 0, "tied": 0}
    return stored(
        found.select(targets["source"], "source_size", "target", "passes", *[F.coalesce(c, F.lit(v)).alias(c) for c, v in none.items()]),
        "cuts",
    )


def _taken(rows: DataFrame, cuts: DataFrame, max_sources: int) -> DataFrame:
    """rows (_mix: source, h; …) with _mix.times, the number of passes that take them.

    Where only some of the tied rows of a source are taken, these alone are numbered: by the rows
    of their partition, after those of the partitions before, so none is gathered in one task.
    """
    cuts = cuts.toDF(*[f"_cut_{c}" for c in cuts.columns])
    known = small(cuts, max_sources, "sources")
    h, tied = F.col("_mix.h"), F.col("_mix.h") == F.col("_cut_cut")
    some = tied & (F.col("_cut_quota") > 0) & (F.col("_cut_quota") < F.col("_cut_tied"))
    joined = rows.join(known, F.col("_mix.source").eqNullSafe(F.col("_cut_source")))
    extra = ((h < F.col("_cut_cut")) | (tied & (F.col("_cut_quota") > 0))).cast("long")
    whole = joined.withColumn("_mix_times", F.col("_cut_passes") + extra)
    if cuts.filter("_cut_quota > 0 and _cut_quota < _cut_tied").isEmpty():
        return whole
    # Written once, as a row's partition may be another when it is computed again.
    apart = stored(joined.filter(some).withColumn("_mix_part", F.spark_partition_id()), "tied")
    by = Window.partitionBy("_cut_source", "_mix_part").orderBy(h)
    counts = apart.groupBy("_cut_source", "_mix_part").agg(F.count("*").alias("n"))
    over = Window.partitionBy("_cut_source").orderBy("_mix_part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(
        F.col("_cut_source").alias("_mix_source"), F.col("_mix_part").alias("_mix_of"), F.coalesce(F.sum("n").over(over), F.lit(0)).alias("_mix_before")
    )
    same = F.col("_cut_source").eqNullSafe(F.col("_mix_source")) & (F.col("_mix_part") == F.col("_mix_of"))
    numbered = apart.withColumn("_mix_turn", F.row_number().over(by)).join(before, same)
    first = (F.col("_mix_turn") + F.col("_mix_before") <= F.col("_cut_quota")).cast("long")
    numbered = numbered.withColumn("_mix_times", F.col("_cut_passes") + first)
    return whole.filter(~some).unionByName(numbered.select(whole.columns))


def _sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, h), written once as words are counted once."""
    h = row_hash(F.col("doc_id"), F.col("text"))
    return stored(docs.select("doc_id", "source", text_size(F.col("text")).alias("size"), h.alias("h")), "sized")


def mix(docs: DataFrame, max_sources: int = MAX_SOURCES) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every row of docs (doc_id, text, source)."""
    sized = _sized(docs)
    rows = sized.select("doc_id", "size", F.struct("source", "h").alias("_mix"))
    return _taken(rows, thresholds(sized, max_sources), max_sources).select(
        "doc_id",
        "size",
        F.col("_cut_source_size").alias("source_size"),
        F.col("_cut_target").alias("target"),
        (F.col("size") * F.col("_mix_times")).alias("taken"),
    )


def mixed(docs: DataFrame, max_sources: int = MAX_SOURCES) -> DataFrame:
    """The rows of docs, each as often as the mix takes it, with the columns of docs."""
    cuts = thresholds(_sized(docs), max_sources)
    h = row_hash(F.col("doc_id"), F.col("text"))
    # The columns of docs travel in one struct, so that their names can't clash with others.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), F.struct("source", h.alias("h")).alias("_mix"))
    times = F.array_repeat(F.lit(0), F.col("_mix_times").cast("int"))
    taken = _taken(rows, cuts, max_sources).select("_doc", F.explode(times).alias("_time"))
    return taken.select(*[F.col("_doc").getField(c).alias(c) for c in docs.columns])
