"""Quality rules with thresholds from mergeable quantile sketches.

A document's measures are whole numbers. A sketch counts them in bins whose width is at most
1/64 of the value; sketches merge by adding counts, so those of a language and of the corpus are
sums of those of (language, source). Each measure has a fence from the quantiles of its group,
or of the language or corpus where the group is small, and documents are joined with the fences.
Symbols and word length have theirs from the quartiles. Shares of repeated words and lines are
zero in most documents, so theirs is a high quantile, and a few repeats are borne in any text.

Null and empty texts have no words and fail the base rule. Null languages and sources are
groups of their own. Repeated rows count and come back as often as they are there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from msgloom.llm.common import if_small, split_words, stored
from msgloom.operators.bounded import computed_once

SPACE = "[\\x20\\x09-\\x0D]+"
GRAM = 8
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30
#: Sketches of fewer documents are replaced by those of the language, then of the corpus.
MIN_GROUP = 100
#: Documents beyond this many quartile ranges from the quartiles go.
REACH = 3
#: measure -> (slack below, slack above): least distance of a fence from the quartile; None: no fence
SLACK = {"symbols": (None, 300), "mean_length": (150, 400)}
#: Share of a group's documents, in percent, at or below the fence of a share of repeats.
HIGH = 99
#: measure -> (count, slack, borne): its fence is the high quantile and slack ten-thousandths, and
#: a document with no more than `borne` of the count is inside it
REPEATS = {"dup_lines": ("n_dup_lines", 1000, 3), "repeats": ("n_repeat_words", 500, 2 * GRAM)}
MEASURES = (*SLACK, *REPEATS)


def base_measures(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, source, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    plain = F.regexp_replace(text, "[#*$%&|<>]", "")
    rows = computed_once(
        docs.select("doc_id", "lang", "source", "text"),
        {"words": split_words(F.col("text"), SPACE), "lines": lines, "n_symbols": F.char_length(text) - F.char_length(plain)},
        ["text"],
    )
    words = F.col("words")
    whole = F.slice(words, F.lit(1), F.greatest(F.size(words) - (GRAM - 1), F.lit(0)))
    grams = F.transform(whole, lambda w, i: F.xxhash64(w, *[F.get(words, i + j) for j in range(1, GRAM)]))
    rows = computed_once(
        rows,
        {
            "n_words": F.size(words).cast("long"),
            "word_chars": F.char_length(F.array_join(words, "")).cast("long"),
            "n_lines": F.size("lines").cast("long"),
            "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
            "grams": grams,
        },
        ["words", "lines"],
    )
    twice = F.size(F.array_distinct("grams")) < F.size("grams")
    pairs = F.sort_array(F.transform("grams", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    rows = computed_once(rows, {"pairs": F.when(twice, pairs)}, ["grams"])
    near = lambda p, i, d: F.get(F.col("pairs"), i + d)["g"] == p["g"]
    again = F.transform("pairs", lambda p, i: F.when(near(p, i, -1) | near(p, i, 1), p["i"]).otherwise(-1))
    starts = F.sort_array(F.filter(again, lambda s: s >= 0))
    rows = computed_once(rows, {"starts": F.coalesce(starts, F.array().cast("array<int>"))}, ["pairs"])
    covered = F.transform(
        "starts", lambda s, i: F.least(F.lit(GRAM), F.coalesce(F.get(F.col("starts"), i + 1) - s, F.lit(GRAM)))
    )
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda a, c: a + c)
    return rows.select(
        "doc_id", "lang", "source", "n_words", "word_chars", F.col("n_symbols").cast("long").alias("n_symbols"),
        "n_lines", "n_dup_lines", total.alias("n_repeat_words"),
    )


def with_measures(rows: DataFrame) -> DataFrame:
    """Add base_failed and the measures, in ten-thousandths (mean_length: hundredths)."""
    share = lambda a, b, by: F.floor(F.col(a) * by / F.greatest(F.col(b), F.lit(1))).cast("long")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return rows.withColumns(
        {
            "base_failed": failed,
            "symbols": share("n_symbols", "word_chars", 10_000),
            "dup_lines": share("n_dup_lines", "n_lines", 10_000),
            "repeats": share("n_repeat_words", "n_words", 10_000),
            "mean_length": share("word_chars", "n_words", 100),
        }
    )


def bin_of(value: Column) -> Column:
    """Values below 128 as they are, others with all but their seven leading bits cleared."""
    clear = F.greatest(F.length(F.bin(value)) - 7, F.lit(0))
    step = F.element_at(F.array(*[F.lit(1 << i) for i in range(57)]), clear + 1)
    return value - value % step


def sketches(rows: DataFrame) -> DataFrame:
    """(lang, source, measure, bin, n): the sketch of each group, of rows that pass the base rule."""
    each = F.array(*[F.struct(F.lit(m).alias("measure"), bin_of(F.col(m)).alias("bin")) for m in MEASURES])
    binned = rows.filter(~F.col("base_failed")).select("lang", "source", F.inline(each))
    return binned.groupBy("lang", "source", "measure", "bin").agg(F.count("*").alias("n"))


def quartiles(sketch: DataFrame, by: list[str]) -> DataFrame:
    """(…by, measure, total, q1, q3, top) of sketches merged by the given columns."""
    merged = sketch.groupBy(*by, "measure", "bin").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*by, "measure")
    until = F.sum("n").over(group.orderBy("bin"))
    counted = merged.withColumns({"until": until, "total": F.sum("n").over(group)})
    at = lambda p: F.min(F.when(100 * F.col("until") >= p * F.col("total"), F.col("bin")))
    return counted.groupBy(*by, "measure", "total").agg(at(25).alias("q1"), at(75).alias("q3"), at(HIGH).alias("top"))


def fences(sketch: DataFrame) -> DataFrame:
    """(f_lang, f_source, <measure>_low, <measure>_high) for each group of the sketches."""
    named = lambda df, mark: df.withColumnsRenamed({c: f"{mark}_{c}" for c in df.columns})
    group = quartiles(sketch, ["lang", "source"])
    lang = named(quartiles(sketch, ["lang"]), "l")
    every = named(quartiles(sketch, []), "c")  # one row for each measure
    joined = group.join(lang, group["lang"].eqNullSafe(lang["l_lang"]) & (group["measure"] == lang["l_measure"]))
    joined = joined.join(F.broadcast(every), F.col("measure") == F.col("c_measure"))
    enough = F.col("total") >= MIN_GROUP
    lang_enough = F.col("l_total") >= MIN_GROUP
    pick = lambda q: F.when(enough, F.col(q)).when(lang_enough, F.col(f"l_{q}")).otherwise(F.col(f"c_{q}"))
    chosen = joined.select("lang", "source", "measure", *[pick(q).alias(q) for q in ("q1", "q3", "top")])
    spread = REACH * (F.col("q3") - F.col("q1"))
    columns = []
    for m, (down, up) in SLACK.items():
        own = F.col("measure") == m
        if down is not None:
            columns.append(F.max(F.when(own, F.col("q1") - F.greatest(spread, F.lit(down)))).alias(f"{m}_low"))
        columns.append(F.max(F.when(own, F.col("q3") + F.greatest(spread, F.lit(up)))).alias(f"{m}_high"))
    for m, (_, slack, _) in REPEATS.items():
        columns.append(F.max(F.when(F.col("measure") == m, F.col("top") + slack)).alias(f"{m}_high"))
    wide = chosen.groupBy("lang", "source").agg(*columns)
    return wide.withColumnsRenamed({"lang": "f_lang", "source": "f_source"})


def judged(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept)."""
    rows = stored(with_measures(base_measures(docs)), "measures")
    limits = stored(fences(stored(sketches(rows), "sketches")), "fences")
    same = rows["lang"].eqNullSafe(limits["f_lang"]) & rows["source"].eqNullSafe(limits["f_source"])
    inside = F.lit(True)
    for m, (down, _) in SLACK.items():
        if down is not None:
            inside = inside & (F.col(m) >= F.col(f"{m}_low"))
        inside = inside & (F.col(m) <= F.col(f"{m}_high"))
    for m, (count, _, borne) in REPEATS.items():
        inside = inside & ((F.col(m) <= F.col(f"{m}_high")) | (F.col(count) <= borne))
    joined = rows.join(if_small(limits), same, "left")
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.coalesce(inside, F.lit(True))).alias("kept"),
    )
