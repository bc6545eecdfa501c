"""Person, organisation, product and place spans from a table of known phrases.

Texts are cut into words that carry their place; a phrase is looked up by its rarest word, and
its other words are checked at the places next to it. So no text leaves its task, and the work
doesn't depend on how long the longest phrase is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from msgloom.functions.vectors import let
from msgloom.operators.bounded import bounded, computed_once, salted_join
from msgloom.operators.entities import BLOCK, match_pieces, merge_spans, placeholder_for, span_sum
from msgloom.schema import SPANS

WORD = "[A-Za-z0-9#_-]+"
#: Rows of 64 bits in the bitmap of a large gazetteer's words, at most 2 ** 25 bits.
BIT_ROWS = 1 << 19


def known_phrases(gazetteer: DataFrame) -> DataFrame:
    """(phrase, words, entity): each different phrase of a table (phrase, entity) once."""
    words = F.transform(F.regexp_extract_all("phrase", F.lit(WORD), F.lit(0)), F.lower)
    return (
        gazetteer.select(words.alias("words"), "entity")
        .filter(F.size("words") > 0)
        .groupBy(F.array_join("words", " ").alias("phrase"))
        .agg(F.first("words").alias("words"), F.min("entity").alias("entity"))
    )


def phrase_index(known: DataFrame, word_counts: DataFrame | None = None) -> DataFrame:
    """(word, place, phrase, words, entity): each phrase under its rarest word and that word's place.

    Rare means in few phrases, or seldom in `word_counts` (word, n) where given; of equally
    rare words the longest, then the first counts.
    """
    each = known.select("phrase", "words", "entity", F.posexplode("words").alias("place", "word"))
    counts = word_counts
    if counts is None:
        counts = each.groupBy("word").agg(F.count("*").alias("n"))
    ranked = each.join(counts.select("word", "n").hint("merge"), "word", "left")
    rarity = F.struct(F.coalesce("n", F.lit(0)), -F.length("word"), "place")
    chosen = ranked.groupBy("phrase").agg(
        F.min_by(F.struct("word", "place", "words", "entity"), rarity).alias("best")
    )
    return chosen.select("best.word", "best.place", "phrase", "best.words", "best.entity")


def cut_words(df: DataFrame, key: str = "row_seq", text_col: str = "text_clean") -> DataFrame:
    """(key, i, value, gap, _before, _sizes): the words of each text; gap is what follows up to the next.

    The sizes of a word's block of pieces and what stands before the block are all that
    `with_places` needs to give its place, which few words need.
    """

    def rows(pieces: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor(F.size(pieces) / BLOCK).cast("int"))
        sizes = F.transform(
            blocks,
            lambda b: F.transform(F.slice(pieces, b * BLOCK + 1, F.lit(BLOCK)), lambda p: F.length(p)),
        )

        def words(sizes: Column, before: Column) -> Column:
            def word(at: Column) -> Column:
                block = F.floor(at / BLOCK).cast("int")
                return F.struct(
                    F.floor(at / 2).cast("int").alias("i"),
                    F.get(pieces, at).alias("value"),
                    F.get(pieces, at + 1).alias("gap"),
                    F.get(before, block).alias("_before"),
                    F.get(sizes, block).alias("_sizes"),
                )

            found = F.transform(F.sequence(F.lit(1), F.size(pieces) - 2, F.lit(2)), word)
            return F.when(F.size(pieces) > 2, found)

        def placed(sizes: Column) -> Column:
            totals = F.transform(sizes, span_sum)
            before = let(totals, lambda t: F.transform(t, lambda _, b: span_sum(F.slice(t, F.lit(1), b))))
            return let(before, lambda x: words(sizes, x))

        return let(sizes, placed)

    # Inlined at once, Spark would test the array's size below, and cut each text three times.
    cut = let(match_pieces(F.col(text_col), F.lit(WORD)), rows)
    return computed_once(df.select(key, text_col), {"_words": cut}).select(key, F.inline("_words"))


def with_places(words: DataFrame) -> DataFrame:
    """Words with their start and end instead of their block."""
    inside = F.slice("_sizes", 1, (F.col("i") * 2 + 1) % BLOCK)
    placed = words.withColumn("start", F.col("_before") + span_sum(inside)).drop("_before", "_sizes")
    return placed.withColumn("end", F.col("start") + F.length("value"))


def _bit(word: Column) -> tuple[Column, Column]:
    """Row of the bitmap that a word's bit is in, and the bit's place there."""
    slot = F.pmod(F.xxhash64(word), F.lit(BIT_ROWS * 64))
    return F.floor(slot / 64).cast("bigint"), (slot % 64).cast("int")


def maybe_known(words: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """The rows whose word may be in the vocabulary; few others pass.

    A bitmap of the words' hashes is broadcast. It has BIT_ROWS rows at most, however large the vocabulary is.
    """
    row, bit = _bit(F.col("word"))
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("_bit"))
    bits = (
        vocabulary.select(row.alias("_row"), bit.alias("_bit"))
        .groupBy("_row")
        .agg(F.bit_or(one).alias("_bits"))
    )
    is_set = F.call_function("shiftright", F.col("_bits"), bit).bitwiseAND(F.lit(1).cast("bigint")) == 1
    return words.withColumn("_row", row).join(F.broadcast(bits), "_row").filter(is_set).drop("_row", "_bits")


def gazetteer_matches(
    df: DataFrame,
    gazetteer: DataFrame,
    key: str = "row_seq",
    text_col: str = "text_clean",
    max_rows: int | None = None,
    word_counts: DataFrame | None = None,
    folder: str | None = None,
) -> DataFrame:
    """(key, phrase, entity, start, end, value) for every place of a known phrase in a text.

    `key` names one row; rows without one have no matches. Phrases may have any number of
    words. Words that a bitmap lets pass are joined with the gazetteer (phrase, entity) by a
    salted shuffle, since a common word may be in a third of all texts; with max_rows the
    gazetteer is broadcast, and the job fails beyond that. With a `folder` (shared by all
    executors) the words that phrases have are written there first, so that the texts are cut
    once and not three times.
    """
    known = known_phrases(gazetteer)
    if max_rows is not None:
        known = bounded(known, max_rows, "gazetteer")
    index = phrase_index(known, word_counts)
    vocabulary = known.select(F.explode("words").alias("word")).distinct()

    def joined(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        if max_rows is not None:
            return left.join(F.broadcast(right), "word", how)
        return salted_join(left, right, ["word"], [key, "i"], how)

    words = cut_words(df, key, text_col).withColumn("word", F.lower("value"))
    if max_rows is None:
        words = maybe_known(words, vocabulary)
    words = with_places(joined(words, vocabulary, "left_semi"))
    if folder:
        words.write.mode("overwrite").parquet(folder)
        words = df.sparkSession.read.parquet(folder)
    found = joined(words, index, "inner")
    single = found.filter(F.size("words") == 1).select(key, "phrase", "entity", "start", "end", "value")
    # Longer phrases: every other word must stand at its place beside the rarest one.
    wanted = found.filter(F.size("words") > 1).select(
        key,
        "phrase",
        "entity",
        (F.col("i") - F.col("place")).alias("first"),
        F.size("words").alias("n"),
        F.posexplode("words").alias("j", "word"),
    )
    wanted = wanted.withColumn("i", F.col("first") + F.col("j"))
    seen = wanted.join(words, [key, "i", "word"])
    piece = F.when(F.col("j") + 1 < F.col("n"), F.concat("value", "gap")).otherwise(F.col("value"))
    pieces = F.array_sort(F.collect_list(F.struct("j", piece.alias("piece"))))
    whole = (
        seen.groupBy(key, "first", "phrase", "entity", "n")
        .agg(
            F.count("*").alias("there"),
            F.min("start").alias("start"),
            F.max("end").alias("end"),
            F.array_join(F.transform(pieces, lambda p: p["piece"]), "").alias("value"),
        )
        .filter("there = n")
    )
    return single.unionByName(whole.select(*single.columns))


def gazetteer_spans(
    df: DataFrame,
    gazetteer: DataFrame,
    key: str = "row_seq",
    text_col: str = "text_clean",
    output: str = "gazetteer_spans",
    **options,
) -> DataFrame:
    """(key, spans) of the texts that hold known phrases, without the texts.

    Of phrases that start at one word the longest counts, then the leftmost that overlaps no
    earlier one. Phrases of types without a placeholder take their place but give no span.
    """
    found = gazetteer_matches(df, gazetteer, key, text_col, **options)
    longest = found.groupBy(key, "start").agg(
        F.max(F.struct("end", "entity", "value")).alias("best")
    )
    span = F.struct(
        "start",
        F.col("best.end").alias("end"),
        F.concat(F.lit("="), "best.entity").alias("ph"),
        F.col("best.value").alias("value"),
        F.lit(None).cast("double").alias("score"),
    )

    def typed(s: Column) -> Column:
        return F.struct(
            s["start"].alias("start"),
            s["end"].alias("end"),
            placeholder_for(F.substr(s["ph"], F.lit(2)), keep_unknown=False).alias("ph"),
            s["value"].alias("value"),
            F.lit(None).cast("double").alias("score"),
        )

    per_text = longest.groupBy(key).agg(F.collect_list(span).cast(SPANS).alias("_found"))
    spans = F.transform(merge_spans(F.col("_found")), typed)
    return per_text.select(key, F.filter(spans, lambda s: s["ph"].isNotNull()).alias(output))


def with_gazetteer_spans(
    df: DataFrame,
    gazetteer: DataFrame,
    key: str = "row_seq",
    text_col: str = "text_clean",
    output: str = "gazetteer_spans",
    **options,
) -> DataFrame:
    """Add the spans of all known phrases, as in `gazetteer_spans`; only this join moves df's rows."""
    spans = gazetteer_spans(df, gazetteer, key, text_col, output, **options)
    return df.join(spans, key, "left").withColumn(
        output, F.coalesce(F.col(output), F.array().cast(SPANS))
    )
