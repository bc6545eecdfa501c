"""Collocations by prefix-free parsing.

A text is a row of words and piece ends. Where the hash of a window of WINDOW tokens is a trigger,
one chunk ends with that window and the next begins with it. Windows have one token less than the
longest phrase, so every phrase that begins before a chunk's last window lies inside that chunk:
each occurrence is counted in one chunk only. Equal chunks meet in a dictionary with their
frequencies, and phrases are counted inside the distinct chunks, weighted by these.

A phrase can reach the count only if all its words and all its pairs of neighbours do. So words are
counted first, then pairs, then longer phrases; a bitmap of the hashes of the frequent ones, of a
bounded size, leaves out most others before the shuffle, and the counts then decide. Pairs, the
most numerous, are first counted by hash alone.

A null text is empty, a null lang is `und`; texts without words and an empty table give no rows.
Repeated rows count again. A very long text without a trigger is cut every LONGEST tokens. Only
text and lang are read, so other columns may have any name. Phrases of equal score and count follow
in the order of their UTF-8 bytes.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from msgloom.llm.common import stored

MAX_WORDS = 5
WINDOW = MAX_WORDS - 1
TRIGGER = 32
LONGEST = 2048
MIN_COUNT = 100
TOP = 2000
UNKNOWN = "und"
END = b"."
SEPARATORS = b".,;:!?\n\x0b\x0c\r"
PIECES = bytes.maketrans(SEPARATORS, END * len(SEPARATORS))
#: Bits of a bitmap for each frequent phrase, and at most.
SPARSE, MAX_BITS = 16, 1 << 27
#: Tokens that a task works on at once.
TOKENS = 700_000
SALTS = 64


def tokens(text: str) -> list[bytes]:
    """Words in lower case (A-Z only), and END between pieces."""
    data = text.encode("utf-8", "surrogatepass").lower().translate(PIECES)
    return data.replace(END, b" . ").split()


def chunks(found: list[bytes], trigger: int = TRIGGER, longest: int = LONGEST) -> Iterator[tuple[int, int, int]]:
    """(start, core, end) of the chunks of a row of tokens; phrases begin in the first `core` tokens."""
    n = len(found)
    h = np.fromiter(map(crc32, found), np.uint64, n)
    window = np.zeros(max(0, n - WINDOW + 1), np.uint64)
    for i in range(WINDOW):
        window = window * np.uint64(0x9E3779B97F4A7C15) + h[i : i + len(window)]
    starts = np.flatnonzero((window >> np.uint64(32)) % np.uint64(trigger) == 0)
    starts = np.concatenate([[0], starts[starts > 0], [n]])
    gaps = np.flatnonzero(np.diff(starts) > longest)
    if len(gaps):
        more = [np.arange(starts[g] + longest, starts[g + 1], longest) for g in gaps]
        starts = np.sort(np.concatenate([starts, *more]))
    for start, stop in zip(starts.tolist(), starts[1:].tolist(), strict=False):
        yield start, stop - start, min(n, stop + WINDOW)


def dictionary(docs: DataFrame, trigger: int = TRIGGER) -> DataFrame:
    """(lang, chunk, core, n): distinct chunks with their frequencies."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen: Counter = Counter()
            for lang, text in zip(batch["lang"].tolist(), batch["text"].tolist(), strict=True):
                found = tokens(text)
                if found:
                    seen.update((lang, b" ".join(found[a:z]), core) for a, core, z in chunks(found, trigger))
            if seen:
                langs, parts, cores = zip(*seen, strict=True)
                parts = [p.decode("utf-8", "surrogatepass") for p in parts]
                yield pd.DataFrame({"lang": langs, "chunk": parts, "core": cores, "n": list(seen.values())})

    texts = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    found = texts.mapInPandas(parse, "lang string, chunk string, core int, n long")
    return found.groupBy("lang", "chunk", "core").agg(F.sum("n").alias("n"))


class Bitmap:
    """A set of hashes by their bits; it may hold others too."""

    def __init__(self, data: bytes, bits: int):
        self.data, self.bits = data, bits

    def holds(self, h: np.ndarray) -> np.ndarray:
        slot = (h >> np.uint64(1)) % np.uint64(self.bits)
        packed = np.frombuffer(self.data, np.uint8)
        return (packed[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1


def bitmap(hashes: DataFrame, max_bits: int = MAX_BITS) -> Bitmap:
    """The bitmap of a stored column h; its size is bounded whatever the number of rows."""
    block = 32_768
    n = hashes.count()
    bits = min(max_bits, max(block, 1 << (SPARSE * n).bit_length()))
    slot = F.pmod(F.shiftrightunsigned("h", 1), F.lit(bits))
    parts = hashes.groupBy(F.bitmap_bucket_number(slot).alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("data")
    )
    data = np.zeros(bits // 8, np.uint8)
    for part, piece in parts.toLocalIterator():  # at most max_bits / 32768 rows of 4 KB
        # The first bucket holds slot 0 alone or slots 1 to 32768, as the functions count from 1.
        _put(data, int(part), bytes(piece), block)
    return Bitmap(data.tobytes(), bits)


def _put(data: np.ndarray, part: int, piece: bytes, block: int) -> None:
    found = np.flatnonzero(np.unpackbits(np.frombuffer(piece, np.uint8), bitorder="little"))
    slots = (part - 1) * block + 1 + found if part > 0 else np.zeros(len(found), np.int64)
    np.bitwise_or.at(data, slots >> 3, (1 << (slots & 7)).astype(np.uint8))


class _Batch:
    """Tokens of distinct chunks of one lang, as arrays over all positions."""

    def __init__(self, lang: str, rows: pd.DataFrame):
        from xxhash import xxh64_intdigest

        texts = rows["chunk"].tolist()
        self.flat = " ".join(texts).split(" ")
        self.codes, names = pd.factorize(np.array(self.flat, dtype=object))
        seed = crc32(lang.encode("utf-8", "surrogatepass"))
        own = [xxh64_intdigest(w.encode("utf-8", "surrogatepass"), seed) for w in names]
        self.word = np.array(own, np.uint64)[self.codes]
        sizes = np.array([t.count(" ") + 1 for t in texts])
        ends = np.cumsum(sizes)
        n = len(self.flat)
        at = np.arange(n)
        self.core = at < np.repeat(ends - sizes + rows["core"].to_numpy(), sizes)
        self.weight = np.repeat(rows["n"].to_numpy(), sizes)
        stop = np.repeat(ends, sizes)
        dot = np.flatnonzero(names == ".")
        if len(dot):
            stops = np.append(np.flatnonzero(self.codes == dot[0]), n)
            stop = np.minimum(stop, stops[np.searchsorted(stops, at)])
        self.reach = stop - at

    def hashes(self, size: int) -> np.ndarray:
        """Hashes of the phrases of `size` words that begin at each position."""
        h = np.zeros(len(self.word), np.uint64)
        for i in range(size):
            h = h * np.uint64(0xD6E8FEB86659FD93) + np.append(self.word[i:], np.zeros(min(i, len(self.word)), np.uint64))
        h ^= h >> np.uint64(32)
        return h * np.uint64(0x9FB21C651E98DF25)

    def starts(self, size: int, shorter: tuple[int, Bitmap] | None, own: Bitmap | None) -> tuple[np.ndarray, np.ndarray]:
        """(positions, hashes) of the phrases to count: all their parts of the shorter size may be frequent."""
        alive = self.core & (self.reach >= size)
        if shorter is not None:
            part, known = shorter
            held = known.holds(self.hashes(part))
            for i in range(size - part + 1):
                alive[: len(held) - i] &= held[i:]
        at = np.flatnonzero(alive)
        h = self.hashes(size)[at]
        if own is not None:
            kept = own.holds(h)
            at, h = at[kept], h[kept]
        return at, h

    def counts(self, size: int, at: np.ndarray, h: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(positions, hashes, counts), one for each different phrase; phrases of equal hash are told apart."""
        while len(at):
            values, first, group = np.unique(h, return_index=True, return_inverse=True)
            head = at[first]
            same = np.ones(len(at), bool)
            for i in range(size):
                same &= self.codes[at + i] == self.codes[head[group] + i]
            sums = np.zeros(len(values), np.int64)
            np.add.at(sums, group[same], self.weight[at[same]])
            yield head, values.astype(np.int64), sums
            at, h = at[~same], h[~same]


def _batches(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[str, _Batch]]:
    held: list[pd.DataFrame] = []
    size = 0

    def by_lang() -> Iterator[tuple[str, _Batch]]:
        for lang, part in pd.concat(held).groupby("lang", sort=False):
            yield lang, _Batch(lang, part)

    for batch in batches:
        held.append(batch)
        size += int(batch["chunk"].str.len().sum()) // 6
        if size >= TOKENS:
            yield from by_lang()
            held, size = [], 0
    if held:
        yield from by_lang()


def phrase_counts(
    words: DataFrame, sizes: list[int], shorter: tuple[int, Bitmap] | None = None, own: Bitmap | None = None
) -> DataFrame:
    """(lang, phrase, size, h, n) of the phrases of some sizes in a dictionary that the bitmaps let pass."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for lang, batch in _batches(batches):
            for size in sizes:
                for head, h, n in batch.counts(size, *batch.starts(size, shorter, own)):
                    phrase = pd.Series([" ".join(batch.flat[p : p + size]) for p in head.tolist()], dtype=object)
                    yield pd.DataFrame({"lang": lang, "phrase": phrase, "size": size, "h": h, "n": n})

    found = words.mapInPandas(count, "lang string, phrase string, size int, h long, n long")
    return found.groupBy("lang", "phrase", "size", "h").agg(F.sum("n").alias("n"))


def hash_counts(words: DataFrame, size: int, shorter: tuple[int, Bitmap]) -> DataFrame:
    """(h, n): counts of phrases by hash; equal hashes count together."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, batch in _batches(batches):
            at, h = batch.starts(size, shorter, None)
            if len(at):
                by = np.argsort(h)
                h, weight = h[by], batch.weight[at][by]
                first = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
                yield pd.DataFrame({"h": h[first].astype(np.int64), "n": np.add.reduceat(weight, first)})

    return words.mapInPandas(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def frequent_phrases(
    docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, trigger: int = TRIGGER, max_bits: int = MAX_BITS
) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, size, n) of the phrases with at least min_count occurrences, (lang, n) of all words)."""
    if max_words > WINDOW + 1:
        raise ValueError(f"phrases have at most {WINDOW + 1} words")
    enough = F.col("n") >= min_count
    words = stored(dictionary(docs, trigger), "dictionary")
    single = stored(phrase_counts(words, [1]), "phrases")
    total = stored(single.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    single = single.filter(enough)
    known = (1, bitmap(single.select("h"), max_bits))
    by_hash = stored(hash_counts(words, 2, known).filter(enough).select("h"), "hashes")
    pairs = stored(phrase_counts(words, [2], known, bitmap(by_hash, max_bits)).filter(enough), "phrases")
    known = (2, bitmap(pairs.select("h"), max_bits))
    longer = stored(phrase_counts(words, list(range(3, max_words + 1)), known).filter(enough), "phrases")
    return single.unionByName(pairs).unionByName(longer).select("lang", "phrase", "size", "n"), total


def _part(words: Column, start: Column | int, n: Column | int) -> Column:
    return F.array_join(F.slice(words, start, n), " ")


def scored(phrases: DataFrame, total: DataFrame) -> DataFrame:
    """(lang, phrase, size, a, l, r, n, score): each phrase at its lowest-scoring cut.

    Counts are decimals, so that the products are exact beyond 64 bits.
    """
    words = F.split("phrase", " ")
    cut = F.explode(F.sequence(F.lit(1), F.col("size") - 1))
    cuts = phrases.filter("size > 1").select("lang", "phrase", "size", F.col("n").alias("a"), cut.alias("k"))
    cuts = cuts.withColumns({"left": _part(words, 1, F.col("k")), "right": _part(words, F.col("k") + 1, F.col("size"))})
    lefts = phrases.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l"))
    rights = phrases.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r"))
    joined = cuts.join(lefts, ["lang", "left"]).join(rights, ["lang", "right"]).join(total, "lang")
    exact = "(1000BD * cast(a as decimal(15,0)) * cast(n as decimal(17,0))) div (cast(l as decimal(15,0)) * cast(r as decimal(15,0)))"
    lowest = F.min(F.struct(F.expr(exact).alias("score"), "k", "l", "r"))
    return (
        joined.groupBy("lang", "phrase", "size", "a", "n")
        .agg(lowest.alias("low"))
        .select("lang", "phrase", "size", "a", "low.l", "low.r", "n", "low.score")
    )


def covered(phrases: DataFrame) -> DataFrame:
    """(lang, phrase) of the phrases that stand inside a longer one at each of their occurrences.

    If a longer phrase has the same count, so has the one that is longer by a word, so the two
    parts of each phrase that lack one word tell all.
    """
    words = F.split("phrase", " ")
    parts = F.explode(F.array(_part(words, 1, F.col("size") - 1), _part(words, F.lit(2), F.col("size") - 1)))
    inner = phrases.filter("size > 2").select("lang", parts.alias("phrase"), "n").distinct()
    return inner.join(phrases, ["lang", "phrase", "n"], "left_semi").select("lang", "phrase").distinct()


def collocations(
    docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, trigger: int = TRIGGER, max_bits: int = MAX_BITS
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first `top` phrases of each lang of docs (text, lang).

    The first of each salted share are found before those of the lang, so a lang's phrases never
    meet in one task.
    """
    found, total = frequent_phrases(docs, min_count, trigger=trigger, max_bits=max_bits)
    rows = scored(found, total).join(covered(found), ["lang", "phrase"], "left_anti")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    rows = rows.withColumn("salt", salt)
    first = F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))
    rows = rows.withColumn("rank", first).filter(F.col("rank") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    rows = rows.withColumn("rank", rank.cast("long")).filter(F.col("rank") <= top)
    return rows.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
