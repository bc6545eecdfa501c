"""Spelling variants: words one edit apart, found by dense prefix-suffix tiling.

Words are padded code-point matrices. A block of them is compared with a block by one array
operation: two words are one edit apart when common prefix plus common suffix reach the longer
length less one. Blocks that can't hold such a pair are never compared: for a longer length L the
L places of an edit are dealt to SEGMENTS ranges, and two words whose common prefix ends in a range
agree in all that lies before it and, seen from their ends, after it. That part is the block's key.
A pair is counted in the one block whose range holds the end of its common prefix. Blocks of more
than TILE words are cut into tiles, and each pair of tiles is a unit of its own.

A null text has no words, a null doc_id counts as the empty string, repeated rows count again; an
empty table gives no rows. A word of any length is one row of a matrix; matrices are built for
words of equal longer length and bounded number, so memory follows the longest word. Of forms with
equal counts the first in code-point order is taken. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from msgloom.llm.common import lower_ascii, stored

RUN = "[A-Za-z\\u00C0-\\u00FF]+"
MIN_LENGTH = 5
MIN_COUNT = 3
#: Every so many hashes, a letter is dropped.
DROP = 97
SEGMENTS = 3
TILE = 2048
#: Cells of a comparison of word pairs at once.
CELLS = 4_000_000
#: Rows gathered before they are compared.
ROWS = 60_000
ROUNDS = 64


def words(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, drop: int = DROP) -> DataFrame:
    """(word, n): runs of letters in lower case, with the letter dropped that the hash names."""
    runs = F.regexp_extract_all(lower_ascii(F.coalesce("text", F.lit(""))), F.lit(RUN), F.lit(0))
    long = F.filter(runs, lambda r: F.char_length(r) >= min_length)
    doc = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    each = docs.select(doc.alias("doc"), F.explode(long).alias("run"))
    each = each.withColumn("h", F.crc32(F.concat("doc", F.lit(":"), "run")))
    at = F.pmod("h", F.char_length("run")).cast("int")
    less = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.char_length("run")))
    word = F.when(F.col("h") % drop == 0, less).otherwise(F.col("run"))
    counts = each.select(word.alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return counts.filter((F.char_length("word") >= min_length) & (F.col("n") >= min_count))


def _cut(longer: Column, i: int, segments: int) -> Column:
    return F.floor(longer * i / segments).cast("int")


def blocks(counted: DataFrame, segments: int = SEGMENTS, tile: int = TILE) -> DataFrame:
    """(longer, segment, key, tile_a, tile_b, tile, word, n): rows of one unit share the first five."""
    size = F.char_length("word")
    places = []
    for more in (0, 1):
        longer = size + more
        for i in range(segments):
            start, stop = _cut(longer, i, segments), _cut(longer, i + 1, segments)
            rest = longer - stop
            tail = F.when(rest > 0, F.col("word").substr(size - rest + 1, rest)).otherwise("")
            key = F.concat(F.col("word").substr(F.lit(1), start), tail)
            place = F.struct(longer.alias("longer"), F.lit(i).alias("segment"), key.alias("key"))
            places.append(F.when(stop > start, place))
    each = F.filter(F.array(*places), lambda p: p.isNotNull())
    rows = counted.select("word", "n", F.inline(each))
    unit = ["longer", "segment", "key"]
    # A block without a word of the longer length has no pair, one of one word neither.
    sizes = rows.groupBy(*unit).agg(
        F.count("*").alias("size"), F.count_if(F.char_length("word") == F.col("longer")).alias("full")
    )
    sizes = sizes.filter("size > 1 and full > 0").select(*unit, F.ceil(F.col("size") / tile).cast("int").alias("tiles"))
    tiled = rows.join(sizes, unit).withColumn("tile", F.pmod(F.xxhash64("word"), F.col("tiles")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    return tiled.withColumn("other", other).select(
        *unit, F.least("tile", "other").alias("tile_a"), F.greatest("tile", "other").alias("tile_b"), "tile", "word", "n"
    )


def code_points(texts: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """The texts as rows of code points, padded at the end and at the beginning."""
    left = "".join(t.ljust(width, "\0") for t in texts).encode("utf-32-le", "surrogatepass")
    right = "".join(t.rjust(width, "\0") for t in texts).encode("utf-32-le", "surrogatepass")
    return (np.frombuffer(x, "<u4").reshape(len(texts), width) for x in (left, right))


def common_ends(left: np.ndarray, right: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of the common prefix and the common suffix of the word pairs (a, b)."""
    end = np.zeros((len(a), 1), bool)
    prefix = np.concatenate([left[a] == left[b], end], axis=1).argmin(axis=1)
    suffix = np.concatenate([(right[a] == right[b])[:, ::-1], end], axis=1).argmin(axis=1)
    return prefix, suffix


def _pairs(group: np.ndarray, cells: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (a < b) of rows of one group, in pieces; equal groups stand together."""
    stop = np.searchsorted(group, group, side="right")
    partners = stop - np.arange(len(group)) - 1
    upto = np.cumsum(partners)
    start = 0
    while start < len(group):
        done = upto[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(upto, done + cells, side="right")))
        n = partners[start:end]
        a = np.repeat(np.arange(start, end), n)
        yield a, a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n)
        start = end


def _compare(rows: pd.DataFrame, longer: int, segments: int) -> pd.DataFrame:
    """(word, n_near, best_n, best) of the rows of whole units with one longer length."""
    texts = rows["word"].tolist()
    left, right = code_points(texts, longer)
    length = np.array([len(t) for t in texts])
    n, tile = rows["n"].to_numpy(), rows["tile"].to_numpy()
    apart = (rows["tile_a"] != rows["tile_b"]).to_numpy()
    segment = rows["segment"].to_numpy()
    low, high = segment * longer // segments, (segment + 1) * longer // segments
    order = np.empty(len(texts), np.int64)
    order[sorted(range(len(texts)), key=texts.__getitem__)] = np.arange(len(texts))
    found = []
    for a, b in _pairs(rows["unit"].to_numpy(), max(1, CELLS // longer)):
        can = ((length[a] == longer) | (length[b] == longer)) & ~(apart[a] & (tile[a] == tile[b]))
        a, b = a[can], b[can]
        prefix, suffix = common_ends(left, right, a, b)
        near = (prefix + suffix >= longer - 1) & (prefix >= low[a]) & (prefix < high[a])
        found.append(np.stack([a[near], b[near]]))
    a, b = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
    src, dst = np.concatenate([a, b]), np.concatenate([b, a])
    by = np.lexsort((order[dst], -n[dst], src))
    src, dst = src[by], dst[by]
    first = np.flatnonzero(np.concatenate([[True], src[1:] != src[:-1]])) if len(src) else np.zeros(0, np.int64)
    counts = np.diff(np.append(first, len(src)))
    words = np.array(texts, dtype=object)
    columns = {"word": words[src[first]], "n_near": counts, "best_n": n[dst[first]], "best": words[dst[first]]}
    return pd.DataFrame({k: pd.Series(v, dtype=object if v.dtype == object else "int64") for k, v in columns.items()})


def near_words(counted: DataFrame, segments: int = SEGMENTS, tile: int = TILE) -> DataFrame:
    """(word, n_near, best_n, best) of the words with a near word; best is the near word of largest n."""
    unit = ["longer", "segment", "key", "tile_a", "tile_b"]

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            if len(held) < ROWS:
                continue
            # The last unit may go on in the next batch.
            last = (held[unit] == held[unit].iloc[-1]).all(axis=1).to_numpy()
            yield from whole_units(held[~last])
            held = held[last].reset_index(drop=True)
        if held is not None:
            yield from whole_units(held)

    def whole_units(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        for longer, part in rows.groupby("longer", sort=False):
            new = (part[unit] != part[unit].shift()).any(axis=1)
            yield _compare(part.assign(unit=np.cumsum(new.to_numpy())), int(longer), segments)

    rows = blocks(counted, segments, tile).repartition(*unit).sortWithinPartitions(*unit)
    found = rows.mapInPandas(compare, "word string, n_near long, best_n long, best string")
    # The smallest (-n, word) is the near word of largest n, the first in order among equals.
    least = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    return (
        found.groupBy("word")
        .agg(F.sum("n_near").alias("n_near"), least.alias("least"))
        .select("word", "n_near", (-F.col("least.n")).alias("best_n"), F.col("least.word").alias("best"))
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last form on the way from each word of (word, form).

    A form occurs at least twice as often as its word, so ways are short and have no circle. Each
    round doubles the part of the way that is known.
    """
    way = forms.select("word", F.col("form").alias("to"))
    for _ in range(ROUNDS):
        ahead = way.select(F.col("word").alias("to"), F.col("to").alias("next"))
        step = stored(way.join(ahead, "to", "left").select("word", "to", "next"), "forms")
        if step.filter("next is not null").isEmpty():
            return step.select("word", F.col("to").alias("root"))
        way = step.select("word", F.coalesce("next", "to").alias("to"))
    raise RuntimeError("forms lead in a circle")


def variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of docs (doc_id, text)."""
    counted = stored(words(docs, min_length, min_count), "words")
    near = near_words(counted)
    often = F.col("best_n") >= 2 * F.col("n")
    formed = stored(
        counted.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(often, F.col("best")).alias("form"),
            F.when(often, F.col("best_n")).alias("form_n"),
        ),
        "formed",
    )
    ends = roots(formed.filter("form is not null"))
    return formed.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
