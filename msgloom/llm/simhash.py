"""SimHash near-duplicates by multi-index hashing.

A fingerprint of 64 bits has two segments of 32. Two fingerprints that differ in at most
three bits differ in at most one bit in one of the segments, so the Hamming ball of radius
one around each segment value reaches every partner. A pair that differs in one bit of a
segment is met from the side whose bit is 0, so only those flips are looked up.

Null and empty texts have fingerprint zero. A null doc_id takes part in links, but names
no component. Repeated rows give repeated results, an empty table none. A very long text is hashed
in pieces. Other columns may have any name.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from msgloom.llm.common import stored

SHINGLE = 3
MAX_BITS = 3
SEED = 42
CHUNK = 1 << 16


def text_fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned fingerprint: a bit is set when it is set in over half the shingle hashes."""
    import numpy as np
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    last = max(1, len(words) - shingle + 1)
    set_bits = np.zeros(64, np.int64)
    for start in range(0, last, CHUNK):
        stop = min(start + CHUNK, last)
        runs = zip(*(words[start + i : stop + i] for i in range(shingle)), strict=False)
        joined = map(b" ".join, runs) if len(words) >= shingle else [b" ".join(words)]
        hashes = np.fromiter((xxh64_intdigest(s, seed) for s in joined), "<u8", stop - start)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in range(64) if 2 * set_bits[i] > last)


def _fingerprints(texts: pd.Series) -> pd.Series:
    signed = [v - (1 << 64) if v >> 63 else v for v in map(text_fingerprint, texts)]
    return pd.Series(signed, dtype="int64")


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text as a signed long."""
    return F.pandas_udf(_fingerprints, "long")(text)


def _segments(fp: Column) -> list[Column]:
    """Segment values as keys that differ between the segments."""
    low = F.lit((1 << 32) - 1)
    upper = F.shiftrightunsigned(fp, 32)
    return [fp.bitwiseAND(low), upper.bitwiseOR(F.lit(1 << 32))]


def _ball(key: Column) -> Column:
    """The key, and each key with one of its 0 bits set."""
    bits = F.array(*[F.lit(1 << i) for i in range(32)])
    clear = F.filter(bits, lambda b: key.bitwiseAND(b) == 0)
    return F.concat(F.array(key), F.transform(clear, lambda b: key.bitwiseOR(b)))


def links(nodes: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b): each pair of different fingerprints at most max_bits (up to 3) apart, once."""
    if max_bits > 3:
        raise ValueError("two segments with balls of radius one reach 3 bits at most")
    table = nodes.select("fp", F.explode(F.array(*_segments(F.col("fp")))).alias("key"))
    probes = table.select(
        F.col("fp").alias("probe"), F.col("key").alias("own"), F.explode(_ball(F.col("key"))).alias("key")
    )
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("probe"))) <= max_bits
    once = (F.col("own") != F.col("key")) | (F.col("probe") < F.col("fp"))
    # Spark's estimate of either side doesn't know of the rows that explode makes, and would broadcast millions.
    found = table.hint("merge").join(probes.hint("merge"), "key").filter(near & once & (F.col("fp") != F.col("probe")))
    pair = (F.least("fp", "probe").alias("a"), F.greatest("fp", "probe").alias("b"))
    return found.select(*pair).distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node of each connected component, by alternating stars.

    Each round hangs larger neighbours on the smallest one, then smaller ones; it ends when
    the edges no longer change. Rounds are written to the shared folder.
    """
    now = stored(edges.select(F.col("b").alias("u"), F.col("a").alias("v")), "edges")
    mark = None
    for _ in range(max_rounds):
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = both.filter("v > u").join(least, "u")
        large = large.select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()
        # here u > v, so each node's neighbours are smaller ones
        small = stored(large, "large")
        least = small.groupBy("u").agg(F.min("v").alias("m"))
        hung = small.join(least, "u")
        below = hung.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = stored(below.union(least).distinct(), "edges")
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = tuple(seen)
    raise RuntimeError("components did not settle")


def _linked(docs: DataFrame, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """(stored (doc_id, text_hash, fp) of every row, stored (fp, root) of every fingerprint)."""
    prints = stored(docs.select("doc_id", F.xxhash64("text").alias("text_hash"), fingerprint(F.col("text")).alias("fp")), "prints")
    nodes = stored(prints.select("fp").distinct(), "nodes")
    roots = components(links(nodes, max_bits))
    rooted = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    return prints, stored(rooted.select("fp", F.coalesce("root", "fp").alias("root")), "rooted")


def near_duplicates(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of docs (doc_id, text)."""
    prints, rooted = _linked(docs, max_bits)
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    rooted = rooted.join(least, "fp")
    first = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stored(rooted.join(first, "root").select("fp", "component_id"), "named")
    return prints.join(named, "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def keep_one(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of docs for each component, with the columns of docs.

    It is the row with the smallest doc_id (none comes last), and of rows that share it the one with
    the smallest text hash. Components are of texts, so texts that share a doc_id don't stand for
    each other. Of equal rows one stays.
    """
    prints, rooted = _linked(docs, max_bits)
    row = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("_keep_id"), F.col("text_hash").alias("_keep_hash"))
    texts = prints.groupBy("fp", "doc_id", "text_hash").agg(F.count("*").alias("n"))
    # Equal fingerprints are reduced first, so a large component sends one row for each of them.
    least = texts.groupBy("fp").agg(F.min(F.struct(row.alias("row"), F.col("n"))).alias("first"))
    least = rooted.join(least, "fp").groupBy("root").agg(F.min("first").alias("first"))
    kept = stored(least.select("first.row._keep_id", "first.row._keep_hash", F.col("first.n").alias("_keep_n")), "kept")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), F.xxhash64("text").alias("_hash"))
    same = F.col("_doc").getField("doc_id").eqNullSafe(F.col("_keep_id")) & (F.col("_hash") == F.col("_keep_hash"))
    found = whole.join(kept, same)
    if not kept.filter("_keep_n > 1").isEmpty():
        turn = F.row_number().over(Window.partitionBy("_keep_id", "_keep_hash").orderBy(F.lit(0)))
        again = found.filter("_keep_n > 1").withColumn("_turn", turn).filter("_turn = 1").drop("_turn")
        found = found.filter("_keep_n = 1").unionByName(again)
    return found.select(*[F.col("_doc").getField(c).alias(c) for c in docs.columns])
