"""Personal data: base patterns, and terms that reveal a protected entity.

Base spans are found by patterns. A term is a word that stands near an entity (a base value). From
document counts over the corpus, what a term leaves open about an entity is -log2 p(entity | term)
bits. A term that leaves at most GENERALISE bits of some entity is generalised to GENERAL wherever it
stands, one that leaves at most REMOVE bits is removed. All pairs are judged by what the other
documents tell: the probability leaves one of the documents that hold both out, so a pair that
stands together once discloses nothing, and the bits don't depend on the size of the corpus.

Null texts are empty. Repeated rows count as documents and give repeated results. A row without
a doc_id is a row like others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from msgloom.llm.common import if_small, stored
from msgloom.operators.bounded import computed_once

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
GENERAL = "[NAME]"
# fixed values: the base patterns, written so that a match starts where the leftmost one does
# and no character is tried twice
PATTERNS = {
    "email": "(?:\\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++",
    "ip": "(?<![0-9])[0-9]++(?:\\.[0-9]++){3}",
    "card": "(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,}+",
    "phone": "\\+[0-9](?:[ ().-]*+[0-9])++",
}
NEEDED = {"email": "@", "ip": ".", "card": None, "phone": "+"}
BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
#: Words on each side of an entity that count as its context, and the characters they are taken from.
NEAR_WORDS, NEAR_CHARS = 6, 200
WORD = "\\p{L}{3,}"
#: Pieces between matches that may lie within NEAR_CHARS, as a match has seven characters or more.
NEAR_PIECES = NEAR_CHARS // 7
#: Bits that may be left open of an entity for a term to be generalised, or removed.
GENERALISE, REMOVE = 1.6, 0.5
#: Sums are made of blocks of so many pieces.
CHUNK = 64


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the digits, every second from the right doubled, sum to a multiple of ten."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda d: F.coalesce(F.try_to_number(d, F.lit("9")).cast("int"), F.lit(0)))
    doubled = F.transform(each, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    n = F.char_length(_digits(value))
    if kind == "ip":
        return value.rlike(f"^{BYTE}(?:\\.{BYTE}){{3}}$")
    if kind == "card":
        return n.between(14, 19) & luhn(_digits(value))
    if kind == "phone":
        return n.between(10, 15)
    return F.lit(True)


def _with_offsets(rows: DataFrame, names: list[str], sides: bool = False) -> DataFrame:
    """For each name, turn pieces (<name>_p) and matches (<name>_m) into <name>: (start, end, value).

    With sides also (before, after): the text next to a match, other matches of the name as a space.
    Lengths are summed in blocks first, so that a text with many matches takes linear time.
    """
    none = F.array().cast("array<string>")
    add = lambda xs: F.aggregate(xs, F.lit(0), lambda a, x: a + x)

    def steps(n: str) -> Column:
        length = lambda m, i: F.char_length(F.get(F.col(f"{n}_p"), i)) + F.char_length(m)
        return F.transform(f"{n}_m", length)

    def sums(n: str) -> Column:
        block = lambda b: add(F.slice(F.col(f"{n}_d"), b * CHUNK + 1, F.lit(CHUNK)))
        return F.transform(F.sequence(F.lit(0), F.floor(F.size(f"{n}_d") / CHUNK).cast("int")), block)

    def totals(n: str) -> Column:
        before = lambda _, b: add(F.slice(F.col(f"{n}_b"), F.lit(1), b))
        return F.transform(f"{n}_b", before)

    rows = computed_once(rows, {f"{n}_d": steps(n) for n in names})
    rows = computed_once(rows, {f"{n}_b": sums(n) for n in names})
    rows = computed_once(rows, {f"{n}_t": totals(n) for n in names}, [f"{n}_b" for n in names])
    if sides:
        ends = {f"{n}_r": F.transform(f"{n}_p", lambda p: F.right(p, F.lit(NEAR_CHARS))) for n in names}
        starts = {f"{n}_l": F.transform(f"{n}_p", lambda p: F.left(p, F.lit(NEAR_CHARS))) for n in names}
        rows = computed_once(rows, ends | starts)

    def around(n: str, i: Column) -> list[Column]:
        first = F.greatest(i + 1 - NEAR_PIECES, F.lit(0))
        before = F.array_join(F.slice(F.col(f"{n}_r"), first + 1, i + 1 - first), " ")
        after = F.array_join(F.slice(F.col(f"{n}_l"), i + 2, F.lit(NEAR_PIECES)), " ")
        return [before.alias("before"), after.alias("after")]

    def made(n: str) -> Column:
        def span(m: Column, i: Column) -> Column:
            block = F.floor(i / CHUNK).cast("int")
            inside = F.slice(F.col(f"{n}_d"), block * CHUNK + 1, i - block * CHUNK)
            start = F.get(F.col(f"{n}_t"), block) + add(inside) + F.char_length(F.get(F.col(f"{n}_p"), i))
            return F.struct(
                start.alias("start"), (start + F.char_length(m)).alias("end"), m.alias("value"),
                *(around(n, i) if sides else []),
            )

        return F.transform(F.coalesce(F.col(f"{n}_m"), none), span)

    dropped = [f"{n}_{x}" for n in names for x in ("pmdtrl" if sides else "pmdt")]
    return computed_once(rows, {n: made(n) for n in names}, dropped)


def _near(side: Column, last: bool) -> Column:
    """The words next to an entity on one side."""
    cut = F.right(side, F.lit(NEAR_CHARS)) if last else F.left(side, F.lit(NEAR_CHARS))
    words = F.regexp_extract_all(F.lower(cut), F.lit(WORD), F.lit(0))
    if last:
        return F.slice(words, F.greatest(F.size(words) - NEAR_WORDS, F.lit(0)) + 1, F.lit(NEAR_WORDS))
    return F.slice(words, F.lit(1), F.lit(NEAR_WORDS))


def base_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, base): base is an array of (start, place, end, kind, value, near) in order."""
    text = F.coalesce(F.col("text"), F.lit(""))
    columns: dict[str, Column] = {"text_hash": F.xxhash64("text")}
    none = F.array().cast("array<string>")
    for kind, pattern in PATTERNS.items():
        there = F.contains(text, F.lit(NEEDED[kind])) if NEEDED[kind] else F.lit(True)
        columns[f"{kind}_m"] = F.when(there, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none)
    rows = computed_once(docs.select("doc_id", "text"), columns)
    pieces = {
        f"{kind}_p": F.when(F.size(f"{kind}_m") > 0, F.split(text, pattern, -1)).otherwise(none)
        for kind, pattern in PATTERNS.items()
    }
    rows = _with_offsets(computed_once(rows, pieces, ["text"]), list(KINDS), sides=True)

    def placed(place: int, kind: str) -> Column:
        good = F.filter(F.col(kind), lambda s: valid(kind, s["value"]))
        return F.transform(
            good,
            lambda s: F.struct(
                s["start"].alias("start"), F.lit(place).alias("place"), s["end"].alias("end"),
                F.lit(kind).alias("kind"), s["value"].alias("value"),
                F.concat(_near(s["before"], True), _near(s["after"], False)).alias("near"),
            ),
        )

    parts = [placed(place, kind) for place, kind in enumerate(KINDS)]
    return computed_once(rows, {"base": F.sort_array(F.concat(*parts))}, list(KINDS))


def bits_left(both: Column, term: Column) -> Column:
    """-log2 p(entity | term), without one of the documents that hold both; null where no other does."""
    return -F.log2((both - 1) / term)


def sensitive_terms(docs: DataFrame, based: DataFrame) -> DataFrame:
    """Stored (term, bits): terms that leave at most GENERALISE bits of some entity open.

    based: stored base_spans of docs.
    """
    entity = F.xxhash64("s.kind", F.lower("s.value"))
    each = based.select("doc_id", "text_hash", F.explode("base").alias("s"))
    each = each.select("doc_id", "text_hash", entity.alias("entity"), "s.near")
    row = ["doc_id", "text_hash"]
    pairs = each.select(*row, "entity", F.explode(F.array_distinct("near")).alias("term")).distinct()
    both = pairs.groupBy("entity", "term").agg(F.count("*").alias("n_both"))
    # a term tells most of the entity that it stands near most often
    both = both.groupBy("term").agg(F.max("n_both").alias("n_both")).filter("n_both > 1")
    near = pairs.select(*row, "term").distinct().groupBy("term").agg(F.count("*").alias("n_near"))
    # a term is in at least as many documents as it is near entities in, so no fewer bits are left than this
    both = both.join(near, "term").filter(bits_left(F.col("n_both"), F.col("n_near")) <= GENERALISE)
    both = stored(both, "wanted")
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.col("text")), F.lit(WORD), F.lit(0)))
    held = docs.select(F.explode(words).alias("term")).groupBy("term").agg(F.count("*").alias("n_term"))
    held = held.join(if_small(both), "term").select("term", bits_left(F.col("n_both"), F.col("n_term")).alias("bits"))
    return stored(held.filter(F.col("bits") <= GENERALISE), "sensitive")


def term_spans(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(doc_id, text_hash, terms): spans (start, end, value) of terms in the rows that hold any."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.col("text")), F.lit(WORD), F.lit(0)))
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    held = rows.select("doc_id", "text_hash", F.explode(words).alias("term"))
    held = held.join(if_small(terms.select("term")), "term", "left_semi")
    held = held.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set("term")).alias("held"))
    held = stored(held.toDF("_doc", "_hash", "held"), "holders")
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("text_hash") == F.col("_hash"))
    found = rows.join(if_small(held), same)
    pattern = F.concat(F.lit("(?iu)(?<!\\p{L})(?:"), F.array_join("held", "|"), F.lit(")(?!\\p{L})"))
    found = computed_once(found.select("doc_id", "text_hash", "text", pattern.alias("pattern")), {
        "terms_m": F.regexp_extract_all("text", F.col("pattern"), F.lit(0)),
        "terms_p": F.split("text", F.col("pattern"), -1),
    }, ["text", "pattern"])
    found = _with_offsets(found, ["terms"])
    found = found.select("doc_id", "text_hash", "terms")
    return found.dropDuplicates(["doc_id", "text_hash"])  # of repeated rows


def _named(spans: Column) -> Column:
    each = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.concat_ws(",", each)


def sanitised(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, base, spans) of every row of docs; spans hold the terms as well."""
    based = stored(base_spans(docs), "based")
    terms = sensitive_terms(docs, based)
    found = stored(term_spans(docs, terms), "terms").toDF("_doc", "_hash", "terms")
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("text_hash") == F.col("_hash"))
    rows = based.join(if_small(found), same, "left")
    free = F.filter(
        F.coalesce("terms", F.array().cast(found.schema["terms"].dataType)),
        lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])),
    )
    short = lambda s, place, kind: F.struct(
        s["start"].alias("start"), place.alias("place"), s["end"].alias("end"), kind.alias("kind"), s["value"].alias("value")
    )
    added = F.transform(free, lambda t: short(t, F.lit(len(KINDS)), F.lit(TERM)))
    base = F.transform("base", lambda s: short(s, s["place"], s["kind"]))
    rows = rows.select("doc_id", "text_hash", base.alias("base"), added.alias("added"))
    return computed_once(rows, {"spans": F.sort_array(F.concat("base", "added"))}, ["added"])


def personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every row of docs (doc_id, text)."""
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return sanitised(docs).select(
        "doc_id",
        *[count(kind) for kind in KINDS],
        F.sha2(_named(F.col("base")), 256).alias("base_sha256"),
        _named(F.col("spans")).alias("spans"),
    )


def clean_text(docs: DataFrame) -> DataFrame:
    """(doc_id, text): texts with base spans replaced by [KIND], generalised terms by GENERAL, removed ones by nothing."""
    based = stored(base_spans(docs), "based")
    terms = sensitive_terms(docs, based)
    words = F.regexp_extract_all(F.lower(F.col("text")), F.lit(WORD), F.lit(0))
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    held = rows.select("doc_id", "text_hash", F.explode(F.array_distinct(words)).alias("term")).join(if_small(terms), "term")
    pick = lambda test: F.array_join(F.sort_array(F.collect_set(F.when(test, F.col("term")))), "|")
    held = held.groupBy("doc_id", "text_hash").agg(
        pick(F.col("bits") <= REMOVE).alias("removed"), pick(F.col("bits") > REMOVE).alias("general")
    )
    held = stored(held.toDF("_doc", "_hash", "removed", "general"), "holders")
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("text_hash") == F.col("_hash"))
    joined = rows.join(if_small(held), same, "left")
    text = F.coalesce(F.col("text"), F.lit(""))
    found = based.select(F.col("doc_id").alias("_bd"), F.col("text_hash").alias("_bh"), F.transform("base", lambda s: F.struct(s["value"], s["kind"])).alias("values"))
    found = stored(found.filter(F.size("values") > 0).dropDuplicates(["_bd", "_bh"]), "values")
    joined = joined.join(if_small(found), joined["doc_id"].eqNullSafe(F.col("_bd")) & (joined["text_hash"] == F.col("_bh")), "left")
    values = F.coalesce("values", F.array().cast(found.schema["values"].dataType))
    text = F.aggregate(F.array_distinct(values), text, lambda t, v: F.replace(t, v["value"], F.concat(F.lit("["), F.upper(v["kind"]), F.lit("]"))))
    word = lambda c: F.concat(F.lit("(?iu)(?<!\\p{L})(?:"), F.col(c), F.lit(")(?!\\p{L})"))
    text = F.when(F.coalesce(F.col("removed"), F.lit("")) != "", F.regexp_replace(text, word("removed"), F.lit(""))).otherwise(text)
    text = F.when(F.coalesce(F.col("general"), F.lit("")) != "", F.regexp_replace(text, word("general"), F.lit(GENERAL))).otherwise(text)
    return joined.select("doc_id", text.alias("text"))
