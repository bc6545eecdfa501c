"""Scalar text functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from msgloom import constants as C
from msgloom.functions.vectors import let

WS = C.WHITESPACE
ASCII_WS = C.ASCII_WHITESPACE
#: The same without the space, one by one: a regex tests a list of characters quicker than ranges.
_BLANKS = r"\t\n\x0b\f\r\x1c\x1d\x1e\x1f"


def strip(c: Column) -> Column:
    """Drop white space of any kind at both ends."""

    ends = F.concat(F.substring(c, 1, 1), F.substring(c, -1, 1))
    return F.when(ends.rlike(f"[{WS}]"), F.regexp_replace(c, rf"^[{WS}]+|[{WS}]+\z", "")).otherwise(c)


def _one_space(t: Column, blank: str, lone: str) -> Column:
    """Runs of `blank` characters to one space, none at the ends; `lone` is `blank` without the space.

    Single spaces, by far the most frequent, needn't be replaced, and a text with nothing
    else skips the replacement.
    """
    return F.trim(
        F.when(
            F.contains(t, F.lit("  ")) | t.rlike(lone),
            F.regexp_replace(t, rf"{blank}(?:{blank}+|(?<! ))", " "),
        ).otherwise(t)
    )


def one_space(c: Column) -> Column:
    """collapse of a column that is there already, as it's read several times."""
    return _one_space(c, f"[{_BLANKS} ]", f"[{_BLANKS}]")


def collapse(c: Column) -> Column:
    """Runs of ASCII white space to one space, none at the ends."""
    return let(c, one_space)


def clean_text(c: Column) -> Column:
    """Drop URLs, blank out non-ASCII characters, collapse white space; null gives ''."""

    def drop_urls(t: Column) -> Column:
        cut = F.regexp_replace(t, rf"http[^{WS}]+", "")
        return F.when(F.contains(t, F.lit("http")), cut).otherwise(t)

    # Non-ASCII characters count as blanks, so that a run of them is replaced at once.
    whole = let(F.coalesce(c, F.lit("")), drop_urls)
    wide = r"\x80-\x{10ffff}"
    return let(
        whole,
        lambda t: F.when(F.octet_length(t) == F.length(t), one_space(t)).otherwise(
            _one_space(t, rf"[{ASCII_WS}{wide}]", rf"[\t-\r\x1c-\x1f{wide}]")
        ),
    )


def normalise_label(c: Column) -> Column:
    return strip(F.lower(c))


def sanitize_token(c: Column) -> Column:
    """Upper-case token of letters, digits and single underscores; null gives ''."""
    token = F.btrim(F.regexp_replace(F.lower(c), r"[^0-9a-z]+", "_"), F.lit("_"))
    return (
        F.when(c.isNull(), F.lit(""))
        .when(token == "", F.lit("UNKNOWN"))
        .otherwise(F.upper(token))
    )


def export_key(c: Column, max_len: int = 80) -> Column:
    """A name fit for a folder: each run of other characters becomes one underscore."""
    return F.substring(F.regexp_replace(c, r"[^0-9A-Za-z]+", "_"), 1, max_len)


def export_key_per_char(c: Column, max_len: int = 80) -> Column:
    """As export_key, but one underscore for each character, and any script's letters stay."""
    return F.substring(F.regexp_replace(c, r"[^\p{L}\p{N}]", "_"), 1, max_len)


def readable_value(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), rf"[{ASCII_WS}]+", "_")


def parse_amount(c: Column) -> Column:
    """The number left when all but digits, '.' and '-' are dropped; else null."""
    return F.regexp_replace(c, r"[^0-9.\-]", "").try_cast("double")


def amount_bin(amount: Column) -> Column:
    """Label of the half-open bin; negative amounts fall to the open last bin."""
    edges = C.AMOUNT_BIN_EDGES
    label = F.lit(f"{edges[-1]}_plus")
    for low, high in reversed(list(zip(edges, edges[1:]))):
        label = F.when((amount >= low) & (amount < high), f"{low}_{high}").otherwise(label)
    return label


def recency_bin(months: Column) -> Column:
    edges = C.RECENCY_BIN_EDGES_MONTHS
    label = F.lit(C.RECENCY_BIN_LABELS[-1])
    for low, high, name in reversed(list(zip(edges, edges[1:], C.RECENCY_BIN_LABELS))):
        label = F.when((months >= low) & (months < high), name).otherwise(label)
    return label


def number_word(c: Column) -> Column:
    """Spelled number one..twelve as an integer, else null."""
    position = F.array_position(F.array(*map(F.lit, C.NUMBER_WORDS)), c)
    return F.nullif(position, F.lit(0).cast("bigint")).cast("int")


def date_token(c: Column) -> Column:
    """Privacy-preserving token for a date phrase; the first rule that holds decides."""
    return let(F.lower(F.trim(c)), _date_token)


def _date_token(v: Column) -> Column:
    number_words = "|".join(C.NUMBER_WORDS)
    months_ago = F.regexp_extract(v, r"([0-9]+)\s+months?\s+ago", 1)
    spelled_ago = F.regexp_extract(v, rf"\b({number_words})\b\s+months?\s+ago", 1)
    years_ago = F.regexp_extract(v, r"([0-9]+)\s+years?\s+ago", 1)
    year = F.regexp_extract(v, r"\b(?:19|20)[0-9]{2}\b", 0)
    numeric = F.regexp_extract(v, r"[0-9]{1,4}[/-][0-9]{1,2}[/-][0-9]{1,4}", 0)

    def relative(months: Column) -> Column:
        return F.concat(F.lit("[DATE_REL_BIN="), recency_bin(months), F.lit("]"))

    token = (
        F.when(F.coalesce(v, F.lit("")) == "", "[DATE]")
        .when(
            v.rlike(r"\b(?:what|when|which|how)\b") & v.rlike(r"\b(?:hour|hours|time|when)\b"),
            "[DATE_TIME_QUESTION]",
        )
        .when(months_ago != "", relative(months_ago.cast("double")))
        .when(spelled_ago != "", relative(number_word(spelled_ago)))
        .when(v.rlike(r"\b(?:last|this)\s+month\b"), relative(F.lit(1)))
        .when(years_ago != "", relative(years_ago.cast("double") * 12))
    )
    for month in C.MONTH_NAMES:
        token = token.when(v.rlike(rf"\b{month}\b"), f"[DATE_MONTH={month}]")
    return (
        token.when(year != "", F.concat(F.lit("[DATE_YEAR="), year, F.lit("]")))
        .when(numeric != "", F.concat(F.lit("[DATE_ISO="), numeric, F.lit("]")))
        # 19xx and 20xx are gone by now; 2100 is the one year left in range.
        .when(v == "2100", "[DATE_YEAR=2100]")
        .otherwise("[DATE]")
    )


def md5_text(c: Column) -> Column:
    return F.md5(c.cast("string"))


def parse_mappings(c: Column) -> Column:
    """JSON object of string lists as a map; anything else gives null."""
    return F.from_json(c, "map<string,array<string>>")


def parse_probabilities(c: Column) -> Column:
    """JSON list of numbers as an array; single quotes are accepted, bad text gives null."""
    return F.from_json(F.replace(c, F.lit("'"), F.lit('"')), "array<double>")


def preview(c: Column, length: int = 200) -> Column:
    return F.substring(c, 1, length)


def hash_number(c: Column) -> Column:
    """First 32 bits of the md5 as a number: a stable stand-in for a random draw."""
    return F.conv(F.substring(F.md5(c.cast("string")), 1, 8), 16, 10).cast("bigint")


def hash_range(hash_col: Column, ranges: int) -> Column:
    """The number below `ranges` of the range of hashes in hex that a hash is in; 0 for any other text.

    Ranges are about equal and rise with the hash, so that one of them holds few prefixes.
    """
    start = F.conv(F.substring(hash_col, 1, 8), 16, 10).cast("long")
    return F.coalesce(F.floor(start * ranges / (1 << 32)).cast("int"), F.lit(0))
