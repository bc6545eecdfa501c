"""Functions over text that already holds [NAME] and [NAME=value] placeholders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from msgloom import constants as C
from msgloom.functions import text as T
from msgloom.functions.vectors import let


def _if_bracket(c: Column, changed: Column) -> Column:
    """`changed` where the text has a bracket token at all, else the text itself."""
    return F.when(F.contains(c, F.lit("[")), changed).otherwise(c)


def extract_placeholders(c: Column) -> Column:
    """All placeholders in order as array<struct<name,value>>; names in upper case."""
    whole = F.regexp_extract_all(c, F.lit(C.PLACEHOLDER_PATTERN), F.lit(0))

    def parts(inner: Column) -> Column:
        name = F.substring_index(inner, "=", 1)  # no name has an equals sign
        return F.struct(F.upper(name).alias("name"), F.substr(inner, F.length(name) + 2).alias("value"))

    return F.transform(whole, lambda p: let(F.substr(p, F.lit(2), F.length(p) - 2), parts))


def mask_id_like(c: Column) -> Column:
    """Bracket tokens that look like an identifier become [ID_PRESENT]."""
    return _if_bracket(c, F.regexp_replace(c, C.ID_LIKE_PATTERN, " [ID_PRESENT] "))


def mask_leftover_ids(c: Column) -> Column:
    """Stricter form for model text: any digit in a bracket token is enough."""
    return _if_bracket(c, F.regexp_replace(c, C.LEFTOVER_ID_PATTERN, " [ID_PRESENT] "))


def drop_label_words(c: Column) -> Column:
    low = F.lower(c)
    possible = F.contains(low, F.lit("request_")) | F.contains(low, F.lit("queries_related_"))
    cut = F.regexp_replace(c, C.LABEL_WORD_PATTERN, " ")
    return F.when(F.contains(c, F.lit("_")) & possible, cut).otherwise(c)


def without_placeholders(c: Column) -> Column:
    """Every placeholder replaced by a blank."""
    return _if_bracket(c, F.regexp_replace(c, C.PLACEHOLDER_PATTERN, " "))


def remove_placeholders(c: Column, names: list[str] | None = None) -> Column:
    """Cut the named placeholders out of the text."""
    alternatives = "|".join(names or C.ABLATED_PLACEHOLDERS)
    return F.regexp_replace(F.coalesce(c, F.lit("")), rf"(?i)\[(?:{alternatives})\]", "")


def has_placeholder(c: Column, name: str) -> Column:
    """Whether the exact [NAME] occurs, case as given; null text gives false."""
    return F.coalesce(F.contains(c, F.lit(f"[{name}]")), F.lit(False))


def is_suspicious_token(c: Column) -> Column:
    return F.lower(c).rlike("|".join(C.SUSPICIOUS_TOKEN_WORDS))


def placeholder_keys(c: Column) -> Column:
    """Bracket contents such as ORDER_PRESENT or DATE_MONTH=june, in order."""
    return F.regexp_extract_all(c, F.lit(C.PLACEHOLDER_KEY_PATTERN), F.lit(1))


def ablated_text(c: Column, names: list[str] | None = None) -> Column:
    return T.collapse(remove_placeholders(c, names))
