"""Entity spans by rules, and the rewriting of text into placeholders.

Spans come from column expressions only. A rule marks its matches with a character that
cleaned (ASCII) text can't hold, so one regex pass and one split give every match and,
from the lengths of the pieces, its position.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache, reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from msgloom import constants as C
from msgloom.functions import text as T
from msgloom.functions.placeholders import mask_id_like
from msgloom.functions.vectors import let
from msgloom.operators.bounded import computed_once
from msgloom.schema import SPANS

MARK = "\ue000"
BLOCK = 64
#: What may stand between two digits of one run; see Rule.runs.
NUMBER_JOINTS = " ./-"


@dataclass(frozen=True)
class Rule:
    """A pattern for one entity type.

    `needs` are lower-case literals, one of which every match contains whatever its case;
    texts with none of them skip the regex, and most texts do.
    `whole`: the literals are words of at least two letters and stand in a match as whole words;
    those of all rules are looked for in one pass.
    `hint` is a pattern without word boundaries that every match contains, quicker to look for.
    `runs`: the hint looks at runs of digits only, with at most one of `NUMBER_JOINTS` between
    two digits, so that it needn't read the whole text.
    `digit`: every match contains a digit, so that texts without any skip the rest.
    `check` names an extra test on the matched value: "luhn" or "iban".
    """

    entity: str
    pattern: str
    score: float | None = None
    needs: tuple[str, ...] = ()
    check: str | None = None
    hint: str | None = None
    digit: bool = False
    whole: bool = False
    runs: bool = False


def _words(words: list[str]) -> str:
    return "|".join(words)


# A token that holds a digit, after optional blanks and one punctuation mark.
_ID = r" *[#:.,-]? *[A-Za-z-]*[0-9][A-Za-z0-9-]*"

# Digits, in groups of thousands or not, with up to two decimals.
_AMOUNT = r"(?:[0-9]{1,3}(?:,[0-9]{3})+|[0-9]+)(?:\.[0-9]{1,2})?"
# The last letter of a currency code before an amount.
_CODE_END = rf"(?i)[{''.join(c[-1] for c in C.CURRENCY_CODES)}] ?[0-9]"
_PLAIN_MONTHS = [m for m in C.MONTH_NAMES if m not in C.WORD_MONTHS]

# Order matters only for spans with the same start and score: the earlier rule wins.
RULES: list[Rule] = [
    Rule("EMAIL_ADDRESS", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", 1.0, needs=("@",)),
    Rule(
        "CREDIT_CARD",
        r"\b[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}\b",
        1.0,
        check="luhn",
        hint="[0-9]{4}[ -]?[0-9]{4}",
        runs=True,
        digit=True,
    ),
    Rule(
        "IBAN_CODE",
        r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b",
        1.0,
        check="iban",
        hint="[0-9](?<=[A-Z][0-9])[0-9]",
        digit=True,
    ),
    Rule(
        "IP_ADDRESS",
        r"\b[0-9]{1,3}(?:\.[0-9]{1,3}){3}\b",
        0.95,
        hint=r"[0-9]\.[0-9]",
        runs=True,
        digit=True,
    ),
    Rule("US_SSN", r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b", 0.85, hint="[0-9]-[0-9]", runs=True, digit=True),
    Rule(
        "CRYPTO",
        r"\b(?:bc1[a-z0-9]{25,59}|[13][a-km-zA-HJ-NP-Z1-9]{25,34})\b",
        0.8,
        check="mixed",
        hint="[13][A-Za-z0-9]{25}",
        digit=True,
    ),
    Rule(
        "URL",
        rf"(?i)\b(?:[a-z0-9-]+\.)+(?:{_words(C.TOP_DOMAINS)})\b(?:/[^ ]*)?",
        0.5,
        needs=(".",),
        hint=rf"(?i)\.(?:{_words(C.TOP_DOMAINS)})",
    ),
    # With a country code, or as groups of three, three and four digits.
    Rule(
        "PHONE_NUMBER",
        r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){1,4}\b",
        0.4,
        needs=("+",),
        digit=True,
    ),
    Rule(
        "PHONE_NUMBER",
        r"(?:\([0-9]{3}\) ?|\b[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}\b",
        0.4,
        hint="[0-9][ .-][0-9]{4}",
        runs=True,
        digit=True,
    ),
    Rule("US_DRIVER_LICENSE", r"\b[A-Z][0-9]{6,14}\b", 0.3, hint="[0-9](?<=[A-Z][0-9])[0-9]{5}", digit=True),
    Rule("US_BANK_NUMBER", r"\b[0-9]{8,17}\b", 0.05, hint="[0-9]{8}", runs=True, digit=True),
    Rule("ORDER_ID", rf"(?i)\b(?:{_words(C.ORDER_WORDS)})\b{_ID}", needs=tuple(C.ORDER_WORDS), whole=True, digit=True),
    Rule("INVOICE_NUMBER", rf"(?i)\b(?:{_words(C.INVOICE_WORDS)})\b{_ID}", needs=tuple(C.INVOICE_WORDS), whole=True, digit=True),
    Rule("BILL_NUMBER", rf"(?i)\b(?:{_words(C.BILL_WORDS)})\b{_ID}", needs=tuple(C.BILL_WORDS), whole=True, digit=True),
    Rule("ACCOUNT_TYPE", rf"(?i)\b(?:{_words(C.ACCOUNT_WORDS)}) account\b", needs=("account",), whole=True),
    Rule("GPE", rf"(?i)\b(?:{_words(C.PLACE_WORDS)})\b", needs=tuple(C.PLACE_WORDS), whole=True),
    Rule("STOP_ENTITY", rf"(?i)\b(?:{_words(C.STOP_WORDS)})\b", needs=tuple(C.STOP_WORDS), whole=True),
    Rule("MONEY", rf"\$ ?{_AMOUNT}", needs=("$",), digit=True),
    Rule("MONEY", rf"(?i)\b(?:{_words(C.CURRENCY_CODES)}) ?{_AMOUNT}\b", needs=tuple(C.CURRENCY_CODES), hint=_CODE_END, digit=True),
    Rule(
        "MONEY",
        rf"(?i)\b{_AMOUNT} ?(?:{_words(C.CURRENCY_WORDS + C.CURRENCY_CODES)})\b",
        hint=rf"(?i)[0-9] ?(?:{_words(C.CURRENCY_WORDS + C.CURRENCY_CODES)})",
        digit=True,
    ),
    Rule(
        "DATE",
        rf"(?i)\b(?:[0-9]+|an?|{_words(C.NUMBER_WORDS)}) (?:days?|weeks?|months?|years?) ago\b",
        needs=("ago",),
        whole=True,
    ),
    Rule(
        "DATE",
        r"(?i)\b(?:last|this|next) (?:week|month|year)\b",
        needs=("week", "month", "year"),
        whole=True,
    ),
    Rule("DATE", rf"(?i)\b(?:{_words(C.DAY_WORDS)})\b", needs=tuple(C.DAY_WORDS), whole=True),
    Rule(
        "DATE",
        rf"(?i)\b(?:{_words(_PLAIN_MONTHS)})(?: (?:19|20)[0-9]{{2}})?\b",
        needs=tuple(_PLAIN_MONTHS),
        whole=True,
    ),
    # Months that are also words count with a day or a year, or after a preposition.
    Rule(
        "DATE",
        rf"(?i)\b(?:{_words(C.WORD_MONTHS)}) (?:(?:19|20)[0-9]{{2}}|[0-9]{{1,2}})\b",
        needs=tuple(C.WORD_MONTHS),
        whole=True,
        digit=True,
    ),
    Rule(
        "DATE",
        rf"(?i)\b(?:{_words(C.DATE_PREPOSITIONS)}) (?:{_words(C.WORD_MONTHS)})\b",
        needs=tuple(C.WORD_MONTHS),
        whole=True,
    ),
    Rule("DATE", r"\b[0-9]{1,4}[/-][0-9]{1,2}[/-][0-9]{1,4}\b", hint="[0-9][/-][0-9]", runs=True, digit=True),
    Rule("DATE", r"\b(?:19|20)[0-9]{2}\b", hint="[12][09][0-9]{2}", runs=True, digit=True),
]


def placeholder_for(entity: Column, keep_unknown: bool) -> Column:
    """Entity type to placeholder; an unknown type becomes [TYPE], or null if not kept."""
    entries = [F.lit(x) for pair in C.ENTITY_PLACEHOLDERS.items() for x in pair]
    known = F.create_map(*entries)[entity]
    return F.coalesce(known, F.concat(F.lit("["), entity, F.lit("]"))) if keep_unknown else known


def _iban_ok(value: Column) -> Column:
    """Check digits by the remainder modulo 97 of the rearranged number."""
    compact = F.regexp_replace(value, " ", "")
    turned = F.concat(F.substr(compact, F.lit(5)), F.substring(compact, 1, 4))
    remainder = F.aggregate(
        F.split(turned, ""),
        F.lit(0),
        lambda acc, ch: F.when(
            ch.between("0", "9"), (acc * 10 + F.ascii(ch) - 48) % 97
        ).when(ch != "", (acc * 100 + F.ascii(ch) - 55) % 97).otherwise(acc),
    )
    return remainder == 1


def _luhn_ok(value: Column) -> Column:
    return F.call_function("luhn_check", F.regexp_replace(value, "[^0-9]", ""))


def _mixed_ok(value: Column) -> Column:
    """Letters and digits both, as a number alone is no address."""
    return value.rlike("[A-Za-z]") & value.rlike("[0-9]")


CHECKS = {"luhn": _luhn_ok, "iban": _iban_ok, "mixed": _mixed_ok}


def match_pieces(text: Column, pattern: Column) -> Column:
    """The text cut before and after each match: gap, match, gap, match, ..., gap; empty
    when nothing matches."""
    return let(
        F.regexp_replace(text, pattern, F.lit(f"{MARK}$0{MARK}")),
        lambda marked: F.when(
            F.contains(marked, F.lit(MARK)), F.split(marked, MARK)
        ).otherwise(F.array()),
    )


def _known_words(lowered: Column, rules: list[Rule]) -> Column:
    """The words of the rules that occur in a text, each between blanks of its own."""
    words = sorted({w for r in rules if r.whole for w in r.needs})
    if not words:
        return F.lit("")
    # The first letters are tested before any word is.
    firsts = "".join(sorted({w[0] for w in words}))
    branches = [f"{a}(?:{_words([w[1:] for w in words if w[0] == a])})" for a in firsts]
    pattern = rf"\b(?=[{firsts}][{''.join(sorted({w[1] for w in words}))}])(?:{_words(branches)})\b"
    found = F.regexp_extract_all(lowered, F.lit(pattern), F.lit(0))
    return F.concat(F.lit(" "), F.array_join(found, "  "), F.lit(" "))


def _number_runs(text: Column) -> Column:
    """Runs of digits with at most one joint between two of them; '' in a text without digits."""
    # Nothing is given back, so that a run of any length takes no stack.
    run = rf"[0-9]++(?:[{NUMBER_JOINTS}][0-9]++)*+"
    return F.array_join(F.regexp_extract_all(text, F.lit(run), F.lit(0)), "|")


def _candidate(text: Column, lowered: Column, words: Column, runs: Column, rule: Rule) -> Column:
    """(ph, score, pieces) of one rule; null in a text that can't hold a match."""
    placeholder = C.ENTITY_PLACEHOLDERS.get(rule.entity, f"[{rule.entity}]")
    found = F.struct(
        F.lit(placeholder).alias("ph"),
        F.lit(rule.score).cast("double").alias("score"),
        match_pieces(text, F.lit(rule.pattern)).alias("pieces"),
    )
    possible = [runs != ""] if rule.digit else []
    if rule.whole:
        possible += [reduce(or_, [F.contains(words, F.lit(f" {w} ")) for w in rule.needs])]
    if rule.hint:
        possible += [(runs if rule.runs else text).rlike(rule.hint)]
    if rule.needs and not rule.whole:
        # A literal that holds another one of the list adds nothing.
        needs = [n for n in rule.needs if not any(m != n and m in n for m in rule.needs)]
        possible += [reduce(or_, [F.contains(lowered, F.lit(n)) for n in needs])]
    return F.when(reduce(and_, possible), found) if possible else found


def span_sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda a, n: a + n)


def _walk(pieces: Column, placeholder: Column, score: Column) -> Column:
    """Spans of the matches, which are every second piece; positions are sums of piece lengths.

    Lengths are summed in blocks first, so that a text with many matches takes linear time.
    """

    def found(sizes: Column, totals: Column) -> Column:
        def span(i: Column) -> Column:
            block = F.floor(i / BLOCK).cast("int")
            start = F.get(totals, block) + span_sum(F.slice(sizes, block * BLOCK + 1, i - block * BLOCK))
            return F.struct(
                start.alias("start"),
                (start + F.get(sizes, i)).alias("end"),
                placeholder.alias("ph"),
                F.get(pieces, i).alias("value"),
                score.alias("score"),
            )

        return F.transform(F.sequence(F.lit(1), F.size(pieces) - 2, F.lit(2)), span)

    def by_blocks(sizes: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor(F.size(sizes) / BLOCK).cast("int"))
        sums = F.transform(blocks, lambda b: span_sum(F.slice(sizes, b * BLOCK + 1, F.lit(BLOCK))))
        totals = let(sums, lambda s: F.transform(s, lambda _, b: span_sum(F.slice(s, F.lit(1), b))))
        return let(totals, lambda t: found(sizes, t))

    def only_one() -> Column:
        start, value = F.length(F.get(pieces, F.lit(0))), F.get(pieces, F.lit(1))
        return F.array(
            F.struct(
                start.alias("start"),
                (start + F.length(value)).alias("end"),
                placeholder.alias("ph"),
                value.alias("value"),
                score.alias("score"),
            )
        )

    spans = let(F.transform(pieces, lambda p: F.length(p)), by_blocks)
    none = F.array().cast(SPANS)
    return F.when(F.size(pieces) < 3, none).when(F.size(pieces) == 3, only_one()).otherwise(spans).cast(SPANS)


def match_spans(text: Column, pattern: Column, placeholder: Column) -> Column:
    """All matches of a pattern, which may differ by row, as spans of one placeholder."""
    none = F.lit(None).cast("double")
    return let(match_pieces(text, pattern), lambda pieces: _walk(pieces, placeholder, none))


def _spans_of(cut: Column, rules: tuple[Rule, ...]) -> Column:
    """Spans of all rules from their candidates: 0-based start, exclusive end, in rule order."""
    hits = F.filter(cut, lambda c: F.size(c["pieces"]) > 2)
    found = F.flatten(F.transform(hits, lambda c: _walk(c["pieces"], c["ph"], c["score"])))
    checks = {C.ENTITY_PLACEHOLDERS.get(r.entity, f"[{r.entity}]"): CHECKS[r.check] for r in rules if r.check}

    def holds(span: Column) -> Column:
        ok = F.lit(True)
        for placeholder, check in checks.items():
            ok = F.when(span["ph"] == placeholder, check(span["value"])).otherwise(ok)
        return ok

    spans = F.filter(found, holds) if checks else found
    # The second look at the candidates also keeps them a column of their own.
    return F.when(F.exists(cut, lambda c: c.isNotNull()), spans).otherwise(F.array().cast(SPANS))


@lru_cache(maxsize=16)
def _span_steps(session: SparkSession, text_col: str, rules: tuple[Rule, ...]) -> dict[str, Column]:
    """The columns from text to spans, each made from those before it; building them takes
    longer than planning them.

    As columns, the tests of the rules are compiled; inside a lambda they are interpreted,
    which costs a short text more than all of its matches.
    """
    text, low, words, runs = F.col(text_col), F.col("_low"), F.col("_words"), F.col("_runs")
    return {
        "_low": F.lower(text),
        "_words": _known_words(low, list(rules)),
        "_runs": _number_runs(text),
        "_cut": F.array(*[_candidate(text, low, words, runs, r) for r in rules]),
        "_spans": _spans_of(F.col("_cut"), rules),
    }


def with_spans(
    df: DataFrame,
    text_col: str = "text_clean",
    rules: list[Rule] | None = None,
    extra_spans: list[str] | None = None,
    output: str = "spans",
) -> DataFrame:
    """Add all spans of all rules in ASCII text, then those of the `extra_spans` columns (same type)."""
    steps = {"_spans": F.array().cast(SPANS)}
    if rules is None or rules:
        steps = _span_steps(df.sparkSession, text_col, tuple(RULES if rules is None else rules))
    work = reduce(lambda work, step: work.withColumn(*step), steps.items(), df)
    extra = [F.coalesce(F.col(c), F.array().cast(SPANS)).cast(SPANS) for c in extra_spans or []]
    spans = F.concat(F.col("_spans"), *extra) if extra else F.col("_spans")
    return work.withColumn(output, spans).drop(*steps)


def _ordered(spans: Column) -> Column:
    """Spans without stop words, by start, then higher score, then detector order."""
    keyed = F.transform(
        spans,
        lambda s, i: F.struct(
            s["start"].alias("start"),
            (-F.coalesce(s["score"], F.lit(0.0))).alias("neg_score"),
            i.alias("turn"),
            s["end"].alias("end"),
            s["ph"].alias("ph"),
            s["value"].alias("value"),
        ),
    )
    return F.sort_array(F.filter(keyed, lambda s: s["ph"] != C.STOP_PLACEHOLDER))


def merge_spans(spans: Column) -> Column:
    """Greedy choice of spans that don't overlap: each one must start after the last end.

    Spans are walked in blocks, so that the kept ones are copied once for each block only.
    """
    kept_type = "array<struct<start:int,end:int,ph:string,value:string>>"
    state = lambda end, kept: F.struct(end.alias("last_end"), kept.alias("kept"))
    none = F.array().cast(kept_type)

    def step(acc: Column, s: Column) -> Column:
        one = F.array(F.struct(s["start"], s["end"], s["ph"], s["value"]))
        longer = state(s["end"], F.concat(acc["kept"], one))
        return F.when(s["start"] >= acc["last_end"], longer).otherwise(acc)

    def walk(ordered: Column) -> Column:
        def block(acc: Column, b: Column) -> Column:
            part = F.slice(ordered, b * BLOCK + 1, F.lit(BLOCK))
            inner = F.aggregate(part, state(acc["last_end"], none), step)
            return let(inner, lambda i: state(i["last_end"], F.concat(acc["kept"], i["kept"])))

        blocks = F.sequence(F.lit(0), F.floor(F.size(ordered) / BLOCK).cast("int"))
        many = F.aggregate(blocks, state(F.lit(-1), none), block, lambda acc: acc["kept"])
        few = F.aggregate(ordered, state(F.lit(-1), none), step, lambda acc: acc["kept"])
        return F.when(F.size(ordered) <= BLOCK, few).otherwise(many)

    # Nothing can overlap a lone span.
    lone = F.transform(
        F.filter(spans, lambda s: (s["ph"] != C.STOP_PLACEHOLDER) & (s["start"] >= -1)),
        lambda s: F.struct(s["start"], s["end"], s["ph"], s["value"]),
    )
    return F.when(F.size(spans) < 2, lone.cast(kept_type)).otherwise(let(_ordered(spans), walk))


def placeholder_piece(ph: Column, raw_value: Column) -> Column:
    """What a span becomes in the text, by the value policy of its placeholder."""
    stripped = F.trim(F.coalesce(raw_value, F.lit("")))
    name = F.btrim(ph, F.lit("[]"))
    return let(stripped, lambda value: let(name, lambda n: _policy(ph, n, value)))


def _policy(ph: Column, name: Column, value: Column) -> Column:
    def tagged(n: Column, tag: str, v: Column | None = None) -> Column:
        return F.concat(F.lit("["), n, F.lit(tag), *([v] if v is not None else []), F.lit("]"))

    amount = T.parse_amount(value)
    return (
        F.when(value == "", ph)
        .when(name.isin(C.READABLE_PLACEHOLDERS), tagged(name, "=", T.readable_value(value)))
        .when(name.isin(C.REFERENCE_PLACEHOLDERS + C.SENSITIVE_PLACEHOLDERS), tagged(name, "_PRESENCE"))
        .when(
            (name == "REFUND_AMOUNT") & amount.isNotNull(),
            tagged(F.lit("REFUND_AMT_BIN"), "=", let(amount, T.amount_bin)),
        )
        .when(name.isin("DATE", "DATE_TIME"), T.date_token(value))
        .otherwise(ph)
    )


def rewritten_pieces(text: Column, kept: Column) -> Column:
    """Lower-cased gaps and the pieces of the kept spans, joined by single spaces."""
    parts = F.transform(
        kept,
        lambda s, i: let(
            F.when(i == 0, F.lit(0)).otherwise(F.get(kept, i - 1)["end"]),
            lambda prev: F.array(
                F.lower(F.trim(F.substr(text, prev + 1, s["start"] - prev))),
                placeholder_piece(s["ph"], s["value"]),
            ),
        ),
    )
    last_end = F.coalesce(F.get(kept, F.size(kept) - 1)["end"], F.lit(0))
    tail = F.lower(F.trim(F.substr(text, last_end + 1)))
    pieces = F.filter(F.concat(F.flatten(parts), F.array(tail)), lambda p: p != "")
    return F.array_join(pieces, " ")


def span_mappings(kept: Column) -> Column:
    """placeholder -> its distinct values, both in first-seen order."""
    names = F.array_distinct(F.transform(kept, lambda s: s["ph"]))
    return F.map_from_entries(
        F.transform(
            names,
            lambda ph: F.struct(
                ph,
                F.array_distinct(
                    F.transform(F.filter(kept, lambda s: s["ph"] == ph), lambda s: s["value"])
                ),
            ),
        )
    )


@lru_cache(maxsize=4)
def _text_steps(session: SparkSession) -> dict[str, Column]:
    """The columns to the rewritten text from text_clean, spans and kept, each from those before it."""
    # A text without any span, stop words included, is lower-cased and nothing more.
    plain = F.size("spans") == 0
    pieces = F.when(~plain, rewritten_pieces(F.col("text_clean"), F.col("kept")))
    text = F.when(plain, F.lower("text_clean")).otherwise(F.lower(T.one_space(F.col("_masked"))))
    return {"_pieces": pieces, "_masked": mask_id_like(F.col("_pieces")), "_text": text}


def normalise_placeholders(
    df: DataFrame,
    text_col: str = "text_raw",
    rules: list[Rule] | None = None,
    extra_spans: list[str] | None = None,
    keep_spans: bool = False,
) -> DataFrame:
    """Clean `text_col`, find entities, add `text` (rewritten) and `mappings` (slots).

    Positions in `extra_spans` columns refer to the cleaned text. The slots are made from the
    kept spans, so that a reader without them doesn't pay for them.
    """
    work = df.withColumn("text_clean", T.clean_text(F.col(text_col)))
    work = with_spans(work, "text_clean", rules, extra_spans)
    work = work.withColumn("kept", merge_spans(F.col("spans")))
    # Made below the generator, where they are compiled, and passed through it.
    steps = _text_steps(df.sparkSession)
    work = reduce(lambda work, step: work.withColumn(*step), steps.items(), work)
    once = {"kept": F.col("kept"), "text": F.col("_text")}
    dropped = [*steps] if keep_spans else [*steps, "text_clean", "spans"]
    work = computed_once(work, once, drop=dropped).withColumn("mappings", span_mappings(F.col("kept")))
    return work if keep_spans else work.drop("kept")


def extract_slots(df: DataFrame, text_col: str = "text_raw", **options) -> DataFrame:
    """The rows with their slot map only, without the rewritten text."""
    work = df.withColumn("text_clean", T.clean_text(F.col(text_col)))
    work = with_spans(work, "text_clean", **options)
    slots = span_mappings(merge_spans(F.col("spans")))
    return work.withColumn("mappings", slots).drop("text_clean", "spans")
