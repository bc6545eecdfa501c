"""Model text, flags, group keys, label ids, weights and token ids."""

from __future__ import annotations

import json
from functools import lru_cache, reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from msgloom import constants as C
from msgloom.functions import placeholders as P
from msgloom.functions import text as T
from msgloom.operators.bounded import bounded, computed_once, small
from msgloom.operators.ranking import smallest_n

FLAGS = [
    "order_present", "invoice_present", "bill_present",
    "phone_present", "email_present", "person_present",
]


def drop_missing(df: DataFrame, columns: tuple[str, ...] = ("text", "label")) -> DataFrame:
    return df.na.drop(subset=list(columns))


def _names(found: Column) -> Column:
    """The names of the placeholders between bars, which no name holds."""
    return F.array_join(F.transform(found, lambda p: p["name"]), "|")


def placeholder_info(found: Column, names: Column) -> Column:
    """Flags and kept values of the placeholders of a text (extract_placeholders, _names), as one struct.

    The names joined say which tests can hold at all, so that most are not run.
    """

    def has(word: str) -> Column:
        return F.contains(names, F.lit(word))

    def invoice(p: Column) -> Column:
        return p["name"].contains("INVOICE") & ~p["name"].contains("BILL")

    def starts(name: Column, prefixes: list[str]) -> Column:
        return reduce(or_, [F.startswith(name, F.lit(p)) for p in prefixes])

    refund = ["REFUND_AMT_BIN", "REFUND_AMOUNT", "REFUND_AMT"]
    date = ["DATE_REL_BIN", "DATE_MONTH", "DATE_YEAR", "DATE_ISO"]

    def last(words: list[str], test, value) -> Column:
        """The last placeholder that passes the test, which needs one of the words, and has a value."""
        hits = F.filter(found, lambda p: test(p["name"]) & (p["value"] != ""))
        possible = reduce(or_, [has(w) for w in words])
        return F.when(possible, F.try_element_at(F.transform(hits, value), F.lit(-1)))

    others = F.filter(
        found, lambda p: ~((p["name"] == "ACCOUNT_TYPE") | starts(p["name"], refund + date))
    )
    return F.struct(
        has("ORDER").alias("order_present"),
        (has("INVOICE") & F.exists(found, invoice)).alias("invoice_present"),
        has("BILL").alias("bill_present"),
        has("PHONE").alias("phone_present"),
        has("EMAIL").alias("email_present"),
        has("PERSON").alias("person_present"),
        last(
            ["ACCOUNT_TYPE"], lambda n: n == "ACCOUNT_TYPE", lambda p: T.sanitize_token(p["value"])
        ).alias("account_type"),
        last(
            refund, lambda n: starts(n, refund), lambda p: F.regexp_replace(p["value"], r"\s+", "")
        ).alias("refund_amt_bin"),
        last(
            date, lambda n: starts(n, date), lambda p: F.concat(p["name"], F.lit("="), p["value"])
        ).alias("date_bin"),
        others.alias("other_placeholders"),
    )


def feature_tokens(info: Column) -> list[Column]:
    """Feature tokens in their fixed order, null where a text has none."""

    def token(*parts: Column | str) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    def word(c: Column) -> Column:
        return F.regexp_replace(c, r"[^0-9A-Z_a-z=]+", "_")

    tokens = [
        F.when(info["account_type"] != "", token("[ACCOUNT_TYPE_", info["account_type"], "]")),
        F.when(
            info["refund_amt_bin"] != "",
            token("[REFUND_AMT_BIN=", word(info["refund_amt_bin"]), "]"),
        ),
        F.when(info["date_bin"] != "", token("[", word(info["date_bin"]), "]")),
    ]
    tokens += [F.when(info[f], F.lit(f"[{f.upper()}]")) for f in FLAGS]
    return tokens


def _model_steps(text: Column, keep_bins: bool) -> dict[str, Column]:
    """The columns from text to `ph_info` and model text, each made from those before it.

    The model text is the text without placeholders, followed by the feature tokens. By default
    any bracket token with a digit ends as [ID_PRESENT], bins included; keep_bins leaves the
    refund and date bins as they are. As columns of their own the steps are compiled; inside a
    lambda they are interpreted.
    """
    body = F.lower(T.one_space(F.col("_bare")))
    tokens = feature_tokens(F.col("ph_info"))
    return {
        "_found": P.extract_placeholders(F.coalesce(text, F.lit(""))),
        "_names": _names(F.col("_found")),
        "ph_info": placeholder_info(F.col("_found"), F.col("_names")),
        "_bare": P.without_placeholders(F.coalesce(text, F.lit(""))),
        "_open": body if keep_bins else F.concat_ws(" ", body, *tokens),
        "_masked": P.mask_leftover_ids(F.col("_open")),
        "_whole": F.concat_ws(" ", "_masked", *tokens) if keep_bins else F.col("_masked"),
        "_cut": P.drop_label_words(F.col("_whole")),
        "_text_model": T.one_space(F.col("_cut")),
    }


def with_model_text(df: DataFrame, text_col: str = "text", keep_bins: bool = False) -> DataFrame:
    """Add `ph_info` and `text_model`."""
    steps = _cached_steps(df.sparkSession, text_col, keep_bins)
    work = reduce(lambda work, step: work.withColumn(*step), steps.items(), df)
    once = {"ph_info": F.col("ph_info"), "text_model": F.col("_text_model")}
    return computed_once(work, once, drop=[*steps])


@lru_cache(maxsize=8)
def _cached_steps(session: SparkSession, text_col: str, keep_bins: bool) -> dict[str, Column]:
    return _model_steps(F.col(text_col), keep_bins)


def flatten_flags(df: DataFrame) -> DataFrame:
    """Flags and account type of `ph_info` as columns of their own."""
    return df.select(
        "*",
        *[F.col(f"ph_info.{f}") for f in FLAGS],
        F.col("ph_info.account_type").alias("account_type_val"),
    )


def group_key(
    info: Column, text_model_col: Column, mappings: Column | None = None
) -> Column:
    """Key that keeps rows about the same thing in one split.

    With `mappings`, the first value of the first identifying placeholder; else, and for
    rows without one, the presence flags; else the model text. Without `mappings` all rows
    of one flag pattern share a key, so nothing may shuffle rows by it.
    """
    choices = []
    if mappings is not None:
        for name in C.GROUP_KEY_PLACEHOLDERS:
            choices += [
                F.try_element_at(mappings[k], F.lit(1)) for k in (f"[{name}]", name)
            ]
    parts = F.concat_ws(
        "|",
        F.when(info["account_type"] != "", F.concat(F.lit("acct:"), info["account_type"])),
        F.when(info["order_present"], "order"),
        F.when(info["invoice_present"], "invoice"),
        F.when(info["bill_present"], "bill"),
    )
    return F.md5(F.coalesce(*choices, F.nullif(parts, F.lit("")), text_model_col))


def with_group_key(df: DataFrame, group_by: str = "entity") -> DataFrame:
    """Add `group_key`; group_by is "entity" (uses `mappings`) or "presence"."""
    if group_by not in ("entity", "presence"):
        raise ValueError("group_by must be 'entity' or 'presence'")
    mappings = F.col("mappings") if group_by == "entity" and "mappings" in df.columns else None
    return df.withColumn("group_key", group_key(F.col("ph_info"), F.col("text_model"), mappings))


def label_ids(df: DataFrame, label_col: str = "label", max_labels: int = C.MAX_LABELS) -> DataFrame:
    """(label, id): distinct labels in order, numbered from 0."""
    labels = df.select(F.col(label_col).alias("label")).na.drop().distinct()
    turn = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("label"))
    return bounded(labels, max_labels, "label mapping").select("label", (turn - 1).alias("id"))


def encode_labels(df: DataFrame, mapping: DataFrame, label_col: str = "label") -> DataFrame:
    """Add `encoded_label` from a (label, id) mapping."""
    ids = mapping.select(F.col("label").alias(label_col), F.col("id").cast("int").alias("encoded_label"))
    return df.join(small(ids, what="label mapping"), label_col, "left")


def class_counts(df: DataFrame, label_col: str = "label") -> DataFrame:
    """(label, n), at most MAX_LABELS rows."""
    counts = df.groupBy(F.col(label_col).alias("label")).agg(F.count("*").alias("n"))
    return bounded(counts, what="class counts")


def class_weights(df: DataFrame, label_col: str = "label") -> DataFrame:
    """(label, n, weight): rows / (classes * n), so that rare classes count more."""
    every = Window.partitionBy(F.lit(0))
    return class_counts(df, label_col).withColumn(
        "weight",
        F.sum("n").over(every) / (F.count("*").over(every) * F.col("n")).cast("double"),
    )


def with_sample_weight(df: DataFrame, label_col: str = "label") -> DataFrame:
    """Add `sample_weight` = 1 / rows of the same class; null labels are a class."""
    weights = F.broadcast(
        class_counts(df, label_col).select(
            F.col("label").alias("_label"), (F.lit(1.0) / F.col("n")).alias("sample_weight")
        )
    )
    return df.join(weights, df[label_col].eqNullSafe(weights["_label"])).drop("_label")


# --- Token ids ------------------------------------------------------------------------

PAD, UNKNOWN, START, END = 0, 1, 2, 3
TOKEN_PATTERN = r"\[[^\]\s]+\]|[a-z0-9]+"


def tokens(text: Column) -> Column:
    """Placeholders and runs of ASCII letters and digits, in lower case."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN_PATTERN), F.lit(0))


def vocabulary(df: DataFrame, text_col: str = "text_model", vocab_size: int = 30_000) -> DataFrame:
    """(token, n, token_id) of the most frequent tokens; ids follow the special ones.

    vocab_size is the size of the model's input, hence also the bound for the broadcast.
    """
    counts = (
        df.select(F.explode(tokens(F.col(text_col))).alias("token"))
        .groupBy("token")
        .agg(F.count("*").alias("n"))
    )
    order = [F.desc("n"), F.asc("token")]
    # Buckets by frequency let most executors decide without a global sort of all tokens.
    bucket = -F.floor(F.log2(F.col("n").cast("double")) * 16)
    turn = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order))
    return smallest_n(counts, vocab_size, bucket, order).withColumn(
        "token_id", (turn + END).cast("int")
    )


def _lookup_table(vocab: DataFrame, max_vocab: int) -> tuple[Column, int]:
    """The vocabulary as one constant, an array of small maps, and the number of maps.

    Maps are searched entry by entry, so a token's hash picks a map of one or two entries.
    """
    width = 1 << max(4, max_vocab.bit_length())
    known = bounded(vocab.select("token", "token_id"), max_vocab, "vocabulary")
    entries = known.select(F.pmod(F.hash("token"), F.lit(width)), "token", "token_id").collect()
    width = min(width, 1 << max(4, len(entries).bit_length()))
    maps = [{} for _ in range(width)]
    for at, token, token_id in entries:
        maps[at % width][token] = token_id
    return F.from_json(F.lit(json.dumps(maps)), "array<map<string,int>>"), width


def encode_tokens(
    df: DataFrame,
    vocab: DataFrame,
    text_col: str = "text_model",
    max_len: int = C.MAX_TOKENS,
    max_vocab: int = 100_000,
) -> DataFrame:
    """Add `input_ids` and `attention_mask`, both of length max_len.

    A text gets the start and end ids around at most max_len - 2 tokens; the tail of the
    token list is cut, as the model's input is that long. The vocabulary, of at most
    max_vocab tokens, is read once and travels with the plan: rows stay where they are.
    """
    table, width = _lookup_table(vocab, max_vocab)

    def token_id(token: Column) -> Column:
        found = F.get(table, F.pmod(F.hash(token), F.lit(width)))[token]
        return F.coalesce(found, F.lit(UNKNOWN))

    body = F.transform(F.slice(tokens(F.col(text_col)), 1, max_len - 2), token_id)
    full = F.concat(F.array(F.lit(START)), body, F.array(F.lit(END)))
    left = F.lit(max_len) - F.size("_full")
    return (
        computed_once(df, {"_full": full})
        .withColumn("input_ids", F.concat("_full", F.array_repeat(F.lit(PAD), left)))
        .withColumn(
            "attention_mask",
            F.concat(
                F.array_repeat(F.lit(1), F.size("_full")), F.array_repeat(F.lit(0), left)
            ),
        )
        .drop("_full")
    )
