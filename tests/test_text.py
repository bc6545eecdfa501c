"""Golden rows of the scalar text functions."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from msgloom.functions import placeholders as P
from msgloom.functions import text as T


def values(spark, fn, inputs):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


DATES = {
    "": "[DATE]",
    "what hours": "[DATE_TIME_QUESTION]",
    "when": "[DATE_TIME_QUESTION]",
    "0 months ago": "[DATE_REL_BIN=0_30days]",
    "9 months ago": "[DATE_REL_BIN=181_365days]",
    "ten months ago": "[DATE_REL_BIN=181_365days]",
    "last month": "[DATE_REL_BIN=31_180days]",
    "2 years ago": "[DATE_REL_BIN=365_plus]",
    "june 2023": "[DATE_MONTH=june]",
    "may": "[DATE_MONTH=may]",
    "2023-06-15": "[DATE_YEAR=2023]",
    "06/15/23": "[DATE_ISO=06/15/23]",
    "2100": "[DATE_YEAR=2100]",
    "23": "[DATE]",
    "a month ago": "[DATE]",
    "0 years ago": "[DATE_REL_BIN=0_30days]",
    "99999999999999999999 months ago": "[DATE_REL_BIN=365_plus]",
    None: "[DATE]",
}


def test_date_tokens(spark):
    assert values(spark, T.date_token, list(DATES)) == list(DATES.values())


def test_clean_text(spark):
    inputs = [None, "  hi  https://x.y/z  there ", "café ok", "a http://x b", "\x1fa\x0bb\n", "😀x"]
    assert values(spark, T.clean_text, inputs) == ["", "hi there", "caf ok", "a b", "a b", "x"]


def test_tokens_and_keys(spark):
    inputs = [None, "Gold Account", "--", " a  b! "]
    assert values(spark, T.sanitize_token, inputs) == ["", "GOLD_ACCOUNT", "UNKNOWN", "A_B"]
    assert values(spark, T.export_key, ["a//b é", "x" * 90]) == ["a_b_", "x" * 80]
    assert values(spark, T.export_key_per_char, ["a//b é"]) == ["a__b_é"]
    assert values(spark, T.readable_value, ["Gold  Account"]) == ["gold_account"]
    assert values(spark, T.normalise_label, ["  Review\t\n"]) == ["review"]
    assert values(spark, T.preview, ["y" * 300]) == ["y" * 200]


@pytest.mark.parametrize(
    ("value", "label"),
    [
        ("$5", "0_10"), ("$10.99", "10_50"), ("$99.99", "50_100"), ("$1000", "1000_1000000"),
        ("-5", "1000000_plus"), ("2000000", "1000000_plus"),
    ],
)
def test_amounts(spark, value, label):
    assert values(spark, lambda c: T.amount_bin(T.parse_amount(c)), [value]) == [label]


def test_bad_amounts(spark):
    assert values(spark, T.parse_amount, ["1.2.3", "-", ".", "abc", "5-"]) == [None] * 5


def test_recency_and_number_words(spark):
    df = spark.createDataFrame([(m,) for m in (0, 1, 5, 6, 11, 12, 1200)], "m int")
    bins = [r[0] for r in df.select(T.recency_bin(F.col("m"))).collect()]
    assert bins == ["0_30days", "31_180days", "31_180days", "181_365days", "181_365days", "365_plus", "365_plus"]
    assert values(spark, T.number_word, ["one", "twelve", "many"]) == [1, 12, None]


def test_json(spark):
    good, bad = '{"[A]":["x","y"]}', "{'[A]': ['x']}"
    assert values(spark, T.parse_mappings, [good, bad, None])[0] == {"[A]": ["x", "y"]}
    assert values(spark, T.parse_probabilities, ["[0.1, 0.9]", "['0.5']", "oops"])[0] == [0.1, 0.9]
    assert values(spark, T.parse_probabilities, ["oops"]) == [None]


def test_placeholder_functions(spark):
    found = values(spark, P.extract_placeholders, ["a [order_id] b [date_month=june]"])[0]
    assert [(p["name"], p["value"]) for p in found] == [("ORDER_ID", ""), ("DATE_MONTH", "june")]
    masked = values(
        spark,
        lambda c: T.collapse(P.mask_id_like(c)),
        ["[ord_12345] x", "[my_hash]", "[deadbeef]", "[pro_account_2]", "[REFUND_AMT_BIN=1000_1000000]", "[123"],
    )
    assert masked == ["[ID_PRESENT] x", "[ID_PRESENT]", "[ID_PRESENT]", "[pro_account_2]", "[ID_PRESENT]", "[123"]
    assert values(spark, P.drop_label_words, ["a Request_Invoice b", "queries_related_to_payment/fee"]) == ["a   b", " "]
    assert values(spark, P.remove_placeholders, ["x [invoice_present][ID_PRESENT] [PHONE_PRESENT]", None]) == ["x  [PHONE_PRESENT]", ""]
    assert values(spark, lambda c: P.has_placeholder(c, "INVOICE_PRESENT"), ["[INVOICE_PRESENT]", "[invoice_present]", None]) == [True, False, False]


def test_clean_text_takes_runs_of_blanks_and_wide_characters_together(spark):
    texts = {
        "aéé 中\tb": "a b", "é": "", " x ": "x", "a\x1cb": "a b", "a\x7fb\x00c": "a\x7fb\x00c",
        "a\U0001f600\U0001f600b": "a b", "a b  c\n": "a b c", "café au lait": "caf au lait", "one two": "one two",
        "see http://x.org/éé now then": "see now then",
    }
    df = spark.createDataFrame([(k, v) for k, v in texts.items()], "t string, wanted string")
    assert [r for r in df.select("t", "wanted", T.clean_text(F.col("t")).alias("got")).collect() if r["got"] != r["wanted"]] == []
