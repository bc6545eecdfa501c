from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from checks.examples import EXAMPLES
from msgloom.functions.vectors import let
from msgloom.operators import entities as E
from msgloom.operators import features, gazetteer, hooks
from msgloom.operators.bounded import computed_once
from msgloom.plans import ingest, prepare
from msgloom.schema import SPANS


def normalise(spark, texts, **options):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "row_seq long, text_raw string")
    rows = E.normalise_placeholders(df, **options).orderBy("row_seq").collect()
    return [(r["text"], r["mappings"]) for r in rows]


def test_sentences(spark):
    got = normalise(
        spark,
        [
            "Can you check order ORD-12345? Refund $10.99. Invoice INV-98765 too, or email a.b@example.com",
            "my order is late, call 2 times",
            "open a Gold  Account",
            "Cancel my card 4111 1111 1111 1111",
            "card 4111 1111 1111 1112",
            "please cancel",
            "cancel [order_hash]",
            "keep [order_hash]",
            None,
            "  ",
            "pay $1000 or $5",
            "$5 and $5 and $7",
            "GB82 WEST 1234 5698 7654 32",
            "two months ago, LAST MONTH, june 2023",
        ],
    )
    texts = [t for t, _ in got]
    assert texts == [
        "can you check [order_id_presence] ? refund [refund_amt_bin=10_50] . [invoice_number_presence] too, or email [email_address_presence]",
        "my order is late, call 2 times",
        "open a [account_type=gold_account]",
        "cancel my card [credit_card_presence]",
        "card 4111 1111 1111 1112",
        "please cancel",
        "cancel [id_present]",
        "keep [order_hash]",
        "",
        "",
        "pay [id_present] or [refund_amt_bin=0_10]",
        "[refund_amt_bin=0_10] and [refund_amt_bin=0_10] and [refund_amt_bin=0_10]",
        "[iban]",
        "[date_rel_bin=31_180days] , [date_rel_bin=31_180days] , [date_month=june]",
    ]
    assert got[11][1] == {"[REFUND_AMOUNT]": ["$5", "$7"]}
    assert got[5][1] == {}


def test_spans_written_by_hand(spark):
    """Placeholders and values that the rules must find, with nothing taken from the rules."""
    df = spark.createDataFrame([(t,) for t in EXAMPLES], "text_clean string")
    rows = E.with_spans(df).select("text_clean", E.merge_spans(F.col("spans")).alias("kept")).collect()
    assert {r["text_clean"]: [(s["ph"], s["value"]) for s in r["kept"]] for r in rows} == EXAMPLES
    assert all(r["text_clean"][s["start"] : s["end"]] == s["value"] for r in rows for s in r["kept"])


def test_many_matches_keep_their_places(spark):
    text = " ".join(f"june {i}" for i in range(1000))
    df = spark.createDataFrame([(text,)], "text_clean string")
    kept = E.with_spans(df).select(E.merge_spans(F.col("spans"))).first()[0]
    assert sum(s["ph"] == "[DATE]" for s in kept) >= 1000
    assert all(text[s["start"] : s["end"]] == s["value"] for s in kept)


def merge(spark, spans):
    df = spark.createDataFrame([(spans,)], f"spans {SPANS.simpleString()}")
    return [(s["start"], s["end"]) for s in df.select(E.merge_spans(F.col("spans"))).first()[0]]


def test_merge_golden(spark):
    spans = [(0, 5, "a", "", 0.5), (0, 9, "b", "", 0.85), (4, 6, "c", "", 1.0), (9, 12, "d", "", None)]
    assert merge(spark, spans) == [(0, 9), (9, 12)]


def test_merge_against_loop(spark):
    rng = random.Random(7)
    cases = []
    for i in range(200):
        spans = []
        for _ in range(rng.randint(0, 8)):
            start = rng.randint(0, 20)
            spans.append((start, start + rng.randint(1, 8), "p", "v", rng.choice([None, 0.4, 1.0])))
        cases.append((i, spans))
    df = spark.createDataFrame(cases, f"i int, spans {SPANS.simpleString()}")
    got = {r["i"]: [(s["start"], s["end"]) for s in r["m"]] for r in df.select("i", E.merge_spans(F.col("spans")).alias("m")).collect()}
    for i, spans in cases:
        want, last = [], -1
        for s in sorted(spans, key=lambda s: (s[0], -(s[4] or 0))):
            if s[0] >= last:
                want.append((s[0], s[1]))
                last = s[1]
        assert got[i] == want


def test_span_positions(spark):
    text = "x 12 yy 345 z6"
    df = spark.createDataFrame([(text,)], "text_clean string")
    rule = E.Rule("NUM", "[0-9]+")
    spans = E.with_spans(df, rules=[rule]).first()["spans"]
    assert [(s["start"], s["end"], s["ph"]) for s in spans] == [(2, 4, "[NUM]"), (8, 11, "[NUM]"), (13, 14, "[NUM]")]
    assert all(text[s["start"]:s["end"]] == s["value"] for s in spans)


def test_placeholder_for_unknown_type(spark):
    df = spark.createDataFrame([("LOCATION",), ("GPE",)], "e string")
    kept = [r[0] for r in df.select(E.placeholder_for(F.col("e"), True)).collect()]
    dropped = [r[0] for r in df.select(E.placeholder_for(F.col("e"), False)).collect()]
    assert kept == ["[LOCATION]", "[DELIVERY_LOCATION]"] and dropped == [None, "[DELIVERY_LOCATION]"]


def test_gazetteer_small_and_large(spark):
    df = spark.createDataFrame(
        [(1, "ask Ada Lovelace or ada"), (2, "New York City and york"), (3, "nobody"), (4, "ada-x or #ada, ADA")],
        "row_seq long, text_clean string",
    )
    known = spark.createDataFrame(
        [("ada", "PERSON"), ("Ada Lovelace", "PERSON"), ("new york", "GPE"), ("york", "NORP")],
        "phrase string, entity string",
    )
    for limit in (100, None):  # broadcast, and salted shuffle
        out = gazetteer.with_gazetteer_spans(df, known, max_rows=limit)
        got = {
            r["row_seq"]: [(s["start"], s["value"], s["ph"]) for s in r["gazetteer_spans"]]
            for r in out.collect()
        }
        assert got == {
            1: [(4, "Ada Lovelace", "[PERSON_NAME]"), (20, "ada", "[PERSON_NAME]")],
            2: [(0, "New York", "[DELIVERY_LOCATION]")],
            3: [],
            4: [(15, "ADA", "[PERSON_NAME]")],
        }


def test_gazetteer_long_names(spark):
    df = spark.createDataFrame([(1, "from Bank of New York to Jo de la Cruz Garcia")], "row_seq long, text_clean string")
    known = spark.createDataFrame(
        [("Bank of New York", "ORG"), ("jo de la cruz garcia", "PERSON")], "phrase string, entity string"
    )
    spans = gazetteer.with_gazetteer_spans(df, known).first()["gazetteer_spans"]
    assert [s["value"] for s in spans][-1] == "Jo de la Cruz Garcia"


def test_gazetteer_by_brute_force(spark):
    own = random.Random(5)
    vocabulary = ["new", "york", "city", "of", "bank", "Ada", "x-1", "#7", "the", "a_b"]
    known = {" ".join(own.choice(vocabulary) for _ in range(n)) for n in (1, 2, 2, 2, 3, 3, 3, 4, 5)}
    known |= {" ".join(vocabulary * 3)}  # 30 words
    gaps = [" ", ", ", " - ".replace("-", "/"), "  ", ". "]
    texts = [
        "".join(own.choice(vocabulary).upper() if own.random() < 0.2 else own.choice(vocabulary) + own.choice(gaps) for _ in range(own.randint(0, 60)))
        for _ in range(150)
    ]
    texts += [f"so {' , '.join(vocabulary * 3)}!", "new york " * 3000, "", None]
    by_words = {tuple(k.lower().split()) for k in known}

    def brute(text):
        words = [(m.start(), m.end(), m[0].lower()) for m in re.finditer("[A-Za-z0-9#_-]+", text or "")]
        found, at = [], 0
        while at < len(words):
            ends = [n for n in range(1, 31) if tuple(w for _, _, w in words[at : at + n]) in by_words and at + n <= len(words)]
            if ends:
                a, b = words[at][0], words[at + max(ends) - 1][1]
                found.append((a, b, text[a:b]))
            at += max(ends, default=1)
        return found

    df = spark.createDataFrame(list(enumerate(texts)), "row_seq long, text_clean string")
    phrases = spark.createDataFrame([(k, "PERSON") for k in sorted(known)], "phrase string, entity string")
    counts = spark.createDataFrame([("of", 1), ("new", 5)], "word string, n long")
    for options in ({}, {"max_rows": 50, "word_counts": counts}):
        out = gazetteer.with_gazetteer_spans(df, phrases, **options).collect()
        got = {r["row_seq"]: [(s["start"], s["end"], s["value"]) for s in r["gazetteer_spans"]] for r in out}
        assert got == {i: brute(t) for i, t in enumerate(texts)}
    none = gazetteer.with_gazetteer_spans(df, phrases.limit(0)).select("gazetteer_spans").distinct().collect()
    assert [r[0] for r in none] == [[]]
    plan = gazetteer.gazetteer_spans(df, phrases)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    exchanges = [part for part in plan.split("\n\n") if re.match(r"\(\d+\) Exchange", part)]
    assert exchanges and not any("text_clean" in part for part in exchanges)


def test_user_model_spans(spark):
    def load():
        def find(text):
            at = text.find("Acme")
            return [] if at < 0 else [{"start": at, "end": at + 4, "ph": "[ORGANIZATION]", "value": "Acme", "score": None}]

        return find

    df = spark.createDataFrame([(1, "call Acme now"), (2, "hi")], "row_seq long, text_raw string")
    found = hooks.with_model_spans(df, load, text_col="text_raw")
    out = E.normalise_placeholders(found, extra_spans=["model_spans"]).orderBy("row_seq").collect()
    assert [r["text"] for r in out] == ["call [ORGANIZATION] now".lower(), "hi"]


MODEL_TEXTS = {
    "please refund [refund_amt_bin=10_50] for [order_id_presence]": "please refund for [ID_PRESENT] [ORDER_PRESENT]",
    "open a [account_type=gold_account]": "open a [ACCOUNT_TYPE_GOLD_ACCOUNT]",
    "see [bill_number_presence] and [invoice_number_presence]": "see and [INVOICE_PRESENT] [BILL_PRESENT]",
    "deliver in [date_month=june]": "deliver in [DATE_MONTH=june]",
    "it was [date_year=2023]": "it was [ID_PRESENT]",
    "mail [email_address_presence] or [phone_number_presence]": "mail or [PHONE_PRESENT] [EMAIL_PRESENT]",
    "what time [date_time_question]": "what time",
    "request_invoice please": "please",
    "[account_type=pro] [account_type=gold] [account_type]": "[ACCOUNT_TYPE_GOLD]",
}


def test_model_text(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(MODEL_TEXTS)], "row_seq int, text string")
    rows = features.with_model_text(df).orderBy("row_seq").collect()
    assert [r["text_model"] for r in rows] == list(MODEL_TEXTS.values())
    kept = features.with_model_text(df, keep_bins=True).orderBy("row_seq").first()["text_model"]
    assert kept == "please refund for [REFUND_AMT_BIN=10_50] [ORDER_PRESENT]"
    assert [p["name"] for p in rows[6]["ph_info"]["other_placeholders"]] == ["DATE_TIME_QUESTION"]


def test_group_key(spark):
    import hashlib

    rows = [
        (1, "x [order_id_presence]", {"[PERSON_NAME]": ["Al"], "[ORDER_ID]": ["o 1"]}),
        (2, "[account_type=gold_account] [order_id_presence]", {}),
        (3, "plain", None),
        (4, "x [order_id_presence]", {"[ORDER_ID]": []}),
    ]
    df = spark.createDataFrame(rows, "row_seq int, text string, mappings map<string,array<string>>")
    modelled = features.with_model_text(df)
    got = [r["group_key"] for r in features.with_group_key(modelled).orderBy("row_seq").collect()]
    want = ["o 1", "acct:GOLD_ACCOUNT|order", "plain", "order"]
    assert got == [hashlib.md5(w.encode()).hexdigest() for w in want]
    presence = features.with_group_key(modelled, "presence").orderBy("row_seq").first()["group_key"]
    assert presence == hashlib.md5(b"order").hexdigest()


def test_filters_do_not_recompute_text(spark):
    """A filter on a costly column stays above the generator that computes it."""
    df = computed_once(spark.range(3), {"x": F.md5(F.col("id").cast("string"))})
    plan = df.filter("x <> 'a'")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("md5(") == 1
    assert df.count() == 3


def test_gazetteer_broadcasts_a_bitmap_only(spark, tmp_path):
    """Spark takes the phrases of a compressed file for small; only the bitmap's rows may be broadcast."""
    path = str(tmp_path / "phrases")
    phrases = F.concat(F.lit("Customer#"), F.col("id")).alias("phrase")
    spark.range(3000).select(phrases, F.lit("PERSON").alias("entity")).write.parquet(path)
    df = spark.createDataFrame([(1, "ask Customer#12 or Customer#2999, not Customer#3000")], "row_seq long, text_clean string")
    known = spark.read.parquet(path)
    plan = gazetteer.gazetteer_spans(df, known)._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "BroadcastHashJoin" in line]
    assert joins and all("_row" in line for line in joins), joins
    folder = str(tmp_path / "words")
    for options in ({}, {"folder": folder}):
        (row,) = gazetteer.gazetteer_spans(df, known, **options).collect()
        assert [(s["start"], s["value"]) for s in row["gazetteer_spans"]] == [(4, "Customer#12"), (19, "Customer#2999")]


def test_guards_lose_no_match():
    """Every rule has a cheap test before its pattern, and each match passes it."""
    assert all(r.needs or r.hint for r in E.RULES)
    texts = [
        *EXAMPLES,
        "card 4111-1111 11111111, 4111111111111111 or 4111 1111 1111 1111",
        "GB82 WEST 1234 5698 7654 32 and GB82WEST12345698765432 licence D1234567",
        "bc1qar0srrr7xfkvy5l643lydnw9re59gtzzwf5mdq 10.20.30.40 078-05-1120 1.2.3.4",
        "a@b.com.x@y.zz me.you+x@mail.example.org (555)201-1234 555 201-1234 +1 (555) 201 1234",
        "order ORD-1, INV 22, bill #3, Billno: B-9 gold account, 5 march 2024, May 5, 1/2/2023 1999 2010",
        "an ago 3 days ago usd 1,500.25 12 pounds $ 9 12345678 99999999999999999 shop.example.io/x",
    ]
    seen = set()
    for i, rule in enumerate(E.RULES):
        for match in (m[0] for text in texts for m in re.finditer(rule.pattern, text)):
            seen.add(i)
            assert not rule.hint or re.search(rule.hint, match), (rule, match)
            assert not rule.digit or re.search("[0-9]", match), (rule, match)
            assert not rule.needs or any(n in match.lower() for n in rule.needs), (rule, match)
    assert seen >= {i for i, r in enumerate(E.RULES) if r.hint}


def test_walk_and_merge_by_number_of_matches(spark):
    """None, one, a block's worth and more matches take different ways and agree."""
    counts = [0, 1, 2, E.BLOCK - 1, E.BLOCK, E.BLOCK + 1, 3 * E.BLOCK]
    df = spark.createDataFrame([(n, "x " * 3 + "2023 ab " * n) for n in counts], "n int, text_clean string")
    for r in E.with_spans(df).withColumn("kept", E.merge_spans(F.col("spans"))).collect():
        wanted = [(6 + 8 * i, 10 + 8 * i) for i in range(r["n"])]
        assert [(s["start"], s["end"]) for s in r["spans"]] == wanted
        assert [(s["start"], s["end"]) for s in r["kept"]] == wanted


def test_cheap_tests_read_whole_words_and_runs(spark):
    """Words inside other words open no rule, every match's digits are in a run, and a run may be long."""
    text = F.col("text_clean")
    long = "1 2 3 4 " * 100_000
    texts = ["preorder inward ordinal, billboard accounts", "Order ORD-12, bill. In MAY", long]
    df = spark.createDataFrame([(t,) for t in texts], "text_clean string")
    known, runs = E._known_words(F.lower(text), E.RULES), E._number_runs(text)
    got = {r[0]: r for r in df.select("text_clean", known, runs).collect()}
    assert [got[t][1].split() for t in texts] == [[], ["order", "ord", "bill", "may"], []]
    assert [got[t][2] for t in texts] == ["", "12", long.strip()]
    matches = ["10.20.30.40", "078-05-1120", "4111 1111-11111111", "(555) 201-1234", "123456789", "1/2/2023", "1999"]
    df = spark.createDataFrame([(m,) for m in matches], "text_clean string")
    found = df.select("text_clean", runs, *[runs.rlike(r.hint) for r in E.RULES if r.runs]).collect()
    ruled = [r for r in E.RULES if r.runs]
    assert all(found[i][2 + k] for i, m in enumerate(matches) for k, r in enumerate(ruled) if re.search(r.pattern, m))


def test_let_takes_no_element_by_index(spark):
    """An element taken by its index works out the type of the whole body for every row."""
    df = spark.createDataFrame([(1,), (None,)], "x int")
    shown = df.select(let(F.col("x") + 1, lambda y: F.struct(y.alias("a"), F.array(y).alias("b"))).alias("z"))
    assert "array_max" in shown._jdf.queryExecution().optimizedPlan().toString()
    assert [tuple(r["z"]) for r in shown.collect()] == [(2, [2]), (None, [None])]
    assert [r[0] for r in df.select(let(F.col("x"), lambda y: y)).collect()] == [1, None]


def test_text_work_is_compiled_and_slots_only_where_read(spark):
    df = spark.createDataFrame([(1, "Order A12 costs $5, see june 2020", "x")], "row_seq long, text string, label string")
    modelled = prepare.model_rows(ingest.clean_messages(df))
    plan = modelled.select("text_model", "label")._jdf.queryExecution().optimizedPlan().toString()
    # Generators and lambdas are interpreted: rewriting stands in neither, and no slots are made for nobody.
    assert "map_from_entries" not in plan
    generators = [line for line in plan.split("\n") if "Generate inline" in line]
    assert len(generators) == 2 and not any("regexp_replace" in line for line in generators)
    assert "map_from_entries" in modelled._jdf.queryExecution().optimizedPlan().toString()
    row = modelled.first()
    assert row["mappings"] == {"[ORDER_ID]": ["Order A12"], "[REFUND_AMOUNT]": ["$5"], "[DATE]": ["june 2020"]}
    assert row["text_model"] == "costs , see [ID_PRESENT] [DATE_MONTH=june] [ORDER_PRESENT]"


def test_a_lone_span_is_kept_unless_it_is_a_stop_word(spark):
    kept = "array<struct<start:int,end:int,ph:string,value:string>>"
    cases = {1: [], 2: [(3, 5, "[DATE]", "ab", 0.5)], 3: [(3, 5, "[STOP_ENTITY]", "ab", None)], 4: None, 5: [(-2, 1, "[DATE]", "a", None)]}
    df = spark.createDataFrame(list(cases.items()), f"i int, spans {SPANS.simpleString()}")
    merged = df.select("i", E.merge_spans(F.col("spans")).cast(kept).alias("m")).collect()
    assert {r["i"]: r["m"] and [tuple(s) for s in r["m"]] for r in merged} == {1: [], 2: [(3, 5, "[DATE]", "ab")], 3: [], 4: None, 5: []}
