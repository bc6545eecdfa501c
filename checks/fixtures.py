"""Inputs of the registered queries, projected from the whole test tables.

Each function reads whole tables and keeps every row and every character of a text.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from msgloom import constants as C
from msgloom.functions import vectors as V
from msgloom.functions.text import hash_number
from msgloom.functions.vectors import let
from msgloom.operators.bounded import computed_once
from msgloom.operators.dedup import first_per_key
from msgloom.sources import readers

H = hash_number
EVENT_LABELS = ["click", "view", "signup", "error", "purchase"]


def table(spark: SparkSession, sf_dir: str, name: str, stream: bool = False) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    if not stream:
        return spark.read.parquet(path)
    # As a pattern the path may be one file or a folder of files.
    pattern = f"{sf_dir}/{name}[.]parquet"
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(pattern)


def pick(labels: list[str], index: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, labels)), (index + 1).cast("int"))


def template(n: Column, price: Column, customer: Column, key: Column) -> Column:
    """One of twelve short messages by n % 12; its values vary with n and the key."""
    choices = [
        F.concat(F.lit("Where is my order ORD-"), 10000 + n % 90000, F.lit("?")),
        F.concat(
            F.lit("Please send invoice INV-"), 10000 + n % 90000,
            F.lit(" to user"), n % 97, F.lit("@mail.example.com"),
        ),
        F.concat(F.lit("I want to see bill #"), n % 100000),
        F.concat(F.lit("Refund $"), n % 1500, F.lit(".50 please")),
        F.concat(F.lit("I bought it "), F.floor(n / 12) % 30, F.lit(" months ago")),
        F.lit("Open a gold  account"),
        F.lit("Deliver to Kent in june"),
        F.concat(F.lit("Call me at +1 555-201-"), 1000 + n % 9000),
        F.concat(F.lit("Visit https://shop.example.com/"), n, F.lit(" now")),
        F.lit("Cancel my card 4111 1111 1111 1111"),
        F.concat(
            F.lit("This is Customer#"), F.lpad(customer.cast("string"), 9, "0"),
            F.lit(" about order "), key, F.lit(" worth $"), price, F.lit(", last month"),
        ),
        F.concat(
            F.lit("Transfer to GB82 WEST 1234 5698 7654 32 for purchase "), key,
            F.lit(", licence D1234567, account "), 10000000 + n % 90000000,
        ),
    ]
    text = F
    for i, choice in enumerate(choices):
        text = text.when(n % 12 == i, choice)
    return text


def messages_raw(spark: SparkSession, sf_dir: str, stream: bool = False, spread: bool = True) -> DataFrame:
    """FX1 (row_seq, ts, text, label): one message for each document and each order.

    A document's message is its whole text, in most cases after a short sentence that
    depends on the text only, so equal texts stay equal. Order messages are short and often
    alike. Labels are uneven and four of the fourteen don't occur. Without `spread` rows stay
    where they were read, for work that shuffles them anyway.
    """
    docs, orders = table(spark, sf_dir, "documents", stream), table(spark, sf_dir, "orders", stream)
    messages = _messages(docs, orders)
    parts = 2 * spark.sparkContext.defaultParallelism
    return messages if stream or not spread else readers.spread(messages, "row_seq", parts)


def _messages(docs: DataFrame, orders: DataFrame, more: tuple[str, ...] = ()) -> DataFrame:
    """The messages of rows of documents and orders, with columns that both have."""
    from_doc, from_order, label = _message_columns(docs.sparkSession)
    docs = computed_once(docs, {"n": H(F.col("text"))})
    draw = H(F.concat(F.lit("ord|"), "o_orderkey"))
    orders = computed_once(orders, {"n": draw})
    ts = F.timestamp_seconds(F.lit(1704067200) + F.col("n") % 86400).alias("ts")
    both = docs.select((F.col("doc_id") * 2).alias("row_seq"), ts, from_doc.alias("text"), *more).unionByName(
        orders.select((F.col("o_orderkey") * 2 + 1).alias("row_seq"), ts, from_order.alias("text"), *more)
    )
    return computed_once(both, {"text": F.col("text"), "label": label})


@lru_cache(maxsize=4)
def _message_columns(session: SparkSession) -> tuple[Column, Column, Column]:
    """Text of a document's message, text of an order's message, label of either."""
    n = F.col("n")
    short = template(n, F.lit("1.00"), n % 1000, n)
    from_doc = F.when(n % 12 < 10, F.concat(short, F.lit(" "), "text")).otherwise(F.col("text"))
    price = F.col("o_totalprice").cast("decimal(15,2)")
    from_order = template(n, price, F.col("o_custkey"), F.col("o_orderkey"))
    k = H(F.concat(F.lit("lab|"), "row_seq")) % 14
    label = let(k, lambda k: pick(C.INTENT_LABELS, F.floor(k * k / 14)))
    return from_doc, from_order, label


def upsert_rows(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    """Cleaned-like rows to load: (row_seq, text_raw, text, label)."""
    return messages_raw(spark, sf_dir, stream, spread=False).select(
        "row_seq", F.col("text").alias("text_raw"), F.lower("text").alias("text"), "label"
    )


def upsert_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX2: the message table before the load.

    It holds the messages of rated documents and of finished orders. Toxic or urgent ones
    have another label, low-quality or low-priority ones an older copy. A quarter of the
    hashes, those of `complaint`, is yet to be filled.
    """
    rated = table(spark, sf_dir, "labels").select(
        "doc_id", (F.col("toxic") == 1).alias("relabel"), (F.col("quality") == 0).alias("copied")
    )
    # An order's state stands in its own row, so only texts of documents are joined with theirs.
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").join(rated, "doc_id")
    orders = (
        table(spark, sf_dir, "orders")
        .filter("o_orderstatus = 'F'")
        .withColumns({"relabel": F.col("o_orderpriority") == "1-URGENT", "copied": F.col("o_orderpriority") == "5-LOW"})
    )
    messages = _messages(docs, orders, ("relabel", "copied")).withColumnRenamed("text", "text_raw").drop("ts")
    # The lower-cased text is made after the shuffle, which needn't carry it.
    rows = first_per_key(messages, ["text_raw"]).withColumn("text", F.lower("text_raw"))
    label = F.when(F.col("relabel"), "complaint").otherwise(F.col("label"))
    ids = F.array(
        F.col("row_seq") + 1, F.when(F.col("copied"), -(F.col("row_seq") + 1))
    )
    loaded = F.lit("2024-01-01 00:00:00").cast("timestamp")
    return rows.select(
        F.explode(F.array_compact(ids)).alias("id"),
        "text_raw",
        "text",
        label.alias("label"),
        F.when(label != "complaint", F.md5("text_raw")).alias("md5_hash"),
        loaded.alias("created_at"),
        F.lit(None).cast("timestamp").alias("updated_at"),
    )


def logs(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    """FX3 (event_id, ts, pred, actual, correct, confidence)."""
    n = H(F.concat(F.lit("act|"), "event_id"))
    actual = F.when(n % 10 == 0, None).when(n % 10 < 8, F.col("event_type")).otherwise(
        pick(EVENT_LABELS, F.floor(n / 16) % 5)
    )
    return (
        table(spark, sf_dir, "events", stream)
        .select(
            "event_id",
            F.col("ts").cast("timestamp").alias("ts"),
            F.col("event_type").alias("pred"),
            actual.alias("actual"),
            (F.lit(0.5) + (n % 500) / 1000.0).alias("confidence"),
        )
        .withColumn("correct", (F.col("actual") == F.col("pred")).cast("int"))
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX4 (row_seq, text, true_id, pred_id, confidence, probs) over ten classes."""
    classes = F.sequence(F.lit(0), F.lit(9))

    def logit(c: Column) -> Column:
        noise = H(F.concat(F.col("vec_id").cast("string"), F.lit("|"), c.cast("string"))) % 1000
        return noise / 100.0 + F.when(c == F.col("label"), 4.0).otherwise(0.0)

    scored = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("row_seq"),
        F.concat(F.lit("vector "), "vec_id").alias("text"),
        F.col("label").alias("true_id"),
        V.softmax(F.transform(classes, logit)).alias("probs"),
    )
    return scored.withColumns(
        {"pred_id": V.argmax(F.col("probs")), "confidence": F.array_max("probs")}
    )


def class_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(label, id) of the classes that occur in the predictions."""
    return (
        table(spark, sf_dir, "embeddings")
        .select(F.concat(F.lit("class_"), "label").alias("label"), F.col("label").alias("id"))
        .distinct()
    )


def gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(phrase, entity): customers as persons."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("phrase"), F.lit("PERSON").alias("entity")
    )


def intent_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(label, id) of the labels of the messages."""
    from msgloom.operators.features import label_ids

    return label_ids(messages_raw(spark, sf_dir))


# A scorer that SQL can repeat: a class scores when its words occur in the model text.
SCORER_WORDS = {
    "account_management": "account",
    "complaint": "cancel",
    "contact_support": "call",
    "queries_related_to_order": "[order_present]",
    "queries_related_to_refund": "refund",
    "request_bill": "[bill_present]",
    "request_invoice": "[invoice_present]",
}


def word_logits(labels: list[str]):
    """Logits over `labels`: 5 for the class's word, plus a stable draw in [0, 1)."""

    def logits(text: Column) -> Column:
        return F.array(
            *[
                (
                    F.when(F.contains(F.lower(text), F.lit(SCORER_WORDS[label])), 5.0).otherwise(0.0)
                    if label in SCORER_WORDS
                    else F.lit(0.0)
                )
                + (H(F.concat(text, F.lit(f"|{label}"))) % 100) / 100.0
                for label in labels
            ]
        )

    return logits
