"""Row layouts of the tables that the operators read and write."""

from __future__ import annotations

from pyspark.sql import types as T

MAPPINGS = T.MapType(T.StringType(), T.ArrayType(T.StringType()))

SPAN = T.StructType(
    [
        T.StructField("start", T.IntegerType()),
        T.StructField("end", T.IntegerType()),
        T.StructField("ph", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("score", T.DoubleType()),
    ]
)
SPANS = T.ArrayType(SPAN)

CLEANED = T.StructType(
    [
        T.StructField("row_seq", T.LongType()),
        T.StructField("text_raw", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("label", T.StringType()),
        T.StructField("mappings", MAPPINGS),
    ]
)

MESSAGES = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("text_raw", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("label", T.StringType()),
        T.StructField("md5_hash", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)

LOGS = T.StructType(
    [
        T.StructField("ts", T.TimestampType()),
        T.StructField("pred", T.StringType()),
        T.StructField("actual", T.StringType()),
        T.StructField("correct", T.IntegerType()),
        T.StructField("confidence", T.DoubleType()),
        T.StructField("slots", T.StringType()),
    ]
)

#: Messages whose text was seen for the first time; they have no id of the message table.
SEEN = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("row_seq", T.LongType()),
        T.StructField("md5_hash", T.StringType()),
        T.StructField("text_raw", T.StringType()),
    ]
)
