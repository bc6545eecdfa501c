"""Tables, the shared folder and files in it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from msgloom.sources.workspace import new_folder

BROADCAST_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write the rows to the shared folder and read them back: lineage ends here."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """A stored table, marked for broadcast when it has at most max_rows rows."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def split_words(text: Column, separators: str) -> Column:
    """The non-empty pieces between separators; none for null."""
    pieces = F.split(F.coalesce(text, F.lit("")), separators, -1)
    return F.filter(pieces, lambda w: w != "")


def file_system(path: str):
    """(file system, path in it) of a folder that Spark names by a URI."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if ":" in path else (fs.LocalFileSystem(), path)
