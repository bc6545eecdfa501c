"""Readers and schema handling."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from msgloom import constants as C

ALIASES = {"query": "text", "intent": "label"}

# Which column plays a role: the first name present wins.
ROLES = {
    "text": ["text", "texts", "text_raw", "text_model"],
    "label": ["label", "intent"],
    "true": ["true", "true_id", "label", "true_label"],
    "pred": ["pred", "pred_id", "pred_label", "prediction"],
}


def read_csv_strings(
    spark: SparkSession,
    path: str | list[str],
    null_tokens: list[str] | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """A CSV with header, every column a string; no pass over the data to infer types.

    With null_tokens, values in the list become null; without, nulls become "". multi_line
    allows line breaks in quotes, but then one file is one task: set it to False for large
    files without such breaks.
    """
    df = (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .csv(path)
    )
    if null_tokens is None:
        return df.na.fill("")
    return df.select(
        *[
            F.when(F.col(f"`{c}`").isin(null_tokens), None).otherwise(F.col(f"`{c}`")).alias(c)
            for c in df.columns
        ]
    )


def read_messages_csv(
    spark: SparkSession,
    path: str | list[str],
    null_tokens: list[str] | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """Raw messages: aliased columns, rows without text or label dropped, row_seq added.

    row_seq follows the order within a file unless the file has a row_seq of its own. A
    missing path fails here, before any job.
    """
    df = alias_columns(
        read_csv_strings(
            spark, path, C.CSV_NULL_TOKENS if null_tokens is None else null_tokens, multi_line
        )
    )
    require_columns(df, ["text", "label"])
    if "row_seq" in df.columns:
        df = df.withColumn("row_seq", F.col("row_seq").cast("bigint"))
    else:
        df = df.withColumn("row_seq", F.monotonically_increasing_id())
    return df.na.drop(subset=["text", "label"])


def spread(df: DataFrame, key: str, parts: int | None) -> DataFrame:
    """The same rows in `parts` partitions by a hash of key; as they are for None.

    A file of one row group is read by one task whatever its size, and costly text work
    would stay there. Inputs with enough parts, as on a cluster, need no shuffle.
    """
    return df if parts is None else df.repartition(parts, key)


def alias_columns(df: DataFrame, aliases: dict[str, str] | None = None) -> DataFrame:
    return df.withColumnsRenamed(ALIASES if aliases is None else aliases)


def require_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"missing columns: {', '.join(missing)}")
    return df


def keep_present(df: DataFrame, columns: list[str]) -> DataFrame:
    """Only those of the columns that exist, in the given order."""
    return df.select(*[c for c in columns if c in df.columns])


def resolve_roles(
    df: DataFrame, wanted: list[str], roles: dict[str, list[str]] | None = None
) -> dict[str, str]:
    """{role: column} by the first name present; roles without a column are left out."""
    roles = roles or ROLES
    found = {r: next((c for c in roles[r] if c in df.columns), None) for r in wanted}
    return {r: c for r, c in found.items() if c is not None}


def text_columns(df: DataFrame) -> dict[str, str]:
    """Text columns by name ending: text_model, text_raw and text, whatever their case."""
    found: dict[str, str] = {}
    for c in df.columns:
        name = c.lower()
        for role in ("text_model", "text_raw"):
            if name.endswith(role):
                found[role] = c
        if name.endswith("text"):
            found.setdefault("text", c)
    return found


def read_table(
    spark: SparkSession,
    table: str,
    columns: list[str] | None = None,
    jdbc_url: str | None = None,
    partition: tuple[str, int, int, int] | None = None,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """Columns of a catalog table, or of a database table with jdbc_url.

    partition = (column, lower, upper, parts) reads a database table in parallel; without
    it one task reads all rows.
    """
    if jdbc_url is None:
        df = spark.table(table)
    else:
        df = spark.read.format("jdbc").options(**jdbc_options(jdbc_url, table, partition, properties)).load()
    return df.select(*columns) if columns else df


def jdbc_options(
    url: str,
    table: str,
    partition: tuple[str, int, int, int] | None = None,
    properties: dict[str, str] | None = None,
) -> dict[str, str]:
    options = {"url": url, "dbtable": table, "fetchsize": "10000", **(properties or {})}
    if partition:
        column, lower, upper, parts = partition
        options |= {
            "partitionColumn": column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(parts),
        }
    return options


def first_available(
    *loaders: Callable[[], DataFrame], required: list[str] | None = None
) -> DataFrame:
    """The first source that opens and has the required columns; raises if none does."""
    reasons = []
    for load in loaders:
        try:
            df = load()
            return require_columns(df, required or [])
        except (AnalysisException, KeyError, FileNotFoundError) as reason:
            reasons.append(str(reason).splitlines()[0])
        except Exception as reason:  # a database that can't be reached raises its own type
            reasons.append(f"{type(reason).__name__}: {str(reason).splitlines()[:1]}")
    raise RuntimeError("no source available: " + "; ".join(reasons))


def load_with(load: Callable[[str], DataFrame], *paths: str) -> DataFrame:
    """First of several paths that a user's loader can open."""
    return first_available(*[lambda p=p: load(p) for p in paths])


def read_report(spark: SparkSession, path: str, label_col: str = "metric") -> DataFrame:
    """A metrics table back with numbers; its first column holds the row labels."""
    df = read_csv_strings(spark, path, [""], multi_line=False)
    first, *rest = df.columns
    return df.select(
        F.col(f"`{first}`").alias(label_col),
        *[F.col(f"`{c}`").try_cast("double").alias(c) for c in rest],
    )


def read_matrix(spark: SparkSession, path: str) -> DataFrame:
    """A wide confusion matrix back as (true, pred, n)."""
    df = read_csv_strings(spark, path, [""], multi_line=False)
    first, *rest = df.columns
    long = df.unpivot([first], [f"`{c}`" for c in rest], "pred", "n")
    return long.select(
        F.col(f"`{first}`").alias("true"), "pred", F.col("n").cast("double").cast("bigint").alias("n")
    )


def read_label_mapping(spark: SparkSession, path: str) -> DataFrame:
    df = read_csv_strings(spark, path, multi_line=False)
    return require_columns(df, ["label", "id"]).select("label", F.col("id").cast("int").alias("id"))
