"""Tables that must stay small, joins that stand a hot key, columns computed once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from msgloom.constants import MAX_LABELS

SALTS = 16


def bounded(df: DataFrame, max_rows: int = MAX_LABELS, what: str = "table") -> DataFrame:
    """The same rows, or a failed job when there are more than max_rows.

    The limit makes the bound hold before the rows are counted, so a broadcast or an
    unpartitioned window over the result never sees more than max_rows + 1 rows.
    """
    turn = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.lit(0)))
    message = F.lit(f"{what} has more than {max_rows} rows")
    checked = F.when(F.col("_turn") > max_rows, F.raise_error(message).cast("boolean"))
    return (
        df.limit(max_rows + 1)
        .withColumn("_turn", turn)
        .filter(checked.otherwise(True))
        .drop("_turn")
    )


def small(df: DataFrame, max_rows: int = MAX_LABELS, what: str = "table") -> DataFrame:
    """A bounded table marked for broadcast."""
    return F.broadcast(bounded(df, max_rows, what))


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    spread_by: list[str],
    how: str = "inner",
    salts: int = SALTS,
) -> DataFrame:
    """Equi-join of a skewed left side with a right side that has few rows for each key.

    Left rows of one key are spread over `salts` partitions; each right row is copied to
    all of them. Kinds: inner, left, left_semi, left_anti. The join is always a shuffle:
    Spark's estimate of the right side doesn't know of the copies, nor of rows that an
    explode made, and would broadcast a table of millions of rows.
    """
    salt = F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")
    spread = left.withColumn("_salt", salt)
    copies = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return spread.join(copies.hint("merge"), [*on, "_salt"], how).drop("_salt")


def computed_once(
    df: DataFrame, columns: dict[str, Column], drop: list[str] | None = None
) -> DataFrame:
    """Add costly columns so that later filters on them don't compute them again.

    A filter, also one that a join infers, moves below a plain projection and takes a copy
    of the column's whole expression with it. It doesn't move below a generator, and one
    row in is one row out here.
    """
    kept = [c for c in df.columns if c not in columns and c not in (drop or [])]
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select(*kept, F.inline(F.array(row)))
