"""Row checks: validity, completeness, uniqueness, references, and the reject report."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fits(column: str | Column, width: int) -> Column:
    """True for a value of at most ``width`` characters; a NULL fits."""
    column = F.col(column) if isinstance(column, str) else column
    return column.isNull() | (F.length(column) <= width)


def first_violation(rules: Mapping[str, Column]) -> Column:
    """Name of the first rule that does not hold, NULL when all do.

    A rule that gives NULL does not hold.
    """
    checks = [
        F.when(~F.coalesce(holds, F.lit(False)), F.lit(name)) for name, holds in rules.items()
    ]
    return F.coalesce(*checks)


def validate(rows: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """All rows, with the name of the first broken rule in ``reason``."""
    return rows.withColumn("reason", first_violation(rules))


def split_valid(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows without and with a ``reason``; together they are the input."""
    valid = rows.filter(F.col("reason").isNull()).drop("reason")
    return valid, rows.filter(F.col("reason").isNotNull())


def complete(rows: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Rows in which none of the columns is NULL."""
    return rows.dropna(subset=list(columns))


def orphans(child: DataFrame, parent: DataFrame, on: str) -> DataFrame:
    """Keys of ``child`` that ``parent`` lacks, with the number of rows each.

    Keys are counted before the join, so a key that many rows share weighs as one row.
    NULL keys refer to nothing and are no orphans.
    """
    counted = (
        child.filter(F.col(on).isNotNull()).groupBy(on).agg(F.count(F.lit(1)).alias("n_rows"))
    )
    return counted.join(parent.select(on), on, "left_anti")


def duplicates(rows: DataFrame, key: str | Column, name: str = "key") -> DataFrame:
    """Values of the key that more than one row has, with their number of rows."""
    key = F.col(key) if isinstance(key, str) else key
    return (
        rows.select(key.alias(name))
        .filter(F.col(name).isNotNull())
        .groupBy(name)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter(F.col("n_rows") > 1)
    )


def reject_rows(rows: DataFrame, stage: str, pos: Column | None = None) -> DataFrame:
    """Rows with a ``reason`` in the shape of the reject table."""
    pos = F.lit(None) if pos is None else pos
    return rows.filter(F.col("reason").isNotNull()).select(
        F.lit(stage).alias("stage"),
        "reason",
        "seq",
        pos.cast("bigint").alias("pos"),
        "raw",
    )
