"""One row per key."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def total_order(df: DataFrame) -> Column:
    """A hash of the whole row, nulls in their places: breaks ties the same way in every run."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    return F.xxhash64(*columns, *[c.isNull() for c in columns])


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank") -> DataFrame:
    """The first `n` rows of every group, numbered from 1.

    Each task keeps its own first `n` rows per group before the shuffle (WindowGroupLimit),
    so a group with a large share of the rows reaches its reducer already cut down.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)


def dedupe_latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key in `order`; equal rows are told apart by their content."""
    return top_per_group(df, keys, [*order, total_order(df)], 1, "__rank").drop("__rank")
