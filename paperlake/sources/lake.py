"""Parquet tables of the lake."""

from pyspark.sql import DataFrame, SparkSession

from paperlake.session import parts_for, plan_bytes


def read_lake(spark: SparkSession, path: str, years: tuple[int, int] | None = None) -> DataFrame:
    """The clean papers; a year range becomes a partition filter, so other years are not listed."""
    papers = spark.read.parquet(path)
    if years is None:
        return papers
    return papers.where(papers["published_year"].between(*years))


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    """A stage table written by the metadata or the embedding pass, in one go or in slices."""
    return spark.read.parquet(path).drop("slice")


#: Files below this size are dealt out; a larger table has splits enough of its own.
WIDEN_BYTES = 256 << 20
_SPLIT_BYTES = 256 << 10
#: Bytes of the files behind one part of a large table that is dealt out by key.
_KEYED_BYTES = 8 << 20


def widen(scan: DataFrame, key: str | None = None) -> DataFrame:
    """Deal the rows of a small file scan out to more tasks, one for each `_SPLIT_BYTES`.

    A single file with one row group would otherwise keep every costly expression on one core. The
    bytes of the files decide, so no cluster, however large, moves the texts of a large table; unless it
    is to be joined by `key` and moves them anyway: dealt out by it, its parts follow its bytes, while adaptive
    execution would merge those of a join into one for each core or 64 MB, whatever is done with their texts later.
    """
    size = plan_bytes(scan)
    if size >= WIDEN_BYTES:
        return scan.repartition(parts_for(size, _KEYED_BYTES, 1, 4096), key) if key else scan
    return scan.repartition(parts_for(size, _SPLIT_BYTES, 1, 64))
