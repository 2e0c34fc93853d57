"""Parquet writes of the lake and its stages."""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CODEC = "zstd"


def write_lake(papers: DataFrame, path: str, partition: str = "published_year") -> None:
    """Overwrite the lake, one folder per year.

    The rebalance hint groups rows by year so that a task does not open a file in every
    folder, and lets adaptive execution split a year that holds a large share of the rows.
    """
    (
        papers.hint("rebalance", partition)
        .write.mode("overwrite")
        .partitionBy(partition)
        .option("compression", CODEC)
        .parquet(path)
    )


def write_stage(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", CODEC).parquet(path)


#: Partition column of a stage that is written slice by slice.
SLICE = "slice"


class SliceMismatch(ValueError):
    """A stage that was begun with another number of slices."""


def write_slices(df: DataFrame, path: str, slices: int, step: Callable[[DataFrame], DataFrame], key: str = "paper_id") -> int:
    """Apply a costly step to the rows slice by slice, each a job of its own; returns how many slices were run.

    Slices go by a hash of the key, so they are the same whenever the rows are. A slice that is finished is not
    run again: after a failure the same call goes on with the one that failed. A new run over new rows needs a new folder.
    """
    spark = df.sparkSession
    done = _finished(spark, path)
    if wrong := {name for name in done if not name.endswith(f"-of-{slices}")}:
        raise SliceMismatch(f"{path} holds {sorted(wrong)[0]}, not one of {slices} slices")
    number = F.pmod(F.xxhash64(key), F.lit(slices))
    todo = [i for i in range(slices) if f"{i}-of-{slices}" not in done]
    for i in todo:
        write_stage(step(df.where(number == i)), f"{path}/{SLICE}={i}-of-{slices}")
    return len(todo)


def _finished(spark, path: str) -> set[str]:
    location = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{SLICE}=*/_SUCCESS")
    found = location.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(location) or []
    return {status.getPath().getParent().getName().split("=")[1] for status in found}


def write_dead_letters(rejects: DataFrame, path: str) -> None:
    """Always overwritten, also by an empty batch, so old rejects never survive a run."""
    rejects.write.mode("overwrite").parquet(path)


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Deal rows out evenly before a costly per-row step.

    With no number given, adaptive execution picks one from the size of the data.
    """
    return df.repartition(partitions) if partitions else df.hint("rebalance")
