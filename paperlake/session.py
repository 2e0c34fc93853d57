"""Session defaults, shared scratch space and the size check used before every broadcast."""

import atexit
import math
import shutil
import tempfile
import threading
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 * 1024 * 1024
#: What one task should have to hold.
PART_BYTES = 128 * 1024 * 1024

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "zstd",
}


_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def build_session(app: str = "paperlake", master: str | None = None, threads: int | None = None, **conf: str) -> SparkSession:
    """A session with the defaults of the library; `conf` keys use `__` for dots.

    `threads` bounds the threads that an injected encoder or extractor may start in each Python worker.
    """
    if threads:
        conf |= {"spark__executorEnv__OMP_NUM_THREADS": str(threads)}
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {key.replace("__", "."): value for key, value in conf.items()}
    spark = builder.config(map=settings).getOrCreate()
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, so that their Python workers can import it.

    Not needed where it is installed or passed with `--py-files`; done once per application. Arrow
    batches of whole texts are kept small unless the session asks for a size of its own.
    """
    context = spark.sparkContext
    if spark.conf.get(_BATCH) == "10000" and not context.getConf().contains(_BATCH):
        spark.conf.set(_BATCH, DEFAULTS[_BATCH])
    if spark.conf.get("spark.paperlake.shipped", None) == context.applicationId:
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="paperlake-")) / f"{root.name}.zip"
    with zipfile.ZipFile(archive, "w") as target:
        for source in sorted(root.rglob("*.py")):
            target.write(source, source.relative_to(root.parent))
    context.addPyFile(str(archive))
    spark.conf.set("spark.paperlake.shipped", context.applicationId)


class _Scopes(threading.local):
    """Scratch folders of the scopes that this thread has open."""

    def __init__(self):
        self.open: list[list[str]] = []


_SCOPES = _Scopes()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder on storage every executor can reach.

    The cluster names it in `spark.checkpoint.dir`. Only a local master, where driver and
    executors are one process, may fall back to a temporary folder, removed when Python ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="paperlake-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if _SCOPES.open:
        _SCOPES.open[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove the scratch folders made inside, for jobs that have written their results elsewhere."""
    _SCOPES.open.append([])
    try:
        yield
    finally:
        for name in _SCOPES.open.pop():
            remove_folder(spark, name)


def remove_folder(spark: SparkSession, name: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, label: str, partition: str | None = None) -> DataFrame:
    """Write `df` once to shared scratch space and go on from the written table.

    Unlike a cached frame the table outlives lost executors, is read column by column, and
    tells the optimizer its true size.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(partition) if partition else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _width(value: Column, kind: T.DataType) -> Column:
    """Approximate bytes of a value, whatever its nesting."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)) + F.lit(16)
    if isinstance(kind, T.StructType):
        return sum((_width(value[f.name], f.dataType) for f in kind.fields), F.lit(16))
    if isinstance(kind, T.MapType):
        return _width(F.map_keys(value), T.ArrayType(kind.keyType)) + _width(F.map_values(value), T.ArrayType(kind.valueType))
    if isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, (T.NumericType, T.BooleanType, T.DatetimeType)):
            return F.coalesce(F.size(value), F.lit(0)) * F.lit(8) + F.lit(16)
        element = lambda total, x: total + _width(x, kind.elementType).cast("long")
        return F.coalesce(F.aggregate(value, F.lit(0).cast("long"), element), F.lit(0)) + F.lit(16)
    if isinstance(kind, (T.NumericType, T.BooleanType, T.DatetimeType, T.NullType)):
        return F.lit(8)
    return F.coalesce(F.octet_length(value.cast("string")), F.lit(0)) + F.lit(16)


def data_bytes(df: DataFrame) -> int:
    """Approximate size of a frame in memory, from one distributed aggregate."""
    width = F.lit(16)
    for field in df.schema.fields:
        width = width + _width(F.col(f"`{field.name}`"), field.dataType)
    return df.agg(F.coalesce(F.sum(width.cast("long")), F.lit(0)).alias("bytes")).first()["bytes"]


def plan_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of a frame's size; for a plain scan the bytes of its files."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def parts_for(size: int, part: int, least: int, most: int) -> int:
    """How many parts of about `part` bytes a frame of `size` bytes is cut into."""
    return max(least, min(most, math.ceil(size / part)))


def is_small(size: int) -> bool:
    return size <= BROADCAST_BYTES


def broadcast_if_small(df: DataFrame, size: int | None = None) -> DataFrame:
    """Hint a broadcast only when the size allows it; else leave a shuffle join.

    The size is measured unless the caller already knows a bound in bytes.
    """
    return F.broadcast(df) if is_small(data_bytes(df) if size is None else size) else df


def probe(
    big: DataFrame, small: DataFrame, key: str, spread_by: str, how: str = "inner", size: int | None = None, salts: int | None = None
) -> DataFrame:
    """Join a large side with a side that is usually small, whatever share of `big` one key holds.

    A side of checked size is broadcast and `big` stays where it is. Beyond the limit both sides
    are shuffled by key and salt: rows of `big` are dealt out by a hash of `spread_by`, the other
    side is copied once per salt, so a hot key is met in `salts` tasks. There are enough salts
    for a third of `big` to fall into parts of `PART_BYTES`.
    """
    if is_small(data_bytes(small) if size is None else size):
        return big.join(F.broadcast(small), key, how)
    salts = salts or parts_for(plan_bytes(big) // 3, PART_BYTES, 4, 256)
    dealt = big.withColumn("__salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
    copied = small.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return dealt.join(copied, [key, "__salt"], how).drop("__salt")
