"""A keyed Parquet table that is replaced in whole or added to by key bucket, one commit at a time.

Rows lie in folders by hash of the key, so a key never changes its bucket whatever columns an
update touches. A commit writes new folders for the buckets it touches and then swaps one small
pointer file that names the folders of every bucket. Readers resolve the pointer, so they see the
state before or after a commit; a failed commit leaves folders that nothing names, and the next one writes over them.

A merge adds a folder with its own rows to each bucket it touches, and one with the keys it replaces: a row of a version
below that of such a key is no longer read. Buckets are written anew, as one folder each, once a merge meets `_MOST_OLDER`
older folders, replaces more than half of their rows, or the replaced keys are too many for a broadcast.

Companions are tables derived from the rows, such as the postings of a text index. Each bucket of
rows has its bucket of each companion, written with it and named by the same pointer, so what is
stored for search never differs from the table. A merge derives those of its own rows from their new folders, bucket
by bucket, so nothing of them is shuffled; where buckets are written anew, what is held of other rows moves along as it is.

Keys are unique and not null: a commit that would break this fails. Every commit has the schema of
the table; JSON text is parsed where it holds VARIANT, and fails the commit if it can't be. The number of folders follows the bytes of the table when it is published, so that a merge of few keys
rewrites a small share of it.
"""

import json
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperlake.functions.metadata import in_types_of
from paperlake.operators.upsert import upsert
from paperlake.session import broadcast_if_small, data_bytes, is_small, materialize, parts_for
from paperlake.sinks.lake import CODEC

BUCKET = "key_bucket"
_POINTER = "CURRENT.json"
_PUSHED_KEYS = 10
#: Bytes in memory of a folder.
_FOLDER_BYTES = 256 << 20
_LEAST, _MOST = 16, 1 << 16
#: The commit that wrote a row, next to its columns.
VERSION = "__version"
#: Older folders that a bucket may have beside its newest one.
_MOST_OLDER = 8
#: Bytes of the row groups of a folder, and of the splits that companions are derived from: their rows may be many times larger.
_SPLIT_BYTES = 8 << 20


class KeyViolation(ValueError):
    """A key that is null or occurs more than once."""


class Companion(NamedTuple):
    """What is derived from rows of the table and committed with them.

    `derive` works row by row and keeps the key; `sort` orders the rows of a folder. Other `settings` than
    the stored ones derive all rows anew.
    """

    name: str
    derive: Callable[[DataFrame], DataFrame]
    sort: tuple[str, ...]
    settings: dict


def _file_context(spark: SparkSession, path: str):
    jvm = spark._jvm
    location = jvm.org.apache.hadoop.fs.Path(path)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        location.toUri(), spark._jsc.hadoopConfiguration()
    )
    return context, location


def _read_pointer(spark: SparkSession, table: str) -> dict | None:
    context, path = _file_context(spark, f"{table}/{_POINTER}")
    if not context.util().exists(path):
        return None
    text = spark.read.option("wholetext", "true").text(f"{table}/{_POINTER}").first()[0]
    return json.loads(text)


def _swap_pointer(spark: SparkSession, table: str, state: dict) -> None:
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    context, fresh = _file_context(spark, f"{table}/{_POINTER}.{state['version']}")
    flags = jvm.java.util.EnumSet.of(
        jvm.org.apache.hadoop.fs.CreateFlag.CREATE, jvm.org.apache.hadoop.fs.CreateFlag.OVERWRITE
    )
    create_opts = jvm.org.apache.hadoop.fs.Options.CreateOpts
    stream = context.create(fresh, flags, gateway.new_array(create_opts, 0))
    stream.write(bytearray(json.dumps(state).encode()))
    stream.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    overwrite = gateway.new_array(rename, 1)
    overwrite[0] = rename.OVERWRITE
    context.rename(fresh, jvm.org.apache.hadoop.fs.Path(f"{table}/{_POINTER}"), overwrite)


def _bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _check_keys(rows: DataFrame, key: str) -> None:
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    bad = counts.where(F.col(key).isNull() | (F.col("n") > 1)).first()
    if bad is not None:
        raise KeyViolation(f"{key} is null" if bad[key] is None else f"{key} {bad[key]!r} occurs {bad['n']} times")


@contextmanager
def _small_splits(spark: SparkSession) -> Iterator[None]:
    """Files are read in splits of `_SPLIT_BYTES` at most by what runs inside."""
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, str(_SPLIT_BYTES))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _write_buckets(
    rows: DataFrame, table: str, folder: str, version: int, key: str, buckets: int, schema: T.StructType, sort: Iterable[str], deal: bool = True
) -> dict[str, str]:
    """Write rows in the given schema below a new folder and return the folder of every bucket written.

    Rows that come from folders of the same buckets need not be dealt out.
    """
    spark = rows.sparkSession
    rows = rows.select([F.col(f.name).cast(f.dataType) for f in schema.fields] + [F.lit(version).alias(VERSION)])
    rows = rows.withColumn(BUCKET, _bucket_of(key, buckets))
    rows = rows.hint("rebalance", BUCKET) if deal else rows
    writer = rows.sortWithinPartitions(BUCKET, *sort).write.mode("overwrite").partitionBy(BUCKET)
    writer = writer.option("compression", CODEC).option("parquet.block.size", _SPLIT_BYTES)
    with _small_splits(spark):
        writer.parquet(f"{table}/{folder}")
    context, path = _file_context(spark, f"{table}/{folder}")
    names = [status.getPath().getName() for status in context.util().listStatus(path)]
    return {n.split("=")[1]: f"{folder}/{n}" for n in names if n.startswith(f"{BUCKET}=")}


def _added(held: dict, written: dict[str, str], anew: set[str]) -> dict[str, dict]:
    """The folders of a table or companion after a commit that wrote the buckets `anew`, or else added to them."""
    folders = {b: f for b, f in held["folders"].items() if b not in anew}
    older = {b: fs for b, fs in held.get("older", {}).items() if b not in anew}
    older |= {b: [*older.get(b, []), folders[b]] for b in written if b in folders}
    return {"folders": folders | written, "older": older}


def _all_folders(held: dict, buckets: set[str] | None = None) -> list[str]:
    chosen = [f for b, f in held["folders"].items() if buckets is None or b in buckets]
    return chosen + [f for b, fs in held.get("older", {}).items() if buckets is None or b in buckets for f in fs]


def _version_of(folder: str) -> int:
    return int(folder.split("/")[0].rpartition("v=")[2])


def _derived(
    spark: SparkSession, table: str, state: dict, before: dict | None, written: dict[str, str], companions: Iterable[Companion], changed: DataFrame | None = None
) -> dict:
    """The companions of a state whose last commit wrote the folders `written`. Those that aren't given are dropped.

    With `changed`, the keys of all rows that are new or differ from those `before`, these folders hold their buckets as a whole.
    """
    out, write = {}, (state["version"], state["key"], state["buckets"])
    for one in companions:
        held, whole = (before or {}).get("companions", {}).get(one.name), _read_folders(spark, table, state, state)
        schema, folder = one.derive(whole).schema, f"{one.name}-v={state['version']}"
        again = held is None or held["settings"] != one.settings or T.StructType.fromJson(held["schema"]).simpleString() != schema.simpleString()
        if again:
            made = _write_buckets(one.derive(whole), table, folder, *write, schema, one.sort, deal=False)
            kept = {"folders": made, "older": {}}
        else:
            rows = _read_folders(spark, table, state, {"schema": state["schema"], "folders": written})
            if changed is not None:
                others = _read_folders(spark, table, before, held, set(written)).join(changed, state["key"], "left_anti")
                rows = others.select(schema.names).unionByName(one.derive(rows.join(changed, state["key"], "left_semi")))
            else:
                rows = one.derive(rows)
            made = _write_buckets(rows, table, folder, *write, schema, one.sort, deal=changed is not None)
            kept = _added(held, made, set(written) if changed is not None else set())
        out[one.name] = {"settings": one.settings, "schema": schema.jsonValue()} | kept
    return out


def exists(spark: SparkSession, table: str) -> bool:
    return _read_pointer(spark, table) is not None


def publish(df: DataFrame, table: str, key: str = "paper_id", buckets: int | None = None, companions: Iterable[Companion] = ()) -> int:
    """Replace the whole table; returns the new version. Folders are as many as its bytes ask for, unless given."""
    spark = df.sparkSession
    current = _read_pointer(spark, table) or {"version": 0}
    state = {
        "version": current["version"] + 1,
        "key": key,
        "buckets": buckets or parts_for(data_bytes(df), _FOLDER_BYTES, _LEAST, _MOST),
        "schema": df.schema.jsonValue(),
        "commits": current.get("commits", {}),
    }
    state["folders"] = _write_buckets(df, table, f"v={state['version']}", state["version"], key, state["buckets"], df.schema, [key])
    _check_keys(_read_folders(spark, table, state, state).select(key), key)
    state["companions"] = _derived(spark, table, state, None, state["folders"], companions)
    _swap_pointer(spark, table, state)
    return state["version"]


def _replaced(spark: SparkSession, table: str, state: dict, since: int) -> DataFrame | None:
    """The keys replaced by merges after the version `since`, with the version of the merge."""
    named = [one for one in state.get("replaced", []) if one["version"] > since]
    if not named:
        return None
    schema = T.StructType([T.StructType.fromJson(state["schema"])[state["key"]], T.StructField(VERSION, T.IntegerType())])
    gone = spark.read.schema(schema).parquet(*[f"{table}/{one['folder']}" for one in named])
    return broadcast_if_small(gone.withColumnRenamed(VERSION, "__gone"), sum(one["bytes"] for one in named))


def _read_folders(spark: SparkSession, table: str, state: dict, held: dict, buckets: set[str] | None = None) -> DataFrame:
    """The rows of a table or companion of it that no later merge has replaced."""
    schema = T.StructType.fromJson(held["schema"])
    chosen = _all_folders(held, buckets)
    if not chosen:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField(VERSION, T.IntegerType())])).parquet(*[f"{table}/{f}" for f in chosen])
    gone = _replaced(spark, table, state, min(map(_version_of, chosen)))
    if gone is not None:
        # A row written before rows had a version is older than any merge that names its keys.
        later = F.coalesce(rows[VERSION], F.lit(0)) < gone["__gone"]
        rows = rows.join(gone, (rows[state["key"]] == gone[state["key"]]) & later, "left_anti")
    return rows.select(schema.names)


def resolve(spark: SparkSession, table: str) -> DataFrame:
    """The table as of the last commit."""
    state = _read_pointer(spark, table)
    if state is None:
        raise FileNotFoundError(f"no published table at {table}")
    return _read_folders(spark, table, state, state)


def lookup(spark: SparkSession, table: str, keys: DataFrame) -> DataFrame:
    """The rows of the table that hold one of `keys`, read only from the folders they hash to.

    At most one number per folder comes to the driver. Rows lie sorted by key, so a handful of
    keys pushed into the scan skips most of a folder as well.
    """
    state = _read_pointer(spark, table)
    if state is None:
        raise FileNotFoundError(f"no published table at {table}")
    key = state["key"]
    wanted = keys.select(key).distinct()
    folders = {str(row[0]) for row in wanted.select(_bucket_of(key, state["buckets"])).distinct().collect()}
    rows = _read_folders(spark, table, state, state, folders)
    few = [row[0] for row in wanted.limit(_PUSHED_KEYS + 1).collect()]
    if len(few) <= _PUSHED_KEYS:
        return rows.where(F.col(key).isin(few))
    return rows.join(broadcast_if_small(wanted), key, "left_semi")


def settings(spark: SparkSession, table: str) -> dict[str, dict]:
    """The companions of the last commit, by name, and the settings each was made with."""
    state = _read_pointer(spark, table) or {}
    return {name: one["settings"] for name, one in state.get("companions", {}).items()}


def companion(spark: SparkSession, table: str, name: str) -> DataFrame:
    """A companion as of the last commit."""
    state = _read_pointer(spark, table)
    if state is None or name not in state.get("companions", {}):
        raise FileNotFoundError(f"no {name} is kept with the table at {table}")
    return _read_folders(spark, table, state, state["companions"][name])


def version(spark: SparkSession, table: str) -> int:
    """The version of the last commit; 0 for a table that was never published."""
    state = _read_pointer(spark, table)
    return state["version"] if state else 0


def _note_replaced(keys: DataFrame, table: str, version: int) -> tuple[int, dict]:
    """Write the keys that a merge replaces; returns how many they are and how the state names them."""
    folder = f"replaced-v={version}"
    keys.withColumn(VERSION, F.lit(version)).write.mode("overwrite").option("compression", CODEC).parquet(f"{table}/{folder}")
    stored = keys.sparkSession.read.schema(keys.schema).parquet(f"{table}/{folder}")
    return stored.count(), {"version": version, "folder": folder, "bytes": data_bytes(stored)}


def merge_into(
    updates: DataFrame, table: str, companions: Iterable[Companion] = (), commit: tuple[str, int] | None = None, **merge
) -> int:
    """Upsert `updates` and commit; only buckets holding their keys get new folders, of the rows that change unless it is time to write them anew.

    A key that is null or comes twice fails the merge. `updates` is read several times, its keys are written to scratch space once. `commit` is a
    source and a growing number; a merge that is repeated under a number already committed does nothing.
    """
    spark = updates.sparkSession
    state = _read_pointer(spark, table)
    if state is None:
        raise FileNotFoundError(f"no published table at {table}")
    if commit and state.get("commits", {}).get(commit[0], -1) >= commit[1]:
        return state["version"]
    key, buckets = state["key"], state["buckets"]
    schema = T.StructType.fromJson(state["schema"])
    updates = in_types_of(updates, schema)
    keys = materialize(updates.select(key), "keys")
    _check_keys(keys, key)
    touched = {str(row[0]) for row in keys.select(_bucket_of(key, buckets)).distinct().collect()}
    if not touched:
        return state["version"]
    number, asked = state["version"] + 1, broadcast_if_small(keys)
    rows = _read_folders(spark, table, state, state, touched)
    replaced, note = _note_replaced(rows.select(key).join(asked, key, "left_semi"), table, number)
    many = max((len(state.get("older", {}).get(b, [])) for b in touched), default=0) >= _MOST_OLDER or 2 * replaced > rows.count()
    anew = many or not is_small(note["bytes"] + sum(one["bytes"] for one in state.get("replaced", [])))
    merged = upsert(rows if anew else rows.join(asked, key, "left_semi"), updates, key=key, **merge)
    written = _write_buckets(merged, table, f"v={number}", number, key, buckets, schema, [key])
    before = state
    state = state | {"version": number} | _added(state, written, touched if anew else set())
    if replaced and not anew:
        state["replaced"] = [*state.get("replaced", []), note]
    state["companions"] = _derived(spark, table, state, before, written, companions, asked if anew else None)
    held = [f for one in (state, *state["companions"].values()) for f in _all_folders(one)]
    state["replaced"] = [one for one in state.get("replaced", []) if one["version"] > min(map(_version_of, held))]
    state["commits"] = state.get("commits", {}) | ({commit[0]: commit[1]} if commit else {})
    _swap_pointer(spark, table, state)
    return number
