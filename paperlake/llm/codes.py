"""Vector code compression: product codes of integer vectors, with codebooks from member-resident Lloyd rounds.

Components become floor(4096 * x); vectors are cut into `POSITIONS` equal consecutive parts. Every part is a member
of one owner, (position, entry, salt), and lies with it in written files. A round measures the members against the codebook
where they lie, in one pass without a shuffle: members that keep their entry stay and are summed up; those whose entry
changes are written apart, and only they are shuffled to their new owners, which add them to their sums.
Each entry then becomes the floor of its members' mean. Salts cut an entry that holds most parts into many owners.

What reaches the driver are sums of `positions x entries` entries. Each round is a written table, the one before it is
removed. Codes and errors of vectors come from the final codebooks, in one pass over the vectors.

Defined results: rows whose vector is null or holds null or non-finite components are left out. Shorter vectors are filled
up with zeros to the longest, and that to a multiple of `positions`; an empty vector is a vector of zeros. Integers are
kept within +-2^24 (|x| < 4096), so all sums fit a long. Repeated ids are rows of their own; equal smallest ids go by their
vectors, null ids come last. With fewer rows than entries the codebooks are as long as the rows. An empty table gives an
empty result. All columns are kept; columns that are named like the added ones are replaced.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperlake.session import materialize, parts_for, probe, remove_folder, scratch_path, ship_package

POSITIONS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
LIMIT = 1 << 24
#: Members of one owner, about.
OWNER_ROWS = 1 << 18
_ADDED = ("code", "error", "label_error", "codebooks_sha256")
_PART = "position int, entry int, salt int, part array<int>"
_STATE = f"kind int, {_PART}, members long, sums array<long>"
_STAYS, _LEAVES, _SUMS = 0, 1, 2


def integers(vector: Column) -> Column:
    """floor(4096 * x) of every component, in double precision."""
    scaled = lambda x: F.greatest(F.least(x.cast("double") * SCALE, F.lit(float(LIMIT))), F.lit(-float(LIMIT)))
    return F.transform(vector, lambda x: F.floor(scaled(x)).cast("int"))


def is_whole(vector: Column) -> Column:
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return vector.isNotNull() & F.forall(vector, lambda x: F.coalesce(number(x.cast("double")), F.lit(False)))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(column), width)


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of each part (ties to the lower index) and the squared distance, exactly."""
    largest = int(np.abs(parts).max(initial=0)) + int(np.abs(book).max(initial=0))
    kind = np.float64 if parts.shape[1] * largest**2 < 1 << 52 else np.int64  # doubles where they are exact
    parts, book = parts.astype(kind), book.astype(kind)
    far = (parts * parts).sum(1)[:, None] - 2 * (parts @ book.T) + (book * book).sum(1)[None]
    entry = np.argmin(far, 1)
    return entry, far[np.arange(len(parts)), entry].astype(np.int64)


class _Sums:
    """Sums of members by (position, entry)."""

    def __init__(self, shape: tuple[int, int, int]):
        self.counts = np.zeros(shape[:2], np.int64)
        self.sums = np.zeros(shape, np.int64)

    def add(self, position: np.ndarray, entry: np.ndarray, parts: np.ndarray) -> None:
        np.add.at(self.counts, (position, entry), 1)
        order = np.argsort(position * self.counts.shape[1] + entry, kind="stable")
        owner = (position * self.counts.shape[1] + entry)[order]
        starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else np.zeros(0, int)
        if len(starts):
            self.sums.reshape(-1, self.sums.shape[2])[owner[starts]] += np.add.reduceat(parts[order], starts)

    def batch(self) -> pa.RecordBatch:
        position, entry = np.nonzero(self.counts)
        n, nothing = len(position), lambda kind: pa.nulls(len(position), kind)
        fixed = {"kind": pa.array(np.full(n, _SUMS), pa.int32()), "position": pa.array(position, pa.int32()), "entry": pa.array(entry, pa.int32())}
        sums = pa.array(list(self.sums[position, entry]), pa.list_(pa.int64()))
        left = {"salt": nothing(pa.int32()), "part": nothing(pa.list_(pa.int32())), "members": pa.array(self.counts[position, entry])}
        return pa.record_batch(fixed | left | {"sums": sums})


def _rows(kind: int, position, entry, salt, parts: np.ndarray) -> pa.RecordBatch:
    n, width = parts.shape
    cells = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(parts.ravel(), pa.int32()))
    small = {"kind": np.full(n, kind), "position": position, "entry": entry, "salt": salt}
    columns = {name: pa.array(value, pa.int32()) for name, value in small.items()}
    return pa.record_batch(columns | {"part": cells, "members": pa.nulls(n, pa.int64()), "sums": pa.nulls(n, pa.list_(pa.int64()))})


def _first_owners(rows: DataFrame, books, salts: int) -> DataFrame:
    """Every part of every vector with its first owner. Salts go by the place in the task, which reads written files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book, seen = books.value, 0
        for batch in batches:
            whole = _matrix(batch.column("ints"), book.shape[0] * book.shape[2])
            salt = (np.arange(len(whole)) + seen) % salts
            seen += len(whole)
            for p in range(len(book)):
                parts = whole[:, p * book.shape[2] : (p + 1) * book.shape[2]]
                yield _rows(_LEAVES, np.full(len(parts), p), nearest(parts, book[p])[0], salt, parts)

    return rows.select("ints").mapInArrow(run, _STATE)


def _measured(members: DataFrame, books) -> DataFrame:
    """One pass over the members where they lie: those that stay, those that leave (with their new entry), sums of what stays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = books.value
        stay = _Sums(book.shape)
        for batch in batches:
            position, entry, salt = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("position", "entry", "salt"))
            parts = _matrix(batch.column("part"), book.shape[2])
            new = entry.copy()
            for p in np.unique(position):
                here = position == p
                new[here] = nearest(parts[here], book[p])[0]
            same = new == entry
            stay.add(position[same], entry[same], parts[same])
            for kind, rows in ((_STAYS, same), (_LEAVES, ~same)):
                yield _rows(kind, position[rows], new[rows], salt[rows], parts[rows])
        yield stay.batch()

    return members.mapInArrow(run, _STATE)


def _arrived(leavers: DataFrame, shape: tuple[int, int, int]) -> DataFrame:
    """Members at their new owners, and the sums of them that each task of owners has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        came = _Sums(shape)
        for batch in batches:
            position, entry, salt = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("position", "entry", "salt"))
            parts = _matrix(batch.column("part"), shape[2])
            came.add(position, entry, parts)
            yield _rows(_STAYS, position, entry, salt, parts)
        yield came.batch()

    moved = leavers.select("position", "entry", "salt", "part").repartition("position", "entry", "salt")
    return moved.mapInArrow(run, _STATE)


class _Round:
    """The written tables of a round: members by whether they stay, and arrivals."""

    def __init__(self, spark):
        self.spark, self.paths = spark, []

    def write(self, frame: DataFrame) -> DataFrame:
        path = scratch_path(self.spark, "codes")
        frame.write.partitionBy("kind").option("compression", "zstd").parquet(path)
        self.paths.append(path)
        return self.spark.read.schema(_STATE).parquet(path)

    def remove(self) -> None:
        for path in self.paths:
            remove_folder(self.spark, path)


def _updated(tables: list[DataFrame], book: np.ndarray) -> np.ndarray:
    """Entries as the floor of their members' mean; entries without members stay."""
    sums = tables[0]
    for other in tables[1:]:
        sums = sums.unionByName(other)
    sums = sums.where(F.col("kind") == _SUMS)
    each = sums.select("position", "entry", "members", F.posexplode("sums").alias("place", "value"))
    total = each.groupBy("position", "entry", "place").agg(F.sum("members").alias("n"), F.sum("value").alias("value"))
    book = book.copy()
    for row in total.collect():  # positions x entries x width
        book[row["position"], row["entry"], row["place"]] = row["value"] // row["n"]
    return book


def train(rows: DataFrame, vec_id: str = "vec_id", positions: int = POSITIONS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (position x entry x component) of a written table with integer vectors in `ints`."""
    spark = rows.sparkSession
    start = rows.orderBy(F.col(vec_id).asc_nulls_last(), "ints").select("ints").limit(entries).collect()
    if not start:
        return np.zeros((positions, 0, 0), np.int64)
    book = np.array([row["ints"] for row in start], np.int64).reshape(len(start), positions, -1).transpose(1, 0, 2)
    salts = parts_for(rows.count(), OWNER_ROWS, 16, 1 << 20)
    before, members = None, None
    for _ in range(rounds):
        books, now = spark.sparkContext.broadcast(book), _Round(spark)
        if members is None:
            held = [now.write(_arrived(_first_owners(rows, books, salts), book.shape))]
        else:
            measured = now.write(_measured(members, books))
            held = [measured, now.write(_arrived(measured.where(F.col("kind") == _LEAVES), book.shape))]
        book = _updated(held, book)
        members = [table.where(F.col("kind") == _STAYS).select("position", "entry", "salt", "part") for table in held]
        members = members[0] if len(members) == 1 else members[0].unionByName(members[1])
        if before:
            before.remove()
        before = now
    if before:
        before.remove()
    return book


def encode(rows: DataFrame, book: np.ndarray) -> DataFrame:
    """Adds code and error to rows with integer vectors in `ints`."""
    held = rows.sparkSession.sparkContext.broadcast(book)

    def run(column: pa.Array) -> pa.Array:
        book = held.value
        whole = _matrix(column, book.shape[0] * book.shape[2])
        codes, error = [], np.zeros(len(whole), np.int64)
        for p in range(len(book)):
            entry, far = nearest(whole[:, p * book.shape[2] : (p + 1) * book.shape[2]], book[p])
            codes.append(entry)
            error += far
        digits = [bytes(row).hex() for row in np.stack(codes, 1).astype(np.uint8)] if len(whole) else []
        return pa.StructArray.from_arrays([pa.array(digits, pa.string()), pa.array(error)], ["code", "error"])

    run.__annotations__ = {"column": pa.Array, "return": pa.Array}
    coded = F.arrow_udf(run, "struct<code: string, error: long>").asNondeterministic()
    out = rows.withColumn("__coded", coded("ints"))
    return out.withColumns({"code": F.col("__coded.code"), "error": F.col("__coded.error")}).drop("__coded")


def compress(
    table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
    positions: int = POSITIONS, entries: int = ENTRIES, rounds: int = ROUNDS,
) -> DataFrame:
    """The kept rows with code, error (squared, over all parts), label_error (its sum over equal labels) and codebooks_sha256."""
    ship_package(table.sparkSession)
    names = [name for name in table.columns if name not in _ADDED]
    kept = table.select(*names).where(is_whole(F.col(vector)))
    width = kept.agg(F.max(F.size(vector)).alias("width")).first()["width"] or 0
    width = max(1, -(-width // positions)) * positions
    filled = F.concat(integers(F.col(vector)), F.array_repeat(F.lit(0), F.lit(width) - F.size(vector)))
    rows = materialize(kept.select(F.struct(*names).alias("row"), F.col(vec_id).alias("id"), filled.alias("ints")), "codes-rows")
    book = train(rows, "id", positions, entries, rounds)
    coded = encode(rows, book).select("row", "id", "code", "error")
    group = F.coalesce(F.concat(F.lit("="), F.col(f"row.`{label}`").cast("string")), F.lit(""))
    coded = materialize(coded.withColumns({"group": group, "place": F.monotonically_increasing_id()}), "codes-rows")
    sums = coded.groupBy("group").agg(F.sum(F.col("error").cast("decimal(38,0)")).cast("long").alias("label_error"))
    joined = probe(coded, sums, "group", "place")
    digest = hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()
    columns = [F.col(f"row.`{name}`").alias(name) for name in names]
    return joined.select(*columns, "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
