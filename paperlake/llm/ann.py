"""Approximate nearest neighbours by Euclidean distance: inverted lists, scanned by an adaptive number of dimensions.

Index: equal vectors are one class, kept with its k + 1 smallest ids (no query can get more of them). Every class
lies in the list of its nearest centroid. Centroids, and the number of lists that a query probes, are fitted on the
driver to at most `SAMPLE_VALUES` components of a hash sample of rows; all classes are indexed. Lists beyond
`SEGMENT_ROWS` are cut into segments by hash, so no task holds more than one segment.

Search (Gao & Long 2023, with the column blocks of Kuffo et al. 2025): query classes and list segments meet in one
shuffle. Where a segment is opened, its vectors are rotated by one random orthogonal matrix and laid out in
blocks of `BLOCK` columns. Distances grow block by block. After d of D dimensions a candidate is abandoned if its partial
distance, scaled by D / d, is above (1 + epsilon / sqrt(d))^2 times the best k-th distance known: under the hypothesis
that it is near enough, a random rotation makes that very unlikely. The first such bound comes from the sample rows in
the probed lists; each segment tightens it. Distances of what is left are computed anew from the original vectors. Queries
that find fewer than k rows, though there are more, ask all lists again without tests.

Defined results: rows without an id, and vectors that are null, zero (or empty) or hold null or non-finite
components take no part. Shorter vectors are read as if filled up with zeros. A row is a candidate of its own however
often its id or vector repeats; a query leaves out one row with its own id and vector. An id that stands with several
vectors asks with each; equal query rows ask once. Ties go to the smaller id. Other columns are not looked at.
"""

import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperlake.session import broadcast_if_small, materialize, probe, ship_package

SAMPLE_VALUES = 1 << 21
SEGMENT_ROWS = 4096
BLOCK = 8
#: Share of the neighbours of sample rows that the probed lists must hold.
RECALL = 0.98
#: Significance of the tests: larger is safer.
EPSILON = 2.1
_CHUNK, _QUERIES, _PAIRS = 1024, 256, 1 << 16


class Index(NamedTuple):
    """Classes by list (list, key, vec, ids) and what was fitted to the sample."""

    rows: DataFrame
    segments: DataFrame
    centroids: np.ndarray
    rotation: np.ndarray
    sample: np.ndarray
    probes: int
    k: int
    n: int


def matrix_of(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the usable rows, and their vectors in double precision, filled up with zeros."""
    lengths = np.asarray(pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False), np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    owner = np.repeat(np.arange(len(column)), lengths)
    bad = np.bincount(owner, ~np.isfinite(flat), len(column)) > 0
    some = np.bincount(owner, flat != 0, len(column)) > 0
    matrix = np.zeros((len(column), width))
    place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    matrix[owner, place] = flat + 0.0  # no negative zeros
    rows = np.flatnonzero(some & ~bad)
    return rows, matrix[rows]


def _lists(matrix: np.ndarray, kind: pa.DataType) -> pa.Array:
    n, width = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(matrix.ravel()).cast(kind))


def _keyed(table: DataFrame, width: int, kind: str) -> DataFrame:
    """(vec_id, key, vec) of the usable rows; equal vectors have equal keys."""
    value = pa.float32() if kind == "float" else pa.float64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, matrix = matrix_of(batch.column("embedding"), width)
            keys = [hashlib.blake2b(row.tobytes(), digest_size=16).digest() for row in matrix]
            ids = batch.column("vec_id").take(pa.array(rows, pa.int64()))
            yield pa.record_batch({"vec_id": ids, "key": pa.array(keys, pa.binary()), "vec": _lists(matrix, value)})

    return table.mapInArrow(run, f"vec_id long, key binary, vec array<{kind}>")


def _plain(table: DataFrame, vec_id: str, vector: str) -> tuple[DataFrame, str]:
    element = table.schema[vector].dataType.elementType
    kind = "float" if isinstance(element, T.FloatType) else "double"
    columns = [F.col(vec_id).try_cast("long").alias("vec_id"), F.col(vector).cast(f"array<{kind}>").alias("embedding")]
    return table.select(*columns).where("vec_id IS NOT NULL AND embedding IS NOT NULL"), kind


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T, 0)


def _nearest(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    step = max(1, (1 << 22) // max(1, len(centroids)))
    parts = [np.argmin(_squares(points[i : i + step], centroids), 1) for i in range(0, len(points), step)]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def fit_lists(sample: np.ndarray, n_lists: int, rounds: int = 8, seed: int = 5) -> np.ndarray:
    """Centroids of a sample by Lloyd's rounds; one without members stays where it is."""
    centroids = sample[np.random.default_rng(seed).choice(len(sample), n_lists, replace=False)]
    for _ in range(rounds):
        own = _nearest(sample, centroids)
        counts = np.bincount(own, minlength=n_lists)
        sums = np.stack([np.bincount(own, column, n_lists) for column in sample.T], 1)
        centroids = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centroids)
    return centroids


def probes_for(sample: np.ndarray, centroids: np.ndarray, k: int, recall: float) -> int:
    """The smallest number of nearest lists that holds a share of the k nearest rows of up to 256 sample rows."""
    if len(sample) < 2:
        return len(centroids)
    asking = np.linspace(0, len(sample) - 1, min(256, len(sample))).astype(int)
    own = _nearest(sample, centroids)
    needed = []
    for i in asking:
        far = _squares(sample[i : i + 1], sample)[0]
        far[i] = np.inf
        near = np.argpartition(far, min(k, len(far) - 1) - 1)[: min(k, len(far) - 1)]
        place = np.empty(len(centroids), np.int64)
        place[np.argsort(_squares(sample[i : i + 1], centroids)[0], kind="stable")] = np.arange(len(centroids))
        needed.append(place[own[near]])
    return int(np.quantile(np.concatenate(needed), recall, method="higher")) + 1


def build_index(
    table: DataFrame, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding", recall: float = RECALL, seed: int = 5
) -> Index:
    """Index all usable rows for searches of up to k neighbours."""
    ship_package(table.sparkSession)
    plain, kind = _plain(table, vec_id, vector)
    width = max(1, plain.agg(F.max(F.size("embedding"))).first()[0] or 1)
    most = max(256, SAMPLE_VALUES // width)
    keyed = _keyed(plain, width, kind)
    n = keyed.count()
    share = F.pmod(F.xxhash64("vec_id", "key"), F.lit(1 << 32)) < F.lit(min(1 << 32, math.ceil((1 << 32) * most / max(n, 1))))
    drawn = keyed.where(share).select("vec").limit(2 * most).toArrow().column("vec").combine_chunks()
    sample = np.unique(matrix_of(drawn, width)[1], axis=0)
    sample = np.random.default_rng(seed).permutation(sample)[:most]
    n_lists = max(1, min(math.ceil(math.sqrt(n) / 2), len(sample) // 8))
    centroids = fit_lists(sample, n_lists, seed=seed) if len(sample) else np.zeros((1, width))
    probes = probes_for(sample, centroids, k, recall)
    rotation = np.linalg.qr(np.random.default_rng(seed).standard_normal((width, width)))[0]

    held = table.sparkSession.sparkContext.broadcast(centroids)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = _nearest(matrix_of(batch.column("vec"), width)[1], held.value)
            yield pa.record_batch({"list": pa.array(lists, pa.int32())} | {c: batch.column(c) for c in ("key", "vec", "ids")})

    first = F.row_number().over(Window.partitionBy("key").orderBy("vec_id"))
    classes = keyed.withColumn("place", first).where(F.col("place") <= k + 1)
    classes = classes.groupBy("key").agg(F.first("vec").alias("vec"), F.sort_array(F.collect_list("vec_id")).alias("ids"))
    rows = materialize(classes.mapInArrow(place, f"list int, key binary, vec array<{kind}>, ids array<long>"), "ann-index")
    segments = rows.groupBy("list").agg(F.ceil(F.count("*") / SEGMENT_ROWS).cast("int").alias("n_segments"))
    return Index(rows, materialize(segments, "ann-segments"), centroids, rotation, sample, probes, k, n)


def _probed(queries: DataFrame, index: Index, kind: str, probes: int) -> DataFrame:
    """Query classes with the lists they probe and the squared distance within which k + 1 sample rows of these lists lie."""
    held = queries.sparkSession.sparkContext.broadcast((index.centroids, index.sample, _nearest(index.sample, index.centroids)))
    width, k = index.rotation.shape[0], index.k

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids, sample, own = held.value
        for whole in batches:
            for start in range(0, len(whole), 64):
                batch = whole.slice(start, 64)
                _, matrix = matrix_of(batch.column("vec"), width)
                lists = np.argsort(_squares(matrix, centroids), 1, kind="stable")[:, :probes]
                bound = np.full(len(matrix), np.inf)
                if len(sample) > k:
                    probed = np.zeros((len(matrix), len(centroids)), bool)
                    np.put_along_axis(probed, lists, True, 1)
                    far = np.where(probed[:, own], _squares(matrix, sample), np.inf)
                    bound = np.partition(far, k, 1)[:, k] * (1 + 1e-9) + 1e-12
                columns = {"key": batch.column("key"), "vec": batch.column("vec"), "bound": pa.array(bound)}
                yield pa.record_batch(columns | {"lists": _lists(lists.astype(np.int32), pa.int32())})

    return queries.mapInArrow(run, f"key binary, vec array<{kind}>, bound double, lists array<int>")


class Segment:
    """An opened list segment: original vectors, and rotated ones in column blocks."""

    def __init__(self, members: pa.Table, rotation: np.ndarray):
        self.keys = np.array(members.column("member").to_pylist(), object)
        self.ids = members.column("ids").combine_chunks()
        self.first = np.array([x[0].as_py() for x in self.ids])
        _, self.vectors = matrix_of(members.column("vec").combine_chunks(), len(rotation))
        self.rotation = rotation
        self.blocks = [np.ascontiguousarray(block) for block in self._cut(self.vectors)]
        self.norms = [(block * block).sum(1) for block in self.blocks]

    def _cut(self, vectors: np.ndarray) -> list[np.ndarray]:
        rotated = vectors @ self.rotation
        return [rotated[:, i : i + BLOCK] for i in range(0, rotated.shape[1], BLOCK)]

    def _survivors(self, asked: list[np.ndarray], bound: np.ndarray, start: int, end: int, epsilon: float) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, row) that no test abandons; blocks are dense while many pairs are left, gathered later."""
        width = len(self.rotation)
        partial = np.zeros((len(bound), end - start))
        alive = np.ones(partial.shape, bool)
        query = row = None
        for number, (mine, block, norms) in enumerate(zip(asked, self.blocks, self.norms, strict=True)):
            done = min((number + 1) * BLOCK, width)
            limit = bound * (1 + 1e-9) + 1e-12
            if done < width:
                limit = limit * (done / width) * (1 + epsilon / math.sqrt(done)) ** 2
            if query is None:
                partial += (mine * mine).sum(1)[:, None] + norms[start:end][None] - 2 * mine @ block[start:end].T
                alive &= partial <= limit[:, None]
                if alive.sum() * 4 < alive.size:
                    query, row = np.nonzero(alive)
                    partial = partial[query, row]
            else:
                difference = mine[query] - block[start:end][row]
                partial = partial + (difference * difference).sum(1)
                left = partial <= limit[query]
                query, row, partial = query[left], row[left], partial[left]
        return (query, row + start) if query is not None else (lambda at: (at[0], at[1] + start))(np.nonzero(alive))

    def ask(self, vectors: np.ndarray, bound: np.ndarray, k: int, epsilon: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, row, distance) of at most k rows for each query, nearest first."""
        asked = self._cut(vectors)
        bound = bound.copy()
        query, row, far = np.zeros(0, int), np.zeros(0, int), np.zeros(0)
        for start in range(0, len(self.vectors), _CHUNK):
            q, r = self._survivors(asked, bound, start, min(start + _CHUNK, len(self.vectors)), epsilon)
            exact = [
                np.sqrt(((vectors[q[i : i + _PAIRS]] - self.vectors[r[i : i + _PAIRS]]) ** 2).sum(1)) for i in range(0, len(q), _PAIRS)
            ]
            query, row, far = np.concatenate([query, q]), np.concatenate([row, r]), np.concatenate([far, *exact])
            order = np.lexsort((self.first[row], far, query))
            query, row, far = query[order], row[order], far[order]
            place = np.arange(len(query)) - np.searchsorted(query, query)
            full = place == k - 1
            bound[query[full]] = np.minimum(bound[query[full]], far[full] ** 2)
            kept = place < k
            query, row, far = query[kept], row[kept], far[kept]
        return query, row, far


def _scan(rotation: np.ndarray, k: int, epsilon: float):
    """Over rows sorted by segment, members first: hold one segment, let its queries pass by in batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = rotation.value
        at, members, opened = None, [], None
        for batch in batches:
            marks = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("list", "segment", "asks")], 1)
            edges = np.flatnonzero((marks[1:] != marks[:-1]).any(1)) + 1
            for start, end in zip([0, *edges], [*edges, len(batch)], strict=True):
                if end == start:
                    continue
                rows, (number, segment, asks) = batch.slice(start, end - start), marks[start]
                if (number, segment) != at:
                    at, members, opened = (number, segment), [], None
                if not asks:
                    members.append(rows)
                    continue
                if not members:
                    continue
                opened = opened or Segment(pa.Table.from_batches(members), turn)
                for i in range(0, len(rows), _QUERIES):
                    part = rows.slice(i, _QUERIES)
                    _, vectors = matrix_of(part.column("vec"), len(turn))
                    query, row, far = opened.ask(vectors, part.column("bound").to_numpy(), k, epsilon)
                    keys = part.column("key").take(pa.array(query))
                    own = np.array(keys.to_pylist(), object) == opened.keys[row]
                    found = {"key": keys, "score": pa.array(far), "own": pa.array(own.astype(bool)), "ids": opened.ids.take(pa.array(row))}
                    yield pa.record_batch(found)

    return run


def _near(index: Index, classes: DataFrame, probes: int, epsilon: float) -> DataFrame:
    """(key, near): the k + 1 nearest rows found for every query class, in order."""
    kind = index.rows.schema["vec"].dataType.elementType.simpleString()
    segments = broadcast_if_small(index.segments)
    absent = lambda kind: F.lit(None).cast(kind)
    probed = _probed(classes, index, kind, probes).withColumn("list", F.explode("lists")).join(segments, "list")
    probed = probed.withColumn("segment", F.explode(F.sequence(F.lit(0), F.col("n_segments") - 1)))
    probed = probed.select("list", "segment", F.lit(1).alias("asks"), "key", absent("binary").alias("member"), "vec", "bound", absent("array<long>").alias("ids"))
    segment = F.pmod(F.xxhash64("key"), F.col("n_segments")).cast("int")
    members = index.rows.join(segments, "list")
    members = members.select("list", segment.alias("segment"), F.lit(0).alias("asks"), absent("binary").alias("key"), F.col("key").alias("member"), "vec", absent("double").alias("bound"), "ids")
    met = members.unionByName(probed).repartition("list", "segment").sortWithinPartitions("list", "segment", "asks")
    rotation = classes.sparkSession.sparkContext.broadcast(index.rotation)
    found = met.mapInArrow(_scan(rotation, index.k + 1, epsilon), "key binary, score double, own boolean, ids array<long>")

    best = _first(found, F.col("score"), F.col("ids")[0], index.k + 1)
    best = best.select("key", "score", "own", F.explode("ids").alias("vec_id"))
    best = _first(best, F.col("score"), F.col("vec_id"), index.k + 1)
    return best.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("score", "vec_id", "own"))).alias("near"))


def search(index: Index, queries: DataFrame, query_id: str = "vec_id", vector: str = "embedding", epsilon: float = EPSILON) -> DataFrame:
    """The nearest rows found for every query -> (query_id, rank, vec_id, score), without one row that is the query itself."""
    plain, _ = _plain(queries, query_id, vector)
    kind = index.rows.schema["vec"].dataType.elementType.simpleString()
    asking = _keyed(plain, index.rotation.shape[0], kind).withColumnRenamed("vec_id", "query_id")
    asking = materialize(asking.dropDuplicates(["query_id", "key"]), "ann-queries")
    classes = asking.groupBy("key").agg(F.first("vec").alias("vec"))
    lists = materialize(_near(index, classes, index.probes, epsilon), "ann-found")
    full = lists.where(F.size("near") >= min(index.k + 1, index.n))
    short = materialize(classes.join(full, "key", "left_anti"), "ann-short")
    if not short.isEmpty():
        lists = full.unionByName(_near(index, short, len(index.centroids), math.inf))
    joined = probe(asking.select("query_id", "key"), lists, "key", "query_id")
    itself = F.array_position(F.transform("near", lambda x: x["own"] & (x["vec_id"] == F.col("query_id"))), F.lit(True))
    joined = joined.withColumn("itself", itself)
    others = F.slice(F.filter("near", lambda x, i: i + 1 != F.col("itself")), 1, index.k)
    out = joined.select("query_id", F.posexplode(others).alias("place", "one"))
    return out.select("query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("one.vec_id").alias("vec_id"), F.col("one.score").alias("score"))


def _first(rows: DataFrame, score: Column, smaller: Column, n: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("key").orderBy(score, smaller))
    return rows.withColumn("place", place).where(F.col("place") <= n).drop("place")
