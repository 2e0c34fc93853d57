"""Approximate vector search on codes: k-means cells, product-quantised residuals, exact re-ranking of the best codes.

Unit vectors become integers, floor(4096 * x), so that training and code distances are exact sums and any engine finds the same
ones. A bounded sample gives the centroids of the cells and, for every run of `PART` components of what a centroid
leaves over, a codebook (Jegou et al. 2011). A paper is stored as its cell and one byte per run. A search sums up, for the papers in
the cells nearest to a question, distances looked up by code, and reads only the `rerank` best vectors of each question
to rank them exactly. Codes are a companion of the keyed table (sinks/table.py), so they follow its rows.
"""

import math
import uuid
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperlake import constants as K
from paperlake.functions.vectors import cosine_distance
from paperlake.operators.dedupe import top_per_group
from paperlake.operators.dense import _blocks, _candidate_schema, _collect_queries, _in_turn, _query_side, _rank
from paperlake.operators.topk import DISTANCE_DIGITS, TopK, to_batch, vector_matrix
from paperlake.session import broadcast_if_small, materialize, probe
from paperlake.sinks import table

SCALE = 4096
#: Vectors that a model is fitted to at most: the first ones in the order of the MD5 of their id.
SAMPLE_ROWS = 4096
PART, ENTRIES, ROUNDS = 4, 64, 4
#: Share of the cells that a question probes, and how many vectors are read for each result.
PROBED, RERANK = 0.85, 5
_QUERIES = 256


class CellModel(NamedTuple):
    """Centroids (cell x component) and codebooks (run x entry x component), in integers."""

    centroids: np.ndarray
    books: np.ndarray


class CellIndex(NamedTuple):
    """Rows (paper_id, cell, code), and the model they were made with."""

    rows: DataFrame
    model: CellModel


def integers(units: np.ndarray) -> np.ndarray:
    return np.floor(units * SCALE).astype(np.int64)


def _squares(points: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distances; exact, as integers of this size are exact in double precision."""
    points, book = points.astype(np.float64), book.astype(np.float64)
    return (points * points).sum(1)[:, None] - 2 * points @ book.T + (book * book).sum(1)[None]


def _fit(points: np.ndarray, entries: int, rounds: int) -> np.ndarray:
    """Lloyd's rounds from the first points; means are floored, and an entry without points stays."""
    book = points[:entries].copy()
    for _ in range(rounds):
        own = np.argmin(_squares(points, book), 1)
        counts = np.bincount(own, minlength=len(book))
        sums = np.zeros_like(book)
        np.add.at(sums, own, points)
        book = np.where(counts[:, None] > 0, sums // np.maximum(counts, 1)[:, None], book)
    return book


def _runs(matrix: np.ndarray) -> np.ndarray:
    """run x row x component; the last run is filled up with zeros."""
    filled = np.pad(matrix, ((0, 0), (0, -matrix.shape[1] % PART)))
    return filled.reshape(len(filled), filled.shape[1] // PART, PART).transpose(1, 0, 2)


def train(docs: DataFrame, dim: int = K.EMBEDDING_DIM, cells: int | None = None, entries: int = ENTRIES, rounds: int = ROUNDS) -> CellModel:
    """Fit a model to at most `SAMPLE_ROWS` vectors. As many cells as half the root of the number of vectors."""
    vectors = docs.where(F.col("embedding").isNotNull()).select("paper_id", "embedding", F.md5(F.col("paper_id").cast("string")).alias("place"))
    n = vectors.count()
    cells = cells or max(1, min(math.ceil(math.sqrt(n) / 2), SAMPLE_ROWS // 16))
    share = min(1.0, 4 * SAMPLE_ROWS / max(n, 1))  # what is sorted is not the whole table
    drawn = vectors.where(F.conv(F.substring("place", 1, 8), 16, 10).cast("double") < share * 2.0**32)
    sample = drawn.orderBy("place", "paper_id").limit(SAMPLE_ROWS).toArrow()
    units, _ = vector_matrix(sample.column("embedding"), dim)
    if not len(units):
        raise ValueError("a model needs vectors")
    whole = integers(units)
    centroids = _fit(whole, cells, rounds)
    left = whole - centroids[np.argmin(_squares(whole, centroids), 1)]
    return CellModel(centroids, np.stack([_fit(run, entries, rounds) for run in _runs(left)]))


def write_model(spark: SparkSession, model: CellModel, path: str) -> str:
    """Store a model in a new folder below `path`, and return that folder."""
    rows = [("cell", 0, i, row.tolist()) for i, row in enumerate(model.centroids)]
    rows += [("run", r, e, entry.tolist()) for r, book in enumerate(model.books) for e, entry in enumerate(book)]
    folder = f"{path}/{uuid.uuid4().hex}"
    spark.createDataFrame(rows, "kind string, run int, entry int, vector array<long>").coalesce(1).write.parquet(folder)
    return folder


def read_model(spark: SparkSession, path: str) -> CellModel:
    rows = sorted(map(tuple, spark.read.parquet(path).collect()))
    books = [[v for _, r, _, v in rows_of] for rows_of in _by_run(rows)]
    return CellModel(np.array([v for kind, _, _, v in rows if kind == "cell"], np.int64), np.array(books, np.int64))


def _by_run(rows: list[tuple]) -> list[list[tuple]]:
    runs: dict[int, list[tuple]] = {}
    for row in rows:
        if row[0] == "run":
            runs.setdefault(row[1], []).append(row)
    return list(runs.values())


def code_rows(docs: DataFrame, model: CellModel) -> DataFrame:
    """(paper_id, cell, code) of the papers with a vector."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["paper_id"].dataType.simpleString()

    def run(batches):
        centroids, books = held.value
        for batch in batches:
            units, rows = vector_matrix(batch.column("embedding"), centroids.shape[1])
            whole = integers(units) if len(rows) else np.zeros((0, centroids.shape[1]), np.int64)
            cell = np.argmin(_squares(whole, centroids), 1)
            code = np.stack([np.argmin(_squares(part, book), 1) for part, book in zip(_runs(whole - centroids[cell]), books, strict=True)], 1)
            codes = [row.tobytes() for row in code.astype(np.uint8)]
            yield pa.record_batch(
                {"paper_id": batch.column("paper_id").take(pa.array(rows, pa.int64())), "cell": pa.array(cell, pa.int32()), "code": pa.array(codes, pa.binary())}
            )

    return docs.select("paper_id", "embedding").mapInArrow(run, f"paper_id {kind}, cell int, code binary")


def build_cells(docs: DataFrame, dim: int = K.EMBEDDING_DIM, **model) -> CellIndex:
    """A model and the codes of a table of papers, not kept with it."""
    made = train(docs, dim, **model)
    return CellIndex(materialize(code_rows(docs, made).repartition("cell").sortWithinPartitions("cell"), "cells"), made)


def _scan_codes(rows: DataFrame, ids: pa.Array, questions: np.ndarray, model: CellModel, probes: int, best: int, schema) -> DataFrame:
    """The `best` papers of every question by code distance in each task."""
    far = _squares(questions, model.centroids)
    near = np.argsort(far, 1, kind="stable")[:, :probes]
    asking = {int(c): np.flatnonzero((near == c).any(1)) for c in np.unique(near)}
    shared = rows.sparkSession.sparkContext.broadcast((ids, questions, model, asking))

    def search(batches):
        query_ids, whole, (centroids, books), probing = shared.value
        top, kind = TopK(np.zeros((len(whole), 1)), best), None
        for batch in batches:
            kind = batch.column("paper_id").type
            cell = batch.column("cell").to_numpy(zero_copy_only=False)
            codes = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(len(batch), len(books))
            for c in np.unique(cell):
                here, asked = np.flatnonzero(cell == c), probing.get(int(c), np.zeros(0, int))
                for start in range(0, len(asked), _QUERIES):
                    chosen = asked[start : start + _QUERIES]
                    distance = np.zeros((len(chosen), len(here)))
                    for run, (part, book) in enumerate(zip(_runs(whole[chosen] - centroids[c]), books, strict=True)):
                        distance += _squares(part, book)[:, codes[here, run]]
                    top.offer(chosen, distance, batch.column("paper_id"), here)
        if kind is not None:
            yield to_batch(query_ids, top.result(), kind)

    return rows.where(F.col("cell").isin([int(c) for c in asking])).mapInArrow(search, schema)


def cell_search(
    index: CellIndex,
    docs: DataFrame,
    queries: DataFrame,
    k: int = K.CANDIDATES,
    rerank: int | None = None,
    probes: int | None = None,
    serving: str | None = None,
    broadcast_limit: int | None = None,
    query_block: int | None = None,
) -> DataFrame:
    """The k nearest papers found for every query by cosine distance -> (query_id, paper_id, distance, rank_dense).

    Codes are scanned once per block of queries; what is shuffled are `rerank` rows per query and task. Only the vectors of
    these candidates are read, from the keyed table at `serving` if it is given.
    Papers without a vector are not found. With all cells and as many candidates as papers the result is exact.
    """
    rerank = rerank or RERANK * k
    probes = probes or math.ceil(PROBED * len(index.model.centroids))
    queries = _query_side(queries)
    schema = _candidate_schema(docs, queries)

    def search(block: DataFrame) -> DataFrame:
        ids, units = _collect_queries(block)
        if not len(units):
            return _rank(docs.sparkSession.createDataFrame([], schema), k)
        found = _scan_codes(index.rows, ids, integers(units), index.model, probes, rerank, schema)
        best = top_per_group(found, ["query_id"], [F.col("distance"), F.col("paper_id")], rerank, "place")
        best = materialize(best.select("query_id", "paper_id"), "candidates")
        vectors = (table.lookup(docs.sparkSession, serving, best) if serving else docs).select("paper_id", "embedding")
        met = probe(vectors, best, "paper_id", "paper_id")
        asked = broadcast_if_small(block.select("query_id", F.col("embedding").alias("asked")))
        exact = F.round(cosine_distance(F.col("embedding"), F.col("asked")), DISTANCE_DIGITS) + F.lit(0.0)
        return _rank(met.join(asked, "query_id").select("query_id", "paper_id", exact.alias("distance")), k)

    return _in_turn(_blocks(queries, broadcast_limit, query_block), search)
