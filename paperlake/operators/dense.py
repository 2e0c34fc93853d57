"""Vector search for a table of queries: exact, and approximate by locality-sensitive hashing."""

import heapq
import math
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperlake import constants as K
from paperlake import session
from paperlake.operators.dedupe import top_per_group
from paperlake.operators.topk import TopK, scan, vector_matrix
from paperlake.session import data_bytes, materialize

CELL = "cell"
#: Rows that a search may shuffle: tasks x queries x k.
_SHUFFLED_ROWS = 100_000_000


class LshTable(NamedTuple):
    """Documents once per hash table in the cells of their vector, and how the cells were made."""

    rows: DataFrame
    dim: int
    bits: int
    seed: int
    tables: int


def _candidate_schema(docs: DataFrame, queries: DataFrame) -> T.StructType:
    return T.StructType(
        [
            T.StructField("query_id", queries.schema["query_id"].dataType),
            T.StructField("paper_id", docs.schema["paper_id"].dataType),
            T.StructField("distance", T.DoubleType()),
        ]
    )


def _rank(candidates: DataFrame, k: int) -> DataFrame:
    order = [F.col("distance").asc_nulls_last(), F.col("paper_id")]
    return top_per_group(candidates, ["query_id"], order, k, "rank_dense").withColumn(
        "rank_dense", F.col("rank_dense").cast("long")
    )


def _query_side(queries: DataFrame) -> DataFrame:
    return queries.where(F.col("embedding").isNotNull()).select("query_id", "embedding")


def _collect_queries(queries: DataFrame) -> tuple[pa.Array, np.ndarray]:
    """Ids and unit vectors of a query table whose size has been checked."""
    table = queries.toArrow()
    matrix, rows = vector_matrix(table.column("embedding"))
    return table.column("query_id").combine_chunks().take(pa.array(rows)), matrix


def _scan_with_broadcast(docs: DataFrame, ids: pa.Array, matrix: np.ndarray, k: int, schema, cells=None) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast((ids, matrix, cells))

    def search(batches):
        query_ids, vectors, probes = shared.value
        return scan(batches, TopK(vectors, k, once=probes is not None), query_ids, probes)

    return docs.mapInArrow(search, schema)


def _blocks(queries: DataFrame, limit: int | None, rows: int | None) -> list[DataFrame]:
    """The queries as they are if they can be broadcast, else cut by hash into blocks that can."""
    limit = session.BROADCAST_BYTES if limit is None else limit
    n = math.ceil(queries.count() / rows) if rows else math.ceil(data_bytes(queries) / limit)
    if n <= 1:
        return [queries]
    number = F.pmod(F.xxhash64("query_id"), F.lit(n))
    return [queries.where(number == i) for i in range(n)]


def _in_turn(blocks: list[DataFrame], search) -> DataFrame:
    """Search block after block. The results of each are written, so no two are held at a time."""
    if len(blocks) == 1:
        return search(blocks[0])
    found = [materialize(search(block), "dense") for block in blocks]
    for other in found[1:]:
        found[0] = found[0].unionByName(other)
    return found[0]


def dense_search(
    docs: DataFrame,
    queries: DataFrame,
    k: int = K.CANDIDATES,
    broadcast_limit: int | None = None,
    query_block: int | None = None,
    max_tasks: int | None = None,
) -> DataFrame:
    """The k nearest documents of every query by cosine distance -> (query_id, paper_id, distance, rank_dense).

    Documents without a vector rank last, by id. Every task scans its share of the documents once
    against all queries and passes on only its own k best per query, so what is shuffled grows
    with tasks x queries x k and never with the documents; tasks read several splits where that
    product would be too large. Queries beyond `broadcast_limit` bytes (or `query_block` rows)
    are searched block after block, each a broadcast and a scan: documents are never copied or moved.
    """
    docs = docs.select("paper_id", "embedding")
    queries = _query_side(queries)
    schema = _candidate_schema(docs, queries)

    def search(block: DataFrame) -> DataFrame:
        ids, matrix = _collect_queries(block)
        tasks = max_tasks or max(1, _SHUFFLED_ROWS // max(1, len(ids) * k))
        return _rank(_scan_with_broadcast(docs.coalesce(tasks), ids, matrix, k, schema), k)

    return _in_turn(_blocks(queries, broadcast_limit, query_block), search)


# --- approximate search -------------------------------------------------------


def hyperplanes(dim: int, bits: int, seed: int, tables: int = 1) -> np.ndarray:
    """tables x bits x dim"""
    return np.random.default_rng(seed).standard_normal((tables, bits, dim))


def _sides(margin: np.ndarray) -> np.ndarray:
    return (margin > 0) @ (1 << np.arange(margin.shape[1]))


def nearest_flips(margin: np.ndarray, probes: int) -> list[int]:
    """Cells by distance from a vector, as the bits in which they differ from its own (multi-probe, Lv et al. 2007).

    A cell is as far away as the summed squared margins of the planes that separate it. The sets of planes
    come from a heap in order of that sum, so only `probes` of the 2 ** bits cells are ever looked at.
    """
    order = np.argsort(np.abs(margin), kind="stable")
    cost = (margin**2)[order].tolist()
    found, heap = [0], [(cost[0], (0,))]
    while heap and len(found) < probes:
        total, planes = heapq.heappop(heap)
        found.append(sum(1 << int(order[p]) for p in planes))
        last = planes[-1]
        if last + 1 < len(cost):
            heapq.heappush(heap, (total + cost[last + 1], (*planes, last + 1)))
            heapq.heappush(heap, (total - cost[last] + cost[last + 1], (*planes[:-1], last + 1)))
    return found[:probes]


def lsh_cells(vector: Column, dim: int, bits: int = 8, seed: int = 7, tables: int = 4) -> Column:
    """Cell of a vector in every hash table: the sides of `bits` random hyperplanes it lies on (Charikar 2002)."""

    @F.pandas_udf("array<int>")
    def assign(vectors: pd.Series) -> pd.Series:
        matrix, rows = vector_matrix(pa.array(vectors, pa.list_(pa.float32())), dim)
        cells = [None] * len(vectors)
        if len(rows):
            planes = hyperplanes(dim, bits, seed, tables)
            own = np.stack([(t << bits) + _sides(matrix @ planes[t].T) for t in range(tables)], 1)
            for place, row in zip(rows.tolist(), own.tolist()):
                cells[place] = row
        return pd.Series(cells, dtype=object)

    # Declared not deterministic so that the optimizer never evaluates it twice for a row.
    return assign.asNondeterministic()(vector)


def _probed(vector: Column, dim: int, bits: int, probes: int, seed: int, tables: int) -> Column:
    """The cells a query visits, its own and the nearest others of every hash table."""

    @F.pandas_udf("array<int>")
    def probe(vectors: pd.Series) -> pd.Series:
        matrix, rows = vector_matrix(pa.array(vectors, pa.list_(pa.float32())), dim)
        cells = [None] * len(vectors)
        planes = hyperplanes(dim, bits, seed, tables)
        for place, unit in zip(rows.tolist(), matrix):
            visited = []
            for t in range(tables):
                margin = planes[t] @ unit
                own = int(_sides(margin[None, :])[0])
                visited += [(t << bits) + (own ^ flips) for flips in nearest_flips(margin, probes)]
            cells[place] = visited
        return pd.Series(cells, dtype=object)

    return probe.asNondeterministic()(vector)


def _in_cells(docs: DataFrame, dim: int, bits: int, seed: int, tables: int) -> DataFrame:
    return docs.withColumn(CELL, F.explode(lsh_cells(F.col("embedding"), dim, bits, seed, tables)))


def write_lsh_table(docs: DataFrame, path: str, dim: int, bits: int = 8, seed: int = 7, tables: int = 4) -> LshTable:
    """Ids and vectors in a new folder, by cell of every hash table; a crowded cell is split over many files.

    How the cells were made is stored next to them.
    """
    spark = docs.sparkSession
    (
        _in_cells(docs.select("paper_id", "embedding"), dim, bits, seed, tables)
        .hint("rebalance", CELL)
        .write.partitionBy(CELL)
        .option("compression", "zstd")
        .parquet(f"{path}/cells")
    )
    made = spark.createDataFrame([(dim, bits, seed, tables)], "dim int, bits int, seed int, tables int")
    made.coalesce(1).write.parquet(f"{path}/made")
    return read_lsh_table(spark, path)


def read_lsh_table(spark: SparkSession, path: str) -> LshTable:
    made = spark.read.parquet(f"{path}/made").first()
    return LshTable(spark.read.parquet(f"{path}/cells"), made["dim"], made["bits"], made["seed"], made["tables"])


def dense_search_approx(
    docs: DataFrame | LshTable,
    queries: DataFrame,
    k: int = K.CANDIDATES,
    dim: int | None = None,
    bits: int | None = None,
    probes: int = 32,
    seed: int | None = None,
    tables: int | None = None,
    broadcast_limit: int | None = None,
    query_block: int | None = None,
) -> DataFrame:
    """As `dense_search`, but a query meets only documents in the `probes` cells nearest to it, in every hash table.

    Of a stored table only these cells are read; it knows how it was made, and other values are
    refused. Other documents get their cells on the way. Documents without a vector are not
    found. With `probes = 2 ** bits` the result is exact.
    """
    given = {"dim": dim, "bits": bits, "seed": seed, "tables": tables}
    if isinstance(docs, LshTable):
        made = {name: getattr(docs, name) for name in given}
        if wrong := {n: v for n, v in given.items() if v is not None and v != made[n]}:
            raise ValueError(f"the table was made with {made}, not with {wrong}")
        rows = docs.rows
    else:
        made = {"dim": K.EMBEDDING_DIM, "bits": 8, "seed": 7, "tables": 4} | {n: v for n, v in given.items() if v is not None}
        rows = _in_cells(docs.select("paper_id", "embedding"), **made)
    rows = rows.select("paper_id", "embedding", CELL)
    queries = _query_side(queries)
    schema = _candidate_schema(rows, queries)
    probes = min(probes, 1 << made["bits"])

    def search(block: DataFrame) -> DataFrame:
        visited = block.withColumn("cells", _probed(F.col("embedding"), made["dim"], made["bits"], probes, made["seed"], made["tables"]))
        table = visited.toArrow()
        matrix, usable = vector_matrix(table.column("embedding"), made["dim"])
        if not len(usable):
            return _rank(rows.sparkSession.createDataFrame([], schema), k)
        usable = pa.array(usable)
        ids = table.column("query_id").combine_chunks().take(usable)
        lists = table.column("cells").combine_chunks().take(usable)
        asking = np.repeat(np.arange(len(ids)), np.diff(lists.offsets.to_numpy()))
        values = lists.flatten().to_numpy()
        order = np.argsort(values, kind="stable")
        names, starts = np.unique(values[order], return_index=True)
        cells = dict(zip(names.tolist(), np.split(asking[order], starts[1:])))
        near = rows.where(F.col(CELL).isin(names.tolist()))
        found = _scan_with_broadcast(near, ids, matrix, k, schema, cells)
        return _rank(found.dropDuplicates(["query_id", "paper_id"]), k)  # a document may be near in several tables

    return _in_turn(_blocks(queries, broadcast_limit, query_block), search)
