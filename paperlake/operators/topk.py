"""Nearest neighbours of many query vectors in a stream of Arrow batches (runs inside tasks)."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

DISTANCE_DIGITS = 9
_CELLS = 1 << 22


def vector_matrix(column: pa.Array, dim: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of the usable rows (not null, not zero) and the positions of those rows.

    All vectors have the same length, `dim` if it is given.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    present = np.flatnonzero(~np.asarray(column.is_null()))
    if len(present) == 0:
        return np.empty((0, 0)), present
    lengths = np.diff(column.offsets.to_numpy())[present]
    expected = lengths[0] if dim is None else dim
    if (lengths != expected).any():
        raise ValueError(f"vectors of {sorted(set(lengths.tolist()))} components where {expected} are expected")
    flat = column.take(pa.array(present)).flatten().to_numpy(zero_copy_only=False)
    matrix = flat.astype(np.float64).reshape(len(present), -1)
    norms = np.sqrt(np.einsum("ij,ij->i", matrix, matrix))
    usable = norms > 0
    return matrix[usable] / norms[usable, None], present[usable]


def _objects(ids: pa.Array, rows: np.ndarray) -> np.ndarray:
    out = np.empty(len(rows), dtype=object)
    out[:] = ids.take(pa.array(rows, pa.int64())).to_pylist()
    return out


class TopK:
    """The k nearest rows seen so far for each query, ordered by (distance, id).

    Distances are compared at nine digits, so the order of rows inside a batch cannot change
    a rank. Rows without a usable vector have no distance and come last, by id.
    """

    def __init__(self, queries: np.ndarray, k: int, once: bool = False):
        """With `once` a row that is added again (from another cell) counts a single time."""
        self.queries, self.k, self.once = queries, k, once
        self.bound = np.full(len(queries), np.inf)
        self.query = np.empty(0, dtype=np.int64)
        self.distance = np.empty(0)
        self.ids = np.empty(0, dtype=object)
        self.null_ids = np.empty(0, dtype=object)

    def add(self, ids: pa.Array, vectors: pa.Array, only: np.ndarray | None = None) -> None:
        """Take in a batch for all queries, or for the query rows `only`."""
        matrix, rows = vector_matrix(vectors, self.queries.shape[1] if len(self.queries) else None)
        if only is None:
            unusable = _objects(ids, np.setdiff1d(np.arange(len(ids)), rows))
            if len(unusable):
                self.null_ids = np.sort(np.concatenate([self.null_ids, unusable]))[: self.k]
        if len(rows) == 0:
            return
        chosen = np.arange(len(self.queries)) if only is None else only
        step = max(1, _CELLS // len(rows))
        for start in range(0, len(chosen), step):
            self._add_block(chosen[start : start + step], matrix, ids, rows)

    def _add_block(self, chosen: np.ndarray, matrix: np.ndarray, ids: pa.Array, rows: np.ndarray) -> None:
        self.offer(chosen, np.round(1.0 - self.queries[chosen] @ matrix.T, DISTANCE_DIGITS) + 0.0, ids, rows)

    def offer(self, chosen: np.ndarray, distance: np.ndarray, ids: pa.Array, rows: np.ndarray) -> None:
        """Take in the distances (chosen queries x rows) of some rows of a batch."""
        bound = self.bound[chosen]
        if distance.shape[1] > self.k:
            bound = np.minimum(bound, np.partition(distance, self.k - 1, axis=1)[:, self.k - 1])
        q, row = np.nonzero(distance <= bound[:, None])
        if len(q) == 0:
            return
        near, place = np.unique(row, return_inverse=True)  # only ids of rows that come near leave Arrow
        self._merge(chosen[q], distance[q, row], _objects(ids, rows[near])[place])

    def _merge(self, query: np.ndarray, distance: np.ndarray, ids: np.ndarray) -> None:
        changed = np.isin(self.query, query)
        query = np.concatenate([self.query[changed], query])
        distance = np.concatenate([self.distance[changed], distance])
        ids = np.concatenate([self.ids[changed], ids])
        order = np.lexsort((np.unique(ids, return_inverse=True)[1], distance, query))
        query, distance, ids = query[order], distance[order], ids[order]
        if self.once and len(query):
            new = np.r_[True, (query[1:] != query[:-1]) | (ids[1:] != ids[:-1])]
            query, distance, ids = query[new], distance[new], ids[new]
        starts = np.flatnonzero(np.r_[True, query[1:] != query[:-1]])
        place = np.arange(len(query)) - np.repeat(starts, np.diff(np.r_[starts, len(query)]))
        full = place == self.k - 1
        self.bound[query[full]] = distance[full]
        keep = place < self.k
        self.query = np.concatenate([self.query[~changed], query[keep]])
        self.distance = np.concatenate([self.distance[~changed], distance[keep]])
        self.ids = np.concatenate([self.ids[~changed], ids[keep]])

    def result(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query row, id, distance); queries short of k rows are filled with rows without distance."""
        query, ids, distance = self.query, self.ids, self.distance
        if len(self.null_ids):
            found = np.bincount(query, minlength=len(self.queries))
            short = np.flatnonzero(found < self.k)
            fill = np.minimum(self.k - found[short], len(self.null_ids))
            query = np.concatenate([query, np.repeat(short, fill)])
            ids = np.concatenate([ids] + [self.null_ids[:n] for n in fill])
            distance = np.concatenate([distance, np.full(fill.sum(), np.nan)])
        return query, ids, distance


def to_batch(query_ids: pa.Array, result: tuple, id_type: pa.DataType) -> pa.RecordBatch:
    query, ids, distance = result
    return pa.record_batch(
        {
            "query_id": query_ids.take(pa.array(query, pa.int64())),
            "paper_id": pa.array(ids.tolist(), id_type),
            "distance": pa.array(distance, pa.float64(), from_pandas=True),
        }
    )


def scan(batches: Iterator[pa.RecordBatch], topk: TopK, query_ids: pa.Array, cells: dict | None) -> Iterator[pa.RecordBatch]:
    """Fold all batches of a task and emit at most k rows per query.

    With `cells` (cell -> query rows that probe it) a row only meets the queries of its cell.
    """
    id_type = None
    for batch in batches:
        ids, vectors = batch.column("paper_id"), batch.column("embedding")
        id_type = ids.type
        if cells is None:
            topk.add(ids, vectors)
            continue
        cell = batch.column("cell").to_numpy(zero_copy_only=False)
        for value in np.unique(cell):
            if value in cells:
                rows = pa.array(np.flatnonzero(cell == value))
                topk.add(ids.take(rows), vectors.take(rows), cells[value])
    if id_type is not None:
        yield to_batch(query_ids, topk.result(), id_type)
