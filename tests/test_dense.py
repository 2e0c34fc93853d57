import itertools

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from paperlake.functions.vectors import cosine_distance, text_to_vector, vector_to_text
from paperlake.operators.dense import (
    dense_search, dense_search_approx, hyperplanes, lsh_cells, nearest_flips, read_lsh_table, write_lsh_table,
)
from paperlake.operators.topk import TopK

DIM = 16


def brute_force(docs, queries, k):
    """(query_id, paper_id, rank) by plain loops."""
    out = set()
    for query_id, q in queries:
        scored = []
        for paper_id, v in docs:
            usable = v is not None and np.linalg.norm(v) > 0
            d = round(1 - float(np.dot(q, v) / np.linalg.norm(q) / np.linalg.norm(v)), 9) if usable else np.inf
            scored.append((d, paper_id))
        out |= {(query_id, paper_id, rank) for rank, (_, paper_id) in enumerate(sorted(scored)[:k], 1)}
    return out


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(0)
    centers = rng.standard_normal((6, DIM))
    docs = [(f"p{i:04d}", (centers[i % 6] + 0.5 * rng.standard_normal(DIM)).astype(np.float32).tolist()) for i in range(300)]
    # A third of the table are copies of one vector; some rows have none.
    docs += [(f"copy{i:04d}", docs[0][1]) for i in range(150)]
    docs += [("none", None), ("zero", [0.0] * DIM)]
    queries = [(i, docs[i * 7][1]) for i in range(12)]
    return docs, queries


@pytest.fixture(scope="module")
def frames(spark, data):
    docs, queries = data
    vectors = "embedding array<float>"
    return (
        spark.createDataFrame(docs, f"paper_id string, {vectors}").repartition(5),
        spark.createDataFrame(queries + [(99, None)], f"query_id long, {vectors}"),
    )


def ranked(df):
    return {(r.query_id, r.paper_id, r.rank_dense) for r in df.collect()}


def test_exact_search(data, frames):
    assert ranked(dense_search(*frames, k=20)) == brute_force(*data, 20)


def test_exact_search_in_blocks(data, frames):
    found = dense_search(*frames, k=20, query_block=5)
    assert ranked(found) == brute_force(*data, 20)


def test_rows_without_vector_fill_up_the_ranks(spark, frames):
    few = spark.createDataFrame([("b", None), ("a", None), ("c", [1.0] * DIM)], "paper_id string, embedding array<float>")
    for block in (None, 1):
        found = dense_search(few, frames[1].where("query_id = 0"), k=20, query_block=block)
        assert [r.paper_id for r in found.orderBy("rank_dense").collect()] == ["c", "a", "b"]


def test_smaller_k_is_a_prefix(frames):
    five, six = ranked(dense_search(*frames, k=5)), ranked(dense_search(*frames, k=6))
    assert five == {row for row in six if row[2] <= 5}


def test_no_queries_or_no_documents(frames):
    docs, queries = frames
    assert dense_search(docs, queries.where("false")).count() == 0
    assert dense_search(docs.where("false"), queries).count() == 0
    assert dense_search_approx(docs, queries.where("false"), dim=DIM).count() == 0


def test_plan_has_no_cross_join_and_cuts_early(frames, plan):
    text = plan(dense_search(*frames)).split("== Physical Plan ==")[1]
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert "WindowGroupLimit" in text


def test_blocks_follow_the_broadcast_limit(data, frames):
    found = dense_search(*frames, k=20, broadcast_limit=1000)
    assert ranked(found) == brute_force(*data, 20)


def test_vectors_of_unequal_length_are_refused(spark, frames):
    ragged = spark.createDataFrame([("a", [1.0, 0.0, 0.0]), ("b", [1.0])], "paper_id string, embedding array<float>").coalesce(1)
    asked = spark.createDataFrame([(1, [1.0, 0.0])], "query_id long, embedding array<float>")
    with pytest.raises(Exception, match="components"):
        dense_search(ragged, asked).collect()
    with pytest.raises(Exception, match="components"):
        dense_search(frames[0], asked).collect()


def test_approximate_search_is_exact_when_every_cell_is_probed(data, frames):
    docs, queries = data
    expected = brute_force([d for d in docs if d[1] is not None and any(d[1])], queries, 10)
    options = dict(k=10, dim=DIM, bits=4, probes=16, tables=2)
    assert ranked(dense_search_approx(*frames, **options)) == expected
    assert ranked(dense_search_approx(*frames, **options, query_block=4)) == expected


def test_stored_and_plain_documents_agree_and_find_most(spark, data, frames, tmp_path, plan):
    """Clustered vectors: nine of ten neighbours, reading less than half of the rows."""
    docs, queries = frames
    stored = write_lsh_table(docs, str(tmp_path / "lsh"), DIM, bits=6, tables=3)
    found = dense_search_approx(stored, queries, k=20, probes=6)
    text = plan(found)
    assert "PartitionFilters: [cell" in text or "PartitionFilters: [isnotnull(cell" in text
    assert ranked(found) == ranked(dense_search_approx(docs, queries, k=20, dim=DIM, bits=6, tables=3, probes=6, query_block=5))
    exact = {r[:2] for r in brute_force(*data, 20)}
    recall = len(exact & {r[:2] for r in ranked(found)}) / len(exact)
    cells = {r.paper_id: set(r.cells) for r in docs.select("paper_id", lsh_cells(F.col("embedding"), DIM, 6, tables=3).alias("cells")).collect() if r.cells}
    planes, shares = hyperplanes(DIM, 6, 7, 3), []
    for _, q in data[1]:
        unit = np.asarray(q, np.float64) / np.linalg.norm(q)
        near = set()
        for t in range(3):
            own = int(((planes[t] @ unit > 0) @ (1 << np.arange(6))))
            near |= {(t << 6) + (own ^ f) for f in nearest_flips(planes[t] @ unit, 6)}
        shares.append(sum(bool(c & near) for c in cells.values()) / len(cells))
    print(f"recall@20 {recall:.2f}, share of rows read {np.mean(shares):.2f}")
    assert recall >= 0.9 and np.mean(shares) < 0.5


def test_a_stored_table_knows_how_it_was_made(spark, frames, tmp_path):
    path = str(tmp_path / "lsh")
    write_lsh_table(frames[0], path, DIM, bits=5, seed=3, tables=2)
    stored = read_lsh_table(spark, path)
    assert (stored.dim, stored.bits, stored.seed, stored.tables) == (DIM, 5, 3, 2)
    with pytest.raises(ValueError, match="made with"):
        dense_search_approx(stored, frames[1], bits=8)
    assert stored.rows.columns == ["paper_id", "embedding", "cell"]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):  # what readers use is never written over
        write_lsh_table(frames[0], path, DIM, bits=5)


@pytest.mark.parametrize("block", [None, 5])
def test_approximate_search_is_exact_within_the_probed_cells(data, frames, block):
    docs, queries = data
    bits, probes, planes = 4, 5, hyperplanes(DIM, 4, 7)[0]
    side = lambda v: tuple((planes @ (np.asarray(v, dtype=np.float64) / np.linalg.norm(v))) > 0)
    expected = set()
    for query_id, q in queries:
        margin = planes @ (np.asarray(q, dtype=np.float64) / np.linalg.norm(q))
        away = {}
        for cell in itertools.product([False, True], repeat=bits):
            away[cell] = sum(m * m for m, own, other in zip(margin, margin > 0, cell) if own != other)
        near = set(sorted(away, key=away.get)[:probes])
        kept = [d for d in docs if d[1] is not None and any(d[1]) and side(d[1]) in near]
        expected |= brute_force(kept, [(query_id, q)], 10)
    found = dense_search_approx(*frames, k=10, dim=DIM, bits=bits, probes=probes, tables=1, query_block=block)
    assert ranked(found) == expected


def test_cells_are_probed_in_order_of_distance():
    rng = np.random.default_rng(1)
    for bits in (1, 3, 7):
        margin = rng.standard_normal(bits)
        away = lambda flips: sum(margin[b] ** 2 for b in range(bits) if flips >> b & 1)  # noqa: E731,B023
        found = nearest_flips(margin, 1 << bits)
        assert sorted(found) == list(range(1 << bits)) and found == sorted(found, key=away)
        assert nearest_flips(margin, 3) == found[:3]


def test_cells_of_missing_vectors_are_null(frames):
    cells = frames[0].select("paper_id", lsh_cells(F.col("embedding"), DIM, 4).alias("cells"))
    assert {r.paper_id for r in cells.where("cells IS NULL").collect()} == {"none", "zero"}


def test_merging_batches_in_any_cut_gives_the_same_rows(data):
    docs, queries = data
    matrix = np.array([q for _, q in queries], dtype=np.float64)
    matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
    results = []
    for size in (1, 7, 1000):
        topk = TopK(matrix, 9)
        for start in range(0, len(docs), size):
            part = docs[start : start + size]
            topk.add(pa.array([p for p, _ in part]), pa.array([v for _, v in part], pa.list_(pa.float32())))
        query, ids, _ = topk.result()
        results.append(set(zip(query.tolist(), ids.tolist())))
    assert results[0] == results[1] == results[2]


def test_distance_column(spark):
    rows = [([1.0, 0.0], [2.0, 0.0]), ([1.0, 0.0], [0.0, 3.0]), ([0.0, 0.0], [1.0, 0.0]), (None, [1.0, 0.0])]
    frame = spark.createDataFrame(rows, "a array<float>, b array<float>")
    assert [r[0] for r in frame.select(cosine_distance(F.col("a"), F.col("b"))).collect()] == [0.0, 1.0, None, None]


def test_vector_text(spark):
    frame = spark.createDataFrame([([0.1, -2.5e-8],), (None,)], "v array<float>")
    text = vector_to_text(F.col("v"))
    back = frame.select("v", text.alias("t"), text_to_vector(text).alias("b")).collect()
    assert back[0].v == back[0].b and back[0].t.startswith("[0.1,") and back[1].t is None
