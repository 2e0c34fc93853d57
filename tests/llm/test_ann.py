import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from paperlake.llm import ann

SCHEMA = "vec_id long, embedding array<double>"


def brute(rows, k=10, every=100):
    """Queries by id and vector, each against every row but one that is the query itself."""
    use = [(i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    width = max((len(v) for _, v in use), default=0)
    use = [(i, tuple(map(float, v)) + (0.0,) * (width - len(v))) for i, v in use]
    out = []
    for i, v in sorted({(i, v) for i, v in use if i % every == 0}):
        others = list(use)
        others.remove((i, v))
        near = sorted((math.dist(v, w), j) for j, w in others)[:k]
        out += [(i, rank, j, d) for rank, (d, j) in enumerate(near, 1)]
    return sorted(out)


def found(spark, rows, k=10, schema=SCHEMA, every=100, **index):
    table = spark.createDataFrame(rows, schema)
    made = ann.build_index(table, k, **index)
    return made, sorted(map(tuple, ann.search(made, table.where(F.col("vec_id") % every == 0)).collect()))


def same(ours, expected):
    assert [r[:3] for r in ours] == [r[:3] for r in expected]
    assert np.allclose([r[3] for r in ours], [r[3] for r in expected], rtol=0, atol=1e-12)


def test_clustered_vectors_reach_the_recall_with_few_lists(spark):
    rng = np.random.default_rng(3)
    centers = rng.standard_normal((40, 24))
    rows = [(i, (centers[i % 40] + 0.15 * rng.standard_normal(24)).tolist()) for i in range(4000)]
    made, ours = found(spark, rows)
    expected = brute(rows)
    hits = len({r[::2] for r in [(q, 0, v) for q, _, v, _ in ours]} & {(q, v) for q, _, v, _ in expected})
    assert hits >= 0.95 * len(expected)
    assert made.probes < len(made.centroids) / 2
    for q, _, v, score in ours:  # exactly the measure on original vectors
        assert score == pytest.approx(math.dist(rows[q][1], rows[v][1]), abs=1e-12)


@pytest.mark.parametrize("folder", ["sf0.01", "sf0.1"])
def test_recall_on_the_given_vectors(spark, folder):
    table = spark.read.parquet(f"/root/testdata/{folder}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in table.select("vec_id", "embedding").collect()]
    made = ann.build_index(table)
    ours = ann.search(made, table.where("vec_id % 100 = 0")).collect()
    expected = brute(rows)
    hits = {(r["query_id"], r["vec_id"]) for r in ours} & {(q, v) for q, _, v, _ in expected}
    assert len(ours) == len(expected) and len(hits) >= 0.95 * len(expected)


def test_copies_ties_and_repeated_rows(spark):
    copies = [(i, [1.0, 0.0, 2.0]) for i in range(0, 1500, 5)]
    rows = copies + [(200, [1.0, 0.0, 2.0]), (300, [0.0, 1.0]), (7, [-0.0, 1.0, 0.0]), (8, [0.0, 1.0, 0.0])]
    same(found(spark, rows)[1], brute(rows))


def test_rows_that_take_no_part(spark):
    rows = [(0, None), (100, [0.0, 0.0]), (200, [1.0, None]), (300, [math.nan, 1.0]), (400, [math.inf, 0.0]), (None, [1.0, 1.0]), (500, [])]
    assert found(spark, rows)[1] == []
    rows += [(600, [1.0, 1.0]), (1, [1.0, 2.0])]
    assert [r[:3] for r in found(spark, rows)[1]] == [(600, 1, 1)]
    assert found(spark, [])[1] == []


def test_segments_and_epsilon(spark, monkeypatch):
    monkeypatch.setattr(ann, "SEGMENT_ROWS", 40)
    rng = np.random.default_rng(4)
    rows = [(i, rng.standard_normal(19).tolist()) for i in range(600)]
    made = ann.build_index(spark.createDataFrame(rows, SCHEMA), 10)
    made = made._replace(probes=len(made.centroids))
    table = spark.createDataFrame(rows, SCHEMA).where("vec_id % 50 = 0")
    same(sorted(map(tuple, ann.search(made, table, epsilon=50.0).collect())), brute(rows, every=50))


def test_queries_that_find_too_few_rows_ask_again(spark):
    rows = [(i, [float(i % 3), float(i // 3), 1.0]) for i in range(0, 900)]
    table = spark.createDataFrame(rows, SCHEMA)
    made = ann.build_index(table, 10)._replace(probes=1)
    far = spark.createDataFrame([(100, [5000.0, -5000.0, 3.0])], SCHEMA)
    assert ann.search(made._replace(k=10), far).count() == 10
    assert len(ann.search(ann.build_index(table, 500)._replace(probes=1), far).collect()) == 500


def test_tests_abandon_far_rows_and_keep_near_ones():
    rng = np.random.default_rng(5)
    rotation = np.linalg.qr(rng.standard_normal((64, 64)))[0]
    vectors = rng.standard_normal((1000, 64)) * np.where(np.arange(1000) < 20, 0.2, 1.0)[:, None]
    members = pa.table({"member": pa.array([b"x"] * 1000, pa.binary()), "vec": pa.array(list(vectors), pa.list_(pa.float64())), "ids": pa.array([[i] for i in range(1000)])})
    segment = ann.Segment(members, rotation)
    query = np.zeros((1, 64)) + 0.01
    bound = np.array([np.sort(((vectors - query) ** 2).sum(1))[9]])
    q, r = segment._survivors(segment._cut(query), bound, 0, 1000, ann.EPSILON)
    assert 10 <= len(r) <= 20
    assert segment.ask(query, bound, 10, ann.EPSILON)[1].tolist() == np.argsort(((vectors - query) ** 2).sum(1))[:10].tolist()


def test_other_columns_and_types_do_not_matter(spark):
    rows = [(float(i), [float(i), 1.0], "x", i) for i in range(0, 300, 20)]
    table = spark.createDataFrame(rows, "vec_id double, embedding array<float>, key string, list int")
    ours = ann.search(ann.build_index(table, 3), table.where("vec_id = 100")).collect()
    assert [r["vec_id"] for r in ours] == [80, 120, 60]
