import numpy as np
import pytest
from pyspark.sql import functions as F

from paperlake.operators import cells
from paperlake.operators.dense import dense_search
from paperlake.sinks import table
from suite import queries, views

DIM = 24


@pytest.fixture(scope="module")
def frames(spark):
    rng = np.random.default_rng(2)
    centers = rng.standard_normal((30, DIM))
    rows = [(str(i), (centers[i % 30] + 0.3 * rng.standard_normal(DIM)).tolist()) for i in range(900)]
    rows += [("none", None), ("zero", [0.0] * DIM)]
    asked = [(i, (centers[i] + 0.3 * rng.standard_normal(DIM)).tolist()) for i in range(12)] + [(99, None)]
    schema = "{} , embedding array<float>"
    return spark.createDataFrame(rows, schema.format("paper_id string")).repartition(3), spark.createDataFrame(asked, schema.format("query_id long"))


def ranked(df):
    return sorted(map(tuple, df.collect()))


def test_exact_with_all_cells_and_all_candidates(frames):
    docs, asked = frames
    made = cells.build_cells(docs, DIM)
    expected = ranked(dense_search(docs.where("paper_id NOT IN ('none', 'zero')"), asked))
    for options in ({}, {"query_block": 5}):
        assert ranked(cells.cell_search(made, docs, asked, rerank=1000, probes=1000, **options)) == expected


def test_clustered_vectors_are_found_in_few_cells(frames):
    docs, asked = frames
    made = cells.build_cells(docs, DIM)
    exact = {r[:2] for r in ranked(dense_search(docs.where("embedding IS NOT NULL"), asked))}
    found = {r[:2] for r in ranked(cells.cell_search(made, docs, asked, probes=4, rerank=100))}
    assert len(exact & found) >= 0.9 * len(exact)


@pytest.mark.parametrize("folder", ["sf0.01", "sf0.1"])
def test_recall_of_the_registered_query(spark, folder):
    sf = f"/root/testdata/{folder}"
    papers, asked = views.papers(spark, sf).where("embedding IS NOT NULL"), views.questions(spark, sf)
    exact = {(r.query_id, r.paper_id) for r in dense_search(papers, asked).collect()}
    found = {(r.query_id, r.paper_id) for r in queries.cells_topk(spark, sf).collect()}
    share = cells.RERANK * 20 / papers.count()
    print(f"{folder}: recall@20 {len(exact & found) / len(exact):.3f}, vectors read for a question {share:.2f}")
    assert len(exact & found) >= 0.9 * len(exact) and share < 0.3


def test_recall_of_the_lsh_query(spark):
    sf = "/root/testdata/sf0.01"
    exact = {(r.query_id, r.paper_id) for r in dense_search(views.papers(spark, sf), views.questions(spark, sf)).collect()}
    found = {(r.query_id, r.paper_id) for r in queries.lsh_topk(spark, sf).collect()}
    assert len(exact & found) >= 0.9 * len(exact)


def test_models_are_bounded_and_read_back(spark, frames, tmp_path, monkeypatch):
    docs, _ = frames
    monkeypatch.setattr(cells, "SAMPLE_ROWS", 64)
    model = cells.train(docs, DIM, entries=200)
    assert model.centroids.shape == (4, DIM) and model.books.shape == (6, 64, 4)
    back = cells.read_model(spark, cells.write_model(spark, model, str(tmp_path / "m")))
    assert (back.centroids == model.centroids).all() and (back.books == model.books).all()
    with pytest.raises(ValueError):
        cells.train(docs.where("paper_id = 'none'"), DIM)


def test_codes_follow_the_table_and_only_candidates_are_read(spark, frames, tmp_path, plan):
    docs, asked = frames
    path = str(tmp_path / "t")
    model = cells.train(docs, DIM)
    kept = table.Companion("cells", lambda rows: cells.code_rows(rows, model), ("cell",), {"model": "m"})
    table.publish(docs, path, buckets=64, companions=[kept])
    moved = docs.where("paper_id = '3'").withColumn("embedding", F.transform("embedding", lambda x: -x))
    table.merge_into(moved, path, [kept])
    state = table._read_pointer(spark, path)["companions"]["cells"]["folders"]
    assert sum(f.startswith("cells-v=2") for f in state.values()) == 1  # only the bucket of the paper was coded again
    index = cells.CellIndex(table.companion(spark, path, "cells"), model)
    found = ranked(cells.cell_search(index, table.resolve(spark, path), asked, rerank=1000, probes=1000, serving=path))
    assert found == ranked(dense_search(table.resolve(spark, path).where("paper_id NOT IN ('none', 'zero')"), asked))
    few = cells.cell_search(index, table.resolve(spark, path), asked.where("query_id = 1"), k=2, rerank=3, serving=path)
    assert "In(paper_id" in plan(few)  # the vectors of three candidates


def test_a_batch_without_vectors(spark, frames):
    docs, asked = frames
    made = cells.train(docs, DIM)
    none = docs.where("paper_id IN ('none', 'zero')").repartition(1)
    assert cells.code_rows(docs.where("paper_id = 'none'"), made).collect() == []
    assert cells.code_rows(none.unionByName(docs.where("paper_id = '5'")), made).count() == 1
