import datetime
import re

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paperlake.operators import keyword as kw
from paperlake.operators.context import build_context, target_model
from paperlake.operators.dense import dense_search_approx
from paperlake.operators.fusion import best_fused, rrf, rrf_score
from paperlake.plans.search import hybrid_search, result_counts
from paperlake.sinks import table

RANKED = "query_id long, paper_id string, {} long"


def test_published_scores(spark):
    frame = spark.createDataFrame([(1, 999), (2, 999), (3, 999)], "d long, s long")
    scores = [r[0] for r in frame.select(rrf_score(F.col("d"), F.col("s"))).collect()]
    assert scores == [0.017337729686218054, 0.01707331932133175, 0.016817302936283106]


@given(st.integers(1, 999), st.integers(1, 999))
def test_score_is_symmetric_and_falls_with_rank(a, b):
    score = lambda x, y: 1 / (60 + x) + 1 / (60 + y)
    assert score(a, b) == score(b, a) and score(a + 1, b) < score(a, b)


def test_fusion(spark):
    dense = spark.createDataFrame([(0, "b", 1), (0, "c", 2)], RANKED.format("rank_dense"))
    sparse = spark.createDataFrame([(0, "a", 1), (0, "c", 2), (1, "z", 1)], RANKED.format("rank_sparse"))
    fused = rrf(dense, sparse)
    assert {(r.query_id, r.paper_id): (r.rank_dense, r.rank_sparse) for r in fused.collect()} == {
        (0, "a"): (999, 1), (0, "b"): (1, 999), (0, "c"): (2, 2), (1, "z"): (999, 1)
    }
    best = best_fused(fused, 3).where("query_id = 0").orderBy("place").collect()
    assert [r.paper_id for r in best] == ["c", "a", "b"], "equal scores go by id"


@pytest.fixture(scope="module")
def corpus(spark):
    day = datetime.date(2024, 1, 1)
    rows = [
        ("1", "Graph nets", "deep graph networks", "u1", day, [1.0, 0.0], '{"core_method":"m"}'),
        ("2", "Cakes", "graph of ovens", "u2", None, [0.0, 1.0], None),
        ("3", "Other", "nothing shared", "u3", day, None, None),
    ]
    schema = "paper_id string, title string, abstract string, url string, published_date date, embedding array<float>, metadata string"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def queries(spark):
    rows = [(0, "graph", [0.0, 2.0], "gpt-4o"), (1, "zebra", [1.0, 0.1], None)]
    return spark.createDataFrame(rows, "query_id long, text string, embedding array<float>, model_tag string")


def test_hybrid_search(corpus, queries):
    rows = hybrid_search(corpus, queries, limit=2).orderBy("query_id", "place").collect()
    assert [(r.query_id, r.place, r.paper_id) for r in rows] == [(0, 1, "1"), (0, 2, "2"), (1, 1, "1"), (1, 2, "2")]
    assert (rows[0].rank_dense, rows[0].rank_sparse, rows[1].rank_dense) == (2, 1, 1), "equal scores go by id"
    assert rows[2].rank_sparse == 999 and rows[0].title == "Graph nets" and "metadata" not in rows[0]


def test_hybrid_search_on_a_stored_index(corpus, queries, tmp_path):
    index = kw.write_index(corpus, str(tmp_path / "i"), stem="english", buckets=2)
    by = ["query_id", "place"]
    expected = hybrid_search(corpus, queries, with_metadata=True).orderBy(by).collect()
    table.publish(corpus, str(tmp_path / "t"), buckets=4)
    dense = dense_search_approx(corpus, queries, dim=2, bits=2, probes=4)
    stored = hybrid_search(corpus, queries, with_metadata=True, index=index, serving=str(tmp_path / "t"))
    assert stored.orderBy(by).collect() == expected
    near = hybrid_search(corpus, queries, with_metadata=True, index=index, dense=dense, limit=2)
    assert near.orderBy(by).collect() == [r for r in expected if r.place <= 2]


def test_plain_text_is_read_as_a_search_box_in_word_stems(spark, corpus):
    asked = [(0, "networking graphs", {"1"}), (1, '"graph nets"', {"1"}), (2, "ovens -cake or networks", {"1"}), (3, "oven", {"2"})]
    queries = spark.createDataFrame([(i, text, [1.0, 0.0]) for i, text, _ in asked], "query_id long, text string, embedding array<float>")
    found = {}
    for row in hybrid_search(corpus, queries).where("rank_sparse < 999").collect():
        found.setdefault(row.query_id, set()).add(row.paper_id)
    assert found == {i: papers for i, _, papers in asked}
    with pytest.raises(kw.WordForms):
        hybrid_search(corpus, queries, index=kw.build_index(corpus))


@pytest.mark.parametrize("limit", [0, 51])
def test_limit_is_checked(corpus, queries, limit):
    with pytest.raises(ValueError):
        hybrid_search(corpus, queries, limit=limit)


def test_counts_cover_questions_without_results(spark, queries):
    results = spark.createDataFrame([(0, "a"), (0, "b")], "query_id long, paper_id string")
    assert dict(result_counts(queries, results).collect()) == {0: 2, 1: 0}


def test_prompt(corpus, queries):
    found = hybrid_search(corpus, queries, limit=2, with_metadata=True).where("query_id = 0")
    with_match, without = build_context(queries, found).orderBy("query_id").collect()
    assert with_match.prompt == (
        "Context:\n"
        '[1] Title: Graph nets\nAbstract: deep graph networks\nURL: u1\n\nStructured Metadata: {"core_method":"m"}\n\n'
        "[2] Title: Cakes\nAbstract: graph of ovens\nURL: u2\n\n\n"
        "\n\nQuestion: graph"
    )
    assert [tuple(m) for m in with_match.matched] == [
        ("1", "Graph nets", "2024-01-01", '{"core_method":"m"}'), ("2", "Cakes", None, None)
    ]
    assert with_match.model == "openai/gpt-4o"
    assert without.prompt == "Context:\nNo specific matching papers found in the local database.\n\nQuestion: zebra"
    assert without.matched == [] and without.model == "google/gemini-3.7-flash"


def test_unknown_tag_gets_the_default(spark):
    frame = spark.createDataFrame([("nope",), (None,), ("DeepSeek-V3",)], "tag string")
    models = [r[0] for r in frame.select(target_model(F.col("tag"))).collect()]
    assert models == ["google/gemini-3.7-flash"] * 2 + ["deepseek/deepseek-chat"]


def test_only_ranked_papers_are_moved_for_their_texts(corpus, queries, plan):
    dealt = hybrid_search(corpus.repartition(3, "paper_id"), queries)
    assert sorted(dealt.collect()) == sorted(hybrid_search(corpus, queries).collect())
    text = plan(dealt).split("== Physical Plan ==")[1]
    assert re.search(r"paper_id#\d+ IN", text[text.index("REPARTITION_BY_NUM") :])
