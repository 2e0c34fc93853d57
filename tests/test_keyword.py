import math
import random
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paperlake import session
from paperlake.constants import STOP_WORDS
from paperlake.functions.tokens import index_terms, plain_stem
from paperlake.operators import keyword as kw
from paperlake.session import probe
from paperlake.sinks import table
from paperlake.sources import lake
from suite import views

PAPERS = [
    ("1", "Deep learning", "Networks of layers. Learning networks is hard."),
    ("2", "Shallow learning", "No layers at all"),
    ("3", "Cooking", "A layer of the cake, deep in the oven"),
    ("4", None, "deep deep learning"),
    ("5", "", ""),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(PAPERS, "paper_id string, title string, abstract string")


def ask(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "query_id long, text string")


def found(df):
    out = {}
    for row in df.orderBy("query_id", "rank_sparse").collect():
        out.setdefault(row.query_id, []).append(row.paper_id)
    return out


def search(docs, terms, **options):
    return kw.keyword_search(kw.scan_index(docs, terms), terms, **options)


def test_all_words_are_required(spark, docs):
    terms = kw.question_terms(ask(spark, "the deep learning", "learning layers", "oven zebra", "of the", ""))
    result = found(search(docs, terms))
    assert set(result) == {0, 1} and set(result[0]) == {"1", "4"} and set(result[1]) == {"1", "2"}


def test_score_is_bm25(spark, docs):
    terms = kw.question_terms(ask(spark, "deep"))
    scores = {r.paper_id: r.score for r in search(docs, terms).collect()}
    lengths = {"1": 7, "2": 3, "3": 5, "4": 3, "5": 0}
    average = sum(lengths.values()) / 5
    idf = math.log(1 + (5 - 3 + 0.5) / (3 + 0.5))
    for paper, tf in (("1", 1), ("3", 1), ("4", 2)):
        norm = tf + 1.2 * (0.25 + 0.75 * lengths[paper] / average)
        assert scores[paper] == pytest.approx(idf * tf * 2.2 / norm, abs=1e-9)


def test_any_word(spark, docs):
    result = found(search(docs, kw.any_terms(ask(spark, "oven learning"))))
    assert set(result[0]) == {"1", "2", "3", "4"} and result[0][0] == "3"


def test_phrase_counts_stop_words_as_places(spark, docs):
    asked = ask(spark, "deep learning", "layer of the cake", "layer cake", "learning networks", "deep in oven")
    result = found(search(docs, kw.phrase_terms(asked)))
    # "learning networks" also spans the end of the title and the start of the abstract.
    assert {q: set(p) for q, p in result.items()} == {0: {"1", "4"}, 1: {"3"}, 3: {"1"}}


def test_negation_and_alternatives(spark, docs):
    rows = [
        (0, 0, "learning", False), (0, 0, "shallow", True),
        (1, 0, "oven", False), (1, 1, "shallow", False), (1, 1, "learning", False), (1, 2, "zebra", False),
        (2, 0, "deep", True),
    ]
    terms = spark.createDataFrame(rows, "query_id long, alt int, term string, negated boolean")
    result = found(search(docs, terms))
    assert {q: set(p) for q, p in result.items()} == {0: {"1", "4"}, 1: {"2", "3"}}


def test_two_phrases_and_a_word(spark, docs):
    rows = [(0, "deep", 0, 0), (0, "learning", 1, 0), (0, "networks", 0, 1), (0, "layers", 2, 1), (0, "hard", 0, None)]
    terms = spark.createDataFrame(rows, "query_id long, term string, pos int, phrase int")
    assert found(search(docs, terms)) == {0: ["1"]}
    broken = terms.withColumn("pos", F.when(F.col("term") == "layers", 1).otherwise(F.col("pos")))
    assert found(search(docs, broken)) == {}


def test_weights_change_the_order(spark, docs):
    terms = kw.any_terms(ask(spark, "learning"))
    plain = found(search(docs, terms))[0]
    boosted = found(search(docs, terms, weights={"title": 0.1, "abstract": 5.0}))[0]
    assert (plain, boosted) == (["1", "2", "4"], ["4", "1", "2"])


def test_cut_and_ties(spark):
    same = spark.createDataFrame([(f"{i:03d}", "word", "") for i in range(50)], "paper_id string, title string, abstract string")
    rows = search(same.repartition(7), kw.question_terms(ask(spark, "word")), k=20).orderBy("rank_sparse").collect()
    assert [r.paper_id for r in rows] == [f"{i:03d}" for i in range(20)]


def test_stored_index_gives_the_same_answers(spark, docs, tmp_path, plan):
    index = kw.write_index(docs, str(tmp_path / "index"), buckets=4)
    asked = ask(spark, "deep learning", "layers", "oven")
    for terms in (kw.question_terms(asked), kw.any_terms(asked), kw.phrase_terms(asked)):
        stored = kw.keyword_search(kw.lookup(index, terms), terms)
        assert sorted(stored.collect()) == sorted(search(docs, terms).collect())
    few = plan(kw.lookup(index, kw.question_terms(asked)).postings)
    assert re.search(r"PartitionFilters: \[[^\]]*term_bucket", few) and "In(term" in few
    many = spark.range(30).select(F.lit(0).alias("query_id"), F.concat(F.lit("w"), "id").alias("term"))
    assert kw.lookup(index, many).postings.count() == 0
    assert tuple(index.corpus.select("n_docs", "avg_dl").first()) == (5, 18 / 5)


def test_index_rows(spark, docs):
    rows = {(r.term, r.paper_id): (r.title_tf, r.abstract_tf, r.positions, r.dl) for r in kw.build_index(docs).postings.collect()}
    assert rows["learning", "1"] == (1, 1, [1, 5], 7)
    assert rows["deep", "4"] == (0, 2, [0, 1], 3)
    assert ("the", "3") not in rows and ("", "5") not in rows


def test_postings_are_formed_without_a_shuffle(spark, docs, plan):
    """Grouped in the row of the paper, and stored with one exchange of one row per (term, paper)."""
    text = plan(kw.paper_postings(docs)).split("== Physical Plan ==")[1]
    assert "Exchange" not in text and "Aggregate" not in text
    counts = kw.paper_postings(docs).groupBy("term", "paper_id").count()
    assert counts.where("count > 1").count() == 0


def test_postings_equal_those_of_plain_loops(spark, plan):
    """Empty and missing texts, stop words, words of one form, few of the terms; and no step that runs for every place of a word."""
    pick = random.Random(3)
    text = lambda n: " ".join(pick.choices(["the", "of", "net", "nets", "Layer", "layers", "é", "x1", "ties", "-"], k=n))
    papers = [(str(i), text(i % 7), text(i * 5 % 90)) for i in range(60)] + [("n", None, None), ("e", "", "the of"), ("t", "net", None), (None, "nets", "x1")]
    docs = spark.createDataFrame(papers, "paper_id string, title string, abstract string").repartition(2)
    for stem in (False, True):
        for only in (None, ["net", "layers", "tie", "zebra"], []):
            expected = []
            for paper_id, title, abstract in papers:
                in_title, rest = (re.findall(r"[^\W_]+", (t or "").lower()) for t in (title, abstract))
                places = {}
                for pos, word in enumerate(in_title + rest):
                    if word not in STOP_WORDS:
                        places.setdefault(plain_stem(word) if stem else word, []).append(pos)
                dl = sum(map(len, places.values()))
                for term, at in places.items():
                    if only is None or term in only:
                        n = sum(pos < len(in_title) for pos in at)
                        expected.append((term, paper_id, n, len(at) - n, at, dl))
                expected.append(("", paper_id, 0, 0, [], dl))
            got = [tuple(r) for r in kw.paper_postings(docs, stem, only).collect()]
            assert sorted(got, key=repr) == sorted(expected, key=repr), (stem, only)
    text = plan(kw.paper_postings(docs)).split("== Physical Plan ==")[1]
    assert "transform(" not in text and "sort_array(" not in text


def test_papers_of_a_large_table_are_indexed_in_parts_of_their_bytes(spark, tmp_path, monkeypatch):
    """Where a join shuffles the texts, adaptive execution would leave a part for each core or 64 MB, and all postings of it to one task."""
    documents = spark.range(4000).selectExpr("id AS doc_id", "concat('word', id, ' of text') AS text", "'en' AS lang", "'s' AS source", "12L AS n_chars")
    documents.write.parquet(f"{tmp_path}/documents.parquet")
    spark.range(0, 4000, 2).selectExpr("id AS vec_id", "array(1f, 2f) AS embedding").write.parquet(f"{tmp_path}/embeddings.parquet")
    monkeypatch.setattr(lake, "WIDEN_BYTES", 0)
    monkeypatch.setattr(lake, "_KEYED_BYTES", 1 << 9, raising=False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = kw.paper_postings(views.papers(spark, str(tmp_path)))
        parts = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(parts) == 3 * 4000 and len(parts) > 16 and max(parts) < 2000


def test_plain_questions_are_aggregated_once_by_question_and_paper(spark, docs, plan):
    terms = kw.any_terms(ask(spark, "deep learning", "oven"))
    text = plan(kw.match_terms(kw.scan_index(docs, terms), terms)).split("== Physical Plan ==")[1]
    assert "(paper_id" not in text.replace("hashpartitioning(query_id", "") or text.count("hashpartitioning(query_id") <= 1
    assert text.count("hashpartitioning(query_id") == 1


def test_an_index_kept_with_a_table_equals_a_new_one(spark, docs, tmp_path):
    """Replaced papers are found by their new words only, new papers are found, totals follow."""
    path = str(tmp_path / "table")
    text = table.Companion("text", kw.paper_postings, ("term",), {"stem": False})
    table.publish(docs, path, buckets=4, companions=[text])
    now = docs
    for change in ([("1", "cats", "only cats"), ("9", "graph", "deep graph")], [("9", "dogs", ""), ("2", "cats", "")]):
        changed = spark.createDataFrame(change, docs.schema)
        now = now.join(changed, "paper_id", "left_anti").unionByName(changed)
        table.merge_into(changed, path, [text])
        index, fresh = kw.kept_index(table.companion(spark, path, "text")), kw.build_index(now)
        terms = kw.any_terms(ask(spark, "deep learning", "cats", "graph", "networks dogs"))
        assert sorted(kw.keyword_search(kw.lookup(index, terms), terms).collect()) == sorted(kw.keyword_search(fresh, terms).collect())
        assert tuple(index.corpus.first()) == tuple(fresh.corpus.first())


def test_a_companion_that_is_not_kept_up_is_dropped(spark, docs, tmp_path):
    path = str(tmp_path / "table")
    text = table.Companion("text", kw.paper_postings, ("term",), {"stem": False})
    table.publish(docs, path, buckets=4, companions=[text])
    table.merge_into(docs.limit(1), path)
    with pytest.raises(FileNotFoundError):
        table.companion(spark, path, "text")
    table.merge_into(docs.limit(1), path, [text])  # derived from all rows again
    assert table.companion(spark, path, "text").where("term = ''").count() == docs.count()
    other = text._replace(derive=lambda rows: kw.paper_postings(rows, True), settings={"stem": True})
    table.merge_into(docs.limit(1), path, [other])
    assert table.settings(spark, path) == {"text": {"stem": True}}
    assert not table.companion(spark, path, "text").where("term = 'layers'").count()


def test_a_merge_derives_only_what_its_own_rows_need(spark, docs, tmp_path, monkeypatch):
    """What is kept of other rows of a bucket moves along, whether the keys are broadcast or not; other columns derive all anew."""
    path, columns = str(tmp_path / "table"), ["paper_id", "n"]

    def made(n, *more):
        return table.Companion("text", lambda rows: rows.select("paper_id", F.lit(n).alias("n"), *map(F.lit, more)), ("paper_id",), {})

    held = lambda: sorted(tuple(r) for r in table.companion(spark, path, "text").select(columns).collect())
    table.publish(docs, path, buckets=2, companions=[made(0)])
    change = spark.createDataFrame([("2", "cats", "x"), ("9", "dogs", "y"), ("3", "birds", None)], docs.schema)
    table.merge_into(change, path, [made(1)])
    assert held() == [("1", 0), ("2", 1), ("3", 1), ("4", 0), ("5", 0), ("9", 1)]
    monkeypatch.setattr(session, "BROADCAST_BYTES", 0)
    table.merge_into(change.where("paper_id = '9'"), path, [made(2)])
    assert held() == [("1", 0), ("2", 1), ("3", 1), ("4", 0), ("5", 0), ("9", 2)]
    table.merge_into(change.where("paper_id = '9'"), path, [made(3, "more")])
    assert {n for _, n in held()} == {3}


def test_candidates_give_the_same_answers_as_all_postings(spark, docs):
    """With an alternative given, every posting is looked at; without, only papers with the rarest term."""
    asked = ask(spark, "the deep learning deep", "layers", "oven zebra", "learning layers networks")
    for terms in (kw.question_terms(asked), kw.phrase_terms(asked)):
        everything = terms.withColumn("alt", F.lit(0))
        assert sorted(search(docs, terms).collect()) == sorted(search(docs, everything).collect())


def test_terms_made_from_text_are_complete(spark, docs):
    asked = ask(spark, "the deep learning deep", "layers", "")
    for terms in (kw.question_terms(asked), kw.any_terms(asked)):
        bare = terms.drop("required", "scores")
        columns = ["query_id", "term", "alt", "negated", "required", "scores"]
        complete = lambda t: sorted(tuple(r) for r in kw._prepared_terms(t).select(columns).collect())
        assert complete(terms) == complete(bare)
        assert sorted(search(docs, terms).collect()) == sorted(search(docs, bare).collect())


def test_text_is_split_once(docs, plan):
    """No filter is inferred that would run the word pattern a second time in the scan."""
    text = plan(kw.paper_postings(docs)).split("== Physical Plan ==")[1]
    assert text.count("regexp_extract_all") == 2  # title and abstract


def test_light_stem(spark):
    words = "queries ponies boxes classes cats bus glass goes trees shoes"
    assert index_terms(ask(spark, words), "text", stem=True).first().terms == "query pony boxe classe cat bus glass goe tree shoe".split()


def test_stemmed_search(spark, docs):
    terms = kw.question_terms(ask(spark, "layer"), stem=True)
    assert set(found(kw.keyword_search(kw.scan_index(docs, terms, stem=True), terms))[0]) == {"1", "2", "3"}


def test_large_term_tables_are_joined_by_shuffle(spark, docs, monkeypatch):
    """Any word, all words, phrases and forbidden words, with every join by key and salt."""
    rows = [(0, 0, "learning", False), (0, 0, "shallow", True), (1, 0, "oven", False), (1, 1, "deep", False)]
    asked = ask(spark, "deep learning", "oven")
    terms = [kw.any_terms(asked), kw.question_terms(asked), kw.phrase_terms(asked), spark.createDataFrame(rows, "query_id long, alt int, term string, negated boolean")]
    expected = [sorted(search(docs, t).collect()) for t in terms]
    monkeypatch.setattr("paperlake.session.BROADCAST_BYTES", -1)
    assert [sorted(search(docs, t).collect()) for t in terms] == expected


def parse(text):
    """The search box in plain Python, character by character: (alternative, negated, words of a piece)."""
    pieces, i = [], 0
    while i < len(text):
        if text[i].isspace():
            i += 1
            continue
        start = i
        while i < len(text) and text[i] == "-":
            i += 1
        if i < len(text) and text[i] == '"':
            end = text.find('"', i + 1)
            i = len(text) if end < 0 else end + 1
        else:
            while i < len(text) and not text[i].isspace() and text[i] != '"':
                i += 1
        pieces.append(text[start:i])
    alt, rows = 0, set()
    for number, piece in enumerate(pieces):
        if piece.lower() == "or":
            alt += 1
            continue
        kept = [(pos, w) for pos, w in enumerate(re.findall(r"[a-z0-9]+", piece.lower())) if w not in STOP_WORDS]
        for pos, word in kept:
            rows.add((word, alt, piece.startswith("-"), number if len(kept) > 1 else None, pos if len(kept) > 1 else 0))
    return rows


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(['"', "-", "or", "OR", " ", "  ", "a", "graph", "deep", "cats", "-dogs", "nets-2", '""', "\n"]), max_size=14).map("".join), min_size=25, max_size=25))
def test_search_terms_equal_a_plain_parser(spark, texts):
    found = {}
    for r in kw.search_terms(ask(spark, *texts)).collect():
        found.setdefault(r.query_id, set()).add((r.term, r.alt, r.negated, r.phrase, r.pos))
    assert found == {i: rows for i, text in enumerate(texts) if (rows := parse(text))}


def test_what_is_typed_is_found(spark):
    schema = "paper_id string, title string, abstract string"
    papers = spark.createDataFrame([("1", "deep graph nets", "cats"), ("2", "graph deep", "dogs"), ("3", "cats dogs", ""), ("4", "graph", "nets of cats")], schema)
    typed = {
        "deep graph": {"1", "2"}, '"deep graph"': {"1"}, '"deep graph': {"1"}, "deep -cats": {"2"}, "dogs or nets": {"1", "2", "3", "4"},
        'graph -"deep graph"': {"2", "4"}, 'graph -"deep cats"': {"1", "2", "4"}, "or deep or": {"1", "2"}, "- deep": {"1", "2"}, "-deep": set(),
        '"nets of cats"': {"4"}, "deep-graph": {"1"}, '""': set(), "": set(), 'cats -dogs or "graph deep"': {"1", "2", "4"}, "graph -deep-graph": {"2", "4"},
    }
    terms = kw.search_terms(ask(spark, *typed))
    hits = {}
    for r in kw.keyword_search(kw.scan_index(papers, terms), terms).collect():
        hits.setdefault(r.query_id, set()).add(r.paper_id)
    assert [hits.get(i, set()) for i in range(len(typed))] == list(typed.values())


def test_bounded_search_equals_the_whole_one(spark):
    pick = random.Random(3)
    words = [f"w{i}" for i in range(120)]
    weights = [1 / (i + 1) for i in range(120)]
    rows = [(str(i), " ".join(pick.choices(words, weights, k=4)), " ".join(pick.choices(words, weights, k=pick.randint(0, 60)))) for i in range(900)]
    papers = spark.createDataFrame(rows, "paper_id string, title string, abstract string")
    asked = ask(spark, *[" ".join(pick.sample(words, n)) for n in (1, 1, 2, 2, 3, 5, 12)], "nothing", "")
    terms = kw.any_terms(asked)
    index = kw.scan_index(papers, terms)
    for options in ({}, {"k": 3, "block_papers": 1, "seeds": 1}, {"block_papers": 50}, {"weights": {"title": 3.0, "abstract": 0.5}}):
        k, w = options.pop("k", 20), options.pop("weights", None)
        assert sorted(kw.bounded_search(index, terms, k, w, **options).collect()) == sorted(kw.keyword_search(index, terms, k, w).collect())


def test_bounds_keep_most_rows_out_of_the_scores(spark, monkeypatch):
    """Of the rows that the whole search sums up by question and paper, less than half meet their postings."""
    sf, scored = "/root/testdata/sf0.1", []
    terms = kw.any_terms(views.questions(spark, sf))
    index = kw.scan_index(views.papers(spark, sf), terms)
    whole = index.postings.join(F.broadcast(terms.select("query_id", "term")), "term").count()

    def watch(big, small, key, spread_by, *args, **kwargs):
        out = probe(big, small, key, spread_by, *args, **kwargs)
        if key == "key":
            scored.append(out.count())
        return out

    monkeypatch.setattr(kw, "probe", watch)
    kw.bounded_search(index, terms)
    print(f"rows scored {sum(scored)} of {whole}")
    assert len(scored) == 2 and sum(scored) < whole / 2


def test_a_candidate_meets_only_the_terms_of_its_question(spark, plan):
    """Candidates are joined to postings by paper and term; by paper alone each would meet every asked posting of the paper."""
    many = " ".join(f"word{i}" for i in range(40))
    docs = spark.createDataFrame([(str(i), "t", many) for i in range(20)] + [("x", "t", "word1")], "paper_id string, title string, abstract string")
    asked = spark.createDataFrame([(i, f"word{i} word{i + 1}") for i in range(39)], "query_id long, text string")
    terms = kw.question_terms(asked)
    found = kw.match_terms(kw.scan_index(docs, terms), terms)
    assert sorted({(r.query_id, r.paper_id) for r in found.collect()}) == sorted((q, str(i)) for q in range(39) for i in range(20))
    joins = [line for line in plan(found).split("== Physical Plan ==")[1].splitlines() if "Join" in line]
    assert any(re.search(r"Join \[paper_id#\d+, term#\d+\]", line) for line in joins)


def test_many_candidates_meet_their_terms_in_several_tasks(spark, monkeypatch):
    """However few bytes the candidates have; a pair of a null id is kept as well."""
    docs = spark.createDataFrame([(str(i), "t", "left right" + " north" * (i % 2)) for i in range(60)], "paper_id string, title string, abstract string")
    asked = spark.createDataFrame([(1, "left right"), (2, "north left"), (None, "right north")], "query_id long, text string")
    terms, parts = kw.question_terms(asked), []
    index = kw.scan_index(docs, terms)

    def watch(big, small, key, spread_by, *args, **kwargs):
        if key == "key":
            parts.append(big.rdd.getNumPartitions())
        return probe(big, small, key, spread_by, *args, **kwargs)

    monkeypatch.setattr(kw, "probe", watch)
    whole = sorted(kw.match_terms(index, terms).collect(), key=str)
    monkeypatch.setattr(kw, "_TASK_CANDIDATES", 10, raising=False)
    dealt = sorted(kw.match_terms(index, terms).collect(), key=str)
    assert len(whole) == 60 + 30 + 30 and dealt == whole
    assert parts[0] == 1 and parts[1] >= 12


def test_rows_of_many_candidates_and_their_terms_are_not_shuffled(spark, plan, monkeypatch):
    """Phrases, alternatives, papers of one id and a null id give the same matches as few candidates do."""
    docs = [(str(i % 50), "t", "left right" + " north" * (i % 2) + " south left" * (i % 3)) for i in range(60)] + [(None, "t", "left right")]
    docs = spark.createDataFrame(docs, "paper_id string, title string, abstract string")
    asked = spark.createDataFrame([(1, 'left -"south left" or north'), (2, '"left right north"'), (3, "right -north"), (None, "south")], "query_id long, text string")
    for terms in (kw.search_terms(asked), kw.question_terms(asked)):
        index = kw.scan_index(docs, terms)
        few = sorted(kw.match_terms(index, terms).collect(), key=str)
        with monkeypatch.context() as m:
            m.setattr(kw, "_TASK_CANDIDATES", 10)
            many = kw.match_terms(index, terms)
            assert sorted(many.collect(), key=str) == few and few
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables of any size
            text = plan(kw.match_terms(index, terms)).split("== Physical Plan ==")[1]
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
            moved = [line for line in text.splitlines() if "hashpartitioning" in line]
            assert moved and not any(re.search(r"hashpartitioning\((paper_id#\d+, term|term#\d+, paper_id|query_id#\d+L?, paper_id)", line) for line in moved)
            m.setattr(session, "BROADCAST_BYTES", 0)
            assert sorted(kw.match_terms(index, terms).collect(), key=str) == few
