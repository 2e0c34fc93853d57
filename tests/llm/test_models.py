"""Trained operators: held-out accuracy on the driver tables, counts against brute force, odd inputs."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from paperlake.llm import labelled, nbsvm, queries, rules, toxicity
from paperlake.llm.words import texts_of

SF = "/root/testdata/sf0.01"
ODD = [None, "", " \n\t", "x", "é😀", "a " * 60_000, "%%% *** !!!", "\x00"]


def held_out_accuracy(spark, name, label, column):
    scored = queries.QUERIES[name](spark, SF).select("doc_id", "held_out", F.col(column).cast("int").alias("got"))
    rows = scored.join(queries.table(spark, SF, "labels"), "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows) and len(rows) > 60
    return sum(r.got == r[label] for r in rows) / len(rows)


def test_quality_on_held_out_rows(spark):
    assert held_out_accuracy(spark, "op2_quality", "quality", "predicted") >= 0.95


def test_toxicity_on_held_out_rows(spark):
    assert held_out_accuracy(spark, "op9_toxicity", "toxic", "predicted") >= 0.93


def test_rules_keep_good_long_texts_and_drop_junk(spark):
    judged = queries.QUERIES["op5_quality_rules"](spark, SF).join(queries.table(spark, SF, "labels"), "doc_id").where("NOT base_failed").collect()
    assert sum(r.kept == bool(r.quality) for r in judged) / len(judged) >= 0.97


def brute_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    repeated = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(repeated)


def test_counts_equal_brute_force():
    pick = random.Random(2)
    parts = ["a", "b", "é😀", "%", "|x", " ", " ", "\n", "\t", "\x0b", "\r\n", "a b c", "<>"]
    texts = ["".join(pick.choice(parts) for _ in range(pick.randint(0, 60))) for _ in range(300)] + ODD
    got = rules.counts(texts_of(pa.array(texts, pa.string())))
    assert list(zip(*(got[k].tolist() for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")), strict=True)) == [
        brute_counts(t) for t in texts
    ]


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture
def mixed(spark, documents):
    good = [(i, f"the cat number {i} sat on the mat and looked at a bird. " * 3) for i in range(40)]
    bad = [(100 + i, f"WIN!! {i} $$$ CLICK!! NOW!! idiot " * 12) for i in range(40)]
    docs = documents(good + bad, score=1, kept="old", held_out=3, label="x")
    return docs, labels_of(spark, [(i, int(i < 100), int(i >= 100)) for i, _ in good + bad] + [(None, 1, 1), (5, None, None), (6, 7, 7), (9, 0, 0)])


def test_scores_of_odd_rows_and_empty_tables(spark, documents, mixed):
    docs, labels = mixed
    odd = documents([(i, t) for i, t in enumerate(ODD)] + [(None, "x")] * 2, score=1)
    nb, lexicon, rule = nbsvm.train(docs, labels), toxicity.train(docs, labels), rules.train(docs, labels)
    for model, module in ((nb, nbsvm), (lexicon, toxicity)):
        rows = odd.select("doc_id", module.score(odd, F.col("text"), model).alias("p")).collect()
        assert len(rows) == len(ODD) + 2 and all(0 <= r.p <= 1 for r in rows)
        assert odd.limit(0).select(module.score(odd, F.col("text"), model)).count() == 0
    judged = rules.judge(odd, rule).collect()
    assert [r.base_failed for r in judged if r.doc_id is not None] == [True] * len(ODD)
    assert rules.judge(odd.limit(0), rule).count() == 0
    both = docs.select("doc_id", nbsvm.score(docs, F.col("text"), nb).alias("p"), toxicity.score(docs, F.col("text"), lexicon).alias("t")).collect()
    assert all((r.p > 0.5) == (r.doc_id < 100) and (r.t > 0.5) == (r.doc_id >= 100) for r in both)


@pytest.mark.parametrize("rows", [[], [(1, 1, 0), (2, 1, 0)], [(1, 0, 1)]])
def test_without_both_labels(spark, documents, rows):
    docs, labels = documents([(1, "a b"), (2, "c d"), (3, None)]), labels_of(spark, rows)
    share = rows[0][1] if rows else 0.5
    p = [r.p for r in docs.select(nbsvm.score(docs, F.col("text"), nbsvm.train(docs, labels)).alias("p")).collect()]
    assert p == pytest.approx([share] * 3, abs=1e-3)
    toxic = rows[0][2] if rows else 0.5
    t = [r.p for r in docs.select(toxicity.score(docs, F.col("text"), toxicity.train(docs, labels)).alias("p")).collect()]
    assert t == pytest.approx([toxic] * 3, abs=1e-3)
    assert rules.judge(docs, rules.train(docs, labels)).where("probability < 0.5").count() == 0


def test_training_does_not_see_held_out_rows_and_is_bounded(spark, mixed):
    docs, labels = mixed
    ids = {r.text for r in labelled.sample(docs, labels, "quality").collect()}
    out = {r.text for r in docs.where(labelled.held_out(F.col("doc_id"))).collect()}
    assert out and not ids & out
    assert labelled.sample(docs, labels, "quality", rows=10).count() == 10


def test_models_do_not_depend_on_the_order_of_rows(spark, mixed):
    docs, labels = mixed
    first, again = nbsvm.train(docs.coalesce(1), labels), nbsvm.train(docs.repartition(5), labels.repartition(3))
    assert np.array_equal(first.weights, again.weights) and first.slope == again.slope
    one, two = rules.train(docs.coalesce(1), labels), rules.train(docs.repartition(5), labels)
    assert np.array_equal(one.weights, two.weights)


def test_folding():
    assert toxicity.fold("ІDІ0T").strip() == "idiot"
    assert toxicity.fold("id1ot m0r0n $cum l00k 2024 scum!! a-b").split() == ["idiot", "moron", "scum", "look", "scum", "a", "b"]
    assert toxicity.fold(None) == "  "


def test_substituted_signs_at_the_ends_of_words():
    assert toxicity.fold("a$$ a55 h4t3 l0s3r5 a$$!! idiot!!1 $100 1,000 2024").split() == ["ass", "ass", "hate", "losers", "ass", "idiot"]
    model = toxicity.Model({" ass ": 5.0, " hate ": 4.0, " losers ": 3.0}, power=0.0, slope=1.0, offset=0.0)
    texts = ["a$$", "you a55!", "I h4t3 it", "l0s3r5.", "ass1", "hate 5", "nice", "the trash can5"]
    raw = [model.raw(first, None, *others) for first, *others in map(toxicity._lines, texts)]
    assert raw == [5.0, 5.0, 4.0, 3.0, 5.0, 4.0, 0.0, 0.0]
    assert model.scores(texts) == pytest.approx(labelled.sigmoid(np.array(raw)))


def test_exception_phrases_are_no_hits():
    model = toxicity.Model({" clown ": 5.0, " tra": 3.0}, power=0.0, slope=1.0, offset=0.0)
    assert model.raw(" a clown ") == 5.0 and model.raw(" a clown fish ") == 0.0
    assert model.raw(" clown fish and clown ") == 5.0
    assert model.raw(" the trash can ") == 0.0 and model.raw(" the trash heap ") == 3.0


def test_platt_is_stable_on_separable_and_constant_margins():
    slope, offset = labelled.platt(np.array([0.0] * 50 + [90.0] * 5), np.array([0] * 50 + [1] * 5))
    p = labelled.sigmoid(slope * np.array([0.0, 90.0]) + offset)
    assert p[0] < 0.05 and p[1] > 0.8
    slope, offset = labelled.platt(np.zeros(10), np.array([1] * 3 + [0] * 7))
    assert 0.2 < labelled.sigmoid(np.array([offset]))[0] < 0.45


def test_a_sample_holds_one_row_of_each_id(spark):
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(500)] + [(3, "a"), (9, None), (None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (3, 0), (9, 1), (None, 1), (1, 1), (1, 0)], "doc_id long, quality int")
    rows = [tuple(r) for r in labelled.sample(docs, labels, "quality", 10).collect()]
    assert len(rows) == 3 and sorted(x for _, x in rows) == [0, 1, 1]
    assert sorted(map(str, rows)) == sorted(str(tuple(r)) for r in labelled.sample(docs.repartition(7), labels, "quality", 10).collect())
    assert labelled.sample(docs, labels, "quality", 2).count() == 2


def test_descent_reaches_the_optimum_of_a_plain_solver():
    """The hinge loss over scaled indicators with a bias, its dual solved densely by projected gradients."""
    rng = np.random.default_rng(3)
    labels = (np.arange(60) % 3 == 0).astype(float)
    rows = [np.unique(rng.integers(0, 40, 12) + (20 if one else 0)).astype(np.int32) for one in labels]
    ratios = nbsvm.log_count_ratios(rows, labels)
    dense = np.zeros((60, 61))
    for i, row in enumerate(rows):
        dense[i, row] = ratios[row]
    dense[:, 60] = 1.0
    sign = np.where(labels > 0, 1.0, -1.0)
    cost = 0.5
    limit = np.where(labels > 0, cost * 60 / (2 * labels.sum()), cost * 60 / (2 * (60 - labels.sum())))
    kernel = (dense @ dense.T) * np.outer(sign, sign)
    dual, step = np.zeros(60), 1 / np.linalg.eigvalsh(kernel)[-1]
    for _ in range(200_000):
        dual = np.clip(dual - step * (kernel @ dual - 1), 0, limit)
    plain = (dual * sign) @ dense
    scaled, bias = nbsvm.descend(rows, labels, ratios, cost, rounds=3000)
    assert np.allclose(scaled[:60], plain[:60] * ratios[:60], atol=1e-3) and abs(bias - plain[60]) < 1e-3


def test_margins_are_sums_of_the_weights_of_indicators():
    rng = np.random.default_rng(4)
    model = nbsvm.Model(rng.standard_normal(nbsvm.DIMENSIONS), 0.3, 1.0, 0.0)
    texts = ["Ein Satz, zwei Wörter!", "a b c d", "", "%%% *** !!!", "x\ny\n\nz 12 12 12 AB", "the the the cat 😀 " * 40]
    chunk = texts_of(pa.array(texts))
    found = nbsvm.indicators(chunk)
    assert np.allclose(model.margins(chunk), [0.3 + model.weights[f].sum() for f in found])
    for text, numbers in zip(texts, found, strict=True):  # trigrams of byte classes, counted one by one
        classes = [int(nbsvm._CLASS[b]) for b in text.encode()]
        grams = Counter((a * 12 + b) * 12 + c for a, b, c in zip(classes, classes[1:], classes[2:]))
        total = max(sum(grams.values()), 1)
        expected = {g + i * nbsvm.N_GRAMS for i, level in enumerate(nbsvm.LEVELS) for g, n in grams.items() if n / total >= level}
        assert {n for n in numbers.tolist() if n < len(nbsvm.LEVELS) * nbsvm.N_GRAMS and n % nbsvm.N_GRAMS < 12**3} == expected


def test_lexicon_hits_equal_naive_matching():
    pick = random.Random(5)
    words = ["abc", "abcd", "ab", "bcd", "cab", "dabc", "xyz"]
    weights = {entry: pick.uniform(0.5, 3) for entry in (" abc ", " abc", " ab ", " bcd", " cab ", " dab")}
    model = toxicity.Model(weights, exceptions=("cab abc", "xyz bcd"), power=0.5)
    for _ in range(300):
        text = toxicity._lines(" ".join(pick.choices(words, k=pick.randint(0, 40))))[0]
        covered = [(i, i + len(p)) for p in (" cab abc ", " xyz bcd ") for i in range(len(text)) if text.startswith(p, i)]
        total = 0.0
        for entry, weight in weights.items():
            hits = [i for i in range(len(text)) if text.startswith(entry, i) and not any(a <= i and i + len(entry) <= b for a, b in covered)]
            total += weight * (1 + np.log(len(hits))) if hits else 0.0
        assert np.isclose(model.raw(text), total / (1 + len(text.split()) / 100) ** 0.5)
