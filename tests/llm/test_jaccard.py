import random
import re

import pytest
from pyspark.sql import functions as F

from paperlake.llm import jaccard
from paperlake.llm.components import components


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}


def brute(rows):
    """(doc_id, n, smallest id of the component) of every row."""
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            common = len(a & b)
            if common and 100 * common >= 75 * (len(a) + len(b) - common):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(doc, least.get(root(i), doc))
    return [(doc, len(s), least.get(root(i)) if s else doc) for i, ((doc, _), s) in enumerate(zip(rows, sets, strict=True))]


def corpus(seed):
    pick = random.Random(seed)
    text = lambda n: [f"W{pick.randint(0, 400)}" for _ in range(n)]
    shared = text(30)
    rows = []
    for _ in range(12):
        base = text(pick.randint(5, 120))
        rows.append(base)
        for _ in range(pick.randint(0, 6)):
            copy = list(pick.choice(rows[-3:]))
            for _ in range(pick.randint(0, 4) if copy else 0):
                copy[pick.randrange(len(copy))] = f"x{pick.randint(0, 9)}"
            rows.append(copy if pick.random() < 0.5 else copy[pick.randint(0, 5) :])
    rows += [[*shared, *text(pick.randint(0, 14))] for _ in range(15)]
    rows += [["a"], ["A"], ["a", "b"], ["a", "b", "c", "d", "e"], [], shared, shared]
    out = [" ".join(r) if pick.random() < 0.5 else "\n".join(r).lower() for r in rows] + [None, " ", "é É"]
    return [(i, t) for i, t in enumerate(out)]


def result(docs):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in docs.collect()), key=str)


@pytest.mark.parametrize("seed,hot", [(1, 200), (2, 3), (3, 1), (4, 200)])
def test_equals_brute_force(spark, documents, monkeypatch, seed, hot):
    monkeypatch.setattr(jaccard, "HOT", hot)
    rows = corpus(seed)
    random.Random(seed).shuffle(rows)
    got = result(jaccard.similar_components(documents(rows, node=1, n=2, key="k", group=3)))
    assert got == sorted(brute(rows), key=str)


def test_without_stars_the_matrix_finds_every_link(spark, documents, monkeypatch):
    links = jaccard._star_links
    monkeypatch.setattr(jaccard, "_star_links", lambda *args: links(*args).limit(0))
    monkeypatch.setattr(jaccard, "PART", 2)
    monkeypatch.setattr(jaccard, "ASKING", 2)
    rows = corpus(5)
    assert result(jaccard.similar_components(documents(rows))) == sorted(brute(rows), key=str)


def test_null_and_equal_ids(spark, documents):
    rows = [(None if i % 4 == 0 else i % 9, t) for i, t in corpus(6)]
    got = result(jaccard.similar_components(documents(rows)))
    assert got == sorted(brute(rows), key=str)


def test_empty_table_and_very_long_text(spark, documents):
    assert jaccard.similar_components(documents([(1, "a")]).limit(0)).count() == 0
    long = [f"w{i}" for i in range(60_000)]
    rows = [(3, " ".join(long)), (5, " ".join(long[:50_000])), (9, " ".join(long[:30_000]))]
    assert result(jaccard.similar_components(documents(rows))) == [(3, 59_996, 3), (5, 49_996, 3), (9, 29_996, 9)]


def test_one_of_each_group_stays(spark, documents):
    rows = corpus(7) + corpus(7)[:3]
    docs = documents(rows, key="k", group=1)
    kept = jaccard.keep_one(docs)
    want = sorted({doc for doc, n, least in brute(rows) if n and doc == least} | {doc for doc, n, _ in brute(rows) if not n})
    assert sorted(r.doc_id for r in kept.collect()) == want and kept.columns == docs.columns


def test_components_of_a_chain_a_star_and_a_ring(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 140)]
    ring = [(200 + i, 200 + (i + 1) % 9) for i in range(9)]
    links = spark.createDataFrame(chain + star + ring + [(300, 300), (41, 40), (0, 1)], "a long, b long")
    got = {r.node: r.component for r in components(links).collect()}
    assert got == {**dict.fromkeys(range(42), 0), **dict.fromkeys(range(100, 140), 100), **dict.fromkeys(range(200, 209), 200)}
    assert components(links.limit(0)).count() == 0


def test_the_bound_of_a_part_covers_every_size_of_its_members(spark):
    share = lambda m: -(-75 * m // 100)
    overlap = lambda n, m: -(-75 * (n + m) // 175)
    rows = []
    for n in range(1, 130):
        for low in range(share(n), n * 100 // 75 + 1, 3):
            best = -n
            for high in range(low, n * 100 // 75 + 1):
                best = max(best, share(max(n, high)) - 1 - overlap(n, high))
                rows.append((n, low, high, best))
    frame = spark.createDataFrame(rows, "n int, low int, high int, best int")
    wrong = frame.where(jaccard._spare(F.col("n"), F.col("low"), F.col("high")) != F.col("best"))
    assert wrong.count() == 0


def test_a_token_that_every_document_holds(spark, documents):
    """One shingle in all sets, and no window over the rows of a token in any plan."""
    pick = random.Random(21)
    word = lambda: "".join(pick.choices("abcdefghijklmnop", k=6))
    shared = "this very line stands everywhere"
    texts = [" ".join([shared, *(word() for _ in range(20))]) for _ in range(300)]
    texts += [texts[i].rsplit(" ", 1)[0] for i in range(0, 300, 10)]
    found = {r.doc_id: r.component_id for r in jaccard.similar_components(documents(list(enumerate(texts)))).collect()}
    assert found == {i: 10 * (i - 300) if i >= 300 else i for i in range(len(texts))}
