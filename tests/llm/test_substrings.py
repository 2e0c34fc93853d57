import random
import re
from collections import Counter

import pytest

from paperlake.llm import substrings


def brute(texts, window):
    lists = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in lists for i in range(len(w) - window + 1))
    out = []
    for words in lists:
        keep = [True] * len(words)
        for i in range(len(words) - window + 1):
            if seen[tuple(words[i : i + window])] > 1:
                keep[i : i + window] = [False] * window
        kept = [w for w, k in zip(words, keep, strict=True) if k]
        out.append((len(words), len(words) - len(kept), " ".join(kept)))
    return out


def corpus(seed, vocabulary=40):
    pick = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)] + ["é", "😀x", "A\x1fb"]
    text = lambda n: [pick.choice(words) for _ in range(n)]
    passage, texts = text(60), []
    for i in range(25):
        body = text(pick.randint(0, 120))
        if i % 3 == 0:
            cut = pick.randint(30, 60)
            start = pick.randint(0, 60 - cut)
            at = pick.randint(0, len(body))
            body[at:at] = passage[start : start + cut]
        texts.append((pick.choice([" ", "\n", "  \t"])).join(body))
    texts += [texts[4], texts[4], "a " * 100, None, "", " \n", " ".join(passage[:34]), " ".join(passage[:35]), " ".join(["x", *passage[10:50], "y"] * 3)]
    return texts


def run(documents, texts, window, ids=None):
    rows = list(zip(ids or range(len(texts)), texts, strict=True))
    docs = documents(rows, places="old", whole=1, key="k", n_words=-1, kept="old")
    return substrings.remove_repeated(docs, window).collect()


@pytest.mark.parametrize("window,seed", [(35, 1), (35, 2), (20, 3), (3, 4), (42, 5)])
def test_equals_brute_force(spark, documents, window, seed):
    texts = corpus(seed)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in run(documents, texts, window)}
    assert [got[i] for i in range(len(texts))] == brute(texts, window)


def test_null_and_equal_ids(spark, documents):
    texts = corpus(6)
    ids = [None if i % 3 else 7 for i in range(len(texts))]
    got = sorted((r.text or "", r.n_words, r.n_removed, r.kept) for r in run(documents, texts, 35, ids))
    assert got == sorted((t or "", *x) for t, x in zip(texts, brute(texts, 35), strict=True))


def test_both_ways_to_join_agree(spark, documents, monkeypatch):
    texts = corpus(8)
    first = {r.doc_id: r.kept for r in run(documents, texts, 35)}
    monkeypatch.setattr("paperlake.session.BROADCAST_BYTES", 0)
    monkeypatch.setattr(substrings, "broadcast_if_small", lambda df: df)
    assert {r.doc_id: r.kept for r in run(documents, texts, 35)} == first


def test_empty_table_and_very_long_text(spark, documents):
    assert substrings.remove_repeated(documents([(1, "a")]).limit(0)).count() == 0
    words = [f"w{i}" for i in range(200_000)]
    rows = substrings.remove_repeated(documents([(1, " ".join(words)), (2, " ".join(words[:800]))])).collect()
    assert {r.doc_id: (r.n_words, r.n_removed) for r in rows} == {1: (200_000, 800), 2: (800, 800)}


@pytest.mark.parametrize("period", list(substrings.COVERS))
def test_covers_hold_every_difference(period):
    cover = substrings.COVERS[period]
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))
