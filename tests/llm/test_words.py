import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from paperlake.llm import words as W

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab \n\t\x0b\x1f\x85é€😀", max_size=30)), max_size=12)


@settings(max_examples=80, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_pattern(texts):
    found = W.texts_of(pa.array(texts, pa.string()))
    words = W.words_of(found)
    hashes, seen = W.word_hashes(found, words), {}
    for i, text in enumerate(texts):
        expected = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        first, last = words.firsts[i], words.firsts[i + 1]
        spans = zip(words.starts[first:last], words.ends[first:last], strict=True)
        assert [bytes(found.data[a:b]).decode() for a, b in spans] == expected
        for word, value in zip(expected, hashes[first:last].tolist(), strict=True):
            assert seen.setdefault(word, value) == value
    assert len(set(seen.values())) == len(seen)


@settings(max_examples=50, deadline=None)
@given(TEXTS, st.integers(1, 4))
def test_windows_stay_within_a_text_and_equal_windows_hash_alike(texts, size):
    found = W.texts_of(pa.array(texts, pa.string()))
    words = W.words_of(found)
    starts = W.window_starts(words, size)
    hashes, seen = W.window_hashes(W.word_hashes(found, words), starts, size), {}
    lists = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    assert len(starts) == sum(max(0, len(x) - size + 1) for x in lists)
    for start, value in zip(starts.tolist(), hashes.tolist(), strict=True):
        text = words.text[start]
        place = start - words.firsts[text]
        window = tuple(lists[text][place : place + size])
        assert len(window) == size and seen.setdefault(window, value) == value
    assert len(set(seen.values())) == len(seen)


def test_chunks_cover_all_rows_once(monkeypatch):
    monkeypatch.setattr(W, "CHUNK_BYTES", 10)
    column = pa.array(["a" * 8, "b" * 30, None, "", "c" * 5, "d" * 5, "e"])
    parts = list(W.chunks(column))
    assert [i for a, b in parts for i in range(a, b)] == list(range(7))
    assert (1, 2) in [(a, min(b, 2)) for a, b in parts]
    assert list(W.chunks(pa.array([], pa.string()))) == []


def test_a_sliced_column_is_read_from_its_own_start():
    column = pa.array(["one two", "three", None, "four five six"]).slice(1)
    texts = W.texts_of(column)
    assert bytes(texts.data) == b"threefour five six"
    assert W.words_of(texts).counts.tolist() == [1, 0, 3]


@pytest.mark.parametrize("n", [0, 1, 5])
def test_hashes_differ_by_order(n):
    texts = W.texts_of(pa.array(["x " * n + "a b", "x " * n + "b a"]))
    words = W.words_of(texts)
    hashes = W.window_hashes(W.word_hashes(texts, words), W.window_starts(words, n + 2), n + 2)
    assert len(np.unique(hashes)) == 2
