"""Text analysis for keyword search: lower-case words of letters and digits."""

import re
from collections.abc import Callable, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperlake.constants import STOP_WORDS
from paperlake.functions.porter import REMEMBERED, english_stem, english_stems

#: How word endings are reduced: not at all, plural endings only (True), or by the English suffix rules ("english").
Stem = bool | str

WORD = r"[\p{L}\p{N}]+"
NOT_WORD = r"[^\p{L}\p{N}]+"


def words(text: Column) -> Column:
    """All words of a text in order, stop words included (they hold their position)."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


# As SQL text the list is parsed in one go; as a column it would be built word by word.
_STOP_LIST = ", ".join(f"'{word}'" for word in STOP_WORDS)


def is_stop_word(column: str) -> Column:
    return F.expr(f"{column} IN ({_STOP_LIST})")


def without_stop_words(column: str) -> Column:
    return F.expr(f"filter({column}, w -> w NOT IN ({_STOP_LIST}))")


def light_stem(word: Column) -> Column:
    """Plural endings only, after Harman's S-stemmer (1991)."""
    return (
        F.when(word.rlike("(?<![ea])ies$"), F.regexp_replace(word, "ies$", "y"))
        .when(word.rlike("(?<![aeo])es$"), F.regexp_replace(word, "es$", "e"))
        .when(word.rlike("(?<![us])s$"), F.regexp_replace(word, "s$", ""))
        .otherwise(word)
    )


def reduced(found: Column, stem: Stem) -> Column:
    """An array of words in the forms of an index."""
    if stem == "english":
        return english_stems(found)
    return F.transform(found, light_stem) if stem else found


_PLURALS = tuple((re.compile(ending), cut, put) for ending, cut, put in (("(?<![ea])ies$", 3, "y"), ("(?<![aeo])es$", 2, "e"), ("(?<![us])s$", 1, "")))


@lru_cache(REMEMBERED)
def plain_stem(word: str) -> str:
    """`light_stem` of one word."""
    return next((word[:-cut] + put for ending, cut, put in _PLURALS if ending.search(word)), word)


def _each(form: Callable[[str], str]):
    def run(found: pa.Array) -> pa.Array:
        words = found.flatten().dictionary_encode()
        forms = pa.array([w if w is None else form(w) for w in words.dictionary.to_pylist()], pa.string())
        ends = np.cumsum(pc.fill_null(pc.list_value_length(found), 0).to_numpy(zero_copy_only=False))
        places = pa.array(np.concatenate(([0], ends)), pa.int32())
        return pa.ListArray.from_arrays(places, forms.take(words.indices), mask=found.is_null() if found.null_count else None)

    return F.arrow_udf(run, "array<string>").asNondeterministic()


def forms(found: Column, stem: Stem) -> Column:
    """`reduced` for the words of whole texts: a task reduces each different word of a batch once, and remembers the frequent ones.

    Not for use inside a lambda. Column expressions would reduce every word anew wherever it stands.
    """
    return _each(english_stem if stem == "english" else plain_stem)(found) if stem else found


#: Of one paper: how many of its words are indexed, and each different term with its places, ascending.
_PLACED = "struct<dl: int, found: array<struct<term: string, title_tf: bigint, positions: array<int>>>>"


def _grouped(found: pa.Array, n_title: pa.Array, form: Callable[[str], str] | None, only: Sequence[str] | None) -> pa.Array:
    """`_PLACED` of a batch of word arrays: words become numbers, and one stable sort of them by paper and term keeps their places in order."""
    coded = found.flatten().dictionary_encode()
    different, word = coded.dictionary, coded.indices.to_numpy()
    forms = pa.array([form(w) for w in different.to_pylist()], different.type) if form else different
    indexed = ~pc.is_in(different, value_set=pa.array(STOP_WORDS, different.type)).to_numpy(zero_copy_only=False)
    asked = True if only is None else pc.is_in(forms, value_set=pa.array(only, forms.type)).to_numpy(zero_copy_only=False)
    terms = forms.dictionary_encode()  # words of one form have one number
    lengths = pc.list_value_length(found).to_numpy()
    paper = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(len(paper)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    dl = np.bincount(paper[indexed[word]], minlength=len(lengths))

    kept = np.flatnonzero((indexed & asked)[word])
    paper, place, term = paper[kept], place[kept], terms.indices.to_numpy()[word[kept]]
    order = np.argsort(paper * len(terms.dictionary) + term, kind="stable")
    paper, place, term = paper[order], place[order], term[order]
    starts = np.flatnonzero(np.diff(paper, prepend=-1) | np.diff(term, prepend=-1))
    titled = np.concatenate(([0], np.cumsum(place < n_title.to_numpy()[paper])))
    ends = np.append(starts, len(paper))
    columns = {
        "term": terms.dictionary.take(pa.array(term[starts])),
        "title_tf": pa.array(titled[ends[1:]] - titled[starts], pa.int64()),
        "positions": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(place, pa.int32())),
    }
    of_paper = np.concatenate(([0], np.cumsum(np.bincount(paper[starts], minlength=len(lengths)))))
    rows = pa.ListArray.from_arrays(pa.array(of_paper, pa.int32()), pa.StructArray.from_arrays([*columns.values()], [*columns]))
    return pa.StructArray.from_arrays([pa.array(dl, pa.int32()), rows], ["dl", "found"])


def placed_terms(found: Column, n_title: Column, stem: Stem = False, only: Sequence[str] | None = None) -> Column:
    """The terms of each array of words, the first `n_title` of them from the title, as `_PLACED`. With `only`, those of them.

    Stop words are left out but hold their place, and each different word of a batch is reduced once. Not for use inside a lambda.
    """
    form = (english_stem if stem == "english" else plain_stem) if stem else None
    return F.arrow_udf(lambda ws, n: _grouped(ws, n, form, only), _PLACED).asNondeterministic()(found, n_title)


def index_terms(df: DataFrame, text: str, name: str = "terms", stem: Stem = False) -> DataFrame:
    """Add the words of a text column that are indexed: no stop words, endings reduced on request."""
    kept = df.withColumn(name, words(F.col(text))).withColumn(name, without_stop_words(name))
    return kept.withColumn(name, reduced(F.col(name), stem)) if stem else kept
