"""Quality rules: counts per text, fixed limits, and a hashed n-gram logistic regression as the last rule.

Counts: words, code points in words, symbol characters, repeated lines, words in repeated 3-word windows. A text
fails the base rules with fewer than 50 words or if more than half of its words are in repeated windows.

The regression weighs hashed character 3-grams and hashed words and word pairs (with a mark where a word follows
itself); each kind has its shares of the text as features. It is fitted on the driver to features (not texts)
of at most `labelled.SAMPLE_ROWS` labelled rows, its probabilities are calibrated on a fold it has not seen, and
texts are scored in Arrow batches. A text is kept if its probability reaches `KEEP`.

Null and empty texts have zero counts and fail. Without both labels in the sample the regression keeps all.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperlake.llm.labelled import SAMPLE_ROWS, platt, sample, sigmoid
from paperlake.llm.words import (
    LOWER,
    NOT_BLANK,
    Texts,
    Words,
    map_texts,
    mix,
    text_udf,
    window_hashes,
    window_starts,
    word_hashes,
    words_of,
    range_hashes,
)
from paperlake.session import ship_package

MIN_WORDS, MAX_REPEATED_PERCENT, KEEP = 50, 50, 0.5
CHAR_BITS, WORD_BITS = 14, 14
#: character 3-grams, character-kind 3-grams, words, word pairs
SIZES = (1 << CHAR_BITS, 1 << 11, 1 << WORD_BITS, 1 << 10)
STARTS = np.concatenate(([0], np.cumsum(SIZES)))
DIMENSIONS = int(STARTS[-1])

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_NOT_NEWLINE = np.ones(256, bool)
_NOT_NEWLINE[10] = False
_KIND = LOWER.astype(np.int64)
_KIND[97:123], _KIND[128:] = 1, 1
_KIND[65:91], _KIND[48:58], _KIND[[9, 11, 12, 13, 32]] = 2, 3, 4
_KIND = np.where((_KIND > 4) & (_KIND != 10), 5 + _KIND % 11, np.where(_KIND == 10, 0, _KIND))


def counts(texts: Texts) -> dict[str, np.ndarray]:
    n, data = len(texts), texts.data
    owner = np.repeat(np.arange(n), np.diff(texts.bounds))
    words = words_of(texts)
    inside = NOT_BLANK[data] & ((data & 0xC0) != 0x80)
    return {
        "n_words": words.counts,
        "word_chars": np.bincount(owner[inside], minlength=n),
        "n_symbols": np.bincount(owner[_SYMBOLS[data]], minlength=n),
        "n_dup_lines": _repeated_lines(texts, words),
        "n_repeat_words": _repeated_words(texts, words),
    }


def _repeated_lines(texts: Texts, words: Words) -> np.ndarray:
    lines = words_of(texts, _NOT_NEWLINE)
    hashes = range_hashes(mix(texts.data.astype(np.uint64) + np.uint64(1)), lines.starts, lines.ends)
    # lines with a word: some word starts in them
    held = np.searchsorted(words.starts, lines.ends) > np.searchsorted(words.starts, lines.starts)
    order = np.lexsort((hashes[held], lines.text[held]))
    text, hashes = lines.text[held][order], hashes[held][order]
    again = (text[1:] == text[:-1]) & (hashes[1:] == hashes[:-1])
    return np.bincount(text[1:][again], minlength=len(texts))


def _repeated_words(texts: Texts, words: Words, size: int = 3) -> np.ndarray:
    starts = window_starts(words, size)
    hashes = window_hashes(word_hashes(texts, words), starts, size)
    text = words.text[starts]
    order = np.lexsort((hashes, text))
    same = (text[order][1:] == text[order][:-1]) & (hashes[order][1:] == hashes[order][:-1])
    found = np.zeros(len(starts), bool)
    found[order[1:][same]] = True
    found[order[:-1][same]] = True
    covered = np.zeros(len(words.text), bool)
    for i in range(size):
        covered[starts[found] + i] = True
    return np.bincount(words.text[covered], minlength=len(texts))


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEATED_PERCENT * n_words)


def _features(texts: Texts) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each kind of n-gram: the text and the feature of every occurrence."""
    owner = np.repeat(np.arange(len(texts)), np.diff(texts.bounds))
    out = []
    for codes, size, seed in ((LOWER[texts.data].astype(np.uint64), SIZES[0], 1), (_KIND[texts.data].astype(np.uint64), SIZES[1], 2)):
        gram = (codes[:-2] << np.uint64(16)) | (codes[1:-1] << np.uint64(8)) | codes[2:] if len(codes) > 2 else codes[:0]
        whole = owner[:-2] == owner[2:] if len(codes) > 2 else np.zeros(0, bool)
        out.append((owner[:-2][whole] if len(codes) > 2 else owner[:0], (mix(gram, seed) % np.uint64(size)).astype(np.int64)[whole]))
    words = words_of(texts)
    hashes = word_hashes(texts.lowered(), words)
    out.append((words.text, (hashes % np.uint64(SIZES[2])).astype(np.int64)))
    whole = words.text[1:] == words.text[:-1]
    pair = mix(hashes[:-1] + np.uint64(3) * hashes[1:]) % np.uint64(SIZES[3] - 1) + np.uint64(1)
    pair = np.where(hashes[1:] == hashes[:-1], np.uint64(0), pair).astype(np.int64)
    out.append((words.text[1:][whole], pair[whole]))
    return [(text, found + STARTS[i]) for i, (text, found) in enumerate(out)]


def shares(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows: text, feature, share of the occurrences of its kind."""
    rows = []
    for text, found in _features(texts):
        keys, n = np.unique(text * DIMENSIONS + found, return_counts=True)
        owner = keys // DIMENSIONS
        rows.append((owner, keys % DIMENSIONS, n / np.maximum(np.bincount(text, minlength=len(texts)), 1)[owner]))
    return tuple(np.concatenate(x) for x in zip(*rows, strict=True))


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def margins(self, texts: Texts) -> np.ndarray:
        out = np.full(len(texts), self.bias)
        for text, found in _features(texts):
            n = np.bincount(text, minlength=len(texts))
            out += np.bincount(text, self.weights[found], len(texts)) / np.maximum(n, 1)
        return out

    def probabilities(self, texts: Texts) -> np.ndarray:
        return sigmoid(self.slope * self.margins(texts) + self.offset)


def descend(text: np.ndarray, feature: np.ndarray, share: np.ndarray, labels: np.ndarray, rounds: int = 150, ridge: float = 1e-3) -> tuple[np.ndarray, float]:
    """Logistic regression by gradient steps with momentum and a step size per weight; classes count alike."""
    weights, bias = np.zeros(DIMENSIONS), 0.0
    mean, square = np.zeros(DIMENSIONS + 1), np.zeros(DIMENSIONS + 1)
    importance = np.where(labels > 0, 0.5 / max(labels.sum(), 1), 0.5 / max((labels == 0).sum(), 1))
    for step in range(1, rounds + 1):
        margin = np.bincount(text, weights[feature] * share, len(labels)) + bias
        error = (sigmoid(margin) - labels) * importance
        gradient = np.append(np.bincount(feature, error[text] * share, DIMENSIONS) + ridge / DIMENSIONS * weights, error.sum())
        mean, square = 0.9 * mean + 0.1 * gradient, 0.999 * square + 0.001 * gradient**2
        move = 0.5 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-7)
        weights, bias = weights - move[:-1], bias - move[-1]
    return weights, float(bias)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE_ROWS) -> Model:
    ship_package(docs.sparkSession)

    def extract(batch: pa.RecordBatch, texts: Texts) -> pa.RecordBatch:
        text, feature, share = shares(texts)
        order = np.argsort(text, kind="stable")
        cuts = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=len(texts)))))
        offsets = pa.array(cuts, pa.int32())
        return pa.RecordBatch.from_arrays(
            [
                pa.ListArray.from_arrays(offsets, pa.array(feature[order], pa.int32())),
                pa.ListArray.from_arrays(offsets, pa.array(share[order], pa.float32())),
                batch.column("label"),
            ],
            ["feature", "share", "label"],
        )

    table = map_texts(sample(docs, labels, label, rows), "feature array<int>, share array<float>, label int", extract).toArrow()
    found = [
        (known, f.values.to_numpy(), s.values.to_numpy())
        for known, f, s in zip(table.column("label").to_pylist(), _lists(table, "feature"), _lists(table, "share"), strict=True)
    ]
    found = sorted(found, key=lambda r: (r[0], r[1].tobytes(), r[2].tobytes()))  # not the order of arrival
    found = [found[i] for i in np.random.default_rng(5).permutation(len(found))]
    known = np.array([r[0] for r in found])
    if len(set(known.tolist())) < 2:
        return Model(np.zeros(DIMENSIONS), 0.0, 0.0, 100.0)
    cut = len(found) * 3 // 4

    def sparse(part):
        return np.repeat(np.arange(len(part)), [len(r[1]) for r in part]), np.concatenate([r[1] for r in part]), np.concatenate([r[2] for r in part])

    weights, bias = descend(*sparse(found[:cut]), known[:cut])
    text, feature, share = sparse(found[cut:])
    slope, offset = platt(np.bincount(text, weights[feature] * share, len(found) - cut) + bias, known[cut:])
    return Model(weights, bias, slope, offset)


def _lists(table: pa.Table, name: str):
    return table.column(name).combine_chunks() if table.num_rows else []


def judge(docs: DataFrame, model: Model, keep: float = KEEP) -> DataFrame:
    """All columns, the counts, probability, base_failed and kept (columns of these names are replaced)."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    def measure(texts: Texts) -> pa.Array:
        found = counts(texts)
        columns = [pa.array(found[name], pa.int64()) for name in names]
        return pa.StructArray.from_arrays([*columns, pa.array(held.value.probabilities(texts), pa.float64())], [*names, "probability"])

    schema = ", ".join(f"{name} bigint" for name in names) + ", probability double"
    measured = docs.withColumn("__found", text_udf(measure, f"struct<{schema}>")(F.col("text")))
    judged = measured.withColumns({name: F.col(f"__found.{name}") for name in (*names, "probability")}).drop("__found")
    failed = base_failed(F.col("n_words"), F.col("n_repeat_words"))
    return judged.withColumns({"base_failed": failed, "kept": ~failed & (F.col("probability") >= keep)})
