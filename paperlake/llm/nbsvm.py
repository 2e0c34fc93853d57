"""Quality classifier: Naive Bayes support vectors over n-gram indicators.

Indicators of a text: byte-class trigrams and word-shape bigrams, each asking whether the n-gram makes up at
least 1/2, 1/8, 1/32 or 1/128 of the text or occurs at all, and hashed words. Every indicator is scaled by its
class log-count ratio; a linear model with hinge loss is fitted to them by dual coordinate descent, and its
margins are turned into scores by a logistic curve through out-of-fold margins.

The model is fitted on the driver, from indicators (not texts) of at most `labelled.SAMPLE_ROWS` labelled rows;
texts are scored in tasks. Only the text is an input of a score. Null and empty texts have no indicators and get
the score of the bare model. Without both labels in the sample every score is the share of label 1 (0.5 if none).
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from paperlake.llm.labelled import SAMPLE_ROWS, platt, sample, sigmoid
from paperlake.llm.words import NOT_BLANK, Texts, map_texts, text_udf, word_hashes, words_of
from paperlake.session import ship_package

N_CLASSES, N_SHAPES, BUCKETS = 12, 36, 1 << 15
LEVELS = (1 / 2, 1 / 8, 1 / 32, 1 / 128, 1e-12)
N_GRAMS = N_CLASSES**3 + N_SHAPES**2
DIMENSIONS = N_GRAMS * len(LEVELS) + BUCKETS

_CLASS = np.zeros(256, np.int64)  # lower case and non-ASCII
for _i, _bytes in enumerate((range(65, 91), range(48, 58), b" \t\r\v\f", b"\n", b".", b",", b"!?", b"|", b"#*$%&<>~^_=+@", b"\"'()[]{}:;-/"), 1):
    _CLASS[list(_bytes)] = _i
_CLASS[[c for c in range(128) if _CLASS[c] == 0 and not 97 <= c <= 122]] = 11


def _gram_counts(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts of n-grams (texts x N_GRAMS), totals per kind, and hashed distinct words as (text, bucket)."""
    n = len(texts)
    classes = _CLASS[texts.data]
    owner = np.repeat(np.arange(n), np.diff(texts.bounds))
    counts = np.zeros((n, N_GRAMS), np.float32)
    kinds = N_CLASSES**3
    if len(classes) >= 3:
        whole = owner[:-2] == owner[2:]
        gram = (classes[:-2] * N_CLASSES + classes[1:-1]) * N_CLASSES + classes[2:]
        counts[:, :kinds] = np.bincount(owner[:-2][whole] * kinds + gram[whole], minlength=n * kinds).reshape(n, kinds)
    words = words_of(texts, NOT_BLANK)
    hashes = word_hashes(texts, words)
    if len(hashes):
        first, last = classes[words.starts], classes[words.ends - 1]
        second = classes[np.minimum(words.starts + 1, words.ends - 1)]
        shape = np.select([(first == 1) & (second == 1), first == 1, first == 2, first == 0, first == 8], [0, 1, 2, 3, 4], 5)
        tail = np.select([last <= 2, (last >= 5) & (last <= 6)], [0, 1], 2)
        again = np.zeros(len(hashes), bool)
        again[1:] = (hashes[1:] == hashes[:-1]) & (words.text[1:] == words.text[:-1])
        shape = (shape * 3 + tail) * 2 + again
        whole = words.text[:-1] == words.text[1:]
        pair = words.text[:-1][whole] * N_SHAPES**2 + shape[:-1][whole] * N_SHAPES + shape[1:][whole]
        counts[:, kinds:] = np.bincount(pair, minlength=n * N_SHAPES**2).reshape(n, -1)
    totals = np.stack([counts[:, :kinds].sum(1), counts[:, kinds:].sum(1)], 1)
    seen = np.unique(words.text * BUCKETS + (hashes >> np.uint64(49)).astype(np.int64))
    return counts, totals, seen


def _shares(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    kinds = N_CLASSES**3
    counts[:, :kinds] /= np.maximum(totals[:, :1], 1)
    counts[:, kinds:] /= np.maximum(totals[:, 1:], 1)
    return counts


def indicators(texts: Texts) -> list[np.ndarray]:
    """The indicators that hold for each text, as sorted numbers below DIMENSIONS."""
    counts, totals, seen = _gram_counts(texts)
    shares = _shares(counts, totals)
    text, number = [seen // BUCKETS], [seen % BUCKETS + N_GRAMS * len(LEVELS)]
    for i, level in enumerate(LEVELS):
        rows, grams = np.nonzero(shares >= level)
        text.append(rows)
        number.append(grams + i * N_GRAMS)
    text, number = np.concatenate(text), np.concatenate(number)
    order = np.lexsort((number, text))
    return np.split(number[order].astype(np.int32), np.cumsum(np.bincount(text, minlength=len(texts)))[:-1])


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def margins(self, texts: Texts) -> np.ndarray:
        counts, totals, seen = _gram_counts(texts)
        shares = _shares(counts, totals)
        out = np.full(len(texts), self.bias)
        for i, level in enumerate(LEVELS):
            out += (shares >= level).astype(np.float32) @ self.weights[i * N_GRAMS : (i + 1) * N_GRAMS]
        words = self.weights[N_GRAMS * len(LEVELS) :]
        return out + np.bincount(seen // BUCKETS, words[seen % BUCKETS], len(texts))

    def scores(self, texts: Texts) -> np.ndarray:
        return sigmoid(self.slope * self.margins(texts) + self.offset)


def log_count_ratios(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    one, zero = np.ones(DIMENSIONS), np.ones(DIMENSIONS)
    for row, label in zip(rows, labels, strict=True):
        (one if label else zero)[row] += 1
    return np.log(one / (labels.sum() + 2)) - np.log(zero / ((labels == 0).sum() + 2))


def descend(rows: list[np.ndarray], labels: np.ndarray, ratios: np.ndarray, cost: float = 0.02, rounds: int = 12) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the linear hinge loss over scaled indicators; classes count alike."""
    sign = np.where(labels > 0, 1.0, -1.0)
    limit = np.where(labels > 0, cost * len(labels) / (2 * max(labels.sum(), 1)), cost * len(labels) / (2 * max((labels == 0).sum(), 1)))
    squares = ratios * ratios
    norms = np.array([squares[row].sum() + 1 for row in rows])
    dual, scaled, bias = np.zeros(len(rows)), np.zeros(DIMENSIONS), 0.0  # scaled = weights * ratios
    order = np.random.default_rng(7)
    for _ in range(rounds):
        for i in order.permutation(len(rows)):
            row = rows[i]
            gradient = sign[i] * (scaled[row].sum() + bias) - 1
            new = min(max(dual[i] - gradient / norms[i], 0), limit[i])
            if step := (new - dual[i]) * sign[i]:
                scaled[row] += step * squares[row]
                bias += step
                dual[i] = new
    return scaled, bias


def fit(rows: list[np.ndarray], labels: np.ndarray) -> Model:
    n_one = int(labels.sum())
    if n_one in (0, len(labels)):
        share = n_one / len(labels) if len(labels) else 0.5
        return Model(np.zeros(DIMENSIONS), 0.0, 0.0, float(np.log((share + 1e-6) / (1 - share + 1e-6))))
    fold = np.arange(len(rows)) % 3
    margins = np.zeros(len(rows))
    for k in range(3):
        chosen = np.flatnonzero(fold != k)
        part = [rows[i] for i in chosen]
        weights, bias = descend(part, labels[chosen], log_count_ratios(part, labels[chosen]))
        for i in np.flatnonzero(fold == k):
            margins[i] = weights[rows[i]].sum() + bias
    slope, offset = platt(margins, labels)
    weights, bias = descend(rows, labels, log_count_ratios(rows, labels))
    return Model(weights, bias, slope, offset)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE_ROWS) -> Model:
    ship_package(docs.sparkSession)

    def extract(batch: pa.RecordBatch, texts: Texts) -> pa.RecordBatch:
        found = pa.array(indicators(texts), pa.list_(pa.int32()))
        return pa.RecordBatch.from_arrays([found, batch.column("label")], ["found", "label"])

    table = map_texts(sample(docs, labels, label, rows), "found array<int>, label int", extract).toArrow()
    found = [np.asarray(row.values) for row in table.column("found").combine_chunks()] if table.num_rows else []
    known = table.column("label").to_numpy() if table.num_rows else np.zeros(0)
    order = sorted(range(len(found)), key=lambda i: (known[i], found[i].tobytes()))  # not the order of arrival
    shuffled = np.random.default_rng(11).permutation(len(order))
    order = [order[i] for i in shuffled]
    return fit([found[i] for i in order], known[order] if order else known)


def score(docs: DataFrame, text: Column, model: Model) -> Column:
    """Probability of label 1, as a column."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    return text_udf(lambda texts: pa.array(held.value.scores(texts), pa.float64()), "double")(text)
