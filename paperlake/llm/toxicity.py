"""Toxicity: a weighted lexicon matched by Aho-Corasick in folded text, normalised by length.

Folding: lower case, look-alike letters of other scripts to Latin ones, digits and signs that stand for letters
to those letters, all else to spaces. Signs that follow a letter and end a word may be letters (a$$) or not (note1):
texts that have such signs are read both ways, and a hit counts as often as in the reading that has more. Entries are whole words and word beginnings with the log-odds of
documents that hold them; both lists are folded alike. A hit inside an exception phrase does not count.
The score is a logistic curve over sum(weight * (1 + ln hits)) / (1 + words / 100) ** power.

The lexicon, its weights, the power and the curve are learned from at most `labelled.SAMPLE_ROWS` labelled rows;
candidates are counted in tasks and at most `COLLECTED` of them reach the driver. Only the text is an input of a
score. Null, empty and signless texts have no hits and the score of none. Without both labels in the sample
every score is the share of label 1 (0.5 if none).
"""

import re
import unicodedata
from collections import Counter
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperlake.llm.labelled import SAMPLE_ROWS, platt, sample, sigmoid
from paperlake.session import materialize, ship_package

ENTRIES, SUPPORT, MIN_WEIGHT = 2000, 4, 1.5
#: Candidates that reach the driver at most, the best by weight.
COLLECTED = 20 * ENTRIES
PREFIXES = range(3, 10)
POWERS = (0.0, 0.25, 0.5, 1.0)
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "clown fish", "circus clown", "pond scum", "sore loser")
#: Letters of other scripts and signs that look like, or stand for, a Latin letter.
LOOK_ALIKES = {
    "a": "аαɑ@4", "b": "ЬƄ8", "c": "сϲ", "d": "ԁ", "e": "еєɛ3", "f": "ƒ", "g": "ɡ9", "h": "һ", "i": "іιı1!|", "j": "јϳ", "k": "κк",
    "l": "ӏ", "m": "м", "n": "ո", "o": "оοσ0", "p": "рρ", "q": "ԛ", "r": "г", "s": "ѕ$5", "t": "тτ7+", "u": "υս", "v": "ѵν", "w": "ԝω",
    "x": "хχ", "y": "уγ", "z": "ᴢ2",
}


class _Fold(dict):
    """Code point to folded text, filled as characters are met."""

    def __missing__(self, code: int) -> str:
        char = chr(code)
        plain = next((latin for latin, alike in LOOK_ALIKES.items() if char in alike), None)
        if plain is None:
            wide = unicodedata.normalize("NFKC", char).lower()
            plain = wide if wide.isalpha() else " "
        self[code] = plain
        return plain


_FOLD = _Fold()
#: Runs of signs before no letter: those that follow none, and '!' and '|' at the end of a word; and all of them.
_FREE = re.compile(r"(?<![^\W_])(?<![@!|$+])[@4839!|10$5726+]++(?![^\W\d_])|[!|][!|1]*+(?![^\W_]|[@!|$+])")
_SIGNS = re.compile(r"[@4839!|10$5726+]++(?![^\W\d_])")


def fold(text: str | None, signs: re.Pattern = _FREE) -> str:
    """Folded text between spaces. Runs of digits and signs before no letter stand for none, unless they follow one."""
    return f" {signs.sub(' ', (text or '').lower()).translate(_FOLD)} "


def _line(text: str | None, signs: re.Pattern = _FREE) -> str:
    """Folded words with one space around each."""
    return " ".join(["", *fold(text, signs).split(), ""])


def _lines(text: str | None) -> tuple[str, ...]:
    """The readings of a text: with and without the signs at the ends of words, if that makes a difference."""
    return tuple(dict.fromkeys((_line(text), _line(text, _SIGNS))))


def candidates(folded: str) -> set[str]:
    """Distinct words (" word ") and word beginnings (" wor") of a folded text."""
    words = set(folded.split())
    found = {f" {word} " for word in words if len(word) > 2}
    for n in PREFIXES:
        found.update(f" {word[:n]}" for word in words if len(word) >= n)
    return found


@dataclass
class Model:
    weights: dict[str, float] = field(default_factory=dict)
    power: float = 0.5
    slope: float = 0.0
    offset: float = 0.0
    exceptions: tuple[str, ...] = EXCEPTIONS

    def automaton(self) -> "ahocorasick.Automaton | None":
        """Entries carry their number, exception phrases a negative length."""
        tree = ahocorasick.Automaton()
        for entry, weight in self.weights.items():
            tree.add_word(entry, (entry, weight))
        for phrase in self.exceptions:
            key = _line(phrase)
            tree.add_word(key, (key, None))
        if not len(tree):
            return None
        tree.make_automaton()
        return tree

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_tree"}

    def _counts(self, folded: str) -> Counter:
        hits, covered = [], []
        for end, (entry, weight) in self._tree.iter(folded):
            (covered if weight is None else hits).append((end - len(entry) + 1, end, entry))
        if covered:
            hits = [h for h in hits if not any(a <= h[0] and h[1] <= b for a, b, _ in covered)]
        return Counter(entry for _, _, entry in hits)

    def raw(self, folded: str, power: float | None = None, *others: str) -> float:
        """The margin of a text; `others` are further readings of it."""
        if not hasattr(self, "_tree"):
            self._tree = self.automaton()
        if self._tree is None:
            return 0.0
        counts = self._counts(folded)
        for other in others:
            counts |= self._counts(other)
        if not counts:
            return 0.0
        total = sum(self.weights[entry] * (1 + np.log(n)) for entry, n in sorted(counts.items()))
        return total / (1 + len(folded.split()) / 100) ** (self.power if power is None else power)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        raw = [self.raw(first, None, *others) for first, *others in map(_lines, texts)]
        return sigmoid(self.slope * np.array(raw) + self.offset)


def choose(counted: dict[str, tuple[int, int]], n_one: int, n_zero: int) -> dict[str, float]:
    """Entries by weight: beginnings that several words share, and words or longer beginnings that say clearly more."""
    weights = {e: float(np.log((a + 0.5) / (n_one + 1)) - np.log((b + 0.5) / (n_zero + 1))) for e, (a, b) in counted.items()}
    largest: dict[str, int] = {}
    for entry, (one, _) in counted.items():
        if entry.endswith(" "):
            for n in PREFIXES:
                largest[entry[: n + 1]] = max(largest.get(entry[: n + 1], 0), one)
    chosen: dict[str, float] = {}
    for entry in sorted(weights, key=lambda e: (len(e.strip()), e)):
        one_word = not entry.endswith(" ") and largest.get(entry, 0) >= 0.7 * counted[entry][0]
        shorter = [chosen[entry[: n + 1]] for n in PREFIXES if entry[: n + 1] in chosen]
        if not one_word and weights[entry] >= max([MIN_WEIGHT, *(w + 1.0 for w in shorter)]):
            chosen[entry] = weights[entry]
    return dict(sorted(chosen.items(), key=lambda x: (-x[1], x[0]))[:ENTRIES])


def calibrate(model: Model, raw: np.ndarray, labels: np.ndarray, share: float) -> Model:
    """Choose the power with the least loss (a column of `raw` each) and set the curve."""
    if len(set(labels.tolist())) < 2:
        model.slope, model.offset = 1.0, float(np.log(share / (1 - share)))
        return model
    losses = []
    for i, power in enumerate(POWERS):
        slope, offset = platt(raw[:, i], labels)
        z = slope * raw[:, i] + offset
        losses.append((float(np.mean(np.logaddexp(0, z) - labels * z)), power, slope, offset))
    _, model.power, model.slope, model.offset = min(losses)
    return model


def train(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = SAMPLE_ROWS, exceptions: tuple[str, ...] = EXCEPTIONS
) -> Model:
    ship_package(docs.sparkSession)

    def count(batches):
        for batch in batches:
            found: dict[str, list[int]] = {}
            for text, known in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
                for entry in set().union(*map(candidates, _lines(text))):
                    found.setdefault(entry, [0, 0])[1 - known] += 1
            if found:
                one, zero = zip(*found.values(), strict=True)
                yield pa.RecordBatch.from_pydict({"entry": list(found), "one": pa.array(one, pa.int64()), "zero": pa.array(zero, pa.int64())})

    labelled = materialize(sample(docs, labels, label, rows), "toxicity-sample")
    totals = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n_one, n_zero = totals.get(1, 0), totals.get(0, 0)
    if not n_one or not n_zero:
        share = 1.0 if n_one else 0.0 if n_zero else 0.5
        return Model(offset=float(np.log((share + 1e-6) / (1 - share + 1e-6))), exceptions=exceptions)
    # two thirds of the sample choose the entries, the rest sets power and curve
    third = F.pmod(F.xxhash64("text"), F.lit(3))
    learn = labelled.where(third != 0)
    totals = {r["label"]: r["n"] for r in learn.groupBy("label").agg(F.count("*").alias("n")).collect()}
    one, zero = totals.get(1, 0), totals.get(0, 0)
    counted = learn.mapInArrow(count, "entry string, one bigint, zero bigint").groupBy("entry").agg(F.sum("one").alias("one"), F.sum("zero").alias("zero"))
    weight = (F.col("one") + 0.5) / F.lit(one + 1.0) / ((F.col("zero") + 0.5) / F.lit(zero + 1.0))
    best = counted.where((F.col("one") >= SUPPORT) & (weight >= float(np.exp(MIN_WEIGHT)))).orderBy(weight.desc(), "entry").limit(COLLECTED)
    weights = choose({r["entry"]: (r["one"], r["zero"]) for r in best.collect()}, one, zero)
    model = Model(weights, exceptions=exceptions)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def measure(batches):
        for batch in batches:
            raw = [[held.value.raw(first, power, *others) for power in POWERS] for first, *others in map(_lines, batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(raw, pa.list_(pa.float64())), batch.column("label")], ["raw", "label"])

    rest = labelled.where(third == 0).mapInArrow(measure, "raw array<double>, label int").collect()
    rest = sorted((r["label"], *r["raw"]) for r in rest)
    return calibrate(model, np.array([r[1:] for r in rest]).reshape(len(rest), len(POWERS)), np.array([r[0] for r in rest]), n_one / (n_one + n_zero))


def score(docs: DataFrame, text: Column, model: Model) -> Column:
    """Probability of label 1, as a column."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(column: pa.Array) -> pa.Array:
        return pa.array(held.value.scores(column.to_pylist()), pa.float64())

    run.__annotations__ = {"column": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "double").asNondeterministic()(text)
