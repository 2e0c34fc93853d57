"""Words of whole texts on Arrow batches: positions, hashes and windows, all in numpy.

A batch is handled in chunks of at most `CHUNK_BYTES` of text (a longer text is a chunk of its own), so
the arrays of a task stay small whatever the batch holds. Null texts count as empty.
"""

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK_BYTES = 1 << 20
#: `[^\x20\x09-\x0D]+`
WORD_SQL = r"[^\x20\x09-\x0D]+"

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
NOT_BLANK = ~_BLANK
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POWERS: dict[int, np.ndarray] = {}


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """The finalizer of splitmix64: spreads 64-bit values evenly."""
    x = x ^ np.uint64((seed * 0xD1B54A32D192ED03) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    held = _POWERS.get(int(base))
    if held is None or len(held) < n:
        held = np.full(max(n, CHUNK_BYTES + 1), base, np.uint64)
        held[0] = 1
        np.cumprod(held, out=held)
        if n <= CHUNK_BYTES + 1:
            _POWERS[int(base)] = held
    return held[:n]


def _sums(values: np.ndarray) -> np.ndarray:
    """Prefix sums of values times powers: the hash of any range is a difference times an inverse power."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers(_BASE, len(values)), out=out[1:])
    return out


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums = _sums(values)
    hashes = (sums[ends] - sums[starts]) * _powers(_INVERSE, len(values) + 1)[starts]
    return mix(hashes + (ends - starts).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


@dataclass
class Texts:
    """A chunk of texts as one byte array; text i is data[bounds[i]:bounds[i + 1]]."""

    data: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def lowered(self) -> "Texts":
        """A-Z in lower case; other bytes unchanged."""
        return Texts(LOWER[self.data], self.bounds)


@dataclass
class Words:
    """Words in order: byte range, number of the text, index of the first word of each text."""

    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray
    firsts: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.firsts)

    @property
    def place(self) -> np.ndarray:
        """Index of each word within its text."""
        return np.arange(len(self.text)) - self.firsts[self.text]


def texts_of(column: pa.Array) -> Texts:
    column = column.fill_null("").cast(pa.large_string())
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[bounds[0] : bounds[-1]] if raw is not None else np.zeros(0, np.uint8)
    return Texts(data, bounds - bounds[0])


def words_of(texts: Texts, inside: np.ndarray = NOT_BLANK) -> Words:
    """Maximal runs of the byte values that `inside` marks; no word crosses the end of a text."""
    return runs_of(texts, inside[texts.data])


def runs_of(texts: Texts, mask: np.ndarray) -> Words:
    """Maximal runs of the marked bytes within each text."""
    data, bounds = texts.data, texts.bounds
    edges = bounds[(bounds > 0) & (bounds < len(data))]
    first, last = mask.copy(), mask.copy()
    if len(data):
        first[1:] &= ~mask[:-1]
        first[edges] = mask[edges]
        last[:-1] &= ~mask[1:]
        last[edges - 1] = mask[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    text = np.searchsorted(bounds, starts, side="right") - 1
    firsts = np.searchsorted(starts, bounds)
    return Words(starts, ends, text, firsts)


def word_hashes(texts: Texts, words: Words) -> np.ndarray:
    return range_hashes(_CODES[texts.data], words.starts, words.ends)


def window_starts(words: Words, size: int) -> np.ndarray:
    """Indexes of the words that start a window of `size` words within one text."""
    room = np.maximum(words.counts - size + 1, 0)
    total = int(room.sum())
    shift = np.repeat(words.firsts[:-1] - np.concatenate(([0], np.cumsum(room)[:-1])) if len(room) else room, room)
    return np.arange(total) + shift


def window_hashes(hashes: np.ndarray, starts: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    values = mix(hashes, seed) if seed else hashes
    return range_hashes(values, starts, starts + size)


def chunks(column: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of at most CHUNK_BYTES of text each, one row at least."""
    if not len(column):
        return
    sizes = np.diff(texts_of(column).bounds)
    start, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and total + size > CHUNK_BYTES:
            yield start, i
            start, total = i, 0
        total += size
    yield start, len(sizes)


Chunked = Callable[[pa.RecordBatch, Texts], pa.RecordBatch]


def map_texts(df: DataFrame, schema: str, fn: Chunked, text: str = "text") -> DataFrame:
    """`mapInArrow` over chunks of whole rows; `fn` gets the rows and the bytes of their texts."""

    def run(batches):
        for batch in batches:
            column = batch.column(text)
            for start, end in chunks(column):
                rows = batch.slice(start, end - start)
                yield fn(rows, texts_of(rows.column(text)))

    return df.mapInArrow(run, schema)


def text_udf(fn: Callable[[Texts], pa.Array], returns: str) -> Callable[[Column], Column]:
    """A column function of a text, evaluated over chunks. Never evaluated twice by the optimizer."""

    def run(column: pa.Array) -> pa.Array:
        parts = [fn(texts_of(column.slice(start, end - start))) for start, end in chunks(column)]
        return pa.concat_arrays(parts) if parts else fn(texts_of(column))

    run.__annotations__ = {"column": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, returns).asNondeterministic()


def sums_by(text: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(text, weights, n)
