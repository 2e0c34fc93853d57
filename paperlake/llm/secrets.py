"""Secret scan: three patterns, and a battery of randomness tests for tokens that no pattern names.

Patterns (kinds assign, access, hex) are matched leftmost and non-overlapping per kind; too short matches are
dropped. The battery looks at other runs of at least `MIN_TOKEN` token characters, wherever they stand ('=' is a part
only as padding behind a run, so values after `name=` are runs of their own). Per inferred encoding (hex,
base32, base36, base62, base64; the first three in lower or upper case) it takes

- chi-squared uniformity over the alphabet, and over its lower case, upper case, digits and signs,
- the number of runs above and below the middle of the alphabet,
- the serial correlation of neighbouring characters.

A token passes if none of them rejects randomness; of one with dashes that doesn't, the parts between them are tested, if long
enough. (UUIDs have only short parts and are not reported: they name things.) Its p-value is the chance that a token of its length made of
ordinary text looks as uniform as it does (base32 and base36: and holds as many digits), so short tokens have to be more
uniform. The tokens of a document
then go through the step-up false-discovery procedure with weights in proportion to their length.

Spans are in code points, end exclusive, ordered by start, then kind as in `KINDS`; spans of the battery never
overlap those of the patterns. Null and empty texts have no spans. The result of a text depends on that text alone.
"""

import math
import re
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperlake.session import ship_package

KINDS = ("assign", "access", "hex", "random")
MIN_TOKEN = 20
#: Level of each test of the battery, and of the false-discovery control.
REJECT, DISCOVER = 0.001, 0.01

_ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")
_TOKEN = re.compile(rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{{MIN_TOKEN},}}=*")

_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER_HEX, _UPPER_HEX, _BASE32 = f"{_DIGITS}abcdef", f"{_DIGITS}ABCDEF", f"{_UPPER}234567"
_BASE64 = f"{_UPPER}{_LOWER}{_DIGITS}+/"
#: Encodings by size of the alphabet; the second number is how often two characters of ordinary text agree.
ENCODINGS = {
    "hex": (_LOWER_HEX, 0.25), "HEX": (_UPPER_HEX, 0.25), "base32": (_BASE32, 0.07), "lower base32": (_BASE32.lower(), 0.07),
    "base36": (_DIGITS + _LOWER, 0.065), "BASE36": (_DIGITS + _UPPER, 0.065), "base62": (_DIGITS + _UPPER + _LOWER, 0.065), "base64": (_BASE64, 0.065),
}
#: Encodings of letters in both cases; tokens of the others are words if they have no digit.
MIXED = ("base62", "base64")
#: Share of digits in ordinary runs of letters of one case and digits, at most.
DIGIT_SHARE = 0.1


def _normal(z: float) -> float:
    return 0.5 * math.erfc(-z / math.sqrt(2))


def chi_squared_tail(x: float, degrees: int) -> float:
    """Chance of a larger value (cube-root normal approximation)."""
    a = 2 / (9 * degrees)
    return 1 - _normal(((max(x, 1e-12) / degrees) ** (1 / 3) - (1 - a)) / math.sqrt(a))


def at_least(k: int, n: int, share: float) -> float:
    """Chance of k or more of n, each with the same share; in logarithms, from the largest term on."""
    if k <= 0:
        return 1.0
    total, i = 0.0, k
    at = math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(share) + (n - k) * math.log1p(-share)
    if k <= n * share:  # the lower tail is the smaller one
        return 1.0 - at_least(n - k + 1, n, 1 - share)
    term = math.exp(at) if at > -745 else 0.0
    while i <= n and term > total * 1e-17:
        total += term
        term *= (n - i) / (i + 1) * share / (1 - share)
        i += 1
    return min(1.0, total)


_SETS = {name: frozenset(alphabet) for name, (alphabet, _) in ENCODINGS.items()}
_NUMERALS = frozenset(_DIGITS)


def infer_encoding(token: str) -> str | None:
    """The smallest alphabet that holds the token; None for plain numbers and words of one kind of letter."""
    used = set(token.rstrip("="))
    if used <= _NUMERALS:
        return None
    for name, held in _SETS.items():
        if used <= (held if name != "base64" else held | {"-", "_"}):
            return None if name not in MIXED and not used & _NUMERALS else name
    return None


def _code_table(alphabet: str) -> np.ndarray:
    table = np.zeros(128, np.int64)
    table[list(alphabet.encode())] = np.arange(len(alphabet))
    return table


_CODES = {name: _code_table(alphabet) for name, (alphabet, _) in ENCODINGS.items()}


def battery(token: str, encoding: str) -> tuple[bool, float]:
    """Whether the token passes as random, and (if it does) the chance that ordinary text looks as uniform."""
    alphabet, agree = ENCODINGS[encoding]
    body = token.rstrip("=")
    body = body.replace("-", "+").replace("_", "/") if encoding == "base64" else body
    codes = _CODES[encoding][np.frombuffer(body.encode(), np.uint8)]
    n, size = len(codes), len(alphabet)
    counts = np.bincount(codes, minlength=size)
    chi = float((counts.astype(float) ** 2).sum() * size / n - n)
    p_values = [chi_squared_tail(chi, size - 1)]

    kinds = np.array([0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3 for c in alphabet])
    expected = np.bincount(kinds, minlength=4) * n / size
    seen = np.bincount(kinds[codes], minlength=4)
    used = expected > 0
    if used.sum() > 1:
        p_values.append(chi_squared_tail(float(((seen - expected)[used] ** 2 / expected[used]).sum()), int(used.sum()) - 1))

    high = codes >= size // 2
    n_high = int(high.sum())
    n_low = n - n_high
    if n_high and n_low:
        runs = 1 + int((high[1:] != high[:-1]).sum())
        mean = 2 * n_high * n_low / n + 1
        spread = math.sqrt(max((mean - 1) * (mean - 2) / (n - 1), 1e-9))
        p_values.append(2 * _normal(-abs(runs - mean) / spread))
    else:
        p_values.append(0.0)
    centered = codes - codes.mean()
    square = float((centered**2).sum())
    serial = float((centered[1:] * centered[:-1]).sum()) / square if square else 1.0
    p_values.append(2 * _normal(-abs(serial + 1 / n) * math.sqrt(n)))

    if min(p_values) < REJECT:
        return False, 1.0
    excess = (n - 1) * (size * agree - 1)
    chance = _normal((chi - (size - 1 + excess)) / math.sqrt(2 * (size - 1) + 4 * excess))
    if size in (32, 36):
        chance *= at_least(int(counts[kinds == 2].sum()), n, DIGIT_SHARE)
    return True, chance


def discover(chances: list[float], lengths: list[int], level: float = DISCOVER) -> list[bool]:
    """Step-up control of false discoveries with weights in proportion to length."""
    mean = sum(lengths) / len(lengths) if lengths else 1
    weighted = [p * mean / n for p, n in zip(chances, lengths, strict=True)]
    order = sorted(range(len(weighted)), key=lambda i: weighted[i])
    last = max((k for k, i in enumerate(order, 1) if weighted[i] <= level * k / len(order)), default=0)
    chosen = set(order[:last])
    return [i in chosen for i in range(len(weighted))]


def spans_of(text: str | None) -> list[tuple[str, int, int]]:
    if not text:
        return []
    found = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 12]
    found += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if len(m.group()) >= 18]
    found += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    taken = _merged(found)
    tested = []
    for match in _TOKEN.finditer(text):
        start, end = match.span()
        before = bisect_left(taken, (end, 0))
        if not before or taken[before - 1][1] <= start:
            tested += _tested(match.group(), start)
    chosen = discover([t[3] if t[2] else 1.0 for t in tested], [t[1] - t[0] for t in tested])
    found += [("random", t[0], t[1]) for t, yes in zip(tested, chosen, strict=True) if yes and t[2]]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def _merged(spans: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """The places covered by spans, in order and apart from each other."""
    out: list[tuple[int, int]] = []
    for start, end in sorted((a, b) for _, a, b in spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _tested(token: str, start: int) -> list[tuple[int, int, bool, float]]:
    """(start, end, passes, chance) of a token; of its long parts between dashes if it doesn't pass as a whole."""
    encoding = infer_encoding(token)
    whole = [(start, start + len(token), *battery(token, encoding))] if encoding else []
    if "-" not in token or (whole and whole[0][2]):
        return whole
    parts = [m for m in re.finditer(rf"[^-]{{{MIN_TOKEN},}}", token) if infer_encoding(m.group())]
    tested = [(start + m.start(), start + m.end(), *battery(m.group(), infer_encoding(m.group()))) for m in parts]
    return tested or whole


_TYPE = "array<struct<kind: string, start: bigint, end: bigint>>"


def find_spans(docs: DataFrame, text: Column) -> Column:
    """All spans of a text: array of kind, start, end."""
    ship_package(docs.sparkSession)
    element = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(column: pa.Array) -> pa.Array:
        rows = ([{"kind": k, "start": a, "end": b} for k, a, b in spans_of(t.as_py())] for t in column)
        return pa.array(rows, element)

    run.__annotations__ = {"column": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, _TYPE).asNondeterministic()(text)


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame) -> DataFrame:
    """All columns and `spans`."""
    return docs.withColumn("spans", find_spans(docs, F.col("text")))


def redact(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """The same columns; every stretch covered by spans is replaced in `text`. Texts without spans are unchanged."""
    ship_package(docs.sparkSession)

    def clean(text: str | None) -> str | None:
        out, at = [], 0
        for _, start, end in spans_of(text):
            if start >= at:
                out += [text[at:start], mark]
            at = max(at, end)
        return text if not out else "".join(out) + text[at:]

    def run(column: pa.Array) -> pa.Array:
        return pa.array((clean(t.as_py()) for t in column), pa.string())

    run.__annotations__ = {"column": pa.Array, "return": pa.Array}
    return docs.withColumn("text", F.arrow_udf(run, "string").asNondeterministic()("text"))
