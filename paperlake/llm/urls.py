"""URL filter: allow and block rules in a trie over reversed host labels and path segments.

A rule is a host and a path, written together (`example.com/en/`). It fits its host and all subdomains
if the path of the url starts with the path of the rule. The rule with the longest host wins, then the
longest path; of two equal rules the blocking one. Where none fits, the verdict is the default.

Null urls and urls without `://` have an empty host and path, which only a rule without a host can fit.
Every input row gives one row, repeated rows and null ids included; other columns are kept.
"""

from collections.abc import Iterable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperlake.session import probe, ship_package

#: Rules beyond this many characters are joined instead of broadcast.
TRIE_CHARS = 16 << 20


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    block: bool

    @classmethod
    def read(cls, verdict: str, text: str) -> "Rule":
        host, slash, path = text.partition("/")
        return cls(host.lower(), slash + path, verdict == "block")

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """From the first `://` up to `/`, `?`, `#` or the end, with A-Z in lower case."""
    host = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise("")


def build_trie(rules: Iterable[Rule]) -> dict:
    """Nested dicts: host labels from the right, below "/" the path segments, below None the path ends there."""
    root: dict = {}
    for rule in rules:
        node = root
        for label in reversed(rule.host.split(".")) if rule.host else ():
            node = node.setdefault(label, {})
        *segments, last = rule.path.split("/")
        node = node.setdefault("/", {})
        for segment in segments:
            node = node.setdefault(segment, {})
        ends = node.setdefault(None, {})
        ends[last] = (rule.text, rule.block or ends.get(last, ("", False))[1])
    return root


def _longest_path(node: dict, path: str) -> tuple[str, bool] | None:
    found, parts = None, path.split("/")
    for i, part in enumerate(parts):
        fitting = [end for end in node.get(None, ()) if part.startswith(end)]
        if fitting:
            found = node[None][max(fitting, key=len)]
        if i == len(parts) - 1 or part not in node:
            break
        node = node[part]
    return found


def look_up(trie: dict, host: str, path: str) -> tuple[str, bool] | None:
    """The text of the winning rule and whether it blocks."""
    nodes = [trie]
    for label in reversed(host.split(".")):
        if label == "/" or label not in nodes[-1]:
            break
        nodes.append(nodes[-1][label])
    for node in reversed(nodes):
        if "/" in node and (found := _longest_path(node["/"], path)):
            return found
    return None


def judge(pages: DataFrame, rules: Iterable[Rule], url: str = "url", default: str = "allow") -> DataFrame:
    """Add host, path, rule and verdict to every row (columns of these names are replaced)."""
    rules = list(rules)
    ship_package(pages.sparkSession)
    parsed = pages.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    if sum(len(rule.text) for rule in rules) > TRIE_CHARS:
        return judge_by_join(parsed, rules, default)
    trie = pages.sparkSession.sparkContext.broadcast(build_trie(rules))

    def run(host: pa.Array, path: pa.Array) -> pa.Array:
        found = [look_up(trie.value, h or "", p or "") for h, p in zip(host.to_pylist(), path.to_pylist(), strict=True)]
        return pa.StructArray.from_arrays(
            [pa.array([f and f[0] for f in found], pa.string()), pa.array([f and f[1] for f in found], pa.bool_())],
            ["rule", "block"],
        )

    run.__annotations__ = {"host": pa.Array, "path": pa.Array, "return": pa.Array}
    matched = F.arrow_udf(run, "rule string, block boolean").asNondeterministic()
    judged = parsed.withColumn("__match", matched("host", "path"))
    return judged.withColumns({"rule": F.col("__match.rule"), "verdict": _verdict(F.col("__match.block"), default)}).drop("__match")


def _verdict(block: Column, default: str) -> Column:
    return F.when(block, "block").when(~block, "allow").otherwise(default)


def judge_by_join(parsed: DataFrame, rules: list[Rule], default: str) -> DataFrame:
    """The same verdicts for rule lists beyond a broadcast: an equi-join on host suffix and path prefix.

    A url has one key for each of its host suffixes and each length that the path of some rule has, so it meets the rules
    that fit it and no others, however many a host has. Keys that many urls share (`com` and `/`) are dealt out by salt.
    """
    spark = parsed.sparkSession
    unique = {(r.host, r.path): r for r in sorted(rules, key=lambda r: r.block)}  # of equal rules one that blocks
    rows = [(f"{r.host}\n{r.path}", len(r.host), len(r.path), r.text, r.block) for r in unique.values()]
    table = spark.createDataFrame(rows, "__key string, __host int, __path int, __rule string, __block boolean")
    lengths = F.array(*[F.lit(n) for n in sorted({len(r.path) for r in rules})])
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    pairs = parsed.select("host", "path").distinct().withColumn("__suffix", F.explode(F.concat(suffixes, F.array(F.lit("")))))
    cuts = F.transform(F.filter(lengths, lambda n: n <= F.length("path")), lambda n: F.substr("path", F.lit(1), n))
    keyed = pairs.withColumn("__cut", F.explode(cuts)).select("host", "path", F.concat_ws("\n", "__suffix", "__cut").alias("__key"))
    fits = probe(keyed, table, "__key", "path")
    best = fits.groupBy("host", "path").agg(F.max_by(F.struct("__rule", "__block"), F.struct("__host", "__path")).alias("__best"))
    joined = parsed.drop("rule", "verdict").join(best, ["host", "path"], "left")
    found = joined.withColumns({"rule": F.col("__best.__rule"), "verdict": _verdict(F.col("__best.__block"), default)})
    return found.drop("__best")
