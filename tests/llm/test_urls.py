import random

import pytest

from paperlake.llm import urls
from paperlake.llm.queries import RULES

CASES = {
    "http://example.com/en/1": ("example.com/en/", "block"),
    "http://WWW.Example.COM/en/1?x#y": ("www.example.com/en/", "allow"),
    "http://a.www.example.com/en/": ("www.example.com/en/", "allow"),
    "http://m.example.com/en/": ("example.com/en/", "block"),
    "http://example.com/en": ("com/", "allow"),
    "http://example.com/EN/": ("com/", "allow"),
    "http://notexample.com/en/": ("com/", "allow"),
    "http://x.net/es/1": ("net/es/", "block"),
    "http://x.net/de/1": (None, "allow"),
    "http://net/fr/": ("net/fr/", "block"),
    "http://com": (None, "allow"),
    "http://com?/": (None, "allow"),
    "mailto:x@example.com": (None, "allow"),
    "": (None, "allow"),
    None: (None, "allow"),
}


def brute(rules, host, path, default="allow"):
    fits = [r for r in rules if (not r.host or host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: (len(r.host), len(r.path), r.block), default=None)
    return (best.text, "block" if best.block else "allow") if best else (None, default)


def judged(spark, rows, rules, how=urls.judge):
    frame = spark.createDataFrame(rows, "page_id long, url string, rule string, host int")
    return {(r.page_id, r.url): (r.rule, r.verdict, r.host, r.path) for r in how(frame, rules).collect()}


def test_contract_rules(spark):
    rows = [(i, url, "old", 1) for i, url in enumerate(CASES)]
    found = judged(spark, rows, RULES)
    assert {k[1]: v[:2] for k, v in found.items()} == CASES
    assert {v[2] for k, v in found.items() if k[1] == "http://WWW.Example.COM/en/1?x#y"} == {"www.example.com"}
    assert {v[3] for k, v in found.items() if k[1] == "http://WWW.Example.COM/en/1?x#y"} == {"/en/1"}
    assert {v[2:] for k, v in found.items() if k[1] in (None, "", "mailto:x@example.com")} == {("", "")}


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_trie_and_join_agree_with_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(urls, "TRIE_CHARS", limit)
    pick = random.Random(3)
    hosts = ["", "com", "a.com", "b.a.com", "net", "x.net"]
    paths = ["", "/", "/a", "/a/", "/a/b", "/ab/"]
    rules = [urls.Rule(pick.choice(hosts), pick.choice(paths), pick.random() < 0.5) for _ in range(25)]
    rows = []
    for i in range(200):
        host = pick.choice(["c.", "", "bb."]) + pick.choice(hosts[1:])
        rows.append((i, f"http://{host}" + pick.choice(["", "/", "/a", "/a/b/c", "/abc", "/ab/", "//a/"]), None, 0))
    for (_, _), (rule, verdict, host, path) in judged(spark, rows, rules).items():
        assert (rule, verdict) == brute(rules, host, path), (host, path)


def test_repeated_rows_null_ids_and_empty_tables(spark):
    rows = [(None, "http://example.com/en/", "x", 1)] * 3
    frame = spark.createDataFrame(rows, "page_id long, url string, rule string, host int")
    out = urls.judge(frame, RULES).collect()
    assert len(out) == 3 and {r.verdict for r in out} == {"block"}
    assert urls.judge(frame.limit(0), RULES).count() == 0
    assert {r.verdict for r in urls.judge(frame, [], default="block").collect()} == {"block"}


def test_very_long_url(spark):
    frame = spark.createDataFrame([(1, "http://example.com/en/" + "a/" * 100_000)], "page_id long, url string")
    assert urls.judge(frame, RULES).first().verdict == "block"


def test_many_rules_of_one_host_by_join(spark, monkeypatch):
    """A url meets the rules that fit it, not the ten thousand of its host."""
    monkeypatch.setattr(urls, "TRIE_CHARS", 0)
    rules = [urls.Rule("example.com", f"/{i}/p", i % 2 == 0) for i in range(10_000)] + [urls.Rule("com", "/", True), urls.Rule("", "", False)]
    rows = [(i, f"http://www.example.com/{i * 7}/p{i}", None, 0) for i in range(1000)] + [(5000 + i, f"http://x{i}.com/a", None, 0) for i in range(500)]
    found, met = {}, []

    def watch(*args, **kwargs):
        met.append(joined := probe(*args, **kwargs))
        return joined

    probe = urls.probe
    monkeypatch.setattr(urls, "probe", watch)
    found = judged(spark, rows, rules)
    for (i, _), (rule, verdict, _, _) in found.items():
        expected = (f"example.com/{i * 7}/p", "block" if i % 2 == 0 else "allow") if i < 1000 else ("com/", "block")
        assert (rule, verdict) == expected
    assert met[0].count() <= 3 * len(rows)
