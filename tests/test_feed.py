import datetime

import pytest
from pyspark.sql import functions as F

from paperlake.functions import feedtext
from paperlake.sources.feed import parse_feed, read_feed

RSS = """<?xml version='1.0' encoding='UTF-8'?>
<rss xmlns:dc="http://purl.org/dc/elements/1.1/" version="2.0"><channel><title>feed</title>
<item><title> First
 paper </title><link>https://arxiv.org/abs/2608.18078</link>
<description>arXiv:2608.18078v1 Announce Type: new
Abstract: We   study &lt;b&gt;things&lt;/b&gt; of  note.</description>
<guid isPermaLink="false">oai:arXiv.org:2608.18078v1</guid><category>cs.AI</category><category> </category><category>cs.LG</category>
<dc:creator> A. Doe, B. Roe </dc:creator><pubDate>Thu, 20 Aug 2026 23:30:00 -0400</pubDate></item>
<item><title>Second</title><link>https://arxiv.org/abs/hep-th/9901001v2</link><description>No header here</description></item>
</channel></rss>"""


def test_rss_document(spark, tmp_path):
    (tmp_path / "feed.xml").write_text(RSS)
    first, second = parse_feed(read_feed(spark, str(tmp_path))).orderBy("paper_id").collect()
    assert first.paper_id == "2608.18078"
    assert first.title == "First\n paper"
    assert first.abstract == "We study things of note."
    assert (first.authors, first.categories) == ("A. Doe, B. Roe", "cs.AI, cs.LG")
    assert (first.published_date, first.published_year) == (datetime.date(2026, 8, 20), 2026)
    assert second.paper_id == "hep-th/9901001"
    assert second.abstract == "No header here"
    assert (second.authors, second.categories, second.published_date) == (None, None, None)


@pytest.mark.parametrize(
    "guid, link, expected",
    [
        ("oai:arXiv.org:2608.18078v12", None, "2608.18078"),
        ("other", "https://arxiv.org/abs/2401.00001v2", "2401.00001"),
        (None, "https://arxiv.org/abs/2401.00001", "2401.00001"),
        ("other", "https://example.org/x", ""),
        (None, None, ""),
        ("oai:arXiv.org:hep-th/9901001v1", None, "hep-th/9901001"),
        (None, "https://arxiv.org/abs/2608.18078v1/", "2608.18078"),
        (None, "https://arxiv.org/abs/math.GT/0309136v2/", "math.GT/0309136"),
        ("oai:arXiv.org:2608.18078v3/", None, "2608.18078"),
    ],
)
def test_paper_id(spark, guid, link, expected):
    frame = spark.createDataFrame([(guid, link)], "guid string, link string")
    assert frame.select(feedtext.feed_paper_id(F.col("guid"), F.col("link"))).first()[0] == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        ("Thu, 20 Aug 2026 00:00:00 -0400", datetime.date(2026, 8, 20)),
        ("Thu, 20 Aug 2026 23:59:00 -0400", datetime.date(2026, 8, 20)),
        ("1 jan 2024 05:00 GMT", datetime.date(2024, 1, 1)),
        ("20 August 2026 10:00:00 +0000", datetime.date(2026, 8, 20)),
        ("Thu, 20 Aug 26 00:00:00 GMT", datetime.date(2026, 8, 20)),
        ("1 Jan 69 00:00 GMT", datetime.date(1969, 1, 1)),
        ("1 Jan 68 00:00 GMT", datetime.date(2068, 1, 1)),
        ("1 Jan 026 00:00 GMT", None),
        ("Thu, 31 Feb 2026 00:00:00 GMT", None),
        ("Thu, 20 Aug 2026 25:00:00 GMT", None),
        ("2026-08-20", None),
        ("", None),
        (None, None),
    ],
)
def test_dates(spark, text, expected):
    frame = spark.createDataFrame([(text,)], "x string")
    assert frame.select(feedtext.feed_date(F.col("x"))).first()[0] == expected


def test_categories_are_cut(spark):
    frame = spark.createDataFrame([(["x" * 200, " ", "y" * 200],)], "c array<string>")
    cut = frame.select(feedtext.feed_categories(F.col("c"))).first()[0]
    assert len(cut) == 255 and cut.startswith("x" * 200 + ", y")
