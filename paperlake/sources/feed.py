"""Incremental feed: XML files of `item` elements in a landing folder."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperlake.functions import feedtext
from paperlake.schemas import FEED_ITEM


def read_feed(spark: SparkSession, path: str, streaming: bool = False, max_files: int | None = None) -> DataFrame:
    """One row per `item` element, as a bounded table or as a stream of up to `max_files` a step."""
    reader = spark.readStream if streaming else spark.read
    if streaming and max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.format("xml").option("rowTag", "item").schema(FEED_ITEM).load(path)


def parse_feed(items: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """Feed items to the nine paper columns."""
    creator = F.col("`dc:creator`")
    published = feedtext.feed_date(F.col("pubDate"))
    return items.select(
        feedtext.feed_paper_id(F.col("guid"), F.col("link")).alias("paper_id"),
        feedtext.strip(F.col("title")).alias("title"),
        feedtext.feed_abstract(F.col("description")).alias("abstract"),
        feedtext.feed_authors(creator).alias("authors"),
        feedtext.feed_categories(F.col("category")).alias("categories"),
        feedtext.strip(F.col("link")).alias("url"),
        published.alias("published_date"),
        F.year(published).alias("published_year"),
        (F.current_timestamp() if loaded_at is None else loaded_at).alias("ingested_at"),
    )
