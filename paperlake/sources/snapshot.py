"""Bulk snapshot: JSON Lines with a fixed nested schema."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperlake.functions import cleanse
from paperlake.schemas import SNAPSHOT


MALFORMED = "malformed"


def read_snapshot(spark: SparkSession, path: str, keep_malformed: bool = False) -> DataFrame:
    """Fields that do not fit the schema come back null; no inference pass is made.

    With `keep_malformed` the text of a line that does not fit stands in a column of its own.
    """
    schema = T.StructType([*SNAPSHOT.fields, T.StructField(MALFORMED, T.StringType())]) if keep_malformed else SNAPSHOT
    return spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", MALFORMED).json(path)


def clean_papers(raw: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """Snapshot records to the nine paper columns, and the malformed line if it was kept."""
    kept = [MALFORMED] if MALFORMED in raw.columns else []
    published = cleanse.iso_date(F.col("update_date"))
    return raw.select(
        F.col("id").alias("paper_id"),
        cleanse.clean_title(F.col("title")).alias("title"),
        cleanse.clean_abstract(F.col("abstract")).alias("abstract"),
        F.coalesce(cleanse.author_names(F.col("authors_parsed")), F.col("authors")).alias("authors"),
        cleanse.clean_categories(F.col("categories")).alias("categories"),
        cleanse.paper_url(F.col("id")).alias("url"),
        published.alias("published_date"),
        F.year(published).alias("published_year"),
        (F.current_timestamp() if loaded_at is None else loaded_at).alias("ingested_at"),
        *kept,
    )
