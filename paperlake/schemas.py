"""Explicit schemas: nothing in the lake is ever inferred from data."""

from pyspark.sql import types as T

SNAPSHOT = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in (
            "id",
            "submitter",
            "authors",
            "title",
            "comments",
            "journal-ref",
            "doi",
            "report-no",
            "categories",
            "license",
            "abstract",
            "update_date",
        )
    ]
    + [T.StructField("authors_parsed", T.ArrayType(T.ArrayType(T.StringType())))]
)

FEED_ITEM = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("link", T.StringType()),
        T.StructField("guid", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("category", T.ArrayType(T.StringType())),
        T.StructField("dc:creator", T.StringType()),
        T.StructField("pubDate", T.StringType()),
    ]
)

PAPER = T.StructType(
    [
        T.StructField("paper_id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("abstract", T.StringType()),
        T.StructField("authors", T.StringType()),
        T.StructField("categories", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("published_date", T.DateType()),
        T.StructField("published_year", T.IntegerType()),
        T.StructField("ingested_at", T.TimestampType()),
    ]
)

SERVING = T.StructType(
    PAPER.fields
    + [
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("metadata", T.StringType()),
    ]
)

#: The same with metadata as typed values.
SERVING_VARIANT = T.StructType([T.StructField(f.name, T.VariantType()) if f.name == "metadata" else f for f in SERVING.fields])
