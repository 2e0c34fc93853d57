"""The driver tables seen as papers, questions, snapshot records and feed items."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperlake.functions.cleanse import paper_url
from paperlake.session import scratch_path
from paperlake.sources.lake import widen

# Part of every document, so that the cleansing rules meet LaTeX and braces.
LATEX_SAMPLE = r"\textbf{foo} \alpha $x$ {k} "


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str, key: str | None = None) -> DataFrame:
    """A table of long texts, spread over the cores if it is one small file; a larger one only by the `key` of a join."""
    return widen(table(spark, sf_dir, name), key)


def first_line(text):
    return F.get(F.split(text, "\n"), F.lit(0))


def papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the vector of the same number; not every document has one."""
    documents, vectors = texts(spark, sf_dir, "documents", "doc_id"), table(spark, sf_dir, "embeddings")
    joined = documents.join(vectors.select("vec_id", "embedding"), documents["doc_id"] == vectors["vec_id"], "left")
    paper_id = F.col("doc_id").cast("string")
    return joined.select(
        paper_id.alias("paper_id"),
        first_line(F.col("text")).alias("title"),
        F.col("text").alias("abstract"),
        F.lit(None).cast("string").alias("authors"),
        F.col("source").alias("categories"),
        paper_url(paper_id).alias("url"),
        F.expr("date_add(DATE'2000-01-01', cast(n_chars AS int))").alias("published_date"),
        F.year(F.expr("date_add(DATE'2000-01-01', cast(n_chars AS int))")).alias("published_year"),
        F.lit("2026-01-01 00:00:00").cast("timestamp").alias("ingested_at"),
        "embedding",
        F.when(F.col("lang") != "en", F.to_json(F.struct("lang", "source"))).alias("metadata"),
    )


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items as whole-text questions, with the vector of the same number."""
    items, vectors = table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "embeddings")
    joined = items.join(vectors.select("vec_id", "embedding"), items["item_id"] == vectors["vec_id"], "left")
    tag = (
        F.when(F.length("text") > 300, "gpt-4o").when(F.length("text") > 200, "DeepSeek-V3").otherwise("unheard-of")
    )
    return joined.select(F.col("item_id").alias("query_id"), "text", "embedding", tag.alias("model_tag"))


def snapshot_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in the snapshot schema; the lines of a text stand for its authors."""
    lines = F.transform(F.split("text", "\n"), lambda line: F.split(line, " "))
    return texts(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("id"),
        F.lit("nobody").alias("submitter"),
        F.col("source").alias("authors"),
        F.concat(first_line(F.col("text")), F.lit("\t \r\n")).alias("title"),
        F.concat(F.lit(" "), "source", F.lit("  "), "lang", F.lit(" ")).alias("categories"),
        F.concat(F.lit(LATEX_SAMPLE), "text").alias("abstract"),
        F.when(
            F.col("lang") != "es",
            F.expr("date_format(date_add(DATE'2000-01-01', cast(n_chars AS int)), 'yyyy-MM-dd')"),
        )
        .otherwise("n/a")
        .alias("update_date"),
        F.when(F.col("lang") != "de", lines).alias("authors_parsed"),
    )


def write_snapshot(spark: SparkSession, sf_dir: str) -> str:
    """The snapshot as compressed JSON lines, which name every field and hold a text up to three times."""
    path = scratch_path(spark, "snapshot")
    snapshot_records(spark, sf_dir).write.json(path, compression="gzip")
    return path


def feed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as feed items, tags and all; secure pages carry a guid, the others only a link.

    Every third link ends with a slash, and every fourth date has a year of two digits.
    """
    pages = texts(spark, sf_dir, "pages")
    at = F.expr("timestamp_seconds(1700000000 + 86400 * (page_id % 9000))")
    date = lambda year: F.date_format(at, f"d MMM {year} HH:mm:ss 'GMT'")
    slash = F.when(F.col("page_id") % 3 == 0, "/").otherwise("")
    return pages.select(
        F.concat(F.lit("\n "), F.regexp_extract("html", r"<title>([^<]*)</title>", 1), F.lit(" \n")).alias("title"),
        F.concat("url", F.lit("/abs/"), F.col("page_id").cast("string"), F.lit("v3"), slash).alias("link"),
        F.when(
            F.col("url").startswith("https"),
            F.concat(F.lit("oai:arXiv.org:"), F.lpad(F.col("page_id").cast("string"), 9, "0"), F.lit("v2")),
        ).alias("guid"),
        F.concat(F.lit("arXiv:1 Announce Type: new \nAbstract: "), "html").alias("description"),
        F.split(F.regexp_extract("url", r"//([^/]+)/", 1), r"\.").alias("category"),
        F.regexp_extract("html", r'lang="(\w+)"', 1).alias("dc:creator"),
        F.when(F.col("page_id") % 4 == 1, date("yy")).otherwise(date("yyyy")).alias("pubDate"),
    )


def write_feed(spark: SparkSession, sf_dir: str, files: int | None = None) -> str:
    """The feed as XML files, each a document of its own."""
    path = scratch_path(spark, "feed")
    items = feed_items(spark, sf_dir)
    items = items.repartition(files, "link") if files else items
    # The prefixed name of the creator is no valid name to the writer, which knows no namespaces.
    writer = items.write.format("xml").option("rootTag", "channel").option("rowTag", "item")
    writer.option("validateName", "false").save(path)
    return path
