"""Staging rows for, and appending them to, a relational table over JDBC."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperlake.functions.vectors import vector_to_text
from paperlake.operators.dedupe import dedupe_latest
from paperlake.schemas import PAPER


def staging_rows(enriched: DataFrame) -> DataFrame:
    """One row per key in the eleven staging columns; the vector travels as text."""
    unique = dedupe_latest(enriched, ["paper_id"], [F.col("ingested_at").desc_nulls_last()])
    return unique.select(
        *PAPER.fieldNames(),
        vector_to_text(F.col("embedding")).alias("embedding_str"),
        "metadata_json",
    )


def jdbc_options(url: str, table: str, user: str, password: str, driver: str, batch_size: int = 200) -> dict[str, str]:
    return {
        "url": url,
        "dbtable": table,
        "user": user,
        "password": password,
        "driver": driver,
        "batchsize": str(batch_size),
        "isolationLevel": "READ_COMMITTED",
        "stringtype": "unspecified",
        "reWriteBatchedInserts": "true",
    }


def append_jdbc(rows: DataFrame, options: dict[str, str], connections: int = 24) -> None:
    """Append over a fixed number of connections; an empty frame opens none."""
    if rows.isEmpty():
        return
    rows.repartition(connections).write.format("jdbc").options(**options).mode("append").save()
