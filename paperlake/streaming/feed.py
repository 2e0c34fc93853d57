"""The daily feed as a file stream: every arrival is gated and merged like a batch."""

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from paperlake import constants as K
from paperlake.plans.pipelines import merge_feed
from paperlake.session import scratch_path, scratch_scope
from paperlake.sinks.lake import CODEC
from paperlake.sources.feed import read_feed


def first_arrivals(items: DataFrame, within: str) -> DataFrame:
    """A stream without rows that equal an earlier one; what is remembered of a row is a digest, and only for that long."""
    content = F.sha2(F.to_json(F.struct(*items.columns), {"ignoreNullFields": "false"}), 256)
    arrived = items.withColumns({"__arrived": F.current_timestamp(), "__content": content}).withWatermark("__arrived", within)
    return arrived.dropDuplicatesWithinWatermark(["__content"]).select(*items.columns)


def stream_feed(
    spark: SparkSession,
    landing: str,
    serving: str,
    dlq: str,
    checkpoint: str,
    url_prefix: str = K.FEED_URL_PREFIX,
    max_error_rate: float = K.DAILY_ERROR_LIMIT,
    now: Column | None = None,
    max_files: int | None = None,
    repeats: str | None = "7 days",
) -> StreamingQuery:
    """Merge every file that arrives in `landing`, then stop when all are taken in.

    An item that repeats an earlier one in every field within `repeats` of its arrival is dropped before the gate, so files
    that overlap rewrite nothing. The clock is that of arrival, not the date of the item: no item is ever too late.

    A micro-batch may run again after a failure. Its number is committed with the table, under the id of the
    query, so one that had got that far is recognised. Dead letters are kept per micro-batch.

    A stream's own session plans without adaptive execution, so a merge there would leave a file of each task in every folder,
    more with every batch. What arrives is written once and merged in the given session.
    """
    items = read_feed(spark, landing, streaming=True, max_files=max_files)
    if repeats:
        items = first_arrivals(items, repeats)

    def take_in(batch, batch_id: int) -> None:
        source = json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]
        with scratch_scope(spark):
            arrived = scratch_path(spark, "arrived")
            batch.write.option("compression", CODEC).parquet(arrived)
            items = spark.read.schema(batch.schema).parquet(arrived)
            merge_feed(items, serving, f"{dlq}/batch={batch_id}", url_prefix, max_error_rate, now, False, (source, batch_id))

    return (
        items.writeStream.foreachBatch(take_in)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
