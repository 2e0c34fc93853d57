"""Metadata as typed values: parsing, reading, storing and refusing."""

import json

import pytest
from pyspark.sql import functions as F

from paperlake.functions.metadata import in_types_of, json_field, json_text, to_variant
from paperlake.operators.context import build_context
from paperlake.operators.embed import fuse_text
from paperlake.plans import pipelines as P
from paperlake.schemas import SERVING, SERVING_VARIANT
from paperlake.sinks import table

GOOD = ['{"b": 1.50, "a": {"x": [1, null]}, "t": "é\\"", "n": null, "f": false}', "[]", "null", '"s"', "7", "{}", None]
BAD = ["", " ", "{", "{}}", '{"a":1,"a":2}', "kept 1", '{"a":1} {"b":2}', "NaN"]


def texts(spark, rows):
    return spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "id long, m string")


def papers(spark, rows):
    """Serving rows (key, title, metadata) as text."""
    frame = spark.createDataFrame(rows, "paper_id string, title string, metadata string")
    held = [F.col(f.name) if f.name in frame.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in SERVING]
    return frame.select(held)


def served(spark, path):
    rows = table.resolve(spark, path)
    return {r.paper_id: r.m for r in rows.select("paper_id", json_text(rows, "metadata").alias("m")).collect()}


def test_text_and_variant_hold_the_same_values(spark, tmp_path):
    frame = texts(spark, GOOD).withColumn("m", to_variant(F.col("m")))
    frame.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    assert stored.schema["m"].dataType.simpleString() == "variant"
    back = [r.m for r in stored.orderBy("id").select(json_text(stored, "m").alias("m")).collect()]
    assert [b and json.loads(b) for b in back] == [g and json.loads(g) for g in GOOD]
    assert back[0].startswith('{"a":{"x":[1,null]},"b":1.5,'), "names in order, no blanks"


@pytest.mark.parametrize("text", BAD)
def test_text_that_is_not_one_value_is_refused(spark, text):
    with pytest.raises(Exception, match="not one JSON value"):
        texts(spark, ["{}", text]).select(to_variant(F.col("m")).alias("m")).collect()


@pytest.mark.parametrize("name", ["a", "b", "t", "n", "f", "none"])
def test_fields_read_alike_from_text_and_variant(spark, name):
    frame = texts(spark, ['{"b": 1.5, "a": {"x": [1, null]}, "t": "é\\"", "n": null, "f": false}', "[]", '"s"', "{}", None])
    typed = frame.withColumn("m", to_variant(F.col("m")))
    read = lambda df: [r.v for r in df.orderBy("id").select(json_field(df, "m", name).alias("v")).collect()]
    assert read(typed) == read(frame)


def test_fused_text_and_context_from_typed_metadata(spark):
    rows = [("t", "a", '{"core_method":"m","key_findings":null,"dataset_used":"d"}'), ("t", None, None), ("t", "b", "[1]")]
    frame = spark.createDataFrame(rows, "title string, abstract string, metadata_json string")
    typed = frame.withColumn("metadata_json", to_variant(F.col("metadata_json")))
    assert [r.embedding_text for r in fuse_text(typed).collect()] == ["t. a. m. d", "t", "t. b"]

    asked = spark.createDataFrame([(0, "q")], "query_id long, text string")
    found = spark.createDataFrame(
        [(0, 1, "1", "T", "A", "u", None, '{"a":1}'), (0, 2, "2", "T", "A", "u", None, None)],
        "query_id long, place int, paper_id string, title string, abstract string, url string, published_date date, metadata string",
    )
    expected = build_context(asked, found).collect()
    assert build_context(asked, found.withColumn("metadata", to_variant(F.col("metadata")))).collect() == expected


@pytest.mark.parametrize("limit", [None, 0])
def test_a_table_with_typed_metadata_takes_text(spark, tmp_path, monkeypatch, limit):
    if limit is not None:
        monkeypatch.setattr("paperlake.session.BROADCAST_BYTES", limit)
    path = str(tmp_path / "t")
    table.publish(in_types_of(papers(spark, [("1", "a", '{"k":1}'), ("2", "b", None)]), SERVING_VARIANT), path, buckets=2)
    table.merge_into(papers(spark, [("2", "c", '{"k":"x"}'), ("3", "d", "null"), ("4", "e", None)]), path)
    assert table.resolve(spark, path).schema == SERVING_VARIANT
    assert served(spark, path) == {"1": '{"k":1}', "2": '{"k":"x"}', "3": "null", "4": None}
    with pytest.raises(Exception, match="not one JSON value"):
        table.merge_into(papers(spark, [("1", "z", "{}"), ("5", "z", "{} {}")]), path)
    assert table.version(spark, path) == 2 and served(spark, path)["1"] == '{"k":1}', "nothing of a refused merge is seen"
    partial = spark.createDataFrame([("1", "renamed"), ("6", "new")], "paper_id string, title string")
    table.merge_into(partial, path, update_cols=["title"])
    assert served(spark, path) == {"1": '{"k":1}', "2": '{"k":"x"}', "3": "null", "4": None, "6": None}


def test_a_table_with_text_takes_typed_metadata(spark, tmp_path):
    path = str(tmp_path / "t")
    table.publish(papers(spark, [("1", "a", "{}")]), path, buckets=2)
    table.merge_into(in_types_of(papers(spark, [("1", "b", '{"k": 1}'), ("2", "b", '"s"')]), SERVING_VARIANT), path)
    assert served(spark, path) == {"1": '{"k":1}', "2": '"s"'}


def test_only_the_fields_asked_for_are_scanned(spark, tmp_path, plan):
    frame = texts(spark, ['{"a": "1", "b": "2"}']).withColumn("m", to_variant(F.col("m")))
    frame.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    shown = plan(stored.select(json_field(stored, "m", "a").alias("a"))).split("ReadSchema")[-1]
    assert "m:struct<" in shown and "id:" not in shown


def test_loading_makes_a_typed_table_and_follows_it(spark, tmp_path):
    def stage(name, rows):
        frame = papers(spark, rows).withColumnRenamed("metadata", "metadata_json").withColumns(
            {"abstract": F.lit("an abstract"), "url": F.lit("u"), "embedding": F.array(F.lit(1.0), F.lit(0.5)).cast("array<float>"), "published_year": F.lit(2024)}
        )
        frame.write.parquet(f"{tmp_path}/{name}")
        return f"{tmp_path}/{name}"

    path = f"{tmp_path}/serving"
    assert P.run_loading(spark, stage("one", [("1", "a", '{"k":1}')]), path, dim=2, buckets=2, variant=True) == 1
    assert P.run_loading(spark, stage("two", [("1", "b", '{"k":2}'), ("2", "c", None)]), path, dim=2) == 2
    assert table.resolve(spark, path).schema == SERVING_VARIANT
    assert served(spark, path) == {"1": '{"k":2}', "2": None}
    with pytest.raises(P.G.GateError):
        P.run_loading(spark, stage("bad", [("3", "d", "{}}")]), path, dim=2)
    assert table.version(spark, path) == 2
