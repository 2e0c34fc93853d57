import datetime
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paperlake import session
from paperlake.operators.dedupe import dedupe_latest
from paperlake.operators.upsert import upsert
from paperlake.sinks import table
from paperlake.sinks.jdbc import jdbc_options, staging_rows

SCHEMA = "paper_id string, title string, embedding array<float>, ingested_at int"
TARGET = [("a", "old a", [1.0], 1), ("b", "old b", [2.0], 1)]
UPDATES = [("b", "new b", None, 2), ("c", "new c", None, 2)]
LIMITS = [0, 1 << 20]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("limit", LIMITS)
def test_full_row_upsert(spark, limit):
    target, updates = spark.createDataFrame(TARGET, SCHEMA), spark.createDataFrame(UPDATES, SCHEMA)
    merged = upsert(target, updates, broadcast_limit=limit)
    assert rows(merged) == [("a", "old a", [1.0], 1), ("b", "new b", None, 2), ("c", "new c", None, 2)]
    assert rows(upsert(merged, updates, broadcast_limit=limit)) == rows(merged)


@pytest.mark.parametrize("limit", LIMITS)
@pytest.mark.parametrize("invalidate", [(), ("embedding",)])
def test_partial_upsert_keeps_other_columns(spark, limit, invalidate):
    target = spark.createDataFrame(TARGET, SCHEMA)
    updates = spark.createDataFrame(UPDATES, SCHEMA).select("paper_id", "title")
    merged = upsert(
        target, updates, update_cols=["title"], touch="ingested_at", now=F.lit(9), invalidate=invalidate, broadcast_limit=limit
    )
    kept = None if invalidate else [2.0]
    assert rows(merged) == [("a", "old a", [1.0], 1), ("b", "new b", kept, 9), ("c", "new c", None, 9)]


@pytest.mark.parametrize("limit", LIMITS)
def test_null_values_replace_old_ones(spark, limit):
    target, updates = spark.createDataFrame(TARGET, SCHEMA), spark.createDataFrame([("a", None, None, None)], SCHEMA)
    assert ("a", None, None, None) in rows(upsert(target, updates, broadcast_limit=limit))


def test_small_updates_do_not_shuffle_the_target(spark, plan):
    target, updates = spark.createDataFrame(TARGET, SCHEMA), spark.createDataFrame(UPDATES, SCHEMA)
    physical = plan(upsert(target, updates)).split("== Physical Plan ==")[1]
    assert "Exchange hashpartitioning" not in physical and "BroadcastHashJoin" in physical
    assert "FullOuter" in plan(upsert(target, updates, broadcast_limit=0))


@pytest.mark.parametrize("limit", LIMITS)
@pytest.mark.parametrize("how", [{}, {"update_cols": ["v"]}])
def test_the_result_has_the_schema_of_the_target_whatever_the_updates_bring(spark, limit, how):
    target = spark.createDataFrame([("a", 1)], "paper_id string, v int")
    updates = spark.createDataFrame([("a", 2), ("b", 3)], "paper_id string, v bigint")
    merged = upsert(target, updates, broadcast_limit=limit, **how)
    assert merged.schema == target.schema and rows(merged) == [("a", 2), ("b", 3)]


keys = st.sampled_from("abcdef")
entries = st.dictionaries(keys, st.integers(0, 9), max_size=6)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(entries, entries, st.sampled_from(LIMITS))
def test_merge_is_a_dictionary_update(spark, old, new, limit):
    frame = lambda d: spark.createDataFrame(list(d.items()), "paper_id string, v int")
    assert dict(rows(upsert(frame(old), frame(new), broadcast_limit=limit))) == old | new


def test_dedupe_is_repeatable_and_cuts_before_the_shuffle(spark, plan):
    data = [("k", i % 3, f"v{i}") for i in range(60)] + [("l", 0, "w")]
    random.Random(1).shuffle(data)
    once = dedupe_latest(spark.createDataFrame(data, "k string, t int, v string"), ["k"], [F.col("t").desc()])
    again = dedupe_latest(spark.createDataFrame(data[::-1], "k string, t int, v string"), ["k"], [F.col("t").desc()])
    assert rows(once) == rows(again) and once.count() == 2
    assert "WindowGroupLimit" in plan(once) and "Partial" in plan(once)


class TestKeyedTable:
    def test_publish_merge_resolve(self, spark, tmp_path):
        path = str(tmp_path / "t")
        assert not table.exists(spark, path)
        assert table.publish(spark.createDataFrame(TARGET, SCHEMA), path, buckets=4) == 1
        before = table.resolve(spark, path)
        assert table.merge_into(spark.createDataFrame(UPDATES, SCHEMA), path) == 2
        assert rows(table.resolve(spark, path)) == [("a", "old a", [1.0], 1), ("b", "new b", None, 2), ("c", "new c", None, 2)]
        assert rows(before) == rows(spark.createDataFrame(TARGET, SCHEMA)), "a reader keeps the state it resolved"
        table.merge_into(spark.createDataFrame(UPDATES, SCHEMA), path)
        assert table.resolve(spark, path).count() == 3

    def test_only_touched_buckets_are_rewritten(self, spark, tmp_path):
        path = tmp_path / "t"
        many = spark.range(200).select(F.col("id").cast("string").alias("paper_id"), F.lit(0).alias("v"))
        table.publish(many, str(path), buckets=8)
        table.merge_into(many.where("paper_id = '7'").withColumn("v", F.lit(1)), str(path))
        assert len(list((path / "v=2").glob("key_bucket=*"))) == 1
        assert table.resolve(spark, str(path)).agg(F.sum("v"), F.count("*")).first() == (1, 200)

    def test_wider_types_and_extra_columns_leave_the_table_readable(self, spark, tmp_path):
        path = str(tmp_path / "t")
        table.publish(spark.createDataFrame([("a", 1), ("c", 9)], "paper_id string, v int"), path, buckets=2)
        table.merge_into(spark.createDataFrame([("a", 2, "x"), ("b", 3, "y")], "paper_id string, v bigint, w string"), path)
        assert table.resolve(spark, path).dtypes == [("paper_id", "string"), ("v", "int")]
        assert rows(table.resolve(spark, path)) == [("a", 2), ("b", 3), ("c", 9)]

    @pytest.mark.parametrize("bad", [[("a", 1), ("a", 2)], [(None, 1)]])
    def test_repeated_and_null_keys_fail(self, spark, tmp_path, bad):
        path, schema = str(tmp_path / "t"), "paper_id string, v int"
        with pytest.raises(table.KeyViolation):
            table.publish(spark.createDataFrame(bad, schema), path)
        assert not table.exists(spark, path)
        table.publish(spark.createDataFrame([("z", 0)], schema), path)
        with pytest.raises(table.KeyViolation):
            table.merge_into(spark.createDataFrame(bad, schema), path)
        assert rows(table.resolve(spark, path)) == [("z", 0)]

    def test_more_bytes_get_more_folders(self, spark, tmp_path, monkeypatch):
        monkeypatch.setattr(table, "_FOLDER_BYTES", 256)
        monkeypatch.setattr(table, "_LEAST", 1)
        many = spark.range(400).select(F.col("id").cast("string").alias("paper_id"), F.repeat(F.lit("x"), 10).alias("v"))
        folders = lambda path: table._read_pointer(spark, str(path))["buckets"]
        table.publish(many.limit(5), str(tmp_path / "small"))
        table.publish(many, str(tmp_path / "large"))
        assert 1 <= folders(tmp_path / "small") < folders(tmp_path / "large")
        table.merge_into(many.where("paper_id = '7'"), str(tmp_path / "large"))
        assert len(list((tmp_path / "large" / "v=2").glob("key_bucket=*"))) == 1
        table.merge_into(many, str(tmp_path / "small"))
        assert table.resolve(spark, str(tmp_path / "small")).count() == 400

    def test_a_repeated_commit_does_nothing(self, spark, tmp_path):
        path = str(tmp_path / "t")
        table.publish(spark.createDataFrame(TARGET, SCHEMA), path, buckets=2)
        updates = spark.createDataFrame(UPDATES, SCHEMA)
        assert table.merge_into(updates, path, commit=("q", 0)) == 2
        assert table.merge_into(updates, path, commit=("q", 0)) == 2
        assert table.merge_into(updates, path, commit=("other", 0)) == 3
        assert table.merge_into(updates, path, commit=("q", 1)) == 4
        assert table.publish(updates, path) == 5 and table.merge_into(updates, path, commit=("q", 1)) == 5

    def test_empty_table_and_empty_merge(self, spark, tmp_path):
        path = str(tmp_path / "t")
        empty = spark.createDataFrame([], SCHEMA)
        table.publish(empty, path)
        assert table.resolve(spark, path).count() == 0
        assert table.merge_into(empty, path) == 1
        table.merge_into(spark.createDataFrame(UPDATES, SCHEMA), path)
        assert table.resolve(spark, path).count() == 2

    @pytest.mark.parametrize("n", [2, 30])
    def test_lookup_reads_only_the_folders_of_its_keys(self, spark, tmp_path, n):
        path = str(tmp_path / "t")
        many = spark.range(500).select(F.col("id").cast("string").alias("paper_id"), F.lit(0).alias("v"))
        table.publish(many, path, buckets=64)
        keys = many.where(F.col("paper_id").cast("int") < n)
        found = table.lookup(spark, path, keys.unionByName(keys))
        assert {r.paper_id for r in found.collect()} == {str(i) for i in range(n)}
        assert {f.split("key_bucket=")[1].split("/")[0] for f in found.inputFiles()} < {str(b) for b in range(64)}

    def test_a_merge_writes_the_rows_that_change_and_no_others(self, spark, tmp_path):
        """Of the table and of what is kept with it, though the merge touches every bucket."""
        path = tmp_path / "t"
        many = spark.range(400).select(F.col("id").cast("string").alias("paper_id"), F.lit(0).alias("v"))
        twice = table.Companion("twice", lambda rows: rows.select("paper_id", F.explode(F.array("v", "v")).alias("w")), ("w",), {})
        table.publish(many, str(path), buckets=4, companions=[twice])
        for step in (1, 2):
            some = many.where(F.col("paper_id").cast("int") % 10 == step).unionByName(spark.createDataFrame([(f"new {step}", 0)], many.schema))
            table.merge_into(some.withColumn("v", F.lit(step)), str(path), [twice])
            stored = [spark.read.parquet(f"{path}/{folder}v={step + 1}").count() for folder in ("", "twice-")]
            assert stored == [41, 82] and len(list((path / f"v={step + 1}").glob("key_bucket=*"))) == 4
        assert table.resolve(spark, str(path)).groupBy("v").count().orderBy("v").collect() == [(0, 320), (1, 41), (2, 41)]
        assert table.companion(spark, str(path), "twice").groupBy("w").count().orderBy("w").collect() == [(0, 640), (1, 82), (2, 82)]
        state = table._read_pointer(spark, str(path))
        assert [one["version"] for one in state["replaced"]] == [2, 3] and {len(f) for f in state["older"].values()} == {2}

    @pytest.mark.parametrize("limit", [None, 0])
    def test_merges_are_dictionary_updates_however_buckets_are_kept(self, spark, tmp_path, monkeypatch, limit):
        """More merges than a bucket keeps folders, of known and new keys, in whole and in part; one of them replaces most rows."""
        path, schema = str(tmp_path / "t"), "paper_id string, v int, w int"
        if limit is not None:
            monkeypatch.setattr(session, "BROADCAST_BYTES", limit)
        monkeypatch.setattr(table, "_MOST_OLDER", 1)
        kept = table.Companion("kept", lambda rows: rows.select("paper_id", (F.col("v") + F.col("w")).alias("s")), ("s",), {})
        known = {str(i): (0, i) for i in range(60)}
        table.publish(spark.createDataFrame([(k, *v) for k, v in known.items()], schema), path, buckets=3, companions=[kept])
        older = []
        for step in range(1, 6):
            keys = [str(i) for i in (range(50) if step == 4 else (step, step + 1, 70 + step, 30))]
            change = spark.createDataFrame([(k, step, -step) for k in keys], schema)
            whole = step % 2 == 0
            table.merge_into(change, path, [kept], **({} if whole else {"update_cols": ["v"]}))
            known |= {k: (step, -step if whole else known.get(k, (0, None))[1]) for k in keys}
            assert {r.paper_id: (r.v, r.w) for r in table.resolve(spark, path).collect()} == known
            sums = {k: None if w is None else v + w for k, (v, w) in known.items()}
            held = table.companion(spark, path, "kept").collect()
            assert len(held) == len(known) and {r.paper_id: r.s for r in held} == sums
            few = table.lookup(spark, path, change.where("paper_id IN ('30', '1')"))
            assert {r.paper_id: (r.v, r.w) for r in few.collect()} == {k: known[k] for k in ("30", "1") if k in keys}
            older.append(max(map(len, table._read_pointer(spark, path)["older"].values()), default=0))
        assert older == ([1, 0, 1, 0, 1] if limit is None else [0] * 5)

    def test_tables_of_rows_without_a_version_are_read_on(self, spark, tmp_path):
        path = tmp_path / "t"
        many = spark.range(40).select(F.col("id").cast("string").alias("paper_id"), F.lit(0).alias("v"))
        table.publish(many, str(path), buckets=2)
        state = table._read_pointer(spark, str(path))
        for bucket, folder in state["folders"].items():
            spark.read.parquet(f"{path}/{folder}").drop(table.VERSION).write.parquet(f"{path}/was-{folder}")
            state["folders"][bucket] = f"was-{folder}"
        del state["companions"]
        table._swap_pointer(spark, str(path), state)
        table.merge_into(many.limit(3).withColumn("v", F.lit(1)), str(path))
        assert table.resolve(spark, str(path)).groupBy("v").count().orderBy("v").collect() == [(0, 37), (1, 3)]

    def test_missing_table(self, spark, tmp_path):
        with pytest.raises(FileNotFoundError):
            table.resolve(spark, str(tmp_path / "none"))


def test_staging_rows_and_jdbc_options(spark):
    stamp = datetime.datetime(2024, 1, 1)
    newer = datetime.datetime(2024, 1, 2)
    schema = (
        "paper_id string, title string, abstract string, authors string, categories string, url string, "
        "published_date date, published_year int, ingested_at timestamp, metadata_json string, embedding array<float>"
    )
    row = lambda title, at: ("1", title, "a", None, None, "u", None, None, at, "{}", [0.5, -1.0])
    (staged,) = staging_rows(spark.createDataFrame([row("old", stamp), row("new", newer)], schema)).collect()
    assert staged.title == "new" and staged.embedding_str == "[0.5,-1.0]" and len(staged) == 11
    options = jdbc_options("jdbc:x", "papers_stage", "u", "p", "d")
    assert options["batchsize"] == "200" and options["isolationLevel"] == "READ_COMMITTED"
