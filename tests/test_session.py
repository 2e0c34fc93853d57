import pytest
from pyspark.sql import functions as F

from paperlake import session
from paperlake.sources.lake import widen


def test_nested_values_are_measured(spark):
    long = "x" * 1000
    nested = spark.range(1).select(
        F.array(*[F.lit(long)] * 10).alias("words"),
        F.create_map(F.lit("k"), F.lit(long * 10)).alias("map"),
        F.struct(F.lit(long).alias("a"), F.array(F.struct(F.lit(long).alias("b"))).alias("c")).alias("struct"),
    )
    assert 22_000 <= session.data_bytes(nested) < 24_000
    nulls = spark.range(3).select(F.lit(None).cast("array<string>").alias("a"), F.lit(None).cast("map<string,array<string>>").alias("m"))
    assert session.data_bytes(nulls) < 500


@pytest.mark.parametrize("how", ["inner", "left_semi"])
def test_both_ways_of_a_probe_agree(spark, monkeypatch, how):
    big = spark.range(300).select((F.col("id") % 3).alias("k"), F.col("id").alias("i"))
    small = spark.createDataFrame([(0,), (1,)], "k long")
    expected = sorted(session.probe(big, small, "k", "i", how).collect())
    monkeypatch.setattr(session, "BROADCAST_BYTES", -1)
    assert sorted(session.probe(big, small, "k", "i", how).collect()) == expected


def test_only_small_scans_are_widened(spark, tmp_path, monkeypatch):
    spark.range(60_000).withColumn("text", F.repeat(F.col("id").cast("string"), 20)).coalesce(1).write.parquet(str(tmp_path / "t"))
    scan = spark.read.parquet(str(tmp_path / "t"))
    assert widen(scan).count() == 60_000
    monkeypatch.setattr("paperlake.sources.lake.WIDEN_BYTES", 1)
    assert widen(scan) is scan


def test_scratch_folders_go_with_their_scope(spark, tmp_path):
    with session.scratch_scope(spark):
        inner = session.materialize(spark.range(3), "inside")
        path = inner.inputFiles()[0].removeprefix("file://").rpartition("/")[0]
        assert inner.count() == 3
    import os

    assert not os.path.exists(path)


def test_no_local_fallback_where_executors_are_processes_of_their_own(monkeypatch):
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "local-cluster[2,1,1024]"

        def getCheckpointDir(self):
            return None

    fake = type("S", (), {"conf": Conf(), "sparkContext": Context()})()
    with pytest.raises(RuntimeError):
        session.scratch_path(fake, "x")
