"""Published snapshots and periods change whole or not at all."""

import pytest
from pyspark.sql import functions as F

from aevia.sources import storage as T
from aevia.sources.snapshots import ConcurrentCommit, Snapshots


def rows(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v string")


def values(df):
    return sorted(r["v"] for r in df.collect())


def test_tables_change_together(spark, scratch):
    shots = Snapshots(spark, scratch)
    assert shots.numbers() == [] and shots.tables() == {}
    assert shots.publish({"a": rows(spark, "1"), "b": rows(spark, "x")}) == 1
    # a job that dies between stage and commit: readers see the old tables whole
    staged = {"a": {"all": shots.stage(rows(spark, "2", "3"), "a")}, "b": {"all": shots.stage(rows(spark, "y"), "b")}}
    assert values(shots.read("a")) == ["1"] and values(shots.read("b")) == ["x"]
    assert shots.commit(staged) == 2
    assert values(shots.read("a")) == ["2", "3"] and values(shots.read("b")) == ["y"]
    assert values(shots.read("a", number=1)) == ["1"]  # old snapshots stay
    assert shots.publish({"a": rows(spark, "2", "3")}) == 3  # run again: the same rows
    assert values(shots.read("a")) == ["2", "3"] and values(shots.read("b")) == ["y"]
    assert shots.history().where("snapshot = 3").count() == 2


def test_a_stage_that_fails_changes_nothing(spark, scratch):
    shots = Snapshots(spark, scratch)
    shots.publish({"a": rows(spark, "1"), "b": rows(spark, "x")})
    bad = spark.range(4).select(F.when(F.col("id") == 3, F.raise_error(F.lit("lost"))).otherwise(F.col("id").cast("string")).alias("v"))
    with pytest.raises(Exception, match="lost"):
        shots.publish({"b": rows(spark, "y"), "a": bad})
    assert shots.numbers() == [1] and values(shots.read("b")) == ["x"] and values(shots.read("a")) == ["1"]


def test_parts(spark, scratch):
    shots = Snapshots(spark, scratch)
    for part, v in (("01", "a"), ("02", "b"), ("01", "c")):
        shots.publish({"t": rows(spark, v)}, part=part)
    assert values(shots.read("t")) == ["b", "c"] and values(shots.read("t", parts=["01"])) == ["c"]
    shots.commit({"t": {"02": None}})
    assert values(shots.read("t")) == ["c"]
    shots.publish({"t": rows(spark, "whole")})
    assert values(shots.read("t")) == ["whole"]
    shots.publish({"t": rows(spark, "p")}, part="03")  # parts take the place of a whole table
    assert values(shots.read("t")) == ["p"]


def test_two_writers(spark, scratch):
    shots = Snapshots(spark, scratch)
    shots.publish({"t": rows(spark, "1")})
    one, two = (shots.stage(rows(spark, v), "t") for v in "ab")
    shots.commit({"t": {"all": one}}, base=1)
    with pytest.raises(ConcurrentCommit):
        shots.commit({"t": {"all": two}}, base=1)
    shots.numbers = lambda: [1]  # a writer that did not see the other's commit
    with pytest.raises(ConcurrentCommit):
        shots.commit({"t": {"all": two}})
    assert values(Snapshots(spark, scratch).read("t")) == ["a"]


def test_missing_tables(spark, scratch):
    shots = Snapshots(spark, scratch)
    assert shots.read("t", rows(spark, "1").schema).count() == 0
    with pytest.raises(ValueError, match="no table t"):
        shots.read("t")
    with pytest.raises(ValueError, match="no snapshot 4"):
        shots.read("t", number=4)


def test_a_period_is_replaced_whole(spark, scratch):
    T.replace_period(rows(spark, "1", "2"), scratch, "silver", "t", "2024-01")
    bad = spark.range(4).select(F.when(F.col("id") == 3, F.raise_error(F.lit("lost"))).otherwise(F.lit("9")).alias("v"))
    with pytest.raises(Exception, match="lost"):
        T.replace_period(bad, scratch, "silver", "t", "2024-01")
    t = f"{scratch}/silver/t"
    assert values(spark.read.parquet(t)) == ["1", "2"] and T.list_periods(spark, t) == ["2024-01"]
    T.replace_period(rows(spark, "3"), scratch, "silver", "t", "2024-01")
    assert values(spark.read.parquet(t)) == ["3"]
    T.replace_period(rows(spark), scratch, "silver", "t", "2024-01")
    assert spark.read.parquet(t).count() == 0
