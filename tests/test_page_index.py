"""Pages by a sparse index against plain offsets."""

import pytest
from pyspark.sql import functions as F

from aevia.sources import page_index as PI


def test_pages_equal_offsets_and_read_their_files_alone(spark, scratch):
    df = spark.range(0, 5000, 1, 7).select(
        (F.col("id") * 7919 % 5000).alias("k"), F.col("id").alias("v"), F.lit("x").alias("file"), F.lit(1).alias("n"))
    PI.write_indexed(df, scratch, ["k"], file_rows=250)
    for skip, limit in ((0, 10), (100, 100), (2490, 20), (4700, 300), (4990, 100), (0, 5000)):
        got = PI.read_page(spark, scratch, ["k"], skip, limit)
        assert [r.k for r in got.collect()] == list(range(5000))[skip: skip + limit]
        assert got.columns == df.columns
    deep, first = PI.page_files(spark, scratch, 4700, 100), PI.page_files(spark, scratch, 0, 100)
    assert 1 <= len(first) <= 3 and 1 <= len(deep) <= 3
    assert len(PI.read_page(spark, scratch, ["k"], 4700, 100).inputFiles()) == len(deep)
    assert spark.read.parquet(f"{scratch}/index").count() > 10
    assert PI.read_page(spark, scratch, ["k"], 5000, 10).collect() == []
    with pytest.raises(ValueError):
        PI.read_page(spark, scratch, ["k"], -1, 10)


def test_hot_and_null_keys(spark, scratch):
    """A key of half of all rows is many files; nulls stand first, and pages
    neither lose nor repeat a row."""
    df = spark.range(2000).select(
        F.when(F.col("id") % 2 == 0, F.lit(500)).when(F.col("id") % 7 != 0, F.col("id")).alias("k"), F.col("id").alias("v"))
    PI.write_indexed(df, scratch, ["k"], file_rows=100)
    assert spark.read.parquet(f"{scratch}/index").agg(F.max("n")).first()[0] < 500
    pages = [r for at in range(0, 2100, 300) for r in PI.read_page(spark, scratch, ["k"], at, 300).collect()]
    assert sorted(r.v for r in pages) == list(range(2000))
    keys = [r.k for r in pages]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))


def test_empty_table_and_rewriting(spark, scratch):
    df = spark.range(30).withColumnRenamed("id", "k")
    PI.write_indexed(df.limit(0), scratch, ["k"])
    empty = PI.read_page(spark, scratch, ["k"], 0, 10)
    assert empty.columns == ["k"] and empty.collect() == []
    PI.write_indexed(df, scratch, ["k"])
    assert [r.k for r in PI.read_page(spark, scratch, ["k"], 25, 10).collect()] == [25, 26, 27, 28, 29]
    with pytest.raises(ValueError):
        PI.write_indexed(df.withColumn(PI.PLACE, F.lit(1)), scratch, ["k"])
