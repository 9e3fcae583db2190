"""Pages of a large ordered table by a sparse index.

``write_indexed`` stores rows in order: every file holds one range of the
order keys, and the index has one row a file with its first key, its rows and
how many rows stand before it. ``read_page`` looks up the files that hold a
page and reads those alone, so a deep page costs what the first one costs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aevia.sources.storage import scratch_path

FILE_ROWS = 100_000  # about, rows a file
PLACE = "_place"  # tells rows of equal keys apart


def write_indexed(rows: DataFrame, root: str, order_cols: list[str], file_rows: int = FILE_ROWS) -> str:
    """Stores ``rows`` in the order of ``order_cols`` (nulls first) with their
    index; replaces what is at ``root``. Rows of equal keys are told apart by
    a number that they get once, from stored rows, so a task run again deals
    them alike and a key that a third of all rows share is many files."""
    if PLACE in rows.columns:
        raise ValueError(f"{PLACE} is a column of the stored rows")
    spark, root = rows.sparkSession, root.rstrip("/")
    unordered = scratch_path(spark, "unordered")
    rows.write.parquet(unordered)
    rows = spark.read.schema(rows.schema).parquet(unordered).withColumn(PLACE, F.monotonically_increasing_id())
    keys = [*order_cols, PLACE]
    files = max(1, -(-rows.count() // file_rows))
    rows.repartitionByRange(files, *keys).sortWithinPartitions(*keys).write.mode("overwrite").parquet(f"{root}/data")
    stored = spark.read.schema(rows.schema).parquet(f"{root}/data")
    index = stored.groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct(*keys)).alias("first"))
    # one row a file
    before = Window.orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    index.select("file", "n", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")).coalesce(1).write.mode(
        "overwrite").parquet(f"{root}/index")
    return root


def page_files(spark: SparkSession, root: str, skip: int, limit: int) -> list:
    """Index rows of the files that hold the rows ``skip`` to ``skip + limit``:
    no more than the page has rows."""
    index = spark.read.parquet(f"{root.rstrip('/')}/index")
    held = (F.col("start") < skip + limit) & (F.col("start") + F.col("n") > skip)
    return index.where(held).select("file", "start").orderBy("start").collect()


def read_page(spark: SparkSession, root: str, order_cols: list[str], skip: int, limit: int) -> DataFrame:
    """LIM1: ``limit`` rows after ``skip`` rows of a table written by
    ``write_indexed``. A page beyond the end is empty, as is every page of an
    empty table."""
    if skip < 0 or limit < 0:
        raise ValueError(f"bad page: {limit} rows after {skip}")
    data, files = f"{root.rstrip('/')}/data", page_files(spark, root, skip, limit)
    if not files:
        return spark.read.parquet(data).drop(PLACE).limit(0)
    rows = spark.read.parquet(*[f"{data}/{f['file']}" for f in files])
    return rows.orderBy(*order_cols, PLACE).offset(skip - files[0]["start"]).limit(limit).drop(PLACE)
