"""Readers for the flat test tables under an ``sf_dir``.

The test tables are read-only, so the reader DataFrame of each table is
kept per session: building a query then does not list files and read
Parquet footers again for every table it touches (about 0.2 s per table
on the driver, more than some whole queries take to run).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_READERS: dict[tuple[str, str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    df = _READERS.get(key)
    if df is None or df.sparkSession is not spark:
        df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
        _READERS[key] = df
    return df
