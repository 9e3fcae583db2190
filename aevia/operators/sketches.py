"""Distinct counts that add up over run periods.

Every period keeps one sketch a column (HyperLogLog, a few kilobytes
whatever the data) under ``quality/distinct_sketches``; the lake's count is
the estimate of their union. A new period reads itself alone, and a period
run again replaces its own sketches. The exact counts stay with the
profile; an estimate is off by ``RELATIVE_ERROR`` as a standard error.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aevia.sources.storage import read_or_empty, replace_period

LG_BUCKETS = 14
RELATIVE_ERROR = 1.04 / 2 ** (LG_BUCKETS / 2)
SCHEMA = "table_name string, column_name string, n_values long, sketch binary, period string"
#: Columns counted by the profile, by silver table.
COLUMNS = {"adverse_events": ["safety_report_id", "country"], "drugs": ["drug_name"], "reactions": ["reaction_name"]}


def sketches(silver: dict[str, DataFrame], columns: dict[str, list[str]] = COLUMNS) -> DataFrame:
    """(table_name, column_name, n_values, sketch): one pass a table, nulls
    left out."""
    def of_table(name: str) -> DataFrame:
        cols = columns[name]
        one = silver[name].agg(*[F.struct(F.lit(c).alias("column_name"), F.count(c).alias("n_values"),
                                          F.hll_sketch_agg(F.col(c).cast("string"), LG_BUCKETS).alias("sketch")).alias(c) for c in cols])
        return one.select(F.lit(name).alias("table_name"), F.inline(F.array(*cols)))

    return reduce(DataFrame.unionByName, map(of_table, columns))


def keep_sketches(silver: dict[str, DataFrame], root: str, period: str) -> str:
    """The sketches of one run period, in place of an earlier run's."""
    return replace_period(sketches(silver), root, "quality", "distinct_sketches", period)


def distinct_estimates(spark: SparkSession, root: str) -> DataFrame:
    """(table_name, column_name, n_values, distinct_estimate) over all
    periods kept; no rows without any."""
    kept = read_or_empty(spark, f"{root.rstrip('/')}/quality/distinct_sketches", spark.createDataFrame([], SCHEMA).schema)
    return kept.groupBy("table_name", "column_name").agg(
        F.sum("n_values").alias("n_values"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_estimate"))
