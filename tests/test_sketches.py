"""Distinct counts by sketches of run periods."""

from pyspark.sql import functions as F

from aevia.operators import sketches as K


def silver_of(spark, first, n):
    rows = spark.range(first, first + n).select(
        F.col("id").cast("string").alias("safety_report_id"), F.concat(F.lit("C"), F.col("id") % 30).alias("country"),
        F.concat(F.lit("D"), F.col("id") % 20_000).alias("drug_name"), F.lit(None).cast("string").alias("reaction_name"))
    return {name: rows for name in K.COLUMNS}


def estimates(spark, root):
    return {r["column_name"]: (r["n_values"], r["distinct_estimate"]) for r in K.distinct_estimates(spark, root).collect()}


def test_periods_add_up_and_are_replaced(spark, scratch):
    assert K.distinct_estimates(spark, scratch).collect() == []
    K.keep_sketches(silver_of(spark, 0, 30_000), scratch, "2024-01")
    K.keep_sketches(silver_of(spark, 20_000, 30_000), scratch, "2024-02")  # the first month's rows are not at hand
    for want in (50_000, 25_000):
        got = estimates(spark, scratch)
        assert abs(got["safety_report_id"][1] / want - 1) < 4 * K.RELATIVE_ERROR
        assert abs(got["drug_name"][1] / 20_000 - 1) < 4 * K.RELATIVE_ERROR
        assert got["country"][1] == 30 and got["reaction_name"] == (0, 0)
        K.keep_sketches(silver_of(spark, 20_000, 5_000), scratch, "2024-02")
        K.keep_sketches(silver_of(spark, 0, 20_000), scratch, "2024-01")
    assert estimates(spark, scratch)["safety_report_id"][0] == 25_000
