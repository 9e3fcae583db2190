"""Report queries over gold: the dashboard pages and the warehouse SQL of
the README, as DataFrames.

Top-k queries order by their measure and then by name, so ties at the
cut-off are deterministic; ``orderBy(...).limit(n)`` plans as
``TakeOrderedAndProject`` (a per-partition top-n then a merge of n rows
per partition), so no full sort or shuffle of the input happens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aevia.functions.exprs import period_label


def kpi(overview: DataFrame) -> DataFrame:
    """REP1: total, serious, death, rate."""
    return overview.select("total_reports", "serious_reports", "death_reports", "seriousness_rate_pct")


def trend(monthly: DataFrame, drop_unknown: bool = False) -> DataFrame:
    """REP2: monthly counts with a ``YYYY-MM`` label, in calendar order."""
    df = monthly
    if drop_unknown:
        df = df.where(F.col("year").isNotNull())
    return df.select(
        F.when(F.col("year").isNotNull(), period_label("year", "month")).alias("period"),
        "year",
        "month",
        "total_reports",
        "serious_reports",
    ).orderBy(F.col("year").asc_nulls_first(), F.col("month").asc_nulls_first())


def value_counts(df: DataFrame, col: str, name: str | None = None) -> DataFrame:
    """Non-null counts of one column, most frequent first."""
    name = name or col
    return (
        df.where(F.col(col).isNotNull())
        .groupBy(F.col(col).alias(name))
        .agg(F.count(F.lit(1)).alias("count"))
    )


def share(counts: DataFrame, count_col: str = "count") -> DataFrame:
    """Adds ``pct`` = count / total * 100 over an already aggregated frame
    (one row per distinct value, so the window's single partition is
    bounded by the number of values, not by the data)."""
    total = F.sum(count_col).over(Window.partitionBy(F.lit(0)))
    return counts.withColumn("pct", F.round(F.col(count_col) / total * 100, 2))


def sex_share(features: DataFrame) -> DataFrame:
    """REP3: report share by sex (null sex is left out, as value counts do)."""
    return share(value_counts(features, "patient_sex", "sex"))


def top_countries(features: DataFrame, n: int = 15) -> DataFrame:
    """REP4 / TOP5."""
    return value_counts(features, "country").orderBy(F.desc("count"), "country").limit(n)


def top_drugs(drug_summary: DataFrame, n: int = 20) -> DataFrame:
    """REP5 / TOP1: by volume."""
    return drug_summary.orderBy(F.desc("total_reports"), "drug_name").limit(n)


def top_rate_drugs(drug_summary: DataFrame, n: int = 20) -> DataFrame:
    """REP6 / TOP2: by seriousness rate (nulls rank last), shown ascending."""
    top = drug_summary.orderBy(F.desc_nulls_last("seriousness_rate_pct"), "drug_name").limit(n)
    return top.orderBy(F.asc_nulls_first("seriousness_rate_pct"), F.desc("drug_name"))


def drug_detail(drug_summary: DataFrame, n: int = 20) -> DataFrame:
    """REP7: display table of the top drugs."""
    return top_drugs(drug_summary, n).select(
        F.col("drug_name").alias("Drug"),
        F.col("total_reports").alias("Total Reports"),
        F.col("serious_reports").alias("Serious"),
        F.col("seriousness_rate_pct").alias("Seriousness Rate (%)"),
    )


def top_reactions(reaction_summary: DataFrame, n: int = 20) -> DataFrame:
    """REP8 / TOP3."""
    return reaction_summary.orderBy(F.desc("total_reports"), "reaction_name").limit(n)


def signal_scatter(pairs: DataFrame, min_pairs: int = 5) -> DataFrame:
    """REP9 / FLT6: pairs seen at least ``min_pairs`` times."""
    return pairs.where(F.col("pair_count") >= min_pairs).select(
        "drug_name", "reaction_name", "pair_count", "serious_count", "seriousness_rate_pct"
    )


def top_pairs(pairs: DataFrame, n: int = 20) -> DataFrame:
    """REP10 / TOP4: display table of the most frequent pairs."""
    return (
        pairs.orderBy(F.desc("pair_count"), "drug_name", "reaction_name")
        .limit(n)
        .select(
            F.col("drug_name").alias("Drug"),
            F.col("reaction_name").alias("Reaction"),
            F.col("pair_count").alias("Pair Count"),
            F.col("serious_count").alias("Serious"),
            F.col("seriousness_rate_pct").alias("Seriousness Rate (%)"),
        )
    )


def top_serious_drugs(drug_summary: DataFrame, n: int = 20) -> DataFrame:
    """TOP7 (warehouse SQL): drugs by serious reports."""
    return drug_summary.orderBy(F.desc_nulls_last("serious_reports"), "drug_name").limit(n).select(
        "drug_name", "total_reports", "serious_reports", "seriousness_rate_pct"
    )


def signal_pairs(pairs: DataFrame, min_count: int = 10, n: int = 20) -> DataFrame:
    """TOP8 (warehouse SQL): frequent pairs with the highest seriousness."""
    return (
        pairs.where(F.col("pair_count") >= min_count)
        .orderBy(F.desc_nulls_last("seriousness_rate_pct"), "drug_name", "reaction_name")
        .limit(n)
        .select("drug_name", "reaction_name", "pair_count", "seriousness_rate_pct")
    )


def signal_pairs_sql(spark, pairs: DataFrame, min_count: int = 10, n: int = 20) -> DataFrame:
    """TOP8 through Spark SQL, as a warehouse user writes it; the frame is an
    argument, so no view stays behind in the session."""
    return spark.sql(
        """
        SELECT drug_name, reaction_name, pair_count, seriousness_rate_pct
        FROM {pairs}
        WHERE pair_count >= {min_count}
        ORDER BY seriousness_rate_pct DESC NULLS LAST, drug_name, reaction_name
        LIMIT {n}
        """,
        pairs=pairs, min_count=int(min_count), n=int(n),
    )
