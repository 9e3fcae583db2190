"""Profiling queries (the exploration notebooks, as distributed
aggregations). Each returns a small DataFrame; none collects data-sized
results.

Exact medians use Spark's ``median`` (an exact percentile whose buffer is a
value -> frequency map), applied to low-cardinality columns such as ages in
whole years, so the buffer is bounded by the number of distinct values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aevia.functions import exprs as X
from aevia.operators.reports import share, value_counts
from aevia.schemas import SERIOUS_LABELS, SEX_LABELS

HIST_BINS = 30


def raw_flat(bronze: DataFrame) -> DataFrame:
    """PRJ23: one raw report -> ten scalar columns; missing objects give
    nulls (arrays count 0)."""
    return bronze.select(
        F.col("safetyreportid").alias("safety_report_id"),
        F.col("receivedate").alias("receive_date_raw"),
        F.col("serious"),
        F.col("seriousnessdeath").alias("serious_death"),
        F.col("seriousnesshospitalization").alias("serious_hospitalization"),
        F.col("primarysourcecountry").alias("country"),
        F.col("patient.patientonsetage").alias("patient_age"),
        F.col("patient.patientsex").alias("patient_sex"),
        X.size_or_zero("patient.drug").alias("num_drugs"),
        X.size_or_zero("patient.reaction").alias("num_reactions"),
    )


def _melt(df: DataFrame, source: str, cols: dict) -> DataFrame:
    """(source, column_name, value) rows for several columns of one frame:
    one scan, the values side by side in an exploded array."""
    items = [
        F.struct(F.lit(name).alias("column_name"), (F.col(c) if isinstance(c, str) else c).cast("string").alias("value"))
        for name, c in cols.items()
    ]
    return df.select(F.lit(source).alias("source"), F.inline(F.array(*items)))


def value_count_profile(bronze: DataFrame, events: DataFrame, drugs: DataFrame, reactions: DataFrame,
                        features: DataFrame) -> DataFrame:
    """AGG9 at every site of the notebooks and dashboard, as one long frame
    (source, column_name, value, count): each source frame is melted in one
    scan, and one grouped aggregation (map-side combined) counts them all."""
    raw = raw_flat(bronze)
    long = (
        _melt(raw, "raw", {
            "serious": X.relabel("serious", SERIOUS_LABELS),
            "patient_sex": X.code_label("patient_sex", SEX_LABELS),
            "country": "country",
            "num_drugs": "num_drugs",
        })
        .unionByName(_melt(events, "silver", {
            "country": "country",
            "patient_sex": "patient_sex",
            "is_serious": "is_serious",
            "report_day": F.dayofmonth("report_date"),
        }))
        .unionByName(_melt(drugs, "silver", {"drug_role": "drug_role", "drug_name": "drug_name"}))
        .unionByName(_melt(reactions, "silver", {"reaction_name": "reaction_name"}))
        .unionByName(_melt(features, "features", {
            "is_serious": F.coalesce(F.col("is_serious"), F.lit(0)),
            "num_drugs": "num_drugs",
            "num_reactions": "num_reactions",
            "has_suspect_drug": "has_suspect_drug",
        }))
    )
    return (
        long.where(F.col("value").isNotNull())
        .groupBy("source", "column_name", "value")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def country_seriousness(bronze: DataFrame, k: int = 10) -> DataFrame:
    """AGG10 over the top-k reporting countries (raw reports): rate of
    ``serious == "1"`` and report count. The top-k list has k rows, so the
    semi join broadcasts a frame of proven size."""
    raw = raw_flat(bronze).where(F.col("country").isNotNull())
    top = value_counts(raw, "country").orderBy(F.desc("count"), "country").limit(k).select("country")
    return (
        raw.join(F.broadcast(top), "country", "left_semi")
        .groupBy("country")
        .agg(
            F.round(F.avg(X.raw_equals_flag("serious")) * 100, 2).alias("seriousness_rate_pct"),
            F.count(F.lit(1)).alias("total_reports"),
        )
    )


def age_stats(events: DataFrame) -> DataFrame:
    """AGG11 on silver ages (already unit-scaled and range-checked)."""
    a = F.col("patient_age")
    return events.agg(
        F.min(a).alias("min_age"),
        F.max(a).alias("max_age"),
        F.median(a).alias("median_age"),
        F.round(F.avg(a), 4).alias("mean_age"),
        F.count_if(a.isNull()).alias("null_ages"),
        F.round(F.try_divide(F.count_if(a.isNull()).cast("double"), F.count(F.lit(1))) * 100, 2).alias(
            "null_age_pct"
        ),
    )


def drug_buckets(bronze: DataFrame) -> DataFrame:
    """AGG12 on raw reports: reports with 1, 2, 3+ drugs, max, mean."""
    n = X.size_or_zero("patient.drug")
    return bronze.select(n.alias("n")).agg(
        F.count_if(F.col("n") == 1).alias("reports_1_drug"),
        F.count_if(F.col("n") == 2).alias("reports_2_drugs"),
        F.count_if(F.col("n") >= 3).alias("reports_3plus_drugs"),
        F.max("n").alias("max_drugs"),
        F.round(F.avg("n"), 4).alias("avg_drugs"),
    )


def drugs_per_report(drugs: DataFrame) -> DataFrame:
    """AGG21 on silver: mentions per report id (null ids left out)."""
    per = drugs.where(F.col("safety_report_id").isNotNull()).groupBy("safety_report_id").agg(
        F.count(F.lit(1)).alias("n")
    )
    return per.agg(
        F.count_if(F.col("n") == 1).alias("reports_1_drug"),
        F.count_if(F.col("n") == 2).alias("reports_2_drugs"),
        F.count_if(F.col("n") >= 3).alias("reports_3plus_drugs"),
        F.round(F.avg("n"), 4).alias("avg_drugs"),
    )


def age_histogram(events: DataFrame, bins: int = HIST_BINS) -> DataFrame:
    """AGG13: equal-width histogram of valid ages. Reports are counted per
    age first, in the one pass over the input; the range and the bins come
    from those counts (whole years, 121 rows at most)."""
    ages = events.where(F.col("patient_age").isNotNull()).groupBy("patient_age").agg(F.count(F.lit(1)).alias("n"))
    every = Window.partitionBy(F.lit(1))
    low = F.min("patient_age").over(every).cast("double")
    width = (F.max("patient_age").over(every).cast("double") - low) / bins
    binned = ages.select("n", "patient_age", low.alias("low"), width.alias("width")).select(
        "n", "low", "width", F.when(F.col("width") > 0, F.least(
            F.floor((F.col("patient_age") - F.col("low")) / F.col("width")), F.lit(bins - 1))).otherwise(0).cast("int").alias("bin"))
    return binned.groupBy("bin", "low", "width").agg(F.sum("n").alias("count")).select(
        "bin",
        F.round(F.col("low") + F.col("bin") * F.col("width"), 6).alias("lower"),
        F.round(F.col("low") + (F.col("bin") + 1) * F.col("width"), 6).alias("upper"),
        "count",
    )


def null_rates(df: DataFrame) -> DataFrame:
    """AGG14 + FLT8: null percentage per column, only columns with nulls.
    One aggregation over all columns, then unpivoted."""
    cols = df.columns
    one = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in cols])
    long = one.unpivot([], cols, "column_name", "null_rate")
    return long.where(F.col("null_rate") > 0).select(
        "column_name", F.round(F.col("null_rate") * 100, 4).alias("null_pct")
    )


def class_balance(features: DataFrame) -> DataFrame:
    """AGG15: target classes (null counts as 0) with their share."""
    y = F.coalesce(F.col("is_serious"), F.lit(0)).cast("int")
    counts = features.groupBy(y.alias("is_serious")).agg(F.count(F.lit(1)).alias("count"))
    return share(counts)


def raw_summary(bronze: DataFrame) -> DataFrame:
    """AGG17 + AGG20: one-row summary of raw reports.

    Report-grain and mention-grain measures come from one aggregation over a
    tagged union of the three grains (no join of one-row frames)."""
    raw = raw_flat(bronze)
    age_num = F.col("patient_age").try_cast("double")
    reports = raw.select(
        F.lit("r").alias("tag"),
        F.col("serious"),
        F.col("country"),
        age_num.alias("age"),
        F.col("num_drugs"),
        F.col("num_reactions"),
        F.lit(None).cast("string").alias("name"),
    )
    drugs = bronze.select(F.explode("patient.drug").alias("d")).select(
        F.lit("d").alias("tag"),
        F.lit(None).cast("string").alias("serious"),
        F.lit(None).cast("string").alias("country"),
        F.lit(None).cast("double").alias("age"),
        F.lit(None).cast("int").alias("num_drugs"),
        F.lit(None).cast("int").alias("num_reactions"),
        X.drug_name("d.medicinalproduct").alias("name"),
    )
    reactions = bronze.select(F.explode("patient.reaction").alias("x")).select(
        F.lit("x").alias("tag"),
        F.lit(None).cast("string").alias("serious"),
        F.lit(None).cast("string").alias("country"),
        F.lit(None).cast("double").alias("age"),
        F.lit(None).cast("int").alias("num_drugs"),
        F.lit(None).cast("int").alias("num_reactions"),
        X.reaction_name("x.reactionmeddrapt").alias("name"),
    )
    u = reports.unionByName(drugs).unionByName(reactions)
    is_r = F.col("tag") == "r"
    named = X.not_blank("name")
    total = F.count_if(is_r)
    serious = F.count_if(is_r & (F.col("serious") == "1"))
    null_age = F.count_if(is_r & F.col("age").isNull())
    return u.agg(
        total.alias("total_reports"),
        serious.alias("serious_reports"),
        F.round(F.try_divide(serious.cast("double"), total) * 100, 2).alias("seriousness_rate_pct"),
        F.count_distinct(F.when(is_r, F.col("country"))).alias("unique_countries"),
        F.count_if((F.col("tag") == "d") & named).alias("drug_mentions"),
        F.count_distinct(F.when((F.col("tag") == "d") & named, F.col("name"))).alias("unique_drugs"),
        F.count_if((F.col("tag") == "x") & named).alias("reaction_mentions"),
        F.count_distinct(F.when((F.col("tag") == "x") & named, F.col("name"))).alias("unique_reactions"),
        null_age.alias("null_age_reports"),
        F.round(F.try_divide(null_age.cast("double"), total) * 100, 2).alias("null_age_pct"),
        F.round(F.avg(F.when(is_r, F.col("num_drugs"))), 4).alias("avg_drugs"),
        F.round(F.avg(F.when(is_r, F.col("num_reactions"))), 4).alias("avg_reactions"),
    )


def date_range(events: DataFrame) -> DataFrame:
    """AGG18."""
    d = F.col("report_date")
    return events.agg(
        F.min(d).alias("first_date"), F.max(d).alias("last_date"), F.count_if(d.isNull()).alias("null_dates")
    )


def shapes(tables: dict[str, DataFrame]) -> DataFrame:
    """AGG19: rows and columns per table."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).alias("n_cols")
        )
        out = one if out is None else out.unionByName(one)
    return out


def key_presence(raw_json: DataFrame, col: str = "props") -> DataFrame:
    """AGG16: per top-level JSON key, the number and percentage of records
    that carry it. Keys come from ``json_object_keys`` on the raw text; the
    record total is carried through the same pass, as the count of a null
    key that every record gets."""
    keys = F.array_distinct(F.coalesce(F.json_object_keys(F.col(col)), F.array().cast("array<string>")))
    marked = raw_json.select(F.explode(F.concat(F.array(F.lit(None).cast("string")), keys)).alias("key"))
    counts = marked.groupBy("key").agg(F.count(F.lit(1)).alias("records"))
    total = F.max(F.when(F.col("key").isNull(), F.col("records"))).over(Window.partitionBy(F.lit(1)))
    return counts.select("key", "records", F.round(F.col("records") / total * 100, 2).alias("pct")).where(F.col("key").isNotNull())


# The top-k lists of the exploration notebooks.
TOP_LISTS = {
    "raw_countries": 20,
    "raw_drugs": 25,
    "raw_reactions": 25,
    "silver_drugs": 15,
    "silver_reactions": 15,
}


def top_values(df: DataFrame, col: str, k: int, list_name: str) -> DataFrame:
    """TOP6: the k most frequent non-null values (value ascending breaks
    ties); a per-partition top-k, no full sort."""
    return (
        df.where(F.col(col).isNotNull())
        .groupBy(F.col(col).cast("string").alias("value"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "value")
        .limit(k)
        .select(F.lit(list_name).alias("list_name"), "value", "count")
    )


def top_value_lists(bronze: DataFrame, drugs: DataFrame, reactions: DataFrame) -> DataFrame:
    raw = raw_flat(bronze)
    raw_d = bronze.select(F.explode("patient.drug").alias("d")).select(X.drug_name("d.medicinalproduct").alias("v"))
    raw_r = bronze.select(F.explode("patient.reaction").alias("r")).select(
        X.reaction_name("r.reactionmeddrapt").alias("v")
    )
    parts = [
        top_values(raw, "country", TOP_LISTS["raw_countries"], "raw_countries"),
        top_values(raw_d.where(X.not_blank("v")), "v", TOP_LISTS["raw_drugs"], "raw_drugs"),
        top_values(raw_r.where(X.not_blank("v")), "v", TOP_LISTS["raw_reactions"], "raw_reactions"),
        top_values(drugs, "drug_name", TOP_LISTS["silver_drugs"], "silver_drugs"),
        top_values(reactions, "reaction_name", TOP_LISTS["silver_reactions"], "silver_reactions"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
