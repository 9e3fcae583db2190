"""Feature preparation and the train/test split (ML1-ML5).

Everything is fitted with distributed aggregations:

* one aggregation fits both the label encoding of ``patient_sex`` and
  ``country`` (sorted distinct values, so codes equal a sorted-distinct
  encoder's) and the median fill (Spark's exact ``median``: an exact
  percentile whose buffer is a value -> frequency map, bounded by the number
  of distinct values of these small integer features);
* the split assigns each report by a hash of its id, so it needs no
  shuffle and no per-class window.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aevia.schemas import FEATURE_COLS, RANDOM_STATE, TARGET_COL, TEST_SIZE

CATEGORICAL = ["patient_sex", "country"]
NUMERIC = ["patient_age", "num_drugs", "num_reactions", "has_suspect_drug"]
ID = "safety_report_id"


def fill_categories(df: DataFrame) -> DataFrame:
    """PRJ16: missing categories become the literal ``Unknown``."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("Unknown")) for c in CATEGORICAL})


def fit(df: DataFrame) -> dict:
    """One aggregation fits everything: the exact median of each numeric
    feature and the sorted distinct values of each category. Both are
    bounded by the number of distinct values (small integer domains, a few
    hundred categories at most), whatever the row count."""
    filled = fill_categories(df)
    row = filled.agg(
        *[F.median(F.col(c)).alias(c) for c in NUMERIC],
        *[F.array_sort(F.collect_set(F.col(c))).alias(f"{c}_levels") for c in CATEGORICAL],
    ).first()
    return {
        "medians": {c: row[c] for c in NUMERIC},
        "levels": {c: list(row[f"{c}_levels"] or []) for c in CATEGORICAL},
    }


def encode(col: str, levels: list[str]):
    """Alphabetical label code 0..k-1 (a sorted-distinct label encoder);
    a value unseen in the fit gets k."""
    if not levels:
        return F.lit(0.0)
    kv = []
    for i, v in enumerate(levels):
        kv += [F.lit(v), F.lit(float(i))]
    return F.coalesce(F.create_map(*kv)[F.col(col)], F.lit(float(len(levels))))


def prepare_features(df: DataFrame, fit_on: DataFrame | None = None) -> tuple[DataFrame, dict]:
    """ML1-ML4: (id, six numeric feature columns, label, features vector).

    Encoders and medians are fitted on ``fit_on`` (default: all rows, as the
    reference does before splitting; pass the training split to avoid the
    leakage). Codes are plain numbers (no nominal metadata), so tree models
    treat them as ordered values, like the reference's models do.
    """
    fitted = fit(df if fit_on is None else fit_on)
    med, levels = fitted["medians"], fitted["levels"]
    filled = fill_categories(df)
    cols = {
        "patient_sex": encode("patient_sex", levels["patient_sex"]),
        "country": encode("country", levels["country"]),
    }
    for c in NUMERIC:
        cols[c] = F.coalesce(F.col(c).cast("double"), F.lit(med[c]).cast("double"))
    out = filled.select(
        F.col(ID),
        *[cols[c].alias(c) for c in FEATURE_COLS],
        F.coalesce(F.col(TARGET_COL), F.lit(0)).cast("int").alias("label"),
    )
    out = VectorAssembler(inputCols=FEATURE_COLS, outputCol="features").transform(out)
    return out, fitted


def split_hash(id_col: str = ID, seed: int = RANDOM_STATE):
    """Eight hex digits that put the rows of a class in a fixed, shuffled
    order; the same text orders identically in any SQL engine."""
    return F.substring(F.md5(F.concat(F.col(id_col), F.lit(f":{seed}"))), 1, 8)


def with_split(df: DataFrame, label: str = "label", seed: int = RANDOM_STATE, test_size: float = TEST_SIZE) -> DataFrame:
    """ML5: adds ``is_test``, an exact stratified split: of each class the
    first ``round(test_size * rows)`` by hash (then id) are test rows.

    No class is sorted in one task. Rows are counted per class and leading
    three hex digits (4,096 counts a class); the running counts give the one
    prefix that holds the cut, and only the rows of that prefix are ranked.
    """
    h = df.select("*", split_hash(ID, seed).alias("_hash")).withColumn("_prefix", F.substring("_hash", 1, 3))
    counts = h.groupBy(label, "_prefix").agg(F.count(F.lit(1)).alias("n"))
    by_class = Window.partitionBy(label)
    before = by_class.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    quota = F.round(F.sum("n").over(by_class) * test_size) - F.coalesce(F.sum("n").over(before), F.lit(0))
    # of each prefix: how many of its rows are test rows (none, some, all)
    counts = counts.select(label, "_prefix", F.least(F.greatest(quota, F.lit(0)), F.col("n")).alias("_take"), F.col("n").alias("_n"))
    rows = h.join(F.broadcast(counts), [label, "_prefix"])
    place = F.row_number().over(Window.partitionBy(label, "_prefix").orderBy("_hash", ID))
    cut = (F.col("_take") > 0) & (F.col("_take") < F.col("_n"))
    whole = rows.where(~cut).withColumn("is_test", F.col("_take") > 0)
    ranked = rows.where(cut).withColumn("is_test", place <= F.col("_take"))
    return whole.unionByName(ranked).select(*df.columns, "is_test")


def train_test_split(df: DataFrame, seed: int = RANDOM_STATE, test_size: float = TEST_SIZE):
    """Training and test rows, stratified by the label (a missing target
    counts as 0, as in ``prepare_features``)."""
    if "label" in df.columns:
        split = with_split(df, "label", seed, test_size)
        return split.where(~F.col("is_test")).drop("is_test"), split.where("is_test").drop("is_test")
    target = df.withColumn("label", F.coalesce(F.col(TARGET_COL), F.lit(0)).cast("int"))
    train, test = train_test_split(target, seed, test_size)
    return train.drop("label"), test.drop("label")
