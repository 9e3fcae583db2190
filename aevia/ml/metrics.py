"""Binary-classification metrics as DataFrame aggregations (ML9-ML12).

ROC-AUC and the ROC curve need cumulative counts over scores in descending
order. A window ordered over the whole frame would pull every row into one
task, so the prefix sums are computed in three distributed steps:

1. aggregate to one row per distinct score (positives, negatives) - a
   score shared by a third of the rows is still one row;
2. cut the distinct scores into ranges at approximate quantiles (about
   200k distinct scores per range, 256 to 8192 ranges; the boundaries are
   fetched to the driver), total each range, and turn the range totals (one
   row per range, a proven bound) into offsets;
3. inside each range, a window partitioned by range adds the local running
   sum to the range's offset.

Exact: the quantiles only decide the grouping, never the result.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aevia.session import ensure_checkpoint_dir

MIN_RANGES = 256
MAX_RANGES = 8192  # offsets table size: bounded, so it is broadcast
SCORES_PER_RANGE = 200_000  # distinct scores sorted by one window task


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    y, p = F.col(label).cast("int"), F.col(prediction).cast("int")
    return df.agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
    )


def _ratio(num, den):
    return F.coalesce(F.try_divide(num.cast("double"), den), F.lit(0.0))


def classification_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """ML9: accuracy, precision, recall, F1 of class 1, rounded to 4 places;
    undefined ratios are 0."""
    c = confusion(df, label, prediction)
    tp, fp, tn, fn = (F.col(x) for x in ("tp", "fp", "tn", "fn"))
    precision = _ratio(tp, tp + fp)
    recall = _ratio(tp, tp + fn)
    f1 = _ratio(2 * tp, 2 * tp + fp + fn)
    return c.select(
        F.round(_ratio(tp + tn, tp + fp + tn + fn), 4).alias("accuracy"),
        F.round(precision, 4).alias("precision"),
        F.round(recall, 4).alias("recall"),
        F.round(f1, 4).alias("f1"),
    )


def class_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """ML12: per class precision, recall, F1 and support (rounded to 4)."""
    rows = []
    c = confusion(df, label, prediction)
    for cls in (0, 1):
        tp = F.col("tn") if cls == 0 else F.col("tp")
        fp = F.col("fn") if cls == 0 else F.col("fp")
        fn = F.col("fp") if cls == 0 else F.col("fn")
        rows.append(
            c.select(
                F.lit(cls).alias("class"),
                F.round(_ratio(tp, tp + fp), 4).alias("precision"),
                F.round(_ratio(tp, tp + fn), 4).alias("recall"),
                F.round(_ratio(2 * tp, 2 * tp + fp + fn), 4).alias("f1"),
                (tp + fn).alias("support"),
            )
        )
    return rows[0].unionByName(rows[1])


def score_counts(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    y = F.col(label).cast("int")
    return df.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg")
    )


def cumulative_by_score(counts: DataFrame, max_ranges: int | None = None) -> DataFrame:
    """Per distinct score: its positives and negatives, and the positives
    and negatives with a score >= it (``cum_pos``, ``cum_neg``)."""
    # The distinct-score counts are read twice (quantiles, then the sums):
    # write them once to the shared checkpoint folder instead of computing
    # the whole input twice.
    ensure_checkpoint_dir(counts.sparkSession)
    counts = counts.checkpoint(eager=True)
    if max_ranges is None:
        # about SCORES_PER_RANGE distinct scores per range, within bounds
        n = counts.count()
        max_ranges = min(MAX_RANGES, max(MIN_RANGES, n // SCORES_PER_RANGE + 1))
    qs = [i / max_ranges for i in range(1, max_ranges)]
    cuts = sorted(set(counts.approxQuantile("score", qs, 0.001))) if max_ranges > 1 else []
    splits = [float("-inf")] + [c for c in cuts] + [float("inf")]
    if len(splits) < 3:
        ranged = counts.withColumn("rng", F.lit(0.0))
    else:
        ranged = Bucketizer(splits=splits, inputCol="score", outputCol="rng", handleInvalid="keep").transform(counts)
    totals = ranged.groupBy("rng").agg(F.sum("pos").alias("rp"), F.sum("neg").alias("rn"))
    # ranges in descending score order; offsets = totals of higher ranges
    w_hi = Window.orderBy(F.desc("rng")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "rng",
        F.coalesce(F.sum("rp").over(w_hi), F.lit(0)).alias("op"),
        F.coalesce(F.sum("rn").over(w_hi), F.lit(0)).alias("on"),
    )
    w_in = Window.partitionBy("rng").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.join(F.broadcast(offsets), "rng").select(
        "score",
        "pos",
        "neg",
        (F.col("op") + F.sum("pos").over(w_in)).alias("cum_pos"),
        (F.col("on") + F.sum("neg").over(w_in)).alias("cum_neg"),
    )
    return local


def roc_auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """ML10: one row ``roc_auc`` (ties count one half, null with one class)."""
    cum = cumulative_by_score(score_counts(df, label, score))
    # negatives strictly below score s = N - cum_neg(s)
    tot = cum.agg(
        F.sum("pos").alias("P"),
        F.sum("neg").alias("N"),
        F.sum(F.col("pos") * F.col("cum_neg") - F.col("pos") * F.col("neg") * F.lit(0.5)).alias("above"),
    )
    # AUC = P(score_pos > score_neg) + 0.5 P(tie)
    #     = (P*N - sum_s pos_s * (cum_neg_s - neg_s/2)) / (P*N)
    pn = F.col("P") * F.col("N")
    return tot.select(
        F.round(F.when(pn > 0, (pn - F.col("above")) / pn), 4).alias("roc_auc")
    )


def roc_points(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """ML11: (threshold, fpr, tpr) per distinct score, plus the (0, 0)
    start point (threshold null: above every score)."""
    counts = score_counts(df, label, score)
    cum = cumulative_by_score(counts)
    # one row; only the lowest score has all positives and negatives at or above it
    totals = cum.agg(F.max("cum_pos").alias("P"), F.max("cum_neg").alias("N"))

    def share(part: str, whole: str):
        return F.round(F.try_divide(F.col(part).cast("double"), F.col(whole)), 6)

    none = F.lit(None).cast("double")
    start = df.sparkSession.range(1).select(none.alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    # a one-row side joined on a constant: no pass of its own over the input
    points = cum.withColumn("_one", F.lit(1)).join(F.broadcast(totals.withColumn("_one", F.lit(1))), "_one")
    return start.unionByName(points.select(F.col("score").alias("threshold"), share("cum_neg", "N").alias("fpr"), share("cum_pos", "P").alias("tpr")))
