"""Batch jobs: bronze -> silver -> quality gate -> gold -> publish.

Every job takes the caller's ``SparkSession``; the period is a parameter.
Stages hand over through written tables, so each stage's lineage starts at
storage and a lost executor only recomputes from the last written table.
"""

from __future__ import annotations

import logging
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aevia.operators import gold as G
from aevia.operators import quality as Q
from aevia.operators import silver as S
from aevia.plans.incremental_gold import update_gold
from aevia.sources import bronze as B
from aevia.sources import storage as T
from aevia.sources.snapshots import Snapshots

log = logging.getLogger(__name__)

SILVER_TABLES = ("adverse_events", "drugs", "reactions")


def period_of(year: int, month: int) -> str:
    return f"{int(year):04d}-{int(month):02d}"


def run_bronze_to_silver(spark: SparkSession, bronze_root: str, lake_root: str, year: int, month: int,
                         mode: str = "dynamic", dedupe_reports: bool = False, max_corrupt: int = 0) -> dict[str, str]:
    """JOB1: one month of bronze (line or array files) -> three silver
    tables.

    ``mode="dynamic"`` (default) keeps a ``period`` partition per run month
    and replaces that month whole, also by nothing; ``mode="replace"``
    rewrites the tables whole, so gold sees only the last month processed.
    ``dedupe_reports`` also drops repeated reports from the child tables
    (the default keeps them, as the source semantics do). The load audit is
    stored first, and more than ``max_corrupt`` unreadable records stop the
    month.
    """
    period = period_of(year, month)
    # The audit and the three builders read the same month: parse the JSON once,
    # into a file and not into the executors' memory, which the reports of a
    # large month fill (blocks that leave it are serialized on the heap).
    parsed = f"{lake_root.rstrip('/')}/_parsed-{uuid.uuid4().hex}"
    raw = B.read_bronze_raw(spark, bronze_root, year, month)
    try:
        raw.write.parquet(parsed)
        raw = spark.read.schema(raw.schema).parquet(parsed)
        store_audit(spark, B.audit_bronze(raw), lake_root, "bronze", period, max_corrupt)
        src = raw.where(F.col(B.CORRUPT).isNull()).select(*B.REPORT_COLS)
        tables = S.build_silver(src.dropDuplicates() if dedupe_reports else src)
        if mode == "dynamic":
            paths = T.together(spark, [lambda n=n: T.replace_period(tables[n], lake_root, "silver", n, period) for n in SILVER_TABLES])
            return dict(zip(SILVER_TABLES, paths))
        return {n: T.write_table(tables[n], lake_root, "silver", n) for n in SILVER_TABLES}
    finally:
        T.drop_folder(spark, parsed)


def store_audit(spark: SparkSession, audit: DataFrame, lake_root: str, source: str, period: str, max_corrupt: int = 0) -> dict:
    """Keep a load audit row (``quality/load_audit``, one partition per
    source and period), then raise ``DataQualityError`` if records could not
    be read or pages are missing."""
    path = f"{lake_root.rstrip('/')}/quality/load_audit/source={source}/period={period}"
    audit.write.mode("overwrite").parquet(path)
    row = spark.read.parquet(path).first().asDict()
    if row["corrupt"] > max_corrupt or row["missing_pages"]:
        raise Q.DataQualityError(f"load audit of {source} {period} failed: {row}")
    return row


def read_silver(spark: SparkSession, lake_root: str, period: str | None = None) -> dict[str, DataFrame]:
    """Silver tables in their declared schemas: one ``period``, or all.

    A report id sent again in a later month exists in several periods: the
    latest period wins (de-duplicated like within a month, period first),
    and drug and reaction rows are kept only from that period (a semi join
    on id and period; rows without an id are kept as they are). The plan is
    the same for one period and for many.
    """
    raw = {n: spark.read.parquet(f"{lake_root.rstrip('/')}/silver/{n}") for n in SILVER_TABLES}
    cols = {n: [f.name for f in T.SILVER[n].fields] for n in SILVER_TABLES}
    if period is not None:
        return {n: raw[n].where(F.col("period") == period).select(*cols[n]) for n in SILVER_TABLES}
    if "period" not in raw["adverse_events"].columns:  # written by mode="replace"
        return {n: raw[n].select(*cols[n]) for n in SILVER_TABLES}
    ev = raw["adverse_events"].withColumn("period", F.col("period").cast("string"))
    rest = [c for c in cols["adverse_events"] if c != "safety_report_id"]
    latest = (
        ev.groupBy("safety_report_id").agg(F.max(F.struct("period", *rest)).alias("_s")).select("safety_report_id", "_s.*")
    )
    keys = latest.select("safety_report_id", "period")
    out = {"adverse_events": latest.select(*cols["adverse_events"])}
    for n in ("drugs", "reactions"):
        df = raw[n].withColumn("period", F.col("period").cast("string"))
        kept = df.join(G.of_reports(keys), ["safety_report_id", "period"], "left_semi").unionByName(
            df.where(F.col("safety_report_id").isNull())
        )
        out[n] = kept.select(*cols[n])
    return out


def run_quality_gate(spark: SparkSession, lake_root: str, period: str | None = None) -> list[dict]:
    """DQ12: store the silver check results of ``period`` (or of the whole
    tables), then raise ``DataQualityError`` before gold if a suite fails.

    The results (one row per rule) are written to ``quality/silver_checks``
    first, one partition per run period, so a failed gate leaves its
    evidence; the gate then reads back the rule-sized table."""
    results = Q.silver_results(read_silver(spark, lake_root, period))
    return _store_and_enforce(spark, results, f"{lake_root.rstrip('/')}/quality/silver_checks", period or "all")


def run_build_gold(spark: SparkSession, lake_root: str, period: str | None = None) -> dict[str, str]:
    """JOB2: silver -> the six gold tables.

    With the run ``period``, gold takes up what the period adds and drops what
    it supersedes (``incremental_gold``). Without, all is built anew: the
    periods are merged once, into ``silver_current``, which all gold tables
    read."""
    if period is not None:
        return update_gold(spark, lake_root, period)
    for name, df in read_silver(spark, lake_root).items():
        T.write_table(df, lake_root, "silver_current", name)
    s = {n: T.read_table(spark, lake_root, "silver_current", n) for n in SILVER_TABLES}
    gold = G.build_gold(s["adverse_events"], s["drugs"], s["reactions"])
    paths = T.together(spark, [lambda n=n: T.write_table(gold[n], lake_root, "gold", n) for n in T.GOLD_ORDER])
    return dict(zip(T.GOLD_ORDER, paths))


def _store_and_enforce(spark: SparkSession, results: DataFrame, path: str, period: str) -> list[dict]:
    results.withColumn("period", F.lit(period)).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("period").parquet(path)
    return Q.enforce(spark.read.parquet(path).where(F.col("period") == period).drop("period"))


def run_gold_gate(spark: SparkSession, lake_root: str, period: str | None = None) -> list[dict]:
    """DQ13 as a gate: store the gold check results (``quality/gold_checks``),
    then raise if a gold invariant fails, before anything is published."""
    results = Q.run_gold_suite(read_gold(spark, lake_root), with_seq=True)
    return _store_and_enforce(spark, results, f"{lake_root.rstrip('/')}/quality/gold_checks", period or "all")


def read_gold(spark: SparkSession, lake_root: str) -> dict[str, DataFrame]:
    return {n: T.read_table(spark, lake_root, "gold", n) for n in T.GOLD_ORDER}


def run_pipeline(spark: SparkSession, year: int, month: int, bronze_root: str, lake_root: str,
                 pages_path: str | None = None, publish_root: str | None = None,
                 mode: str = "dynamic", snapshots: bool = False, page_lines: bool = False) -> dict:
    """JOB3: ingest -> silver -> quality -> gold -> publish for one month.

    With ``pages_path`` the month is first landed from page files (with
    ``page_lines`` from files of a page a line); gold is
    built only when the silver gate passes, and published only when the
    gold tables pass their own suite: in place, or with ``snapshots`` as one
    snapshot of all tables (``sources.snapshots``), whose number is returned.
    """
    B.check_period(year, month)
    result: dict = {"period": period_of(year, month)}
    if pages_path:
        store_audit(spark, B.audit_pages(B.read_page_files(spark, pages_path, page_lines)), lake_root, "pages", result["period"])
        result["bronze"] = B.land_bronze(B.read_pages(spark, pages_path, page_lines), bronze_root, year, month)
    result["silver"] = run_bronze_to_silver(spark, bronze_root, lake_root, year, month, mode=mode)
    result["quality"] = run_quality_gate(spark, lake_root, result["period"] if mode == "dynamic" else None)
    result["gold"] = run_build_gold(spark, lake_root, result["period"] if mode == "dynamic" else None)
    # output invariants of the written gold tables gate publishing
    result["gold_quality"] = run_gold_gate(spark, lake_root, result["period"])
    if publish_root and snapshots:
        result["published"] = Snapshots(spark, publish_root).publish(read_gold(spark, lake_root))
    elif publish_root:
        result["published"] = T.publish_gold(read_gold(spark, lake_root), publish_root)
    return result
