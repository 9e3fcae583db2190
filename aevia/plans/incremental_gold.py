"""Gold from what a run month adds and takes back.

The lake keeps, beside silver, the parts of every run period (see
``operators.partials``), all under ``gold_parts``:

* ``ids/period=P``: the report ids of period P;
* ``mentions_<name>/period=P``: the names that P's reports mention, counted by
  report, with its seriousness; all parts below are worked out from them;
* ``added_<part>/period=P``: what all reports of P add to gold;
* ``superseded/period=S``: the reports that S sends again, each with the
  period that held it last before S;
* ``lost_<name>/period=S``: the mentions of these earlier versions;
* ``removed_<part>/period=S``: what these earlier versions had added, negated;
* ``features/period=P``: the feature rows of P's reports.

Gold is the sum of all added and removed parts. A new period therefore reads
its own silver, the ids of the earlier ones, and the silver and mentions of
just those earlier periods that hold a report it sends again. A period that is run again
replaces its parts, and the periods after it work out anew what they
supersede (a report it no longer holds goes back to an earlier version); the
parts that they added stay. Every write replaces one period's folder whole, so
a job that is run again ends in the same state.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aevia.operators import gold as G
from aevia.operators import partials as PT
from aevia.schemas import GOLD
from aevia.sources import storage as T

log = logging.getLogger(__name__)

ID = G.ID
SILVER_TABLES = ("adverse_events", "drugs", "reactions")
LAYER = "gold_parts"
NAMES = {"drugs": "drug_name", "reactions": "reaction_name"}


def _read(spark: SparkSession, lake_root: str, layer: str, name: str, periods: list[str]) -> DataFrame | None:
    """The rows of ``periods`` of a period-partitioned table with a string
    ``period``; no other folder is listed or read."""
    path = f"{lake_root.rstrip('/')}/{layer}/{name}"
    frames = [spark.read.parquet(f"{path}/period={p}").withColumn("period", F.lit(p)) for p in periods]
    out = None
    for f in frames:
        out = f if out is None else out.unionByName(f)
    return out


def _silver_of(spark: SparkSession, lake_root: str, period: str) -> dict[str, DataFrame]:
    """Silver of one period; mentions of reports that the period does not
    hold are left out, those without an id stay."""
    s = {n: _read(spark, lake_root, "silver", n, [period]).drop("period") for n in SILVER_TABLES}
    known = s["adverse_events"].select(ID)
    for n in ("drugs", "reactions"):
        s[n] = s[n].where(F.col(ID).isNotNull()).join(G.of_reports(known), ID, "left_semi").unionByName(s[n].where(F.col(ID).isNull()))
    return s


def _parts(spark: SparkSession, lake_root: str, name: str, period: str) -> DataFrame:
    return _read(spark, lake_root, LAYER, name, [period]).drop("period")


def add_period(spark: SparkSession, lake_root: str, period: str) -> None:
    """Store what ``period`` adds, from its silver alone. Its mentions meet
    their reports once; mentions of reports that it does not hold are left
    out, those without an id stay."""
    ev, *mentions = (_read(spark, lake_root, "silver", n, [period]).drop("period") for n in SILVER_TABLES)
    _replace(spark, lake_root, {f"mentions_{n}": PT.report_mentions(m, ev, NAMES[n]) for n, m in zip(NAMES, mentions)}, period)
    dr, rx = (_parts(spark, lake_root, f"mentions_{n}", period) for n in NAMES)
    tables = {f"added_{name}": parts for name, parts in PT.all_parts(ev, dr, rx).items()}
    tables["features"] = G.features_of(ev, dr, rx)
    _replace(spark, lake_root, tables, period)
    # last: a period whose ids are there is whole
    T.replace_period(ev.select(ID), lake_root, LAYER, "ids", period)


def _replace(spark: SparkSession, lake_root: str, tables: dict[str, DataFrame], period: str) -> None:
    T.together(spark, [lambda n=n, df=df: T.replace_period(df, lake_root, LAYER, n, period) for n, df in tables.items()])


def supersede(spark: SparkSession, lake_root: str, period: str, known: list[str]) -> list[str]:
    """Store what ``period`` takes back of the earlier ones of ``known``
    periods; gives the periods that lose reports to it."""
    earlier = [p for p in known if p < period]
    ids = _read(spark, lake_root, LAYER, "ids", [period]).select(ID)
    none = spark.createDataFrame([], f"{ID} string, held string")
    old = none
    if earlier:
        held = _read(spark, lake_root, LAYER, "ids", earlier).withColumnRenamed("period", "held")
        old = held.join(G.of_reports(ids), ID, "left_semi").groupBy(ID).agg(F.max("held").alias("held"))
    T.replace_period(old, lake_root, LAYER, "superseded", period)
    old = spark.read.schema(none.schema).parquet(f"{lake_root.rstrip('/')}/{LAYER}/superseded/period={period}")
    # run months that lose reports: a few, never data-sized
    losing = sorted(r["held"] for r in old.select("held").distinct().collect())
    if not losing:
        _replace(spark, lake_root, {f"removed_{n}": spark.createDataFrame([], spark.read.parquet(
            f"{lake_root.rstrip('/')}/{LAYER}/added_{n}/period={period}").schema) for n in PT.KEYS}, period)
        return []

    def lost(layer: str, name: str) -> DataFrame:
        return _read(spark, lake_root, layer, name, losing).withColumnRenamed("period", "held").join(
            G.of_reports(old), [ID, "held"], "left_semi").drop("held")

    _replace(spark, lake_root, {f"lost_{n}": lost(LAYER, f"mentions_{n}") for n in NAMES}, period)
    parts = PT.all_parts(lost("silver", "adverse_events"), *(_parts(spark, lake_root, f"lost_{n}", period) for n in NAMES))
    _replace(spark, lake_root, {f"removed_{n}": PT.negated(df, n) for n, df in parts.items()}, period)
    return losing


def _write_features(spark: SparkSession, lake_root: str, known: list[str], periods: list[str]) -> None:
    """The feature rows of ``periods`` that no later period supersedes; gold
    keeps them by period, so other periods' folders stay as they are."""
    there = set(T.list_periods(spark, f"{lake_root.rstrip('/')}/gold/ml_features"))
    columns = [f.name for f in GOLD["ml_features"].fields]

    def current(ps: list[str]) -> DataFrame:
        rows = _read(spark, lake_root, LAYER, "features", ps).withColumnRenamed("period", "held")
        gone = _read(spark, lake_root, LAYER, "superseded", known).select(ID, "held")
        return rows.join(G.of_reports(gone), [ID, "held"], "left_anti")

    if not set(known) - set(periods) <= there:  # the table was not kept by period before
        df = current(known).withColumnRenamed("held", "period").select(*columns, "period")
        T.write_table(df, lake_root, "gold", "ml_features", ["period"], dynamic=False)
        return
    for p in periods:
        T.replace_period(current([p]).select(*columns), lake_root, "gold", "ml_features", p)


def update_gold(spark: SparkSession, lake_root: str, period: str) -> dict[str, str]:
    """JOB2 for one run period: the six gold tables of the lake after
    ``period`` was written to silver (for the first time or again). Periods
    whose parts are not there yet are added as well."""
    root = lake_root.rstrip("/")
    known = T.list_periods(spark, f"{root}/silver/adverse_events")
    if period not in known:
        raise ValueError(f"no silver of period {period}")
    have = set.intersection(*(set(T.list_periods(spark, f"{root}/{LAYER}/{n}")) for n in ("ids", *(f"mentions_{n}" for n in NAMES))))
    todo = [p for p in known if p == period or p not in have]
    for p in todo:
        add_period(spark, lake_root, p)
    changed = set(todo)
    for p in known:
        if p >= todo[0]:
            before = T.list_periods(spark, f"{root}/{LAYER}/superseded")
            if p in before:  # periods that may get reports back
                changed |= {r["held"] for r in spark.read.parquet(f"{root}/{LAYER}/superseded/period={p}").select("held").distinct().collect()}
            changed |= set(supersede(spark, lake_root, p, known))
    out = {"ml_features": f"{root}/gold/ml_features"}

    def write(name: str) -> None:
        parts = _read(spark, lake_root, LAYER, f"added_{name}", known).unionByName(
            _read(spark, lake_root, LAYER, f"removed_{name}", known))
        for table, df in PT.finished(name, PT.merged(parts.drop("period"), name)).items():
            out[table] = T.write_table(df, lake_root, "gold", table)

    T.together(spark, [lambda: _write_features(spark, lake_root, known, sorted(changed)), *(lambda n=n: write(n) for n in PT.KEYS)])
    return {n: out[n] for n in T.GOLD_ORDER}
