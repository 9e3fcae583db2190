"""What may not grow with the tables: what the driver holds, how often the
reports are built, what one task sorts, how many files pages take."""

import glob
import re

import pytest
from pyspark.sql import functions as F

from aevia.operators import gold as G
from aevia.operators import partials as PT
from aevia.operators import quality as Q
from aevia.operators import silver as S
from aevia.operators import top_pairs as TP
from aevia.plans import incremental_gold as IG
from aevia.plans import pipeline as P
from aevia.plans import queries as QU
from aevia.sources import bronze as B
from aevia.sources import storage as T
from aevia.sources import testbed
from conftest import SF_SMALL, report


def planned(spark, df) -> str:
    """The plan by file sizes alone."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return df.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_reports_are_never_broadcast(spark, scratch, bronze_of):
    """Tables of a row a report are small files, and large in the driver."""
    B.land_bronze(bronze_of([report(str(i)) for i in range(30)] + [report(None)]), f"{scratch}/bronze", 2024, 1)
    P.run_bronze_to_silver(spark, f"{scratch}/bronze", scratch, 2024, 1)
    s = IG._silver_of(spark, scratch, "2024-01")
    ev, dr, rx = (T.read_table(spark, scratch, "silver", n) for n in IG.SILVER_TABLES)
    frames = {
        "silver of a period": s["drugs"], "summary": G.drug_summary(ev, dr), "features": G.ml_features(ev, dr, rx),
        "features side by side": G.ml_features(ev, dr, rx, side_by_side=True), "pairs": G.drug_reaction_pairs(ev, dr, rx),
        "parts": PT.mention_parts(rx, ev, "reaction_name"), "latest": P.read_silver(spark, scratch)["drugs"],
        "orphans": Q.orphan_check(dr, ev), "bounds": TP._bounds(dr, rx, "drug_name", "reaction_name"),
    }
    for name, df in frames.items():
        plan = planned(spark, df)
        joins = re.findall(r"BroadcastHashJoin \[[^]]*\], \[[^]]*\], (\w+)", plan)
        # but for the crowded reports, one in a thousand names at most
        assert "SortMergeJoin" in plan and joins == (["LeftAnti"] if name == "pairs" else []), (name, joins)


def test_taken_back_reports_are_never_broadcast(spark, scratch, bronze_of, monkeypatch):
    seen = []
    monkeypatch.setattr(T, "replace_period", lambda df, root, layer, name, *a, keep=T.replace_period: seen.append(
        (name, planned(spark, df))) or keep(df, root, layer, name, *a))
    for month, ids in ((1, range(20)), (2, range(10, 30))):
        B.land_bronze(bronze_of([report(str(i)) for i in ids]), f"{scratch}/bronze", 2024, month)
        P.run_bronze_to_silver(spark, f"{scratch}/bronze", scratch, 2024, month)
        P.run_build_gold(spark, scratch, P.period_of(2024, month))
    joined = {name for name, plan in seen if "BroadcastHashJoin" in plan}
    assert {"removed_drugs", "superseded", "features", "ml_features"} <= {name for name, _ in seen}
    assert joined <= {"added_pairs", "removed_pairs"}  # crowded reports alone


def test_lines_are_dealt_by_their_number(spark, monkeypatch):
    whole = testbed.bronze(spark, SF_SMALL)
    plan = planned(spark, whole)
    assert [b for b in re.findall(r"BroadcastExchange.*", plan)] and plan.count("BroadcastExchange") == 1  # countries
    rows = sorted(map(str, whole.collect()))
    monkeypatch.setattr(testbed, "TASK_LINES", 500)
    dealt = testbed._children(spark, SF_SMALL)
    lines = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    assert dealt.rdd.getNumPartitions() == -(-lines // 500) > 4
    assert sorted(map(str, testbed.bronze(spark, SF_SMALL).collect())) == rows


@pytest.mark.parametrize("key", ["dq_gold", "dq_orphans", "prof_value_counts", "bound_signal_pairs", "publish_roundtrip", "bucketed_drug_summary"])
def test_reports_are_built_once(spark, monkeypatch, key):
    """Silver is made of written reports, not of the tables again."""
    seen = []
    monkeypatch.setattr(QU.S, "build_silver", lambda bronze, keep=S.build_silver: seen.append(bronze) or keep(bronze))
    monkeypatch.setattr(QU, "_CONTEXTS", {})
    out = QU.QUERIES[key](spark, SF_SMALL)
    plans = [df._jdf.queryExecution().toString() for df in (*seen, out)]
    assert len(seen) == 1 and not any("l_returnflag" in p for p in plans)


def test_features_of_models_are_built_once(spark, monkeypatch):
    monkeypatch.setattr(QU, "_CONTEXTS", {})
    c = QU.context(spark, SF_SMALL)
    features = QU._features(c)
    assert "l_returnflag" not in features._jdf.queryExecution().toString()
    assert sorted(map(str, features.collect())) == sorted(map(str, c.gold["ml_features"].collect()))


def test_pages_kept_as_lines(spark, scratch, bronze_of):
    rows = bronze_of([report(str(i)) for i in range(95)]).withColumn("k", F.col("safetyreportid").cast("int"))
    B.write_page_lines(rows, "k", scratch, page_size=10)
    assert len(glob.glob(scratch.removeprefix("file:") + "/*.json")) <= 4  # not a file a page
    pages = B.read_page_files(spark, scratch, lines=True)
    assert sorted(r.skip for r in pages.collect()) == list(range(0, 100, 10))
    got = B.read_pages(spark, scratch, lines=True)
    assert sorted(map(str, got.select(*B.REPORT_COLS).collect())) == sorted(map(str, rows.select(*B.REPORT_COLS).collect()))
    as_texts = B.unwrap_pages(B.page_bodies(rows, "k", 10)).select((F.col("page") * 10).alias("skip"), "pos", "safetyreportid")
    assert sorted(map(str, as_texts.collect())) == sorted(map(str, got.select("skip", "pos", "safetyreportid").collect()))
    # a page cut short, one without reports and one that never came
    spark.createDataFrame([('{"skip": 100, "results": [{"safetyrep',), ('{"skip": 110, "results": []}',), ('{"skip": 130}',)], "value string").coalesce(
        1).write.mode("append").text(scratch)
    audit = B.audit_pages(B.read_page_files(spark, scratch, lines=True), 10).first().asDict()
    assert audit == {"files": 13, "pages": 12, "empty_pages": 2, "missing_pages": 2, "corrupt": 1, "reports": 95}
    with pytest.raises(Q.DataQualityError):
        P.run_pipeline(spark, 2024, 1, f"{scratch}-bronze", f"{scratch}-lake", pages_path=scratch, page_lines=True)
