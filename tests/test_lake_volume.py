"""What the monthly lake writes and exchanges: reports land compressed and
where they are, mentions meet their reports once a period."""

import glob
import gzip
import shutil

import pytest

from aevia.operators import partials as PT
from aevia.operators import quality as Q
from aevia.plans import incremental_gold as IG
from aevia.plans import pipeline as P
from aevia.sources import bronze as B
from aevia.sources import storage as T
from aevia.sources import testbed
from conftest import SF_SMALL, report
from test_large_tables import planned


def test_landed_files_are_compressed_and_bounded(spark, scratch, bronze_of, monkeypatch):
    monkeypatch.setattr(B, "FILE_REPORTS", 7)
    B.land_bronze(bronze_of([report(str(i)) for i in range(20)] + [report(None)]).coalesce(1), scratch, 2024, 1)
    files = glob.glob(f"{scratch.removeprefix('file:')}/year=2024/month=01/*.json.gz")
    assert sorted(len(gzip.open(f).readlines()) for f in files) == [7, 7, 7]
    ids = [r[0] for r in B.read_bronze(spark, scratch, 2024, 1).select("safetyreportid").collect()]
    assert sorted(ids, key=str) == sorted([*map(str, range(20)), None], key=str)


def run_month(spark, root, month, reports):
    B.land_bronze(reports, f"{root}/bronze", 2024, month)
    P.run_bronze_to_silver(spark, f"{root}/bronze", root, 2024, month)
    return P.run_build_gold(spark, root, P.period_of(2024, month))


def test_mentions_meet_their_reports_once(spark, scratch, bronze_of, monkeypatch):
    plans = {}
    monkeypatch.setattr(T, "replace_period", lambda df, root, layer, name, *a, keep=T.replace_period: plans.update(
        {name: planned(spark, df)}) or keep(df, root, layer, name, *a))
    for month, ids in ((1, range(20)), (2, range(10, 30))):
        run_month(spark, scratch, month, bronze_of([report(str(i), drugs=[("a", "1", None)], reactions=["r"]) for i in ids]))
    for name in ("mentions_drugs", "mentions_reactions", "lost_drugs", "lost_reactions"):
        assert plans[name].count("SortMergeJoin") == 1, name
    for name in ("added_drugs", "added_reactions", "removed_drugs", "removed_reactions"):
        assert "Join" not in plans[name], name


def test_mentions_without_a_report_or_an_id(spark):
    events = spark.createDataFrame([("1", 1), ("2", None)], "safety_report_id string, is_serious int")
    drugs = spark.createDataFrame([("1", "A", "Suspect"), ("1", "A", None), ("2", None, None), ("9", "A", None), (None, "A", None), (None, "A", "Suspect")],
                                  "safety_report_id string, drug_name string, drug_role string")
    got = {tuple(r) for r in PT.report_mentions(drugs, events, "drug_name").select("safety_report_id", "drug_name", "n", "suspect", "is_serious").collect()}
    assert got == {("1", "A", 2, 1, 1), ("2", None, 1, 0, None), (None, "A", 2, 1, None)}


def test_lake_without_stored_mentions(spark, scratch, bronze_of):
    """Parts of an earlier form are worked out anew."""
    for month, ids in ((1, range(20)), (2, range(10, 30))):
        run_month(spark, scratch, month, bronze_of([report(str(i), drugs=[("a", "1", None)], reactions=["r"]) for i in ids]))
    want = {n: sorted(map(str, df.collect())) for n, df in P.read_gold(spark, scratch).items()}
    for name in IG.NAMES:
        shutil.rmtree(f"{scratch.removeprefix('file:')}/{IG.LAYER}/mentions_{name}")
    P.run_build_gold(spark, scratch, "2024-02")
    assert {n: sorted(map(str, df.collect())) for n, df in P.read_gold(spark, scratch).items()} == want


def test_items_are_put_in_order_without_lambdas(spark):
    assert "lambdafunction" not in planned(spark, testbed.bronze(spark, SF_SMALL))


def test_a_month_is_parsed_once_and_not_kept_in_memory(spark, scratch, bronze_of, monkeypatch):
    """All that reads the month reads its written rows; they go at the end."""
    plans = {}
    monkeypatch.setattr(T, "replace_period", lambda df, root, layer, name, *a, keep=T.replace_period: plans.update(
        {name: planned(spark, df)}) or keep(df, root, layer, name, *a))
    monkeypatch.setattr(P, "store_audit", lambda spark, audit, *a, keep=P.store_audit: plans.update(
        {"audit": planned(spark, audit)}) or keep(spark, audit, *a))
    B.land_bronze(bronze_of([report("1"), report("1"), report("2", drugs=None), report(None)]), f"{scratch}/bronze", 2024, 1)
    P.run_bronze_to_silver(spark, f"{scratch}/bronze", f"{scratch}/lake", 2024, 1)
    assert set(plans) == {"audit", *P.SILVER_TABLES}
    for name, plan in plans.items():
        assert "InMemoryTableScan" not in plan and "FileScan json" not in plan and plan.count("FileScan parquet") == 1, name
    folder = f"{scratch.removeprefix('file:')}/lake"
    assert not glob.glob(f"{folder}/_*")
    assert [len(P.read_silver(spark, f"{scratch}/lake")[n].collect()) for n in P.SILVER_TABLES] == [2, 3, 4]
    with open(f"{scratch.removeprefix('file:')}/bronze/year=2024/month=01/cut-short.json", "w") as bad:
        bad.write('{"safetyreportid": "x\n')
    with pytest.raises(Q.DataQualityError):
        P.run_bronze_to_silver(spark, f"{scratch}/bronze", f"{scratch}/lake", 2024, 1)
    assert spark.read.parquet(f"{scratch}/lake/quality/load_audit").first()["corrupt"] == 1
    assert not glob.glob(f"{folder}/_*")
