"""The monthly job end to end, and the gate stopping it."""

import pytest
from pyspark.sql import functions as F

from aevia.operators.quality import DataQualityError
from aevia.plans import pipeline as P
from aevia.sources import bronze as B
from aevia.sources import testbed
from conftest import SF_SMALL


def test_pipeline_end_to_end(spark, scratch):
    bronze_root, lake = f"{scratch}/bronze", f"{scratch}/lake"
    B.land_bronze(testbed.bronze(spark, SF_SMALL), bronze_root, 2024, 1)
    out = P.run_pipeline(spark, 2024, 1, bronze_root, lake, publish_root=f"{scratch}/pub")
    assert set(out["gold"]) == {"safety_overview", "monthly_trends", "drug_summary", "reaction_summary",
                                "drug_reaction_pairs", "ml_features"}
    gold = P.read_gold(spark, lake)
    assert gold["safety_overview"].count() == 1
    checks = spark.read.parquet(f"{lake}/quality/gold_checks").where(F.col("period") == "2024-01")
    assert checks.count() == 22 and checks.where(~F.col("passed")).count() == 0
    n_features = gold["ml_features"].count()
    # rerun is idempotent
    P.run_pipeline(spark, 2024, 1, bronze_root, lake)
    assert P.read_gold(spark, lake)["ml_features"].count() == n_features
    with pytest.raises(ValueError):
        P.run_pipeline(spark, 2024, 13, bronze_root, lake)


def test_gate_stops_before_gold(spark, scratch, bronze_of):
    from conftest import report

    bronze_root, lake = f"{scratch}/bronze", f"{scratch}/lake"
    B.land_bronze(bronze_of([report(str(i)) for i in range(5)]), bronze_root, 2024, 2)  # < 10 rows
    with pytest.raises(DataQualityError):
        P.run_pipeline(spark, 2024, 2, bronze_root, lake)
    from aevia.sources.storage import path_exists

    assert not path_exists(spark, f"{lake}/gold/safety_overview")


def test_resent_report_latest_period_wins(spark, scratch, bronze_of):
    from conftest import report

    bronze_root, lake = f"{scratch}/bronze", f"{scratch}/lake"
    jan = [report(str(i)) for i in range(12)] + [report("r", date="20240110", drugs=[("old", "1", None)])]
    feb = [report(str(i)) for i in range(100, 112)] + [report("r", date="20240205", drugs=[("new", "2", None)])]
    B.land_bronze(bronze_of(jan), bronze_root, 2024, 1)
    B.land_bronze(bronze_of(feb), bronze_root, 2024, 2)
    P.run_bronze_to_silver(spark, bronze_root, lake, 2024, 1)
    P.run_bronze_to_silver(spark, bronze_root, lake, 2024, 2)
    s = P.read_silver(spark, lake)
    assert s["adverse_events"].count() == 25
    r = s["adverse_events"].where(F.col("safety_report_id") == "r").collect()
    assert len(r) == 1 and str(r[0].report_date) == "2024-02-05"
    names = [x.drug_name for x in s["drugs"].where(F.col("safety_report_id") == "r").collect()]
    assert names == ["NEW"]


def test_pipeline_from_page_files(spark, scratch, tmp_path):
    import json
    import os

    folder = tmp_path / "pages"
    folder.mkdir()

    def rec(i):
        return {"safetyreportid": str(i), "receivedate": "20240301", "serious": "1" if i % 2 else "2",
                "primarysourcecountry": "FR",
                "patient": {"patientsex": "2", "patientonsetage": "50", "patientonsetageunit": "801",
                            "drug": [{"medicinalproduct": "aspirin", "drugcharacterization": "1"}],
                            "reaction": [{"reactionmeddrapt": "nausea"}]}}

    for skip in (0, 100, 200):
        (folder / f"page-{skip:05d}.json").write_text(json.dumps({"results": [rec(skip + j) for j in range(5)]}))
    (folder / "page-00300.json").write_text(json.dumps({"results": []}))
    (folder / "page-00400.json").write_text(json.dumps({"results": [rec(999)]}))  # after the empty page: kept
    out = P.run_pipeline(spark, 2024, 3, f"{scratch}/bronze", f"{scratch}/lake", pages_path=str(folder),
                         publish_root=f"{scratch}/pub")
    assert out["bronze"].endswith("year=2024/month=03")
    gold = P.read_gold(spark, f"{scratch}/lake")
    o = gold["safety_overview"].first()
    assert o.total_reports == 16 and o.serious_reports == 7  # odd ids 1, 3, 101, 103, 201, 203, 999
    (folder / "page-00100.json").write_text('{"results": [{"safetyr')  # truncated
    with pytest.raises(DataQualityError, match="load audit of pages 2024-03"):
        P.run_pipeline(spark, 2024, 3, f"{scratch}/bronze", f"{scratch}/lake", pages_path=str(folder))
    os.remove(folder / "page-00100.json")  # missing
    with pytest.raises(DataQualityError, match="'missing_pages': 1"):
        P.run_pipeline(spark, 2024, 3, f"{scratch}/bronze", f"{scratch}/lake", pages_path=str(folder))
    assert os.path.isdir(f"{scratch}/pub/published/drug_reaction_pairs".replace("file:", ""))


def test_gate_results_are_stored(spark, scratch, bronze_of):
    from conftest import report

    bronze_root, lake = f"{scratch}/bronze", f"{scratch}/lake"
    B.land_bronze(bronze_of([report(str(i)) for i in range(5)]), bronze_root, 2024, 4)
    with pytest.raises(DataQualityError, match="row_count_minimum"):
        P.run_pipeline(spark, 2024, 4, bronze_root, lake)
    stored = spark.read.parquet(f"{lake}/quality/silver_checks").where(F.col("period") == "2024-04")
    rows = {(r.table_name, r.check_name): r for r in stored.collect()}
    assert rows[("silver_adverse_events", "row_count_minimum")].passed is False
    assert rows[("silver_adverse_events", "row_count_minimum")].observed == 5.0
    assert len(rows) == 13  # 6 events + 4 drugs (one warning) + 3 reactions rules
    # the gate stopped the run, so no gold checks were stored
    from aevia.sources.storage import path_exists

    assert not path_exists(spark, f"{lake}/quality/gold_checks")


def test_array_month_file_and_rerun(spark, scratch, tmp_path, bronze_of):
    import json

    from conftest import report

    def month_file(ids):
        return json.dumps([{"safetyreportid": i, "receivedate": "20240601", "serious": "1",
                            "patient": {"drug": [{"medicinalproduct": "aspirin", "drugcharacterization": "1"}],
                                        "reaction": [{"reactionmeddrapt": "nausea"}]}} for i in ids], indent=2)

    folder = tmp_path / "year=2024" / "month=06"
    folder.mkdir(parents=True)
    (folder / "events.json").write_text(month_file([str(i) for i in range(30)]))
    lake = f"{scratch}/lake"
    P.run_pipeline(spark, 2024, 6, str(tmp_path), lake)
    assert P.read_gold(spark, lake)["safety_overview"].first().total_reports == 30
    # a rerun with a replaced file publishes the new reports only
    (folder / "events.json").write_text(month_file([f"n{i}" for i in range(40)]))
    P.run_pipeline(spark, 2024, 6, str(tmp_path), lake)
    assert P.read_gold(spark, lake)["safety_overview"].first().total_reports == 40
    # a month that has become empty leaves no old rows behind, and fails its own gate
    (folder / "events.json").write_text("[]")
    with pytest.raises(DataQualityError):
        P.run_pipeline(spark, 2024, 6, str(tmp_path), lake)
    assert P.read_silver(spark, lake, "2024-06")["adverse_events"].count() == 0
    # a good history does not hide a bad month
    B.land_bronze(bronze_of([report(str(i)) for i in range(20)]), f"{scratch}/b", 2024, 1)
    B.land_bronze(bronze_of([report(f"x{i}", date="unknown") for i in range(12)]), f"{scratch}/b", 2024, 2)
    P.run_pipeline(spark, 2024, 1, f"{scratch}/b", f"{scratch}/lake2")
    with pytest.raises(DataQualityError, match="date"):
        P.run_pipeline(spark, 2024, 2, f"{scratch}/b", f"{scratch}/lake2")


def test_corrupt_lines_stop_the_month(spark, scratch, tmp_path):
    import json

    folder = tmp_path / "year=2024" / "month=07"
    folder.mkdir(parents=True)
    good = [json.dumps({"safetyreportid": str(i), "receivedate": "20240701"}) for i in range(20)]
    (folder / "part-0.json").write_text("\n".join(good + ['{"safetyreportid": "x'] * 20))
    with pytest.raises(DataQualityError, match="'corrupt': 20"):
        P.run_pipeline(spark, 2024, 7, str(tmp_path), f"{scratch}/lake")
    audit = spark.read.parquet(f"{scratch}/lake/quality/load_audit").first()
    assert (audit.source, str(audit.period), audit.corrupt, audit.reports) == ("bronze", "2024-07", 20, 20)
