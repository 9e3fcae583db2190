"""Sources and sinks: month window, pages, landing, pruning, overwrite."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from aevia.sources import bronze as B
from aevia.sources import storage as T
from conftest import report


def test_month_window_includes_leap_day(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, d),) for d in (1, 28, 29)] + [(dt.date(2024, 3, 1),)], "d date")
    assert df.where(B.in_month("d", 2024, 2)).count() == 3
    import pytest

    with pytest.raises(ValueError):
        B.month_window(2024, 13)


def _write_page(folder, skip, body):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, f"page-{skip:05d}.json"), "w") as f:
        f.write(json.dumps(body))


def test_all_pages_are_read_and_audited(spark, tmp_path):
    folder = str(tmp_path / "pages")
    rec = lambda i: {"safetyreportid": str(i), "receivedate": "20240101", "patient": {"patientsex": "1"}}
    _write_page(folder, 0, {"results": [rec(i) for i in range(3)]})
    _write_page(folder, 100, {"meta": {}})  # no results key: an empty page
    _write_page(folder, 300, {"results": [rec(9)]})  # 200 is missing
    audit = lambda: B.audit_pages(B.read_page_files(spark, folder)).first().asDict()
    assert sorted(r.safetyreportid for r in B.read_pages(spark, folder).collect()) == ["0", "1", "2", "9"]
    assert audit() == {"files": 3, "pages": 3, "empty_pages": 1, "missing_pages": 1, "corrupt": 0, "reports": 4}
    with open(os.path.join(folder, "page-00200.json"), "w") as f:
        f.write('{"results": [{"safetyreportid": "5"')  # truncated: nothing after it is lost
    _write_page(folder, 400, {"results": []})
    with open(os.path.join(folder, "notes.json"), "w") as f:
        f.write(json.dumps({"results": [rec(77)]}))  # a name without a skip
    assert {"0", "1", "2", "9", "77"} <= {r.safetyreportid for r in B.read_pages(spark, folder).collect()}
    got = audit()
    assert (got["files"], got["corrupt"], got["missing_pages"], got["empty_pages"]) == (6, 2, 0, 2)


def test_corrupt_lines_are_counted(spark, tmp_path):
    folder = tmp_path / "year=2024" / "month=05"
    folder.mkdir(parents=True)
    lines = [json.dumps({"safetyreportid": str(i)}) for i in range(4)] + ['{"safetyreportid": "x', "oops"]
    (folder / "part-0.json").write_text("\n".join(lines))
    raw = B.read_bronze_raw(spark, str(tmp_path), 2024, 5).cache()
    assert B.audit_bronze(raw).first().asDict() == {
        "files": 1, "pages": 0, "empty_pages": 0, "missing_pages": 0, "corrupt": 2, "reports": 4}
    assert B.read_bronze(spark, str(tmp_path), 2024, 5).count() == 4
    raw.unpersist()


def test_unwrap_text_bodies(spark):
    bodies = spark.createDataFrame([(0, '{"results": [{"safetyreportid": "a"}]}'), (1, '{"results": []}'),
                                    (2, '{"other": 1}'), (3, "not json")], "page int, body string")
    assert [r.safetyreportid for r in B.unwrap_pages(bodies).collect()] == ["a"]


def test_land_read_prune_and_dynamic_overwrite(spark, scratch, bronze_of):
    root = f"{scratch}/bronze"
    B.land_bronze(bronze_of([report("1"), report("2")]), root, 2024, 1)
    B.land_bronze(bronze_of([report("3")]), root, 2024, 2)
    jan = B.read_bronze(spark, root, 2024, 1)
    assert sorted(r.safetyreportid for r in jan.collect()) == ["1", "2"]
    plan = jan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    # rerun of January replaces January only
    B.land_bronze(bronze_of([report("4")]), root, 2024, 1)
    assert sorted(r.safetyreportid for r in B.read_bronze(spark, root).collect()) == ["3", "4"]
    import pytest

    with pytest.raises(ValueError):
        B.land_bronze(bronze_of([report("1")]).where(F.lit(False)), root, 2024, 3)


def test_json_array_month_files(spark, tmp_path):
    folder = tmp_path / "year=2024" / "month=03"
    folder.mkdir(parents=True)
    (folder / "events.json").write_text(json.dumps([{"safetyreportid": "a"}, {"safetyreportid": "b"}], indent=2))
    (folder / "compact.json").write_text(json.dumps([{"safetyreportid": "c"}, {"safetyreportid": "d"}]))
    (folder / "lines.json").write_text('{"safetyreportid": "e"}\n{"safetyreportid": "f"}\n')
    raw = B.read_bronze_raw(spark, str(tmp_path), 2024, 3).cache()
    got = raw.select("safetyreportid", B.CORRUPT, "year", "month").collect()
    assert sorted(r.safetyreportid for r in got) == list("abcdef")
    assert all(r[B.CORRUPT] is None and (r.year, r.month) == (2024, 3) for r in got)
    assert B.audit_bronze(raw).first().files == 3
    raw.unpersist()


def test_array_files_hold_a_bounded_number_of_reports(spark, bronze_of, scratch):
    rows = [report(f"{m}-{n}") for m in (1, 2, 12) for n in range(100 * m)] + [report("copy")] * 300
    months = F.when(F.col("safetyreportid") == "copy", 3).otherwise(F.split("safetyreportid", "-")[0].cast("int"))
    reports = bronze_of(rows).repartition(3).withColumn("year", F.lit(2024)).withColumn("month", months)
    B.write_array_files(reports, scratch, file_reports=50)
    raw = B.read_bronze_raw(spark, scratch)
    held = raw.groupBy("_file").agg(F.count("*").alias("n"), F.max("month").alias("month"), F.count_if(F.col("safetyreportid").isNull()).alias("bad")).collect()
    assert max(r.n for r in held) <= 100 and not any(r.bad for r in held)
    assert {m: sum(r.month == m for r in held) > 1 for m in (1, 2, 3, 12)} == {1: True, 2: True, 3: True, 12: True}
    cols = ["safetyreportid", "year", "month"]
    got = sorted(map(tuple, B.read_bronze(spark, scratch).select(cols).collect()))
    assert got == sorted(map(tuple, reports.select(cols).collect()))
    empty = f"{scratch}-empty"
    B.write_array_files(reports.where("false"), empty)
    assert B.read_bronze(spark, empty, 2024, 1).collect() == []


def test_read_or_empty_and_publish(spark, scratch):
    from aevia.schemas import GOLD

    df = spark.createDataFrame([("X", 1, 1, 100.0)], GOLD["drug_summary"])
    paths = T.publish_gold({"drug_summary": df}, scratch)
    assert list(paths) == ["drug_summary"]
    assert T.read_or_empty(spark, paths["drug_summary"], GOLD["drug_summary"]).count() == 1
    assert T.read_or_empty(spark, f"{scratch}/nope", GOLD["drug_summary"]).count() == 0


def test_offset_page(spark):
    df = spark.range(0, 250).withColumnRenamed("id", "k")
    assert [r.k for r in B.offset_page(df, ["k"], 200, 100).collect()] == list(range(200, 250))


def test_catalog_publish_and_feature_loader(spark, scratch):
    from aevia.schemas import GOLD

    feats = spark.createDataFrame([("1", None, "US", "Male", 40, 1, 2, 1, 3)], GOLD["ml_features"])
    names = T.publish_to_catalog(spark, {"ml_features": feats}, "gold")
    assert names == ["gold.ml_features"]
    assert spark.table("gold.ml_features").count() == 1
    # storage path first, catalog when the path is missing
    path = T.write_table(feats, scratch, "gold", "ml_features")
    assert T.load_ml_features(spark, path).count() == 1
    assert T.load_ml_features(spark, f"{scratch}/missing").count() == 1
    assert T.copy_parquet_table(spark, path, f"{scratch}/copy") == f"{scratch}/copy"
    assert spark.read.parquet(f"{scratch}/copy").count() == 1
    assert T.copy_parquet_table(spark, f"{scratch}/empty", f"{scratch}/copy2") == ""
