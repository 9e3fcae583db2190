"""Each quality rule passes on good data and fails on a planted fixture."""

import pytest
from pyspark.sql import functions as F

from aevia.operators import quality as Q

EV_SCHEMA = ("safety_report_id string, country string, report_date date, is_serious int, death int, "
             "hospitalization int, patient_sex string, patient_age int")


def events(spark, n=20, **over):
    import datetime as dt

    rows = []
    for i in range(n):
        r = {"safety_report_id": str(i), "country": "US", "report_date": dt.date(2024, 1, 1), "is_serious": 1,
             "death": 0, "hospitalization": None, "patient_sex": "Male", "patient_age": 40}
        for k, f in over.items():
            r[k] = f(i, r[k])
        rows.append(tuple(r.values()))
    return spark.createDataFrame(rows, EV_SCHEMA)


def failed(df, table):
    res = [r.asDict() for r in Q.run_suite(df, table).collect()]
    return [r["check_name"] for r in res if not r["passed"] and r["severity"] == "error"]


def test_good_events_pass(spark):
    assert failed(events(spark), "adverse_events") == []
    Q.enforce(Q.run_suite(events(spark), "adverse_events"))


def test_dq1_null_id(spark):
    df = events(spark, safety_report_id=lambda i, v: None if i == 0 else v)
    assert failed(df, "adverse_events") == ["no_null_safety_report_ids"]
    with pytest.raises(Q.DataQualityError, match="no_null_safety_report_ids"):
        Q.enforce(Q.run_suite(df, "adverse_events"))


def test_dq2_flag(spark):
    assert failed(events(spark, is_serious=lambda i, v: 5 if i == 3 else v), "adverse_events") == [
        "is_serious_is_binary"]


@pytest.mark.parametrize("nulls,n,fails", [(1, 20, False), (6, 100, True), (5, 100, False)])
def test_dq3_null_date_rate(spark, nulls, n, fails):
    df = events(spark, n, report_date=lambda i, v: None if i < nulls else v)
    assert ("report_date_null_rate" in failed(df, "adverse_events")) is fails


def test_dq4_age(spark):
    assert failed(events(spark, patient_age=lambda i, v: 200 if i == 1 else v), "adverse_events") == [
        "patient_age_realistic"]


def test_dq5_rows_and_empty_table(spark):
    assert failed(events(spark, 9), "adverse_events") == ["row_count_minimum"]
    empty = events(spark).where(F.lit(False))
    # an empty table passes the null-rate rule, then fails the row count
    assert failed(empty, "adverse_events") == ["row_count_minimum"]


def test_dq6_dq7_blank_names(spark):
    d = spark.createDataFrame([(str(i), "X" if i else " ", None, "Suspect") for i in range(12)],
                              "safety_report_id string, drug_name string, indication string, drug_role string")
    assert failed(d, "drugs") == ["drug_name_not_empty"]
    r = spark.createDataFrame([(str(i), None if i == 2 else "Rash") for i in range(12)],
                              "safety_report_id string, reaction_name string")
    assert failed(r, "reactions") == ["reaction_name_not_empty"]


def test_dq8_missing_column(spark):
    d = spark.createDataFrame([("HUMIRA",)], "drug_name string")
    res = {r.check_name: r for r in Q.run_suite(d, "drugs").collect()}
    assert res["required_columns_exist"].passed is False
    assert res["required_columns_exist"].observed == 2.0
    with pytest.raises(Q.DataQualityError, match="required_columns_exist"):
        Q.enforce(Q.run_suite(d, "drugs"))


def test_drug_null_ids_are_a_warning(spark):
    d = spark.createDataFrame([(None if i == 0 else str(i), "X", None, "Suspect") for i in range(12)],
                              "safety_report_id string, drug_name string, indication string, drug_role string")
    res = {r.check_name: r for r in Q.run_suite(d, "drugs").collect()}
    assert res["null_safety_report_ids"].passed is False and res["null_safety_report_ids"].severity == "warn"
    Q.enforce(Q.run_suite(d, "drugs"))  # no raise


def test_one_job_per_suite(spark):
    """All rules of a suite come from one aggregation (one scan)."""
    plan = Q.run_suite(events(spark), "adverse_events")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1 or plan.count("LocalTableScan") <= 1


def test_gold_suite_on_testbed(spark):
    from aevia.plans.queries import Ctx
    from conftest import SF_SMALL

    res = Q.run_gold_suite(Ctx(spark, SF_SMALL).gold).collect()
    assert all(r.passed for r in res), [r for r in res if not r.passed]
