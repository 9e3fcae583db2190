"""Exact values for every code-book row and parsing rule."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from aevia.functions import exprs as X
from aevia.schemas import DRUG_ROLE_LABELS, SEX_LABELS


def one(spark, expr, *cols_vals):
    names = [f"c{i}" for i in range(len(cols_vals))]
    df = spark.createDataFrame([tuple(cols_vals)], ", ".join(f"{n} string" for n in names))
    return df.select(expr(*names).alias("v")).first()["v"]


@pytest.mark.parametrize("raw,expected", [("1", 1), ("2", 0), ("3", None), (None, None), ("x", None),
                                          ("1.0", 1), (" 2", 0)])
def test_binary_flag(spark, raw, expected):
    assert one(spark, X.binary_flag, raw) == expected


@pytest.mark.parametrize(
    "age,unit,expected",
    [
        ("4", "800", 40),  # decades
        ("13", "800", None),  # 130 years
        ("40", "801", 40),
        ("11", "802", 0),  # 11 months -> 0 years
        ("30", "802", 2),
        ("104", "803", 1),  # weeks
        ("800", "804", 2),  # days
        ("9000", "805", 1),  # hours
        ("120.9", "801", None),
        ("120", "801", 120),
        ("-0.4", "801", None),
        ("0.4", "801", 0),
        ("55", None, 55),  # no unit -> years
        ("55", "999", 55),  # unknown unit -> years
        ("n/a", "801", None),
        (None, "801", None),
    ],
)
def test_age_in_years(spark, age, unit, expected):
    assert one(spark, X.age_in_years, age, unit) == expected


@pytest.mark.parametrize(
    "raw,expected",
    [("20240229", dt.date(2024, 2, 29)), ("20230229", None), ("unknown", None), ("2024011", None),
     (None, None), ("20240115", dt.date(2024, 1, 15))],
)
def test_parse_date(spark, raw, expected):
    assert one(spark, X.parse_yyyymmdd, raw) == expected


@pytest.mark.parametrize("code,label", list(SEX_LABELS.items()) + [("3", None), (None, None)])
def test_sex_labels(spark, code, label):
    assert one(spark, lambda c: X.code_label(c, SEX_LABELS), code) == label


@pytest.mark.parametrize("code,label", list(DRUG_ROLE_LABELS.items()) + [("9", None)])
def test_role_labels(spark, code, label):
    assert one(spark, lambda c: X.code_label(c, DRUG_ROLE_LABELS), code) == label


def test_names(spark):
    assert one(spark, X.drug_name, "  aspirin 81 ") == "ASPIRIN 81"
    assert one(spark, X.reaction_name, " drug-induced liver INJURY ") == "Drug-induced Liver Injury"
    assert one(spark, X.not_blank, "   ") is False
    assert one(spark, X.not_blank, None) is False
    # trim removes spaces only: a tab survives and counts as a name
    assert one(spark, X.not_blank, "\t") is True


def test_rate_and_labels(spark):
    df = spark.createDataFrame([(1, 3), (0, 0), (None, 4), (2, 3)], "n long, d long")
    got = [r[0] for r in df.select(X.rate_pct("n", "d")).collect()]
    assert got == [33.33, None, None, 66.67]
    df2 = spark.createDataFrame([(2024, 3)], "y int, m int")
    assert df2.select(X.period_label("y", "m")).first()[0] == "2024-03"
    assert one(spark, lambda c: X.raw_equals_flag(c), None) == 0
    assert one(spark, lambda c: X.relabel(c, {"1": "Serious"}), "7") == "7"


def test_size_or_zero(spark):
    df = spark.createDataFrame([([1, 2],), (None,), ([],)], "a array<int>")
    assert [r[0] for r in df.select(X.size_or_zero("a")).collect()] == [2, 0, 0]
