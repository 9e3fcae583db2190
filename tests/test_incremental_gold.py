"""Gold kept up to date by parts equals gold built at once."""

import os
import random

import pytest
from pyspark.sql import functions as F

from aevia.plans import incremental_gold as IG
from aevia.plans import pipeline as P
from aevia.sources import bronze as B
from aevia.sources import storage as T
from conftest import report


def rows_of(spark, lake):
    return {n: sorted(map(str, df.collect())) for n, df in P.read_gold(spark, lake).items()}


def built_at_once(spark, lake, scratch):
    """Gold of a lake's silver by the full build, elsewhere."""
    s = P.read_silver(spark, lake)
    from aevia.operators import gold as G

    return {n: sorted(map(str, df.collect())) for n, df in G.build_gold(s["adverse_events"], s["drugs"], s["reactions"]).items()}


def month_rows(rng, ids):
    names, felt = ["aspirin", "ibuprofen", " x ", "rare-%d" % rng.randrange(3)], ["nausea", "pain", "rash"]
    return [report(i, date=rng.choice(["20240110", "20240205", "bad"]), serious=rng.choice(["1", "2", None]),
                   death=rng.choice([None, "1"]), hosp=rng.choice([None, "1", "x"]), age=rng.choice(["40", None]),
                   drugs=rng.choice([None, [(rng.choice(names), rng.choice("123"), None) for _ in range(rng.randrange(4))]]),
                   reactions=[rng.choice(felt) for _ in range(rng.randrange(3))]) for i in ids]


def run_month(spark, bronze_of, rows, root, month):
    B.land_bronze(bronze_of(rows), f"{root}/bronze", 2024, month)
    P.run_bronze_to_silver(spark, f"{root}/bronze", root, 2024, month)
    return P.run_build_gold(spark, root, P.period_of(2024, month))


def test_months_in_and_out_of_order(spark, scratch, bronze_of):
    """Three months with resent, dropped and id-less reports, one of them
    run again with other reports, and one that comes late."""
    rng = random.Random(4)
    ids = [str(i) for i in range(40)]
    sent = [(1, ids[:20] + [None, None]), (4, ids[5:12] + ids[20:30]), (3, ids[:20] + ids[28:33] + [None]), (4, ids[8:12] + ids[30:40])]
    for month, wanted in sent:  # month 3 takes all that month 1 holds
        out = run_month(spark, bronze_of, month_rows(rng, wanted), scratch, month)
        assert list(out) == T.GOLD_ORDER
        assert rows_of(spark, scratch) == built_at_once(spark, scratch, scratch)


def test_run_again_changes_nothing(spark, scratch, bronze_of):
    rng = random.Random(5)
    run_month(spark, bronze_of, month_rows(rng, map(str, range(20))), scratch, 1)
    run_month(spark, bronze_of, month_rows(rng, map(str, range(10, 30))), scratch, 2)
    before = rows_of(spark, scratch)
    for month in (1,):
        P.run_build_gold(spark, scratch, P.period_of(2024, month))
        assert rows_of(spark, scratch) == before


def test_old_lake_is_taken_up(spark, scratch, bronze_of):
    """A lake whose gold was built at once gets parts of all its periods."""
    rng = random.Random(7)
    for month in (1, 2):
        B.land_bronze(bronze_of(month_rows(rng, map(str, range(month, 20)))), f"{scratch}/bronze", 2024, month)
        P.run_bronze_to_silver(spark, f"{scratch}/bronze", scratch, 2024, month)
    P.run_build_gold(spark, scratch)
    want = rows_of(spark, scratch)
    P.run_build_gold(spark, scratch, "2024-02")
    assert rows_of(spark, scratch) == want
    with pytest.raises(ValueError, match="2024-07"):
        P.run_build_gold(spark, scratch, "2024-07")


def test_untouched_periods_are_not_read(spark, scratch, bronze_of, monkeypatch):
    """A new period reads no silver of periods it sends nothing of: their
    mentions are made unreadable, and gold is still right."""
    rng = random.Random(8)
    run_month(spark, bronze_of, month_rows(rng, map(str, range(20))), scratch, 1)
    run_month(spark, bronze_of, month_rows(rng, map(str, range(20, 40))), scratch, 2)
    new = month_rows(rng, map(str, range(30, 50)))
    B.land_bronze(bronze_of(new), f"{scratch}/bronze", 2024, 3)
    P.run_bronze_to_silver(spark, f"{scratch}/bronze", scratch, 2024, 3)
    want = built_at_once(spark, scratch, scratch)
    local = scratch.removeprefix("file:")
    for table in ("drugs", "reactions", "adverse_events"):
        folder = f"{local}/silver/{table}/period=2024-01"
        for f in os.listdir(folder):
            if f.endswith(".parquet"):
                with open(f"{folder}/{f}", "wb") as out:
                    out.write(b"unreadable")
            elif f.endswith(".crc"):
                os.remove(f"{folder}/{f}")
    P.run_build_gold(spark, scratch, "2024-03")
    assert rows_of(spark, scratch) == want


def test_parts_add_up_by_key(spark):
    from aevia.operators import partials as PT

    parts = spark.createDataFrame([("A", 3, 2, 1, 2), ("A", -1, -1, -1, -1), ("B", 2, 2, 2, 2), ("B", -2, -2, -2, -2), ("C", 1, 0, None, 0)],
                                  "drug_name string, mentions long, reports long, is_serious long, is_serious_known long")
    got = {r["drug_name"]: tuple(r)[1:] for r in PT.finished("drugs", PT.merged(parts, "drugs"))["drug_summary"].collect()}
    assert got == {"A": (1, 0, 0.0), "C": (0, None, None)}
    assert PT.merged(PT.negated(parts, "drugs").unionByName(parts), "drugs").count() == 0


def test_superseded_reports_are_stored(spark, scratch, bronze_of):
    rng = random.Random(9)
    for month, wanted in ((1, range(5)), (2, range(3, 8)), (3, [0, 4, 9])):
        run_month(spark, bronze_of, month_rows(rng, map(str, wanted)), scratch, month)
    gone = spark.read.parquet(f"{scratch}/{IG.LAYER}/superseded").withColumn("period", F.col("period").cast("string"))
    assert {tuple(r) for r in gone.select("safety_report_id", "held", "period").collect()} == {
        ("3", "2024-01", "2024-02"), ("4", "2024-01", "2024-02"), ("4", "2024-02", "2024-03"), ("0", "2024-01", "2024-03")}
