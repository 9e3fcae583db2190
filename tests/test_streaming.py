"""Incremental silver equals what the batch job makes of the same bronze."""

from aevia.plans import pipeline as P
from aevia.sources import bronze as B
from aevia.streaming.incremental import start_incremental_silver
from conftest import report


def silver(spark, lake):
    return {n: sorted(map(str, df.collect())) for n, df in P.read_silver(spark, lake).items()}


def test_incremental_equals_batch(spark, scratch, bronze_of):
    root, lake, batch_lake = f"{scratch}/bronze", f"{scratch}/lake", f"{scratch}/batch"

    def step(year, month, rows):
        B.land_bronze(bronze_of(rows), root, year, month)
        start_incremental_silver(spark, root, lake, f"{scratch}/offsets").awaitTermination(120)

    step(2024, 8, [report(None, drugs=[(f"d{i}", "1", None)]) for i in range(10)] + [report(str(i)) for i in range(5)])
    assert len(silver(spark, lake)["drugs"]) == 15  # rows without an id stay
    step(2024, 3, [report(f"m{i}", date="20240301") for i in range(5)])  # late, and kept
    step(2024, 9, [report("1", date="20240901"), report("1", date="20240905"), report("u", date="unknown")])
    step(2024, 3, [report(f"m{i}", date="20240301") for i in range(7)])  # the month landed again
    for year, month in ((2024, 3), (2024, 8), (2024, 9)):
        P.run_bronze_to_silver(spark, root, batch_lake, year, month)
    got = silver(spark, lake)
    assert got == silver(spark, batch_lake)
    dates = [x for x in got["adverse_events"] if "safety_report_id='1'" in x]
    assert len(dates) == 1 and "2024, 9, 5" in dates[0]
