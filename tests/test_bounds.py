"""Pruned top pairs and medians by rounds, against the plain forms."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from aevia.operators import gold as G
from aevia.operators import reports as R
from aevia.operators import top_pairs as TP
from aevia.operators.medians import exact_medians


def silver_of(spark, drugs, reactions):
    ids = sorted({i for i, _ in drugs + reactions if i is not None})
    events = spark.createDataFrame([(i, int(i[1:]) % 2) for i in ids], "safety_report_id string, is_serious int")
    return (events, spark.createDataFrame(drugs, "safety_report_id string, drug_name string"),
            spark.createDataFrame(reactions, "safety_report_id string, reaction_name string"))


@pytest.fixture(scope="module")
def skewed(spark):
    """A few names in most reports, many names in one report each, one
    report that holds a third of the mentions, a null id and null names."""
    rng, drugs, reactions = random.Random(4), [], []
    for i in range(300):
        rid = f"r{i}"
        drugs += [(rid, f"D{min(int(rng.expovariate(0.4)), 9)}") for _ in range(3)] + [(rid, f"RARE{i}-{k}") for k in range(4)]
        reactions += [(rid, f"R{min(int(rng.expovariate(0.4)), 9)}") for _ in range(2)] + [(rid, f"rare{i}-{k}") for k in range(4)]
    drugs += [("r7", f"HOT{k}") for k in range(400)] + [(None, "D0")] * 50 + [("r8", None)] * 3
    reactions += [("r7", f"hot{k % 40}") for k in range(80)] + [(None, "R0")] * 50 + [("r8", None)] * 2
    return [t.persist() for t in silver_of(spark, drugs, reactions)]


def pairs_made(tables, kept=None):
    events, drugs, reactions = tables
    if kept is not None:
        of_drugs, of_reactions = TP.name_bounds(drugs, reactions)
        drugs = TP._of_names(drugs, of_drugs.where(F.col("bound") >= kept), "drug_name")
        reactions = TP._of_names(reactions, of_reactions.where(F.col("bound") >= kept), "reaction_name")
    return G.mention_pairs(events, drugs, reactions).count()


@pytest.mark.parametrize("n, first_names", [(20, 200), (20, 3), (5, 1), (1, 1), (100_000, 200)])
def test_top_pairs_equal_the_full_table(skewed, n, first_names):
    want = R.top_pairs(G.drug_reaction_pairs(*skewed), n).collect()
    assert TP.top_pairs_by_bound(*skewed, n=n, first_names=first_names).collect() == want


def test_adversarial_bounds(spark):
    """Names of the highest bounds never meet; the best pairs are of names
    outside the first round, and tie at the cut."""
    drugs = [(f"r{i}", "LONE") for i in range(40)] + [(f"r{i}", f"P{i % 4}") for i in range(100, 180)]
    reactions = [(f"r{i}", f"x{i}") for i in range(40)] + [(f"r{i}", "LOST") for i in range(40, 90)] + [
        (f"r{i}", f"q{i % 4}") for i in range(100, 180)]
    tables = silver_of(spark, drugs, reactions)
    got = TP.top_pairs_by_bound(*tables, n=2, first_names=1).collect()
    assert [(r["Drug"], r["Pair Count"]) for r in got] == [("P0", 20), ("P1", 20)]
    assert got == R.top_pairs(G.drug_reaction_pairs(*tables), 2).collect()


def test_bounds_hold_and_prune(skewed):
    events, drugs, reactions = skewed
    of_drugs, of_reactions = TP.name_bounds(drugs, reactions)
    pairs = G.drug_reaction_pairs(*skewed)
    for bounds, name in ((of_drugs, "drug_name"), (of_reactions, "reaction_name")):
        most = pairs.groupBy(F.col(name).alias("kept")).agg(F.max("pair_count").alias("most"))
        broken = most.join(bounds, F.col("kept").eqNullSafe(F.col(name)), "left").where(
            F.col("bound").isNull() | (F.col("bound") < F.col("most")))
        assert broken.count() == 0
    least = TP.pair_threshold(events, drugs, reactions, (of_drugs, of_reactions), 20)
    assert least > 5
    assert pairs_made(skewed, least) * 5 < pairs_made(skewed)


def test_frequent_pairs(skewed):
    full = G.drug_reaction_pairs(*skewed)
    key = ["drug_name", "reaction_name"]
    assert TP.signal_pairs_by_bound(*skewed).collect() == R.signal_pairs(full).collect()
    assert TP.frequent_pairs(*skewed, least=3).orderBy(*key).collect() == full.where("pair_count >= 3").orderBy(*key).collect()


def test_no_mentions(spark):
    events, drugs, reactions = silver_of(spark, [("r1", "A")], [("r1", "b")])
    none = drugs.where("false"), reactions.where("false")
    assert TP.top_pairs_by_bound(events, *none).collect() == []
    assert [tuple(r)[:3] for r in TP.top_pairs_by_bound(events, drugs, reactions).collect()] == [("A", "b", 1)]


def test_medians_by_rounds(spark):
    rng = random.Random(9)
    n = 4001
    columns = {
        "apart": [rng.gauss(0, 1e6) for _ in range(n)],
        "skewed": [rng.paretovariate(0.3) for _ in range(n)],
        "tied": [float(rng.choice([1, 2, 2, 2, 9])) for _ in range(n)],
        "halves": [0.0] * 2000 + [1.0] * 2000 + [None],  # the middle two differ, all rows tie
        "mostly_null": [float(i) if i % 10 == 0 else None for i in range(n)],
        "one": [None] * (n - 1) + [5.5],
        "none": [None] * n,
        "a.b": [float(i) for i in range(n)],
    }
    order = list(range(n))
    rng.shuffle(order)
    schema = ", ".join(f"`{c}` double" for c in columns)
    df = spark.createDataFrame([tuple(v[i] for v in columns.values()) for i in order], schema).repartition(5)
    want = {c: statistics.median(x) if (x := [v for v in vs if v is not None]) else None for c, vs in columns.items()}
    for accuracy, last_rows in ((50, 10), (20, 1), (2_000, 4_096)):
        assert exact_medians(df, list(columns), accuracy, last_rows) == want
    assert exact_medians(df.where("false"), ["apart", "one"]) == {"apart": None, "one": None}
    whole = df.selectExpr("cast(tied as int) as n", "cast('nan' as double) as odd")
    assert exact_medians(whole, ["n"], 50, 10)["n"] == 2.0
    nan = exact_medians(whole, ["odd"], 50, 10)["odd"]
    assert nan != nan
