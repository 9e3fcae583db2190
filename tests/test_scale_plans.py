"""Hot keys and plan shape: results stay exact when one report id holds
most rows, and the plans pre-aggregate before shuffling, prune columns,
push filters and never plan a cartesian product."""

from collections import Counter

from pyspark.sql import functions as F

from aevia.operators import gold as G
from aevia.operators import silver as S
from aevia.plans import pipeline as P
from aevia.sources import bronze as B
from conftest import report


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_report_id_exact(spark, bronze_of):
    hot = [report("hot", serious="1", drugs=[("a", "1", None), ("b", "2", None), ("a", "1", None)],
                  reactions=["x", "y"]) for _ in range(300)]
    null_hot = [report(None, drugs=[("a", "1", None)], reactions=["x"]) for _ in range(200)]
    rest = [report(str(i), serious="2" if i % 2 else "1", drugs=[("c", "3", None), ("a", "1", None)],
                   reactions=["x"]) for i in range(50)]
    b = bronze_of(hot + null_hot + rest)
    s = S.build_silver(b)
    ev, dr, rx = s["adverse_events"], s["drugs"], s["reactions"]
    # brute force over the mention rows, as the plain join would count
    drows = [(r.safety_report_id, r.drug_name) for r in dr.collect()]
    rrows = [(r.safety_report_id, r.reaction_name) for r in rx.collect()]
    serious = {r.safety_report_id: r.is_serious for r in ev.collect()}
    want_pairs, want_serious = Counter(), Counter()
    for i, d in drows:
        for j, x in rrows:
            if i is not None and i == j:
                want_pairs[(d, x)] += 1
                want_serious[(d, x)] += serious.get(i) or 0
    got = {(r.drug_name, r.reaction_name): r for r in G.drug_reaction_pairs(ev, dr, rx).collect()}
    assert {k: v.pair_count for k, v in got.items()} == dict(want_pairs)
    assert {k: v.serious_count for k, v in got.items()} == dict(want_serious)
    for part in (1, 2):  # reports split into parts of one or two names
        split = G.drug_reaction_pairs(ev, dr, rx, part=part).collect()
        assert {(r.drug_name, r.reaction_name): r.pair_count for r in split} == dict(want_pairs)
    want_total = Counter(d for i, d in drows if i is not None)
    summ = {r.drug_name: r.total_reports for r in G.drug_summary(ev, dr).collect()}
    assert summ == {d: want_total.get(d, 0) for d in {d for _, d in drows}}


def test_gold_plans_over_written_silver(spark, scratch, bronze_of):
    bronze_root, lake = f"{scratch}/bronze", f"{scratch}/lake"
    B.land_bronze(bronze_of([report(str(i)) for i in range(20)]), bronze_root, 2024, 1)
    P.run_bronze_to_silver(spark, bronze_root, lake, 2024, 1, mode="replace")
    s = P.read_silver(spark, lake)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        pairs = _plan(G.drug_reaction_pairs(s["adverse_events"], s["drugs"], s["reactions"]))
        summary = _plan(G.drug_summary(s["adverse_events"], s["drugs"]))
        feats = _plan(G.ml_features(s["adverse_events"], s["drugs"], s["reactions"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    for plan in (pairs, summary, feats):
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
        assert "partial_count" in plan or "partial_sum" in plan  # map-side combine before the shuffle
    # the pairs scans read two columns and push the not-null filter
    assert "ReadSchema: struct<safety_report_id:string,drug_name:string>" in pairs
    assert "PushedFilters: [IsNotNull(safety_report_id)]" in pairs
    # features: one exchange of all mentions, one of the reports, one join
    assert feats.count("Exchange hashpartitioning") == 2 and feats.count("SortMergeJoin") == 1
    # the pair rows meet by (report, part), so a report of many names is many tasks
    assert "hashpartitioning(safety_report_id" in pairs and ", part#" in pairs


def test_dedup_combines_map_side(spark, bronze_of):
    ev = S.silver_events(bronze_of([report("1"), report("1"), report("2")]))
    plan = _plan(ev)
    assert "partial_max" in plan
    assert ev.count() == 2


def test_bucketed_silver_is_read_side_by_side(spark, scratch, bronze_of):
    """Over silver tables bucketed by report id nothing is exchanged by it:
    the summaries and features read matching buckets, and the pairs exchange
    crowded reports alone."""
    import re

    from aevia.sources import storage as T

    hot = [report("hot", serious="1", drugs=[(f"d{i}", "1", None) for i in range(25)], reactions=["x", "y"])]
    rest = [report(str(i), serious="2" if i % 2 else "1", drugs=[("c", "3", None), ("a", "1", None)], reactions=["x"]) for i in range(50)]
    silver = S.build_silver(bronze_of(hot + rest + [report(None, drugs=[("n", "1", None)])]))
    database = scratch.rsplit("/", 1)[1].replace("-", "_")
    names = T.publish_silver(spark, silver, database, buckets=4, location=scratch)
    assert names == [f"{database}.{n}" for n in ("adverse_events", "drugs", "reactions")]
    s = T.read_published_silver(spark, database)
    ev, dr, rx = s["adverse_events"], s["drugs"], s["reactions"]
    plain = G.build_gold(silver["adverse_events"], silver["drugs"], silver["reactions"])
    for t in (ev, dr, rx):
        assert t.count() > 0
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, df in G.build_gold(ev, dr, rx, side_by_side=True).items():
            assert sorted(map(str, df.collect())) == sorted(map(str, plain[name].collect()))
            exchanged = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", _plan(df).split("Initial Plan")[0])
            assert not [e for e in exchanged if e.startswith("safety_report_id")], (name, exchanged)
        split = G.drug_reaction_pairs(ev, dr, rx, part=10)  # the hot report is crowded
        assert sorted(map(str, split.collect())) == sorted(map(str, plain["drug_reaction_pairs"].collect()))
        exchanged = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", _plan(split).split("Initial Plan")[0])
        by_id = [e for e in exchanged if e.startswith("safety_report_id")]
        assert len(by_id) == 2 and all(", part" in e for e in by_id)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
