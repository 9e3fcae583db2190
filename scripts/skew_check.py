"""Hot-key check: a third of all drug and reaction mentions moved to one
report id (silver derived from the test tables), then the gold builders
timed on it. The plain mention-level join would emit sum(d_i * r_i) rows
for the pairs table; the pre-aggregated plan emits at most distinct drug
names x distinct reaction names for the hot id.

usage: python scripts/skew_check.py [sf_dir]
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from pyspark.sql import functions as F

    from aevia.operators import gold as G
    from aevia.plans.queries import context
    from aevia.session import local_session
    from aevia.sources.storage import scratch_path

    spark = local_session("aevia-skew", shuffle_partitions=16)
    c = context(spark, sf_dir)
    root = scratch_path(spark, "skew")
    hot = F.when(F.abs(F.xxhash64("safety_report_id")) % 3 == 0, F.lit("HOT")).otherwise(F.col("safety_report_id"))
    c.events.write.parquet(f"{root}/events")
    c.drugs.withColumn("safety_report_id", hot).write.parquet(f"{root}/drugs")
    c.reactions.withColumn("safety_report_id", hot).write.parquet(f"{root}/reactions")
    ev, dr, rx = (spark.read.parquet(f"{root}/{t}") for t in ("events", "drugs", "reactions"))

    d_per = dr.groupBy("safety_report_id").count().withColumnRenamed("count", "d")
    r_per = rx.groupBy("safety_report_id").count().withColumnRenamed("count", "r")
    plain_rows = d_per.join(r_per, "safety_report_id").agg(F.sum(F.col("d") * F.col("r"))).first()[0]
    hot_share = dr.where(F.col("safety_report_id") == "HOT").count() / dr.count()

    out = {"sf_dir": sf_dir, "hot_share_of_drug_mentions": round(hot_share, 3),
           "plain_join_pair_rows": int(plain_rows)}
    d_agg = dr.groupBy("safety_report_id", "drug_name").count()
    r_agg = rx.groupBy("safety_report_id", "reaction_name").count()
    out["pre_aggregated_join_rows"] = int(
        d_agg.alias("a").join(r_agg.alias("b"), "safety_report_id").count()
    )
    for name, build in (
        ("drug_reaction_pairs", lambda: G.drug_reaction_pairs(ev, dr, rx)),
        ("drug_summary", lambda: G.drug_summary(ev, dr)),
        ("ml_features", lambda: G.ml_features(ev, dr, rx)),
    ):
        build().write.format("noop").mode("overwrite").save()  # warm-up
        t0 = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        out[f"{name}_sec"] = round(time.perf_counter() - t0, 2)
    # de-duplication with a third of all reports under one id (different
    # content, so the survivor rule matters)
    from aevia.operators import silver as S
    from aevia.sources import testbed

    b = testbed.bronze(spark, sf_dir, children=False)
    b.withColumn(
        "safetyreportid",
        F.when(F.abs(F.xxhash64("safetyreportid")) % 3 == 0, F.lit("HOT")).otherwise(F.col("safetyreportid")),
    ).write.parquet(f"{root}/bronze_hot")
    bh = spark.read.parquet(f"{root}/bronze_hot")
    out["hot_share_of_reports"] = round(bh.where(F.col("safetyreportid") == "HOT").count() / bh.count(), 3)
    S.silver_events(bh).write.format("noop").mode("overwrite").save()
    t0 = time.perf_counter()
    S.silver_events(bh).write.format("noop").mode("overwrite").save()
    out["silver_events_dedup_sec"] = round(time.perf_counter() - t0, 2)
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
