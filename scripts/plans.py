"""Physical plans of the gold builders over written silver, and stage
times of the monthly job from Spark's event log (written to a scratch
folder; the UI stays off).

usage: python scripts/plans.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def tree(df) -> str:
    """The operator tree of the formatted plan (without the per-node
    details)."""
    text = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    return text.split("\n\n")[0]


def _lines(path: str):
    if path.endswith(".zstd"):
        import io

        import zstandard

        with open(path, "rb") as f:
            yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(f), encoding="utf-8")
    else:
        with open(path) as f:
            yield from f


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    logs = tempfile.mkdtemp(prefix="aevia-eventlog-")
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]")
        .appName("aevia-plans")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "16")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", logs)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from aevia.operators import gold as G
    from aevia.plans import pipeline as P
    from aevia.sources import bronze as B
    from aevia.sources import testbed
    from aevia.sources.storage import scratch_path

    root = scratch_path(spark, "plans")
    B.land_bronze(testbed.bronze(spark, sf_dir), f"{root}/bronze", 2024, 1)
    sc = spark.sparkContext
    sc.setJobGroup("job_month", "monthly job")
    sc.setLocalProperty("spark.job.description", "1 bronze -> silver (3 tables)")
    P.run_bronze_to_silver(spark, f"{root}/bronze", root, 2024, 1)
    sc.setLocalProperty("spark.job.description", "2 quality gate (3 suites)")
    P.run_quality_gate(spark, root)
    sc.setLocalProperty("spark.job.description", "3 silver -> gold (6 tables)")
    P.run_build_gold(spark, root)
    sc.setLocalProperty("spark.job.description", None)
    sc.setJobGroup("plans", "plans")

    s = P.read_silver(spark, root)
    ev, dr, rx = s["adverse_events"], s["drugs"], s["reactions"]
    print(f"# Plans and stage times ({os.path.basename(sf_dir.rstrip('/'))}, local[8])\n")
    print("Generated by `scripts/plans.py`: gold builders over silver written by the monthly job.")
    print("AQE may still change join strategies at run time (broadcast when a side is small).\n")
    for name, df in G.build_gold(ev, dr, rx).items():
        print(f"## {name}\n\n```\n{tree(df)}\n```\n")
    # the shape a large silver gets: no side under the broadcast threshold
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    print("## At scale (no broadcast side)\n")
    print("The same builders with the broadcast threshold off, as when every silver table is large.\n")
    for name in ("drug_summary", "drug_reaction_pairs", "ml_features"):
        df = G.build_gold(ev, dr, rx)[name]
        print(f"### {name}\n\n```\n{tree(df)}\n```\n")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

    spark.stop()
    # stage summary of the monthly job from the event log
    stages, job_of = {}, {}
    for path in sorted(glob.glob(f"{logs}/**/*", recursive=True)):
        if os.path.isdir(path) or os.path.basename(path).startswith("appstatus"):
            continue
        for line in _lines(path):
            e = json.loads(line)
            kind = e.get("Event")
            if kind == "SparkListenerJobStart":
                props = e.get("Properties") or {}
                for sid in e.get("Stage IDs", []):
                    job_of[sid] = (props.get("spark.jobGroup.id"), props.get("spark.job.description"))
            elif kind == "SparkListenerStageCompleted":
                info = e["Stage Info"]
                if "Completion Time" not in info or "Submission Time" not in info:
                    continue
                acc = {a.get("Name"): a.get("Value") for a in info.get("Accumulables", [])}
                stages[info["Stage ID"]] = (
                    info["Number of Tasks"],
                    (info["Completion Time"] - info["Submission Time"]) / 1000.0,
                    int(acc.get("internal.metrics.shuffle.write.bytesWritten", 0) or 0),
                    int(acc.get("internal.metrics.input.bytesRead", 0) or 0),
                )
    steps: dict[str, list] = {}
    for sid, (tasks, secs, sw, rd) in sorted(stages.items()):
        group, desc = job_of.get(sid, (None, None))
        if group != "job_month":
            continue
        st = steps.setdefault(desc or "?", [0, 0, 0.0, 0, 0])
        st[0] += 1
        st[1] += tasks
        st[2] += secs
        st[3] += rd
        st[4] += sw
    print("## Stage time of the monthly job (from the event log)\n")
    print("| step | stages | tasks | stage seconds | input bytes | shuffle write bytes |")
    print("|---|---|---|---|---|---|")
    for desc, (n, tasks, secs, rd, sw) in sorted(steps.items()):
        print(f"| {desc} | {n} | {tasks} | {secs:.2f} | {rd} | {sw} |")


if __name__ == "__main__":
    main()
