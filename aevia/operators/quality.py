"""Data-quality gate.

Rules are data: ``(check, aggregate expression, threshold, comparison)``.
Each suite runs as ONE aggregation over its table (the reference runs one
count job per rule), yields a small result frame
``(suite, table_name, check_name, observed, threshold, passed, severity)``,
and ``enforce`` raises ``DataQualityError`` for the first failing
error-level rule in the suite's order.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aevia.functions.exprs import not_blank
from aevia.operators.gold import of_reports
from aevia.schemas import (
    DRUG_ROLE_LABELS,
    MAX_NULL_RATE,
    MIN_ROW_COUNT,
    REQUIRED_COLUMNS,
    SEX_LABELS,
)

log = logging.getLogger(__name__)


class DataQualityError(Exception):
    """A quality rule failed; the pipeline stops before gold."""


@dataclass(frozen=True)
class Rule:
    check: str
    expr: Column  # aggregate expression -> observed value
    threshold: float
    op: str  # "<=" observed must not exceed threshold, ">=" must reach it
    severity: str = "error"
    needs: tuple[str, ...] = ()  # columns the expression reads


RESULT_COLUMNS = ["suite", "table_name", "check_name", "observed", "threshold", "passed", "severity"]


def _count_if(cond: Column) -> Column:
    return F.count_if(cond)


def _null_rate(c: str) -> Column:
    # 0 for an empty table, as the reference does
    return F.coalesce(F.try_divide(F.count_if(F.col(c).isNull()).cast("double"), F.count(F.lit(1))), F.lit(0.0))


def events_rules() -> list[Rule]:
    return [
        Rule("no_null_safety_report_ids", _count_if(F.col("safety_report_id").isNull()), 0, "<=",
             needs=("safety_report_id",)),
        Rule("is_serious_is_binary",
             _count_if(F.col("is_serious").isNotNull() & ~F.col("is_serious").isin(0, 1)), 0, "<=",
             needs=("is_serious",)),
        Rule("report_date_null_rate", _null_rate("report_date"), MAX_NULL_RATE, "<=", needs=("report_date",)),
        Rule("patient_age_realistic",
             _count_if(F.col("patient_age").isNotNull() & ((F.col("patient_age") < 0) | (F.col("patient_age") > 120))),
             0, "<=", needs=("patient_age",)),
        Rule("row_count_minimum", F.count(F.lit(1)), MIN_ROW_COUNT, ">="),
    ]


def drugs_rules() -> list[Rule]:
    return [
        Rule("drug_name_not_empty", _count_if(~not_blank("drug_name")), 0, "<=", needs=("drug_name",)),
        Rule("row_count_minimum", F.count(F.lit(1)), MIN_ROW_COUNT, ">="),
        # the reference requires the id column but never checks it: a warning
        Rule("null_safety_report_ids", _count_if(F.col("safety_report_id").isNull()), 0, "<=", "warn",
             needs=("safety_report_id",)),
    ]


def reactions_rules() -> list[Rule]:
    return [
        Rule("reaction_name_not_empty", _count_if(~not_blank("reaction_name")), 0, "<=",
             needs=("reaction_name",)),
        Rule("row_count_minimum", F.count(F.lit(1)), MIN_ROW_COUNT, ">="),
    ]


def silver_shape_rules(table: str) -> list[Rule]:
    """Invariants the reference's transformation tests assert on silver."""
    if table == "adverse_events":
        return [
            Rule("patient_sex_labels",
                 _count_if(F.col("patient_sex").isNotNull() & ~F.col("patient_sex").isin(*SEX_LABELS.values())),
                 0, "<=", needs=("patient_sex",)),
        ]
    if table == "drugs":
        return [
            Rule("drug_names_upper_case", _count_if(F.col("drug_name") != F.upper("drug_name")), 0, "<=",
                 needs=("drug_name",)),
            Rule("drug_role_labels",
                 _count_if(F.col("drug_role").isNotNull() & ~F.col("drug_role").isin(*DRUG_ROLE_LABELS.values())),
                 0, "<=", needs=("drug_role",)),
        ]
    return []


SUITES = {
    "adverse_events": events_rules,
    "drugs": drugs_rules,
    "reactions": reactions_rules,
}


def _passed(op: str, observed: Column, threshold: float) -> Column:
    t = F.lit(float(threshold))
    ok = observed <= t if op == "<=" else observed >= t
    return F.coalesce(ok, F.lit(False))


def run_rules(df: DataFrame, suite: str, table_name: str, rules: list[Rule],
              required: list[str] | None = None, seq_base: int | None = None) -> DataFrame:
    """One aggregation over ``df`` -> one result row per rule.

    The required-columns rule is a schema check: it costs no job, and rules
    that read a missing column are reported as failed instead of raising an
    analysis error.
    """
    present = set(df.columns)
    missing = [c for c in (required or []) if c not in present]
    aggs, meta = [], []
    if required is not None:
        meta.append(("required_columns_exist", F.lit(float(len(missing))), 0.0, "<=", "error"))
    for r in rules:
        if any(c not in present for c in r.needs):
            meta.append((r.check, F.lit(None).cast("double"), r.threshold, r.op, r.severity))
            continue
        alias = f"_r{len(aggs)}"
        aggs.append(r.expr.cast("double").alias(alias))
        meta.append((r.check, F.col(alias), r.threshold, r.op, r.severity))
    one = df.agg(*aggs) if aggs else df.agg(F.count(F.lit(1)).alias("_x"))
    items = [
        F.struct(
            F.lit(suite).alias("suite"),
            F.lit(table_name).alias("table_name"),
            F.lit(check).alias("check_name"),
            obs.alias("observed"),
            F.lit(float(thr)).alias("threshold"),
            _passed(op, obs, thr).alias("passed"),
            F.lit(sev).alias("severity"),
        )
        for check, obs, thr, op, sev in meta
    ]
    out = one.select(F.inline(F.array(*items))).select(*RESULT_COLUMNS)
    if seq_base is not None:
        # rule order, kept when results are stored and read back
        order = F.create_map(*[x for i, m in enumerate(meta) for x in (F.lit(m[0]), F.lit(seq_base + i))])
        out = out.withColumn("seq", order[F.col("check_name")])
    return out


def run_suite(df: DataFrame, table: str, seq_base: int | None = None) -> DataFrame:
    return run_rules(df, "silver", f"silver_{table}", SUITES[table](), REQUIRED_COLUMNS[table], seq_base)


def silver_results(silver: dict[str, DataFrame]) -> DataFrame:
    """The three silver suites as one result frame with a ``seq`` column in
    the gate's order (events, drugs, reactions; rules in suite order)."""
    out = None
    for i, table in enumerate(("adverse_events", "drugs", "reactions")):
        r = run_suite(silver[table], table, seq_base=100 * i)
        out = r if out is None else out.unionByName(r)
    return out


def run_silver_shape(df: DataFrame, table: str) -> DataFrame:
    return run_rules(df, "silver_shape", f"silver_{table}", silver_shape_rules(table))


def orphan_check(children: DataFrame, events: DataFrame, child: str = "drugs") -> DataFrame:
    """Referential check: child report ids must exist in events (null ids
    count as orphans). Rows are counted per id before the left-anti join,
    so a hot or null id is one row there."""
    per_id = children.groupBy("safety_report_id").agg(F.count(F.lit(1)).alias("rows"))
    orphans = per_id.join(of_reports(events.select("safety_report_id")), "safety_report_id", "left_anti")
    orphan_rule = run_rules(
        orphans, "referential", f"silver_{child}",
        [Rule("report_ids_exist_in_events", F.coalesce(F.sum("rows"), F.lit(0)), 0, "<=", "warn")],
    )
    # child rows >= event rows: one aggregation over a tagged union of both
    tagged = children.select(F.lit(1).alias("c")).unionByName(events.select(F.lit(-1).alias("c")))
    rows_rule = run_rules(
        tagged, "referential", f"silver_{child}",
        [Rule("child_rows_at_least_events", F.sum("c"), 0, ">=", "warn")],
    )
    return orphan_rule.unionByName(rows_rule)


def gold_rules() -> dict[str, list[Rule]]:
    rate = F.col("seriousness_rate_pct")
    in_range = rate.between(0, 100)
    return {
        "safety_overview": [
            Rule("has_one_row", F.abs(F.count(F.lit(1)) - F.lit(1)), 0, "<="),
            Rule("total_reports_positive", _count_if(~F.coalesce(F.col("total_reports") > 0, F.lit(False))), 0,
                 "<=", needs=("total_reports",)),
            Rule("seriousness_rate_in_range", _count_if(~F.coalesce(in_range, F.lit(False))), 0, "<=",
                 needs=("seriousness_rate_pct",)),
        ],
        "monthly_trends": [
            Rule("has_rows", F.count(F.lit(1)), 1, ">="),
            Rule("seriousness_rate_in_range", _count_if(~F.coalesce(in_range, F.lit(False))), 0, "<=",
                 needs=("seriousness_rate_pct",)),
        ],
        "drug_summary": [
            Rule("has_rows", F.count(F.lit(1)), 1, ">="),
            Rule("seriousness_rate_in_range", _count_if(rate.isNotNull() & ~in_range), 0, "<=",
                 needs=("seriousness_rate_pct",)),
            Rule("total_reports_positive", _count_if(~F.coalesce(F.col("total_reports") > 0, F.lit(False))), 0,
                 "<=", needs=("total_reports",)),
        ],
        "reaction_summary": [
            Rule("has_rows", F.count(F.lit(1)), 1, ">="),
        ],
        "drug_reaction_pairs": [
            Rule("has_rows", F.count(F.lit(1)), 1, ">="),
            Rule("pair_count_positive", _count_if(~F.coalesce(F.col("pair_count") > 0, F.lit(False))), 0, "<=",
                 needs=("pair_count",)),
            Rule("seriousness_rate_in_range", _count_if(rate.isNotNull() & ~in_range), 0, "<=",
                 needs=("seriousness_rate_pct",)),
        ],
        "ml_features": [
            Rule("has_rows", F.count(F.lit(1)), 1, ">="),
            Rule("num_drugs_non_negative", _count_if(F.col("num_drugs") < 0), 0, "<=", needs=("num_drugs",)),
            Rule("num_reactions_non_negative", _count_if(F.col("num_reactions") < 0), 0, "<=",
                 needs=("num_reactions",)),
            Rule("has_suspect_drug_is_binary",
                 _count_if(F.col("has_suspect_drug").isNull() | ~F.col("has_suspect_drug").isin(0, 1)), 0, "<=",
                 needs=("has_suspect_drug",)),
        ],
    }


def run_gold_suite(gold: dict[str, DataFrame], with_seq: bool = False) -> DataFrame:
    """Output invariants of the six gold tables, one aggregation each."""
    from aevia.schemas import GOLD

    out = None
    for i, (name, rules) in enumerate(gold_rules().items()):
        req = [f.name for f in GOLD[name].fields]
        r = run_rules(gold[name], "gold", name, rules, req, seq_base=None if not with_seq else 100 * i)
        out = r if out is None else out.unionByName(r)
    return out


def enforce(results: DataFrame) -> list[dict]:
    """Collect the (small, rule-count sized) result frame and raise on the
    first failing error-level rule, in rule order (``seq`` when present)."""
    if "seq" in results.columns:
        results = results.orderBy("seq")
    rows = [r.asDict() for r in results.collect()]
    for r in rows:
        if r["severity"] == "error" and not r["passed"]:
            raise DataQualityError(
                f"{r['table_name']}: check {r['check_name']} failed "
                f"(observed {r['observed']}, threshold {r['threshold']})"
            )
        log.info("%s %s.%s observed=%s", "PASS" if r["passed"] else "WARN", r["table_name"], r["check_name"],
                 r["observed"])
    return rows


def quality_gate(silver: dict[str, DataFrame]) -> list[dict]:
    """The gate between silver and gold: all three suites must pass."""
    rows = []
    for table in ("adverse_events", "drugs", "reactions"):
        rows += enforce(run_suite(silver[table], table))
    return rows
