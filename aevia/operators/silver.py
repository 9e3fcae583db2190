"""Bronze -> silver builders: DataFrame in, DataFrame out, no I/O.

* ``silver_events``: one row per report id (the only shuffle of this layer)
* ``silver_drugs`` / ``silver_reactions``: one row per mention; a
  generator over the child array, map-side only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aevia.functions import exprs as X
from aevia.schemas import DRUG_ROLE_LABELS, SEX_LABELS


def _event_columns(bronze: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    return bronze.select(
        F.col("safetyreportid").alias("safety_report_id"),
        F.col("primarysourcecountry").alias("country"),
        X.parse_yyyymmdd("receivedate").alias("report_date"),
        X.binary_flag("serious").alias("is_serious"),
        X.binary_flag("seriousnessdeath").alias("death"),
        X.binary_flag("seriousnesshospitalization").alias("hospitalization"),
        X.code_label("patient.patientsex", SEX_LABELS).alias("patient_sex"),
        X.age_in_years("patient.patientonsetage", "patient.patientonsetageunit").alias("patient_age"),
        *carry,
    )


def dedupe_reports(events: DataFrame, key: str = "safety_report_id") -> DataFrame:
    """One row per ``key`` with a deterministic survivor: the latest
    ``report_date`` (nulls lose), then the greatest remaining columns.

    Written as ``max(struct)`` per key rather than a ``row_number`` window:
    the aggregate combines map-side, so a key that holds a large share of
    all rows (copies of one report) collapses before the shuffle instead of
    landing whole in one task.
    """
    others = [c for c in events.columns if c not in (key, "report_date")]
    order = ["report_date"] + others if "report_date" in events.columns else others
    return (
        events.groupBy(key)
        .agg(F.max(F.struct(*[F.col(c) for c in order])).alias("_s"))
        .select(key, *[F.col(f"_s.{c}").alias(c) for c in order])
        .select(*events.columns)
    )


def silver_events(bronze: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Report-level table; null ids are dropped (the filter is pushed below
    the de-duplication by Catalyst). ``carry`` passes bronze columns (such
    as partition columns) through unchanged."""
    ev = _event_columns(bronze, carry).where(F.col("safety_report_id").isNotNull())
    return dedupe_reports(ev)


def silver_drugs(bronze: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per drug mention. Null report ids are kept (as the reference
    does); blank or missing names are dropped. An inner explode is exact:
    reports without drugs would only yield null names, which are dropped."""
    d = bronze.select(
        F.col("safetyreportid").alias("safety_report_id"),
        F.explode("patient.drug").alias("d"),
        *carry,
    )
    return d.select(
        "safety_report_id",
        X.drug_name("d.medicinalproduct").alias("drug_name"),
        F.col("d.drugindication").alias("indication"),
        X.code_label("d.drugcharacterization", DRUG_ROLE_LABELS).alias("drug_role"),
        *carry,
    ).where(X.not_blank("drug_name"))


def silver_reactions(bronze: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per reaction mention, name in initial capitals."""
    r = bronze.select(
        F.col("safetyreportid").alias("safety_report_id"),
        F.explode("patient.reaction").alias("r"),
        *carry,
    )
    return r.select(
        "safety_report_id",
        X.reaction_name("r.reactionmeddrapt").alias("reaction_name"),
        *carry,
    ).where(X.not_blank("reaction_name"))


def build_silver(bronze: DataFrame, carry: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    return {
        "adverse_events": silver_events(bronze, carry),
        "drugs": silver_drugs(bronze, carry),
        "reactions": silver_reactions(bronze, carry),
    }
