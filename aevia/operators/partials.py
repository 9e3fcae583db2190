"""Mergeable partial aggregates of the gold tables.

A part is what some reports add to a gold table: sums by key that can be
added up, and taken back by adding them again with the opposite sign. Every
sum that may be null in gold (no report with a known value) comes with the
count of known values, so that a merged table says null where a table built
at once does.

``gold = finish(merge(parts of all reports))``, whatever the way in which the
reports are dealt into parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aevia.functions.exprs import rate_pct
from aevia.operators import gold as G

ID = G.ID

#: Keys of the parts, by the name of the part table.
KEYS = {
    "events": ["year", "month"],
    "drugs": ["drug_name"],
    "reactions": ["reaction_name"],
    "pairs": ["drug_name", "reaction_name"],
}


def event_parts(events: DataFrame) -> DataFrame:
    """Per report month: reports, and sums and known values of the flags."""
    flags = [x for c in ("is_serious", "death", "hospitalization")
             for x in (F.sum(c).alias(c), F.count(c).alias(f"{c}_known"))]
    return events.groupBy(F.year("report_date").alias("year"), F.month("report_date").alias("month")).agg(
        F.count(ID).alias("reports"), *flags)


def report_mentions(mentions: DataFrame, events: DataFrame, name: str) -> DataFrame:
    """(id, name, n, is_serious) of the mentions whose report is in
    ``events``, and of those without an id; of drugs also ``suspect``, 1 if
    one was. All parts come from these rows, so mentions and reports meet
    once, in one exchange by report id."""
    sums = [F.count(F.lit(1)).alias("n")]
    if name == "drug_name":
        sums.append(F.max(F.when(F.col("drug_role") == "Suspect", 1).otherwise(0)).alias("suspect"))
    known = mentions.where(F.col(ID).isNotNull()).join(G.of_reports(events.select(ID, "is_serious")), ID)
    nobody = mentions.where(F.col(ID).isNull()).groupBy(name).agg(*sums).withColumns({
        ID: F.lit(None).cast("string"), "is_serious": F.lit(None).cast(events.schema["is_serious"].dataType)})
    return known.groupBy(ID, name, "is_serious").agg(*sums).unionByName(nobody)


def mention_parts(mentions: DataFrame, events: DataFrame, name: str) -> DataFrame:
    """Per name: mentions, those with a report id, and the seriousness of
    their reports. Mentions are combined per report before the join, as in
    ``gold``."""
    per = mentions.groupBy(ID, name).agg(F.count(F.lit(1)).alias("n"))
    return name_parts(per.join(G.of_reports(events.select(ID, "is_serious")), ID, "left"), name)


def name_parts(joined: DataFrame, name: str) -> DataFrame:
    """``mention_parts`` of rows as ``report_mentions`` gives them."""
    n, none = F.col("n"), F.lit(0).cast("long")
    return joined.groupBy(name).agg(
        F.sum("n").alias("mentions"),
        F.coalesce(F.sum(F.when(F.col(ID).isNotNull(), n)), none).alias("reports"),
        F.sum(n * F.col("is_serious")).alias("is_serious"),
        F.coalesce(F.sum(F.when(F.col("is_serious").isNotNull(), n)), none).alias("is_serious_known"))


def pair_parts(drugs: DataFrame, reactions: DataFrame, part: int = G.PAIR_PART) -> DataFrame:
    """Per drug and reaction: mention pairs and the seriousness of their
    reports, of rows as ``report_mentions`` gives them."""
    d, r = (m.where(F.col(ID).isNotNull()) for m in (drugs, reactions))
    pairs = G.paired(d.select(ID, "drug_name", F.col("n").alias("n_d")),
                     r.select(ID, "reaction_name", F.col("n").alias("n_r"), "is_serious"), part)
    w = F.col("n_d") * F.col("n_r")
    return pairs.groupBy("drug_name", "reaction_name").agg(
        F.sum(w).alias("pairs"), F.sum(w * F.col("is_serious")).alias("is_serious"),
        F.coalesce(F.sum(F.when(F.col("is_serious").isNotNull(), w)), F.lit(0).cast("long")).alias("is_serious_known"))


def all_parts(events: DataFrame, drugs: DataFrame, reactions: DataFrame) -> dict[str, DataFrame]:
    """The parts of reports and their ``report_mentions``."""
    return {
        "events": event_parts(events),
        "drugs": name_parts(drugs, "drug_name"),
        "reactions": name_parts(reactions, "reaction_name"),
        "pairs": pair_parts(drugs, reactions),
    }


def negated(parts: DataFrame, name: str) -> DataFrame:
    """What takes ``parts`` back."""
    return parts.select(*[F.col(c) if c in KEYS[name] else (-F.col(c)).alias(c) for c in parts.columns])


def merged(parts: DataFrame, name: str) -> DataFrame:
    """Parts added up by key; a key that nothing is left of goes."""
    sums = [c for c in parts.columns if c not in KEYS[name]]
    out = parts.groupBy(*KEYS[name]).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums])
    return out.where(F.col({"events": "reports", "pairs": "pairs"}.get(name, "mentions")) > 0)


def _known(name: str) -> Column:
    """A sum, null if no value of it is known."""
    return F.when(F.col(f"{name}_known") > 0, F.col(name))


def finished(name: str, parts: DataFrame) -> dict[str, DataFrame]:
    """The gold tables that merged parts make up."""
    if name == "events":
        return {"safety_overview": _overview(parts), "monthly_trends": _rates(parts, ["year", "month"])}
    if name == "pairs":
        sums = [F.col("pairs").alias("pair_count"), _known("is_serious").alias("serious_count")]
        return {"drug_reaction_pairs": parts.select(*KEYS[name], *sums).withColumn(
            "seriousness_rate_pct", rate_pct("serious_count", "pair_count"))}
    table = {"drugs": "drug_summary", "reactions": "reaction_summary"}[name]
    return {table: parts.select(
        *KEYS[name], F.col("reports").alias("total_reports"), _known("is_serious").alias("serious_reports"),
    ).withColumn("seriousness_rate_pct", rate_pct("serious_reports", "total_reports"))}


def _rates(parts: DataFrame, keys: list[str]) -> DataFrame:
    return parts.select(
        *keys, F.col("reports").alias("total_reports"), _known("is_serious").alias("serious_reports"),
        _known("death").alias("death_reports"), _known("hospitalization").alias("hospitalization_reports"),
    ).withColumn("seriousness_rate_pct", rate_pct("serious_reports", "total_reports"))


def _overview(parts: DataFrame) -> DataFrame:
    sums = [c for c in parts.columns if c not in KEYS["events"]]
    return _rates(parts.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums]), [])
