"""Exact frequent and top pairs without the table of all pairs.

A pair can be counted no more often than either of its names allows: a drug
at most ``sum(n_d * max n_r)`` over its reports, a reaction likewise. These
bounds cost one row a name. Names whose bound is below a threshold are taken
out of the mentions before reports are paired, so their pairs are never
made; what is left is counted as in the full table.

For the top k the threshold comes from a first round: the exact counts of the
pairs among the ``FIRST_NAMES`` drugs and reactions of the highest bounds.
The k-th of them is a lower bound of the k-th of all, so no pair of the
answer, ties included, has a name with a bound below it. Bounds only skip
work; the result is that of the full table at any ``FIRST_NAMES``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aevia.operators.gold import ID, _mentions_per_report, drug_reaction_pairs, of_reports
from aevia.operators.reports import signal_pairs, top_pairs
from aevia.sources.storage import scratch_path

#: Names of each kind whose pairs are counted first.
FIRST_NAMES = 200


def _bounds(mentions: DataFrame, others: DataFrame, name: str, other: str) -> DataFrame:
    """(name, bound): the most that a pair of this name can be counted."""
    most = _mentions_per_report(others, other, "n").groupBy(ID).agg(F.max("n").alias("most"))
    per = _mentions_per_report(mentions, name, "n").join(of_reports(most), ID)
    return per.groupBy(name).agg(F.sum(F.col("n") * F.col("most")).alias("bound"))


def name_bounds(drugs: DataFrame, reactions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The bounds of drugs and of reactions, written once: both rounds read
    them."""
    spark, written = drugs.sparkSession, []
    for name, bounds in (("drug_name", _bounds(drugs, reactions, "drug_name", "reaction_name")),
                         ("reaction_name", _bounds(reactions, drugs, "reaction_name", "drug_name"))):
        path = scratch_path(spark, f"bounds-{name}")
        bounds.write.parquet(path)
        written.append(spark.read.schema(bounds.schema).parquet(path))
    return written[0], written[1]


def _of_names(mentions: DataFrame, names: DataFrame, name: str) -> DataFrame:
    """The mentions of these names (a null name is a name, as in the full
    table)."""
    return mentions.alias("m").join(names.select(F.col(name).alias("kept")), F.col(f"m.{name}").eqNullSafe(F.col("kept")), "left_semi")


def frequent_pairs(events: DataFrame, drugs: DataFrame, reactions: DataFrame, least: int,
                   bounds: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Rows of the pairs table with ``pair_count`` of at least ``least``."""
    of_drugs, of_reactions = bounds or name_bounds(drugs, reactions)
    d = _of_names(drugs, of_drugs.where(F.col("bound") >= least), "drug_name")
    r = _of_names(reactions, of_reactions.where(F.col("bound") >= least), "reaction_name")
    return drug_reaction_pairs(events, d, r).where(F.col("pair_count") >= least)


def pair_threshold(events: DataFrame, drugs: DataFrame, reactions: DataFrame, bounds: tuple[DataFrame, DataFrame],
                   n: int, first_names: int = FIRST_NAMES) -> int:
    """A count that the ``n``-th most frequent pair reaches (0 if the first
    round has fewer than ``n`` pairs)."""
    first = [b.orderBy(F.desc("bound"), b.columns[0]).limit(first_names) for b in bounds]
    counted = drug_reaction_pairs(events, _of_names(drugs, first[0], "drug_name"), _of_names(reactions, first[1], "reaction_name"))
    best = counted.orderBy(F.desc("pair_count")).limit(n)
    found, least = best.agg(F.count(F.lit(1)), F.min("pair_count")).first()
    return int(least) if found == n and n else 0


def top_pairs_by_bound(events: DataFrame, drugs: DataFrame, reactions: DataFrame, n: int = 20,
                       first_names: int = FIRST_NAMES) -> DataFrame:
    """REP10 / TOP4 / SRT3: the table of ``reports.top_pairs``."""
    bounds = name_bounds(drugs, reactions)
    least = pair_threshold(events, drugs, reactions, bounds, n, first_names)
    return top_pairs(frequent_pairs(events, drugs, reactions, least, bounds), n)


def signal_pairs_by_bound(events: DataFrame, drugs: DataFrame, reactions: DataFrame, min_count: int = 10, n: int = 20) -> DataFrame:
    """TOP8: the table of ``reports.signal_pairs``; names that cannot be in a
    pair of ``min_count`` are not paired."""
    return signal_pairs(frequent_pairs(events, drugs, reactions, min_count), min_count, n)
