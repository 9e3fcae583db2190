"""Nested bronze reports derived from the flat test tables.

The real monthly report files are not available, so a deterministic set of
nested reports is built from ``orders``, ``customer``, ``nation``,
``lineitem`` and ``part``: one report per order, with one drug per line item
and one reaction per line item numbered 1..3. Modulo rules on the keys plant
every kind of bad value the silver rules must handle (null ids, unparsable
dates, unknown codes, blank names, exact duplicate reports).

Everything is a DataFrame plan: the child arrays come from one grouped
aggregation of line items by order (at most seven items per order, so the
groups are small and bounded), joined to the order rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aevia.schemas import BRONZE_REPORT
from aevia.sources.tables import table

# ---------------------------------------------------------------------------
# The planting rules of the test bronze (moduli on the keys).
# ---------------------------------------------------------------------------
NULL_ID_MOD = 997  # safetyreportid null
DUP_MOD = 50  # report present twice, exact copy
BAD_DATE_MOD = 41  # receivedate 'unknown'
NULL_SERIOUS_MOD = 7  # status P -> serious null
BAD_HOSP_MOD = 211  # seriousnesshospitalization 'x'
NULL_COUNTRY_MOD = 29  # on o_custkey
SEX_MOD = 5  # on o_custkey: 0,1,2 codes, 3 unmapped, 4 null
NULL_AGE_MOD = 13
BAD_AGE_MOD = 101  # patientonsetage 'n/a'
AGE_MOD = 1500
UNIT_MOD = 8  # 0..5 -> 800..805, 6 null, 7 '999'
NULL_DRUG_MOD = 89  # on l_partkey: medicinalproduct null
BLANK_DRUG_MOD = 97  # on l_partkey: medicinalproduct '   '
MAX_REACTION_LINE = 3
UNMAPPED_ROLE_LINE = 7
NULL_INDICATION_MOD = 3
#: Line items that one task groups by order.
TASK_LINES = 250_000


def _reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"
    )
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    # nation is a fixed code list of countries (25 rows at every scale):
    # a proven size bound, so it is broadcast.
    nation = F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    # customers and parts grow with the tables: never broadcast, however small
    # their files are
    return orders.join(customer.hint("merge"), orders.o_custkey == customer.c_custkey).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )


def _children(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_returnflag"
    )
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_brand")
    lines = li.join(part.hint("merge"), li.l_partkey == part.p_partkey)

    pk = F.col("l_partkey")
    ln = F.col("l_linenumber")
    product = (
        F.when(pk % NULL_DRUG_MOD == 0, F.lit(None).cast("string"))
        .when(pk % BLANK_DRUG_MOD == 0, F.lit("   "))
        .otherwise(F.concat(F.lit("  "), F.col("p_name"), F.lit(" ")))
    )
    role = (
        F.when(F.col("l_returnflag") == "A", F.lit("1"))
        .when(F.col("l_returnflag") == "N", F.lit("2"))
        .when(F.col("l_returnflag") == "R", F.when(ln == UNMAPPED_ROLE_LINE, F.lit("9")).otherwise(F.lit("3")))
    )
    indication = F.when(ln % NULL_INDICATION_MOD == 0, F.lit(None).cast("string")).otherwise(
        F.col("p_type")
    )
    reaction = F.concat(F.lit(" "), F.lower(F.col("p_type")), F.lit(" "), F.col("p_brand"))

    drug_item = F.struct(
        ln.alias("pos"),
        F.struct(
            product.alias("medicinalproduct"),
            role.alias("drugcharacterization"),
            indication.alias("drugindication"),
        ).alias("item"),
    )
    reaction_item = F.when(
        ln <= MAX_REACTION_LINE, F.struct(ln.alias("pos"), F.struct(reaction.alias("reactionmeddrapt")).alias("item"))
    )
    # One exchange by order key; sorted partitions let the grouping run as
    # a streaming sort-based aggregate (groups are at most seven items, so
    # a map-side combine would gain nothing). Arrays are still sorted by
    # line number, so a report's content never depends on shuffle order
    # (``sort_array`` and the field of an array of structs are compiled;
    # ``array_sort`` and ``transform`` call a lambda per item).
    # As many partitions as the lines need (a count from the file footers), so
    # that the sort of one task is as large at any size of the table.
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-li.count() // TASK_LINES))
    grouped = lines.repartition(parts, "l_orderkey").sortWithinPartitions("l_orderkey", "l_linenumber")
    return grouped.groupBy("l_orderkey").agg(
        F.sort_array(F.collect_list(drug_item))["item"].alias("drug"),
        F.sort_array(F.collect_list(reaction_item))["item"].alias("reaction"),
    )


def bronze_reports(spark: SparkSession, sf_dir: str, children: bool = True) -> DataFrame:
    """Nested reports with the declared bronze schema (plus ``_order_key``
    kept for paging and landing; it is dropped by every silver builder).

    ``children=False`` leaves the drug and reaction arrays null: the
    report-level fields are identical, and report-level consumers (the
    events table) skip the line-item grouping, as nested-schema pruning
    skips the arrays when real bronze files are scanned.
    """
    k = F.col("o_orderkey")
    ck = F.col("o_custkey")
    status = F.col("o_orderstatus")
    prio = F.col("o_orderpriority")
    null_s = F.lit(None).cast("string")

    if children:
        rep = _reports(spark, sf_dir).join(
            _children(spark, sf_dir).hint("merge"), F.col("o_orderkey") == F.col("l_orderkey"), "left"
        )
    else:
        rep = _reports(spark, sf_dir).select(
            "*",
            F.lit(None).cast(BRONZE_REPORT["patient"].dataType["drug"].dataType).alias("drug"),
            F.lit(None).cast(BRONZE_REPORT["patient"].dataType["reaction"].dataType).alias("reaction"),
        )
    sex = F.when(ck % SEX_MOD == 4, null_s).otherwise((ck % SEX_MOD).cast("string"))
    age = (
        F.when(k % NULL_AGE_MOD == 0, null_s)
        .when(k % BAD_AGE_MOD == 0, F.lit("n/a"))
        .otherwise((k % AGE_MOD).cast("string"))
    )
    unit = (
        F.when(k % UNIT_MOD <= 5, (F.lit(800) + k % UNIT_MOD).cast("string"))
        .when(k % UNIT_MOD == 6, null_s)
        .otherwise(F.lit("999"))
    )
    out = rep.select(
        k.alias("_order_key"),
        F.when(k % NULL_ID_MOD == 0, null_s).otherwise(k.cast("string")).alias("safetyreportid"),
        F.when(k % BAD_DATE_MOD == 0, F.lit("unknown"))
        .otherwise(F.date_format(F.col("o_orderdate"), "yyyyMMdd"))
        .alias("receivedate"),
        F.when(status == "F", F.lit("1"))
        .when(status == "O", F.lit("2"))
        .when(status == "P", F.when(k % NULL_SERIOUS_MOD == 0, null_s).otherwise(F.lit("2")))
        .alias("serious"),
        F.when(prio == "1-URGENT", F.lit("1")).when(prio == "5-LOW", F.lit("2")).alias("seriousnessdeath"),
        F.when(k % BAD_HOSP_MOD == 0, F.lit("x"))
        .when(prio == "2-HIGH", F.lit("1"))
        .alias("seriousnesshospitalization"),
        F.when(ck % NULL_COUNTRY_MOD == 0, null_s).otherwise(F.col("n_name")).alias("primarysourcecountry"),
        F.struct(
            sex.alias("patientsex"),
            age.alias("patientonsetage"),
            unit.alias("patientonsetageunit"),
            F.col("drug"),
            F.col("reaction"),
        ).alias("patient"),
        F.when(k % DUP_MOD == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))).alias("_copies"),
    )
    # exact duplicate reports, without a second scan of the inputs
    out = out.withColumn("_copy", F.explode("_copies")).drop("_copies", "_copy")
    return out.select("_order_key", *[F.col(f.name).cast(f.dataType).alias(f.name) for f in BRONZE_REPORT.fields])


def bronze(spark: SparkSession, sf_dir: str, children: bool = True) -> DataFrame:
    """Nested reports exactly in the declared bronze schema."""
    return bronze_reports(spark, sf_dir, children).drop("_order_key")


def parse_receivedate(bronze: DataFrame) -> DataFrame:
    """Adds ``_d``, the parsed receive date (null when unparsable), used to
    lay reports out by month."""
    return bronze.withColumn("_d", F.try_to_date(F.col("receivedate"), "yyyyMMdd"))
