"""Bronze sources and the landing sink.

* Landing writes reports as compressed JSON Lines, at most ``FILE_REPORTS``
  a file (one file is one task), into Hive-style ``year=YYYY/month=MM`` partitions with dynamic
  partition overwrite, so a rerun replaces only the months it touches.
* Reading goes through the root folder with a declared schema, so a filter
  on ``year`` / ``month`` prunes whole partitions before any file is opened.
* A monthly file that is one JSON array (the source format) is found by its
  first line and read with ``multiLine``; page files ``{"results": [...]}``
  are unwrapped with an explode.
* Nothing is dropped silently: text that does not parse is kept in
  ``_corrupt`` and counted, with missing and empty pages, in a load audit
  that gates the month.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from aevia.schemas import BRONZE_REPORT, PAGE_BODY
from aevia.sources.storage import scratch_path, take_places

PARTITIONED_BRONZE = StructType(
    list(BRONZE_REPORT.fields) + [StructField("year", IntegerType()), StructField("month", IntegerType())]
)


def check_period(year: int, month: int) -> None:
    if not 1 <= int(month) <= 12:
        raise ValueError(f"month must be 1-12, got {month}")
    if int(year) < 1:
        raise ValueError(f"bad year {year}")


def month_window(year: int, month: int) -> tuple:
    """SRC5: inclusive first and last day of a month, as Spark date columns
    (``last_day`` knows leap years)."""
    check_period(year, month)
    first = F.make_date(F.lit(int(year)), F.lit(int(month)), F.lit(1))
    return first, F.last_day(first)


def in_month(date_col: str, year: int, month: int):
    first, last = month_window(year, month)
    return F.col(date_col).between(first, last)


def period_path(root: str, year: int, month: int) -> str:
    check_period(year, month)
    return f"{root.rstrip('/')}/year={int(year)}/month={int(month):02d}"


#: Columns of a load audit, all counts.
AUDIT = ["files", "pages", "empty_pages", "missing_pages", "corrupt", "reports"]
REPORT_COLS = [f.name for f in BRONZE_REPORT.fields]
CORRUPT = "_corrupt"
PAGE_SIZE = 100  # reports a page of the source API
ARRAY_REPORTS = 20_000  # reports an array file
FILE_REPORTS = 100_000  # reports a landed file


def land_bronze(reports: DataFrame, root: str, year: int | None = None, month: int | None = None) -> str:
    """SNK1 + SRC6: write raw reports to their monthly partition.

    With ``year``/``month`` every report lands in that run period; without
    them, ``year``/``month`` columns of ``reports`` decide, and rows are brought
    together by month before the write, so a month is a few files and not
    one per task; rows of one given month are written where they are. Raises ``ValueError`` when there is nothing to land (what
    was landed before stays). The input is computed once, into a staged
    folder that readers skip; its months take their places when all is there,
    so a landing that fails leaves the months as they were.
    """
    if year is not None:
        check_period(year, month)
        reports = reports.withColumn("year", F.lit(int(year))).withColumn("month", F.lit(int(month)))
    rows = reports.select(*REPORT_COLS, "year", F.lpad(F.col("month").cast("string"), 2, "0").alias("month"))
    staged = f"{root.rstrip('/')}/_staged-{uuid.uuid4().hex}"
    if year is None:
        rows = rows.hint("rebalance", "year", "month")
    rows.write.partitionBy("year", "month").option("maxRecordsPerFile", FILE_REPORTS).json(staged, compression="gzip")
    if not take_places(reports.sparkSession, staged, root, levels=2):
        raise ValueError("no reports to land")
    return period_path(root, year, month) if year is not None else root


def write_array_files(reports: DataFrame, root: str, file_reports: int = ARRAY_REPORTS) -> str:
    """Reports as the source writes them: every month (``year``, ``month``
    of ``reports``) as array files over many lines, of about ``file_reports``
    reports each, so neither a task nor a value grows with the month. A month
    without reports has no file."""
    spark, texts = reports.sparkSession, scratch_path(reports.sparkSession, "array-reports")
    rows = reports.select("year", F.lpad(F.col("month").cast("string"), 2, "0").alias("month"),
                          F.to_json(F.struct(*REPORT_COLS)).alias("report"))
    rows.write.parquet(texts)
    rows = spark.read.schema(rows.schema).parquet(texts)
    # one row a month
    months = rows.groupBy(F.col("year").alias("y"), F.col("month").alias("m")).agg(
        F.ceil(F.count(F.lit(1)) / file_reports).cast("int").alias("files"))
    # row numbers of written files, so a task run again deals alike; they spread copies of one report too
    dealt = rows.withColumn("n", F.monotonically_increasing_id()).join(
        F.broadcast(months), F.col("year").eqNullSafe(F.col("y")) & F.col("month").eqNullSafe(F.col("m"))).withColumn(
        "file", F.pmod(F.xxhash64("n"), F.col("files")))
    arrays = dealt.groupBy("year", "month", "file").agg(
        F.concat(F.lit("[\n"), F.array_join(F.collect_list("report"), ",\n"), F.lit("\n]")).alias("value"))
    # one array a file
    arrays.select("value", "year", "month").write.mode("overwrite").option("maxRecordsPerFile", 1).partitionBy(
        "year", "month").text(root)
    return root


def read_bronze_raw(spark: SparkSession, root: str, year: int | None = None, month: int | None = None) -> DataFrame:
    """Reports of one month (or all) with ``_corrupt``, the text of what did
    not parse (null for a report), and ``_file``.

    Files are JSON Lines, or one JSON array each (indented or not). A file
    whose first line is ``[`` is an indented array: such files are read
    whole, the others by line, so a month may hold both.
    """
    schema = StructType([*PARTITIONED_BRONZE.fields, StructField(CORRUPT, StringType())])
    where = F.lit(True)
    if year is not None:
        check_period(year, month)
        where = (F.col("year") == int(year)) & (F.col("month") == int(month))
    reader = spark.read.schema(schema).option("columnNameOfCorruptRecord", CORRUPT)
    lines = reader.json(root).where(where).withColumn("_file", F.input_file_name())
    # files of the import format, some a month; all else is read by line alone
    opening = spark.read.text(root)
    if "year" not in opening.columns:  # no period has been written
        return lines
    arrays = [r[0] for r in opening.where(where).where(F.trim("value") == "[").select(F.input_file_name()).distinct().collect()]
    if not arrays:
        return lines
    whole = reader.option("multiLine", True).option("basePath", root).json(arrays).withColumn("_file", F.input_file_name())
    return lines.where(~F.col("_file").isin(arrays)).unionByName(whole)


def read_bronze(spark: SparkSession, root: str, year: int | None = None, month: int | None = None) -> DataFrame:
    """SRC1: reports of one month (or all), schema declared, partitions
    pruned by the filter, line and array files alike. Text that does not
    parse is left out here and counted by ``audit_bronze``."""
    raw = read_bronze_raw(spark, root, year, month)
    return raw.where(F.col(CORRUPT).isNull()).select(*REPORT_COLS, "year", "month")


def audit_bronze(raw: DataFrame) -> DataFrame:
    """The load audit of a month's raw reports, one row."""
    return raw.agg(
        F.count_distinct("_file").alias("files"),
        F.count(CORRUPT).alias("corrupt"),
        F.count_if(F.col(CORRUPT).isNull()).alias("reports"),
    ).select("files", *[F.lit(0).cast("long").alias(c) for c in ("pages", "empty_pages", "missing_pages")], "corrupt", "reports").select(*AUDIT)


def unwrap_pages(bodies: DataFrame, body_col: str = "body", page_col: str | None = "page") -> DataFrame:
    """SRC3 on text: one row per report of each page body; a page without a
    ``results`` key (or an unparsable one) adds no rows."""
    parsed = bodies.select(
        *([F.col(page_col)] if page_col else []),
        F.from_json(F.col(body_col), PAGE_BODY).alias("_b"),
    )
    out = parsed.select(
        *([F.col(page_col)] if page_col else []),
        F.posexplode(F.coalesce(F.col("_b.results"), F.array())).alias("pos", "r"),
    )
    return out.select(*([page_col] if page_col else []), "pos", "r.*")


def read_page_files(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Every page file under ``path`` (``page-<skip>.json`` or, as Spark lays
    files out, ``page=<skip>/...``; one JSON object each): ``skip`` (null if the name has none), ``results`` (empty without
    the key), ``_corrupt`` (the text, if it does not parse).

    With ``lines`` a file holds many pages, one a line with its own ``skip``
    (``write_page_lines``): files do not grow in number with the pages."""
    schema = StructType([*PAGE_BODY.fields, StructField(CORRUPT, StringType())])
    if lines:
        schema = StructType([StructField("skip", LongType()), *schema.fields])
        raw = spark.read.schema(schema).option("columnNameOfCorruptRecord", CORRUPT).json(path)
        return raw.select("skip", F.coalesce("results", F.array()).alias("results"), CORRUPT)
    raw = (
        spark.read.schema(schema).option("multiLine", True).option("columnNameOfCorruptRecord", CORRUPT)
        .option("recursiveFileLookup", True).json(path)
    )
    return raw.select(
        F.regexp_extract(F.input_file_name(), r"page[-=](\d+)", 1).try_cast("long").alias("skip"),
        F.coalesce("results", F.array()).alias("results"), CORRUPT)


def read_pages(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """SRC4: the reports of all page files, read in parallel. Empty, missing
    and corrupt pages take nothing from the others; ``audit_pages`` counts
    them."""
    return read_page_files(spark, path, lines).select("skip", F.posexplode("results").alias("pos", "r")).select("skip", "pos", "r.*")


def audit_pages(pages: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """The load audit of page files, one row. A page is missing when its
    skip lies below the largest one and no file has it; a file without a
    skip in its name counts as corrupt."""
    named = F.col("skip").isNotNull()
    bad = F.col(CORRUPT).isNotNull() | ~named
    expected = F.coalesce(F.floor(F.max("skip") / page_size) + 1, F.lit(0))
    return pages.agg(
        F.count(F.lit(1)).alias("files"),
        F.count_if(~bad).alias("pages"),
        F.count_if(~bad & (F.size("results") == 0)).alias("empty_pages"),
        F.greatest(expected - F.count_distinct("skip"), F.lit(0)).cast("long").alias("missing_pages"),
        F.count_if(bad).alias("corrupt"),
        F.coalesce(F.sum(F.size("results")), F.lit(0)).cast("long").alias("reports"),
    ).select(*AUDIT)


def page_bodies(reports: DataFrame, order_col: str, page_size: int = 100) -> DataFrame:
    """Pages of ``page_size`` reports as JSON text bodies, numbered by the
    reports' order key (the layout the source API serves). Each group holds
    at most ``page_size`` reports."""
    return _pages(reports, order_col, page_size).select("page", F.to_json(F.struct("results")).alias("body"))


def _pages(reports: DataFrame, order_col: str, page_size: int) -> DataFrame:
    return (
        reports.withColumn("page", F.floor(F.col(order_col) / page_size))
        .groupBy("page")
        # sorted, so a recomputed page (lost executor) has the same text
        .agg(F.array_sort(F.collect_list(F.struct(*REPORT_COLS))).alias("results"))
    )


def write_page_lines(reports: DataFrame, order_col: str, path: str, page_size: int = PAGE_SIZE) -> str:
    """The pages of ``page_bodies`` as files of many pages, one a line with
    its ``skip``. A file a page would be as many files as pages, which the
    driver lists and moves one by one."""
    pages = _pages(reports, order_col, page_size)
    pages.select((F.col("page") * page_size).alias("skip"), "results").write.json(path)
    return path


def offset_page(reports: DataFrame, order_cols: list[str], skip: int, limit: int) -> DataFrame:
    """LIM1: one page of ``limit`` rows after ``skip`` rows, in a fixed
    order."""
    return reports.orderBy(*order_cols).offset(int(skip)).limit(int(limit))
