"""Table sinks and readers for silver, gold and published tables.

Paths are Hadoop-FS URIs (``file:``, ``s3a://``, ``gs://``, ``hdfs://``):
Spark writes to object stores directly, so no separate upload step exists.
Scratch output goes under the cluster's shared ``spark.checkpoint.dir``,
never a machine-local temporary folder.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from aevia.schemas import GOLD, SILVER

log = logging.getLogger(__name__)

GOLD_ORDER = [
    "safety_overview",
    "monthly_trends",
    "drug_summary",
    "reaction_summary",
    "drug_reaction_pairs",
    "ml_features",
]


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (see
    ``aevia.session.ensure_checkpoint_dir``)."""
    from aevia.session import ensure_checkpoint_dir

    return ensure_checkpoint_dir(spark).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder in the shared checkpoint area."""
    return f"{shared_dir(spark)}/aevia-scratch/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop FileSystem of the path's scheme."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def has_parquet_files(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return False
    it = fs.listFiles(hpath, True)
    while it.hasNext():
        if it.next().getPath().getName().endswith(".parquet"):
            return True
    return False


def together(spark: SparkSession, jobs: Iterable[Callable], threads: int = 4) -> list:
    """The results of independent jobs, a few of them on the cluster at a
    time: small tables do not wait for one another. An error of one is
    raised when all are done."""
    with ThreadPoolExecutor(threads) as pool:
        futures = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
    return [f.result() for f in futures]


def list_periods(spark: SparkSession, path: str) -> list[str]:
    """The periods of a period-partitioned table, ascending (a folder
    listing; a missing table has none)."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(hpath)]
    return sorted(n.removeprefix("period=") for n in names if n.startswith("period="))


def write_table(df: DataFrame, root: str, layer: str, name: str, partition_by: list[str] | None = None,
                dynamic: bool = True) -> str:
    """SNK2 / SNK3: overwrite one table. With ``partition_by`` and
    ``dynamic`` only the partitions present in ``df`` are replaced."""
    path = f"{root.rstrip('/')}/{layer}/{name}"
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
        if dynamic:
            w = w.option("partitionOverwriteMode", "dynamic")
    w.parquet(path)
    log.info("written %s.%s to %s", layer, name, path)
    return path


def replace_period(df: DataFrame, root: str, layer: str, name: str, period: str) -> str:
    """SNK2: write one ``period`` partition whole. An empty ``df`` leaves an
    empty partition, never the rows of an earlier run.

    The rows are staged in a folder that readers skip and take the period's
    place when they are all there: a job that fails leaves the period as it
    was."""
    path, spark = f"{root.rstrip('/')}/{layer}/{name}", df.sparkSession
    staged, old, target = (f"{path}/{d}" for d in (f"_staged-{uuid.uuid4().hex}", f"_old-{uuid.uuid4().hex}", f"period={period}"))
    df.write.parquet(staged)
    if path_exists(spark, target):
        _rename(spark, target, old)
    _rename(spark, staged, target)
    drop_folder(spark, old)
    log.info("written %s.%s period %s to %s", layer, name, period, path)
    return path


def take_places(spark: SparkSession, staged: str, root: str, levels: int) -> list[str]:
    """The partitions of a staged folder (``levels`` deep) replace those of
    ``root``, each whole; the staged folder goes. Gives their paths below
    ``root``: a few folders, as many as the write touched."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(staged).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [""]
    for _ in range(levels):
        found = [f"{d}/{x.getPath().getName()}" for d in found for x in fs.listStatus(path(staged + d))
                 if x.isDirectory() and "=" in x.getPath().getName()]
    for d in sorted(found):
        target, old = f"{root.rstrip('/')}{d}", f"{root.rstrip('/')}/_old-{uuid.uuid4().hex}"
        if fs.exists(path(target)):
            _rename(spark, target, old)
        else:
            fs.mkdirs(path(target).getParent())
        _rename(spark, staged + d, target)
        drop_folder(spark, old)
    drop_folder(spark, staged)
    return sorted(found)


def _rename(spark: SparkSession, source: str, target: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(source).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.rename(path(source), path(target)):
        raise OSError(f"could not move {source} to {target}")


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder and all that is in it; a missing one is no error."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def read_table(spark: SparkSession, root: str, layer: str, name: str, schema: StructType | None = None) -> DataFrame:
    """SRC2: read a table with its declared schema (extra partition columns,
    if any, are dropped)."""
    schema = schema or {**SILVER, **GOLD}.get(name)
    df = spark.read.parquet(f"{root.rstrip('/')}/{layer}/{name}")
    return df.select(*[f.name for f in schema.fields]) if schema is not None else df


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """SRC8: the table at ``path``, or an empty frame of ``schema`` when it
    is missing."""
    if path_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def publish_gold(gold: dict[str, DataFrame], root: str, tables: list[str] | None = None) -> dict[str, str]:
    """SNK5 / SNK6 by path: write the gold tables in their fixed order;
    missing inputs are skipped with a warning."""
    out = {}
    for name in tables or GOLD_ORDER:
        if name not in gold:
            log.warning("gold table %s missing, not published", name)
            continue
        out[name] = write_table(gold[name], root, "published", name)
    return out


def publish_to_catalog(spark: SparkSession, gold: dict[str, DataFrame], database: str,
                       tables: list[str] | None = None, location: str | None = None) -> list[str]:
    """SNK4 / SNK5 through the catalog: replace each table whole
    (``saveAsTable`` in overwrite mode; the schema comes from the frame).
    A new database is made at ``location``, else in the warehouse folder
    that the cluster sets."""
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{at}")
    names = []
    for name in tables or GOLD_ORDER:
        if name in gold:
            gold[name].write.mode("overwrite").format("parquet").saveAsTable(f"{database}.{name}")
            names.append(f"{database}.{name}")
    return names


#: The column that all silver tables are laid out by.
REPORT_ID = "safety_report_id"


def publish_silver(spark: SparkSession, silver: dict[str, DataFrame], database: str, buckets: int,
                   location: str | None = None) -> list[str]:
    """SNK4 for silver: catalog tables bucketed and sorted by report id, all
    into the same number of ``buckets``. Joins and aggregates by report id
    then read matching buckets side by side and exchange nothing. Rows are
    brought together by bucket before the write, so a bucket is one file (a
    hot id's bucket is as large as its rows)."""
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{at}")
    names = []
    for name, df in silver.items():
        (df.repartition(buckets, REPORT_ID).write.mode("overwrite").format("parquet").bucketBy(buckets, REPORT_ID)
         .sortBy(REPORT_ID).saveAsTable(f"{database}.{name}"))
        names.append(f"{database}.{name}")
    return names


def read_published_silver(spark: SparkSession, database: str) -> dict[str, DataFrame]:
    """The bucketed silver tables, in their declared columns."""
    return {n: spark.table(f"{database}.{n}").select(*schema.fieldNames()) for n, schema in SILVER.items()}


def copy_parquet_table(spark: SparkSession, src: str, dst: str) -> str:
    """SNK6 re-aimed: move a Parquet table between storage URIs with Spark
    (distributed read and write; data files only). A source without
    Parquet files is a warning, not an error."""
    if not has_parquet_files(spark, src):
        log.warning("no parquet files under %s, nothing copied", src)
        return ""
    spark.read.parquet(src).write.mode("overwrite").parquet(dst)
    return dst


def load_ml_features(spark: SparkSession, path: str | None = None, table: str = "gold.ml_features") -> DataFrame:
    """SRC7: the feature table from storage if present, else from the
    catalog."""
    if path and path_exists(spark, path):
        return spark.read.parquet(path)
    return spark.table(table)
