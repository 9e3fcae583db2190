"""Session helpers.

Library code never builds its own session: every job and query takes the
caller's ``SparkSession``. ``local_session`` is for tests, scripts and the
bench only.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(app: str = "aevia", cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("AEVIA_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and scratch tables.

    Uses the cluster's ``spark.checkpoint.dir``, else a checkpoint folder
    already set on the SparkContext. When neither exists, a local master
    (tests) gets a scratch folder of this machine; any other master raises,
    as a folder of one machine is lost to the others.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None)
    if d:
        if not sc._jsc.sc().getCheckpointDir().isDefined():
            sc.setCheckpointDir(d)
        return d
    cur = sc._jsc.sc().getCheckpointDir()
    if cur.isDefined():
        return cur.get()
    if sc.master.split("[")[0] != "local":
        raise RuntimeError("no shared folder: set spark.checkpoint.dir to one that the driver and all executors reach")
    d = tempfile.mkdtemp(prefix="aevia-ckpt-")
    sc.setCheckpointDir(d)
    return sc._jsc.sc().getCheckpointDir().get()
