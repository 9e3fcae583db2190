import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    scratch = tempfile.mkdtemp(prefix="aevia-test-")  # local test warehouse only
    s = (
        SparkSession.builder.master("local[4]")
        .appName("aevia-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    from aevia.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(s)  # the session's own setting, or a scratch one when unset
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from aevia.sources.storage import scratch_path

    return scratch_path(spark, "test")


def report(rid, date="20240115", serious="1", death=None, hosp=None, country="US", sex="1", age="40",
           unit="801", drugs=(("  aspirin ", "1", "pain"),), reactions=(" nausea ",)):
    """One bronze report tuple in the declared schema's field order."""
    return (
        rid, date, serious, death, hosp, country,
        (sex, age, unit,
         None if drugs is None else [tuple(d) for d in drugs],
         None if reactions is None else [(r,) for r in reactions]),
    )


@pytest.fixture()
def bronze_of(spark):
    from aevia.schemas import BRONZE_REPORT

    def make(rows):
        return spark.createDataFrame(rows, BRONZE_REPORT)

    return make
