"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aevia.sources.storage import scratch_path

#: A word is a maximal run of characters other than these six.
BLANKS = " \t\n\x0b\x0c\r"
WORD_SPLIT = "[ \\t-\\r]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def vocabulary_path(name: str) -> str:
    """A vocabulary file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


def read_bytes(path: str) -> bytes:
    """A vocabulary file, read on the driver and shipped with the tasks (a
    file of a published tokenizer: 2 MB at most, whatever the data)."""
    if os.path.getsize(path) > 64 << 20:
        raise ValueError(f"{path} is too large for a vocabulary")
    with open(path, "rb") as f:
        return f.read()


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the cluster's shared scratch folder and read
    back: later steps start from the files, so a lost executor costs only
    the step at hand, and joins of two saved tables can be split by skew."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words_of(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text, in order; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_SPLIT), lambda w: w != "")


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often ``body``
    uses it and wherever the optimizer moves the expression."""
    return F.transform(F.array(value), body)[0]


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def use_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver found it
    (clusters that install it, or set PYTHONPATH, do not need this)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])
