"""Snapshots: tables published together, all at once or not at all.

A snapshot root holds data folders, each written once and never changed, and
numbered manifests (``_snapshots/00000007.json``) that name, for every table,
the folders it is made of, by part (a period, or ``all``). Writing has two
steps: ``stage`` writes a frame to a fresh folder that no manifest names, and
``commit`` adds one manifest that takes up all staged folders. A job that
fails before the commit changes nothing that a reader sees, several tables
change in the same instant, and every earlier snapshot can still be read.

The commit creates the manifest's file without overwriting, so of two writers
that started from the same snapshot one fails and can commit again. (On file
systems whose create is exclusive, such as HDFS; an object store needs
conditional puts for that.)
"""

from __future__ import annotations

import json
import logging
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from aevia.sources import storage as T

log = logging.getLogger(__name__)

WHOLE = "all"


class ConcurrentCommit(RuntimeError):
    """Another writer committed first."""


class Snapshots:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _fs(self, path: str):
        hpath = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return hpath.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), hpath

    def _manifest(self, number: int) -> str:
        return f"{self.root}/_snapshots/{number:08d}.json"

    def numbers(self) -> list[int]:
        """The snapshots there are, ascending."""
        fs, folder = self._fs(f"{self.root}/_snapshots")
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json"))

    def tables(self, number: int | None = None) -> dict[str, dict[str, str]]:
        """Folders by table and part, of a snapshot (default: the newest)."""
        known = self.numbers()
        if number is None and not known:
            return {}
        if number is not None and number not in known:
            raise ValueError(f"no snapshot {number} under {self.root}")
        fs, path = self._fs(self._manifest(known[-1] if number is None else number))
        stream = fs.open(path)
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)["tables"]

    def stage(self, df: DataFrame, table: str) -> str:
        """``df`` written to a fresh folder, which no reader sees yet."""
        folder = f"data/{table}/{uuid.uuid4().hex}"
        df.write.parquet(f"{self.root}/{folder}")
        return folder

    def commit(self, changes: dict[str, dict[str, str | None]], base: int | None = None) -> int:
        """A new snapshot: of every table in ``changes`` the parts given are
        replaced (by nothing, if None; all parts, if ``WHOLE`` is given).
        ``base`` is the snapshot that the changes were worked out from
        (default: the newest); with a newer one there, the commit fails."""
        known = self.numbers()
        newest = known[-1] if known else 0
        if base is not None and base != newest:
            raise ConcurrentCommit(f"snapshot {newest} came after {base}")
        tables = self.tables(newest) if known else {}
        for table, parts in changes.items():
            kept = {} if WHOLE in parts else {p: f for p, f in tables.get(table, {}).items() if p != WHOLE}
            tables[table] = {p: f for p, f in {**kept, **parts}.items() if f is not None}
        fs, path = self._fs(self._manifest(newest + 1))
        text = json.dumps({"snapshot": newest + 1, "tables": tables}, sort_keys=True, indent=1)
        try:
            stream = fs.create(path, False)
        except Exception as e:  # a Java exception of the file system
            if "already exists" in str(e):
                raise ConcurrentCommit(f"snapshot {newest + 1} was committed meanwhile") from e
            raise
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        log.info("committed snapshot %d of %s", newest + 1, self.root)
        return newest + 1

    def publish(self, frames: dict[str, DataFrame], part: str = WHOLE) -> int:
        """All frames as one new snapshot, each as ``part`` of its table."""
        staged = T.together(self.spark, [lambda n=n, df=df: (n, self.stage(df, n)) for n, df in frames.items()])
        return self.commit({name: {part: folder} for name, folder in staged})

    def read(self, table: str, schema: StructType | None = None, number: int | None = None,
             parts: list[str] | None = None) -> DataFrame:
        """A table of a snapshot (default: the newest), or just some of its
        parts. A table that the snapshot does not hold is empty, if its
        schema is given."""
        folders = self.tables(number).get(table, {})
        paths = [f"{self.root}/{f}" for p, f in sorted(folders.items()) if parts is None or p in parts]
        if not paths:
            if schema is None:
                raise ValueError(f"no table {table} in the snapshot")
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(*paths)

    def history(self) -> DataFrame:
        """(snapshot, table, part, folder): what every snapshot is made of."""
        rows = [(n, t, p, f) for n in self.numbers() for t, parts in self.tables(n).items() for p, f in parts.items()]
        return self.spark.createDataFrame(rows, "snapshot int, table string, part string, folder string").orderBy(
            F.desc("snapshot"), "table", "part")
