"""Ledger tables as parquet: declared schemas, additive migration, versioned replacement."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketflow.operators.keyed import overlaid
from docketflow.schemas import DEFAULTS, TABLES

#: What identifies a row of the tables that take ``update``.
KEYS = {"items": "id", "batches": "id", "scanned_partitions": "prefix", "meta": "key",
        "partition_totals": "prefix"}
#: Folders of either kind after which the next call writes the table as one new version.
MOST_STEPS = 50


def conform(df: DataFrame, table: str) -> DataFrame:
    """Give ``df`` exactly the table's columns and types.

    A column the input lacks is added with the table's default; one it has keeps its values.
    """
    defaults = DEFAULTS[table]
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in have else F.lit(defaults.get(f.name)))
        .cast(f.dataType).alias(f.name)
        for f in TABLES[table].fields
    ])


def exists(spark: SparkSession, name: str) -> bool:
    """Whether there is a file or folder of this name, in whatever store it is."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


class TableStore:
    """Ledger tables below one folder.

    ``replace`` writes a new version next to the old one and readers take the newest complete
    version, so a job lost half-way leaves the previous state readable.  A lazily read frame
    stays valid for ``keep - 1`` replacements.  ``append`` and ``update`` write only their own rows,
    each call a folder beside the version, which counts once it is complete; so the cost of a
    change follows the rows it touches and not the table.  There is one writer at a time.
    """

    def __init__(self, spark: SparkSession, root: str, keep: int = 3):
        self.spark, self.root, self.keep = spark, root.rstrip("/"), keep

    def _folder(self, name: str):
        """Hadoop path below the root, and its file system."""
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        path = hadoop.Path(f"{self.root}/{name}")
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _versions(self, table: str) -> list[int]:
        path, fs = self._folder(table)
        if not fs.exists(path):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(path)]
        return sorted(
            int(n.split("=")[1]) for n in names
            if n.startswith("version=") and fs.exists(self._folder(f"{table}/{n}/_SUCCESS")[0])
        )

    def _dir(self, table: str, version: int) -> str:
        return f"{self.root}/{table}/version={version}"

    def _steps(self, table: str, kind: str, version: int) -> list[int]:
        """Complete ``added`` or ``changed`` folders of a version, oldest first."""
        path, fs = self._folder(f"{table}/{kind}/version={version}")
        if not fs.exists(path):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(path)]
        return sorted(
            int(n.split("=")[1]) for n in names if n.startswith("step=") and fs.exists(
                self._folder(f"{table}/{kind}/version={version}/{n}/_SUCCESS")[0]))

    def _read_steps(self, table: str, kind: str, version: int) -> DataFrame | None:
        steps = self._steps(table, kind, version)
        if not steps:
            return None
        root = f"{self.root}/{table}/{kind}/version={version}"
        schema = T.StructType([*TABLES[table].fields, T.StructField("step", T.LongType())])
        return self.spark.read.option("basePath", root).schema(schema).parquet(
            *[f"{root}/step={n}" for n in steps])

    def _write_step(self, table: str, kind: str, df: DataFrame, version: int) -> None:
        last = self._steps(table, kind, version)[-1:] or [0]
        conform(df, table).write.mode("overwrite").parquet(
            f"{self.root}/{table}/{kind}/version={version}/step={last[0] + 1}")

    def create(self) -> None:
        """Create the tables that do not exist yet."""
        for table, schema in TABLES.items():
            if not self._versions(table):
                self.replace(table, self.spark.createDataFrame([], schema))

    def read(self, table: str) -> DataFrame:
        """Current rows; columns missing from older files come back with their default.

        The declared schema spares reading footers to find one.
        """
        versions = self._versions(table)
        if not versions:
            return self.spark.createDataFrame([], TABLES[table])
        stored = self.spark.read.schema(TABLES[table]).parquet(self._dir(table, versions[-1]))
        added = self._read_steps(table, "added", versions[-1])
        if added is not None:
            stored = stored.unionByName(added.drop("step"))
        changed = self._read_steps(table, "changed", versions[-1])
        if changed is not None:
            stored = overlaid(stored, changed, KEYS[table], "step")
        defaults = {c: F.coalesce(c, F.lit(v).cast(TABLES[table][c].dataType))
                    for c, v in DEFAULTS[table].items()}
        return stored.select(*[
            defaults.get(c, F.col(c)).alias(c) for c in TABLES[table].fieldNames()])

    def _write(self, table: str, df: DataFrame, version: int) -> None:
        writer = conform(df, table).write.mode("overwrite")
        if table == "items":
            writer = writer.partitionBy("source")
        writer.parquet(self._dir(table, version))

    def append(self, table: str, df: DataFrame) -> None:
        """Add rows of new keys; the call after ``MOST_STEPS`` others folds them, as in ``update``."""
        versions = self._versions(table)
        if versions and len(self._steps(table, "added", versions[-1])) >= MOST_STEPS:
            self.replace(table, self.read(table))
            versions = self._versions(table)
        if versions:
            self._write_step(table, "added", df, versions[-1])
        else:
            self._write(table, df, 1)

    def update(self, table: str, rows: DataFrame) -> None:
        """Put whole ``rows``, one of a key at most, in place of the table's rows of their keys.

        Nothing else is written, except that the call after ``MOST_STEPS`` others first folds
        them into a new version; readers see the same rows before and after.
        """
        version = self._versions(table)[-1]
        if len(self._steps(table, "changed", version)) >= MOST_STEPS:
            self.replace(table, self.read(table))
            version = self._versions(table)[-1]
        self._write_step(table, "changed", rows, version)

    def replace(self, table: str, df: DataFrame) -> None:
        """Write ``df`` as the next version; of the older ones the last few stay for readers."""
        versions = self._versions(table)
        self._write(table, df, versions[-1] + 1 if versions else 1)
        for old in versions[: 1 - self.keep]:
            for name in (f"version={old}", f"added/version={old}", f"changed/version={old}"):
                path, fs = self._folder(f"{table}/{name}")
                fs.delete(path, True)
