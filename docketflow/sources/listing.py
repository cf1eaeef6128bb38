"""Object listings: which files exist, how large, and in which collection partition."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow.fs import FileSelector, FileSystem, FileType
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketflow.operators.catalogue import TARGET, partition_prefix
from docketflow.session import settle
from docketflow.settings import HC_BUCKET, SC_BUCKET

# Fixed value: where the documents live below a bucket.
DATA_ROOT = "data/pdf/"


def _after_equals(part: Column) -> Column:
    return F.substring_index(part, "=", -1)


def place_objects(
    keys: DataFrame, hc_bucket: str = HC_BUCKET, sc_bucket: str = SC_BUCKET
) -> DataFrame:
    """Split each key of an inventory (bucket, s3_key, bytes) into partition and file name.

    The split limit keeps any deeper path inside ``filename``, where the name filter sees it.
    Directory markers and keys outside the partition layout belong to no partition.
    """
    hc_parts = F.split("s3_key", "/", 6)
    sc_parts = F.split("s3_key", "/", 5)
    is_hc = F.col("bucket") == hc_bucket
    placed = (
        keys.where(F.col("bucket").isin(hc_bucket, sc_bucket))
        .where(F.col("s3_key").startswith(DATA_ROOT) & ~F.col("s3_key").endswith("/"))
        .select(
            "bucket", "s3_key", F.col("bytes").cast("long").alias("bytes"),
            F.when(is_hc, "hc").otherwise("sc").alias("source"),
            F.when(F.get(hc_parts, F.lit(2)).startswith("year="),
                   _after_equals(F.get(hc_parts, F.lit(2)))).try_cast("int").alias("year"),
            F.when(is_hc, F.when(F.get(hc_parts, F.lit(3)).startswith("court="),
                                 _after_equals(F.get(hc_parts, F.lit(3)))))
            .otherwise(F.get(sc_parts, F.lit(3))).alias("court"),
            F.when(is_hc & F.get(hc_parts, F.lit(4)).startswith("bench="),
                   _after_equals(F.get(hc_parts, F.lit(4)))).alias("bench"),
            F.when(is_hc, F.get(hc_parts, F.lit(5)))
            .otherwise(F.get(sc_parts, F.lit(4))).alias("filename"),
        )
    )
    whole = F.col("year").isNotNull() & F.col("court").isNotNull() & F.col("filename").isNotNull()
    return placed.where(whole & ((F.col("source") == "sc") | F.col("bench").isNotNull())).select(
        "bucket", "s3_key", "filename", "bytes", "source", "year", "court", "bench"
    )


def scan_tree(spark: SparkSession, root: str, pattern: str | None = None) -> DataFrame:
    """(path, bytes) of every file below ``root``; file contents are never read.

    A folder that does not exist has no files.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    try:
        found = reader.load(root)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string, bytes bigint")
    return found.select("path", F.col("length").alias("bytes"))


def list_bucket(spark: SparkSession, root: str, bucket: str) -> DataFrame:
    """Listing of a bucket mounted at ``root``.

    For very large buckets read the store's own inventory instead and pass it to
    ``place_objects``: the listing then costs one columnar scan.
    """
    files = scan_tree(spark, f"{root.rstrip('/')}/{DATA_ROOT}")
    keys = files.select(
        F.lit(bucket).alias("bucket"),
        F.regexp_extract("path", f"({DATA_ROOT}.*)$", 1).alias("s3_key"),
        "bytes",
    )
    return place_objects(keys, *((bucket, "") if bucket == HC_BUCKET else ("", bucket)))


#: Files of a folder handed on at a time.
LISTED_ROWS = 10_000


def _listed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Files of each folder; a folder that can't be listed gives one row with the reason."""
    def rows(prefix: str, names: list, sizes: list, error: str | None = None) -> pa.RecordBatch:
        n = max(len(names), 1 if error else 0)
        return pa.RecordBatch.from_arrays(
            [pa.array([prefix] * n, pa.string()), pa.array(names or [None] * n, pa.string()),
             pa.array(sizes or [None] * n, pa.int64()), pa.array([error] * n, pa.string())],
            names=["prefix", "name", "bytes", "error"])

    for batch in batches:
        for prefix, folder in zip(batch["prefix"].to_pylist(), batch["folder"].to_pylist(), strict=True):
            try:
                fs, path = FileSystem.from_uri(folder)
                found = fs.get_file_info(FileSelector(path, allow_not_found=True, recursive=True))
            except (OSError, ValueError) as exc:
                yield rows(prefix, [], [], f"{type(exc).__name__}: {exc}")
                continue
            files = [x for x in found if x.type == FileType.File]
            for at in range(0, len(files), LISTED_ROWS):
                part = files[at : at + LISTED_ROWS]
                yield rows(prefix, [x.path[len(path.rstrip("/")) + 1 :] for x in part], [x.size for x in part])


def list_targets(
    targets: DataFrame, hc_root: str, sc_root: str, hc_bucket: str = HC_BUCKET,
    sc_bucket: str = SC_BUCKET,
) -> tuple[DataFrame, DataFrame]:
    """Objects of the target partitions, and (prefix, source, error) of those that can't be listed.

    Only the targets' own folders are listed, one task row each, so nothing else of a bucket is
    read and one unreadable folder concerns its partition alone.  A folder that does not exist has
    no objects.  Roots are URIs; both frames come from one written listing.
    """
    is_hc = F.col("source") == "hc"
    place = F.when(is_hc, F.concat(
        F.lit("year="), F.col("year").cast("string"), F.lit("/court="), "court", F.lit("/bench="), "bench")
    ).otherwise(F.concat(F.lit("year="), F.col("year").cast("string"), F.lit("/"), "court"))
    root = F.when(is_hc, hc_root.rstrip("/")).otherwise(sc_root.rstrip("/"))
    named = targets.select(*TARGET, partition_prefix().alias("prefix"), place.alias("place")).distinct()
    asked = named.withColumn("folder", F.concat(root, F.lit(f"/{DATA_ROOT}"), "place"))
    listed = settle(asked.select("prefix", "folder").repartition("prefix").mapInArrow(
        _listed, "prefix string, name string, bytes long, error string"))
    rows = listed.join(named, "prefix")
    objects = rows.where(F.col("error").isNull()).select(
        F.when(is_hc, hc_bucket).otherwise(sc_bucket).alias("bucket"),
        F.concat(F.lit(DATA_ROOT), "place", F.lit("/"), "name").alias("s3_key"),
        F.col("name").alias("filename"), "bytes", *TARGET)
    return objects, rows.where(F.col("error").isNotNull()).select("prefix", "source", "error")


def read_inventory(spark: SparkSession, path: str, **buckets: str) -> DataFrame:
    """Listing from an inventory parquet with columns bucket, s3_key, bytes."""
    return place_objects(spark.read.parquet(path).select("bucket", "s3_key", "bytes"), **buckets)


def partition_dirs(objects: DataFrame) -> DataFrame:
    """The partitions that hold at least one object."""
    return objects.select("source", "year", "court", "bench").distinct()


def scan_staging(spark: SparkSession, root: str) -> DataFrame:
    """(path, bytes) of the staged documents."""
    return scan_tree(spark, root, "*.pdf")
