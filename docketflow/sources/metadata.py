"""Metadata collections, read by Spark: each file gives all its rows by its own types, or one error.

Only footers are looked at file by file.  Files with equal stored types are read together by Spark's
own reader, so a large file is split like any other and only declared columns are decoded.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketflow.schemas import HC_METADATA, SC_METADATA
from docketflow.session import settle
from docketflow.sources.listing import scan_tree

# Where the metadata lives below a bucket.
METADATA_ROOT = "metadata/parquet"
FILE_NAME = "metadata.parquet"


def _files(
    spark: SparkSession, root: str, years: list[int] | None, targets: DataFrame | None = None,
    pattern: str = FILE_NAME,
) -> DataFrame:
    """(path, bytes) of the metadata files, of whole directories of years or of target partitions.

    A directory that does not exist has no files; no years give none.
    """
    top = f"{root.rstrip('/')}/{METADATA_ROOT}"
    folders = [top] if years is None else [f"{top}/year={y}" for y in sorted(set(years))]
    if targets is not None:  # a row a partition, as Spark's reader takes paths from the driver
        named = targets.where(F.col("source") == "hc").select("year", "court", "bench").distinct().collect()
        folders = [f"{top}/year={r.year}/court={r.court}/bench={r.bench}" for r in named]
    found = spark.createDataFrame([], "path string, bytes bigint")
    for path in folders:
        found = found.unionByName(files_below(spark, path, pattern))
    return found


def files_below(spark: SparkSession, folder: str, pattern: str = FILE_NAME) -> DataFrame:
    """(path, bytes) of the files of a name or pattern, however deep they lie."""
    return scan_tree(spark, folder, pattern)


def _opened(path: str) -> pa.NativeFile:
    """A file by the path that Spark lists it under."""
    if path.startswith("file:"):
        return fs.LocalFileSystem().open_input_file("/" + path.removeprefix("file:").lstrip("/"))
    system, inner = fs.FileSystem.from_uri(path)
    return system.open_input_file(inner)


def _footer_reader(names: list[str]) -> Callable:
    """(path, kind, rows, error): the declared columns that a file has and their types, by its footer."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for listed in batches:
            out: list[tuple] = []
            for path in listed.column("path").to_pylist():
                try:
                    with _opened(path) as source:
                        file = pq.ParquetFile(source)
                        fields = [f for f in file.schema_arrow if f.name in names]
                        kind = ", ".join(sorted(f"{f.name} {f.type}" for f in fields))
                        out.append((path, kind, file.metadata.num_rows, None))
                except Exception as exc:  # whatever stops the reader is the finding itself
                    out.append((path, None, None, f"Parquet parse failed: {exc}"))
            columns = list(zip(*out, strict=True)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()),
                 pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.string())],
                names=["path", "kind", "rows", "error"])

    return run


def _same(path: Column | str) -> Column:
    """A path with one slash after its scheme, as writers and readers differ in their number."""
    return F.regexp_replace(path, "^([a-z0-9]+):/+", "$1:/")


def _as_text(spark: SparkSession, paths: list[str], names: list[str]) -> DataFrame:
    """Declared columns as text, of files with equal stored types, with file path and row position.

    What a damaged file can't give is left out here, and the file by ``triaged``.  The partition is
    taken from the path: a directory named like a data column would hide it.
    """
    stored = spark.read.parquet(paths[0]).schema
    kept = T.StructType([f for f in stored.fields if f.name in names])
    rows = spark.read.schema(kept).option("ignoreCorruptFiles", "true").parquet(*paths)
    return rows.select(
        *[(F.col(n) if n in kept.fieldNames() else F.lit(None)).cast("string").alias(n) for n in names],
        _same("_metadata.file_path").alias("file_path"), F.col("_metadata.row_index").alias("ord"))


def triaged(
    files: DataFrame, declared: T.StructType
) -> tuple[DataFrame, DataFrame]:
    """(rows, errors) of metadata files: all rows of the sound ones, (path, error) of the others.

    Kinds of stored types are few and known to the driver, as are the paths that it hands to Spark's
    reader.  A first pass decodes every declared column and counts rows; a file with fewer than its
    footer tells is damaged, and none of its rows is used.
    """
    spark, names = files.sparkSession, declared.fieldNames()
    footers = settle(files.select("path").repartition("path").mapInArrow(
        _footer_reader(names), "path string, kind string, rows bigint, error string"))
    read = None
    for (kind,) in footers.where("kind IS NOT NULL").select("kind").distinct().collect():
        paths = [r.path for r in footers.where(F.col("kind") == kind).select("path").collect()]
        part = _as_text(spark, paths, names)
        read = part if read is None else read.unionByName(part)
    unread = footers.where("error IS NOT NULL").select("path", "error")
    if read is None:
        nothing = ", ".join(f"`{n}` string" for n in names) + ", file_path string, ord bigint"
        return spark.createDataFrame([], nothing), unread
    decoded = read.groupBy("file_path").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64(*names)).alias("decoded"))
    damaged = settle(
        footers.where("kind IS NOT NULL").withColumn("file_path", _same("path"))
        .join(decoded, "file_path", "left").withColumn("n", F.coalesce("n", F.lit(0)))
        # The hash is asked for, else no column would be decoded.
        .where("n <> rows OR (n > 0 AND decoded IS NULL)").select("path", "file_path", F.concat(
            F.lit("Parquet rows unreadable: "), F.col("n").cast("string"), F.lit(" of "),
            F.col("rows").cast("string")).alias("error")))
    if not damaged.isEmpty():
        read = read.join(damaged.select("file_path"), "file_path", "left_anti").select(*read.columns)
    return read, unread.unionByName(damaged.select("path", "error"))


def _path_field(name: str) -> Column:
    return F.regexp_extract("file_path", f"/{name}=([^/]+)/", 1)


def hc_rows(rows: DataFrame) -> DataFrame:
    """Rows of the first collection with the partition that their path names."""
    return rows.select(
        _path_field("year").try_cast("int").alias("year"),
        _path_field("court").alias("court_code"),
        _path_field("bench").alias("bench"),
        "ord", *HC_METADATA.fieldNames(), "file_path",
    )


def read_hc_metadata(
    spark: SparkSession, root: str, years: list[int] | None = None,
    targets: DataFrame | None = None, pattern: str = FILE_NAME,
) -> DataFrame:
    """Metadata of all partitions, of whole years, or of ``targets`` alone, whose files are then the
    only ones that are opened."""
    return hc_rows(triaged(_files(spark, root, years, targets, pattern), HC_METADATA)[0])


def read_sc_metadata(
    spark: SparkSession, root: str, years: list[int] | None = None
) -> DataFrame:
    """One file per year, shared by both kinds of document and read once for them."""
    rows = triaged(_files(spark, root, years), SC_METADATA)[0]
    return rows.select(
        _path_field("year").try_cast("int").alias("year"),
        "ord", *SC_METADATA.fieldNames(), "file_path",
    )


def metadata_errors(
    spark: SparkSession, root: str, years: list[int] | None = None, pattern: str = FILE_NAME
) -> DataFrame:
    """(path, error) of the metadata files whose rows are not read.

    Files are decoded as for reading, by the columns of their own collection, so a file gives all its
    rows or one error.  A file that is not listed is absent, which is no error, and an intact empty
    one is none either.
    """
    files = settle(_files(spark, root, years, pattern=pattern))
    of_court = F.col("path").contains("/court=")
    hc = triaged(files.where(of_court), HC_METADATA)[1]
    return hc.unionByName(triaged(files.where(~of_court), SC_METADATA)[1])


def errors_by_partition(errors: DataFrame) -> DataFrame:
    """Metadata errors keyed by partition; a yearly file fails for both kinds."""
    year = F.regexp_extract("path", r"/year=(\d+)/", 1).cast("int")
    court = F.regexp_extract("path", r"/court=([^/]+)/", 1)
    bench = F.nullif(F.regexp_extract("path", r"/bench=([^/]+)/", 1), F.lit(""))
    courts = F.when(court == "", F.array(F.lit("english"), F.lit("regional"))).otherwise(
        F.array(court)
    )
    return errors.select(
        F.when(court == "", "sc").otherwise("hc").alias("source"),
        year.alias("year"), F.explode(courts).alias("court"), bench.alias("bench"), "error",
    )
