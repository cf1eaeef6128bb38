"""Discovery: listed objects joined to metadata, for every target partition in one job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketflow.functions.case_types import with_case_type
from docketflow.functions.text import clip, first_nonblank, parties, stem, suffix_split
from docketflow.operators.catalogue import TARGET, partition_prefix
from docketflow.operators.metadata_index import hc_index, sc_index
from docketflow.schemas import DISCOVERED
from docketflow.settings import DEFAULTS, Limits

# What a row says when its metadata is silent.
HC_LINK = "https://judgments.ecourts.gov.in/"
SC_LINK = "https://scr.sci.gov.in/"
SC_COURT = "Supreme Court of India"


def usable(objects: DataFrame, limits: Limits = DEFAULTS) -> DataFrame:
    """Documents directly in their partition, of an acceptable size (both bounds included)."""
    name = F.col("filename")
    return objects.where(
        name.endswith(".pdf") & ~name.contains("/")
        & F.col("bytes").between(limits.min_pdf_bytes, limits.max_pdf_bytes)
    )


def in_targets(objects: DataFrame, targets: DataFrame) -> DataFrame:
    """Objects of the target partitions."""
    wanted = targets.select(partition_prefix().alias("prefix")).distinct()
    return objects.withColumn("prefix", partition_prefix()).join(wanted, "prefix", "left_semi")


def metadata_in_targets(metadata: DataFrame, targets: DataFrame) -> DataFrame:
    """Metadata rows of the target partitions; the yearly collection is kept by year.

    Done before any text is normalised.  Targets are a few columns per partition, a size at
    which Spark broadcasts them by itself.
    """
    if "court_code" in metadata.columns:
        hc = targets.where(F.col("source") == "hc").select(
            "year", F.col("court").alias("court_code"), "bench").distinct()
        return metadata.join(hc, ["year", "court_code", "bench"], "left_semi")
    years = targets.where(F.col("source") == "sc").select("year").distinct()
    return metadata.join(years, "year", "left_semi")


def _resolve_title(rows: DataFrame) -> DataFrame:
    """Title and case type, falling back to the file's stem for rows without a title.

    ``title_type`` is ready for titled rows; for the others the text searched is empty, so the
    pattern chain costs nothing there.
    """
    untitled = F.col("m.title").isNull()
    typed = with_case_type(
        rows, "stem_type", F.when(untitled, F.col("stem")), F.col("m.loose_description"))
    return typed.withColumn("title", first_nonblank("m.title", "stem")).withColumn(
        "case_type", F.when(untitled, F.col("stem_type")).otherwise(F.col("m.title_type")))


def _emit(rows: DataFrame, keep: tuple[str, ...] = (), **columns: Column | str) -> DataFrame:
    out = {k: F.col(v) if isinstance(v, str) else v for k, v in columns.items()}
    return rows.select(*[out[c].alias(c) for c in DISCOVERED], *keep)


def discover_hc(
    objects: DataFrame, metadata: DataFrame, court_dim: DataFrame, limits: Limits = DEFAULTS
) -> DataFrame:
    """Ledger rows for High Court objects, with their partition ``prefix``.

    The join key holds the file name, so it is spread evenly however large one court is.
    """
    files = usable(objects.where(F.col("source") == "hc"), limits).select(
        "bucket", "s3_key", "bytes", "year", F.col("court").alias("court_code"), "bench",
        "filename", stem("filename").alias("stem"),
        partition_prefix().alias("prefix"),
    )
    index = hc_index(metadata).withColumnRenamed("last", "m")
    rows = files.join(index, ["year", "court_code", "bench", "filename"], "left").join(
        F.broadcast(court_dim), "court_code", "left")
    rows = _resolve_title(rows).withColumn("own_citation", F.concat(
        F.lit("HC/"), "court_code", F.lit("/"), "bench", F.lit("/"), "stem"))
    cnr = F.col("m.cnr")
    return _emit(
        rows, ("prefix",), source=F.lit("hc"), bucket="bucket", s3_key="s3_key", bytes="bytes",
        citation=F.substring("own_citation", 1, 255),
        source_citation=F.substring(F.coalesce(cnr, "own_citation"), 1, 255),
        title="title", year=F.coalesce("m.decision_year", "year"),
        decision_date="m.decision_date",
        court=F.coalesce("m.court_text", "court_name", "court_code"),
        court_type=F.lit("high_court"), state_name="state_name", bench="bench",
        bench_type="m.bench_type", case_type="case_type", judges="m.judges",
        parties=clip(parties("title"), 2000), outcome="m.outcome", language=F.lit("en"),
        source_url=F.concat(F.lit(HC_LINK + " (CNR "), cnr, F.lit(")")), cnr=cnr,
    )


def discover_sc(
    objects: DataFrame, metadata: DataFrame, limits: Limits = DEFAULTS
) -> DataFrame:
    """Ledger rows for Supreme Court objects, with their partition ``prefix``.

    A file matches metadata by its stem without the language suffix, else by its whole stem;
    the matched row is taken as a whole.  A stem without a suffix searches by itself at once,
    which keeps empty keys, all alike, out of the join.
    """
    kind = F.coalesce(F.nullif(F.col("court"), F.lit("")), F.lit("english"))
    files = usable(objects.where(F.col("source") == "sc"), limits).select(
        "bucket", "s3_key", "bytes", "year", kind.alias("kind"), stem("filename").alias("stem"),
        partition_prefix().alias("prefix"),
    )
    base, suffix = suffix_split("stem")
    files = files.withColumn("suffix", suffix).withColumn("base", first_nonblank(base, "stem"))
    index = sc_index(metadata)
    by_base = index.select("year", F.col("path").alias("base"), F.col("last").alias("by_base"))
    by_stem = index.select("year", F.col("path").alias("stem"), F.col("last").alias("by_stem"))
    rows = (
        files.join(by_base, ["year", "base"], "left")
        .join(by_stem, ["year", "stem"], "left")
        .withColumn("m", F.coalesce("by_base", "by_stem")).drop("by_base", "by_stem")
    )
    rows = _resolve_title(rows).withColumn("own_citation", F.concat(
        F.lit("SC/"), F.col("year").cast("string"), F.lit("/"), "stem"))
    regional = F.col("kind") != "english"
    named = F.col("suffix") != ""
    return _emit(
        rows, ("prefix",), source=F.lit("sc"), bucket="bucket", s3_key="s3_key", bytes="bytes",
        citation=F.substring(
            F.when(regional & named, F.concat("own_citation", F.lit("_"), "suffix"))
            .otherwise(F.col("own_citation")), 1, 255),
        source_citation=F.substring(
            F.coalesce("m.reported_citation", "own_citation"), 1, 255),
        title="title", year=F.coalesce("m.decision_year", "year"),
        decision_date="m.decision_date", court=F.coalesce("m.court_text", F.lit(SC_COURT)),
        court_type=F.lit("supreme_court"), state_name=F.lit("India"),
        bench=F.lit(None).cast("string"), bench_type="m.bench_type", case_type="case_type",
        judges="m.judges", parties=clip("m.parties", 2000), outcome="m.outcome",
        language=F.when(regional, F.substring(
            F.lower(F.when(named, F.col("suffix")).otherwise(F.lit("regional"))), 1, 10)
        ).otherwise(F.lit("en")),
        source_url=F.lit(SC_LINK), cnr="m.cnr",
    )


def discover(
    objects: DataFrame, hc_metadata: DataFrame, sc_metadata: DataFrame, court_dim: DataFrame,
    limits: Limits = DEFAULTS,
) -> DataFrame:
    """Both collections together."""
    return discover_hc(objects, hc_metadata, court_dim, limits).unionByName(
        discover_sc(objects, sc_metadata, limits))


def scan_summary(
    targets: DataFrame, objects: DataFrame, found: DataFrame, queued: DataFrame,
    errors: DataFrame | None = None,
) -> DataFrame:
    """Per target: objects seen before any filter, usable rows, newly queued rows, error.

    Every count is a partial aggregate on the prefix; a target without objects counts 0.
    """
    def tally(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy("prefix").agg(F.count("*").alias(name))

    named = targets.select(*TARGET, partition_prefix().alias("prefix")).dropDuplicates(["prefix"])
    seen = tally(objects.select(partition_prefix().alias("prefix")), "seen")
    out = named.join(seen, "prefix", "left")
    out = out.join(tally(found, "usable"), "prefix", "left")
    out = out.join(tally(queued, "queued"), "prefix", "left")
    if errors is None:
        out = out.withColumn("metadata_error", F.lit(None).cast("string"))
    else:
        failed = errors.select(partition_prefix().alias("prefix"), "error").groupBy("prefix").agg(
            F.min("error").alias("metadata_error"))
        out = out.join(failed, "prefix", "left")
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("seen", "usable", "queued")]
    return out.select("prefix", "source", *counts, "metadata_error")


def scan_events(summary: DataFrame) -> DataFrame:
    """Log lines of a scan: a warning where metadata failed, then the counts."""
    warned = summary.where(F.col("metadata_error").isNotNull()).select(
        "prefix", F.lit(0).alias("line"), F.lit("warn").alias("level"),
        F.format_string("%s: metadata unreadable (%s), documents taken without it",
                        "prefix", "metadata_error").alias("message"))
    counted = summary.select(
        "prefix", F.lit(1).alias("line"), F.lit("info").alias("level"),
        F.format_string("%s scanned: %d objects, %d usable, %d new",
                        "prefix", "seen", "usable", "queued").alias("message"))
    return warned.unionByName(counted).withColumn("item_id", F.lit(None).cast("long"))
