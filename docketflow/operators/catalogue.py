"""What the listings hold, and which partitions a request covers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketflow.functions.text import col
from docketflow.operators.arrival import with_arrival_ids
from docketflow.operators.keyed import first_per_key

TARGET = ["source", "year", "court", "bench"]

# The kinds of Supreme Court documents, and the years a request may name.
SC_KINDS = ("english", "regional")
FIRST_YEAR, LAST_YEAR = 1950, 2100


def check_request(source: str, year_from: int, year_to: int) -> None:
    """Refuse an unknown collection or an impossible year range."""
    if source not in ("hc", "sc"):
        raise ValueError(f"unknown source {source!r}")
    for year in (year_from, year_to):
        if not FIRST_YEAR <= year <= LAST_YEAR:
            raise ValueError(f"year {year} outside {FIRST_YEAR}-{LAST_YEAR}")
    if year_to < year_from:
        raise ValueError("year_to lies before year_from")


def years(objects: DataFrame, source: str) -> DataFrame:
    found = objects.where((F.col("source") == source) & F.col("year").isNotNull())
    return found.select("year").distinct().orderBy("year")


def courts(objects: DataFrame, court_dim: DataFrame, year: int | None = None) -> DataFrame:
    """Court codes with their names, by name; an unknown code stands for itself."""
    hc = objects.where(F.col("source") == "hc")
    hc = hc if year is None else hc.where(F.col("year") == year)
    codes = hc.select("year", F.col("court").alias("code")).distinct()
    names = court_dim.select(F.col("court_code").alias("code"), "court_name")
    return codes.join(F.broadcast(names), "code", "left").select(
        "year", "code", F.coalesce("court_name", "code").alias("name")
    ).orderBy("year", "name", "code")


def benches(objects: DataFrame, year: int | None = None, court: str | None = None) -> DataFrame:
    hc = objects.where(F.col("source") == "hc")
    if year is not None:
        hc = hc.where(F.col("year") == year)
    if court is not None:
        hc = hc.where(F.col("court") == court)
    return hc.select("year", "court", "bench").distinct().orderBy("year", "court", "bench")


def expand_hc(
    objects: DataFrame, year_from: int, year_to: int, court_filter: list[str] | None = None
) -> DataFrame:
    """Existing (year, court, bench) combinations; an empty filter means every court."""
    check_request("hc", year_from, year_to)
    hc = objects.where(
        (F.col("source") == "hc") & F.col("year").between(year_from, year_to)
    )
    if court_filter:
        hc = hc.where(F.col("court").isin(*court_filter))
    return hc.select(*TARGET).distinct()


def expand_sc(
    spark: SparkSession, year_from: int, year_to: int, include_regional: bool = False
) -> DataFrame:
    """Every year of the range for each kind asked for, whether or not objects exist."""
    check_request("sc", year_from, year_to)
    return sc_targets(
        spark.range(1).select(F.lit(year_from).alias("lo"), F.lit(year_to).alias("hi")),
        include_regional,
    )


def sc_targets(bounds: DataFrame, include_regional: bool) -> DataFrame:
    """Targets for the year range held in a one-row frame (lo, hi)."""
    kinds = SC_KINDS if include_regional else SC_KINDS[:1]
    return (
        bounds.select(F.explode(F.sequence("lo", "hi")).alias("year"))
        .select(
            F.lit("sc").alias("source"), F.col("year").cast("int").alias("year"),
            F.explode(F.array(*[F.lit(k) for k in kinds])).alias("court"),
            F.lit(None).cast("string").alias("bench"),
        )
    )


def partition_prefix(
    source: Column | str = "source", year: Column | str = "year",
    court: Column | str = "court", bench: Column | str = "bench",
) -> Column:
    """Stable identity of a partition."""
    year = col(year).cast("string")
    hc = F.concat(F.lit("hc/year="), year, F.lit("/court="), col(court),
                  F.lit("/bench="), col(bench))
    kind = F.coalesce(F.nullif(col(court), F.lit("")), F.lit("english"))
    return F.when(col(source) == "hc", hc).otherwise(
        F.concat(F.lit("sc/year="), year, F.lit("/"), kind))


def _value(part: Column) -> Column:
    """Text after the first equals sign; NULL without one."""
    at = F.instr(part, "=")
    return F.when(at > 0, F.substring(part, at + 1, F.length(part)))


def target_of(prefix: Column | str) -> Column:
    """The partition a prefix names, as a struct; NULL when it is malformed."""
    prefix = col(prefix)
    four, three = F.split(prefix, "/", 4), F.split(prefix, "/", 3)
    year = _value(F.get(four, F.lit(1))).try_cast("int")
    court, bench = _value(F.get(four, F.lit(2))), _value(F.get(four, F.lit(3)))
    kind = F.get(three, F.lit(2))
    hc = F.struct(F.lit("hc").alias("source"), year.alias("year"), court.alias("court"),
                  bench.alias("bench"))
    sc = F.struct(F.lit("sc").alias("source"), year.alias("year"), kind.alias("court"),
                  F.lit(None).cast("string").alias("bench"))
    return F.when(
        prefix.startswith("hc/") & year.isNotNull() & court.isNotNull() & bench.isNotNull(), hc
    ).when(prefix.startswith("sc/") & year.isNotNull() & kind.isNotNull(), sc)


def outstanding(targets: DataFrame, partitions: DataFrame) -> DataFrame:
    """Targets, once each, whose partition is not yet scanned."""
    done = partitions.where(F.col("status") == "done").select("prefix")
    named = targets.select(*TARGET, partition_prefix().alias("prefix"))
    return named.dropDuplicates(["prefix"]).join(done, "prefix", "left_anti")


def set_plan(
    targets: DataFrame, partitions: DataFrame, plan: DataFrame | None = None
) -> DataFrame:
    """The plan (pos, prefix, target) after installing ``targets``.

    Without ``plan`` it is replaced, positions from 0 in catalogue order; with it the targets
    it lacks are appended after its last position.
    """
    fresh = outstanding(targets, partitions)
    if plan is not None:
        fresh = fresh.join(plan.select("prefix"), "prefix", "left_anti")
    placed = with_arrival_ids(fresh, TARGET, plan, "pos", first=0).select(
        "pos", "prefix", *TARGET)
    if plan is None:
        return placed
    return plan.select("pos", "prefix", *TARGET).unionByName(placed)


def plan_progress(plan: DataFrame, position: Column) -> DataFrame:
    """One row: size of the plan, cursor within it, and what is left."""
    total = F.count("*")
    return plan.agg(total.alias("total")).select(
        "total",
        F.least(position.cast("long"), F.col("total")).alias("position"),
        F.greatest(F.lit(0).cast("long"), F.col("total") - position).alias("remaining"),
    )


def pending_targets(plan: DataFrame, position: Column) -> DataFrame:
    """Targets at or after the cursor: all of them are scanned in one job."""
    return plan.where(F.col("pos") >= position)


def plan_from_rows(rows: DataFrame) -> DataFrame:
    """Repair a plan whose targets repeat: the first position of each prefix stays."""
    return first_per_key(rows, ["prefix"], "pos")
