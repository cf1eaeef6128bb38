"""The life cycle of an item as an ordered fold over its events.

A state is (exists, status, attempts, has_file).  Attempts are shared by download and upload,
so the order of events matters and plain aggregates do not give the state.  A run of events is
folded once per possible entry state into a transition table, an array of exits; tables of
consecutive runs compose, so a history can be cut anywhere, stored in segments and merged.

Events are cut twice: into buckets of time, the segments that are stored, and within them where the
ranges of (item, time) that tasks fold happen to end.  An item with any share of all events spreads
over ranges like any other.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketflow.settings import DEFAULTS, Limits

KINDS = ("discovered", "downloading", "downloaded", "uploading", "pushed", "skipped",
         "failed", "retry")

# Entry status of a run when it is not "failed": whatever it was, it is passed on.
_SAME = "="


def state(exists, status, attempts, has_file, relative=False) -> Column:
    def lit(v):
        return v if isinstance(v, Column) else F.lit(v)

    return F.struct(
        lit(exists).cast("boolean").alias("exists"), lit(status).cast("string").alias("status"),
        lit(attempts).cast("long").alias("attempts"),
        lit(has_file).cast("boolean").alias("has_file"),
        lit(relative).cast("boolean").alias("relative"),
    )


def absent() -> Column:
    return state(False, None, 0, False)


def step(s: Column, kind: Column, limits: Limits = DEFAULTS) -> Column:
    """The state after one event.

    Only ``discovered`` creates an item, and only once; events of unknown items change nothing.
    A failure counts an attempt and returns to the stage its file implies, or parks the item at
    the limit.  ``retry`` releases parked items and alone resets the attempts.
    """
    tries = s["attempts"] + 1
    stage = F.when(s["has_file"], "downloaded").otherwise("discovered")
    parked = s["status"] == "failed"

    def moved(status, has_file=None, attempts=None, relative=None) -> Column:
        return state(
            True, status, s["attempts"] if attempts is None else attempts,
            s["has_file"] if has_file is None else has_file,
            s["relative"] if relative is None else relative)

    known = (
        F.when(kind.isin("downloading", "uploading"), moved(kind))
        .when(kind == "downloaded", moved(kind, has_file=True))
        .when(kind.isin("pushed", "skipped"), moved(kind, has_file=False))
        .when(kind == "failed", moved(
            F.when(tries >= limits.max_attempts, "failed").otherwise(stage), attempts=tries))
        .when((kind == "retry") & parked, moved(stage, attempts=0, relative=False))
        .otherwise(s)
    )
    return F.when(s["exists"], known).when(
        kind == "discovered", state(True, "discovered", 0, False)).otherwise(s)


def _entries(limits: Limits) -> list[Column]:
    """Every entry state a run can meet, in the order ``_entry_index`` counts them."""
    known = [
        state(True, status, attempts, has_file, relative=True)
        for attempts, has_file, status in product(
            range(limits.max_attempts + 1), (False, True), (_SAME, "failed"))
    ]
    return [absent(), *known]


def _entry_index(s: Column, limits: Limits) -> Column:
    attempts = F.least(s["attempts"], F.lit(limits.max_attempts))
    known = attempts * 4 + s["has_file"].cast("int") * 2 + (s["status"] == "failed").cast("int")
    return F.when(s["exists"], known + 1).otherwise(0).cast("int")


def _apply(s: Column, table: Column, limits: Limits) -> Column:
    """The exit of a run for entry state ``s``.

    Attempts above the limit share one entry; what the run added counts from there.
    """
    out = F.get(table, _entry_index(s, limits))
    above = F.when(out["relative"],
                   F.greatest(s["attempts"] - limits.max_attempts, F.lit(0))).otherwise(0)
    return state(
        out["exists"],
        F.when(out["status"] == _SAME, s["status"]).otherwise(out["status"]),
        out["attempts"] + above, out["has_file"], s["relative"] & out["relative"])


def with_bucket(events: DataFrame, bucket_s: int | None) -> DataFrame:
    """(item_id, bucket, ts, event_id, kind); without a length all time is one bucket."""
    ts = F.col("ts")
    if isinstance(events.schema["ts"].dataType, (T.TimestampType, T.TimestampNTZType)):
        ts = F.unix_seconds(ts.cast("timestamp"))
    bucket = F.floor(ts / bucket_s) if bucket_s else F.lit(0)
    return events.select("item_id", bucket.cast("long").alias("bucket"), "ts", "event_id", "kind")


def pieces(events: DataFrame, limits: Limits = DEFAULTS) -> DataFrame:
    """Transition tables of bucketed events: (item_id, bucket, piece, n_events, last, exits).

    A piece is what one range holds of an item's bucket, so its rows fit where a shuffle partition
    does; pieces are numbered in the order of time.
    """
    keys = ["item_id", "bucket", "ts", "event_id"]
    cut = events.repartitionByRange(*keys).withColumn("piece", F.spark_partition_id())
    queues = cut.groupBy("item_id", "bucket", "piece").agg(
        F.sort_array(F.collect_list(F.struct("ts", "event_id", "kind"))).alias("q"),
        F.count("*").alias("n_events"), F.max(F.struct("ts", "event_id")).alias("last"))
    exits = F.aggregate("q", F.array(*_entries(limits)), lambda table, e: F.transform(
        table, lambda s: step(s, e["kind"], limits)))
    return queues.select("item_id", "bucket", "piece", "n_events", "last", exits.alias("exits"))


def after(first: Column, then: Column, limits: Limits = DEFAULTS) -> Column:
    """The table of one run of events followed by another."""
    return F.transform(first, lambda s: _apply(s, then, limits))


def segments(tables: DataFrame, limits: Limits = DEFAULTS) -> DataFrame:
    """One table per item and bucket from its pieces: (item_id, bucket, n_events, last, exits)."""
    packed = tables.groupBy("item_id", "bucket").agg(
        F.sort_array(F.collect_list(F.struct("piece", "exits"))).alias("t"),
        F.sum("n_events").alias("n_events"), F.max("last").alias("last"))
    return packed.select("item_id", "bucket", "n_events", "last", F.aggregate(
        "t", F.array(*_entries(limits)), lambda acc, x: after(acc, x["exits"], limits)).alias("exits"))


def states(tables: DataFrame, limits: Limits = DEFAULTS) -> DataFrame:
    """The state of every item from its tables, pieces or segments, in the order of time.

    Items never discovered have no state and are left out.
    """
    order = [c for c in ("bucket", "piece") if c in tables.columns]
    packed = tables.groupBy("item_id").agg(
        F.sort_array(F.collect_list(F.struct(*order, "exits"))).alias("t"),
        F.sum("n_events").alias("n_events"), F.max("last").alias("last"))
    final = F.aggregate("t", absent(), lambda s, x: _apply(s, x["exits"], limits))
    return packed.withColumn("s", final).where("s.exists").select(
        "item_id", F.col("s.status").alias("status"), F.col("s.attempts").alias("attempts"),
        F.col("s.has_file").alias("has_file"), "n_events",
        F.col("last.ts").alias("last_ts"), F.col("last.event_id").alias("last_event_id"))


def merged(
    stored: DataFrame, log: DataFrame, batch: DataFrame, limits: Limits = DEFAULTS
) -> DataFrame:
    """The segments that ``batch`` touches, as they are after it.

    ``stored`` holds segments, ``batch`` new bucketed events, and ``log`` all bucketed events of the
    buckets concerned, the batch included.  Events after the last one of their segment extend its
    table.  Where one is late or repeated, that segment is folded again from the log, and no other.
    An event is one (item_id, event_id).
    """
    keys, once = ["item_id", "bucket"], ["item_id", "event_id"]
    first = batch.groupBy(*keys).agg(F.min(F.struct("ts", "event_id")).alias("first"))
    known = stored.select(*keys, F.col("n_events").alias("n0"), F.col("last").alias("last0"),
                          F.col("exits").alias("exits0"))
    touched = first.join(known, keys, "left").withColumn(
        "late", F.coalesce(F.col("first") <= F.col("last0"), F.lit(False)))
    late = touched.where("late").select(*keys)
    fresh = batch.join(late, keys, "left_anti").dropDuplicates(once)
    again = log.join(late, keys, "left_semi").dropDuplicates(once)
    extended = segments(pieces(fresh, limits), limits).join(
        touched.where(~F.col("late")), keys).select(
        *keys, (F.col("n_events") + F.coalesce("n0", F.lit(0))).alias("n_events"), "last",
        F.when(F.col("exits0").isNull(), F.col("exits")).otherwise(
            after(F.col("exits0"), F.col("exits"), limits)).alias("exits"))
    return extended.unionByName(segments(pieces(again, limits), limits))


def lifecycle(
    events: DataFrame, limits: Limits = DEFAULTS, bucket_s: int | None = None
) -> DataFrame:
    """State per item from (item_id, ts, event_id, kind), ordered by (ts, event_id)."""
    return states(pieces(with_bucket(events, bucket_s), limits), limits)
