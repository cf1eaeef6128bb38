"""Every registered query: a job of the library over inputs derived from the driver tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.adapters import adapter
from docketflow.functions import dates, display, judges, text
from docketflow.functions.case_types import with_case_type
from docketflow.operators import (
    admission, batches, catalogue, counters, delivery, insertion, lifecycle, partitions, reports, status,
    transitions,
)
from docketflow.operators.keyed import overlaid, patch
from docketflow.plans import cap, discovery, walk
from docketflow.schemas import HC_METADATA
from docketflow.session import settle, shared_dir
from docketflow.sources import metadata
from docketflow.sources.courts import court_dimension
from docketflow.sources.keyvalue import decoded, upsert_settings
from docketflow.sources.sinks import new_events
from docketflow.sources.store import conform
from docketflow.streaming.rates import event_rates as rates_of

QUERIES = {}

# Clock of all queries, in epoch seconds; nothing reads the real time.
NOW_S = 1_700_010_000
HEADROOM = 200_000_000

# A claim of very many rows at once.
MANY = 1_000_000


def now() -> Column:
    return F.timestamp_seconds(F.lit(NOW_S))


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


class Inputs:
    """Adapters by name, shaped like the library's tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf = spark, sf_dir

    def fx(self, name: str) -> DataFrame:
        return adapter(self.spark, self.sf, f"fx_{name}")

    def log(self) -> DataFrame:
        return self.fx("log").withColumnRenamed("stamp", "at")

    def objects(self) -> DataFrame:
        return self.fx("objects").drop("doc_id")

    def courts(self) -> DataFrame:
        return court_dimension(self.spark)

    def items(self) -> DataFrame:
        raw = self.fx("items")
        return conform(raw.withColumn("discovered_at", F.timestamp_seconds("seen_s")), "items")

    def partitions(self) -> DataFrame:
        raw = self.fx("partitions")
        return conform(raw.withColumns({
            "scanned_at": F.timestamp_seconds("scanned_s"),
            "next_attempt_at": F.timestamp_seconds("next_s")}), "scanned_partitions")

    def targets(self) -> DataFrame:
        return self.objects().select(*catalogue.TARGET).distinct()

    def batches(self) -> DataFrame:
        """Batches as the ledger's rows imply them: one per id, open when not at rest."""
        done = batches.batch_completion(self.items())
        return done.select(
            F.col("batch_id").alias("id"),
            F.timestamp_seconds(F.lit(1_700_000_000) + F.col("batch_id")).alias("opened_at"),
            F.lit(None).cast("timestamp").alias("closed_at"),
            F.lit(None).cast("timestamp").alias("pushed_at"),
            F.when(F.col("done"), "full").otherwise("open").alias("status"))


def seconds(df: DataFrame, *columns: str) -> DataFrame:
    """Timestamps as epoch seconds, which read the same in every engine and zone."""
    return df.withColumns({c: F.unix_seconds(c) for c in columns})


# -- discovery ---------------------------------------------------------------------------


@query
def discover_hc(spark, sf):
    i = Inputs(spark, sf)
    return discovery.discover_hc(i.objects(), i.fx("hc_meta"), i.courts())


@query
def discover_sc(spark, sf):
    i = Inputs(spark, sf)
    return discovery.discover_sc(i.objects(), i.fx("sc_meta"))


@query
def discovered_profile(spark, sf):
    i = Inputs(spark, sf)
    rows = discovery.discover(i.objects(), i.fx("hc_meta"), i.fx("sc_meta"), i.courts())
    return rows.groupBy("source", "court", "bench_type", "case_type").agg(
        F.count("*").alias("n"), F.sum("bytes").alias("bytes"))


def _ledger_of(objects: DataFrame) -> DataFrame:
    """A ledger that already knows two thirds of the objects, under old keys for the rest."""
    known = F.col("doc_id") % 3 != 0
    key = F.when(known, F.col("s3_key")).otherwise(F.concat(F.lit("old/"), F.col("s3_key")))
    return objects.select(key.alias("s3_key"), F.when(
        F.col("doc_id") % 5 != 0, F.concat(F.lit("O/"), F.col("doc_id").cast("string"))
    ).otherwise(F.concat(F.lit("K/"), F.col("doc_id").cast("string"))).alias("citation"),
        F.col("doc_id").alias("id"))


def _batch_of(objects: DataFrame) -> DataFrame:
    """The listing twice, with citations that some objects share or lack."""
    doc = F.col("doc_id")
    citation = (
        F.when(doc % 19 == 0, F.concat(F.lit("dup/"), (doc % 7).cast("string")))
        .when(doc % 23 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("K/"), doc.cast("string")))
    )
    once = objects.select("s3_key", citation.alias("citation"), "source", "bucket", "bytes",
                          (doc * 2).alias("ord"))
    return once.unionByName(once.withColumn("ord", F.col("ord") + 1))


@query
def insert_or_ignore(spark, sf):
    objects = Inputs(spark, sf).fx("objects")
    return insertion.new_items(_ledger_of(objects), _batch_of(objects), "ord").select(
        "s3_key", "citation", "ord")


@query
def rejected_items(spark, sf):
    objects = Inputs(spark, sf).fx("objects")
    ledger, batch = _ledger_of(objects), _batch_of(objects)
    inserted = insertion.new_items(ledger, batch, "ord")
    return insertion.rejected_items(ledger, batch, inserted, "ord")


@query
def arrival_ids(spark, sf):
    objects = Inputs(spark, sf).fx("objects")
    ledger, batch = _ledger_of(objects), _batch_of(objects)
    rows = insertion.as_ledger_rows(
        ledger, insertion.new_items(ledger, batch, "ord"), ["s3_key"], now())
    return seconds(rows.select("id", "s3_key", "status", "attempts", "language",
                               "discovered_at"), "discovered_at")


@query
def arrival_ids_in_plan(spark, sf):
    """New rows numbered by the place of their partition in a plan that lacks a third of them."""
    i = Inputs(spark, sf)
    objects = i.fx("objects")
    ledger, batch = _ledger_of(objects), _batch_of(objects)
    plan = catalogue.set_plan(i.targets(), i.partitions())
    keys = insertion.accepted_keys(ledger, batch, "ord").join(
        objects.select("s3_key", catalogue.partition_prefix().alias("prefix")), "s3_key")
    return insertion.numbered_in_plan(ledger, keys, plan, ["ord"]).select("id", "s3_key", "prefix")


@query
def metadata_triage(spark, sf):
    """Partitions of metadata files, written in two kinds of types and some of them as other text."""
    meta = Inputs(spark, sf).fx("hc_meta").withColumn("court_name", F.col("court"))
    root = f"{shared_dir(spark).rstrip('/')}/metadata-{uuid.uuid4().hex}"
    place = f"{root}/{metadata.METADATA_ROOT}"
    parts = ["year", "court_code"]
    dirs = {"year": "year", "court_code": "court"}
    rows = meta.select(
        *[F.col(c).alias(f"{dirs[c]}_dir") for c in parts], *[
            c for c in HC_METADATA.fieldNames() if c != "court"], F.col("court_name").alias("court"))
    odd = F.col("year_dir") % 2 == 1
    bad = F.col("year_dir") == 2014
    day = F.to_date(F.when(F.col("decision_date").rlike("^20[0-9]{2}-"), F.substring("decision_date", 1, 10)))
    kinds = [rows.where(odd & ~bad), rows.where(~odd & ~bad).withColumn("decision_date", day)]
    for kind, df in enumerate(kinds):
        df.repartition("year_dir", "court_dir").write.partitionBy("year_dir", "court_dir").parquet(
            f"{place}/kind={kind}")
    rows.where(bad).repartition("year_dir", "court_dir").select(
        "year_dir", "court_dir", F.coalesce("title", F.lit("no title")).alias("value")
    ).write.partitionBy("year_dir", "court_dir").text(f"{place}/other")
    files = metadata.files_below(spark, place, "part-*")
    found, errors = metadata.triaged(files, HC_METADATA)

    def where(path: str) -> list[Column]:
        return [F.regexp_extract(path, f"/{d}_dir=([^/]+)/", 1).alias(c) for c, d in dirs.items()]

    sound = found.select(*where("file_path"), "title", "decision_date").groupBy(*parts).agg(
        F.count("*").alias("n_rows"), F.count("title").alias("n_titles"),
        F.min("decision_date").alias("first_date"), F.lit(False).alias("damaged"))
    broken = errors.select(*where("path")).distinct().select(
        *parts, F.lit(0).cast("long"), F.lit(0).cast("long"), F.lit(None).cast("string"), F.lit(True))
    return sound.unionAll(broken)


@query
def scan_summary(spark, sf):
    i = Inputs(spark, sf)
    objects = i.objects()
    usable = discovery.usable(objects).withColumn("prefix", catalogue.partition_prefix())
    ledger = _ledger_of(i.fx("objects"))
    queued = usable.join(ledger.select("s3_key"), "s3_key", "left_anti")
    errors = i.targets().where(F.col("year").isin(2014, 2021)).withColumn(
        "error", F.lit("truncated"))
    return discovery.scan_summary(i.targets(), objects, usable, queued, errors)


@query
def scan_events(spark, sf):
    summary = scan_summary(spark, sf)
    log = Inputs(spark, sf).log()
    return new_events(log, discovery.scan_events(summary), now(), ["prefix", "line"]).select(
        "id", "level", "message", F.unix_seconds("at").alias("at"), "item_id")


# -- functions ---------------------------------------------------------------------------


def _both(spark, sf, *columns: str) -> DataFrame:
    """Columns of the metadata of both collections."""
    i = Inputs(spark, sf)
    hc, sc = (i.fx(f"{name}_meta").select(F.lit(name).alias("collection"), "ord", *columns)
              for name in ("hc", "sc"))
    return hc.unionByName(sc)


@query
def case_types(spark, sf):
    rows = _both(spark, sf, "title", "description")
    return with_case_type(rows, "case_type", "title", "description").select(
        "collection", "ord", "case_type")


@query
def bench_types(spark, sf):
    return _both(spark, sf, "judge").select(
        "collection", "ord", judges.bench_type("judge").alias("bench_type"),
        judges.judge_name("judge").alias("judge_name"))


@query
def decision_dates(spark, sf):
    return _both(spark, sf, "decision_date").select(
        "collection", "ord", dates.decision_date("decision_date").alias("decision_date"),
        dates.decision_year("decision_date").alias("decision_year"))


@query
def clip_and_parties(spark, sf):
    meta = Inputs(spark, sf).fx("hc_meta")
    return meta.select(
        "ord", text.clip("title", 500).alias("title"),
        text.clip(text.parties("title"), 2000).alias("parties"),
        text.basename("pdf_link").alias("file"), text.stem(text.basename("pdf_link")).alias("stem"),
        text.first_nonblank(text.clip("cnr", 64), text.clip("court", 255)).alias("label"))


@query
def human_sizes(spark, sf):
    scaled = F.col("bytes") * (F.col("id") % 997)
    sizes = Inputs(spark, sf).items().select("id", scaled.alias("n"))
    return sizes.select("id", display.human_size("n").alias("long_form"),
                        display.short_size("n").alias("short_form"))


@query
def event_clock(spark, sf):
    return Inputs(spark, sf).log().select(
        "id", dates.clock("at").alias("clock"), text.error_text("message").alias("message"))


# -- catalogue ---------------------------------------------------------------------------


@query
def catalogue_years(spark, sf):
    objects = Inputs(spark, sf).objects()
    return catalogue.years(objects, "hc").withColumn("source", F.lit("hc")).unionByName(
        catalogue.years(objects, "sc").withColumn("source", F.lit("sc")))


@query
def catalogue_courts(spark, sf):
    i = Inputs(spark, sf)
    return catalogue.courts(i.objects(), i.courts())


@query
def catalogue_benches(spark, sf):
    return catalogue.benches(Inputs(spark, sf).objects())


@query
def place_objects(spark, sf):
    from docketflow.sources.listing import place_objects as place
    keys = Inputs(spark, sf).fx("objects").select("bucket", "s3_key", "bytes")
    return place(keys)


@query
def expand_targets(spark, sf):
    i = Inputs(spark, sf)
    objects = i.objects()
    hc = catalogue.expand_hc(objects, 2012, 2020, ["9_13", "7_26", "99_9", "27_1"])
    span = objects.agg(F.min("year").alias("lo"), F.max("year").alias("hi"))
    return hc.unionByName(catalogue.sc_targets(span, include_regional=True))


@query
def prefix_roundtrip(spark, sf):
    parts = Inputs(spark, sf).fx("partitions")
    t = F.col("t")
    return parts.withColumn("t", catalogue.target_of("prefix")).select(
        "prefix", t["source"].alias("source"), t["year"].alias("year"), t["court"].alias("court"),
        t["bench"].alias("bench"),
        F.when(t.isNotNull(), catalogue.partition_prefix(
            t["source"], t["year"], t["court"], t["bench"])).alias("again"))


@query
def plan_replace(spark, sf):
    i = Inputs(spark, sf)
    return catalogue.set_plan(i.targets(), i.partitions())


@query
def plan_append(spark, sf):
    i = Inputs(spark, sf)
    targets = i.targets()
    first = catalogue.set_plan(targets.where(F.col("source") == "hc"), i.partitions())
    return catalogue.set_plan(targets, i.partitions(), first)


# Where the cursor of the walked plan stands, and how many targets one page takes.
PAGE_START, PAGE_SIZE = 5, 250


@query
def plan_walk(spark, sf):
    """All partitions after a page of the plan was walked, in which some listings failed."""
    i = Inputs(spark, sf)
    known, objects = i.partitions(), i.objects()
    plan = catalogue.set_plan(i.targets(), known)
    targets = walk.page(plan, PAGE_START, PAGE_SIZE)
    failures = targets.where(F.col("year").isin(2014, 2021)).select(
        "prefix", "source", F.concat(F.lit("cannot list "), "prefix").alias("error"))
    listed = discovery.in_targets(objects, walk.without(targets, failures))
    usable = discovery.usable(listed)
    queued = usable.join(_ledger_of(i.fx("objects")).select("s3_key"), "s3_key", "left_anti")
    summary = discovery.scan_summary(walk.without(targets, failures), listed, usable, queued)
    after = walk.finished(walk.begun(known, targets, now()), summary, failures, now())
    events = walk.failure_events(after, failures).select("prefix", "level", "message")
    places = plan.select("prefix", "pos", (F.col("pos") < PAGE_START + PAGE_SIZE).alias("behind"))
    return _partition_columns(
        after.join(places, "prefix", "left").join(events, "prefix", "left"))


@query
def plan_progress(spark, sf):
    i = Inputs(spark, sf)
    plan = catalogue.outstanding(i.targets(), i.partitions())
    return catalogue.plan_progress(plan, F.lit(5))


# -- ledger ------------------------------------------------------------------------------


@query
def admit_under_budget(spark, sf):
    items = Inputs(spark, sf).items()
    cap = reports.reserved_bytes(items).scalar() + HEADROOM
    return admission.claim_for_download(items, cap)


@query
def admit_many(spark, sf):
    items = Inputs(spark, sf).items()
    cap = reports.reserved_bytes(items).scalar() + HEADROOM * 200
    return admission.claim_for_download(items, cap, limit=MANY)


@query
def claim_for_upload(spark, sf):
    items = Inputs(spark, sf).items()
    ids = admission.claimed_as(admission.claim_for_upload(items), "uploading")
    return patch(items, ids, "id").select("id", "status")


@query
def ledger_merge(spark, sf):
    """The ledger with two logs of changed rows laid over it, the later one last."""
    items = Inputs(spark, sf).items()
    third = items.where(F.col("id") % 3 == 0).withColumns({
        "status": F.lit("uploading"), "attempts": F.col("attempts") + 1, "step": F.lit(1)})
    sixth = items.where(F.col("id") % 6 == 0).withColumns({
        "status": F.lit("pushed"), "local_path": F.lit(None).cast("string"), "step": F.lit(2)})
    merged = overlaid(items, third.unionByName(sixth), "id", "step")
    return merged.select("id", "source", "s3_key", "bytes", "status", "attempts", "local_path")


@query
def mark_downloaded(spark, sf):
    i = Inputs(spark, sf)
    items = i.items()
    moving = items.where(F.col("status") == "downloading")
    staged = moving.select(
        transitions.staging_path(F.lit(77)).alias("path"),
        (F.col("bytes") + F.col("id") % 3).alias("bytes"), "id",
    ).withColumn("path", F.when(F.col("id") % 5 == 0, F.lit("lost")).otherwise(F.col("path")))
    manifest = transitions.staged_manifest(moving, staged, F.lit(77))
    out = transitions.mark_downloaded(items, manifest, now())
    return seconds(out.select("id", "status", "local_path", "bytes", "batch_id", "attempts",
                              "error", "downloaded_at"), "downloaded_at")


@query
def staging_paths(spark, sf):
    return Inputs(spark, sf).items().select("id", transitions.staging_path().alias("path"))


def _outcomes(i: Inputs) -> DataFrame:
    return delivery.classify(i.fx("responses"))


_AFTER = ["id", "status", "attempts", "error", "document_id", "local_path", "pushed_at"]


@query
def delivery_outcomes(spark, sf):
    i = Inputs(spark, sf)
    out = transitions.apply_outcomes(i.items(), _outcomes(i), now())
    return seconds(out.select(*_AFTER), "pushed_at")


@query
def delivery_events(spark, sf):
    """What deliveries and the batches they complete add to the log."""
    i = Inputs(spark, sf)
    outcomes = _outcomes(i)
    after = transitions.apply_outcomes(i.items(), outcomes, now())
    closing = batches.completed_batches(i.items())
    return delivery.outcome_events(after, outcomes).unionByName(batches.completion_events(closing))


@query
def replayed_responses(spark, sf):
    """Responses twice over, and late ones to an earlier claim that came last of all."""
    i = Inputs(spark, sf)
    items = i.items().withColumn("claims", F.col("id") % 3 + 1)
    answers = i.fx("responses").select(
        F.col("item_id") + 1, (F.col("item_id") + 1) % 3 + 1, "http_status", "body",
        F.lit(1).cast("long")).toDF("item_id", "claim", "http_status", "body", "seq")
    late = answers.select(
        "item_id", F.col("claim") - 1, F.lit(500), F.lit("late"), F.lit(9).cast("long")).toDF(*answers.columns)
    responses = answers.unionByName(answers).unionByName(late)
    uploading = items.where(F.col("status") == "uploading")
    outcomes = delivery.classify(delivery.answered(uploading, responses))
    return seconds(transitions.apply_outcomes(items, outcomes, now()).select(*_AFTER), "pushed_at")


@query
def download_failures(spark, sf):
    i = Inputs(spark, sf)
    failures = i.items().where(F.col("status") == "downloading").select(
        F.col("id").alias("item_id"), F.lit("retry").alias("outcome"),
        F.lit(None).cast("long").alias("document_id"), F.lit("timed out").alias("message"),
        F.lit("discovered").alias("retry_state"))
    out = transitions.apply_outcomes(i.items(), failures, now())
    return seconds(out.select(*_AFTER), "pushed_at")


@query
def retry_failed(spark, sf):
    return transitions.retry_failed(Inputs(spark, sf).items()).select(
        "id", "status", "attempts", "error", "local_path")


@query
def recover_inflight(spark, sf):
    i = Inputs(spark, sf)
    return transitions.reset_inflight(i.items(), i.fx("staged")).select(
        "id", "status", "local_path", "attempts")


@query
def requeue_vanished(spark, sf):
    i = Inputs(spark, sf)
    return transitions.requeue_vanished(i.items(), i.fx("staged")).select(
        "id", "status", "local_path", "attempts")


@query
def orphans(spark, sf):
    i = Inputs(spark, sf)
    return transitions.orphans(i.items(), i.fx("staged"))


@query
def open_batch(spark, sf):
    return batches.open_batch(Inputs(spark, sf).batches())


@query
def batch_completion(spark, sf):
    return batches.batch_completion(Inputs(spark, sf).items())


@query
def batch_status(spark, sf):
    i = Inputs(spark, sf)
    full = i.batches().where(F.col("status") == "open").select(
        "id", F.lit("full").alias("status"))
    changes = batches.completed_batches(i.items()).unionByName(full)
    return seconds(batches.set_batch_status(i.batches(), changes, now()),
                   "opened_at", "closed_at", "pushed_at")


@query
def lifecycle_fold(spark, sf):
    states = lifecycle.lifecycle(Inputs(spark, sf).fx("item_events"))
    return states.withColumn("last_ts", F.date_format("last_ts", "yyyy-MM-dd HH:mm:ss"))


@query
def lifecycle_hot_items(spark, sf):
    """The same states, with the history of every item cut at each hour."""
    states = lifecycle.lifecycle(Inputs(spark, sf).fx("item_events"), bucket_s=3_600)
    return states.withColumn("last_ts", F.date_format("last_ts", "yyyy-MM-dd HH:mm:ss"))


@query
def lifecycle_late_events(spark, sf):
    """The same states from segments of days, into which every seventh event comes late."""
    events = lifecycle.with_bucket(Inputs(spark, sf).fx("item_events"), 86_400)
    late = F.col("event_id") % 7 == 0
    stored = settle(lifecycle.segments(lifecycle.pieces(events.where(~late))))
    # The late ones come with some that were there already.
    batch = events.where(late | (F.col("event_id") % 11 == 0))
    new = settle(lifecycle.merged(stored, events, batch))
    rest = stored.join(new, ["item_id", "bucket"], "left_anti")
    states = lifecycle.states(rest.unionByName(new))
    return states.withColumn("last_ts", F.date_format("last_ts", "yyyy-MM-dd HH:mm:ss"))


@query
def event_rates(spark, sf):
    rates = rates_of(Inputs(spark, sf).fx("item_events"), "6 hours")
    return rates.select(
        F.unix_seconds("window_start").alias("window_s"), "kind", "n_events",
        F.round(F.col("per_minute") * 360).cast("long").alias("per_window"))


@query
def schema_migrate(spark, sf):
    older = Inputs(spark, sf).items().drop(
        "source_citation", "decision_date", "court_type", "bench_type", "language", "attempts")
    return seconds(conform(older, "items").select(
        "id", "source_citation", "decision_date", "court_type", "bench_type", "language",
        "attempts", "status", "bytes", "discovered_at"), "discovered_at")


# -- reports -----------------------------------------------------------------------------


@query
def disk_usage(spark, sf):
    i = Inputs(spark, sf)
    return reports.disk_usage(i.items(), i.fx("staged"))


@query
def held_with_file(spark, sf):
    return reports.held_with_file(Inputs(spark, sf).items())


@query
def ledger_stats(spark, sf):
    return reports.ledger_stats(Inputs(spark, sf).items())


def _changes(i: Inputs) -> list[tuple[DataFrame, DataFrame]]:
    """A chain of ledger changes, each as the rows it touches before and after it."""
    items = i.items()
    queued = items.where((F.col("status") == "discovered") & (F.col("id") % 2 == 0))
    ids = queued.select("id")
    claimed = patch(queued, admission.claimed_as(ids, "downloading"), "id")
    arrived = claimed.where(F.col("id") % 3 == 0)
    manifest = arrived.select(
        "id", F.lit("staging/x.pdf").alias("local_path"), (F.col("bytes") + 7).alias("bytes"),
        F.lit(77).cast("long").alias("batch_id"))
    staged = transitions.mark_downloaded(arrived, manifest, now())
    failed = items.where(F.col("status") == "failed")
    return [(queued, claimed), (arrived, staged), (failed, transitions.retry_failed(failed))]


def _counted(i: Inputs) -> DataFrame:
    """The ledger's counts after the chain: those before it and what each change adds."""
    counts = counters.cells(i.items())
    for before, after in _changes(i):
        counts = counts.unionByName(counters.change(before, after))
    return counts


@query
def stats_deltas(spark, sf):
    return counters.stats(counters.summed(_counted(Inputs(spark, sf))))


@query
def status_deltas(spark, sf):
    return counters.figures(_counted(Inputs(spark, sf)))


@query
def source_stats(spark, sf):
    return reports.source_stats(Inputs(spark, sf).items())


@query
def ledger_totals(spark, sf):
    return reports.totals(Inputs(spark, sf).items())


@query
def queue_head(spark, sf):
    return reports.queue_head(Inputs(spark, sf).items())


@query
def item_page(spark, sf):
    return reports.list_items(Inputs(spark, sf).items(), "failed", 50, 20)


@query
def item_table(spark, sf):
    return reports.item_table(Inputs(spark, sf).items())


@query
def item_lines(spark, sf):
    return reports.item_lines(Inputs(spark, sf).items(), "skipped")


@query
def recent_events(spark, sf):
    return reports.recent_events(Inputs(spark, sf).log(), 80).withColumn(
        "at", dates.clock("at"))


@query
def event_retention(spark, sf):
    return reports.retained_events(Inputs(spark, sf).log()).select(
        "id", "level", "message", "item_id")


@query
def kv_latest(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    value = (
        F.when(F.col("event_id") % 4 == 0, F.col("event_type"))
        .when(F.col("event_id") % 4 == 1, F.concat(F.lit('"'), "event_type", F.lit('"')))
        .when(F.col("event_id") % 4 == 2, F.get_json_object("props", "$.k"))
        .otherwise(F.lit("null"))
    )
    writes = events.select(F.col("user_id").cast("string").alias("key"), value.alias("value"),
                           F.col("event_id").alias("seq"))
    base = events.select(F.concat(F.lit("old"), F.col("user_id").cast("string")).alias("key"),
                         F.lit("true").alias("value")).distinct()
    merged = upsert_settings(base, writes)
    return merged.select("key", "value", decoded("value").alias("decoded"))


# -- partitions --------------------------------------------------------------------------


def _partition_columns(df: DataFrame) -> DataFrame:
    return seconds(df, "scanned_at", "next_attempt_at")


@query
def partition_scanned(spark, sf):
    i = Inputs(spark, sf)
    results = i.objects().groupBy(
        catalogue.partition_prefix().alias("prefix"), "source").agg(
        F.count("*").alias("found"),
        F.count_if(F.col("filename").endswith(".pdf")).alias("queued"))
    return _partition_columns(partitions.mark_scanned(i.partitions(), results, now()))


@query
def partition_counts_merged(spark, sf):
    """Totals of partitions listed in four parts, one of which is counted twice."""
    i = Inputs(spark, sf)
    objects = i.fx("objects").withColumns(
        {"prefix": catalogue.partition_prefix(), "fresh": F.lit(True)})
    ledger = _ledger_of(i.fx("objects"))
    totals = conform(spark.range(0), "partition_totals")
    for part in (0, 1, 2, 2, 3):
        counted = counters.by_batch(objects.where(F.col("doc_id") % 4 == part), ledger, part)
        new = settle(counters.merged_counts(totals, counted))
        totals = totals.join(new, "prefix", "left_anti").unionByName(new)
    return totals


@query
def partition_failures(spark, sf):
    i = Inputs(spark, sf)
    failures = i.targets().select(
        catalogue.partition_prefix().alias("prefix"), "source",
        F.lit("listing timed out").alias("error"))
    return _partition_columns(partitions.mark_failed(i.partitions(), failures, now()))


@query
def partition_retry(spark, sf):
    return _partition_columns(partitions.retry_failed(Inputs(spark, sf).partitions()))


@query
def partition_retry_queue(spark, sf):
    waiting = partitions.retry_targets(partitions.due(Inputs(spark, sf).partitions(), now()))
    t = F.col("target")
    return waiting.select("prefix", "source", "attempts", t["year"].alias("year"),
                          t["court"].alias("court"), t["bench"].alias("bench"),
                          t.isNull().alias("malformed"))


@query
def partition_due_page(spark, sf):
    return partitions.due(Inputs(spark, sf).partitions(), now(), 25).select("prefix", "attempts")


@query
def partition_backlog(spark, sf):
    return partitions.backlog(Inputs(spark, sf).partitions())


@query
def newest_partitions(spark, sf):
    return seconds(partitions.newest(Inputs(spark, sf).partitions()), "scanned_at")


@query
def backoff_delays(spark, sf):
    parts = Inputs(spark, sf).partitions()
    return parts.select("prefix", dates.backoff_seconds(F.col("attempts") + 1).alias("delay_s"))


# -- delivery ----------------------------------------------------------------------------


@query
def payloads(spark, sf):
    return delivery.payload_columns(Inputs(spark, sf).items())


@query
def payload_json(spark, sf):
    return delivery.payloads(Inputs(spark, sf).items())


@query
def classify_responses(spark, sf):
    return _outcomes(Inputs(spark, sf))


@query
def auth_halt(spark, sf):
    return delivery.auth_halt(_outcomes(Inputs(spark, sf)))


# -- status ------------------------------------------------------------------------------


def _snapshot(spark, sf, **flags) -> DataFrame:
    i = Inputs(spark, sf)
    plan = catalogue.outstanding(i.targets(), i.partitions())
    return status.snapshot(i.items(), i.fx("staged"), i.partitions(), plan, F.lit(5), now(),
                           **flags)


@query
def status_report(spark, sf):
    report = status.report(_snapshot(spark, sf))
    return report.select(
        "phase", "work_left", "disk.used_bytes", "disk.filesystem_bytes", "disk.cap_bytes",
        "disk.free_bytes", F.round(F.col("disk.pct") * 100).cast("long").alias("pct_hundredths"),
        F.col("plan.total").alias("plan_total"), F.col("plan.position").alias("plan_position"),
        F.col("plan.remaining").alias("plan_remaining"),
        F.col("partitions.pending").alias("parts_pending"),
        F.col("partitions.failed").alias("parts_failed"), "due", "stats.total_items",
        "stats.pushed_bytes", "stats.known_bytes", "stats.bytes_on_disk",
        "stats.smallest_queued", "stats.discovered", "stats.pushed")


@query
def status_phases(spark, sf):
    def at(name: str, **flags):
        return status.report(_snapshot(spark, sf, **flags)).select(
            F.lit(name).alias("setting"), "phase")

    roomy = 10**15
    return (
        at("paused", paused=True).unionByName(at("auto push"))
        .unionByName(at("manual, full", auto_push=False))
        .unionByName(at("manual, room", auto_push=False, cap_bytes=roomy))
    )


@query
def cap_cycle(spark, sf):
    """The notices of three passes and the batches after them.

    A pass under a cap that is full, one that finds it told already, and one that finds the rows
    ready to push gone while failed ones still hold the cap.
    """
    i = Inputs(spark, sf)
    items, known = i.items(), i.batches()
    plan = catalogue.outstanding(i.targets(), i.partitions())
    stuck = items.withColumn("status", F.when(
        F.col("status") == "downloaded", "failed").otherwise(F.col("status")))
    meta = conform(spark.range(0), "meta")

    def look(rows: DataFrame, meta: DataFrame) -> DataFrame:
        shot = status.snapshot(rows, i.fx("staged"), i.partitions(), plan, F.lit(5), now(),
                               auto_push=False)
        return settle(cap.notice(status.report(shot), cap.waiting_batch(known), meta))

    def told(meta: DataFrame, notices: DataFrame) -> DataFrame:
        return upsert_settings(meta, notices.select(
            "key", F.col("batch").cast("string").alias("value"), F.lit(1).alias("seq")))

    first = look(items, meta)
    after = settle(told(meta, first))
    again, blocked = look(items, after), look(stuck, after)
    notices = first.withColumn("turn", F.lit(1)).unionByName(again.withColumn("turn", F.lit(2))).unionByName(
        blocked.withColumn("turn", F.lit(3)))
    marked = batches.set_batch_status(known, cap.full_batches(first), now())
    return notices.join(
        seconds(marked.select(F.col("id").alias("batch"), "status", "closed_at"), "closed_at"), "batch")


@query
def status_lines(spark, sf):
    return status.status_lines(Inputs(spark, sf).items())


@query
def status_headline(spark, sf):
    return status.headline(_snapshot(spark, sf))
