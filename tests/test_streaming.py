"""Streaming forms against their batch forms, with replays, late and repeated input."""

import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F

from docketflow.operators import counters, lifecycle, reports, status
from docketflow.plans import cycles, feed
from docketflow.sources.store import TableStore
from docketflow.streaming import discovery, lifecycle as stream

NOW = 1_700_000_000
HC_META = ("year int, court_code string, bench string, ord long, title string, "
           "description string, judge string, pdf_link string, cnr string, decision_date string, "
           "disposal_nature string, court string")
SC_META = ("year int, ord long, path string, title string, petitioner string, respondent string, "
           "description string, judge string, author_judge string, citation string, "
           "case_id string, cnr string, decision_date string, disposal_nature string, "
           "court string, nc_display string")
BUCKET = "indian-high-court-judgments"


def now(offset=0):
    return F.timestamp_seconds(F.lit(NOW + offset))


def keys(spark, names, year=2024):
    rows = [(BUCKET, f"data/pdf/year={year}/court=9_13/bench=m/{n}", 5000) for n in names]
    return spark.createDataFrame(rows, "bucket string, s3_key string, bytes long")


@pytest.fixture
def store(spark, tmp_path):
    ledger = TableStore(spark, str(tmp_path / "ledger"))
    ledger.create()
    return ledger


def readers(spark):
    meta = spark.createDataFrame([(2024, "9_13", "m", 1, "Contempt", None, "A", "x/a.pdf", None,
                                   None, None, None)], HC_META)
    return (lambda years: meta.where(F.col("year").isin(years)),
            lambda years: spark.createDataFrame([], SC_META))


def run_discovery(spark, tmp_path, store):
    hc, sc = readers(spark)
    query = discovery.stream_discovery(
        spark, str(tmp_path / "inv"), str(tmp_path / "cp"), store, hc, sc, max_files=1)
    query.awaitTermination()
    assert query.exception() is None


def test_discovery_stream_equals_batch_and_is_idempotent(spark, tmp_path, store):
    inv = str(tmp_path / "inv")
    keys(spark, ["a.pdf", "b.pdf"]).coalesce(1).write.parquet(inv)
    keys(spark, ["b.pdf", "c.pdf", "x.html"]).coalesce(1).write.mode("append").parquet(inv)
    run_discovery(spark, tmp_path, store)
    rows = store.read("items").orderBy("id").collect()
    assert [r.id for r in rows] == [1, 2, 3]
    assert {r.s3_key.split("/")[-1]: r.case_type for r in rows} == {
        "a.pdf": "contempt_petition", "b.pdf": None, "c.pdf": None}
    keys(spark, ["a.pdf", "c.pdf"]).coalesce(1).write.mode("append").parquet(inv)
    run_discovery(spark, tmp_path, store)
    assert store.read("items").count() == 3
    part = store.read("scanned_partitions").first()
    assert (part.status, part.found, part.queued) == ("done", 4, 3)
    total = store.read("partition_totals").first()
    assert (total.found, total.queued) == (4, 3)
    ids = [r.id for r in store.read("events").orderBy("id").collect()]
    assert ids == [1, 2, 3]


def test_failures_and_retries_by_cycles(spark, tmp_path, store):
    from docketflow.sources.courts import court_dimension
    from docketflow.sources.listing import place_objects
    hc, sc = readers(spark)
    objects = place_objects(keys(spark, [f"{i}.pdf" for i in range(40)]))
    targets = objects.select("source", "year", "court", "bench").distinct()
    cycles.scan(store, targets, objects, hc([2024]), sc([]), court_dimension(spark), now())
    failures = spark.createDataFrame(
        [(1, "reset by peer"), (1, "later"), (2, "timeout"), (30, "not claimed")],
        "item_id long, message string")
    for tries in (1, 2, 3):
        cycles.claim_downloads(store, limit=8)
        # A claim of eight rows writes eight rows, whatever the size of the ledger.
        steps = store._steps("items", "changed", 1)
        written = spark.read.parquet(f"{store.root}/items/changed/version=1/step={steps[-1]}")
        assert written.count() == 8
        cycles.fail_downloads(store, failures, now(tries))
        rows = {r.id: r for r in store.read("items").collect()}
        assert len(rows) == 40
        assert (rows[1].attempts, rows[1].error) == (tries, "later")
        assert rows[1].status == ("failed" if tries == 3 else "discovered")
        assert (rows[30].status, rows[30].attempts) == ("discovered", 0)
        cycles.recover(store, spark.createDataFrame([], "path string, bytes long"))
    cycles.retry_failed_items(store)
    after = {r.id: (r.status, r.attempts) for r in store.read("items").collect()}
    assert after[1] == after[2] == ("discovered", 0) and len(after) == 40


def target_rows(spark, *benches):
    return spark.createDataFrame(
        [("hc", 2024, "9_13", b) for b in benches], "source string, year int, court string, bench string")


def test_walk_goes_on_past_an_unreadable_partition(spark, tmp_path, store):
    from docketflow.plans import walk
    from docketflow.sources import listing
    from docketflow.sources.courts import court_dimension
    hc, sc = readers(spark)
    root = tmp_path / "bucket"
    court = root / "data/pdf/year=2024/court=9_13"
    for bench in "abd":
        (court / f"bench={bench}").mkdir(parents=True)
        for name in ("1.pdf", "2.pdf"):
            (court / f"bench={bench}" / name).write_bytes(b"x" * 5000)
    (court / "bench=c").write_bytes(b"not a folder")  # cannot be listed

    def lister(targets):
        return listing.list_targets(targets, str(root), str(root))

    def go(job, at):
        return job(store, lister, hc([2024]), sc([]), court_dimension(spark), now(at))

    def step(at):
        return walk.walk(store, lister, hc([2024]), sc([]), court_dimension(spark), now(at), size=3)

    assert walk.install(store, target_rows(spark, *"abcde")) == 5
    assert walk.cursor(store) == 0
    seen = {r.prefix[-1]: (r.seen, r.queued) for r in step(0).collect()}
    assert seen == {"a": (2, 2), "b": (2, 2)} and walk.cursor(store) == 3
    parts = {r.prefix[-1]: r for r in store.read("scanned_partitions").collect()}
    assert {k: (r.status, r.attempts) for k, r in parts.items()} == {
        "a": ("done", 0), "b": ("done", 0), "c": ("pending", 1)}
    assert "bench=c" in parts["c"].error
    assert {r.level for r in store.read("events").collect()} == {"info", "warn"}
    # Planning again drops what is done and appends nothing that is there; the walk goes on.
    assert walk.install(store, target_rows(spark, *"abcde"), replace=False) == 0
    assert {r.prefix[-1]: r.seen for r in step(1).collect()} == {"d": 2, "e": 0}
    assert step(2) is None and walk.cursor(store) == 5
    # The plan is walked, the failed partition still owed its tries.
    assert go(walk.retry, 30) is None
    for tries, at in ((2, 61), (3, 1000), (4, 3000)):
        assert go(walk.retry, at).count() == 0
        left = store.read("scanned_partitions").where("prefix LIKE '%bench=c'").first()
        assert (left.attempts, left.status) == (tries, "failed" if tries == 4 else "pending")
    assert store.read("events").where("level = 'error'").count() == 1
    (court / "bench=c").unlink()
    (court / "bench=c").mkdir()
    (court / "bench=c" / "9.pdf").write_bytes(b"x" * 5000)
    cycles.retry_parked_partitions(store)
    assert go(walk.retry, 9000).first().queued == 1
    assert store.read("items").count() == 7


def test_ticks_walk_the_plan_then_read_what_is_due_alone(spark, tmp_path, store):
    from docketflow.plans import walk
    from docketflow.sources.listing import place_objects
    from docketflow.streaming.walk import stream_walk
    hc, sc = readers(spark)
    asked = []

    def lister(targets):
        benches = sorted(r.bench for r in targets.collect())
        asked.append(("list", benches))
        bad = [b for b in benches if b == "b" and len(asked) < 4]
        found = [(BUCKET, f"data/pdf/year=2024/court=9_13/bench={x}/1.pdf", 5000) for x in benches if x not in bad]
        failures = [(f"hc/year=2024/court=9_13/bench={b}", "hc", "timed out") for b in bad]
        return (place_objects(spark.createDataFrame(found, "bucket string, s3_key string, bytes long")),
                spark.createDataFrame(failures, "prefix string, source string, error string"))

    def metadata_of(targets):
        asked.append(("read", sorted(r.bench for r in targets.collect())))
        return hc([2024])

    walk.install(store, target_rows(spark, "a", "b", "c"))
    source = str(tmp_path / "ticks")
    for tick, at in enumerate((0, 1, 2, 70)):
        spark.createDataFrame([(dt.datetime.fromtimestamp(NOW + at, dt.UTC),)], "timestamp timestamp").coalesce(
            1).write.mode("append").parquet(source)
        ticks = spark.readStream.schema("timestamp timestamp").parquet(source)
        query = stream_walk(ticks, str(tmp_path / "cp"), store, lister, metadata_of, sc([]), size=2,
                            trigger={"availableNow": True})
        query.awaitTermination()
        assert query.exception() is None
        if tick == 2:  # nothing is due yet, so nothing was listed
            assert len(asked) == 4
    assert asked == [("list", ["a", "b"]), ("read", ["a"]), ("list", ["c"]), ("read", ["c"]),
                     ("list", ["b"]), ("read", ["b"])]
    assert store.read("items").count() == 3
    assert {r.status for r in store.read("scanned_partitions").collect()} == {"done"}


def test_partitions_begun_but_lost_are_owed_a_scan(spark, store):
    from docketflow.operators import partitions
    from docketflow.plans import walk
    targets = target_rows(spark, "a", "b")
    done = partitions.mark_scanned(store.read("scanned_partitions"), spark.createDataFrame(
        [("hc/year=2024/court=9_13/bench=a", "hc", 1, 1)], "prefix string, source string, found long, queued long"),
        now())
    after = walk.begun(done, targets, now())
    assert {r.prefix[-1]: r.status for r in after.collect()} == {"a": "done", "b": "pending"}
    assert [r.prefix[-1] for r in partitions.due(after, now()).collect()] == ["b"]


def test_cap_is_told_once_per_batch(spark, store):
    from docketflow.plans import cap
    cells = "id long, source string, s3_key string, bytes long, status string, local_path string, batch_id long"
    rows = [(1, "hc", "a", 90, "downloaded", "x", 1), (2, "hc", "b", 50, "discovered", None, None)]
    store.replace("items", spark.createDataFrame(rows, cells))
    cycles.recount(store)
    nothing = spark.createDataFrame([], "path string, bytes long")

    def look(at):
        found = cap.check_cap(store, nothing, now(at), cap_bytes=100, auto_push=False)
        return [(r.phase, r.batch) for r in found.collect()]

    assert look(0) == [("cap-reached", 1)] and look(1) == []
    assert [(r.id, r.status) for r in store.read("batches").collect()] == [(1, "full")]
    assert [r.level for r in store.read("events").collect()] == ["warn"]
    rows[0] = (1, "hc", "a", 90, "failed", "x", 1)
    store.replace("items", spark.createDataFrame(rows, cells))
    cycles.recount(store)
    assert look(2) == [("cap-blocked", 1)] and look(3) == []
    assert sorted(r.level for r in store.read("events").collect()) == ["error", "warn"]


def test_rates_drop_events_behind_the_watermark(spark, tmp_path):
    from docketflow.streaming.rates import event_rates, stream_rates
    base = dt.datetime(2024, 1, 1, 12)

    def rows(*minutes):
        return spark.createDataFrame([(m, m, base + dt.timedelta(minutes=m), "x") for m in minutes], stream.EVENT)

    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for part in ((1, 2, 59), (61, 200), (3, 201), (400,)):
        rows(*part).coalesce(1).write.mode("append").parquet(source)
        events = spark.readStream.schema(stream.EVENT).parquet(source)
        stream_rates(events, str(tmp_path / "cp"), out).awaitTermination()
    got = {(r.window_start.hour, r.n_events) for r in spark.read.parquet(out).collect()}
    assert got == {(12, 3), (13, 1), (15, 2)}  # minute 3 came 197 minutes late; 18:40 is still open
    whole = {(r.window_start.hour, r.n_events) for r in event_rates(rows(1, 2, 3, 59, 61, 200, 201)).collect()}
    assert whole == {(12, 4), (13, 1), (15, 2)}


def test_many_updates_fold_into_a_version(spark, store, monkeypatch):
    from docketflow.sources import store as stores
    monkeypatch.setattr(stores, "MOST_STEPS", 2)
    cells = "id long, source string, s3_key string, status string"
    rows = [(i, "hc", f"k{i}", "discovered") for i in range(4)]
    store.append("items", spark.createDataFrame(rows[:3], cells))
    store.append("items", spark.createDataFrame(rows[3:], cells))
    for n in range(4):
        store.update("items", spark.createDataFrame([(n % 2, "hc", f"k{n % 2}", f"s{n}")], cells))
        assert store.read("items").count() == 4
    assert store._versions("items") == [1, 2]
    assert {r.id: r.status for r in store.read("items").collect()} == {
        0: "s2", 1: "s3", 2: "discovered", 3: "discovered"}
    # A folder that a lost job left incomplete is not read, and is written over.
    store._write_step("items", "changed", spark.createDataFrame([(2, "hc", "k2", "x")], cells), 2)
    last = store._steps("items", "changed", 2)[-1]
    path, fs = store._folder(f"items/changed/version=2/step={last}/_SUCCESS")
    fs.delete(path, False)
    assert store.read("items").where("id = 2").first().status == "discovered"


def test_whole_cycle(spark, tmp_path, store):
    from docketflow.sources.courts import court_dimension
    from docketflow.sources.listing import place_objects
    hc, sc = readers(spark)
    objects = place_objects(keys(spark, [f"{c}.pdf" for c in "abcdef"]))
    targets = objects.select("source", "year", "court", "bench").distinct()
    summary = cycles.scan(store, targets, objects, hc([2024]), sc([]), court_dimension(spark),
                          now()).first()
    assert (summary.seen, summary.usable, summary.queued) == (6, 6, 6)
    claimed = cycles.claim_downloads(store, cap_bytes=21_000, limit=8)
    assert claimed.count() == 4
    assert cycles.claim_downloads(store, cap_bytes=21_000, limit=8).count() == 0
    staged = store.read("items").where("status = 'downloading'").select(
        F.concat(F.lit("batch1/hc/"), F.col("id").cast("string"), F.lit("_"),
                 F.substring_index("s3_key", "/", -1)).alias("path"), F.col("bytes"))
    cycles.record_downloads(store, staged, now())
    assert store.read("items").where("status = 'downloaded' AND batch_id = 1").count() == 4
    files = staged.sparkSession.createDataFrame(
        [(r.local_path, r.bytes) for r in store.read("items").collect() if r.local_path],
        "path string, bytes long")
    sending = cycles.claim_uploads(store, files, str(tmp_path / "payloads"), limit=4)
    ids = sorted(r.id for r in sending.collect())
    assert len(ids) == 4
    assert spark.read.json(str(tmp_path / "payloads")).count() == 4
    answers = [(ids[0], 1, 201, '{"data": {"id": 5}}', 1), (ids[1], 1, 409, "dup", 1),
               (ids[2], 1, 500, "x", 1), (ids[3], 1, 401, "no", 1),
               (ids[0], 1, 201, '{"data": {"id": 6}}', 2)]
    responses = spark.createDataFrame(
        answers, "item_id long, claim long, http_status int, body string, seq long")
    halt = cycles.apply_responses(store, responses, now()).first()
    assert halt.halt
    after = {r.id: r for r in store.read("items").collect()}
    assert [after[i].status for i in ids] == ["pushed", "skipped", "downloaded", "downloaded"]
    assert after[ids[0]].document_id == 6
    snapshot = sorted(map(str, store.read("items").collect()))
    cycles.apply_responses(store, responses, now(5))
    assert sorted(map(str, store.read("items").collect())) == snapshot
    assert store.read("batches").first().status == "open"
    # A late failure of the first claim, after the row was claimed again, counts for nothing.
    again = cycles.claim_uploads(store, files, str(tmp_path / "payloads"), limit=1)
    assert [(r.id, r.claims) for r in again.collect()] == [(ids[2], 2)]
    assert {r.claims for r in spark.read.json(str(tmp_path / "payloads")).collect()} == {1, 2}
    late = spark.createDataFrame([(ids[2], 1, 500, "x", 8), (ids[2], 1, 503, "x", 9)], responses.schema)
    cycles.apply_responses(store, late, now(6))
    row = store.read("items").where(F.col("id") == ids[2]).first()
    assert (row.status, row.attempts) == ("uploading", 1)
    cycles.apply_responses(store, late.withColumn("claim", F.lit(2).cast("long")), now(7))
    row = store.read("items").where(F.col("id") == ids[2]).first()
    assert (row.status, row.attempts) == ("downloaded", 2)
    # All along, the counted changes agree with the ledger.
    figures = status.item_figures(store.read("items")).first().asDict()
    assert counters.figures(store.read("item_counts")).first().asDict() == figures
    cycles.compact_counts(store)
    assert counters.figures(store.read("item_counts")).first().asDict() == figures
    shown = feed.report(store, files, now(8))
    assert shown.first().stats.asDict() == figures
    assert not any("/items/" in name for name in shown.inputFiles())
    orphaned = cycles.recover(store, files)
    assert orphaned.count() == 2


def test_retry_pass(spark, tmp_path, store):
    from docketflow.sources.listing import place_objects
    failures = spark.createDataFrame(
        [("hc/year=2024/court=9_13/bench=m", "hc", "down"), ("hc/broken", "hc", "down")],
        "prefix string, source string, error string")
    cycles.fail_partitions(store, failures, now(-30))
    hc, sc = readers(spark)
    objects = place_objects(keys(spark, ["a.pdf"]))
    ticks = str(tmp_path / "ticks")

    def tick(offset):
        stamp = dt.datetime.fromtimestamp(NOW + offset)
        spark.createDataFrame([(stamp,)], "timestamp timestamp").coalesce(1).write.mode(
            "append").parquet(ticks)
        source = spark.readStream.schema("timestamp timestamp").parquet(ticks)
        query = discovery.stream_retries(
            source, str(tmp_path / "cp"), store, lambda: objects, lambda: hc([2024]),
            lambda: sc([]), trigger={"availableNow": True})
        query.awaitTermination()
        return {r.prefix: (r.status, r.attempts)
                for r in store.read("scanned_partitions").collect()}

    assert tick(0) == {"hc/year=2024/court=9_13/bench=m": ("pending", 1),
                       "hc/broken": ("pending", 1)}
    assert tick(100) == {"hc/year=2024/court=9_13/bench=m": ("done", 0),
                         "hc/broken": ("pending", 2)}
    assert store.read("items").count() == 1


def test_status_feed(spark, tmp_path, store):
    ticks = spark.readStream.format("rate").option("rowsPerSecond", 5).load()
    out = str(tmp_path / "feed")
    query = discovery.stream_status(
        ticks, str(tmp_path / "cp"), store, lambda: reports.totals(store.read("items")), out)
    deadline = time.time() + 60
    while not query.recentProgress and time.time() < deadline:
        time.sleep(0.5)
    query.stop()
    assert query.exception() is None
    assert spark.read.json(f"{out}/tick=0/report").first().total_items == 0


def event_rows(rng, items, n):
    base = dt.datetime(2024, 1, 1)
    return [(rng.randrange(items), e, base + dt.timedelta(seconds=e // 2),
             rng.choice(lifecycle.KINDS)) for e in range(n)]


def states(df):
    return {r.item_id: (r.status, r.attempts, r.has_file, r.n_events, r.last_event_id)
            for r in df.collect()}


def test_lifecycle_stream_equals_batch_with_late_and_repeated_events(spark, tmp_path):
    rng = random.Random(4)
    rows = event_rows(rng, 12, 400)
    late = [r for r in rows[:150] if rng.random() < 0.2]
    first = [r for r in rows[:150] if r not in late]
    third = rows[300:] + late + rng.sample(rows[:200], 20)
    source, root = str(tmp_path / "in"), str(tmp_path / "state")
    table = stream.StateTable(spark, root, bucket_s=60)
    assert table.state().count() == 0
    for part in (first, rows[150:300], third):
        spark.createDataFrame(part, stream.EVENT).coalesce(1).write.mode("append").parquet(source)
        events = spark.readStream.schema(stream.EVENT).parquet(source)
        query = stream.stream_lifecycle(events, str(tmp_path / "cp"), table)
        query.awaitTermination()
    batch = lifecycle.lifecycle(spark.createDataFrame(rows, stream.EVENT))
    assert states(table.state()) == states(batch)
    some = spark.createDataFrame([(3,), (5,), (99,)], "item_id long")
    assert states(table.state(some)) == {k: v for k, v in states(batch).items() if k in (3, 5)}
    # A replay of the last micro-batch writes the same state.
    table.apply(spark.createDataFrame(third, stream.EVENT), 2)
    assert states(table.state()) == states(batch)


def test_a_late_event_rewrites_its_bucket_alone(spark, tmp_path):
    table = stream.StateTable(spark, str(tmp_path / "state"), bucket_s=60)
    rows = event_rows(random.Random(5), 4, 400)
    table.apply(spark.createDataFrame(rows, stream.EVENT), 0)
    folder = tmp_path / "state/segments"
    before = {p: p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}
    base = dt.datetime(2024, 1, 1)
    table.apply(spark.createDataFrame([(1, 9_000, base + dt.timedelta(seconds=61), "failed")], stream.EVENT), 1)
    after = {p: p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}
    changed = {p.parent.name for p, _ in set(before.items()) ^ set(after.items())}
    assert len({p.parent.name for p in after}) == 4 and len(changed) == 1
    longer = lifecycle.lifecycle(spark.createDataFrame(
        [*rows, (1, 9_000, base + dt.timedelta(seconds=61), "failed")], stream.EVENT))
    assert states(table.state()) == states(longer)


def test_delivery_stream(spark, tmp_path, store):
    ledger = spark.createDataFrame(
        [(i, "hc", f"k{i}", "uploading", f"p{i}") for i in range(1, 4)],
        "id long, source string, s3_key string, status string, local_path string")
    store.replace("items", ledger)
    source = str(tmp_path / "responses")
    answers = [(1, 0, 201, '{"data": {"id": 5}}', 1), (2, 0, 503, "busy", 1), (3, 7, 400, "other claim", 1)]
    for _ in range(2):
        spark.createDataFrame(answers, stream.RESPONSE).coalesce(1).write.mode("append").parquet(
            source)
        rows = spark.readStream.schema(stream.RESPONSE).parquet(source)
        stream.stream_delivery(rows, str(tmp_path / "cp"), store).awaitTermination()
        got = {r.id: (r.status, r.attempts) for r in store.read("items").collect()}
        assert got == {1: ("pushed", 0), 2: ("downloaded", 1), 3: ("uploading", 0)}
