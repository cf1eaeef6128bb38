"""Ledger operators against brute force in plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from docketflow.operators import (
    admission, arrival, batches, catalogue, delivery, insertion, lifecycle, partitions, reports,
    status, transitions,
)
from docketflow.operators.keyed import first_per_key, last_per_key, patch
from docketflow.schemas import PARTITIONS
from docketflow.sources.store import conform

NOW = 1_700_000_000


def now():
    return F.timestamp_seconds(F.lit(NOW))


def items(spark, rows):
    """Ledger rows from dicts; unnamed columns take their defaults."""
    names = sorted({k for r in rows for k in r})
    kinds = {"id": "long", "bytes": "long", "attempts": "int", "batch_id": "long",
             "document_id": "long", "year": "int"}
    schema = ", ".join(f"{n} {kinds.get(n, 'string')}" for n in names)
    return conform(spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema),
                   "items")


def by_id(df):
    return {r.id: r for r in df.collect()}


def greedy(rows, budget, limit):
    queue = [r for r in sorted(rows) if r[1] <= budget][: limit * 4] if budget > 0 else []
    spent, out = 0, []
    for i, size in queue:
        if spent + size <= budget and len(out) < limit:
            out.append(i)
            spent += size
    return out


def test_admission_skips_and_continues(spark):
    rows = items(spark, [{"id": i, "bytes": b, "status": "discovered"}
                         for i, b in [(1, 60), (2, 50), (3, 30)]])
    assert [r.id for r in admission.claim_for_download(rows, 100).collect()] == [1, 3]


@pytest.mark.parametrize("seed", range(3))
def test_admission_matches_brute_force(spark, seed, monkeypatch):
    rng = random.Random(seed)
    sizes = [(i, rng.randint(1, 400)) for i in rng.sample(range(1, 5000), 300)]
    held = [{"id": 9000 + i, "bytes": 100, "status": s}
            for i, s in enumerate(["downloading", "downloaded", "uploading", "failed", "pushed"])]
    ledger = items(spark, held + [
        {"id": i, "bytes": b, "status": "discovered"} for i, b in sizes]).cache()
    for budget, limit in [(900, 8), (5000, 40), (0, 8), (-5, 8), (30, 500), (20_000, 200)]:
        want = greedy(sizes, budget, limit)
        cap = budget + 400
        assert sorted(r.id for r in admission.claim_for_download(
            ledger, cap, limit).collect()) == want
        if budget > 0:
            with monkeypatch.context() as m:
                m.setattr(admission, "CHUNK", 7)
                got = admission.claim_for_download(ledger, cap, limit)
                assert sorted(r.id for r in got.collect()) == want
        assert sum(dict(sizes)[i] for i in want) + 400 <= max(cap, 400)


def test_admission_of_alternating_sizes_is_one_fold(spark):
    sizes = [(i, 1 if i % 2 else 900) for i in range(1, 60_001)]
    ledger = items(spark, [{"id": i, "bytes": b, "status": "discovered"} for i, b in sizes]).cache()
    ledger.count()
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("admission", "admission")
    try:
        got = sorted(r.id for r in admission.claim_for_download(ledger, 40_000, 30_000).collect())
        jobs = tracker.getJobIdsForGroup("admission")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert got == greedy(sizes, 40_000, 30_000)
    assert len(jobs) <= 6  # the sum, the sorted queue, chunks, the fold; none per skipped row


def test_upload_claim_and_patch(spark):
    ledger = items(spark, [{"id": i, "status": "downloaded" if i % 2 else "pushed"}
                           for i in range(20)])
    ids = admission.claim_for_upload(ledger, 3)
    out = by_id(patch(ledger, admission.claimed_as(ids, "uploading"), "id"))
    assert [i for i, r in out.items() if r.status == "uploading"] == [1, 3, 5]
    assert len(out) == 20


def sequential_insert(ledger, batch):
    keys, cites = {k for k, _ in ledger}, {c for _, c in ledger if c is not None}
    out = []
    for k, c, o in sorted(batch, key=lambda r: r[2]):
        if k not in keys and (c is None or c not in cites):
            out.append(o)
            keys.add(k)
            cites.add(c)
    return sorted(out)


@pytest.mark.parametrize("seed", range(3))
def test_insert_matches_sequential_inserts(spark, seed):
    rng = random.Random(seed)
    cite = {k: rng.choice([None, f"c{rng.randint(0, 40)}", "hot"]) for k in range(120)}
    ledger = [(f"k{k}", f"c{rng.randint(0, 60)}") for k in rng.sample(range(120), 25)]
    picks = [rng.choice([rng.randint(0, 119), 5]) for _ in range(400)]
    batch = [(f"k{k}", cite[k], o) for o, k in enumerate(picks)]
    led = spark.createDataFrame(ledger, "s3_key string, citation string").withColumn(
        "id", F.lit(7).cast("long"))
    new = spark.createDataFrame(batch, "s3_key string, citation string, ord long")
    inserted = insertion.new_items(led, new, "ord")
    want = sequential_insert(ledger, batch)
    assert sorted(r.ord for r in inserted.collect()) == want
    rejected = insertion.rejected_items(led, new, inserted, "ord")
    assert rejected.count() == len(batch) - len(want)
    rows = insertion.as_ledger_rows(
        led, inserted.withColumn("source", F.lit("hc")), ["s3_key"], now())
    assert sorted(r.id for r in rows.collect()) == list(range(8, 8 + len(want)))
    again = insertion.new_items(led.unionByName(inserted.select("s3_key", "citation").withColumn(
        "id", F.lit(1).cast("long"))), new, "ord")
    assert again.count() == 0


def test_arrival_ids_are_dense_and_ordered(spark):
    rows = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("v"),
                                    F.lit(1).alias("hot"))
    got = arrival.with_arrival_ids(rows, ["hot", "v"], first=10).collect()
    assert all(r.id == r.v + 10 for r in got) and len(got) == 5000


def test_first_and_last_per_key(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 3, None), ("b", 2, "y")],
                                 "k string, o long, v string")
    assert {(r.k, r.o, r.v) for r in first_per_key(rows, ["k"], "o").collect()} == {
        ("a", 1, "x"), ("b", 2, "y")}
    assert {(r.k, r["last"].v) for r in last_per_key(rows, ["k"], "o").collect()} == {
        ("a", None), ("b", "y")}


def test_outcomes(spark):
    ledger = items(spark, [
        {"id": 1, "status": "uploading", "attempts": 2, "local_path": "p1"},
        {"id": 2, "status": "uploading", "attempts": 1, "local_path": "p2"},
        {"id": 3, "status": "uploading", "attempts": 0, "local_path": "p3", "error": "old"},
        {"id": 4, "status": "uploading", "attempts": 0, "local_path": "p4"},
        {"id": 5, "status": "uploading", "attempts": 0, "local_path": "p5", "error": "kept"}])
    responses = spark.createDataFrame([
        (1, 500, "down"), (2, 401, '{"message": "expired"}'),
        (3, 201, '{"data": {"id": 77}}'), (4, 409, "x" * 600)],
        "item_id long, http_status int, body string")
    outcomes = delivery.classify(responses)
    out = by_id(transitions.apply_outcomes(ledger, outcomes, now()))
    assert (out[1].status, out[1].attempts, out[1].local_path, out[1].error) == (
        "failed", 3, "p1", "HTTP 500: down")
    assert (out[2].status, out[2].attempts, out[2].error) == (
        "downloaded", 2, "Unauthorised: expired")
    assert (out[3].status, out[3].document_id, out[3].local_path, out[3].error) == (
        "pushed", 77, None, None)
    assert out[3].pushed_at is not None
    assert (out[4].status, out[4].local_path, len(out[4].error)) == ("skipped", None, 319)
    assert (out[5].status, out[5].error) == ("uploading", "kept")
    halt = delivery.auth_halt(outcomes).first()
    assert (halt.halt, halt.refused) == (True, 1)
    # A failed upload keeps its bytes reserved and its file claimed.
    assert reports.bytes_on_disk(items(spark, [
        {"id": 1, "status": "failed", "bytes": 9, "local_path": "p1"}])).first()[0] == 9
    staged = spark.createDataFrame([("p1", 1), ("zz", 1)], "path string, bytes long")
    assert [r.path for r in transitions.orphans(
        transitions.apply_outcomes(ledger, outcomes, now()), staged).collect()] == ["zz"]


@pytest.mark.parametrize("status_code,body,outcome,doc", [
    (201, '{"data": {"id": "12"}}', "pushed", 12), (200, '{"data": null}', "retry", None),
    (201, "not json", "retry", None), (409, "{}", "skipped", None), (400, "x", "skipped", None),
    (401, "x", "auth", None), (403, "x", "auth", None), (500, "x", "retry", None),
    (404, '{"data": {"id": 4}}', "retry", None)])
def test_classification(spark, status_code, body, outcome, doc):
    row = delivery.classify(spark.createDataFrame(
        [(1, status_code, body)], "item_id long, http_status int, body string")).first()
    assert (row.outcome, row.document_id) == (outcome, doc)
    assert (row.message is None) == (outcome == "pushed")


def test_payload_leaves_blanks_out(spark):
    import json
    ledger = items(spark, [{"id": 1, "citation": "c", "title": "", "year": 2020, "language": "",
                            "source_url": "https://x/ (CNR 1)", "state_name": "India"}])
    assert json.loads(delivery.payloads(ledger).first().payload) == {
        "citation": "c", "year": "2020", "language": "en", "state": "India"}


def test_recovery_and_retry(spark):
    ledger = items(spark, [
        {"id": 1, "status": "uploading", "local_path": "a"},
        {"id": 2, "status": "uploading", "local_path": "gone"},
        {"id": 3, "status": "downloading"},
        {"id": 4, "status": "downloading", "local_path": "b"},
        {"id": 5, "status": "pushed"},
        {"id": 6, "status": "failed", "attempts": 3, "local_path": "c", "error": "e"},
        {"id": 7, "status": "failed", "attempts": 3, "error": "e"}])
    staged = spark.createDataFrame([("a", 1), ("b", 1)], "path string, bytes long")
    out = by_id(transitions.reset_inflight(ledger, staged))
    assert [(out[i].status, out[i].local_path) for i in range(1, 6)] == [
        ("downloaded", "a"), ("discovered", None), ("discovered", None), ("downloaded", "b"),
        ("pushed", None)]
    gone = by_id(transitions.requeue_vanished(ledger, staged))
    assert (gone[1].status, gone[2].status, gone[4].status) == (
        "uploading", "discovered", "downloading")
    again = by_id(transitions.retry_failed(ledger))
    assert [(again[i].status, again[i].attempts, again[i].error) for i in (6, 7)] == [
        ("downloaded", 0, None), ("discovered", 0, None)]


def test_staging_paths_never_collide(spark):
    ledger = items(spark, [{"id": i, "source": "hc", "batch_id": 1, "s3_key": f"d{i}/same.pdf"}
                           for i in range(50)])
    paths = [r[0] for r in ledger.select(transitions.staging_path()).collect()]
    assert len(set(paths)) == 50 and "batch1/hc/7_same.pdf" in paths


def test_download_manifest_takes_the_true_size(spark):
    ledger = items(spark, [{"id": i, "source": "hc", "s3_key": f"x/{i}.pdf", "bytes": 5,
                            "attempts": 2, "status": "downloading", "error": "e"}
                           for i in (1, 2)])
    staged = spark.createDataFrame([("batch9/hc/1_1.pdf", 8)], "path string, bytes long")
    out = by_id(transitions.mark_downloaded(
        ledger, transitions.staged_manifest(ledger, staged, F.lit(9)), now()))
    assert (out[1].status, out[1].bytes, out[1].batch_id, out[1].attempts, out[1].error) == (
        "downloaded", 8, 9, 2, None)
    assert (out[2].status, out[2].bytes) == ("downloading", 5)


def test_batches(spark):
    none = spark.createDataFrame([], "id long, opened_at timestamp, closed_at timestamp, "
                                     "pushed_at timestamp, status string")
    assert batches.open_batch(none).first() == (1, True)
    opened = batches.with_open_batch(none, now())
    assert batches.open_batch(opened).first() == (1, False)
    assert batches.with_open_batch(opened, now()).count() == 1
    closed = batches.set_batch_status(opened, spark.createDataFrame(
        [(1, "full")], "id long, status string"), now())
    assert closed.first().closed_at is not None and closed.first().pushed_at is None
    assert batches.open_batch(closed).first() == (2, True)


def replay(events, max_attempts=3):
    """The life cycle of one item, one event at a time."""
    s = None
    for kind in events:
        if s is None:
            if kind == "discovered":
                s = ["discovered", 0, False]
            continue
        if kind in ("downloading", "uploading"):
            s[0] = kind
        elif kind == "downloaded":
            s[0], s[2] = kind, True
        elif kind in ("pushed", "skipped"):
            s[0], s[2] = kind, False
        elif kind == "failed":
            s[1] += 1
            stage = "downloaded" if s[2] else "discovered"
            s[0] = "failed" if s[1] >= max_attempts else stage
        elif kind == "retry" and s[0] == "failed":
            s[0], s[1] = ("downloaded" if s[2] else "discovered"), 0
    return tuple(s) if s else None


@pytest.mark.parametrize("bucket_s,parts", [(None, 8), (7, 8), (2, 41)])
def test_lifecycle_matches_replay(spark, bucket_s, parts):
    rng = random.Random(parts)
    weights = [1, 2, 3, 2, 1, 1, 6, 3]
    rows, histories = [], {}
    for item in range(60):
        n = rng.choice([1, 4, 9, 90])
        kinds = rng.choices(lifecycle.KINDS, weights, k=n)
        histories[item] = kinds
        rows += [(item, t // 3, t, k) for t, k in enumerate(kinds)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "item_id long, ts long, event_id long, kind string")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = {r.item_id: (r.status, r.attempts, r.has_file)
               for r in lifecycle.lifecycle(df, bucket_s=bucket_s).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    want = {i: replay(k) for i, k in histories.items() if replay(k)}
    assert got == want


def partitions_frame(spark, rows):
    names = PARTITIONS.fieldNames()
    schema = "prefix string, source string, status string, attempts int, next_s long"
    df = spark.createDataFrame(rows, schema).withColumn(
        "next_attempt_at", F.timestamp_seconds("next_s"))
    return conform(df, "scanned_partitions").select(*names)


def test_partition_failures_back_off_then_park(spark):
    parts = partitions_frame(spark, [])
    failure = spark.createDataFrame([("p", "hc", "e" * 600)],
                                    "prefix string, source string, error string")
    seen = []
    for _ in range(5):
        parts = partitions.mark_failed(parts, failure, now())
        row = parts.first()
        delay = row.next_attempt_at.timestamp() - NOW
        seen.append((row.attempts, row.status, int(delay), len(row.error)))
    assert seen == [(1, "pending", 60, 500), (2, "pending", 120, 500), (3, "pending", 240, 500),
                    (4, "failed", 480, 500), (5, "failed", 900, 500)]
    assert partitions.backlog(parts).first() == (0, 1)
    retried = partitions.retry_failed(parts).first()
    assert (retried.status, retried.attempts, retried.error) == ("pending", 0, None)
    done = partitions.mark_scanned(parts, spark.createDataFrame(
        [("p", "xx", 5, 2)], "prefix string, source string, found long, queued long"), now())
    row = done.first()
    assert (row.source, row.found, row.queued, row.status, row.attempts) == (
        "hc", 5, 2, "done", 0)


def test_prefixes(spark):
    cases = [("hc/year=2024/court=9_13/bench=a/b", ("hc", 2024, "9_13", "a/b")),
             ("hc/x", None), ("sc/year=2024/english", ("sc", 2024, "english", None)),
             ("sc/year=x/english", None), ("sc/2024/english", None), ("zz/year=1/a", None),
             ("hc/year=2024/court=1", None), ("hc/year=2024/court=a=b/bench=c=d",
                                              ("hc", 2024, "a=b", "c=d"))]
    df = spark.createDataFrame([(c[0],) for c in cases], "prefix string")
    got = {r.prefix: r.t for r in df.select("prefix", catalogue.target_of("prefix").alias("t"))
           .collect()}
    assert {p: tuple(t) if t else None for p, t in got.items()} == dict(cases)


def test_requests_are_checked(spark):
    for bad in [("xx", 2000, 2001), ("hc", 1949, 2000), ("sc", 2000, 2101), ("hc", 2001, 2000)]:
        with pytest.raises(ValueError):
            catalogue.check_request(*bad)
    years = catalogue.expand_sc(spark, 2020, 2022, include_regional=True).collect()
    assert len(years) == 6 and catalogue.expand_sc(spark, 2020, 2022).count() == 3
    with pytest.raises(ValueError):
        reports.list_items(items(spark, [{"id": 1}]), "lost")


def test_plan_drops_done_and_appends(spark):
    schema = "source string, year int, court string, bench string"
    targets = spark.createDataFrame([("hc", 2024, "c", b) for b in "abca"], schema)
    parts = partitions_frame(spark, [("hc/year=2024/court=c/bench=b", "hc", "done", 0, 0),
                                     ("hc/year=2024/court=c/bench=a", "hc", "pending", 1, 0)])
    plan = catalogue.set_plan(targets, parts)
    assert [(r.pos, r.bench) for r in plan.orderBy("pos").collect()] == [(0, "a"), (1, "c")]
    more = spark.createDataFrame([("hc", 2024, "c", "a"), ("sc", 2024, "english", None)], schema)
    longer = catalogue.set_plan(more, parts, plan)
    assert [(r.pos, r.court) for r in longer.orderBy("pos").collect()] == [
        (0, "c"), (1, "c"), (2, "english")]
    assert catalogue.plan_progress(longer, F.lit(9)).first() == (3, 3, 0)
    assert catalogue.pending_targets(longer, F.lit(2)).count() == 1


def snap(spark, rows, part_rows=(), plan_size=0, **flags):
    plan = spark.range(plan_size).select(F.col("id").alias("pos"))
    staged = spark.createDataFrame([], "path string, bytes long")
    shot = status.snapshot(items(spark, rows or [{"id": 0, "status": "pushed", "bytes": 1}]),
                           staged, partitions_frame(spark, list(part_rows)), plan, F.lit(0),
                           now(), **{"cap_bytes": 100, **flags})
    return shot


@pytest.mark.parametrize("rows,parts,plan,flags,phase,left", [
    ([], [], 0, {}, "idle", False),
    ([], [], 0, {"paused": True}, "paused", False),
    ([], [("p", "hc", "failed", 4, 0)], 0, {}, "scan-incomplete", True),
    ([], [("p", "hc", "pending", 1, NOW + 60)], 0, {}, "scan-incomplete", True),
    ([], [("p", "hc", "pending", 1, NOW - 60)], 0, {}, "scanning", True),
    ([], [], 2, {}, "scanning", True),
    ([("downloaded", 10)], [], 0, {}, "pushing", True),
    ([("downloaded", 90), ("discovered", 20)], [], 0, {"auto_push": False}, "cap-reached", True),
    ([("failed", 90), ("discovered", 20)], [], 0, {}, "cap-blocked", True),
    ([("discovered", 20)], [], 3, {}, "downloading", True),
])
def test_phases(spark, rows, parts, plan, flags, phase, left):
    ledger = [{"id": i, "status": s, "bytes": b} for i, (s, b) in enumerate(rows)]
    row = status.report(snap(spark, ledger, parts, plan, **flags)).first()
    assert (row.phase, row.work_left) == (phase, left)


def test_strict_phase_ignores_waiting_partitions(spark):
    shot = snap(spark, [], [("p", "hc", "pending", 1, NOW + 60)])
    assert status.report(shot, strict=True).first().phase == "idle"
    empty = reports.bytes_on_disk(items(spark, [{"id": 1}]).limit(0)).first()[0]
    assert empty == 0
