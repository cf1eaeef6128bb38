"""Listings, metadata files, tables and settings on a small tree of real files."""

import datetime
import json
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from docketflow.plans.discovery import discover, scan_summary
from docketflow.operators.catalogue import TARGET
from docketflow.settings import HC_BUCKET, SC_BUCKET
from docketflow.sources import courts, keyvalue, listing, metadata, sinks
from docketflow.sources.store import TableStore, conform


def put(path, size=4096):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as out:
        out.write(b"x" * size)


def put_metadata(path, rows, schema):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    pq.write_table(pa.Table.from_pylist(rows, schema=schema), path)


HC = pa.schema([(c, pa.string()) for c in (
    "court_code title description judge pdf_link cnr decision_date disposal_nature court "
    "raw_html").split()])
SC = pa.schema([(c, pa.string()) for c in (
    "title petitioner respondent description judge author_judge citation case_id cnr "
    "decision_date disposal_nature court path nc_display raw_html year").split()])


@pytest.fixture(scope="module")
def tree(tmp_path_factory):
    root = str(tmp_path_factory.mktemp("buckets"))
    hc, sc = f"{root}/hc", f"{root}/sc"
    part = "year=2024/court=9_13/bench=main"
    for name, size in [("A_1.pdf", 4096), ("B_1.pdf", 2048), ("small.pdf", 2047),
                       ("page.html", 4096), ("sub/C_1.pdf", 4096), ("D.PDF", 4096)]:
        put(f"{hc}/data/pdf/{part}/{name}", size)
    put(f"{hc}/data/pdf/year=2024/court=99_9/bench=x/E_1.pdf")
    put(f"{hc}/data/pdf/year=2023/court=7_26/bench=bad/F_1.pdf")
    put(f"{hc}/data/pdf/year=2022/court=7_26/bench=empty/G_1.pdf")
    put(f"{hc}/data/pdf/stray.pdf")
    put_metadata(f"{hc}/metadata/parquet/{part}/metadata.parquet", [
        {"pdf_link": "x/A_1.pdf", "title": "old", "court": "First"},
        {"pdf_link": "y/A_1.pdf", "title": "WP(C)/1/2024 of P Vs Q", "judge": "Justice A, B",
         "cnr": " N1 ", "decision_date": "05-03-2023", "court": "Own Court", "raw_html": "<>"},
        {"pdf_link": None, "title": "nowhere"},
    ], HC)
    put(f"{hc}/metadata/parquet/year=2023/court=7_26/bench=bad/metadata.parquet", 500)
    put_metadata(f"{hc}/metadata/parquet/year=2022/court=7_26/bench=empty/metadata.parquet",
                 [], HC)
    for kind, name in [("english", "2024_1_EN.pdf"), ("english", "whole.pdf"),
                       ("regional", "2024_1_HIN.pdf"), ("regional", "nolang.pdf")]:
        put(f"{sc}/data/pdf/year=2024/{kind}/{name}")
    put_metadata(f"{sc}/metadata/parquet/year=2024/metadata.parquet", [
        {"path": "2024_1", "title": "Civil Appeal", "petitioner": "P", "citation": " ",
         "nc_display": "2024 INSC 1", "judge": "X", "author_judge": "Justice X"},
        {"path": "whole", "title": None, "description": "habeas corpus", "respondent": "R"},
    ], SC)
    return hc, sc


@pytest.fixture(scope="module")
def objects(spark, tree):
    hc, sc = tree
    return listing.list_bucket(spark, hc, HC_BUCKET).unionByName(
        listing.list_bucket(spark, sc, SC_BUCKET)).cache()


def test_listing_places_every_object(objects):
    rows = {r.s3_key: r for r in objects.collect()}
    assert len(rows) == 13 and "data/pdf/stray.pdf" not in rows
    nested = rows["data/pdf/year=2024/court=9_13/bench=main/sub/C_1.pdf"]
    assert (nested.filename, nested.year, nested.court, nested.bench) == (
        "sub/C_1.pdf", 2024, "9_13", "main")
    sc = rows["data/pdf/year=2024/regional/2024_1_HIN.pdf"]
    assert (sc.source, sc.court, sc.bench, sc.bytes) == ("sc", "regional", None, 4096)


def test_inventory_gives_the_same_rows(spark, objects, tmp_path):
    path = str(tmp_path / "inv")
    objects.select("bucket", "s3_key", "bytes").write.parquet(path)
    again = listing.read_inventory(spark, path)
    assert again.exceptAll(objects).count() == 0 and again.count() == objects.count()


def test_listing_reads_no_content(spark, tree):
    plan = listing.scan_tree(spark, tree[0])._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1]


def test_metadata_prunes_columns_and_keeps_its_own_court(spark, tree):
    rows = metadata.read_hc_metadata(spark, tree[0])
    assert "raw_html" not in rows._jdf.queryExecution().executedPlan().toString()
    own = {(r.court_code, r.court) for r in rows.select("court_code", "court").collect()}
    assert own == {("9_13", "First"), ("9_13", "Own Court"), ("9_13", None)}
    assert metadata.read_hc_metadata(spark, tree[0], [2024]).count() == 3


def test_metadata_triage(spark, tree):
    errors = metadata.metadata_errors(spark, tree[0])
    found = metadata.errors_by_partition(errors).collect()
    assert [(r.source, r.year, r.court, r.bench) for r in found] == [
        ("hc", 2023, "7_26", "bad")]
    assert found[0].error.startswith("Parquet parse failed")


def test_a_file_is_read_whole_or_reported(spark, tmp_path):
    root = str(tmp_path / "hc")
    place = f"{root}/metadata/parquet/year=2020/court=1_1/bench"
    rows = [{"pdf_link": f"{i}.pdf", "decision_date": f"{i % 28 + 1:02d}-03-2020"} for i in range(2_000)]
    text = pa.schema([("pdf_link", pa.string()), ("decision_date", pa.string())])
    os.makedirs(f"{place}=damaged")
    path = f"{place}=damaged/metadata.parquet"
    pq.write_table(pa.Table.from_pylist(rows, schema=text), path, row_group_size=1_000,
                   use_dictionary=False, compression="gzip")
    second = pq.ParquetFile(path).metadata.row_group(1).column(0)
    raw = bytearray(open(path, "rb").read())
    middle = second.data_page_offset + second.total_compressed_size // 2
    raw[middle : middle + 200] = bytes(200)
    open(path, "wb").write(raw)
    put_metadata(f"{place}=text/metadata.parquet", rows[:3], text)
    dated = [{"pdf_link": "d.pdf", "decision_date": datetime.date(2020, 3, 5)}]
    put_metadata(f"{place}=dated/metadata.parquet", dated, pa.schema(
        [("pdf_link", pa.string()), ("decision_date", pa.date32())]))
    put_metadata(f"{place}=none/metadata.parquet", [], text)
    put(f"{place}=cut/metadata.parquet", 300)
    got = {(r.bench, r.decision_date) for r in metadata.read_hc_metadata(spark, root).collect()}
    assert got == {("text", "01-03-2020"), ("text", "02-03-2020"), ("text", "03-03-2020"),
                   ("dated", "2020-03-05")}
    bad = metadata.errors_by_partition(metadata.metadata_errors(spark, root)).collect()
    assert sorted(r.bench for r in bad) == ["cut", "damaged"]
    assert metadata.read_hc_metadata(spark, root, [1999]).count() == 0
    assert metadata.read_hc_metadata(spark, root, []).count() == 0
    assert metadata.read_hc_metadata(spark, root, [1999, 2020]).count() == 4
    assert metadata.metadata_errors(spark, root, [1999]).count() == 0


def test_targets_open_only_their_files(spark, tree):
    targets = spark.createDataFrame(
        [("hc", 2024, "9_13", "main"), ("hc", 2024, "none", "x"), ("sc", 2024, "english", None)],
        "source string, year int, court string, bench string")
    rows = metadata.read_hc_metadata(spark, tree[0], targets=targets)
    assert rows.count() == 3 and len(rows.inputFiles()) == 1
    objects, failures = listing.list_targets(targets, tree[0], tree[1])
    assert {r.source for r in objects.collect()} == {"hc", "sc"} and failures.count() == 0
    assert objects.where("source = 'hc'").count() == 6  # those of the one partition, no other
    whole = listing.list_bucket(spark, tree[0], "indian-high-court-judgments")
    mine = whole.where("year = 2024 AND court = '9_13'")
    names = ["s3_key", "filename", "bytes", "source", "year", "court", "bench"]
    assert sorted(objects.where("source = 'hc'").select(*names).collect()) == sorted(mine.select(*names).collect())


def test_missing_staging_folder_is_empty(spark, tmp_path):
    assert listing.scan_staging(spark, str(tmp_path / "nowhere")).count() == 0


def test_payloads_of_other_claims_stay(spark, tmp_path):
    def claim(batch, name, *texts):
        rows = spark.createDataFrame([(batch, t) for t in texts], "batch_id long, payload string")
        sinks.write_payloads(rows, str(tmp_path / "out"), name)

    claim(1, "a", "one", "two")
    claim(1, "b", "three")
    claim(2, "a", "four")
    claim(1, "b", "three again")
    found = {r.payload for r in spark.read.json(str(tmp_path / "out")).collect()}
    assert found == {"one", "two", "three again", "four"}


def test_discovery_from_files(spark, tree, objects):
    hc_rows = metadata.read_hc_metadata(spark, tree[0])
    found = discover(objects, hc_rows, metadata.read_sc_metadata(spark, tree[1]),
                     courts.court_dimension(spark)).cache()
    by = {r.citation: r for r in found.collect()}
    assert set(by) == {
        "HC/9_13/main/A_1", "HC/9_13/main/B_1", "HC/99_9/x/E_1", "HC/7_26/bad/F_1",
        "HC/7_26/empty/G_1", "SC/2024/2024_1_EN", "SC/2024/whole", "SC/2024/2024_1_HIN_HIN",
        "SC/2024/nolang_nolang"}
    a = by["HC/9_13/main/A_1"]
    assert (a.title, a.year, a.decision_date, a.court, a.state_name, a.bench_type, a.case_type,
            a.parties, a.cnr, a.source_citation, a.source_url) == (
        "WP(C)/1/2024 of P Vs Q", 2023, "2023-03-05", "Own Court", "Uttar Pradesh",
        "division_bench", "writ_petition", "P Vs Q", "N1", "N1",
        "https://judgments.ecourts.gov.in/ (CNR N1)")
    b = by["HC/9_13/main/B_1"]
    assert (b.title, b.parties, b.court, b.source_citation, b.case_type, b.source_url) == (
        "B_1", "B_1", "Allahabad High Court", "HC/9_13/main/B_1", None, None)
    assert (by["HC/99_9/x/E_1"].court, by["HC/99_9/x/E_1"].state_name) == ("99_9", None)
    en, hin = by["SC/2024/2024_1_EN"], by["SC/2024/2024_1_HIN_HIN"]
    assert (en.title, en.source_citation, en.parties, en.judges, en.bench_type, en.language) == (
        "Civil Appeal", "2024 INSC 1", "P", "X | Justice X", "single_judge", "en")
    assert (hin.language, hin.title) == ("hin", "Civil Appeal")
    whole, nolang = by["SC/2024/whole"], by["SC/2024/nolang_nolang"]
    assert (whole.title, whole.case_type, whole.parties) == ("whole", "habeas_corpus", "R")
    assert nolang.language == "nolang"

    errors = metadata.errors_by_partition(metadata.metadata_errors(spark, tree[0]))
    targets = objects.select(*TARGET).distinct().unionByName(spark.createDataFrame(
        [("hc", 1999, "7_26", "gone")], "source string, year int, court string, bench string"))
    summary = {r.prefix: r for r in scan_summary(
        targets, objects, found, found.limit(0), errors).collect()}
    main = summary["hc/year=2024/court=9_13/bench=main"]
    assert (main.seen, main.usable, main.queued, main.metadata_error) == (6, 2, 0, None)
    gone = summary["hc/year=1999/court=7_26/bench=gone"]
    assert (gone.seen, gone.usable) == (0, 0)
    assert summary["hc/year=2023/court=7_26/bench=bad"].metadata_error


def test_court_names_from_json(spark, tmp_path):
    path = tmp_path / "codes.json"
    path.write_text(json.dumps({"9~13": "Allahabad High Court", "7~26": "Delhi"}, indent=1))
    rows = courts.court_names_from_json(spark, str(path)).collect()
    assert {(r.court_code, r.court_name) for r in rows} == {
        ("9_13", "Allahabad High Court"), ("7_26", "Delhi")}


def test_store_versions_and_migration(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "ledger"))
    store.create()
    store.create()
    assert store.read("items").count() == 0
    row = spark.createDataFrame([(1, "hc", "k1", "b")], "id long, source string, s3_key string, "
                                                        "bucket string")
    store.append("items", row)
    got = store.read("items").first()
    assert (got.status, got.attempts, got.language, got.bytes, got.citation) == (
        "discovered", 0, "en", 0, None)
    before = store.read("items")
    store.replace("items", before.withColumn("status", F.lit("pushed")))
    assert before.first().status == "discovered"
    assert store.read("items").first().status == "pushed"
    for _ in range(4):
        store.replace("items", store.read("items"))
    assert len(store._versions("items")) == 3
    old = store.read("items").drop("attempts", "language", "court_type")
    old.write.mode("overwrite").parquet(store._dir("items", 99))
    migrated = store.read("items").first()
    assert (migrated.attempts, migrated.language, migrated.court_type, migrated.status) == (
        0, "en", None, "pushed")
    parts = conform(spark.createDataFrame([("p", "hc")], "prefix string, source string"),
                    "scanned_partitions").first()
    assert (parts.status, parts.attempts, parts.next_attempt_at.year) == ("done", 0, 1970)


def test_settings(spark):
    meta = spark.createDataFrame(
        [("a", '"x"'), ("b", "raw text"), ("c", '{"k": 1}'), ("d", "null"), ("e", "12")],
        "key string, value string")
    decoded = {r.key: r.v for r in meta.select("key", keyvalue.decoded("value").alias("v"))
               .collect()}
    assert decoded == {"a": "x", "b": "raw text", "c": '{"k":1}', "d": None, "e": "12"}
    writes = spark.createDataFrame([("a", "1", 1), ("a", "2", 2), ("n", "9", 1)],
                                   "key string, value string, seq long")
    merged = keyvalue.upsert_settings(meta, writes)
    assert {(r.key, r.value) for r in merged.collect()} >= {("a", "2"), ("n", "9"), ("e", "12")}
    assert merged.count() == 6
    assert keyvalue.get_setting(merged, "a").first().value == "2"
    assert keyvalue.get_setting(merged, "zz", "none").first().value == "none"


def test_event_sink_continues_ids_and_keeps_levels(spark):
    log = spark.createDataFrame([(41, "info")], "id long, level string")
    rows = spark.createDataFrame(
        [("p2", "warn", "w", None), ("p1", "info", "i", 7), ("p3", "loud", "x", None)],
        "prefix string, level string, message string, item_id long")
    out = sinks.new_events(log, rows, F.timestamp_seconds(F.lit(0)), ["prefix"]).orderBy("id")
    assert [(r.id, r.level, r.item_id) for r in out.collect()] == [
        (42, "info", 7), (43, "warn", None), (44, "loud", None)]
