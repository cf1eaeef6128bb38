"""The registered queries: contracts, SQL, and the pipeline's stages."""

import pytest

import __spark_entry__ as entry_point
import corpus_pipeline
from checks.compare import canonical, duck_connection, duck_rows, spark_rows
from docketflow.llm import frames
from docketflow.llm.queries import ORACLE, QUERIES

TEXTS = [
    (1, None), (2, ""), (3, "x"), (None, "kein id und viele Wörter " * 20), (4, "ein Wort " * 400),
]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_agrees_with_sql(spark, sf_dir, name):
    columns, rows = spark_rows(QUERIES[name](spark, sf_dir))
    want_columns, want = duck_rows(duck_connection(sf_dir), ORACLE[name])
    assert sorted(columns) == sorted(want_columns)
    assert canonical(columns, rows) == canonical(want_columns, want)


def test_all_are_registered():
    found = entry_point.queries()
    assert set(QUERIES) < set(found) and found["pipeline"] is corpus_pipeline.run
    assert {x.split("_")[0] for x in QUERIES} == {f"op{i}" for i in range(1, 14)}


def test_pipeline_stages(spark, sf_dir):
    docs = frames.table(frames.importable(spark), sf_dir, "documents")
    total, columns = docs.count(), docs.columns
    counts = []
    for name, stage in corpus_pipeline.STAGES:
        docs = frames.settle(stage(spark, docs, sf_dir))
        counts.append(docs.count())
        assert name == "packing" or docs.columns == columns
    assert total > counts[0] > counts[1] >= counts[2] >= counts[3] > total / 2
    assert counts[4] >= counts[3]


def test_stages_on_odd_and_empty_tables(spark, sf_dir):
    odd = frames.importable(spark).createDataFrame(
        [(i, t, "xx", None, None) for i, t in TEXTS * 2],
        "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for docs in (odd, odd.where("false")):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, sf_dir)
            assert out.count() <= max(docs.count(), 1)
            assert name == "packing" or out.schema.names == docs.schema.names


def test_near_dedup_keeps_one_row_of_each_group(spark, sf_dir):
    def text(k: int, more: str = "") -> str:
        return " ".join(f"t{k}w{i}" for i in range(120)) + more

    rows = [
        (1, text(1)), (None, text(1, " mehr")), (None, text(1)), (None, text(2)), (None, text(2)),
        (None, text(2, " mehr")), (None, "einmalig"), (None, ""), (5, text(3)), (5, text(3)), (6, text(4)),
        (7, text(4)), (7, text(5)), (8, None), (8, None)]
    docs = frames.importable(spark).createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = corpus_pipeline.near_dedup(spark, docs, sf_dir)
    assert got.columns == docs.columns
    left = sorted(((r.doc_id or 0, r.text or "") for r in got.collect()))
    two = [x for x in left if x[1].startswith("t2")]
    assert len(two) == 1 and two[0][0] == 0
    assert [x for x in left if x not in two] == [
        (0, ""), (0, "einmalig"), (1, text(1)), (5, text(3)), (6, text(4)), (7, text(5)), (8, ""), (8, "")]


def test_classifier_without_labels_of_both_kinds_keeps_all(spark, tmp_path):
    docs = frames.importable(spark).createDataFrame(
        [(i, f"clean text number {i} " * 20) for i in range(8)], "doc_id bigint, text string")
    cases = {"none": [], "others": [(i, i % 2) for i in range(100, 104)],
             "bad": [(i, 0) for i in range(8)], "good": [(i, 1) for i in range(8)]}
    for name, known in cases.items():
        labels = spark.createDataFrame(known, "doc_id bigint, quality int")
        labels.write.parquet(f"{tmp_path}/{name}/labels.parquet")
        out = corpus_pipeline.quality_classifier(spark, docs, f"{tmp_path}/{name}")
        assert sorted(out.collect()) == sorted(docs.collect())
