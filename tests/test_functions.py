"""Hand-written rows for every scalar function."""

import re

import pytest
from pyspark.sql import functions as F

from docketflow.functions import case_types, dates, display, judges, text
from docketflow.functions.courts import COURT_NAMES, COURT_STATES


def evaluate(spark, values, expr, dtype="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {dtype}")
    return [r.out for r in df.select("i", expr("v").alias("out")).orderBy("i").collect()]


def check(spark, pairs, expr, dtype="string"):
    assert evaluate(spark, [p[0] for p in pairs], expr, dtype) == [p[1] for p in pairs]


def test_blanks_are_what_python_strips():
    stripped = {chr(c) for c in range(0x110000) if not chr(c).strip()}
    assert set(text.BLANKS) == stripped


def test_clip(spark):
    check(spark, [
        ("\ta\n", "a"), ("   ", None), ("", None), (None, None), ("x" * 501, "x" * 500),
        ("　\x1c a b \x85", "a b"), ("é" * 600, "é" * 500), ("😀" * 501, "😀" * 500),
        (" " + "a" * 499 + " b", "a" * 499 + " "),
    ], lambda v: text.clip(v, 500))


def test_stem_and_basename(spark):
    check(spark, [("a.pdf", "a"), (".pdf", ".pdf"), ("a.b.pdf", "a.b"), ("abc", "abc"),
                  ("x_1_2024-01-05.pdf", "x_1_2024-01-05")], text.stem)
    check(spark, [("a/b/c.pdf", "c.pdf"), ("c.pdf", "c.pdf"), ("a/", "")], text.basename)


def test_suffix_split(spark):
    cases = ["2024_10_108_125_EN", "abc", "_x", "x_", ""]
    heads = evaluate(spark, cases, lambda v: text.suffix_split(v)[0])
    tails = evaluate(spark, cases, lambda v: text.suffix_split(v)[1])
    expected = [c.rpartition("_") for c in cases]
    assert heads == [e[0] for e in expected]
    assert tails == [e[2] for e in expected]


def test_parties(spark):
    check(spark, [
        ("WP(C)/60/2023 of A Vs B", "A Vs B"), ("A Vs B", "A Vs B"),
        ("State of X Vs Y", "X Vs Y"), ("", None), (None, None),
        ("a of b of c", "b of c"), ("x of  ", None), ("x Of y", "x Of y"),
    ], text.parties)


def test_decision_year(spark):
    check(spark, [
        ("31-02-2024", 2024), ("3rd March 2019", 2019), ("120190", 2019),
        ("2120-01-01", None), (None, None), ("", None), ("12-1999", 1999),
    ], dates.decision_year)


def test_decision_date(spark):
    check(spark, [
        ("2024-03-05 00:00:00", "2024-03-05"), ("05-03-2024", "2024-03-05"),
        ("5/3/2024", "2024-03-05"), ("05-03/2024", "2024-03-05"), ("31-02-2024", None),
        ("NaT", None), ("none", None), (" ", None), ("3rd March 2019", None),
        ("1899-01-01", None), ("2024-02-31", None), ("2024-13-01", None),
        ("00-01-2024", None), ("29-02-2024x", "2024-02-29"), ("\t2023-01-02", "2023-01-02"),
        (None, None), ("1-12-1950", "1950-12-01"), ("2024-00-10", None),
    ], dates.decision_date)


def test_decision_date_of_typed_columns(spark):
    out = spark.sql("SELECT DATE'2024-03-05' d, TIMESTAMP'2024-03-05 10:11:12' t").select(
        dates.decision_date("d").alias("d"), dates.decision_date("t").alias("t")).first()
    assert (out.d, out.t) == ("2024-03-05", "2024-03-05")


def test_judge_name(spark):
    check(spark, [
        ("HON'BLE MR. JUSTICE A B", "ab"), ("A B", "ab"), ("Mrs. X", "sx"),
        ("Mrinal Sen", "inalsen"), ("the chief justice R. K.", "rk"), ("Dr. Ms. Y", "y"),
        ("Chief Justice", ""), ("Honble Justice Z", "z"), ("Hon'ble Z", "honblez"),
        ("Justice\x01A", "a"),
    ], judges.judge_name)


def test_bench_type(spark):
    check(spark, [
        (None, None), ("Justice A", "single_judge"),
        ("A | HON'BLE MR. JUSTICE A", "single_judge"), ("A, B", "division_bench"),
        ("A; B and C", "full_bench"), ("A,B,C,D", "full_bench"),
        ("A,B,C,D,E", "constitution_bench"), ("Anand", "single_judge"),
        ("Justice", None), (", ;|", None), ("A AND B", "division_bench"),
        ("A, MR. JUSTICE B ; Mrs. C", "full_bench"), ("Éand", "single_judge"),
    ], judges.bench_type)


def case_type_of(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    out = case_types.with_case_type(df, "out", "v").orderBy("i").collect()
    return [r.out for r in out]


def test_case_type(spark):
    cases = [
        ("WP(C)/60/2023", "writ_petition"), ("WP(C)/438/2023", "anticipatory_bail"),
        ("habeas corpus writ petition", "habeas_corpus"), ("X Private Ltd", "tax_matter"),
        ("cancellation of the bail", "cancellation_of_bail"), ("xyz", None), ("", None),
        ("cancel the\nbail", "bail_application"), ("R.P.X", "review_petition"),
        ("éwp(c)", None), ("ARTICLE 226", "writ_petition"), ("crl.a 1", "criminal_appeal"),
    ]
    assert case_type_of(spark, [c[0] for c in cases]) == [c[1] for c in cases]


def test_every_case_type_pattern_agrees_with_python(spark):
    probes = []
    for label, pattern in case_types.CASE_TYPES:
        for piece in re.split(r"\|(?![^(]*\))", pattern):
            plain = re.sub(r"\(\?:([^|)]*)[^)]*\)\??", r"\1", piece)
            plain = plain.replace(r"\b", "").replace(r"\(", "(").replace(".{0,20}", "old ")
            plain = re.sub(r"\\\.\?|\\\.", ".", plain).replace(" ?", " ")
            probes += [plain, plain.upper(), f"x{plain}x", f"é{plain} é", f"No {plain} 7"]
    compiled = [(label, re.compile(p, re.I)) for label, p in case_types.CASE_TYPES]
    want = [next((lab for lab, p in compiled if p.search(t)), None) for t in probes]
    assert case_type_of(spark, probes) == want
    assert {w for w in want if w} == {label for label, _ in case_types.CASE_TYPES}


def test_backoff(spark):
    assert evaluate(spark, [1, 2, 3, 4, 5, 40], dates.backoff_seconds, "int") == [
        60, 120, 240, 480, 900, 900]


def python_human(n):
    v = float(n)
    units = ["B", "KiB", "MiB", "GiB", "TiB"]
    k = 0
    while v >= 1024 and k < 4:
        v, k = v / 1024, k + 1
    return f"{int(v)} B" if k == 0 else "%.1f %s" % (v, units[k])


def test_sizes(spark):
    values = [0, 1, 1023, 1024, 1280, 1792, 10239, 10240, 1048575, 1048576, 52428800,
              1073741824, 1342177280, 5 * 1024**4, 5000 * 1024**4, 10188]
    assert evaluate(spark, values, display.human_size, "bigint") == [
        python_human(v) for v in values]
    check(spark, [(None, "–"), (0, "0 B"), (1023, "1023 B"), (1280, "1.3 KiB"),
                  (10240, "10 KiB"), (10751, "10 KiB"), (10752, "11 KiB"),
                  (1048576, "1.0 MiB")], display.short_size, "bigint")


def test_share_and_clock(spark):
    row = spark.range(1).select(
        display.share_of_cap(F.lit(1), F.lit(3)).alias("a"),
        display.share_of_cap(F.lit(5), F.lit(0)).alias("b"),
        dates.clock(F.timestamp_seconds(F.lit(3723))).alias("c"),
        text.error_text(F.lit("e" * 700)).alias("d")).first()
    assert (row.a, row.b, row.c, len(row.d)) == (33.33, 0.0, "01:02:03", 500)


@pytest.mark.parametrize("value,kept", [
    ("https://x.example/", True), ("https://x.example/ (CNR 1)", False), ("ftp://x", False)])
def test_bare_url(spark, value, kept):
    assert evaluate(spark, [value], text.bare_url) == [value if kept else None]


def test_court_tables():
    assert len(COURT_NAMES) == 25 and set(COURT_NAMES) == set(COURT_STATES)
