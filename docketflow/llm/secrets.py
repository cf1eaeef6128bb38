"""Secrets in texts: known shapes, and strings that pass a battery of randomness tests.

Column expressions, joins and windows only.  Every run of ``SHORTEST`` or more characters of base 64 is
a candidate.  The narrowest encoding that holds all its characters is inferred, and its characters
become numbers of that alphabet.  Uniform random numbers are refused when one of three tests refuses
them at ``Z_LIMIT``: a chi-squared test of alphabet uniformity over bins of five expected characters or
more, a test of runs above and below the middle, and a test of serial correlation.

Passing is weak evidence in a short string, so false discoveries are controlled against ordinary
strings, whose neighbouring characters differ in class (digit, lower, upper, other) in at most
``ORDINARY_CHANGES`` of all places.  The evidence against that is a Chernoff bound of the binomial tail
in whole bits, which a short string can't make large; none is left to strings that the battery refused.
Benjamini and Hochberg's rule at ``FALSE_RATE`` then runs over the distinct candidates of all documents,
in every stratum of encoding and octave of length by itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docketflow.llm.frames import settle

#: Patterns of the base, in the order of the kinds; access and hex state the least length they keep.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LENGTH = 8
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = ["assign", "access", "hex", "random"]

SHORTEST = 20
Z_LIMIT = 3.0
ORDINARY_CHANGES = 0.2
FALSE_RATE = 0.01
MOST_BITS = 60
MOST_BINS = 16

_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Encodings from narrow to wide: name, characters as a class, alphabet in the order of its numbers.
ENCODINGS = [
    ("base10", "0-9", _DIGITS),
    ("base16", "0-9a-f", _DIGITS + "abcdef"),
    ("base16_upper", "0-9A-F", _DIGITS + "ABCDEF"),
    ("base32", "A-Z2-7", _UPPER + "234567"),
    ("base36", "0-9a-z", _DIGITS + _LOWER),
    ("base36_upper", "0-9A-Z", _DIGITS + _UPPER),
    ("base62", "0-9A-Za-z", _DIGITS + _UPPER + _LOWER),
    ("base64", "0-9A-Za-z+/", _UPPER + _LOWER + _DIGITS + "+/"),
    ("base64url", "0-9A-Za-z_-", _UPPER + _LOWER + _DIGITS + "-_"),
]
_NUMBERS = "".join(chr(48 + i) for i in range(64))
_CLASSED = _DIGITS + _LOWER + _UPPER + "+/_-"
_CLASSES = "0" * 10 + "1" * 26 + "2" * 26 + "3333"


def _matches(text: Column, kind: int, pattern: str) -> Column:
    """Of every match: its kind, the characters since the match before it, its own, and its string."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    kept = F.transform(found, lambda x: F.lit(True))
    if kind == 0:
        kept = F.transform(
            F.regexp_extract_all(text, F.lit(pattern), F.lit(2)), lambda x: F.length(x) >= ASSIGN_LENGTH)
    strings = found if kind == 3 else F.transform(found, lambda x: F.lit(None).cast("string"))
    rows = F.arrays_zip(
        F.transform(found, lambda x: F.lit(kind)).alias("kind"), F.slice(gaps, F.lit(1), F.size(found)).alias("gap"),
        F.transform(found, F.length).alias("size"), kept.alias("kept"), strings.alias("token"))
    return F.when(text.rlike(pattern), rows)


def found_spans(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(row, doc_id) of every document, and the spans (row, kind, start, stop, token) in them.

    Texts are read once; what is found in them is written, and offsets are sums over a document's
    matches of one kind.  Tokens are kept of candidates only.
    """
    text = F.coalesce("text", F.lit(""))
    run = f"[A-Za-z0-9+/_-]{{{SHORTEST},}}"
    patterns = [ASSIGN, ACCESS, HEX, run]
    found = settle(docs.select("doc_id", text.alias("text")).select(
        F.monotonically_increasing_id().alias("row"), "doc_id",
        F.concat(*[F.coalesce(_matches(F.col("text"), k, p), F.array()) for k, p in enumerate(patterns)]
                 ).alias("found")))
    hits = found.where(F.size("found") > 0).select("row", F.posexplode("found").alias("i", "m")).select(
        "row", "i", "m.*")
    upto = F.sum(F.col("gap") + F.col("size")).over(W.partitionBy("row", "kind").orderBy("i"))
    spans = hits.withColumn("stop", upto.cast("bigint")).where("kept").select(
        "row", "kind", (F.col("stop") - F.col("size")).alias("start"), "stop", "token")
    return found.select("row", "doc_id"), settle(spans)


def _first(conditions: list[tuple[Column, Column]], other: Column) -> Column:
    for condition, value in reversed(conditions):
        other = F.when(condition, value).otherwise(other)
    return other


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda a, x: a + F.coalesce(x, F.lit(0)))


def _div(x: Column, y: Column) -> Column:
    """Whole quotient of numbers that are not negative."""
    return ((x - x % y) / y).cast("bigint")


def _square(x: Column) -> Column:
    return x * x


def _neighbours(values: str, join) -> Column:
    return F.zip_with(values, F.slice(values, F.lit(2), F.greatest(F.size(values) - 1, F.lit(1))), join)


def scores(tokens: DataFrame) -> DataFrame:
    """Encoding, length class, whether the battery refuses randomness, and bits of evidence per token.

    ``tokens`` has distinct strings of the base 64 alphabets; strings that mix both of them, which no
    encoding holds, and all that the battery refuses have no evidence.
    """
    holds = [(F.col("token").rlike(f"^[{chars}]+$"), name, alphabet) for name, chars, alphabet in ENCODINGS]
    rows = tokens.select(
        "token",
        _first([(c, F.lit(name)) for c, name, _ in holds], F.lit("mixed")).alias("encoding"),
        _first([(c, F.lit(len(a))) for c, _, a in holds], F.lit(64)).alias("m"),
        _first([(c, F.translate("token", a, _NUMBERS[: len(a)])) for c, _, a in holds], F.lit("")).alias("numbers"),
        F.filter(F.split(F.translate("token", _CLASSED, _CLASSES), ""), lambda x: x != "").alias("classes"),
    ).select(
        "token", "encoding", F.col("m").cast("bigint"), "classes", F.size("classes").cast("bigint").alias("n"),
        F.transform(F.filter(F.split("numbers", ""), lambda x: x != ""),
                    lambda x: F.ascii(x).cast("bigint") - 48).alias("v"))
    half = F.transform("v", lambda x: (2 * x >= F.col("m")).cast("bigint"))
    rows = rows.withColumn("half", half).select(
        "token", "encoding", "m", "n", "v",
        F.greatest(F.lit(2), F.least(F.lit(MOST_BINS), F.col("m"), F.expr("n DIV 5"))).cast("bigint").alias("k"),
        _total(F.col("v")).cast("double").alias("s"),
        _total(F.transform("v", lambda x: x * x)).cast("double").alias("q"),
        _total(_neighbours("v", lambda a, b: a * b)).cast("double").alias("x"),
        (F.get("v", F.lit(0)) + F.element_at("v", -1)).cast("double").alias("ends"),
        _total(F.col("half")).cast("double").alias("high"),
        (1 + _total(_neighbours("half", lambda a, b: (a != b).cast("bigint")))).cast("double").alias("runs"),
        _total(_neighbours("classes", lambda a, b: (a != b).cast("bigint"))).cast("double").alias("changes"))
    n, high = F.col("n").cast("double"), F.col("high")
    in_bins = F.transform("v", lambda x: _div(x * F.col("k"), F.col("m")))
    uneven = F.aggregate(
        F.sequence(F.lit(0).cast("bigint"), F.col("k") - 1), F.lit(0.0),
        lambda a, b: a + _square(F.size(F.filter("bins", lambda x: x == b)).cast("double"))
        * F.col("m").cast("double") / (n * _symbols(b)))
    rows = rows.withColumn("bins", in_bins).withColumn("chi", F.greatest(uneven - n, F.lit(0.0)))
    pairs = 2.0 * high * (n - high)
    spread = n * n * F.col("q") - n * F.col("s") * F.col("s")
    drift = (n * n * F.col("x") - n * F.col("s") * (2.0 * F.col("s") - F.col("ends"))
             + (n - 1.0) * F.col("s") * F.col("s"))
    rows = rows.select(
        "token", "encoding", "n", "changes", "chi", "k", "runs",
        pairs.alias("pairs"), spread.alias("spread"), drift.alias("drift"))
    z_chi = F.sqrt(2.0 * F.col("chi")) - F.sqrt(2.0 * F.col("k").cast("double") - 3.0)
    z_runs = (F.col("runs") - (F.col("pairs") / n + 1.0)) / F.sqrt(
        F.col("pairs") * (F.col("pairs") - n) / (n * n * (n - 1.0)))
    z_serial = (F.col("drift") / F.col("spread") + 1.0 / n) * F.sqrt(n)
    flat = (F.col("encoding") == "mixed") | (F.col("pairs") <= n) | (F.col("spread") <= 0)
    refused = flat | F.when(~flat, (z_chi > Z_LIMIT) | (F.abs(z_runs) > Z_LIMIT) | (F.abs(z_serial) > Z_LIMIT))
    rate = F.col("changes") / (n - 1.0)
    rest = F.when(rate < 1.0, (1.0 - rate) * F.ln((1.0 - rate) / (1.0 - ORDINARY_CHANGES))).otherwise(0.0)
    bits = (n - 1.0) * (rate * F.ln(rate / ORDINARY_CHANGES) + rest) / F.ln(F.lit(2.0))
    return rows.withColumn("refused", refused).select(
        "token", "encoding", F.length(F.bin("n")).alias("octave"), "refused",
        F.when(F.col("refused") | (rate <= ORDINARY_CHANGES), 0)
        .otherwise(F.least(F.floor(bits), F.lit(MOST_BITS))).cast("int").alias("bits"))


def _symbols(b: Column) -> Column:
    """How many of the alphabet's ``m`` numbers fall into bin ``b`` of ``k``."""
    k, m = F.col("k"), F.col("m")

    def below(x: Column) -> Column:
        return _div(x * m + k - 1, k)

    return (below(b + 1) - below(b)).cast("double")


def thresholds(scored: DataFrame) -> DataFrame:
    """The least bits that count as a discovery, per encoding and octave that has any.

    Of a stratum's M strings those with b bits or more, N of them, are discoveries for the least b
    with M * 2^-b <= rate * N.  Rows are bounded by encodings x octaves x bits.
    """
    counts = settle(scored.groupBy("encoding", "octave", "bits").agg(F.count("*").alias("n")))
    stratum = W.partitionBy("encoding", "octave")
    return counts.select(
        "encoding", "octave", "bits", F.sum("n").over(stratum).alias("all"),
        F.sum("n").over(stratum.orderBy(F.desc("bits"))).alias("upto"),
    ).where((F.col("bits") > 0) & (F.col("all") <= FALSE_RATE * F.col("upto") * F.pow(F.lit(2.0), "bits"))
            ).groupBy("encoding", "octave").agg(F.min("bits").alias("least"))


def discoveries(spans: DataFrame) -> DataFrame:
    """(token) of the candidates among ``spans`` that are secrets."""
    scored = settle(scores(spans.where("kind = 3").select("token").distinct()))
    return settle(scored.join(F.broadcast(thresholds(scored)), ["encoding", "octave"]).where(
        "bits >= least").select("token"))


def _joined(rows: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(rows, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def secret_spans(docs: DataFrame) -> DataFrame:
    """One row per document: n_assign, n_access, n_hex, base_sha256 and spans.

    Spans are kind:start:stop in code points, by start, then kind.  A discovery inside a span of the
    base adds nothing.  Null and empty texts have no spans; rows count each for itself, whatever ids
    they share, and other columns take no part.
    """
    rows, spans = found_spans(docs)
    added = spans.where("kind = 3").join(discoveries(spans), "token").select("row", "kind", "start", "stop")
    every = spans.where("kind < 3").select("row", "kind", "start", "stop").unionAll(added)
    covered = F.max(F.when(F.col("kind") < 3, F.col("stop"))).over(
        W.partitionBy("row").orderBy("start", "kind").rowsBetween(W.unboundedPreceding, 0))
    kept = every.withColumn("covered", covered).where(
        "kind < 3 OR covered IS NULL OR covered < stop")
    span = F.struct("start", "kind", "stop")
    per_row = kept.groupBy("row").agg(
        *[F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{KINDS[k]}") for k in range(3)],
        F.sort_array(F.collect_list(F.when(F.col("kind") < 3, span))).alias("base"),
        F.sort_array(F.collect_list(span)).alias("all"))
    return rows.join(per_row, "row", "left").select(
        "doc_id", *[F.coalesce(f"n_{k}", F.lit(0).cast("bigint")).alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(F.coalesce(_joined(F.col("base")), F.lit("")), 256).alias("base_sha256"),
        F.coalesce(_joined(F.col("all")), F.lit("")).alias("spans"))
