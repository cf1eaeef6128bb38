"""Prefix trie, Merkle manifest and secret scan on odd tables, against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from docketflow.llm import frames, merkle, prefix_trie, ranks, secrets


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is not None, x) for x in r))


# Places in groups.

def test_places_in_groups_over_many_partitions(spark):
    frames.importable(spark)
    rnd = random.Random(1)
    rows = [("hot", rnd.choice([None, 1, 2, 3]), i) for i in range(400)]
    rows += [(f"g{i % 40}", i, i) for i in range(200)] + [("alone", None, -1)]
    df = spark.createDataFrame(rows, "g string, at int, other int").repartition(7)
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")
    try:
        got = ranks.numbered(df, "g", ["at"]).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted((r.g, r.other) for r in got) == sorted((g, o) for g, _, o in rows)
    groups = defaultdict(list)
    for r in got:
        groups[r.g].append((r.pos, r["at"] or 0))
    for members in groups.values():
        members.sort()
        assert [p for p, _ in members] == list(range(len(members)))
        assert [a for _, a in members] == sorted(a for _, a in members)


# Operator 11.

def brute_trie(rows):
    conv, seqs = defaultdict(list), {}
    for c, t, role, text in rows:
        role, text = role or "", text or ""
        tie = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
        if c is not None:
            conv[c].append(((t is not None, t or 0), tie, (role, text)))
    for c in conv:
        conv[c].sort()
    for c, own in conv.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = conv.get(c - int(math.fmod(c, 100)), [])
        seqs[c] = tuple(x[2] for x in base[:h] + own[h:])
    nodes, kids, leaves, saved = defaultdict(list), Counter(), Counter(), Counter()
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            nodes[s[:d]].append(c)
    for s in nodes:
        if s:
            kids[s[:-1]] += 1
    for s, members in nodes.items():
        for d in range(len(s) + 1):
            leaves[s[:d]] += not kids[s]
            saved[s[:d]] += (len(members) - 1) * len(s[-1][1]) if s else 0
    out = []
    for s, members in nodes.items():
        ends = ",".join(map(str, sorted(c for c in members if len(seqs[c]) == len(s))))
        out.append((min(members), len(s), min(nodes[s[:-1]]) if s else None, len(members), kids[s],
                    leaves[s], saved[s], hashlib.sha256(ends.encode()).hexdigest()))
    return ordered(out)


def trie_rows():
    rnd = random.Random(3)
    rows = [(100, t, "user", f"gleich {t}") for t in range(8)]
    for c in range(101, 160):  # branches, prefixes of others, and equal sequences
        rows += [(c, t, "user" if t % 2 else "bot", f"w{rnd.randint(0, 1)}") for t in range(rnd.randint(1, 9))]
    for c in (301, 402, 407, 511):  # long shared runs over several blocks; two of them stay equal
        rows += [(c, t, "r", f"lang {min(t, 700)}") for t in range(900 if c == 511 else 130)]
    rows += [(408, t, "r", f"lang {t}" if t < 70 else "x") for t in range(131)]
    rows += [(200, None, None, "é🙂"), (200, None, "a", None), (200, 1, "", ""), (200, 1, "", ""),
             (-7, 2, "neg", "a"), (-107, 1, "neg", "a"), (None, 1, "no", "conv"), (77, 5, "x", "y" * 70_000)]
    rows += [(1000 + c, t, "same", "turn") for c in range(90) for t in range(6)]
    return rows


TURNS = "conv_id bigint, turn int, role string, text string"


@pytest.mark.parametrize("batch", ["23", "10000"])
def test_trie_against_brute_force(spark, batch):
    rows = trie_rows()
    df = frames.importable(spark).createDataFrame(rows, TURNS).withColumn("cls", F.lit(1)).withColumn(
        "keys", F.lit("clash")).repartition(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = prefix_trie.conversation_trie(df)
        assert got.columns == prefix_trie.NAMES
        assert ordered(got.collect()) == brute_trie(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_trie_of_an_empty_table(spark):
    none = frames.importable(spark).createDataFrame([], TURNS)
    assert prefix_trie.conversation_trie(none).count() == 0
    assert prefix_trie.conversation_trie(spark.createDataFrame([(None, 1, "a", "b")], TURNS)).count() == 0


def test_blocks_of_turns(spark):
    turns = spark.range(2000)
    got = [r[0] for r in turns.select(prefix_trie.block_of(F.col("id"))).collect()]
    for turn, block in enumerate(got):
        assert prefix_trie.block_start(block) <= turn < prefix_trie.block_start(block + 1)


# Operator 12.

def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_manifest(rows):
    def leaf(row):
        return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])

    def tree(leaves):
        levels = [leaves]
        while len(levels[-1]) > 1:
            x = levels[-1]
            levels.append([sha(*x[i : i + 3]) for i in range(0, len(x), 3)])
        return levels

    def steps(levels, i):
        out = []
        for x in levels[:-1]:
            lo = i // 3 * 3
            out.append(("".join(x[lo:i]), "".join(x[i + 1 : lo + 3])))
            i //= 3
        return out

    groups = defaultdict(list)
    for row in rows:
        groups[row[1]].append((row[0] is not None, row[0] or 0, leaf(row), row))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for s in order:
        groups[s].sort(key=lambda x: x[:3])
    trees = {s: tree([x[2] for x in groups[s]]) for s in order}
    top = tree([trees[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for j, (_, _, mine, row) in enumerate(groups[s]):
            way, now = steps(trees[s], j) + steps(top, k), mine
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[4] is not None:
                now = leaf((*row[:4], row[4].replace("\n", "")))
            for before, after in way:
                now = sha(before, now, after)
            out.append((row[0], mine, trees[s][-1][0], top[-1][0], sha(*[x for p in way for x in p]),
                        now, now == top[-1][0]))
    return ordered(out)


LEAVES = "doc_id bigint, source string, lang string, n_chars bigint, text string"
ODD_LEAVES = [
    (None, None, "x", 1, "a\nb"), (None, None, "x", 1, "a\nb"), (1, None, None, None, None), (1, "", "x", 2, "q\n"),
    (7, "z", "x", 2, ""), (8, "z", "y", 3, "n\n\n"), (8, "z", "y", 3, "n\n\n"), (9, "é", "-", -3, "🙂\n"),
    (10, "zz", "y", 3, "lang " * 40_000 + "\n"), (11, "1:a", "y", None, "\n")]


@pytest.mark.parametrize("rows", [
    ODD_LEAVES, ODD_LEAVES[:1], ODD_LEAVES[:1] * 4,
    ODD_LEAVES + [(i, "hot", "de", i, f"t\n{i}") for i in range(3000)] + [(5, f"s{i}", None, 1, "x") for i in range(30)]],
    ids=["odd", "one", "repeated", "hot"])
def test_manifest_against_brute_force(spark, rows):
    docs = frames.importable(spark).createDataFrame(rows, LEAVES).withColumn("tree", F.lit("clash")).withColumn(
        "pos", F.lit(3)).withColumn("leaf", F.lit("x")).repartition(4)
    assert ordered(merkle.dataset_manifest(docs).collect()) == brute_manifest(rows)


def test_manifest_of_an_empty_table(spark):
    assert merkle.dataset_manifest(frames.importable(spark).createDataFrame([], LEAVES)).count() == 0


def test_multiproof_of_some_leaves(spark):
    rows = [(i, f"s{i % 3}", "de", i, f"text {i}") for i in range(500)]
    manifest = merkle.build(merkle.document_leaves(frames.importable(spark).createDataFrame(rows, LEAVES)))
    some = manifest.leaves.where("doc_id IN (0, 3, 4, 250, 499)")
    got = {r.doc_id: r for r in merkle.proven(manifest, some, ["doc_id"]).collect()}
    want = {r[0]: r for r in brute_manifest(rows)}
    assert set(got) == {0, 3, 4, 250, 499}
    for doc, row in got.items():
        assert (row.leaf, row.subroot, manifest.root, row.proof_sha256) == want[doc][1:5]


def test_least_set_of_missing_nodes():
    for n in (1, 2, 3, 4, 28, 100):
        for wanted in ([0], [n - 1], [0, n // 2], list(range(n))):
            missing = merkle.missing_nodes(np.array(wanted), n)
            have, size, level, left = set(wanted), n, 0, set(missing)
            while size > 1:
                runs = {3 * (i // 3) + k for i in have for k in range(3)} & set(range(size))
                assert {(level, i) for i in runs - have} == {x for x in left if x[0] == level}
                have, size, level = {i // 3 for i in have}, -(-size // 3), level + 1
            assert len(missing) == len(left) and (n == len(wanted)) <= (not missing)


# Operator 13.

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ALPHABETS = [DIGITS, DIGITS + "abcdef", DIGITS + "ABCDEF", UPPER + "234567", DIGITS + LOWER, DIGITS + UPPER,
             DIGITS + UPPER + LOWER, UPPER + LOWER + DIGITS + "+/", UPPER + LOWER + DIGITS + "-_"]


def battery(token):
    """(stratum, bits of evidence)."""
    n = len(token)
    kind = next((i for i, a in enumerate(ALPHABETS) if set(token) <= set(a)), None)
    stratum = (kind, n.bit_length())
    if kind is None:
        return stratum, 0
    m, v = len(ALPHABETS[kind]), [ALPHABETS[kind].index(c) for c in token]
    mean = sum(v) / n
    spread = sum((x - mean) ** 2 for x in v)
    k = max(2, min(16, m, n // 5))
    seen, sizes = Counter(x * k // m for x in v), Counter(x * k // m for x in range(m))
    chi = sum((seen[b] - n * sizes[b] / m) ** 2 / (n * sizes[b] / m) for b in range(k))
    half = [2 * x >= m for x in v]
    pairs = 2 * sum(half) * (n - sum(half))
    if spread == 0 or pairs <= n:
        return stratum, 0
    runs = 1 + sum(a != b for a, b in zip(half, half[1:], strict=False))
    z_runs = (runs - pairs / n - 1) / math.sqrt(pairs * (pairs - n) / (n * n * (n - 1)))
    serial = sum((a - mean) * (b - mean) for a, b in zip(v, v[1:], strict=False)) / spread
    z = [math.sqrt(2 * chi) - math.sqrt(2 * k - 3), abs(z_runs), abs((serial + 1 / n) * math.sqrt(n))]
    classes = [(c in DIGITS) + 2 * (c in LOWER) + 4 * (c in UPPER) for c in token]
    rate = sum(a != b for a, b in zip(classes, classes[1:], strict=False)) / (n - 1)
    if max(z) > 3 or rate <= 0.2:
        return stratum, 0
    rest = (1 - rate) * math.log2((1 - rate) / 0.8) if rate < 1 else 0
    return stratum, min(60, math.floor((n - 1) * (rate * math.log2(rate / 0.2) + rest)))


def brute_secrets(rows):
    base, runs = [], []
    for _, text in rows:
        text = text or ""
        found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
        found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
        found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
        base.append(sorted(found))
        runs.append([(m.start(), m.end(), m[0]) for m in re.finditer("[A-Za-z0-9+/_-]{20,}", text)])
    score = {t: battery(t) for row in runs for *_, t in row}
    strata, least = defaultdict(list), {}
    for stratum, bits in score.values():
        strata[stratum].append(bits)
    for stratum, bits in strata.items():
        least[stratum] = next((b for b in range(1, 61) if len(bits) <= 0.01 * sum(x >= b for x in bits) * 2**b), 99)
    names, out = ["assign", "access", "hex", "random"], []

    def said(spans):
        return ",".join(f"{names[k]}:{a}:{b}" for a, k, b in spans)

    for (doc, _), known, row in zip(rows, base, runs, strict=True):
        more = [(a, 3, b) for a, b, t in row if score[t][1] >= least[score[t][0]]
                and not any(x <= a and b <= y for x, _, y in known)]
        counts = [sum(k == i for _, k, _ in known) for i in range(3)]
        out.append((doc, *counts, sha(said(known)), said(sorted(known + more))))
    return ordered(out)


def secret_rows():
    rnd = random.Random(5)
    pick = UPPER + LOWER + DIGITS + "+/"
    rows = [
        (None, None), (None, "token=abcdefgh"), (1, ""), (1, "token: secret: abcdefghijk"), (1, ""),
        (2, "ÄÖ🙂 password = \"hunter2hunter2\" AKIAABCDEFGH2345 " + "0" * 40), (2, "AKIA" + "AKIA" * 3),
        (3, "ſecret=abcdefgh1234 toKen=abcdefgh1234 Key api-key=x APIKEY:'kurz' apikey:'länger99'"),
        (4, "wort " * 30_000 + "secret=" + "a" * 8 + " " + "ab" * 20_000), (5, "-" * 50 + "_" * 20 + "1" * 30)]
    rows += [(10 + i, f"é🙂 {''.join(rnd.choices(pick[: (16, 36, 62, 64)[i % 4]], k=rnd.randint(18, 90)))} und")
             for i in range(300)]
    rows += [(500 + i, f"pfad {'/'.join(''.join(rnd.choices(LOWER[:8], k=5)) for _ in range(8))} "
              f"{''.join(rnd.choices(LOWER[:16], k=30))} CamelCaseWordsInARow{i} x{'-' * i}") for i in range(100)]
    rows += [(900 + i, " ".join("".join(rnd.choices(DIGITS + "abcdef", k=k)) for k in (22, 25, 31)))
             for i in range(50)]
    return rows


def test_secrets_against_brute_force(spark):
    rows = secret_rows()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("row", F.lit(1)).withColumn(
        "kind", F.lit("clash")).repartition(3)
    got = ordered(secrets.secret_spans(docs).collect())
    assert got == brute_secrets(rows)
    added = [r[0] for r in got if "random" in r[-1]]
    assert sum(10 <= (d or 0) < 310 for d in added) > 100  # random strings are found
    assert not any(500 <= (d or 0) < 600 for d in added)  # paths, words and rules are not


def test_secrets_of_an_empty_table(spark):
    assert secrets.secret_spans(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
