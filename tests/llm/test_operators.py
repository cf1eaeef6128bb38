"""Every operator on small odd tables, against brute force or the libraries."""

import base64
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from docketflow.llm import (
    byte_bpe, frames, line_dedup, near_dedup, packing, quality_model, rules, token_counts,
    token_files, top_k, warc)
from docketflow.llm.shared_files import opened

WORD = re.compile(r"[^\x20\x09-\x0D]+")
WORDS, BYTES, MULTI = (public_tokenizers.path(x) for x in (
    "word_bpe_49k.json", "byte_bpe_50k.json", "byte_bpe_multi_50k.tiktoken"))
BASE = " ".join(f"wort{i} Straße{i % 7}" for i in range(60))
TEXTS = [
    (3, BASE), (1, BASE), (2, BASE + " mehr"), (7, BASE.replace("wort30 ", "anders ")), (5, None), (6, ""),
    (8, " \n\t "), (9, "eins zwei"), (10, "EINS  zwei"), (None, "ohne id hier"), (None, BASE),
    (12, "a a a a a a a a a a a a"), (12, "a a a a a a a a a a a a"),
    (13, "Zeile mit genau sechs Wörtern hier.\nkurz\n" * 4 + "Schluss"),
    (14, "x" * 70_000), (15, "lang " * 30_000), (16, "<|endoftext|> a<|startoftext|>b  \n\n c"),
    (17, "日本語 ΣΑΣ İst ́e \x1c\x85 🙂 it's 12½"), (18, "#*$%&|<> ### don't\r\nüber　weit"),
    (-4, "negative id"), (19, "\x00\x01 ﻿"),
]
SCHEMA = "doc_id bigint, text string, node string, score string, label int"


@pytest.fixture(scope="module")
def docs(spark):
    frames.importable(spark)
    rows = [(i, t, "clash", None, 1) for i, t in TEXTS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


def by_id(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is not None, x) for x in r))


def shingles(text, n):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if 0 < len(words) < n:
        return {tuple(words)}
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def brute_groups(rows, n, percent):
    sets = [shingles(t, n) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [d for (d, _), g in zip(rows, group, strict=True) if g == group[i] and d is not None]
        least = min(ids, default=None)
        out.append((doc, len(sets[i]), least, doc == least))
    return out


@pytest.mark.parametrize("n,percent", [(3, 85), (5, 80)])
def test_near_groups(docs, none, n, percent):
    got = near_dedup.near_groups(docs, n, percent).collect()
    assert by_id(got) == by_id(brute_groups(TEXTS, n, percent))
    assert near_dedup.near_groups(none, n, percent).count() == 0


def test_near_groups_in_small_blocks(spark, monkeypatch):
    """Near copies around the limit, with blocks and pieces so small that all are cut."""
    rng = np.random.default_rng(5)
    rows, base = [], [f"w{i}" for i in range(120)]
    for i in range(90):
        text = list(base)
        for at in rng.integers(0, 120, rng.integers(0, 6)):
            text[at] = f"x{rng.integers(1000)}"
        rows.append((i, " ".join(text)))
    rows += [(100 + i, " ".join(f"v{rng.integers(50)}" for _ in range(40))) for i in range(30)]
    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    monkeypatch.setattr(frames, "PIECE", 25)
    frames.importable(spark)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = near_dedup.near_groups(df, 3, 85).collect()
    assert by_id(got) == by_id(brute_groups(rows, 3, 85))


def test_bands_keep_pairs_at_the_limit():
    for percent in (80, 85, 95):
        bands = near_dedup.bands_for(percent)
        assert near_dedup.beyond(4 * bands, 1 - percent / 100, 2 * bands - 1) <= near_dedup.MISS


def test_hamming_index_finds_all_pairs_within_the_distance():
    bands = 3
    rng = np.random.default_rng(0)
    a = rng.integers(0, 1 << 16, (200, 4 * bands))
    b = a.copy()
    for row in b:
        row[rng.choice(4 * bands, rng.integers(0, 2 * bands), replace=False)] += 1
    keys = [
        {(c, o, tuple(np.delete(row[4 * c : 4 * c + 4], o))) for c in range(bands) for o in range(4)}
        for row in (*a, *b)]
    assert all(keys[i] & keys[200 + i] for i in range(200))


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 100), (7, 7), (None, 3), (200, 5)]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    for piece in (3, 1000):
        frames.PIECE, old = piece, frames.PIECE
        try:
            got = {r.node: r.root for r in frames.components(df).collect()}
        finally:
            frames.PIECE = old
        assert got == {**{i: 0 for i in range(41)}, 200: 0, 100: 100, 101: 100}
    assert frames.components(df.where("false")).count() == 0


def test_token_counts(docs, none):
    library = Tokenizer.from_file(WORDS)
    want = [(i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids),
             n > 2048) for i, t in TEXTS]
    assert by_id(token_counts.token_counts(docs, WORDS).collect()) == by_id(want)
    assert token_counts.token_counts(none, WORDS).count() == 0


def test_byte_bpe(docs, none):
    ranks = byte_bpe.ranks_of(MULTI)
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for i, t in TEXTS:
        ids = library.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()))
    got = byte_bpe.round_trip(docs, MULTI, public_tokenizers.PATTERN).collect()
    assert by_id(got) == by_id(want)
    assert byte_bpe.round_trip(none, MULTI, public_tokenizers.PATTERN).count() == 0


def test_token_files(docs, none):
    library = Tokenizer.from_file(BYTES)
    rows = sorted(TEXTS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    want, start = [], 0
    for i, t in rows:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    manifest = frames.settle(token_files.write_tokens(docs, BYTES, 2, parts=3))
    found = token_files.read_digests(manifest).collect()
    assert by_id(r[:4] for r in found) == by_id(want)
    places = docs.sparkSession.createDataFrame(
        [(r.path, r.nth) for r in found if r.doc_id in (1, 9)], "path string, nth bigint")
    ids = {len(r.ids) for r in token_files.fetch_tokens(places).collect()}
    assert ids == {n for i, _, n, _ in want if i in (1, 9)}
    assert token_files.read_digests(token_files.write_tokens(none, BYTES, 2)).count() == 0


def test_token_file_reads_only_what_is_asked(tmp_path, monkeypatch):
    import zstandard

    monkeypatch.setattr(token_files, "FRAME_BYTES", 64)
    path = tmp_path / "x.zst"
    docs = [(i, np.arange(i % 40, dtype="<u4").tobytes()) for i in range(100)]
    with open(path, "wb") as out:
        writer = token_files.TokenWriter(out)
        for row in docs:
            writer.add(*row)
        writer.close()
    with opened(str(path)) as source:
        file = token_files.TokenFile(source)
        assert list(file.read([39]))[0][1] == docs[39][1]
        assert file.frames <= 4 < len(file.checksums)
        assert [x for _, x in file.read(range(100))] == [x for _, x in docs]
    with open(path, "rb") as f:  # a plain reader sees the ids in order
        plain = zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read()
    assert plain == b"".join(x for _, x in docs)
    raw = bytearray(path.read_bytes())
    raw[20] ^= 1
    path.write_bytes(raw)
    with opened(str(path)) as source, pytest.raises((ValueError, zstandard.ZstdError)):
        list(token_files.TokenFile(source).read(range(100)))


def test_packing(docs, none):
    library = Tokenizer.from_file(WORDS)
    got = packing.pack(docs, WORDS).collect()
    want = Counter()
    for i, t in TEXTS:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 1]
        for k, lo in enumerate(range(0, len(ids), 4096)):
            raw = np.array(ids[lo : lo + 4096], "<u4").tobytes()
            want[i, k, lo, len(raw) // 4, zlib.crc32(raw)] += 1
    assert Counter(tuple(r[:5]) for r in got) == want
    held = defaultdict(list)
    for r in got:
        held[r.sequence_id].append((r.offset, r.length))
    for rows in held.values():
        rows.sort()
        assert [o for o, _ in rows] == [sum(n for _, n in rows[:k]) for k in range(len(rows))]
        assert sum(n for _, n in rows) <= 4096
    assert len(held) <= math.ceil(sum(r.length for r in got) / 4096) + 1
    assert packing.pack(none, WORDS).count() == 0
    whole = packing.sequences(docs, WORDS).collect()
    assert sum(len(r.ids) for r in whole) == sum(r.length for r in got)


def test_packing_plans():
    rng = np.random.default_rng(1)
    for size in (1, 7, 300, 30_000):
        counts = np.bincount(np.minimum(rng.lognormal(6, 1.3, size).astype(int) + 1, 4096), minlength=4097)
        plan = packing.planned(counts, 4096)
        assert not plan.left.any()
        assert plan.sequences <= math.ceil((counts * np.arange(4097)).sum() / 4096) * 1.05 + 2
    assert packing.planned(np.zeros(4097, np.int64), 4096).sequences == 0


def test_repetition(docs, none):
    def brute(text):
        words = WORD.findall(text or "")
        seen = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
        inside = set()
        for i in range(len(words) - 4):
            if seen[tuple(words[i : i + 5])] > 1:
                inside |= set(range(i, i + 5))
        lines, dups = set(), 0
        for line in (text or "").split("\n"):
            if WORD.search(line):
                dups += line in lines
                lines.add(line)
        return (len(words), sum(map(len, words)), sum(c in rules.SYMBOLS for c in text or ""),
                dups, len(inside))

    got = rules.judge(docs).select("doc_id", *rules.COUNTS[:5]).collect()
    assert by_id(got) == by_id((i, *brute(t)) for i, t in TEXTS)
    kept = Counter((r.doc_id, r.kept) for r in rules.judge(docs).collect())
    assert by_id(Counter(r.doc_id for r in rules.keep_good(docs).collect()).items()) == by_id(
        ((i, n) for (i, k), n in kept.items() if k))
    assert rules.keep_good(docs).schema == docs.schema
    assert rules.judge(none).count() == 0


def test_quality_model_holds_out_and_learns(spark, sf_dir):
    docs = frames.table(frames.importable(spark), sf_dir.replace("sf0.001", "sf0.01"), "documents")
    labels = frames.table(spark, sf_dir.replace("sf0.001", "sf0.01"), "labels")
    model = quality_model.train(docs, labels)
    rows = quality_model.scored(docs, model).join(labels, "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows)
    good = [r.score for r in rows if r.quality == 1]
    bad = [r.score for r in rows if r.quality == 0]
    wins = np.mean([g > b for g in good for b in bad])
    assert wins > 0.93
    flipped = labels.withColumn("quality", F.when(quality_model.held_out(), 1 - F.col("quality"))
                                .otherwise(F.col("quality")))
    again = quality_model.train(docs, flipped)
    x = np.zeros((1, len(quality_model.FEATURES)))
    assert again.scores(x) == model.scores(x)


def test_quality_model_on_odd_tables(docs, none, spark):
    labels = spark.createDataFrame(
        [(1, 1), (3, 0), (1, None), (None, 1), (14, 0)], "doc_id bigint, quality int")
    for known in (labels, labels.where("false"), labels.where("quality = 1")):
        rows = quality_model.scored(docs, quality_model.train(docs, known)).collect()
        assert len(rows) == len(TEXTS) and all(0 <= r.score <= 1 for r in rows)
    assert quality_model.scored(none, quality_model.train(none, labels)).count() == 0


def brute_top(rows, every, k):
    whole = []
    for i, x in rows:
        if i is not None and x is not None and all(c is not None and math.isfinite(c) for c in x):
            whole.append((i, [math.floor(256 * c) for c in x]))
    out = []
    for q, x in whole:
        if q % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(x, y, strict=False)), i) for i, y in whole if i != q)
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return out


def test_top_k(spark):
    rng = np.random.default_rng(2)
    same = [0.5] * 4
    rows = [(i, rng.normal(size=4).astype(np.float32).tolist()) for i in range(300)]
    rows += [(i, same) for i in range(300, 420)]  # ties
    rows += [(500, None), (550, [1.0, None, 0.0, 2.0]), (600, [float("nan")] * 4), (None, same),
             (650, [float("inf"), 0.0, 0.0, 0.0]), (700, []), (701, [1.0]), (-50, same)]
    df = frames.importable(spark).createDataFrame(
        [(i, x, "c") for i, x in rows], "vec_id bigint, embedding array<float>, score string")
    assert by_id(top_k.top_k(df).collect()) == by_id(brute_top(rows, 50, 5))
    assert by_id(top_k.top_k(df.where("vec_id in (0, 1, 50)")).collect()) == by_id(
        brute_top([r for r in rows if r[0] in (0, 1, 50)], 50, 5))
    assert top_k.top_k(df.where("false")).count() == 0


def test_top_k_stops_early():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(8, 6)) * 400
    x = np.floor(np.repeat(centres, 500, 0) + rng.normal(size=(4000, 6)) * 20)
    space = top_k.Space(x[::4], np.arange(4000)[::4], float((x * x).sum(1).max()), 5)
    ids, dist, seen = np.arange(4000), space.of_rows(x).T, [0]
    scores, found = top_k.search_block(
        x[3], 3, space.of_queries(x[3:4])[0], -np.inf, x, ids, dist, space, seen)
    best = list(zip(scores.astype(int).tolist(), found.tolist(), strict=True))
    want = sorted(((int(x[3] @ x[i]), i) for i in range(4000) if i != 3), key=lambda r: (-r[0], r[1]))[:5]
    assert best == want and seen[0] < 2000


def test_warc(spark):
    rows = [(i, f"http://x/{i}", f"<p>{i % 5}</p>") for i in range(20)]
    rows += [(30, None, None), (29, "http://bad\r\nX: y", ""), (31, "u", "ü" * 300_000), (None, None, None),
             (None, "v", "<p>only</p>"), (4, "again", "<p>4</p>"), (-2, "neg", "<p>3</p>")]
    df = frames.importable(spark).createDataFrame(
        [(*r, "x") for r in rows], "page_id bigint, url string, html string, digest string").repartition(3)
    files = warc.write_pages(df)
    first = {}
    for i, _, html in rows:
        if i is not None:
            first[html or ""] = min(i, first.get(html or "", i))
    want = []
    for i, _, html in rows:
        raw = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        least = first.get(html or "")
        refers = least if least is not None and i != least else None
        want.append((i, len(raw), digest, "revisit" if refers is not None else "response", refers))
    for size in (1 << 24, 997):
        got = warc.read_records(files, size).where("record_type <> 'warcinfo'")
        assert by_id(got.select("page_id", "payload_bytes", "payload_digest", "record_type",
                                "refers_to").collect()) == by_id(want)
    held = {r.page_id: bytes(r.payload) for r in got.where("record_type = 'response'").collect()}
    assert held[31] == ("ü" * 300_000).encode()
    listed = warc.archives(spark, files.first().path.rsplit("/", 1)[0])
    assert warc.read_records(listed).count() == got.count() + files.count()
    assert warc.read_records(warc.write_pages(df.where("false"))).count() == 0


def test_warc_ignores_false_magic(tmp_path):
    """Magic bytes inside a record, and a gzip member that holds no record."""
    import gzip

    noise = warc.MAGIC * 40 + bytes(range(256))
    member = warc.record("resource", "<urn:x:1>", [("Content-Type", "text/plain")], noise)
    data = gzip.compress(b"not a record") + member + member
    path = tmp_path / "x.warc.gz"
    path.write_bytes(data)
    for step in (1, 7, 64, 1 << 20):
        with opened(str(path)) as source:
            at = [a for lo in range(0, len(data), step)
                  for a, _ in warc.members(source, len(data), lo, min(lo + step, len(data)))]
        assert at == [len(data) - 2 * len(member), len(data) - len(member)]


LINES = [f"line number {i} of the text with words" for i in range(30)]
LINE_DOCS = [
    (1, "\n".join(LINES[:6])), (2, "\n".join(["own opening words are here now", *LINES[2:5], "own end"])),
    (3, "\n".join(["short", LINES[0], "mid", LINES[1]])), (4, "\n".join(["short", LINES[0], "mid", LINES[1]])),
    (5, "\n".join(LINES[5::-1])), (6, None), (7, ""), (8, "only five words stand here\nand this"),
    (9, "only five words stand here\nbut that"), (None, "\n".join(LINES[:3])), (10, LINES[9] + "\n" + LINES[9]),
    (11, LINES[9] + "\n" + LINES[9] + "\n" + LINES[9]), (11, "again with one id " * 3),
]


def test_line_dedup(spark):
    df = frames.importable(spark).createDataFrame(
        [(i, t, i, "m") for i, t in LINE_DOCS], "doc_id bigint, text string, first bigint, marks string")
    got = line_dedup.without_shared_lines(df.repartition(4))
    assert got.columns == [*df.columns, "lines_deleted", "words_deleted"]
    text = {(r.doc_id, i): r.text for i, r in enumerate(got.orderBy("doc_id", "text").collect())}
    by = defaultdict(list)
    for (doc, _), t in text.items():
        by[doc].append(t)
    assert by[1] == [LINE_DOCS[0][1]]
    assert by[2] == ["own opening words are here now\nown end"]
    assert by[3] == ["short\nmid"]  # the lines of 1; what stands between differs there
    assert by[4] == ["short\nmid"] or by[4] == [""]
    assert len(by[5][0].split("\n")) == 5  # reversed: only one line is in order
    assert by[6] == [None] and by[7] == [""]
    assert by[8] == [LINE_DOCS[7][1]] and by[9] == [LINE_DOCS[8][1]]  # five words are no block
    assert by[None] == [""]
    assert by[10] == [LINE_DOCS[10][1]] and by[11] == ["again with one id " * 3, LINES[9]]
    assert line_dedup.without_shared_lines(df.where("false")).count() == 0


def test_longest_run_in_order():
    rng = np.random.default_rng(4)
    for _ in range(200):
        x = rng.permutation(rng.integers(1, 9))
        flags = line_dedup.in_order(x)
        best = max(
            len(s) for m in range(1 << len(x))
            if (s := [int(v) for k, v in enumerate(x) if m >> k & 1]) == sorted(s))
        assert flags.sum() == best and (np.diff(x[flags]) > 0).all()


def test_passage_inside_paragraphs(spark):
    """A passage that breaks into a sentence of another text goes, but for its first sentence."""
    rng = np.random.default_rng(11)

    def sentences(n: int) -> list[str]:
        return [" ".join(f"w{rng.integers(10**9)}" for _ in range(9)) + "." for _ in range(n)]

    passage = " ".join(sentences(7))
    texts = {}
    for i in range(6):
        own = " ".join(sentences(6)).split(" ")
        texts[i] = " ".join([*own[:5 * i + 3], passage, *own[5 * i + 3:]]) + "\nEnd of it. " + sentences(1)[0]
    texts[6] = "Clean! " + " ".join(sentences(5)) + "\n\n" + " ".join(sentences(5)) + " "
    df = frames.importable(spark).createDataFrame(list(texts.items()), "doc_id bigint, text string")
    got = {r.doc_id: r.text for r in line_dedup.without_shared_lines(df.repartition(3)).collect()}
    assert got[0] == texts[0] and got[6] == texts[6]
    tail = passage.split(". ", 1)[1]
    for i in range(1, 6):
        assert got[i] == texts[i].replace(tail + " ", "")


def deduplicated(spark, texts: dict[int, str]) -> dict[int, str]:
    df = frames.importable(spark).createDataFrame(list(texts.items()), "doc_id bigint, text string")
    return {r.doc_id: r.text for r in line_dedup.without_shared_lines(df.repartition(3)).collect()}


def words(rng, n: int) -> list[str]:
    return [f"w{rng.integers(10**9)}" for _ in range(n)]


def test_blocks_with_several_first_holders(spark):
    one, two = "the first line has six words", "and the second has six too"
    got = deduplicated(spark, {1: one, 2: f"{one}\n{two}", 3: f"{one}\n{two}", 4: f"own\n{two}\nown"})
    assert got == {1: one, 2: f"{one}\n{two}", 3: "", 4: f"own\n{two}\nown"}


def test_shared_runs_against_brute_force(spark):
    rng = np.random.default_rng(5)
    pool = [words(rng, int(rng.integers(1, 10))) for _ in range(25)]
    docs = {}
    for i in range(60):  # runs of the pool in any order; a piece stands once in a document
        at = rng.permutation([k for k in range(25)]) if i % 3 == 0 else np.roll(np.arange(25), int(rng.integers(25)))
        docs[i] = [int(k) for k in at[: rng.integers(3, 15)]]
    got = deduplicated(spark, {i: "\n".join(" ".join(pool[k]) for k in d) for i, d in docs.items()})
    for i, d in docs.items():
        must, may = set(), set()
        for e in (docs[j] for j in range(i)):
            for a in range(len(d)):
                b = a
                while b < len(d) and d[b] in e and e[e.index(d[a]) :][b - a : b - a + 1] == [d[b]]:
                    b += 1
                    if sum(len(pool[k]) for k in d[a:b]) >= 8:
                        may.update(d[a:b])
                        must.update(d[a:b] if b - a > 1 else [])
        left = {tuple(x.split(" ")) for x in got[i].split("\n")}
        gone = {k for k in d if tuple(pool[k]) not in left}
        assert must <= gone <= may


def test_layouts_of_one_passage(spark):
    """Line breaks inside sentences, and lines of any length, change nothing."""
    rng = np.random.default_rng(12)
    sentences = [" ".join(words(rng, 10)) + "." for _ in range(6)]
    passage, flat = " ".join(sentences), " ".join(sentences).split(" ")
    wrapped = " ".join(flat[:25]) + "\n" + " ".join(flat[25:])
    narrow = "\n".join(" ".join(flat[i : i + 7]) for i in range(0, 60, 7))
    own = [" ".join(words(rng, 12)) + "." for _ in range(3)]
    got = deduplicated(spark, {
        1: passage, 2: f"{own[0]}\n{wrapped}\nEnd.", 3: f"{own[1]} {narrow}",
        4: f"{own[2]} " + " ".join(sentences[:3]), 5: "  ".join(flat)})
    assert got == {1: passage, 2: f"{own[0]}\nEnd.", 3: own[1], 4: own[2], 5: ""}


def test_passages_in_another_order(spark):
    rng = np.random.default_rng(13)
    lines = [" ".join(words(rng, 55)) for _ in range(2)]  # one piece each
    short = ["\n".join(" ".join(words(rng, 6)) for _ in range(9)) for _ in range(3)]
    got = deduplicated(spark, {
        1: "\n".join(lines), 2: "\n".join(["own", *lines[::-1]]),
        3: "\n".join(short), 4: "\n".join(["own", *short[::-1]])})
    assert got[2] == got[4] == "own"
    assert got[1] == "\n".join(lines) and got[3] == "\n".join(short)


def test_passages_of_short_lines(spark):
    rng = np.random.default_rng(14)
    verse = [" ".join(words(rng, n)) for n in (4, 1, 4, 2, 3, 4, 1, 1, 4, 4, 3, 2, 4, 4, 4, 4, 4, 4, 1)]
    texts = {1: "\n".join(verse)} | {i: "\n".join([f"own {i}", *verse, "own end"]) for i in range(2, 6)}
    texts |= {6: "\n".join([*words(rng, 3), *verse[:2], *words(rng, 3)])}  # five words are no block
    got = deduplicated(spark, texts)
    # Two words before or after the verse that others have too go with it.
    assert got[2] == "own 2\nown end" and got[6] == texts[6]
    assert all(got[i] in (f"own {i}\nown end", f"own {i}") for i in range(3, 6))


def archive_of(bodies):
    """Members of an archive, a record each."""
    return [warc.record("resource", f"<urn:x:{i}>", [("Content-Type", "text/plain")], b)
            for i, b in enumerate(bodies)]


def rows_of(spark, tmp_path, data, step):
    path = tmp_path / "damaged.warc.gz"
    path.write_bytes(data)
    files = spark.createDataFrame([(path.as_uri(), len(data))], "path string, size bigint")
    got = warc.read_records(files, step).collect()
    return sorted((r.offset, r.record_id, bool(r.error)) for r in got)


@pytest.mark.parametrize("step", [64, 150, 1 << 20])
def test_damage_is_reported_and_the_rest_is_read(spark, tmp_path, step):
    frames.importable(spark)
    rng = np.random.default_rng(3)
    parts = archive_of([rng.bytes(150), rng.bytes(180), rng.bytes(200)])
    at = np.cumsum([0, *map(len, parts)]).tolist()
    names = [f"<urn:x:{i}>" for i in range(3)]
    good = [(at[i], names[i], False) for i in range(3)]
    assert rows_of(spark, tmp_path, b"".join(parts), step) == good
    # The header of the second one, its body, and its end are damaged.
    for lo, hi in ((10, 14), (len(parts[1]) - 60, len(parts[1]) - 56), (len(parts[1]) - 8, len(parts[1]) - 6)):
        bad = parts[1][:lo] + bytes(255 - b for b in parts[1][lo:hi]) + parts[1][hi:]
        got = rows_of(spark, tmp_path, parts[0] + bad + parts[2], step)
        assert got == [good[0], (at[1], None, True), good[2]]
    # An archive that is cut, one with something else between records, and one without records.
    assert rows_of(spark, tmp_path, b"".join(parts)[:-30], step) == [*good[:2], (at[2], None, True)]
    got = rows_of(spark, tmp_path, parts[0] + b"other bytes" * 9 + parts[1], step)
    assert got == [good[0], (at[1], None, True), (at[1] + 99, names[1], False)]
    assert rows_of(spark, tmp_path, b"nothing" * 30, step) == [(0, None, True)]


def test_a_member_without_a_whole_header_is_no_record(spark, tmp_path):
    import gzip
    frames.importable(spark)
    parts = archive_of([b"one", b"two"])
    false = gzip.compress(b"WARC/1.0 is a file format, see the docs")
    short = gzip.compress(b"WARC/1.0\r\nWARC-Type: resource\r\n\r\nbody")
    got = rows_of(spark, tmp_path, parts[0] + false + short + parts[1], 1 << 20)
    assert got == [(0, "<urn:x:0>", False), (len(parts[0]), None, True),
                   (len(parts[0] + false + short), "<urn:x:1>", False)]


def test_one_text_of_a_repeated_id_is_learned_from(spark):
    frames.importable(spark)
    rows = [(i, ("good words follow one another here " if i % 2 else "!!! ## $$ ") * (i % 9 + 3)) for i in range(40)]
    rows += [(i, "another text of the same id " * (i % 5 + 1)) for i in range(40)] + [(3, None)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id bigint, quality int")
    scores = []
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "doc_id bigint, text string").repartition(3)
        model = quality_model.train(docs, labels)
        scores.append(by_id(quality_model.scored(docs, model).collect()))
    assert scores[0] == scores[1]
