"""Ids of whole columns against the tokenizers library, on texts made to be hard to cut."""

import random

import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from docketflow.llm import piece_arrays
from docketflow.llm.packing import word_encoder
from docketflow.llm.token_files import text_encoder

PARTS = ["a", "Wort", "don't", "it's", "'S", "12", "½", "²x", "é", "É", "ß", "İ", "ǅ", "ΣΑΣ", "日本", "ก็", "🙂", "é",
         "...", "(x)", "_", "-", "a_b", "<|endoftext|>", "<|", "|>", "<|startoftext|>x", "\x00", "\x1c", "\x1f", "​", "﻿"]
GAPS = [" ", " ", " ", "\n", "\n", "  ", "\n\n", " \n", "\n ", "\t", "\r\n", "\xa0", "\x85", "　", " ", "", ""]


def texts(seed, n):
    rnd = random.Random(seed)
    out = [None, "", " ", "\n", "\x1f", "x" * 5_000, " " * 300, "a " * 4_000]
    for _ in range(n):
        out.append("".join(rnd.choice(PARTS) + rnd.choice(GAPS) for _ in range(rnd.randint(1, 12))))
    return out


@pytest.mark.parametrize("led,name,encoder", [
    (False, "word_bpe_49k.json", word_encoder), (True, "byte_bpe_50k.json", text_encoder)])
def test_ids_are_the_librarys(led, name, encoder, monkeypatch):
    path = public_tokenizers.path(name)
    rows = texts(7, 2_500)
    library = Tokenizer.from_file(path)
    want = [x.ids for x in library.encode_batch_fast([x or "" for x in rows], add_special_tokens=False)]
    monkeypatch.setattr(piece_arrays, "SLICE_BYTES", 4_000)
    monkeypatch.setattr(piece_arrays, "TOKEN_BYTES", 20_000)
    store = encoder(path)
    store.forget()
    column = pa.array(["before", *rows], pa.string()).slice(1)
    got = [ids[lo:hi].tolist() for ids, at in piece_arrays.ids_of(column, led, store)
           for lo, hi in zip(at[:-1], at[1:], strict=True)]
    assert len(got) == len(want)
    wrong = [(a, b, c) for a, b, c in zip(rows, got, want, strict=True) if b != c]
    assert not wrong, wrong[:3]
    assert [x.shape for x, _ in piece_arrays.ids_of(column.slice(0, 0), led, store)] == []


def test_words_are_encoded_once_whatever_stops_follow(monkeypatch):
    path = public_tokenizers.path("byte_bpe_50k.json")
    rnd = random.Random(11)
    words = ["ab" * (i % 5 + 1) + chr(97 + i % 26) + chr(97 + i // 26) for i in range(300)] + ["été", "Ñandú", "ǅ"]
    ends = ["", ",", ".", "...", "!!", ",$$$", ".&&&", "!" * 8, "!" * 9, "'", "'s", "<|", "<|endoftext|>", ")}", "²", "-", ".x"]
    rows = ["", "\n", *words, *["".join(rnd.choice([" ", " ", "\n"]) + rnd.choice(words) + rnd.choice(ends) for _ in range(30)).strip()
                                for _ in range(400)]]
    want = [x.ids for x in Tokenizer.from_file(path).encode_batch_fast(rows, add_special_tokens=False)]
    store = text_encoder(path)
    compute, computed = store.compute, []

    def counted(*args):
        computed.extend(args[-1] if isinstance(args[-1], list) else args[-1].to_pylist())
        return compute(*args)

    monkeypatch.setattr(store, "compute", counted)
    for keep, size in ((store.keep, 1 << 20), (2_000, 3_000)):  # all words remembered, and few
        monkeypatch.setattr(store, "keep", keep)
        computed.clear()
        store.forget()
        got = [ids[lo:hi].tolist() for ids, at in piece_arrays.ids_of(pa.array(rows), True, store, size)
               for lo, hi in zip(at[:-1], at[1:], strict=True)]
        assert got == want
        if size == 1 << 20:
            stopped = [w for w in computed if w.lstrip("\x1f\n")[:1].isalpha() and w[-1] in ",.!$&)}" and len(w) < 20]
            assert not [w for w in stopped if not w.endswith("!" * 9)], stopped[:5]
            assert len(computed) == len(set(computed))
    store.forget()


def test_words_without_white_space_are_encoded_once_in_any_case(monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    rnd = random.Random(13)
    words = ["ab" * (i % 5 + 1) + chr(97 + i % 26) + chr(97 + i // 26) for i in range(300)]
    forms = [str.lower, str.upper, str.capitalize]
    odd = ["été", "ÉTÉ", "İstanbul", "H̱a", "T̈", "ǅ", "²x", "12", "a_b", "...", "<|endoftext|>", "<|ENDOFTEXT|>", "日本"]
    ends = ["", ",", ".", "...", "!!", ",$$$", ".&&&", "!" * 8, "!" * 9, "'s", "'S", "'", "|>", ")}", "̱", "-x", ".x"]
    rows = [*(" ".join(rnd.choice(forms)(rnd.choice(words)) + rnd.choice(ends) for _ in range(30)) for _ in range(300)),
            *(rnd.choice(["\n", "  "]).join(rnd.choice(odd) + rnd.choice(ends) for _ in range(9)) for _ in range(300))]
    want = [x.ids for x in Tokenizer.from_file(path).encode_batch_fast(rows, add_special_tokens=False)]
    store = word_encoder(path)
    compute, computed = store.compute, []

    def counted(*args):
        computed.extend(args[-1] if isinstance(args[-1], list) else args[-1].to_pylist())
        return compute(*args)

    monkeypatch.setattr(store, "compute", counted)
    for keep, size in ((1 << 20, 3_000), (2_000, 3_000)):  # all words remembered, and few
        monkeypatch.setattr(piece_arrays, "TOKEN_BYTES", keep)
        computed.clear()
        store.forget()
        got = [ids[lo:hi].tolist() for ids, at in piece_arrays.ids_of(pa.array(rows), False, store, size)
               for lo, hi in zip(at[:-1], at[1:], strict=True)]
        assert got == want
        if keep == 1 << 20:
            assert len(computed) == len(set(computed))
            stopped = [w for w in computed if w[:2] == "ab" and w[-1] in ",.$&}!" and not w.endswith("!" * 9)]
            assert not stopped and not [w for w in computed if w.isascii() and w.isalpha() and w != w.lower()]
    store.forget()
