"""Token ids: the memo against the library, the automaton, files and packing."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from wikiloom.llm import simple8b, tokens
from wikiloom.llm.bpe_automaton import encode_decode, runner
from wikiloom.llm.packing import pack_documents
from wikiloom.llm.tokens import encoder

BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
PIECES = [
    "a", "B", "é", "É", "'s", "t", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", ",", ".", "!", "12",
    "<|endoftext|>", "<|startoftext|>", "<|", "don't", "́", "Σ", "İ", "ß", "中", "😀", "_", "#",
    "foo.\nBar", "..\n\n", " \n", "photograph", "the",
]
texts = st.lists(st.lists(st.sampled_from(PIECES), max_size=14).map("".join), max_size=20)


def library(path: str) -> Tokenizer:
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def ids_of(path: str, rows: list[str]) -> list[bytes]:
    found = library(path).encode_batch(rows, add_special_tokens=False)
    return [np.array(e.ids, "<u4").tobytes() for e in found]


@pytest.mark.parametrize("path", [BYTE, WORD])
@settings(max_examples=60, deadline=None)
@given(rows=texts)
def test_memo_equals_library(path, rows):
    assert encoder(path).encode(rows) == ids_of(path, rows)


@settings(max_examples=60, deadline=None)
@given(rows=texts, word=st.text("abcdehilnrst", max_size=40))
def test_automaton_equals_library(rows, word):
    run, rows = runner(WORD), [*rows, word]
    want = ids_of(WORD, rows)
    assert [run.encode(t) for t in rows] == want
    decode = library(WORD).decode
    for ids in want:
        plain = np.frombuffer(ids, "<u4").tolist()
        assert run.decode(ids) == decode(plain, skip_special_tokens=False)


@settings(max_examples=40, deadline=None)
@given(
    st.lists(st.one_of(
        st.integers(0, 50_000), st.integers(0, 1), st.sampled_from([2**59, 2**60, 15 << 60, 2**64 - 1])
    ), max_size=300),
    st.integers(1, 40),
)
def test_simple8b_round_trip(ids, times):
    ids = np.array(ids * times, dtype=np.uint64)
    words, offsets = simple8b.encode_words(ids)
    assert (simple8b.decode_words(words, offsets, len(ids)) == ids).all()


HARD = [
    (3, "zwei drei"), (1, None), (None, "null id"), (2, ""), (3, "zwei drei"),
    (7, "long " * 5000), (5, "<|endoftext|> \x00 \U0001f600"),
]


def hard(spark):
    rows = [(i, t, f"c{n}", n, "x") for n, (i, t) in enumerate(HARD)]
    return spark.createDataFrame(rows, "doc_id long, text string, part string, n long, _text string")


def test_token_files(spark):
    path = simple8b.write_token_files(hard(spark), BYTE, 0)
    got = sorted(simple8b.read_token_files(spark, path).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [None, 1, 2, 3, 3, 5, 7]
    by_id = dict(HARD)
    at = 0
    for row in got:
        want = ids_of(BYTE, [by_id[row["doc_id"]] or ""])[0] + bytes(4)
        assert (row["start"], row["n_tokens"], bytes(row["ids"])) == (at, len(want) // 4, want)
        at += len(want) // 4
    none = simple8b.write_token_files(hard(spark).limit(0), BYTE, 0)
    assert simple8b.read_token_files(spark, none).count() == 0


def test_packing(spark):
    got = pack_documents(hard(spark), WORD, 1, window=16).collect()
    places = {}
    for row in got:
        assert len(row["ids"]) == 4 * row["length"] and row["offset"] + row["length"] <= 16
        places.setdefault(row["sequence_id"], []).append((row["offset"], row["length"]))
    assert sorted(places) == list(range(len(places)))
    for number, pieces in places.items():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at == 16 or number == len(places) - 1
    total = sum(len(b) // 4 + 1 for b in ids_of(WORD, [t or "" for _, t in HARD]))
    assert sum(r["length"] for r in got) == total
    long = sorted((r["start"], bytes(r["ids"])) for r in got if r["doc_id"] == 7)
    want = ids_of(WORD, [HARD[5][1]])[0] + np.array([1], "<u4").tobytes()
    assert b"".join(b for _, b in long) == want
    assert pack_documents(hard(spark).limit(0), WORD, 1).count() == 0


def test_encode_decode(spark):
    got = encode_decode(hard(spark), WORD).collect()
    assert sorted(r["n_tokens"] for r in got) == sorted(len(b) // 4 for b in ids_of(WORD, [t or "" for _, t in HARD]))
    assert encode_decode(hard(spark).limit(0), WORD).count() == 0


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_pieces_beyond_the_bound_are_encoded_again(path, monkeypatch):
    """Texts of all kinds of white space in one batch; few pieces are kept, as Arrow arrays."""
    monkeypatch.setattr(tokens, "MEMO_PIECES", 5)
    rows = ["", " ", "a", " the (a, b)", "the a　b ", "x\x1cy  z", "l m\n n", "w" * 200, "é é the.", "a\t\r\nb", "😀 the"]
    made = tokens.Encoder(path)
    expected = [np.array(e.ids, "<u4").tobytes() for e in library(path).encode_batch(rows, add_special_tokens=False)]
    for _ in range(2):
        assert made.encode(rows) == expected
        assert [made.encode([row])[0] for row in rows] == expected
    assert len(made.known.pieces) == len(made.known.ids) <= 5
    assert made.encode([]) == []


@pytest.mark.parametrize(("path", "lead"), [(BYTE, " "), (WORD, "")])
def test_parts_met_again_are_kept_and_others_are_not(path, lead):
    rows = ["x photograph, photograph.\nPhotograph zebra! photograph zqxj", "", "y the*** zwölf the*** <a, \x01b\x01."]
    made = tokens.Encoder(path)
    assert made.encode(rows) == made.encode(tokens.pa.array(rows)) == ids_of(path, rows)
    made = tokens.Encoder(path)
    made.encode(rows)
    assert sorted(made.known.pieces.to_pylist()) == sorted([lead + "photograph", lead + "the***", lead + "the", "***"])


def test_texts_are_packed_in_short_batches(spark, monkeypatch):
    """Python gets some megabytes at a time, and the session's own bound holds again afterwards."""
    from wikiloom.llm import packing

    sizes = []
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    monkeypatch.setattr(packing, "landed", lambda df, table: sizes.append(spark.conf.get(name)) or df)
    packing.pack_documents(hard(spark), WORD, 1).count()
    assert sizes == [str(4 << 20)] and spark.conf.get(name) == before
