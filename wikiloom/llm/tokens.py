"""Token ids of whole texts by the tokenizers library, with a bounded memo per Python worker.

A pre-tokenizer never joins text across some places, for example before the blank that follows a
letter. Texts are cut there, each distinct piece is encoded once by the library and kept, and the
ids of a text are the ids of its pieces. Cutting, looking up and joining are done by Arrow for a batch
at a time; only new pieces pass through Python. Tokenizers of an unknown kind encode whole texts.
"""

from __future__ import annotations

import json
import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from wikiloom.llm.arrow import give_back

MEMO_PIECES = 150_000
JOINED_WORDS = 64
KEPT_LENGTH = 64

# Places where neither supported pre-tokenizer joins: a letter before a sign or a line break, a sign
# before a line break, and a line break between a letter or sign and a letter.
_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
_SIGN = r",.;:!?#*$%&|)"
_PART = "\x01"  # stands at such a place
_CUTS = [
    (f"([{_LETTER}])([{_SIGN}\n])", f"\\1{_PART}\\2"),
    (f"([{_SIGN}])\n", f"\\1{_PART}\n"),
    (f"{_PART}\n([{_LETTER}])", f"{_PART}\n{_PART}\\1"),
]
_SPACES = [chr(c) for c in range(0x3001) if chr(c).isspace()]
_SPACE_RUNS = [s + " " for s in _SPACES]
_AFTER_TEXT = re.compile(r"(?<!\s) ")
_ODD_SPACE = re.compile("[\x1c-\x1f]")
# Texts that blanks or ASCII white space alone do not cut, as patterns of Arrow
_BYTE_ODD = "[" + "".join(f"\\x{{{ord(s):x}}}" for s in _SPACES) + "] "
_WORD_ODD = "[" + "".join(f"\\x{{{ord(s):x}}}" for s in _SPACES if not "\t" <= s <= "\r" and s != " ") + "]"
_PLAIN_SPACE = re.compile("[" + "".join(s for s in _SPACES if not "\x1c" <= s <= "\x1f") + "]+")


class Known:
    """Pieces and their ids as two Arrow arrays, kept up to a bound, so that a batch is looked up at once."""

    def __init__(self) -> None:
        self.pieces = pa.array([], pa.large_string())
        self.ids = pa.array([], pa.large_binary())

    def find(self, pieces: pa.Array) -> pa.Array:
        """Places of pieces; null where one is not kept."""
        return pc.index_in(pieces, value_set=self.pieces)

    def add(self, pieces: pa.Array, ids: pa.Array) -> None:
        """Keep new pieces."""
        short = pc.less_equal(pc.utf8_length(pieces), KEPT_LENGTH)
        room = MEMO_PIECES - len(self.pieces)
        if room > 0 and len(pieces):
            self.pieces = pa.concat_arrays([self.pieces, pieces.filter(short)[:room]])
            self.ids = pa.concat_arrays([self.ids, ids.filter(short)[:room]])


def _strung(ids: pa.Array, bounds: np.ndarray) -> pa.Array:
    """Binary values between bounds, each run of them one behind the other as one value."""
    _, offsets, data = ids.buffers()
    ends = np.frombuffer(offsets, np.int64, len(ids) + 1, 8 * ids.offset)[bounds]
    data = pa.py_buffer(b"") if data is None else data
    return pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(ends), data])


class Encoder:
    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.marks = [t["content"] for t in spec["added_tokens"]]
        self.kind = _kind(spec)
        self.known = Known()
        self.lead = " " if self.kind == "byte" else ""
        self.plain = rf"^{self.lead}[{_LETTER}]+$"
        vocab = self.library.get_vocab()
        self.edges = np.zeros(max(vocab.values(), default=0) + 1, dtype=bool)
        for token, i in vocab.items():
            self.edges[i] = token.startswith("Ġ") if self.kind == "byte" else token.endswith("</w>")

    def _words(self, words: list[str]) -> pa.Array:
        """Ids of plain words with their lead. They are joined, as a long text costs the
        library less, and parted at the tokens that begin or end a word."""
        if not words:
            return pa.array([], pa.large_binary())
        gap = "" if self.lead else " "
        joined = [gap.join(words[at : at + JOINED_WORDS]) for at in range(0, len(words), JOINED_WORDS)]
        found = self._each(joined)
        data = b"".join(found)
        ids = np.frombuffer(data, "<u4")
        edges = np.flatnonzero(self.edges[ids])
        edges = np.append(edges, len(ids)) if self.kind == "byte" else np.append(0, edges + 1)
        starts = np.cumsum([0] + [len(f) // 4 for f in found])
        firsts = edges[:-1:JOINED_WORDS]
        if len(edges) != len(words) + 1 or (firsts != starts[:-1]).any() or edges[-1] != len(ids):
            raise ValueError("joined words do not part as expected")
        bounds = pa.py_buffer((edges * 4).astype(np.int64).tobytes())
        return pa.Array.from_buffers(pa.large_binary(), len(words), [None, bounds, pa.py_buffer(data)])

    def _each(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def cut(self, text: str) -> list[str]:
        """Pieces whose ids stand for the text; of kind "byte", all but the first lack a blank."""
        if self.kind == "byte":
            if any(run in text for run in _SPACE_RUNS):
                return _AFTER_TEXT.split(text)
            return text.split(" ")
        if _ODD_SPACE.search(text):
            return [piece for piece in _PLAIN_SPACE.split(text) if piece]
        return text.split()

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        column = texts.cast(pa.large_string()) if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        if self.kind == "whole":
            return self._each(column.to_pylist())
        odd = pc.match_substring_regex(column, _BYTE_ODD if self.kind == "byte" else _WORD_ODD)
        if not pc.any(odd, min_count=0).as_py():
            return self._joined(self._split(column))
        out: list[bytes] = [b""] * len(column)
        for rows, split in ((pc.invert(odd), self._split), (odd, self._split_odd)):
            found = self._joined(split(column.filter(rows)))
            for at, ids in zip(pc.indices_nonzero(rows).to_pylist(), found):
                out[at] = ids
        return out

    def _split(self, column: pa.Array) -> pa.Array:
        return pc.split_pattern(column, " ") if self.kind == "byte" else pc.ascii_split_whitespace(column)

    def _split_odd(self, column: pa.Array) -> pa.Array:
        return pa.array([self.cut(text) for text in column.to_pylist()], pa.list_(pa.large_string()))

    def _joined(self, cut: pa.Array) -> list[bytes]:
        """Ids of texts in pieces. Each distinct piece is looked up once, and the ids of all pieces, one behind
        the other, are taken in one go."""
        if not len(cut):
            return []
        bounds = cut.offsets.to_numpy() - cut.offsets[0].as_py()
        coded = cut.flatten().dictionary_encode()
        pieces, each = coded.dictionary, coded.indices.to_numpy()
        if self.lead:
            # The first piece of a text follows no blank.
            heads = self._each(pc.list_element(cut, 0).to_pylist())
            lead, nothing = (pa.scalar(text, pa.large_string()) for text in (self.lead, ""))
            pieces = pc.binary_join_element_wise(lead, pieces, nothing)
        table = [self._found(pieces, np.bincount(each, minlength=len(pieces)))]
        if self.lead:
            each = each.copy()
            each[bounds[:-1]] = len(pieces) + np.arange(len(heads))
            table.append(pa.array(heads, pa.large_binary()))
        ids = _strung(pa.concat_arrays(table).take(pa.array(each)), bounds)
        found = ids.to_pylist()
        del table, ids, coded, cut, each
        give_back()
        return found

    def _found(self, pieces: pa.Array, counts: np.ndarray) -> pa.Array:
        """Ids of distinct pieces, which occur so many times. New ones are cut on, and their distinct parts looked
        up in turn; those met more than once are kept, as most others never come again."""
        place = self.known.find(pieces)
        new = pc.is_null(place)
        rows = np.flatnonzero(new.to_numpy(zero_copy_only=False))
        if not len(rows):
            return self.known.ids.take(place)
        unknown, times = pieces.filter(new), counts[rows]
        cut = self._cut_on(unknown)
        bounds = cut.offsets.to_numpy() - cut.offsets[0].as_py()
        coded = cut.flatten().dictionary_encode()
        parts, each = coded.dictionary, coded.indices.to_numpy()
        at = self.known.find(parts)
        fresh = parts.filter(pc.is_null(at))
        made = self._encoded(fresh)
        places = at.fill_null(0).to_numpy().copy()
        unmet = at.is_null().to_numpy(zero_copy_only=False)
        places[unmet] = len(self.known.ids) + np.arange(len(fresh))
        ids = pa.concat_arrays([self.known.ids, made]).take(pa.array(places[each]))
        whole = _strung(ids, bounds)
        out = place.fill_null(0).to_numpy().copy()
        out[rows] = len(self.known.ids) + np.arange(len(rows))
        out = pa.concat_arrays([self.known.ids, whole]).take(pa.array(out))
        often = np.bincount(each, np.repeat(times, np.diff(bounds)), len(parts))[unmet] > 1
        self.known.add(fresh.filter(pa.array(often)), made.filter(pa.array(often)))
        several = pa.array((times > 1) & (np.diff(bounds) > 1))
        self.known.add(unknown.filter(several), whole.filter(several))
        return out

    def _cut_on(self, pieces: pa.Array) -> pa.Array:
        """Parts of pieces, between which no pre-tokenizer joins; pieces that may hold a mark are left whole."""
        marked = pieces
        for pattern, parted in _CUTS:
            marked = pc.replace_substring_regex(marked, pattern, parted)
        kept = pc.match_substring_regex(pieces, f"[<{_PART}]")
        cut = pc.split_pattern(pc.if_else(kept, "", marked), _PART)
        if not pc.any(kept).as_py():
            return cut
        flat, firsts = cut.flatten(), cut.offsets.to_numpy()[:-1] - cut.offsets[0].as_py()
        places = np.arange(len(flat))
        rows = np.flatnonzero(kept.to_numpy(zero_copy_only=False))
        places[firsts[rows]] = len(flat) + np.arange(len(rows))
        flat = pa.concat_arrays([flat, pieces.filter(kept)]).take(pa.array(places))
        return pa.ListArray.from_arrays(cut.offsets, flat)

    def _encoded(self, parts: pa.Array) -> pa.Array:
        """Ids of parts by the library; plain words are joined."""
        plain = pc.match_substring_regex(parts, self.plain)
        words, others = parts.filter(plain), parts.filter(pc.invert(plain))
        found = [self._words(words.to_pylist()), pa.array(self._each(others.to_pylist()), pa.large_binary())]
        order = np.empty(len(parts), dtype=np.int64)
        order[np.argsort(~plain.to_numpy(zero_copy_only=False), kind="stable")] = np.arange(len(parts))
        return pa.concat_arrays(found).take(pa.array(order))


def _kind(spec: dict) -> str:
    pre, model = spec["pre_tokenizer"] or {}, spec["model"]
    marks = [t["content"] for t in spec["added_tokens"]]
    usual = (
        model["type"] == "BPE" and not model.get("dropout")
        and all("<" in mark and not any(c.isspace() for c in mark) for mark in marks)
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"])
    )
    if usual and pre.get("type") == "ByteLevel" and spec["normalizer"] is None:
        return "byte" if pre["use_regex"] and not pre["add_prefix_space"] else "whole"
    steps = [p.get("type") for p in pre.get("pretokenizers", [])]
    normal = [n.get("type") for n in (spec["normalizer"] or {}).get("normalizers", [])]
    if usual and steps == ["Split", "ByteLevel"] and normal == ["NFC", "Replace", "Lowercase"]:
        return "word" if pre["pretokenizers"][0]["behavior"] == "Removed" else "whole"
    return "whole"


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder of a tokenizer file; its memo outlives the task."""
    if path not in _ENCODERS:
        # Spark spreads the work: threads of the library would take the cores of other tasks.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
