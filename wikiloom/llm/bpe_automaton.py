"""BPE as a deterministic automaton over tokens, with table-driven encoding and decoding.

The automaton reads token labels. At first it has one state with a loop per base symbol. For each
merge (u, v) -> w, in order, a gadget is applied: every state with an arc u whose target has an arc v
gets an arc w to the target of v; the target of u is split, and the copy that u leads to has no arc
v any more. Every label leads to one state, so the state after a label is named by the label. The
copies are kept as references: the state after w is the state after v as it was when w was made
(``copy_of``), and its arcs are those of that state without the ones removed since. An arc w
exists where arc u existed when w was made. ``removed`` holds the time each arc was removed.
An arc u, u is resolved from the left: after u comes no uu, after uu may come u.

A word has exactly one accepted path. Encoding keeps the state reached at every place of the word
and follows the arcs whose labels continue the word there. Decoding emits the labels of the arcs.

Documents with null text count as empty. Rows with equal ids stay separate rows. Other columns of
the input are not read, so their names may clash with those of the result.
"""

from __future__ import annotations

import json
import unicodedata
from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wikiloom.llm.arrow import per_row

MEMO_WORDS = 300_000
KEPT_LENGTH = 64
END = "</w>"


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself, or the next free one from 256 on."""
    kept = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(256, 512))
    return [chr(b if b in kept else next(free)) for b in range(256)]


class Automaton:
    """Tables of the automaton, made from a tokenizer file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        if model["type"] != "BPE" or model["end_of_word_suffix"] != END or model["dropout"]:
            raise ValueError(f"{path}: only BPE with the word end {END} can be compiled")
        self.ids = vocab
        self.marks = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.marks.values()]) + 1
        self.labels = [""] * size
        for label, i in [*vocab.items(), *self.marks.items()]:
            self.labels[i] = label
        self.pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        # Left and right part of a label and the time it was made; base symbols were always there.
        self.left, self.copy_of, self.made = [-1] * size, [-1] * size, [-1] * size
        self.removed: dict[tuple[int, int], int] = {}
        for time, merge in enumerate(model["merges"]):
            first, second = merge if isinstance(merge, list) else merge.split(" ")
            self._gadget(time, vocab[first], vocab[second], vocab[first + second])
        self.by_start = self._prefixes()

    def _gadget(self, time: int, u: int, v: int, w: int) -> None:
        if self.made[w] >= 0 or max(self.made[u], self.made[v]) >= time:
            raise ValueError("a token is made twice, or used before it is made")
        self.left[w], self.copy_of[w], self.made[w] = u, v, time
        self.removed[u, v] = time

    def _prefixes(self) -> dict[str, int]:
        """Every proper prefix of a label (as -1, if no label itself) and every label with its id."""
        table: dict[str, int] = {}
        for label in self.ids:
            body, end = (label[:-4], True) if label.endswith(END) and label != END else (label, False)
            for n in range(1, len(body)):
                table.setdefault(body[:n], -1)
            if end:
                table.setdefault(body, -1)
                table[body + "\n"] = self.ids[label]
            else:
                table[body] = self.ids[label]
        return table

    def has_arc(self, state: int, label: int) -> bool:
        """Whether the state after ``state`` has an arc ``label``.

        Both are followed back in time: the state to the one it was copied from, the label to its
        left part. A removal counts if it fell when both were current.
        """
        get, left, copy_of, made = self.removed.get, self.left, self.copy_of, self.made
        at, at_until = state, 1 << 60
        while at >= 0:
            arc, arc_until = label, 1 << 60
            while arc >= 0:
                time = get((at, arc))
                if time is not None and time < at_until and time <= arc_until:
                    return False
                arc_until, arc = made[arc], left[arc]
            at_until, at = made[at], copy_of[at]
        return True


class Runner:
    """Runs the automaton over texts; the tables met so far are kept in bounded memos."""

    def __init__(self, machine: Automaton) -> None:
        self.machine = machine
        marks = "|".join(regex.escape(m) for m in machine.marks)
        self.split_marks = regex.compile(f"({marks})") if marks else None
        self.words = regex.compile(machine.pattern)
        self.letters = byte_letters()
        self.arcs: dict[tuple[int, int], bool] = {}
        self.memo: dict[str, list[int]] = {}
        self.chunks: dict[str, bytes] = {}

    def _arc(self, state: int, label: int) -> bool:
        found = self.arcs.get((state, label))
        if found is None:
            if len(self.arcs) > 4 * MEMO_WORDS:
                self.arcs.clear()
            found = self.arcs[state, label] = self.machine.has_arc(state, label)
        return found

    def word(self, word: str) -> list[int]:
        """Labels on the accepted path of a pre-split word."""
        found = self.memo.get(word)
        if found is not None:
            return found
        # The word end is marked by a line break, which is no letter.
        symbols = "".join([self.letters[b] for b in word.encode()]) + "\n"
        n = len(symbols) - 1
        table = self.machine.by_start
        state: list[int] = [-2] * (n + 1)  # -2: not reached
        came: list[int] = [0] * (n + 1)
        state[0] = -1
        for i in range(n):
            q = state[i]
            if q == -2:
                continue
            for j in range(i + 1, n + 1):
                label = table.get(symbols[i:j])
                if label is None:
                    break
                if j == n:
                    label = table.get(symbols[i:], -1)
                if label >= 0 and state[j] == -2 and (q < 0 or self._arc(q, label)):
                    state[j], came[j] = label, i
        path, at = [], n
        while at:
            path.append(state[at])
            at = came[at]
        path.reverse()
        if len(word) <= KEPT_LENGTH:
            if len(self.memo) >= MEMO_WORDS:
                self.memo.clear()
            self.memo[word] = path
        return path

    def _chunk(self, text: str) -> bytes:
        out: list[int] = []
        pieces = self.split_marks.split(text) if self.split_marks and "<" in text else [text]
        for piece in pieces:
            if piece in self.machine.marks:
                out.append(self.machine.marks[piece])
                continue
            piece = unicodedata.normalize("NFC", piece)
            # Letter by letter, so that no rule for word ends applies.
            piece = "".join([c.lower() for c in piece]) if "Σ" in piece else piece.lower()
            for word in self.words.findall(piece):
                out.extend(self.word(word))
        return array("I", out).tobytes()

    def encode(self, text: str | None) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        memo, found = self.chunks, []
        # No word goes over a blank or line break; pieces between them are kept.
        for chunk in text.replace("\n", " ").split(" "):
            ids = memo.get(chunk)
            if ids is None:
                ids = self._chunk(chunk)
                if len(chunk) <= KEPT_LENGTH:
                    if len(memo) >= MEMO_WORDS:
                        memo.clear()
                    memo[chunk] = ids
            found.append(ids)
        return b"".join(found)

    def decode(self, ids: bytes | None) -> str:
        """Labels of the ids, with blanks between, as a file without a decoder gives them."""
        if not ids:
            return ""
        labels = self.machine.labels
        return " ".join([labels[i] for i in np.frombuffer(ids, "<u4").tolist()])


_RUNNERS: dict[str, Runner] = {}


def runner(path: str) -> Runner:
    """The worker's automaton of a tokenizer file, compiled once."""
    if path not in _RUNNERS:
        _RUNNERS[path] = Runner(Automaton(path))
    return _RUNNERS[path]


def encode_decode(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Encode every text and decode its ids again: key, n_tokens, ids (binary), decoded."""
    kind = docs.schema[key].dataType.simpleString()

    def make():
        run = runner(path)

        def f(texts: list, batch: pa.RecordBatch) -> dict:
            ids = [run.encode(t) for t in texts]
            return {
                key: batch.column(key),
                "n_tokens": [len(b) // 4 for b in ids],
                "ids": ids,
                "decoded": [run.decode(b) for b in ids],
            }

        return f

    rows = docs.select(key, F.col(text).cast("string").alias("_text"))
    return per_row(rows, "_text", f"`{key}` {kind}, n_tokens long, ids binary, decoded string", make)
