"""Personal data, chat, quality, language and revisits on hard rows."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from wikiloom.llm import ordered
from wikiloom.llm.chat import read_back, windows
from wikiloom.llm.language import UNKNOWN, fit, identify
from wikiloom.llm.outliers import quality
from wikiloom.llm.pii import KINDS, PATTERNS, learn_patterns, personal_data, redacted, span_text
from wikiloom.llm.warc import canonical_url, merged_headers, resolve_revisits

TEXTS = [
    (1, "a@b.c.d+x@e.f and a@b@c.d, x@y 1.2.3.4.5.6.7.8 999.1.1.1 0255.1.1.01"),
    (2, "4111 1111-1111 1111 then 4111111111111112 call +1 (555) 123-4567 or +4 5-"),
    (3, None), (4, ""), (5, "é😀 me@x.org 😀 10.0.0.1"), (None, "k@l.mn"),
    (6, "1 " * 20_000 + "a" * 20_000 + "@"),
]
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        total = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(digits[::-1]))
        return 16 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, t, "x", "y") for i, t in rows], "doc_id long, text string, base string, spans string"
    )


def test_base_spans(spark):
    assert list(PATTERNS) == KINDS
    got = personal_data(frame(spark, TEXTS)).select("doc_id", span_text(F.col("base")).alias("s")).collect()
    want = {
        i: ",".join(
            f"{k}:{m.start()}:{m.end()}" for k, p in PLAIN.items() for m in re.finditer(p, t or "") if passes(k, m[0])
        )
        for i, t in TEXTS
    }
    assert {r["doc_id"]: r["s"] for r in got} == want
    assert personal_data(frame(spark, TEXTS).limit(0)).count() == 0


def test_contexts_find_unseen_identifiers(spark):
    rows = [(n, f"word{n} please dial number +1 (555) 123-45{n:02d} thanks") for n in range(10, 30)]
    rows.append((99, "please dial number 555-0199 now, room 12 is free"))
    rows += [(200 + n, f"the room {n} is free") for n in range(9)]
    got = {r["doc_id"]: r["s"] for r in personal_data(frame(spark, rows)).select(
        "doc_id", span_text(F.col("spans")).alias("s")).collect()}
    assert got[99] == "phone:19:27" and got[200] == ""


def test_found_identifiers_support_further_contexts(spark):
    found = [f"ref-{n:03d}x" for n in range(8)]
    rows = [(n, f"so dial number +1 (555) 123-45{n:02d} thanks") for n in range(10, 80)]
    rows += [(100 + n, f"so dial number {v} now") for n, v in enumerate(found)]
    rows += [(200 + n, f"their secret code {v} is old") for n, v in enumerate(found)]
    rows += [(300 + n, f"their secret code new{n}7{'z' * 80} is new") for n in range(3)]
    rows += [(400 + n, f"{'-' * 300} in room {n}") for n in range(9)]
    got = {r["doc_id"]: r["s"] for r in personal_data(frame(spark, rows)).select(
        "doc_id", span_text(F.col("spans")).alias("s")).collect()}
    assert all(got[i] for i in got if i < 400) and not any(got[i] for i in got if i >= 400)
    assert got[300] == "phone:18:103"
    # Two of three instances are known in the last context, a third one only if they support it.
    one = {r["left"] for r in learn_patterns(spark.createDataFrame(
        [("a", f"s{n}", 3) for n in range(9)] + [("a", f"f{n}", None) for n in range(3)]
        + [("b", f"f{n}", None) for n in range(3)] + [("c", f"x{n}", None) for n in range(3)],
        "left string, value string, rank int")).collect()}
    assert one == {"a", "b"}


def test_redacted(spark):
    rows = frame(spark, TEXTS)
    found = personal_data(rows).withColumnRenamed("spans", "found").select("doc_id", "found")
    got = rows.join(found, rows["doc_id"].eqNullSafe(found["doc_id"])).select(
        rows["doc_id"], redacted(F.col("text"), F.col("found")).alias("t"))
    got = {r["doc_id"]: r["t"] for r in got.collect()}
    assert got[5] == "é😀 [EMAIL] 😀 [IP]" and got[3] is None and got[None] == "[EMAIL]"


def test_chat_round_trip(spark):
    hard = "<|im_end|><|im_start|>assistant ok"
    rows = [
        (1, 0, "system", "be kind"), (1, 1, "user", hard), (1, 2, "assistant", "\\<|x\\|<\\|" + hard),
        (1, 2, "assistant", "\\<|x\\|<\\|" + hard), (2, 1, "user", None), (2, 2, "assistant", ""),
        (None, None, "assistant", "no id"), (None, 3, None, "no role"), (3, 0, "ro\nle<\\>", "x"),
    ]
    rows += [(4, n, "assistant" if n % 2 else "user", f"turn {n} " + "word " * (n % 7) * 30) for n in range(120)]
    rows += [(4, -1, "system", "long rules " * 20)]
    turns = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, window string")
    out = windows(turns, budget=700, history=100).cache()
    got = {r["conv_id"]: r for r in read_back(out).collect()}
    for conv in (1, 2, 3, 4, None):
        own = sorted(
            ((-9 if r[1] is None else r[1], r[2] or "", r[3] or "") for r in rows if r[0] == conv),
            key=lambda r: (r[0], r[1]),
        )
        assert [(t["role"], t["text"]) for t in got[conv]["turns"]] == [r[1:] for r in own]
        assert got[conv]["losses"] == [r[2] for r in own if r[1] == "assistant"]
    many = out.where("conv_id = 4").orderBy("window").collect()
    assert len(many) > 3 and all(r["text"].startswith("<|im_start|>system\nlong rules") for r in many)
    assert any(r["n_context"] > 1 for r in many)
    assert windows(turns.limit(0)).count() == 0
    out.unpersist()


def plain_windows(costs, room, spans=16):
    """Numbers of turns in the windows of turns without a system turn, by the rule, turn by turn."""
    out, total, start, span = [], 0, None, None
    for cost in costs:
        here = total // (room * spans)
        if here != span or (total + cost - start > room and total > start):
            start, span = total, here
            out.append(0)
        out[-1] += 1
        total += cost
    return out


def test_chat_windows_keep_the_budget(spark):
    draw = random.Random(3)
    sizes = {1: [200, 600, 1300], 2: [draw.choice([3, 40, 300, 900, 1900]) for _ in range(400)]}
    rows = [(c, n, "user" if n % 2 else "assistant", "w " * k) for c, all_ in sizes.items() for n, k in enumerate(all_)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = windows(turns).orderBy("conv_id", "window").collect()
    for conv, all_ in sizes.items():
        mine = [r for r in out if r["conv_id"] == conv]
        assert [r["n_turns"] - r["n_context"] for r in mine] == plain_windows([k + 4 for k in all_], 2048 - 256)
        for r in mine:
            alone = r["n_turns"] - r["n_context"] == 1
            assert r["over_budget"] == (r["n_tokens"] > 2048) and (alone or not r["over_budget"])
            assert r["n_tokens"] == r["text"].count("w ") + 4 * r["n_turns"]
    assert [r["n_turns"] - r["n_context"] for r in out if r["conv_id"] == 1] == [2, 1]


def test_chat_sums_of_many_levels(spark, monkeypatch):
    """More turns than three levels of chunks hold, in one long conversation among short ones."""
    draw = random.Random(5)
    sizes = {c: [draw.choice([3, 40, 300]) for _ in range(90 if c == 2 else 5)] for c in range(6)}
    rows = [(c, n, "user" if n % 2 else "assistant", "w " * k) for c, all_ in sizes.items() for n, k in enumerate(all_)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    monkeypatch.setattr(ordered, "CHUNK", 4)
    out = windows(turns).orderBy("conv_id", "window").collect()
    for conv, all_ in sizes.items():
        new = [r["n_turns"] - r["n_context"] for r in out if r["conv_id"] == conv]
        assert new == plain_windows([k + 4 for k in all_], 2048 - 256)


def test_quality(spark):
    words = [f"w{n}" for n in range(400)]
    rows = [(n, " ".join(words[n : n + 60 + n % 40]) + ".\nnew line", "en", "s") for n in range(150)]
    rows += [
        (200, "# $ % | " * 60, "en", "s"), (201, None, None, None), (202, "", "en", "s"),
        (203, "same old thing " * 40, "en", "s"), (204, "###".join(words[:120]) + " " + " ".join(w + "####" for w in words[:200]), "en", "s"),
        (205, "few words", "xx", None), (206, " ".join(words[:80]), "xx", None),
    ]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, source string, grp int")
    got = {r["doc_id"]: r for r in quality(docs).collect()}
    assert all(got[n]["kept"] for n in range(150)) and got[206]["kept"]
    assert not any(got[n]["kept"] for n in (200, 201, 202, 203, 204, 205))
    assert not got[204]["base_failed"] and got[203]["n_repeat_words"] == 120
    assert (got[0]["n_words"], got[0]["n_dup_lines"], got[201]["word_chars"]) == (62, 0, 0)
    assert quality(docs.limit(0)).count() == 0


@pytest.mark.parametrize("clean", [120, 600])
def test_quality_rejects_outliers_of_one_statistic(spark, clean):
    draw = random.Random(clean)

    def words(count):
        return ["".join(draw.choices("abcdefghij", k=draw.randint(2, 9))) for _ in range(count)]

    def lines(count):
        return "\n".join(" ".join(words(draw.randint(8, 14))) for _ in range(count))

    rows = [(n, lines(draw.randint(8, 30)), "en", "s") for n in range(clean)]
    # Symbols are a tenth of the word characters; most lines are equal, few words beside them.
    junk = [(10_000 + n, " | ".join(words(150)), "en", "s") for n in range(12)]
    same = [(20_000 + n, lines(14) + "\nword" * 12, "en", "s") for n in range(3)]
    docs = spark.createDataFrame(rows + junk + same, "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r for r in quality(docs).collect()}
    assert not any(got[n]["base_failed"] for n in got)
    assert not any(got[n]["kept"] for n, *_ in junk + same)
    assert sum(got[n]["kept"] for n in range(clean)) >= 0.97 * clean


def test_language(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    train, held = docs.where("doc_id % 3 <> 1"), docs.where("doc_id % 3 = 1")
    model = fit(train)
    got = identify(held.drop("lang"), model).join(held.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) >= 0.95 * len(got)
    assert all(0 <= r["score"] <= 1 for r in got)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 _ !"), (None, "the")], "doc_id long, text string")
    found = {r["doc_id"]: r["lang_pred"] for r in identify(odd, model).collect()}
    assert found[1] == found[2] == found[3] == UNKNOWN and found[None] != UNKNOWN
    nothing = fit(train.limit(0))
    assert {r["lang_pred"] for r in identify(held, nothing).collect()} == {UNKNOWN}


def test_revisits(spark):
    assert [r[0] for r in spark.createDataFrame(
        [("HTTP://www.E.org:80/a/index.html?ref=x&b=2&a=1#f",), ("https://e.org/a?a=1&utm_x=3&b=2",), ("",)], "u string"
    ).select(canonical_url(F.col("u"))).collect()] == ["e.org/a?a=1&b=2", "e.org/a?a=1&b=2", ""]
    a, b = {"Date": "1", "X": "x"}, {"date": "2", "X": "no", "Vary": "v"}
    rows = [
        (1, "http://e.org/a", 1, "response", "t", "d", a), (2, "https://e.org/a/", 2, "revisit", "t", None, b),
        (3, "e.org/a", 3, "response", "u", "e", a), (4, "e.org/a", 3, "revisit", "u", None, b),
        (5, "e.org/a", 4, "revisit", None, "e", None), (6, "e.org/b", 9, "revisit", "t", None, b),
        (7, None, 9, "revisit", "t", None, b), (8, "e.org/a", 9, "revisit", "t", None, b),
    ]
    records = spark.createDataFrame(
        rows, "record_id long, url string, ts long, kind string, etag string, digest string, headers map<string,string>"
    )
    got = {r["record_id"]: (r["status"], r["response_id"]) for r in resolve_revisits(records).collect()}
    assert got == {
        2: ("resolved", 1), 4: ("changed", 1), 5: ("resolved", 3), 6: ("no_response", None),
        7: ("no_response", None), 8: ("changed", 3),
    }
    # Each revisit row gives one row, whatever its id; without a time nothing resolves or is resolved.
    rows = [(1, "e.org", 1, "response", "t", "d", a)] * 2 + [(2, "e.org", 2, "revisit", "t", None, b)] * 2
    rows += [(None, "e.org", 3, "revisit", 'W/"x"', "d", b), (None, "f.org", 1, "response", None, "d", a)]
    rows += [(None, "f.org", 2, None, None, "d", b), (5, "f.org", None, "revisit", None, "d", b)]
    rows += [(6, "g.org", None, "response", None, "d", a), (7, "g.org", 2, "revisit", None, "d", b)]
    rows += [(8, "h.org", 1, "response", None, "d", {"Last-Modified": "x"})]
    rows += [(9, "h.org", 2, "revisit", "t", "d", {"last-modified": "y"})]
    odd = spark.createDataFrame([(*r, "z") for r in rows], records.schema.add("latest", "string"))
    got = sorted(((r["record_id"], r["status"], r["response_id"]) for r in resolve_revisits(odd).collect()), key=str)
    assert got == sorted([
        (2, "resolved", 1), (2, "resolved", 1), (None, "changed", 1), (None, "resolved", None), (5, "no_response", None),
        (7, "no_response", None), (9, "changed", 8),
    ], key=str)
    merged = spark.range(1).select(merged_headers(
        F.create_map(F.lit("Date"), F.lit("1"), F.lit("X"), F.lit("x")),
        F.create_map(F.lit("date"), F.lit("2"), F.lit("X"), F.lit("no")))).first()[0]
    assert [tuple(h) for h in merged] == [("date", "2"), ("x", "x")]
    assert resolve_revisits(records.limit(0)).count() == 0


@pytest.mark.parametrize("chunk", [2, 4])
def test_revisits_of_many_levels(spark, monkeypatch, chunk):
    """More records than three levels of chunks hold; the latest response may lie many chunks before."""
    draw = random.Random(11)
    rows = [(0, "e.org/0", 0, "response", "t", None, None)]
    rows += [
        (i, f"e.org/{draw.randrange(3)}", i, draw.choices(["response", "revisit"], [1, 20])[0], "t", None, None)
        for i in range(1, 200)
    ]
    records = spark.createDataFrame(
        rows, "record_id long, url string, ts long, kind string, etag string, digest string, headers map<string,string>"
    )
    latest, want = {}, {}
    for i, url, _, kind, *_ in rows:
        if kind == "response":
            latest[url] = i
        else:
            want[i] = latest.get(url)
    monkeypatch.setattr(ordered, "CHUNK", chunk)
    assert {r["record_id"]: r["response_id"] for r in resolve_revisits(records).collect()} == want


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_running_sums_of_many_levels(spark, monkeypatch, keys):
    monkeypatch.setattr(ordered, "CHUNK", 3)
    draw = random.Random(2)
    rows = [(i // 40, i, draw.randrange(9)) for i in range(100)]
    got = ordered.running_sum(spark.createDataFrame(rows, "k long, at long, v long"), keys, "at", "v", "sum", 100)
    assert got.columns == ["k", "at", "v", "sum"]
    want = {i: sum(v for l, j, v in rows if j < i and (l == k or not keys)) for k, i, _ in rows}
    assert {r["at"]: r["sum"] for r in got.collect()} == want
