from __future__ import annotations

import random
from collections import Counter

from wikiloom.operators import versions as ops


def changes(frame):
    placed = ops.history(frame.select("page_id", "number"))
    return ops.line_changes(ops.version_changes(ops.consecutive_pairs(placed, frame)), frame)


def test_line_changes_match_a_count_of_lines(spark):
    rng = random.Random(3)
    bodies = []
    for page in range(20):
        lines = [rng.choice("abcdef") for _ in range(8)]
        for number in range(1, 6):
            bodies.append((page, number, "\n".join(lines)))
            for _ in range(rng.randrange(3)):
                lines[rng.randrange(len(lines))] = rng.choice(["x", "y", "++z", "--w"])
    frame = spark.createDataFrame(bodies, "page_id long, number long, body string")
    got = {
        (r.page_id, r.number): (r.state, r.added, r.removed) for r in changes(frame).collect()
    }
    texts = {(p, n): b for p, n, b in bodies}
    for (page, number), found in got.items():
        old, new = (Counter(texts[page, n].split("\n")) for n in (number - 1, number))
        state = "identical" if texts[page, number - 1] == texts[page, number] else "changed"
        assert found == (state, (new - old).total(), (old - new).total())
    assert len(got) == 80


def test_gaps(spark):
    have = {1: [1, 2, 5, 6, 9], 2: [4], 3: [10, 40_000]}
    frame = spark.createDataFrame(
        [(p, n) for p, ns in have.items() for n in ns], "page_id long, number long"
    )
    got = {(r.page_id, r.number) for r in ops.missing_numbers(frame, block=1000).collect()}
    want = {(p, n) for p, ns in have.items() for n in range(min(ns), max(ns)) if n not in ns}
    assert got == want


def test_caps_and_batches(spark):
    frame = spark.createDataFrame(
        [(1, n) for n in (2, 3, 7, 8, 9)] + [(2, 4)], "page_id long, number long"
    )
    placed = ops.history(frame)
    assert {(r.page_id, r.number) for r in ops.capped(placed, 2).collect()} == {(1, 7), (1, 8)}
    assert {r.number for r in ops.capped(placed).collect()} == {2, 3, 7, 8}
    report = {r.page_id: (r.total, r.kept, r.skipped, r.large) for r in ops.cap_report(placed, 2).collect()}
    assert report == {1: (5, 2, 2, False), 2: (1, 0, 0, False)}
    batches = {(r.number, r.batch) for r in ops.version_batches(ops.capped(placed, 3), 3, 2).collect()}
    assert batches == {(3, 0), (7, 0), (8, 1)}
    large = ops.cap_report(ops.history(spark.range(502).selectExpr("1L AS page_id", "id AS number")))
    assert large.first().large


def cut(outcomes, limit=5):
    run = 0
    for attempt, outcome in enumerate(outcomes):
        if outcome == "failed":
            run += 1
            if run == limit:
                return attempt
        elif outcome == "ok":
            run = 0
    return None


def test_cut_after_failures(spark):
    rng = random.Random(5)
    pages = {
        p: rng.choices(["failed", "ok", "not_found"], [6, 1, 1], k=40) for p in range(30)
    }
    pages[30] = ["failed"] * 4
    pages[31] = ["failed"] * 4
    frame = spark.createDataFrame(
        [(p, i, o) for p, os in pages.items() for i, o in enumerate(os)],
        "page_id long, attempt long, outcome string",
    )
    cuts = ops.cut_after_failures(frame)
    got = {r.page_id: r.cut_at for r in cuts.collect()}
    want = {p: cut(os) for p, os in pages.items()}
    assert got == {p: c for p, c in want.items() if c is not None}
    kept = ops.before_cut(frame, cuts).count()
    assert kept == sum(len(os) if want[p] is None else want[p] + 1 for p, os in pages.items())


def test_empty_bodies(spark):
    bodies = spark.createDataFrame(
        [(1, 1, ""), (1, 2, None), (1, 3, "a")], "page_id long, number long, body string"
    )
    rows = changes(bodies).orderBy("number").collect()
    assert [(r.state, r.added, r.removed) for r in rows] == [("both empty", 0, 0), ("changed", 1, 0)]


def test_content_groups(spark):
    bodies = spark.createDataFrame(
        [(1, "a", "x"), (1, "b", "x"), (1, "c", None), (2, "a", "x"), (2, "b", "y")],
        "page_id long, source string, body string",
    )
    verdicts = {r.page_id: (r.contents, r.verdict) for r in ops.content_verdict(ops.content_groups(bodies)).collect()}
    assert verdicts == {1: (1, "identical"), 2: (2, "mismatch")}
