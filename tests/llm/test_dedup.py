"""Exact and near copies against brute force, on hard rows and on the whole small table."""

from __future__ import annotations

import itertools
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from wikiloom.llm.components import components
from wikiloom.llm.cqf import build_block, exact_groups, merge_sorted, read_block
from wikiloom.llm.jaccard_join import (
    Shells, chunk_blocks, folded, from_varints, jaccard_components, near_pairs, shared_keys, sketch_of, varints,
)
from wikiloom.llm import shingles
from wikiloom.llm.shingles import shingle_sets

HARD = [
    (4, "a b\t c"), (2, "a b c"), (9, "a  b\nc"), (1, None), (3, ""), (3, ""), (6, " "), (None, "a b c d"),
    (8, "w " * 30_000), (7, "W " * 30_000), (5, "one"),
]


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, t, 1, "k", "p") for i, t in rows], "doc_id long, text string, n long, keep_id string, point string"
    )


def test_filter_blocks_merge_without_loss():
    rng = np.random.default_rng(1)
    shift = 64 - 6 - 12
    parts, whole = [], Counter()
    for _ in range(5):
        values = rng.integers(0, 1 << 58, 300, dtype=np.uint64) | (np.uint64(9) << np.uint64(58))
        values[:200] = rng.choice(np.arange(9 << 58, (9 << 58) + 150, dtype=np.uint64), 200)
        v, c = np.unique(values, return_counts=True)
        whole.update(dict(zip(v.tolist(), c.tolist())))
        parts.append(read_block(9, *build_block(v, c.astype(np.uint64), shift), shift))
    values, counts = merge_sorted(parts)
    assert dict(zip(values.tolist(), counts.tolist())) == whole


def test_exact_groups(spark):
    got = {}
    for r in exact_groups(frame(spark, HARD)).collect():
        got.setdefault(r["doc_id"], []).append((r["keep_id"], r["group_size"], r["kept"]))
    assert got[2] == [(2, 3, True)] and got[4] == [(2, 3, False)] and got[9] == [(2, 3, False)]
    assert got[1] == [(1, 3, True)] and got[3] == [(1, 3, False)] * 2
    assert got[6] == [(6, 1, True)] and got[None] == [(None, 1, True)]
    assert exact_groups(frame(spark, HARD).limit(0)).count() == 0


def brute(rows, words, percent):
    found = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        found.append({tuple(w[k : k + words]) for k in range(max(1, len(w) - words + 1))} if w else set())
    up = list(range(len(rows)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    holders, both = defaultdict(list), Counter()
    for i, s in enumerate(found):
        for g in s:
            holders[g].append(i)
    for group in holders.values():
        both.update(itertools.combinations(group, 2))
    for (a, b), n in both.items():
        if 100 * n >= percent * (len(found[a]) + len(found[b]) - n):
            up[top(a)] = top(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[top(k)] = min(least.get(top(k), i), i)
    return sorted((i, len(found[k]), least[top(k)]) for k, (i, _) in enumerate(rows))


@pytest.mark.parametrize("words,percent", [(3, 90), (2, 60)])
def test_jaccard_components(spark, words, percent):
    rng = np.random.default_rng(5)
    rows, number = [(i, t) for i, t in HARD if i is not None and i != 3] + [(3, "")], 100
    for _ in range(12):
        base = rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(4, 120)).tolist()
        for _ in range(rng.integers(1, 15)):
            copy = list(base)
            for _ in range(rng.integers(0, 5)):
                copy[rng.integers(0, len(copy))] = "x" + str(rng.integers(0, 9))
            rows.append((number, " ".join(copy)))
            number += 1
    got = jaccard_components(frame(spark, rows), words, percent).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute(rows, words, percent)


def test_jaccard_empty_and_null(spark):
    assert jaccard_components(frame(spark, HARD).limit(0)).count() == 0
    got = jaccard_components(frame(spark, [(None, "a b c"), (1, None), (2, None)])).collect()
    assert sorted((r["doc_id"] or 0, r["n_shingles"]) for r in got) == [(0, 1), (1, 0), (2, 0)]
    assert all(r["component_id"] == r["doc_id"] for r in got)


def test_regions_hold_all_near_pairs():
    rng = np.random.default_rng(3)
    for percent in (50, 80, 90):
        shells = Shells(percent)
        for _ in range(200):
            n = int(rng.integers(1, 60))
            a = np.unique(rng.integers(0, 1 << 60, n, dtype=np.uint64))
            drop = int(rng.integers(0, len(a)))
            b = np.unique(np.concatenate([a[drop // 4 :], rng.integers(0, 1 << 60, drop // 5, dtype=np.uint64)]))
            both = len(np.intersect1d(a, b))
            if both and 100 * both >= percent * (len(a) + len(b) - both):
                assert len(np.intersect1d(shells.keys(a), shells.keys(b)))


def test_numbers_of_any_size_come_back():
    rng = np.random.default_rng(6)
    values = rng.integers(0, 1 << 63, 500, dtype=np.uint64) >> rng.integers(0, 63, 500).astype(np.uint64)
    values = np.append(values, np.array([0, 127, 128, (1 << 63) - 1], dtype=np.uint64))
    assert (from_varints(varints(values)) == values).all()
    assert varints(values[:0]) == b"" and not len(from_varints(b""))


def test_blocks_keep_all_rows_of_keys_that_meet_again():
    rng = np.random.default_rng(7)
    edges = np.array([0, 300, 301, 700, 1 << 12], dtype=np.uint64)
    held, got, every = {}, set(), {}
    for chunk in range(4):
        keys = rng.integers(0, 1 << 12, 400, dtype=np.uint64)
        rows = rng.integers(chunk * 1000, chunk * 1000 + 900, 400)
        keys[:60], keys[60:63], rows[61] = 5, 300 + chunk, rows[60]  # a hot key, a repeated row
        for k, r in zip(keys.tolist(), rows.tolist()):
            every.setdefault(k, set()).add(r)
        for bucket, base, coded, places in chunk_blocks(keys, rows, edges):
            if bucket < 0:
                more = np.cumsum(from_varints(coded), dtype=np.uint64)
                got |= set(zip(more.tolist(), (from_varints(places).astype(np.int64) + base).tolist()))
            else:
                held.setdefault(bucket, []).append((base, coded, places))
    entries = sum(len(from_varints(k)) for blocks in held.values() for _, k, _ in blocks)
    assert entries < 4 * 400 - 4 * 59 + 4  # one entry of the hot key a chunk
    for blocks in held.values():
        keys, rows = shared_keys(blocks)
        got |= set(zip(keys.tolist(), rows.tolist()))
    assert got == {(k, r) for k, rows in every.items() if len(rows) > 1 for r in rows}


def test_sketches_never_overstate_distance():
    rng = np.random.default_rng(8)
    for n, m in [(3, 5), (900, 1100), (1000, 1300), (5000, 4000), (70_000, 60_000)]:
        a = np.unique(rng.integers(0, 1 << 62, n, dtype=np.uint64))
        b = np.unique(np.append(a[: n // 2], rng.integers(0, 1 << 62, m - n // 2, dtype=np.uint64)))
        pair = [sketch_of(a), sketch_of(b)]
        x, y = folded(pair, min(map(len, pair)))
        assert np.abs(x - y).sum() <= len(np.setxor1d(a, b))


@pytest.mark.parametrize("tasks", ["1", "7"])
def test_jaccard_of_repeated_null_ids_and_hot_passages(spark, tasks):
    rng = np.random.default_rng(9)
    shared = " ".join(f"s{i}" for i in range(40))
    rows = [(i, shared + " " + " ".join(f"w{rng.integers(0, 10**9)}" for _ in range(60))) for i in range(300)]
    rows += [(1000 + i, rows[0][1] + f" e{i}") for i in range(200)]
    nulls = [(None, "p q r s t"), (None, "p q r s t"), (None, "p q r s u")]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", tasks)
    try:
        got = jaccard_components(frame(spark, rows + nulls), 3, 90).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(got) == 503 and sum(r["doc_id"] is None for r in got) == 3
    found = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got if r["doc_id"] is not None)
    assert found == brute(rows, 3, 90)


def test_near_pairs_loses_none():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 4, (6, 1024))
    vectors = np.clip(base[rng.integers(0, 6, 300)] + (rng.random((300, 1024)) < 0.02), 0, 255).astype(np.uint8)
    sizes = vectors.sum(axis=1).astype(np.int64)
    got = {tuple(sorted(p)) for p in near_pairs(vectors, sizes, np.arange(300), 90).tolist()}
    for a, b in itertools.combinations(range(300), 2):
        apart = np.abs(vectors[a].astype(int) - vectors[b]).sum()
        if 190 * apart <= 10 * (sizes[a] + sizes[b]) and 100 * min(sizes[a], sizes[b]) >= 90 * max(sizes[a], sizes[b]):
            assert (a, b) in got


def test_components(spark):
    links = [(1, 2), (2, 3), (10, 11), (3, 1), (20, 19), (19, 18), (18, 17), (17, 16)]
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {1: 1, 2: 1, 3: 1, 10: 10, 11: 10, 16: 16, 17: 16, 18: 16, 19: 16, 20: 16}


def test_shingles_of_case_and_space():
    a, b, c = shingle_sets(["A b\x0bC d", "a B c\rD", "a b c é"], 3)
    assert (a == b).all() and len(a) == 2 and len(np.intersect1d(a, c)) == 1


def test_tables_that_a_worker_keeps_are_small(monkeypatch):
    monkeypatch.setattr(shingles, "_kept", [])
    long = "ab cd ef " * 300_000
    whole = shingle_sets([long], 2)[0].tolist()
    assert sum(t.nbytes for t in shingles._kept) <= 16 << 20
    part = long[: shingles.SLICE - 1]
    assert shingle_sets([part], 2)[0].tolist() == whole
    assert 0 < sum(t.nbytes for t in shingles._kept) <= 16 << 20
