"""Covering SimHash, prefix tries and divergence of sources against brute force and SQL, on hard rows."""

from __future__ import annotations

import random
import re
from collections import defaultdict

import duckdb
import numpy as np
import pandas as pd
import xxhash

from wikiloom.llm import divergence, prefix_trie, simhash_covering
from wikiloom.llm.divergence_queries import OP11_SQL
from wikiloom.llm.trie_queries import OP12_SQL, rebuilding_plan


def plain_fingerprint(text, words):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(w[i : i + words]) for i in range(max(1, len(w) - words + 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(items, radius):
    """Smallest id reachable from each item of (id, fingerprint); None counts only if there is no other."""
    group = list(range(len(items)))
    for i, (_, a) in enumerate(items):
        for j, (_, b) in enumerate(items[:i]):
            if (a ^ b).bit_count() <= radius and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    ids = defaultdict(list)
    for g, (i, _) in zip(group, items):
        ids[g].append(i)
    return [min((i for i in ids[g] if i is not None), default=None) for g in group]


def test_masks_cover_every_set_of_bits():
    for bits, radius in ((list(range(64)), 4), (list(range(3, 40, 2)), 2), ([5], 4)):
        masks = simhash_covering.covering_masks(bits, radius)
        assert len(masks) == 2 ** (radius + 1) - 1
        draw = random.Random(1)
        for _ in range(3000):
            apart = sum(1 << b for b in draw.sample(bits, min(radius, len(bits))))
            assert any(m & apart == 0 for m in masks)
    assert all(28 <= m.bit_count() <= 36 for m in simhash_covering.covering_masks(list(range(64)), 4))


def near_texts():
    draw = random.Random(3)
    words = ["".join(draw.choices("abcdefghij", k=5)) for _ in range(400)]
    base = [draw.choice(words) for _ in range(300)]
    texts = [None, "", " \n\t", "One", "one", "a b c", "A b c d", "é ü ñ ø", "w " * 300_000, "w w w w", "\x85 \x1f b c d"]
    for _ in range(40):
        copy = list(base)
        for _ in range(draw.randint(0, 12)):
            copy[draw.randrange(300)] = draw.choice(words)
        texts.append(" ".join(copy))
    return [(None if i % 7 == 5 else i // 2 * 2, t) for i, t in enumerate(texts)]


def check_near(spark):
    rows = near_texts()
    docs = spark.createDataFrame(
        [(i, t, "f", 1) for i, t in rows], "doc_id long, text string, fp string, component_id int"
    ).repartition(3)
    got = simhash_covering.simhash_components(docs).collect()
    marks = [plain_fingerprint(t, 4) for _, t in rows]
    want = zip(rows, marks, plain_components([(i, m) for (i, _), m in zip(rows, marks)], 4))
    assert sorted(map(str, ((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got))) == sorted(
        map(str, ((i, f"{m:016x}", c) for (i, _), m, c in want))
    )
    assert simhash_covering.simhash_components(docs.limit(0)).count() == 0


def test_simhash_components(spark):
    check_near(spark)


def test_simhash_components_with_hot_buckets(spark, monkeypatch):
    monkeypatch.setattr(simhash_covering, "HOT", 2)
    monkeypatch.setattr(simhash_covering, "SMALL", 3)
    check_near(spark)


def test_links_connect_all_near_fingerprints(spark):
    rng = np.random.default_rng(5)
    center = rng.integers(0, 1 << 63, 4, dtype=np.uint64)
    points = set(center.tolist())
    for _ in range(600):  # tight balls and chains through them
        bits = rng.choice(64, rng.integers(1, 9), replace=False)
        points.add(int(rng.choice(center)) ^ sum(1 << int(b) for b in bits))
    points = sorted(points)
    signed = np.array(points, dtype=np.uint64).view(np.int64).tolist()
    links = simhash_covering.covering_links(spark.createDataFrame([(p,) for p in signed], "fp long"), 4)
    place = {p: i for i, p in enumerate(signed)}
    got = list(range(len(points)))
    for a, b in links.distinct().collect():
        assert ((a ^ b) & (2**64 - 1)).bit_count() <= 4
        old, new = got[place[a]], got[place[b]]
        got = [new if g == old else g for g in got]
    want = plain_components(list(enumerate(points)), 4)
    least = defaultdict(lambda: len(points))
    for i, g in enumerate(got):
        least[g] = min(least[g], i)
    assert [least[g] for g in got] == want


def rows_of(frame):
    def plain(value):
        return "none" if pd.isna(value) else str(int(value)) if isinstance(value, float) else str(value)

    return sorted(tuple(map(plain, row)) for row in frame[sorted(frame.columns)].itertuples(index=False))


def same_as_sql(got, sql, name, rows):
    connection = duckdb.connect()
    connection.register("given", rows)
    connection.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
    want = connection.execute(sql).df()
    assert sorted(got.columns) == sorted(want.columns) and rows_of(got) == rows_of(want)
    return want


def dialogues():
    draw = random.Random(11)
    said = ["hi", "", None, "é😀 long " * 20, "yes", "no", "same words here"]
    rows = []
    for conv in [0, 1, 2, 3, 7, 50, 99, 100, 101, 140, 205, 206, 320]:
        for turn in range(draw.randint(1, 9)):
            rows.append((conv, turn, draw.choice(["user", "assistant", None]), draw.choice(said)))
    rows += [(conv, t, r, x) for conv in (11, 12, 111) for c, t, r, x in rows if c == 3]  # equal conversations
    rows += [(8, None, "user", "null turn"), (8, 0, "user", "b"), (8, 0, "user", "a"), (8, 0, "user", "a")]
    rows += [(9, 0, "a", "bc"), (9, 1, "ab", "c"), (10, 0, "ab", "c"), (10, 1, "a", "bc")]
    rows += [(13, 0, "u", "only turn"), (None, 0, "user", "no conversation"), (None, 1, None, None)]
    rows += [(400, t, "user", f"turn {t % 3}") for t in range(3000)]  # over several tasks
    rows += [(c, t, "user", f"turn {t % 3}") for c in (401, 402, 403) for t in range(8)]
    return pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype(
        {"conv_id": "Int64", "turn": "Int64"}
    )


# The SQL keeps whole paths, too much for the long conversation: there, nodes are counted.
def trie(spark, rows):
    plain = [
        (None if pd.isna(c) else int(c), None if pd.isna(t) else int(t), r, x)
        for c, t, r, x in rows.itertuples(index=False, name=None)
    ]
    turns = spark.createDataFrame(
        [(*r, 1, 2) for r in plain], "conv_id long, turn long, role string, text string, depth int, print int"
    ).repartition(5)
    return prefix_trie.prefix_trie(turns, rebuilding_plan(turns), 5)


def test_prefix_trie(spark):
    rows = dialogues()
    short = rows[rows["conv_id"].isna() | (rows["conv_id"] != 400)]
    got = trie(spark, short).drop("ref_conv", "ref_place").toPandas()
    want = same_as_sql(got, OP12_SQL, "conversations", short)
    assert (want["n_convs"] > 1).sum() > 3 and want["n_leaves"].max() > 5
    assert trie(spark, short[:0]).count() == 0


def test_prefix_trie_of_a_long_conversation(spark):
    rows = dialogues()
    long = rows[rows["conv_id"].notna() & (rows["conv_id"] >= 400)]
    nodes = {(r["conv_id"], r["depth"]): r for r in trie(spark, long).collect()}
    assert all((400, d) in nodes for d in range(3001))
    end = nodes[400, 3000]
    assert end["n_children"] == 0 and end["n_leaves"] == 1 and end["saved_tokens"] == 0
    assert end["ref_conv"] == 400 and end["ref_place"] == 3000
    top = nodes[400, 0]
    assert top["saved_tokens"] == sum(
        (r["n_convs"] - 1) * len("turn 0") for (_, d), r in nodes.items() if d > 0
    )


def test_equal_fingerprints_of_unlike_prefixes_are_found(spark, monkeypatch):
    rows = dialogues()
    short = rows[rows["conv_id"].notna() & rows["conv_id"].isin([9, 10])]
    want = rows_of(trie(spark, short).toPandas())
    good = prefix_trie.MULTIPLIERS[0]
    monkeypatch.setattr(prefix_trie, "MULTIPLIERS", [1, good])  # with 1, order does not matter
    assert rows_of(trie(spark, short).toPandas()) == want


def corpus():
    draw = random.Random(2)
    words = ["Alpha", "alpha", "beta", "ÉTÉ", "naïve", "don't", "x9y", "日本", "\x85nel", "rare"]
    rows = []
    for i in range(200):
        lang = draw.choice(["en", "de", None, ""])
        source = draw.choice(["s1", "s2", "s3", None])
        rows.append((lang, source, " ".join(draw.choices(words, k=draw.randint(0, 30)))))
    rows += [("en", "empty", None), ("en", "blank", ""), ("fr", "one", "few words"), ("fr", "two", "few"), ("it", "alone", "x")]
    rows += [("en", "long", "alpha beta " * 150_000), ("en", "long", "alpha beta")] + [("en", "s1", "alpha")] * 9
    return pd.DataFrame(rows, columns=["lang", "source", "text"])


def test_source_divergence(spark, monkeypatch):
    rows = corpus()
    docs = spark.createDataFrame(
        [(*r, "x", 7) for r in rows.itertuples(index=False, name=None)],
        "lang string, source string, text string, term string, rank int",
    ).repartition(4)
    got = divergence.source_divergence(docs).toPandas()
    want = same_as_sql(got, OP11_SQL, "documents", rows)
    assert (want["lang"] == "fr").sum() == 2 and not (want["lang"] == "it").any()
    for name, value in (("CHUNK", 2), ("HELD_SUMS", 3), ("HELD_TERMS", 5), ("HISTOGRAM", 2)):
        monkeypatch.setattr(divergence, name, value)
    assert rows_of(divergence.source_divergence(docs).toPandas()) == rows_of(want)
    assert divergence.source_divergence(docs.limit(0)).count() == 0
