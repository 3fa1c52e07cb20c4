from __future__ import annotations

import random

from pyspark.sql import functions as F

from wikiloom.functions.keys import wiki_title
from wikiloom.operators import tree

SCHEMA = "id string, parent_id string, position int, ord long, title string"


def breadth_first(nodes):
    """Order by a queue, roots and children sorted by (position, ord)."""
    ids = {n[0] for n in nodes}
    below, roots = {}, []
    for node in nodes:
        (below.setdefault(node[1], []) if node[1] in ids else roots).append(node)
    queue, out = sorted(roots, key=lambda n: (n[2], n[3])), []
    while queue:
        node = queue.pop(0)
        out.append(node[0])
        queue += sorted(below.get(node[0], []), key=lambda n: (n[2], n[3]))
    return out


def test_push_order_equals_a_queue(spark):
    rng = random.Random(7)
    nodes = [
        (str(i), str(rng.randrange(-3, i)) if i else None, rng.randrange(3), i, f"t {i}")
        for i in range(300)
    ]
    frame = spark.createDataFrame(nodes, SCHEMA).repartition(5)
    paths = tree.tree_paths(frame, ["position", "ord"])
    rows = tree.push_order(paths).orderBy("ord").collect()
    assert [r.id for r in rows] == breadth_first(nodes)
    place = {r.id: r["ord"] for r in rows}
    assert all(r.parent_id is None or place[r.parent_id] < place[r.id] for r in rows)


def test_long_chain(spark):
    nodes = [(str(i), str(i - 1) if i else None, 0, i, "t") for i in range(100)]
    paths = tree.tree_paths(spark.createDataFrame(nodes, SCHEMA), ["ord"])
    assert {(r.id, r.depth) for r in paths.collect()} == {(str(i), i) for i in range(100)}


def test_paths_of_deep_trees_stay_narrow(spark):
    """Branches of a deep tree keep the order of a queue, and no row holds the keys of all its ancestors."""
    rng = random.Random(3)
    nodes = [
        (str(i), str(max(i - rng.randrange(1, 4), 0)) if i else None, rng.choice([0, 1, None]), i, "t")
        for i in range(160)
    ]
    by_queue = breadth_first([(*n[:2], -1 if n[2] is None else n[2], *n[3:]) for n in nodes])
    paths = tree.tree_paths(spark.createDataFrame(nodes, SCHEMA), ["position", "ord"])
    rows = tree.push_order(paths).orderBy("ord").collect()
    assert [r.id for r in rows] == by_queue
    assert max(r.depth for r in rows) > 60
    assert max(len(r.path) for r in rows) <= tree.PATH_KEYS


def test_circles_are_reported(spark):
    nodes = [("a", None, 0, 0, "t"), ("b", "c", 0, 1, "t"), ("c", "b", 0, 2, "t"),
             ("d", "b", 0, 3, "t"), ("e", "e", 0, 4, "t"), ("f", "gone", 0, 5, "t")]
    frame = spark.createDataFrame(nodes, SCHEMA)
    paths = tree.tree_paths(frame, ["ord"])
    assert {r.id for r in paths.collect()} == {"a", "f"}
    assert {r.id for r in tree.unreached_pages(frame, paths).collect()} == {"b", "c", "d", "e"}


def test_child_links_and_parent_titles(spark):
    nodes = [("p", None, 0, 0, "Top 1")] + [(f"c{i}", "p", 9 - i, i, f"C {i}") for i in range(3)]
    frame = spark.createDataFrame(nodes, SCHEMA).withColumn("wiki_title", wiki_title(F.col("title")))
    links = tree.child_links(frame, ["position", "ord"]).collect()
    assert [r.id for r in links] == ["p"]
    assert tree.child_links(frame, ["position", "ord"], part_rows=2).collect() == links
    assert links[0].child_text == (
        "\n\n---\n\n## Child pages\n\n- [[C_002|C 2]]\n- [[C_001|C 1]]\n- [[C_000|C 0]]\n"
    )
    titles = {r.id: r.parent_title for r in tree.with_parent_title(frame).collect()}
    assert titles == {"p": None, "c0": "Top_001", "c1": "Top_001", "c2": "Top_001"}


def test_size_estimates_stay_small_in_deep_trees(spark):
    """The planner's estimate must not be multiplied from round to round, which takes the driver's memory."""
    nodes = [(str(i), str(i - 1) if i else None, 0, i, "t") for i in range(200)]
    paths = tree.tree_paths(spark.createDataFrame(nodes, SCHEMA), ["ord"])
    assert paths._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().bit_length() < 100
    assert {(r.id, r.depth) for r in paths.collect()} == {(str(i), i) for i in range(200)}
