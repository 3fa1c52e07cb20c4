"""The plan of a running wiki on bodies with and without links."""

from __future__ import annotations

from wikiloom.plans.site import SiteTables, revisions

LINK = '<p><a href="/pages/viewpage.action?pageId=2">two</a></p>'
SHOWN = '<p><a href="/display/BB/Two">there</a> <a href="/display/ZZ/Two">off</a></p>'


def site(spark, bodies, current):
    def frame(rows, schema):
        return spark.createDataFrame(rows, schema)

    spaces = frame([("AA", "Space A", "global", 0), ("BB", "Space B", "global", 1)],
                   "key string, name string, type string, ord long")
    projects = frame([("aa", 1, "A"), ("bb", 2, "B")], "identifier string, id long, name string")
    pages = frame(
        [("1", "One", "AA", None, 1), ("2", "Two", "BB", None, 2), ("3", "Three", "AA", [("1", "One")], 3)],
        "id string, title string, space_key string, ancestors array<struct<id: string, title: string>>, ord long",
    )
    versions = frame([b[:2] for b in bodies] + [(p, 9) for p, _ in current], "page_id string, number int")
    old = frame([(*b, "ann", "2024") for b in bodies], "page_id string, number int, body string, author string, when string")
    now = frame([(*c, "bob", "2024") for c in current], "page_id string, body string, author string, when string")
    files = frame([], "page_id string, title string, media_type string, download string, ord long")
    return SiteTables(spaces, projects, None, pages, versions, old, now, files)


def texts(rows):
    return {(r.page_id, r.number): r.text for r in rows.collect()}


def test_links_of_old_and_current_bodies(spark):
    bodies = [("1", 1, LINK), ("1", 2, "<p>plain</p>"), ("1", 3, None), ("3", 1, SHOWN), ("7", 1, LINK)]
    rows = revisions(site(spark, bodies, [("1", SHOWN), ("2", LINK), ("3", "<p>x</p>")]))
    # All bodies are read by one scan, so their conversion is planned once.
    assert rows._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 1
    got = texts(rows)
    assert set(got) == {("1", 1), ("1", 2), ("1", 3), ("1", None), ("2", None), ("3", 1), ("3", None)}
    assert "{{wiki(bb, Two, two)}}" in got["1", 1] and "[[Two|two]]" in got["2", None]
    assert got["1", 2] == "# One\n\nplain\n\n<!-- Confluence version 2/4 -->"
    assert got["1", 3] == "# One\n\n*Empty version*\n\n<!-- Confluence version 3/4 -->"
    shown = "{{wiki(bb, Two, there)}} {{wiki(zz, Two, off)}}"
    assert shown in got["3", 1] and shown in got["1", None]
    assert got["3", None] == "# Three\n\nx" and got["1", None].endswith("{{child_pages}}\n")


def test_bodies_all_with_links_or_none(spark):
    linked = revisions(site(spark, [("1", 1, LINK)], [("1", LINK)]))
    assert all("{{wiki(bb, Two, two)}}" in t for t in texts(linked).values()) and linked.count() == 2
    assert texts(revisions(site(spark, [], [("2", "<p>x</p>")]))) == {("2", None): "# Two\n\nx"}
    assert revisions(site(spark, [], [])).count() == 0
