from __future__ import annotations

import json

from pyspark.sql import functions as F

from wikiloom.operators import pages as page_ops
from wikiloom.plans import export as export_plan
from wikiloom.sources import export, landed, sinks

EXPORT = """<?xml version="1.0" encoding="UTF-8"?>
<objects>
<object class="Page" package="w"><id name="id">1</id>
  <property name="title"><![CDATA[Top & more]]></property>
  <property name="version">3</property><property name="position"></property>
  <property name="contentStatus"><![CDATA[current]]></property>
  <property name="lastModifierName">ann</property>
  <property name="lastModificationDate">2024-05-06 07:08:09.123</property>
  <collection name="bodyContents"><element class="BodyContent"><id name="id">11</id></element>
    <element><id name="id"> 12 </id></element></collection>
</object>
<object class="Page" package="w"><id name="id">2</id><property name="title">Old</property>
  <property name="version">2</property>
  <property name="originalVersion" class="Page"><id name="id">1</id></property></object>
<object class="Page" package="w"><id name="id">3</id><property name="title">Kid 1</property>
  <property name="version">1</property><property name="position">4</property>
  <property name="parent" class="Page"><id name="id">1</id></property></object>
<object class="Page" package="w"><id name="id">4</id><property name="title">Draft</property>
  <property name="contentStatus">draft</property></object>
<object class="Page" package="w"><id name="id">5</id><property name="title"></property></object>
<object class="BodyContent" package="w"><id name="id">11</id>
  <property name="body"><![CDATA[<p>line one
line two</p><ac:structured-macro ac:name="code"><ac:plain-text-body><![CDATA[a <b> &]] ></ac:plain-text-body></ac:structured-macro>]]></property>
  <property name="bodyType">2</property></object>
<object class="BodyContent" package="w"><id name="id">13</id><property name="body">other</property>
  <property name="content" class="Page"><id name="id">1</id></property>
  <property name="bodyType">0</property></object>
<object class="BodyContent" package="w"><id name="id">14</id><property name="body">old text</property>
  <property name="content" class="Page"><id name="id">2</id></property></object>
<object class="Attachment" package="w"><id name="id">21</id><property name="fileName"></property>
  <property name="title">my file.png</property>
  <property name="containerContent" class="Page"><id name="id">1</id></property></object>
<object class="Attachment" package="w"><id name="id">22</id><property name="fileName">gone.png</property>
  <property name="content" class="Page"><id name="id">1</id></property>
  <property name="contentStatus">deleted</property></object>
<object class="Space" package="w"><id name="id">9</id></object>
<object class="Page" package="w"><id name="id">3</id><property name="title">Kid 2</property>
  <property name="version">1</property>
  <property name="parent" class="Page"><id name="id">1</id></property></object>
</objects>
"""


def objects(spark, tmp_path):
    (tmp_path / "entities.xml").write_text(EXPORT, encoding="utf-8")
    return export.read_objects(spark, str(tmp_path / "entities.xml"))


def test_export_tables(spark, tmp_path):
    table = objects(spark, tmp_path)
    counts = {r["class"]: r.objects for r in export.class_counts(table).collect()}
    assert counts == {"Page": 6, "BodyContent": 3, "Attachment": 2, "Space": 1}
    pages = {r.id: r for r in export.export_pages(table).collect()}
    assert pages["1"].title == "Top & more" and pages["1"].version == 3 and pages["1"].position == 0
    assert pages["1"].body_content_ids == ["11", "12"]
    assert pages["2"].original_version_id == "1"
    assert pages["3"].title == "Kid 2" and pages["3"].parent_id == "1"
    bodies = {r.id: r for r in export.export_bodies(table).collect()}
    assert "line one\nline two" in bodies["11"].body and "&]]></ac" in bodies["11"].body
    files = {r.id: r for r in export.export_attachments(table).collect()}
    assert files["21"].filename == "my file.png" and files["21"].version == 1
    assert files["22"].content_id == "1"
    assert {r.id for r in page_ops.current_pages(export.export_pages(table)).collect()} == {"1", "3"}


def test_one_file_is_read_by_several_tasks(spark, tmp_path):
    """Splits of one file cut objects anywhere; bodies hold the tags of objects and marks of CDATA."""
    import random
    import xml.etree.ElementTree as ET

    draw = random.Random(3)
    parts = [
        "text ", "line\nline ", "</object>", '<object class="Page"><id name="id">77</id></object>', "<![CDATA[",
        "]] >", "é日 ", "</objects>", "x" * 300, "&amp;",
    ]
    lines = ['<?xml version="1.0" encoding="UTF-8"?>', "<objects>"]
    for i in range(400):
        body = "a" + "".join(draw.choices(parts, k=draw.randint(0, 12))) + "z"
        if draw.random() < 0.5:
            value = f"<![CDATA[{body}]]>"
        else:
            value = body.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")
        more = f'<property name="title"><![CDATA[t {body}]]></property>' if draw.random() < 0.3 else ""
        lines.append(f'<object class="BodyContent"><id name="id">{i}</id><property name="body">{value}</property>{more}</object>')
    lines.append("</objects>")
    (tmp_path / "entities.xml").write_text("\n".join(lines), encoding="utf-8")
    want = [
        (e.find("id").text, e.find("property").text, len(e.findall("property")))
        for e in ET.fromstringlist(lines).findall("object")
    ]
    split = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(split)
    for size in ("7k", "20k", before):
        spark.conf.set(split, size)
        table = export.read_objects(spark, str(tmp_path))
        got = table.orderBy("ord").collect()
        assert [(r["id"]["_VALUE"], r["property"][0]["_VALUE"], len(r["property"])) for r in got] == want
        if size == "7k":
            assert spark.read.option("lineSep", "</object>").text(str(tmp_path)).rdd.getNumPartitions() > 8
    spark.conf.set(split, before)


def test_the_last_file_wins_whatever_its_size(spark, tmp_path):
    def page(number, title):
        return f'<object class="Page"><id name="id">{number}</id><property name="title">{title}</property></object>'

    for name, titles in (("a", ["first"]), ("b", ["second" * 50] * 40 + ["last"]), ("c", ["third"])):
        rows = "".join(page(1 if name < "c" else 2, t) for t in titles)
        (tmp_path / f"{name}.xml").write_text(f"<objects>{rows}</objects>", encoding="utf-8")
    table = export.read_objects(spark, str(tmp_path))
    assert table.select("ord").distinct().count() == 43 and table.where("ord is null").count() == 0
    assert {r.id: r.title for r in export.export_pages(table).collect()} == {"1": "last", "2": "third"}


def test_export_plan(spark, tmp_path):
    tables = export_plan.load_export(objects(spark, tmp_path))
    rows = export_plan.export_revisions(tables).orderBy("ord", "position").collect()
    got = [(r.wiki_title, r.comments, r.parent_title, r.is_current) for r in rows]
    assert got == [
        ("Top_more", "v2 by ", None, False),
        ("Top_more", "v3 by ann (2024-05-06 07:08:09)", None, True),
        ("Top_more", "Final version with attachments", None, True),
        ("Kid_2", None, "Top_more", True),
    ]
    assert rows[0].text.startswith("# Old\n\nold text")
    assert rows[1].text == (
        "# Top & more\n\nline one\nline two\n\n```\na <b> &\n```"
        "\n\n---\n\n## Child pages\n\n- [[Kid_2|Kid 2]]\n"
    )
    assert rows[3].text == "# Kid 2\n\n*Empty page migrated from Confluence*"
    single = export_plan.export_revisions(tables, with_history=False)
    assert single.where("wiki_title = 'Top_more'").count() == 1


def test_files_are_bound(spark, tmp_path):
    table = objects(spark, tmp_path)
    place = tmp_path / "attachments" / "1" / "21"
    place.mkdir(parents=True)
    for name in ("2", "10", "x"):
        (place / name).write_bytes(b"abc")
    files = export.list_files(spark, str(tmp_path / "attachments"))
    assert {r.length for r in files.collect()} == {3}
    bound = export.bind_files(export.export_attachments(table), files).collect()
    paths = {r.id: r.path for r in bound}
    assert paths["21"].endswith("/1/21/10") and paths["22"] is None


def test_manifest(spark, tmp_path):
    table = objects(spark, tmp_path)
    pages = export.export_pages(table)
    texts = page_ops.chosen_bodies(pages, export.export_bodies(table)).withColumnRenamed("page_id", "id")
    held = page_ops.kept_attachments(export.export_attachments(table))
    sinks.write_json(sinks.manifest(pages.join(texts, "id"), held), str(tmp_path / "manifest"))
    back = {r.id: r for r in spark.read.json(str(tmp_path / "manifest")).collect()}
    assert back["1"].attachment_count == 1 and back["1"].attachments[0].filename == "my file.png"
    assert back["2"].body_length == len("old text") and back["4"].attachment_count == 0


def test_pages_from_both_places(spark, tmp_path):
    rows = [
        {"space_key": "A", "start": 0, "results": [{"id": "1", "title": "a"}, {"id": "2", "title": "b"}]},
        {"space_key": "A", "start": 2, "results": [], "page": {"results": [{"id": "3", "title": "c"}]}},
        {"space_key": "B", "start": 0},
    ]
    path = tmp_path / "pages.json"
    path.write_text("\n".join(json.dumps(r) for r in rows))
    got = landed.read_pages(spark, str(path)).orderBy("ord").select("id", "ord").collect()
    assert [tuple(r) for r in got] == [("1", 0), ("2", 1), ("3", 2)]


def test_mapping_by_name_and_place(spark, tmp_path):
    path = tmp_path / "sheet.csv"
    path.write_text(
        "a,b,c,d,e,f\n"
        "\U0001f4c1 Folder,x,K1,,,S1\n"
        "Top,,K2,,,S2\n"
        "None,Sub,K2,,,S2\n"
        'Top,My Sub,"K3, k4 —",,,"S3 s4,—"\n'
        "Top,My Other Sub,—,,,None\n"
        "Top,Short\n",
        encoding="utf-8",
    )
    rows = landed.read_mapping(spark, str(path)).orderBy("row_no").collect()
    got = [(r.subproject, r.jira_keys, r.wiki_keys, r.identifier) for r in rows]
    assert got == [
        ("My Sub", ["K3", "k4"], ["S3", "s4"], "k3"),
        ("My Other Sub", [], [], "my-other-sub"),
        ("Short", [], [], "short"),
    ]
    named = spark.createDataFrame([(1, "S9", "P", "Q", None)], "row_no long, wiki_keys string, parent string, subproject string, jira_keys string")
    assert landed.mapping_entries(named).first().wiki_keys == ["S9"]


def test_payload_files(spark, tmp_path):
    rows = spark.range(50).select(
        F.when(F.col("id") < 40, "big").otherwise("small").alias("project"), F.col("id").alias("ord")
    )
    sinks.write_payload(rows, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 50


def test_payload_keeps_the_order_of_revisions(spark, tmp_path):
    rows = spark.range(300).select(
        F.lit("p").alias("project"), F.floor(F.col("id") / 100).alias("ord"),
        F.when(F.col("id") % 100 > 0, 99 - F.col("id") % 100).alias("position"),
    )
    path = str(tmp_path / "ordered")
    sinks.write_payload(rows.orderBy(F.desc("ord")), path)
    files = spark.read.parquet(path).select("ord", "position", F.input_file_name().alias("f")).collect()
    by_file = {}
    for r in files:
        by_file.setdefault(r["f"], []).append((r["ord"], 1000 if r["position"] is None else r["position"]))
    assert len(files) == 300 and all(v == sorted(v) for v in by_file.values())


def test_added_children_follow_the_listing(spark):
    pages = spark.createDataFrame(
        [("A", "p0", 0), ("A", "p1", 1), ("B", "q0", 0)], "space_key string, id string, ord long"
    )
    children = spark.createDataFrame(
        [("A", "p1", "k1", 0), ("A", "p0", "k0", 1), ("A", "k0", "k2", 0), ("C", "z", "k3", 0), ("A", "p0", "p1", 0)],
        "space_key string, parent_id string, id string, ord long",
    )
    got = {r["id"]: (r["space_key"], r["ord"]) for r in landed.complete_pages(pages, children).collect()}
    assert got == {
        "p0": ("A", 0), "p1": ("A", 1), "q0": ("B", 0), "k0": ("A", 2), "k1": ("A", 3), "k2": ("A", 4),
        "k3": ("C", 0),
    }


def test_objects_are_parsed_once(spark, tmp_path):
    """The table that is read again and again holds parsed objects."""
    page = '<object class="Page"><id name="id">1</id><property name="title">one</property></object>'
    (tmp_path / "a.xml").write_text(f"<objects>{page}</objects>", encoding="utf-8")
    table = export.read_objects(spark, str(tmp_path))
    assert "from_xml" not in table._jdf.queryExecution().optimizedPlan().toString()
    assert [(r.id, r.title) for r in export.export_pages(table).collect()] == [("1", "one")]
