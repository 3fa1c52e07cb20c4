from __future__ import annotations

import os.path
import re
import unicodedata

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wikiloom.functions import keys, text


def one(spark, make, values):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.x for r in frame.select("i", make(F.col("v")).alias("x")).orderBy("i").collect()]


def test_wiki_titles(spark):
    cases = {
        "9.00 Intro": "Page_009_000_Intro",
        "14.0 Setup": "Page_014_000_Setup",
        "1.2 Basics": "Page_001_002_Basics",
        "1.10 Advanced": "Page_001_010_Advanced",
        "1.2.3": "Page_001_002_003",
        "Été  à la plage!": "Ete_a_la_plage",
        "": "Untitled",
        "???": "Untitled",
        "Plan 2024-12345": "Plan_2024-12345",
        "x" * 300: "x" * 255,
    }
    assert one(spark, keys.wiki_title, cases) == list(cases.values())


def test_plain_titles(spark):
    cases = {"1.2 Basics": "Page_12_Basics", "A  b.": "A_b", " ": "Untitled"}
    assert one(spark, keys.wiki_title_plain, cases) == list(cases.values())


def test_identifiers(spark):
    cases = {" Ab-C_d 1! ": "ab-c_d1", "Çé": "ce", "!!": None, "A" * 120: "a" * 100}
    assert one(spark, keys.identifier, cases) == list(cases.values())


def test_file_names(spark):
    cases = {
        "my file (1).tar.gz": "my_file_1_.tar.gz",
        ".bashrc": ".bashrc",
        "??.png": "attachment.png",
        "": "attachment",
        "a b": "a_b",
        "été.PNG": "été.PNG",
    }
    cases["my file (1).tar.gz"] = "my_file_1_.tar.gz"
    got = one(spark, keys.file_name, cases)
    assert got == list(cases.values())


def test_anchors(spark):
    cases = {"<b>A &amp; B</b> - c": "A-B-c", "Head  two!": "Head-two", " x ": "x"}
    assert one(spark, keys.heading_anchor, cases) == list(cases.values())


def test_unquote_keeps_plus_and_stray_percent(spark):
    cases = {"a%20b+c": "a b+c", "100%": "100%", "%C3%A9%zz": "é%zz"}
    assert one(spark, text.url_unquote, cases) == list(cases.values())


def test_unescape_and_fold(spark):
    assert one(spark, text.unescape, ["a &eacute; &#x41;", "b"]) == ["a é A", "b"]
    assert one(spark, text.fold, ["ﬁ é½", "b"]) == ["fi e1⁄2", "b"]


_SAMPLE = st.lists(st.text(max_size=30), min_size=30, max_size=60)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(values=_SAMPLE)
def test_keys_match_their_definition(spark, values):
    """Characters of all planes, against the definition in plain words."""
    values = [v.replace("\x00", "") for v in values]

    def folded(value):
        return "".join(
            c for c in unicodedata.normalize("NFKD", value) if not unicodedata.combining(c)
        )

    def named(value):
        stem, extension = os.path.splitext(value)
        safe = re.sub("_+", "_", re.sub(r"[^\w.-]", "_", stem)).strip("_")
        return (safe or "attachment") + extension

    def known(value):
        # Characters newer than either side's Unicode tables may differ; so may digits that are
        # letters to one side.
        return all(ord(c) < 0x3000 for c in value)

    values = [v for v in values if known(v)]
    assert one(spark, text.fold, values) == [folded(v) for v in values]
    assert one(spark, text.strip, values) == [v.strip() for v in values]
    assert one(spark, keys.file_name, values) == [named(v) for v in values]
