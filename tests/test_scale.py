from __future__ import annotations

import random

from pyspark.sql import functions as F

from wikiloom import scale


def test_lookup_salts_hot_keys_and_keeps_all_rows(spark):
    left = spark.range(3000).select(
        "id",
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 100 == 1, None)
        .otherwise(F.col("id").cast("string"))
        .alias("k"),
    )
    right = spark.createDataFrame([("hot", 1), ("5", 2), ("none", 3)], "k string, v int")
    plain = left.join(right, "k", "left").select("id", "v").orderBy("id").collect()
    salted = scale.lookup(left, right, ["k"], ["id"], hot_rows=100).select("id", "v")
    assert salted.orderBy("id").collect() == plain
    inner = scale.lookup(left, right, ["k"], ["id"], "inner", hot_rows=100)
    assert inner.count() == 1001


def test_salt_spreads_a_hot_key(spark):
    left = spark.range(4000).select("id", F.lit("hot").alias("k"))
    right = spark.createDataFrame([("hot", 1)], "k string, v int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = scale.lookup(left, right, ["k"], ["id"], hot_rows=100)
        parts = joined.groupBy(F.spark_partition_id()).count().count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert parts == 8


def test_index_is_the_place_in_the_order(spark):
    values = list(range(2000))
    random.Random(1).shuffle(values)
    frame = spark.createDataFrame([(v // 700, v) for v in values], "g int, v int").repartition(7)
    rows = scale.with_index(frame, ["g", "v"], "at").collect()
    assert all(r["at"] == r.v for r in rows) and len(rows) == 2000


def test_index_of_nothing(spark):
    empty = spark.createDataFrame([], "g int, v int")
    assert scale.with_index(empty, ["v"]).count() == 0


def test_group_position(spark):
    frame = spark.createDataFrame([(g, v) for g in "ab" for v in (5, 1, 9)] + [("c", 2)], "g string, v int")
    rows = scale.with_group_position(frame, ["g"], ["v"]).collect()
    assert {(r.g, r.v, r.position, r.total) for r in rows} == {
        (g, v, p, 3) for g in "ab" for p, v in enumerate((1, 5, 9), 1)
    } | {("c", 2, 1, 1)}


def test_first_and_last_rows(spark):
    frame = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 3, "z")], "k string, o int, v string")
    assert {r.v for r in scale.first_rows(frame, ["k"], "o").collect()} == {"x", "z"}
    assert {r.v for r in scale.first_rows(frame, ["k"], "o", last=True).collect()} == {"y", "z"}


def test_parts_are_bounded_and_whole(spark):
    frame = spark.range(25).select(F.lit("a").alias("k"), "id")
    parts = scale.listed_in_parts(frame, ["k"], ["id"], F.col("id"), "ids", part_rows=10)
    rows = sorted(parts.collect(), key=lambda r: r.part)
    assert [len(r.ids) for r in rows] == [10, 10, 5]
    assert sum((r.ids for r in rows), []) == list(range(25))
    assert {r.ids_count for r in rows} == {25}


def test_checkpoint_folder_comes_from_the_session(spark):
    scale.ensure_checkpoint_dir(spark)
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or named in spark.sparkContext.getCheckpointDir()


def test_rows_among_by_bitmaps(spark):
    places = [0, 1, 7, 8, 32767, 32768, (1 << 33) - 1, 1 << 33, (5 << 33) + 40000]
    rows = spark.createDataFrame([(p, f"t{p}") for p in places], "row long, text string")
    wanted = [0, 7, 32768, (1 << 33) - 1, 1 << 33, 99]
    numbers = spark.createDataFrame([(p,) for p in wanted * 2], "row long")
    kept = scale.rows_among(rows, numbers, "row", "test-among")
    assert kept.columns == rows.columns
    assert sorted(r["row"] for r in kept.collect()) == sorted(set(wanted) & set(places))
    left = scale.rows_among(rows, numbers, "row", "test-among", among=False)
    assert sorted(r["row"] for r in left.collect()) == sorted(set(places) - set(wanted))
    none = numbers.where("row < 0")
    assert scale.rows_among(rows, none, "row", "test-among").count() == 0
    assert scale.rows_among(rows, none, "row", "test-among", among=False).count() == len(places)
