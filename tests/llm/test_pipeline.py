"""The pipeline stage by stage over the small table, and its last rows."""

from __future__ import annotations

import random
from pathlib import Path

from pyspark.sql import functions as F

import corpus_pipeline


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ids = [d["doc_id"] for d in docs.select("doc_id").collect()]
    before = set(ids)
    current = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        current = corpus_pipeline.landed(stage(spark, current, sf_dir), "test-" + name.replace(" ", "-"))
        assert current.columns == docs.columns
        now = {d["doc_id"] for d in current.select("doc_id").collect()}
        assert now and now <= before
        before = now
    texts = [r["text"] for r in current.collect()]
    assert len(set(texts)) == len(texts)
    pieces = corpus_pipeline.STAGES[-1][1](spark, current, sf_dir).collect()
    assert {p["doc_id"] for p in pieces} == before


def test_null_and_repeated_ids(spark, sf_dir):
    draw = random.Random(5)

    def words(count):
        return ["".join(draw.choices("abcdefghij", k=draw.randint(3, 9))) for _ in range(count)]

    def through(number, rows):
        kind = "doc_id long, text string, lang string, source string, n_chars long"
        docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], kind).repartition(3)
        return [(r["doc_id"], r["text"]) for r in corpus_pipeline.STAGES[number][1](spark, docs, sf_dir).collect()]

    good = [" ".join(words(60)) for _ in range(3)]
    junk = [(i, "too short " + str(i)) for i in (None, None, 1)]
    rows = [(None, good[0]), (None, good[1]), (1, good[2])]
    assert sorted(t for _, t in through(0, rows + junk)) == sorted(good)

    rows = [(None, good[0]), (None, good[0]), (7, good[0]), (3, good[1]), (3, good[1]), (3, good[2]), (9, good[2])]
    left = [(None, good[0]), (3, good[1]), (3, good[2])]
    assert sorted(through(1, rows), key=str) == sorted(left, key=str)

    near = [good[0] + " " + w for w in words(4)]
    rows = [(None, near[0]), (None, near[1]), (2, good[1]), (2, good[1] + " more"), (2, good[2]), (5, good[2] + " more")]
    kept = through(2, rows)
    assert sorted(map(str, (i for i, _ in kept))) == ["2", "2", "None"]
    assert sum(t in near for _, t in kept) == 1 and sum(t.startswith(good[1]) for _, t in kept) == 1
    assert (2, good[2]) in kept

    rows = [(i, f"{'x' * n} write to name{n}@site.org now") for n in range(1, 9) for i in (None, 4)]
    assert sorted(through(3, rows), key=str) == sorted(
        ((i, f"{'x' * n} write to [EMAIL] now") for n in range(1, 9) for i in (None, 4)), key=str
    )

    pieces = corpus_pipeline.STAGES[4][1](
        spark, spark.createDataFrame([(None, good[0]), (None, good[1]), (4, good[2]), (4, good[2])], "doc_id long, text string"), sf_dir
    ).collect()
    assert sorted(str(p["doc_id"]) for p in pieces if p["start"] == 0) == ["4", "4", "None", "None"]


def test_rows_of_files_are_keyed_in_place(spark, sf_dir, tmp_path):
    """Stages over files write no second copy of the texts; keys of two reads are the same."""
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(i % 7 or None, f"text {i % 40}", "en", "s", 7) for i in range(100)]
    path = str(tmp_path / "docs")
    spark.createDataFrame(rows, kind).repartition(3).write.parquet(path)
    docs = spark.read.parquet(path)
    corpus_pipeline.landed(docs.limit(1), "test-first")  # the checkpoint folder is there
    folder = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    before = set(folder.glob("pipeline-rows-*"))

    keyed = [sorted(map(str, corpus_pipeline._keyed(docs).collect())) for _ in range(2)]
    assert keyed[0] == keyed[1]
    assert corpus_pipeline._keyed(docs).select(corpus_pipeline.ROW).distinct().count() == len(rows)
    kept = corpus_pipeline.exact_dedup(spark, docs, sf_dir)
    assert kept.columns == docs.columns
    assert sorted(r["text"] for r in kept.collect()) == sorted({r[1] for r in rows})
    assert set(folder.glob("pipeline-rows-*")) == before

    made = docs.withColumn("doc_id", F.explode(F.array("doc_id", F.lit(1).cast("long"))))
    assert corpus_pipeline._keyed(made).select(corpus_pipeline.ROW).distinct().count() == 2 * len(rows)
    assert corpus_pipeline._keyed(docs.limit(0)).count() == 0


def test_texts_stay_where_they_are(spark, sf_dir, tmp_path):
    """The keys of 60,000 kept rows would be past the limit for copies; as bitmaps they are not."""
    path = str(tmp_path / "docs")
    text = F.concat(F.lit("text "), F.xxhash64("id").cast("string"))
    spark.range(60_000).select(F.col("id").alias("doc_id"), text.alias("text")).repartition(3).write.parquet(path)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64k")
    try:
        docs = spark.read.parquet(path)
        kept = corpus_pipeline.exact_dedup(spark, docs, sf_dir)
        assert kept.count() == 60_000
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
