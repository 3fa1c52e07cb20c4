"""Reader for XML exports: one table per object class, the last row of an id wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wikiloom import schemas
from wikiloom.functions.text import strip
from wikiloom.scale import first_rows, landed, with_index

_END = "</object>"
_ROW_BITS = 33  # monotonically_increasing_id keeps the partition number above this bit


def read_objects(spark: SparkSession, path: str) -> DataFrame:
    """All ``<object>`` rows; ``ord`` is their order, by path of the file, then place in the file.

    A file is read as text that is split at ``</object>``, so any number of tasks read one file: a record
    belongs to the split in which it begins. A body may hold the same tag in a CDATA section; pieces
    of such an object are put together again before anything is parsed. Objects have a closing tag of
    their own; bytes are UTF-8. The parsed objects are written, so that each is parsed once however often
    its class is read.
    """
    text = spark.read.option("lineSep", _END).text(path)
    at = [
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_mid"),
    ]
    # One row per split; splits are not read in the order of files.
    marked = landed(text.select(*at, _left_open(F.col("value")).alias("_open")), "pieces")
    splits = with_index(marked.select("_file", "_block").distinct(), ["_file", "_block"], "_at")
    row = F.col("_mid").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    order = (F.shiftleft("_at", _ROW_BITS) + row).alias("ord")
    marked = marked.join(splits, ["_file", "_block"]).select(order, "_open")
    pieces = text.select(*at, F.col("value").alias("_piece")).join(splits, ["_file", "_block"])
    whole = _put_together(pieces.select(order, "_piece"), marked)
    begun = F.regexp_instr("_piece", F.lit(r"<object[\s>]"))
    objects = whole.where(begun > 0).select(
        "ord",
        F.from_xml(F.concat(F.substr("_piece", begun), F.lit(_END)), schemas.EXPORT_OBJECT).alias("o"),
    )
    return landed(objects.select("o.*", "ord"), "export-objects")


def _left_open(piece: Column) -> Column:
    """Whether a CDATA section is open at the end of a piece; null if it holds no mark of one."""
    parts = F.split(piece, F.lit("]]>"), -1)
    after = F.element_at(parts, -1).contains("<![CDATA[")
    return F.when(after, F.lit(True)).when(F.size(parts) > 1, F.lit(False))


def _put_together(pieces: DataFrame, marked: DataFrame) -> DataFrame:
    """Pieces as whole objects: those cut within a CDATA section are joined up to where it ends.

    Marks are numbered in order. Marks that leave a section open, one after the other, differ from their
    own number by the same amount; the mark after such a run closes the section.
    """
    if marked.where("_open").isEmpty():
        return pieces
    placed = with_index(marked, ["ord"], "_idx")
    marks = with_index(placed.where(F.col("_open").isNotNull()), ["_idx"], "_mark")
    opened = with_index(marks.where("_open").select("_idx", "_mark"), ["_idx"], "_nth")
    runs = opened.groupBy((F.col("_mark") - F.col("_nth")).alias("_run")).agg(
        F.min("_idx").alias("_first"), (F.max("_mark") + 1).alias("_mark")
    )
    ends = marks.select("_mark", F.col("_idx").alias("_last"))
    runs = runs.join(ends, "_mark").select("_first", F.explode(F.sequence("_first", "_last")).alias("_idx"))
    heads = placed.select(F.col("_idx").alias("_first"), F.col("ord").alias("_head"))
    cut = landed(
        runs.join(placed.select("_idx", "ord"), "_idx").join(heads, "_first").select("ord", "_head"), "cut"
    )
    joined = (
        pieces.join(cut, "ord").groupBy("_head")
        .agg(F.sort_array(F.collect_list(F.struct("ord", "_piece"))).alias("_pieces"))
        .select(F.col("_head").alias("ord"), F.array_join("_pieces._piece", _END).alias("_piece"))
    )
    return pieces.join(cut, "ord", "left_anti").unionByName(joined)


def class_counts(objects: DataFrame) -> DataFrame:
    return objects.groupBy(F.col("_class").alias("class")).agg(F.count(F.lit(1)).alias("objects"))


def _property(name: str) -> Column:
    return F.get(F.filter("property", lambda p: p["_name"] == name), F.lit(0))


def _value(name: str) -> Column:
    return F.coalesce(strip(_property(name)["_VALUE"]), F.lit(""))


def _ref(name: str) -> Column:
    with_id = F.filter("property", lambda p: (p["_name"] == name) & p["id"].isNotNull())
    return F.nullif(strip(F.get(with_id, F.lit(0))["id"]["_VALUE"]), F.lit(""))


def _refs(name: str) -> Column:
    named = F.filter(F.coalesce("collection", F.array()), lambda c: c["_name"] == name)
    ids = F.flatten(
        F.transform(
            named,
            lambda c: F.transform(
                F.coalesce(c["element"], F.array()), lambda e: strip(e["id"]["_VALUE"])
            ),
        )
    )
    return F.filter(ids, lambda i: i.isNotNull() & (i != ""))


def _number(name: str, default: int) -> Column:
    return F.coalesce(F.nullif(_value(name), F.lit("")).cast("int"), F.lit(default))


def _of_class(objects: DataFrame, name: str) -> DataFrame:
    keyed = objects.where(F.col("_class") == name).withColumn("id", strip(F.col("id._VALUE")))
    return first_rows(keyed.where("id <> ''"), ["id"], "ord", last=True)


def export_pages(objects: DataFrame) -> DataFrame:
    return _of_class(objects, "Page").select(
        "id",
        _value("title").alias("title"),
        _number("version", 0).alias("version"),
        _value("contentStatus").alias("status"),
        _ref("parent").alias("parent_id"),
        _ref("originalVersion").alias("original_version_id"),
        _refs("bodyContents").alias("body_content_ids"),
        _number("position", 0).alias("position"),
        _ref("space").alias("space_id"),
        _value("creationDate").alias("created"),
        _value("lastModificationDate").alias("modified"),
        _value("creatorName").alias("creator"),
        _value("lastModifierName").alias("modifier"),
        "ord",
    )


def export_bodies(objects: DataFrame) -> DataFrame:
    return _of_class(objects, "BodyContent").select(
        "id",
        repair_cdata(_value("body")).alias("body"),
        _ref("content").alias("content_id"),
        _value("bodyType").alias("body_type"),
        "ord",
    )


def export_attachments(objects: DataFrame) -> DataFrame:
    return _of_class(objects, "Attachment").select(
        "id",
        F.coalesce(F.nullif(_value("fileName"), F.lit("")), _value("title")).alias("filename"),
        F.coalesce(_ref("containerContent"), _ref("content")).alias("content_id"),
        _number("version", 1).alias("version"),
        F.nullif(_value("originalVersionId"), F.lit("")).alias("original_version_id"),
        _value("contentType").alias("content_type"),
        _value("contentStatus").alias("content_status"),
        _value("fileSize").alias("file_size"),
        "ord",
    )


def repair_cdata(body: Column) -> Column:
    """The export escapes the end of CDATA sections with a space."""
    return F.replace(body, F.lit("]] >"), F.lit("]]>"))


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Paths and sizes below a folder; file contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", "length")
    )


def bind_files(attachments: DataFrame, files: DataFrame) -> DataFrame:
    """Attach to each attachment the path of its file under ``attachments/``, best place first.

    Places in order: page/attachment/version, page/attachment/1, page/attachment,
    attachment/version, the highest number in page/attachment, the first file there.
    """
    parts = F.split(F.regexp_extract("path", r".*?/?attachments/(.*)$", 1), "/")
    files = files.select("path", parts.alias("p"))
    deep = files.where(F.size("p") == 3).select(
        "path", F.col("p")[0].alias("page"), F.col("p")[1].alias("att"), F.col("p")[2].alias("file")
    )
    flat = files.where(F.size("p") == 2).select(
        "path", F.col("p")[0].alias("first"), F.col("p")[1].alias("second")
    )
    atts = attachments.select(
        F.col("id").alias("att_id"),
        F.col("content_id").alias("page_id"),
        F.col("version").cast("string").alias("v"),
    )
    number = F.when(F.regexp_like("file", F.lit(r"^[0-9]+$")), F.col("file").cast("decimal(38,0)"))
    in_page = atts.join(
        deep, (F.col("page_id") == F.col("page")) & (F.col("att_id") == F.col("att"))
    ).select(
        "att_id",
        "path",
        F.struct(
            F.when(F.col("file") == F.col("v"), 1)
            .when(F.col("file") == "1", 2)
            .when(number.isNotNull(), 5)
            .otherwise(6)
            .alias("place"),
            F.coalesce(-number, F.lit(0).cast("decimal(38,0)")).alias("newest"),
            F.col("file").alias("name"),
        ).alias("rank"),
    )

    def flat_rank(place: int) -> Column:
        return F.struct(
            F.lit(place).alias("place"),
            F.lit(0).cast("decimal(38,0)").alias("newest"),
            F.col("second").alias("name"),
        ).alias("rank")

    as_file = atts.join(
        flat, (F.col("page_id") == F.col("first")) & (F.col("att_id") == F.col("second"))
    ).select("att_id", "path", flat_rank(3))
    no_page = atts.join(
        flat, (F.col("att_id") == F.col("first")) & (F.col("v") == F.col("second"))
    ).select("att_id", "path", flat_rank(4))
    best = (
        in_page.unionByName(as_file)
        .unionByName(no_page)
        .groupBy("att_id")
        .agg(F.min_by("path", "rank").alias("path"))
    )
    return attachments.join(best, attachments["id"] == best["att_id"], "left").drop("att_id")
