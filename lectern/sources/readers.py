"""Readers: JSON lines, record files, forum pages, books, ledgers, curation files."""

from __future__ import annotations

import os
from string import Template

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.functions.text import strip
from lectern.model import DOCUMENT, KINDS, Corpus


def in_file_order(rows: DataFrame, name: str, by_time: bool = False) -> DataFrame:
    """``rows`` of a file source with ``name``, their number from 0: files by name (``by_time``: by time of writing first), rows as they stand.

    Only the number of rows of each split comes to the driver.
    """
    split = F.struct((F.col("_metadata.file_modification_time") if by_time else F.lit(None).cast("timestamp")).alias("at"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"))
    rows = rows.withColumns({"__split": split, "__m": F.monotonically_increasing_id()})
    at, shift = 0, []
    for r in rows.groupBy("__split").agg(F.count("*").alias("n"), F.min("__m").alias("low")).orderBy("__split").collect():
        shift.append((r["__split"], at - r.low))
        at += r.n
    offsets = rows.sparkSession.createDataFrame(shift, T.StructType([rows.schema["__split"], T.StructField("__shift", T.LongType())]))
    return rows.join(F.broadcast(offsets), "__split").withColumn(name, F.col("__m") + F.col("__shift")).drop("__split", "__m", "__shift")


def json_lines(spark: SparkSession, path: str, by_time: bool = False) -> DataFrame:
    """``line_no, raw``: non-blank lines; ``line_no`` counts all lines from 0, in the order of :func:`in_file_order`."""
    lines = in_file_order(spark.read.text(path), "line_no", by_time)
    return lines.select("line_no", strip(F.col("value")).alias("raw")).where("raw <> ''")


def line_counts(spark: SparkSession, path: str) -> DataFrame:
    """``file, n_lines`` of text files."""
    return spark.read.text(path).groupBy(F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file")).agg(F.count("*").alias("n_lines"))


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """Record files, one JSON document each: the model's columns, ``file`` and ``corrupt``.

    ``corrupt`` is true for blank files, invalid JSON, and documents without id or with an item of unknown kind.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(folder).select(F.element_at(F.split("path", "/"), -1).alias("file"), F.decode("content", "UTF-8").alias("value"))
    files = files.unionByName(spark.createDataFrame([(n, None) for n in _blank_files(spark, folder)], "file string, value string"))
    return parsed(files)


def parsed(lines: DataFrame) -> DataFrame:
    """Documents of (file, value) rows of JSON text: the model's columns, ``file`` and ``corrupt``."""
    d = lines.select("file", F.when(F.try_parse_json("value").isNotNull(), F.from_json("value", DOCUMENT)).alias("d"))
    bad = F.col("d").isNull() | F.col("d.id").isNull() | F.coalesce(F.exists("d.items", lambda i: ~F.coalesce(i["kind"], F.lit("")).isin(*KINDS)), F.lit(False))
    return d.select("file", "d.*", F.coalesce(bad, F.lit(True)).alias("corrupt"))


def restore(spark: SparkSession, path: str, entries: DataFrame) -> Corpus:
    """The corpus of packaged JSON lines, the inverse of packaging."""
    lines = json_lines(spark, path).where(F.try_parse_json("raw").isNotNull())
    docs = lines.select(F.from_json("raw", DOCUMENT).alias("d")).select("d.*").withColumn("corrupt", F.col("id").isNull())
    return to_corpus(docs, entries)


def _blank_files(spark: SparkSession, folder: str) -> list[str]:
    """Names of empty record files, which file scans pass over; only names come to the driver."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/*.json")
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path) or []
    return [s.getPath().getName() for s in found if s.getLen() == 0]


def to_corpus(docs: DataFrame, ledger: DataFrame) -> Corpus:
    """Nested documents as tables; corrupt ones are left out."""
    d = docs.where("not corrupt")
    text = lambda v, p: F.try_variant_get(v, p, "string")
    source = F.coalesce(text(F.col("meta.source"), "$.source_identity"), text(F.col("meta.source"), "$.source"))
    meta = d.select(F.col("id").alias("doc_uuid"), "kind", source.alias("source_identity"), text(F.col("meta.source"), "$.native_id").alias("native_id"), F.col("meta.resolved.identities").alias("identities"), F.coalesce("meta.annotations", F.array()).alias("annotations"))
    i = d.select(F.col("id").alias("doc_uuid"), F.posexplode("items").alias("item_pos", "i"))
    many = F.try_variant_get(F.col("i.value"), "$", "array<string>")
    items = i.select(
        "doc_uuid", "item_pos", F.col("i.id").alias("item_id"), "i.kind", "i.entity_id", "i.actor_id", "i.category",
        F.coalesce(many, F.when(text(F.col("i.value"), "$").isNotNull(), F.array(text(F.col("i.value"), "$")))).alias("value"),
        F.when(F.col("i.value").isNotNull(), many.isNotNull()).alias("value_is_list"),
        "i.reasoning", "i.item_ids", F.to_json("i.data").alias("data"),
    )
    v = i.select("doc_uuid", F.col("i.id").alias("item_id"), F.posexplode("i.content").alias("variant_id", "v"))
    variants = v.select("variant_id", "doc_uuid", "item_id", "v.name", "v.text", "v.annotation", "v.author_id", "v.post_id", F.col("v.timestamp").alias("posted_at"))
    return Corpus(meta, items, variants, ledger)


def record_files(spark: SparkSession, folder: str, pattern: str = "*.json") -> DataFrame:
    """``file, n_bytes`` of the record files of a folder, blank ones included; their contents aren't read."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/{pattern}")
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path) or []
    return spark.createDataFrame([(s.getPath().getName(), s.getLen()) for s in found], "file string, n_bytes long")


def template(path: str) -> Template:
    """A prompt template: text with ``${name}`` where values go; :meth:`string.Template.substitute` fails on a missing one."""
    with open(path, encoding="utf-8") as f:
        return Template(f.read())


def forum_pages(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """``section_url, contents`` of page files; a limit takes the first pages by address."""
    pages = spark.read.parquet(path).select("section_url", "contents")
    return pages if limit is None else pages.orderBy("section_url").limit(limit)


def book_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files, split where they are large: ``text``, and ``f, s``, the file and the split's place in it, in whose order they stand."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(*(c for c in lines.columns if c != "value"), F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("s"), F.col("value").alias("text"))


def book(spark: SparkSession, path: str, native_id: str) -> DataFrame:
    """``native_id, f, s, text``: the lines of a book in one text file, or in several in the order of their names."""
    return book_lines(spark, path).select(F.lit(native_id).alias("native_id"), "f", "s", "text")


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """All entries of a ledger in JSON lines; blank and unreadable lines are left out, repeats kept.

    ``recorded_at`` is what the line says; ``line_no`` orders lines that don't say it or say the same.
    """
    fields = "source string, native_id string, uuid string, meta variant, recorded_at string"
    rows = json_lines(spark, path, by_time=True).where(F.try_parse_json("raw").isNotNull()).select("line_no", F.from_json("raw", fields).alias("r"))
    return rows.where("r.uuid is not null").select("r.source", "r.native_id", "r.uuid", F.to_json("r.meta").alias("meta"), "r.recorded_at", "line_no")


def ledger_index(entries: DataFrame) -> DataFrame:
    """The entry of each (source, native_id) that was written last."""
    order = [c for c in ("recorded_at", "line_no") if c in entries.columns]
    return entries.groupBy("source", "native_id").agg(F.max_by("uuid", F.struct(*order, "uuid")).alias("uuid"))


def cluster_manifest(spark: SparkSession, path: str) -> DataFrame:
    """``cluster_id, label, members`` of a cluster file."""
    return spark.read.option("multiLine", True).json(path).select(F.explode("clusters").alias("c")).select(F.col("c.cluster_id").cast("string").alias("cluster_id"), "c.label", "c.members")


def decisions(spark: SparkSession, path: str) -> DataFrame:
    """``row_no, cluster_id, human_label, action`` of a worked-through list in CSV."""
    rows = in_file_order(spark.read.option("header", True).csv(path), "row_no")
    return rows.select("row_no", F.col("cluster_id").cast("string").alias("cluster_id"), "human_label", "action")


def acquire(path: str, fetch=None) -> str:
    """The path, fetched with ``fetch(path)`` first if it isn't there. No fetcher is built in."""
    if not os.path.exists(path):
        if fetch is None:
            raise FileNotFoundError(f"{path} is missing and no fetcher is given")
        fetch(path)
    return path


def acquire_dataset(name: str, folder: str, fetch=None, files: tuple[str, ...] = ()) -> list[str]:
    """The files of a published dataset in ``folder``, fetched with ``fetch(name, file, path)`` where they aren't there.

    There is no network here: without a fetcher a missing file is an error.
    """
    paths = [os.path.join(folder, f) for f in files]
    for file, path in zip(files, paths):
        acquire(path, None if fetch is None else lambda p, file=file: fetch(name, file, p))
    return paths
