"""Packaging documents to JSON lines, and back; the split by flavour."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.model import Corpus
from lectern.plans.ordering import numbered


def documents_json(corpus: Corpus) -> DataFrame:
    """``doc_uuid, line``: each document as compact JSON, items in order with their variants."""
    variants = corpus.variants.groupBy("doc_uuid", "item_id").agg(F.array_sort(F.collect_list(F.struct("variant_id" if "variant_id" in corpus.variants.columns else "name", "name", "text", "annotation"))).alias("v"))
    content = F.transform("v", lambda v: F.struct(v["name"].alias("name"), v["text"].alias("text"), v["annotation"].alias("annotation")))
    items = corpus.items.join(variants, ["doc_uuid", "item_id"], "left").withColumn("content", content)
    body = F.struct("item_pos", F.col("item_id").alias("id"), "kind", "entity_id", "actor_id", "category", "value", "reasoning", "item_ids", "content")
    per = items.groupBy("doc_uuid").agg(F.collect_list(body).alias("items"))
    ordered = F.transform(F.array_sort("items", lambda a, b: F.when(a["item_pos"] < b["item_pos"], -1).when(a["item_pos"] > b["item_pos"], 1).when(a["id"] < b["id"], -1).when(a["id"] > b["id"], 1).otherwise(0)), lambda i: i.dropFields("item_pos"))
    meta = F.struct(F.struct("source_identity", "native_id").alias("source"))
    d = corpus.meta.join(per, "doc_uuid", "left")
    return d.select("doc_uuid", F.to_json(F.struct(F.col("doc_uuid").alias("id"), "kind", meta.alias("meta"), F.coalesce(ordered, F.array()).alias("items"))).alias("line"))


def part_lines(corpus: Corpus, size: int = 1_000) -> DataFrame:
    """``doc_uuid, part_no, line``: documents as compact JSON of at most ``size`` items a line, in order, numbered from 0.

    Items are numbered over ranges and each line is gathered by itself, so a document of any length is never in one task.
    Documents without items have one line.
    """
    order = ("variant_id",) if "variant_id" in corpus.variants.columns else ("name",)
    variants = corpus.variants.groupBy("doc_uuid", "item_id").agg(F.array_sort(F.collect_list(F.struct(*order, F.struct("name", "text", "annotation").alias("v")))).alias("v"))
    items = numbered(corpus.items, "doc_uuid", "item_pos", "item_id", name="__n").withColumn("part_no", F.floor((F.col("__n") - 1) / size).cast("int"))
    items = items.join(variants, ["doc_uuid", "item_id"], "left")
    body = F.struct(F.col("item_id").alias("id"), "kind", "entity_id", "actor_id", "category", "value", "reasoning", "item_ids", F.transform("v", lambda x: x["v"]).alias("content"))
    lines = items.groupBy("doc_uuid", "part_no").agg(F.transform(F.array_sort(F.collect_list(F.struct("__n", body.alias("i")))), lambda x: x["i"]).alias("items"))
    d = corpus.meta.select("doc_uuid", "kind").join(lines, "doc_uuid", "left")
    part = F.coalesce("part_no", F.lit(0))
    return d.select("doc_uuid", part.alias("part_no"), F.to_json(F.struct(F.col("doc_uuid").alias("id"), "kind", part.alias("part"), F.coalesce("items", F.array()).alias("items"))).alias("line"))


def rejects(lines: DataFrame) -> DataFrame:
    """Documents that can't be packaged: no id, or a line that doesn't read back."""
    return lines.where(F.col("doc_uuid").isNull() | F.try_parse_json("line").isNull())


def flavour(sexual: Column, toxicity: Column) -> Column:
    """``general`` for clean and safe documents, ``unbound`` for the rest; unset axes count as the mild end."""
    mild = F.coalesce(sexual, F.lit("Clean")).isin("Clean", "Suggestive") & (F.coalesce(toxicity, F.lit("Safe")) == "Safe")
    return F.when(mild, "general").otherwise("unbound")
