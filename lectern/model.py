"""The canonical document model: scales, item kinds, schemas, and the corpus of tables.

Logical row: a document with metadata, an ordered flat list of items and an annotation list. Physical form: four
tables, one row per document, item, content variant and ledger entry, so that reports are plain
aggregations with column pruning and item-level changes are narrow projections.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.plans import table

# The scales of the model.
SEXUAL = ("Clean", "Suggestive", "Explicit")
VIOLENCE = ("None", "Combat", "Graphic")
TOXICITY = ("Safe", "Harassment", "Dangerous")
GENRES = ("Fantasy", "Sci-Fi", "Romance", "Slice of Life", "Action & Adventure", "Mystery & Thriller", "Comedy", "Drama")
GENDERS = ("male", "female", "neutral", "unknown")
CONTENT_KINDS = ("world", "character", "summary", "narrative", "turn")
STRUCTURED_KINDS = ("categorization", "sequence")
KINDS = CONTENT_KINDS + STRUCTURED_KINDS
SCALES = {"sexuality": SEXUAL, "violence": VIOLENCE, "toxicity": TOXICITY, "genre": GENRES}

# Histogram buckets of lengths, from, to (None: open), label.
BUCKETS = ((1, 10, "1-10"), (11, 25, "11-25"), (26, 50, "26-50"), (51, 100, "51-100"), (101, 250, "101-250"), (251, 500, "251-500"), (501, None, "501+"))

PRONOUNS = "struct<subjective:string,objective:string,possessive:string>"
IDENTITY = f"struct<entity_id:string,name:string,gender:string,pronouns:{PRONOUNS},is_player_controlled:boolean>"
ANNOTATION = "struct<kind:string,content:string,reasoning:string>"
VARIANT = "struct<name:string,text:string,annotation:string,author_id:string,post_id:string,timestamp:string>"
ITEM = f"struct<id:string,kind:string,entity_id:string,actor_id:string,category:string,value:variant,reasoning:string,item_ids:array<string>,data:variant,content:array<{VARIANT}>>"
META = f"struct<source:variant,resolved:struct<identities:array<{IDENTITY}>>,annotations:array<{ANNOTATION}>>"
DOCUMENT = f"id string, kind string, meta {META}, items array<{ITEM}>"

META_COLUMNS = "doc_uuid string, kind string, source_identity string, native_id string, identities array<" + IDENTITY + ">, annotations array<" + ANNOTATION + ">"


@dataclass(frozen=True)
class Corpus:
    """The tables of a corpus. Steps take one and return another; nothing is read or written in between."""

    meta: DataFrame
    items: DataFrame
    variants: DataFrame
    ledger: DataFrame

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> Corpus:
        return cls(*(table(spark, folder, n) for n in ("doc_meta", "doc_items", "content_variants", "ledger"))).complete()

    def complete(self) -> Corpus:
        """With empty ``identities`` and ``annotations`` where the metadata has none."""
        meta = self.meta
        for name, kind in (("identities", IDENTITY), ("annotations", ANNOTATION)):
            if name not in meta.columns:
                meta = meta.withColumn(name, F.array().cast(f"array<{kind}>"))
        return replace(self, meta=meta)

    def only(self, documents: DataFrame) -> Corpus:
        """The part of the documents whose ``doc_uuid`` is in ``documents``."""
        keys = documents.select("doc_uuid").distinct()
        keep = lambda df: df.join(keys, "doc_uuid", "left_semi")
        return replace(self, meta=keep(self.meta), items=keep(self.items), variants=keep(self.variants))

    def without(self, documents: DataFrame) -> Corpus:
        """The rest of the corpus, ledger included."""
        keys = documents.select("doc_uuid").where("doc_uuid is not null").distinct()
        drop = lambda df: df.join(keys, "doc_uuid", "left_anti")
        ledger = self.ledger.join(keys.withColumnRenamed("doc_uuid", "uuid"), "uuid", "left_anti").select(self.ledger.columns)
        return Corpus(drop(self.meta), drop(self.items), drop(self.variants), ledger)

    def joined(self, other: Corpus) -> Corpus:
        """Both corpora's documents; columns that one lacks are null."""
        both = lambda a, b: a.unionByName(b, allowMissingColumns=True)
        a, b = self.complete(), other.complete()
        shape = {f.name: f.dataType for f in a.ledger.schema}
        entries = b.ledger.select(*(F.col(c).cast(shape[c]).alias(c) if c in shape else F.col(c) for c in b.ledger.columns))
        return Corpus(both(a.meta, b.meta), both(a.items, b.items), both(a.variants, b.variants), both(a.ledger, entries))
