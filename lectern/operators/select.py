"""Filters and choices over documents, items and variants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions.text import filled, strip
from lectern.model import CONTENT_KINDS


def in_range(df: DataFrame, start: str | None = None, stop: str | None = None, key: str = "doc_uuid") -> DataFrame:
    """Documents whose id lies between ``start`` and ``stop``, both included, either open. Ids compare as strings."""
    if start is not None:
        df = df.where(F.col(key) >= str(start))
    return df if stop is None else df.where(F.col(key) <= str(stop))


def source_identity(*columns: str) -> Column:
    """First of the columns that is neither null nor empty, else ``unknown``."""
    return F.coalesce(*(filled(F.col(c)) for c in columns or ("source_identity",)), F.lit("unknown"))


def of_source(meta: DataFrame, *sources: str) -> DataFrame:
    return meta.where(source_identity().isin(*sources))


def of_kinds(items: DataFrame, kinds: list[str]) -> DataFrame:
    """Items of content kinds; an unknown kind is an error."""
    wrong = sorted(set(kinds) - set(CONTENT_KINDS))
    if wrong:
        raise ValueError(f"not kinds with content: {', '.join(wrong)}")
    return items.where(F.col("kind").isin(*kinds))


def of_categories(items: DataFrame, *categories: str) -> DataFrame:
    return items.where((F.col("kind") == "categorization") & F.col("category").isin(*categories))


def uuid_targets(targets: str | list[str] | None) -> list[str]:
    """Ids from a comma-separated string or a list, sorted, without blanks and repeats."""
    parts = targets.split(",") if isinstance(targets, str) else targets or []
    return sorted({str(p).strip() for p in parts if str(p).strip()})


def with_variant(items: DataFrame, variants: DataFrame, *names: str) -> DataFrame:
    """Items that have a variant of every one of the names."""
    have = variants.where(F.col("name").isin(*names)).groupBy("doc_uuid", "item_id").agg(F.count_distinct("name").alias("n")).where(F.col("n") == len(set(names)))
    return items.join(have.select("doc_uuid", "item_id"), ["doc_uuid", "item_id"], "left_semi")


def without_categories(meta: DataFrame, items: DataFrame, *categories: str) -> DataFrame:
    """Documents that lack at least one of the categories (those still to be refined)."""
    done = of_categories(items, *categories).groupBy("doc_uuid").agg(F.collect_set("category").alias("c")).where(F.size(F.array_except(F.array(*map(F.lit, categories)), "c")) == 0)
    return meta.join(done, "doc_uuid", "left_anti")


def delivery(variants: DataFrame) -> Column:
    """What orders the deliveries of one variant, the latest last."""
    return F.struct(*(c for c in ("ingested_at", "variant_id") if c in variants.columns), F.xxhash64("text").alias("h"))


def preferred_text(variants: DataFrame, preferred: list[str]) -> DataFrame:
    """One text per item: of the first preferred variant name that isn't blank, else the first of the others that isn't blank.

    ``doc_uuid, item_id, name, text`` (stripped). Of a variant that was delivered again the latest counts.
    """
    rank = F.lit(len(preferred))
    for i, name in reversed(list(enumerate(preferred))):
        rank = F.when(F.col("name") == name, F.lit(i)).otherwise(rank)
    some = variants.withColumn("text", strip(F.col("text"))).where("text <> ''")
    one, wanted = F.struct("name", "text"), rank < len(preferred)
    best = some.groupBy("doc_uuid", "item_id").agg(F.max_by(F.when(wanted, one), F.when(wanted, F.struct((-rank).alias("rank"), delivery(some)))).alias("a"), F.min_by(F.when(~wanted, one), F.when(~wanted, F.col("variant_id"))).alias("b"))
    return best.select("doc_uuid", "item_id", F.coalesce("a", "b").alias("best")).select("doc_uuid", "item_id", "best.name", "best.text")


def first_per(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows per key; Spark keeps only ``n`` rows of a group while it reads them."""
    at = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(at)).where(F.col("__n") <= n).drop("__n")


def pending(units: DataFrame, budget: int | None, *order: str) -> DataFrame:
    """The first ``budget`` units of work in order, all without a budget."""
    return units if budget is None else units.orderBy(*order).limit(budget)
