"""Read-only reports; every section is a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions.text import filled, percent, strip
from lectern.model import BUCKETS, CONTENT_KINDS, Corpus
from lectern.operators.meta import Rules, health, resolve, stats
from lectern.operators.select import source_identity
from lectern.plans import cut_lineage
from lectern.plans.ordering import numbered, positions


def item_kinds(items: DataFrame) -> DataFrame:
    return items.groupBy("kind").agg(F.count("*").alias("n_items"))


def variant_counts(items: DataFrame, variants: DataFrame) -> DataFrame:
    """Variants by item kind and name; variants of no item count under a null kind."""
    kind = items.select("doc_uuid", "item_id", "kind").dropDuplicates(["doc_uuid", "item_id"])
    return variants.join(kind, ["doc_uuid", "item_id"], "left").groupBy("kind", "name").agg(F.count("*").alias("n_variants"))


def structured_keys(items: DataFrame) -> DataFrame:
    """Categorizations by category and sequences by what they are a sequence for."""
    made_for = F.coalesce(filled(F.get_json_object("data", "$.sequence_for")), F.lit("(none)"))
    key = F.when(F.col("kind") == "categorization", F.coalesce(filled(F.col("category")), F.lit("(none)"))).otherwise(made_for)
    return items.where("kind in ('categorization', 'sequence')").groupBy("kind", key.alias("key")).agg(F.count("*").alias("n_items"))


def content_shapes(items: DataFrame, variants: DataFrame) -> DataFrame:
    """How the content of items is held: variants, missing, structured, malformed (blank names) or unclassified."""
    per = variants.groupBy("doc_uuid", "item_id").agg(F.bool_or(F.coalesce(F.trim("name"), F.lit("")) == "").alias("blank"))
    shape = (
        F.when(F.col("kind").isin("categorization", "sequence"), F.when(F.col("blank").isNotNull(), "unexpected").otherwise("structured"))
        .when(~F.coalesce(F.col("kind"), F.lit("")).isin(*CONTENT_KINDS), "unclassified")
        .when(F.col("blank").isNull(), "missing")
        .when(F.col("blank"), "malformed")
        .otherwise("variants")
    )
    return items.join(per, ["doc_uuid", "item_id"], "left").groupBy("kind", shape.alias("shape")).agg(F.count("*").alias("n_items"))


def malformed(items: DataFrame, variants: DataFrame) -> DataFrame:
    """Counts of blank variant names, blank categories and sequences without a purpose."""
    blank = lambda c: F.coalesce(strip(c), F.lit("")) == ""
    a = variants.agg(F.count_if(blank(F.col("name"))).alias("blank_names"))
    b = items.agg(
        F.count_if((F.col("kind") == "categorization") & blank(F.col("category"))).alias("blank_categories"),
        F.count_if((F.col("kind") == "sequence") & blank(F.get_json_object("data", "$.sequence_for"))).alias("blank_purposes"),
    )
    return a.join(b)


def shares(df: DataFrame, key: str, total: int | None = None) -> DataFrame:
    """Rows per key with percent of all rows (or of ``total``)."""
    per = df.groupBy(key).agg(F.count("*").alias("n"))
    whole = F.lit(total) if total is not None else F.sum("n").over(Window.partitionBy())
    return per.select(key, "n", percent(F.col("n"), whole).alias("pct"))


def distribution(df: DataFrame, value: str) -> DataFrame:
    """One row: count, total, least, greatest, mean and upper median of a column of integers.

    The median comes from counts per distinct value: ranges of values are summed first, and only the range that holds
    the middle is added up value by value.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    per = df.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("v")).agg(F.count("*").alias("k"))
    all_ = per.agg(F.sum("k").alias("n"), F.sum(F.col("v") * F.col("k")).cast("long").alias("total"), F.min("v").alias("least"), F.max("v").alias("greatest"))
    ranged = cut_lineage(per.repartitionByRange(parts, "v").withColumn("p", F.spark_partition_id()))
    sums = [(r.p, r.k) for r in ranged.groupBy("p").agg(F.sum("k").alias("k")).orderBy("p").collect()]
    before, middle, here = 0, sum(k for _, k in sums) // 2, -1
    for here, k in sums:
        if before + k > middle:
            break
        before += k
    upto = F.lit(before) + F.sum("k").over(Window.partitionBy("p").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    median = ranged.where(F.col("p") == here).withColumn("upto", upto).where(F.col("upto") > middle).agg(F.min("v").alias("median"))
    return all_.crossJoin(F.broadcast(median)).select("n", "total", "least", "greatest", (F.col("total") / F.col("n")).alias("mean"), "median")


def histogram(df: DataFrame, value: str) -> DataFrame:
    """``bucket_no, bucket, n, pct`` over the fixed buckets, empty ones included; percent of all rows. 0 fits none."""
    spark = df.sparkSession
    names = spark.createDataFrame([(i, b[2]) for i, b in enumerate(BUCKETS, 1)], "bucket_no int, bucket string")
    no = F.lit(None).cast("int")
    for i, (low, high, _) in enumerate(BUCKETS, 1):
        inside = (F.col(value) >= low) if high is None else F.col(value).between(low, high)
        no = F.when(inside, F.lit(i)).otherwise(no)
    per = df.groupBy(no.alias("bucket_no")).agg(F.count("*").alias("n"))
    whole = per.agg(F.sum("n").alias("all"))
    out = F.broadcast(names).join(per, "bucket_no", "left").join(F.broadcast(whole))
    return out.select("bucket_no", "bucket", F.coalesce("n", F.lit(0)).alias("n"), percent(F.coalesce("n", F.lit(0)), F.coalesce("all", F.lit(0))).alias("pct"))


def stage_breakdown(healths: DataFrame, rules: Rules | None = None) -> DataFrame:
    """``stage, check, n_passed, n_due, pct``: every stage and check that occurs, and stages without any as 0 rows."""
    rules = rules or Rules()
    spark = healths.sparkSession
    due = spark.createDataFrame(list(rules.due.items()), "stage string, due_source string")
    per_source = healths.groupBy("source").agg(F.count("*").alias("k"))
    n_due = F.broadcast(due).join(per_source, F.col("due_source").isNull() | (F.col("due_source") == F.col("source")), "left").groupBy("stage").agg(F.coalesce(F.sum("k"), F.lit(0)).alias("n_due"))
    flat = healths.select(F.explode("breakdown").alias("stage", "checks")).select("stage", F.explode("checks").alias("check", "ok"))
    passed = flat.groupBy("stage", "check").agg(F.count_if("ok").alias("n_passed"))
    out = n_due.join(passed, "stage", "left")
    return out.select("stage", "check", F.coalesce("n_passed", F.lit(0)).alias("n_passed"), "n_due", percent(F.coalesce("n_passed", F.lit(0)), F.col("n_due")).alias("pct"))


def issue_counts(healths: DataFrame) -> DataFrame:
    return healths.select(F.explode("issues").alias("issue")).groupBy("issue").agg(F.count("*").alias("n_documents"))


def conversion_summary(healths: DataFrame, seconds: float = 5.0) -> DataFrame:
    """Turns, converted turns, percent, and hours left at ``seconds`` a turn."""
    t = healths.agg(F.coalesce(F.sum("total_turns"), F.lit(0)).alias("total_turns"), F.coalesce(F.sum("converted_turns"), F.lit(0)).alias("converted_turns"))
    left = F.col("total_turns") - F.col("converted_turns")
    return t.select("*", percent(F.col("converted_turns"), F.col("total_turns")).alias("pct"), (left * seconds / 3600.0).alias("hours_left"))


def exploded_share(df: DataFrame, values: str, name: str, records: int) -> DataFrame:
    """Uses of each element of a list column; percent of records, so they may sum to more than 100."""
    return df.select(F.explode(values).alias(name)).groupBy(name).agg(F.count("*").alias("n")).select(name, "n", percent(F.col("n"), F.lit(records)).alias("pct"))


def top_with_rest(counts: DataFrame, key: str, n: str = "n", k: int = 25, first: str | None = None) -> DataFrame:
    """The ``k`` most frequent keys and one row ``(other)`` for the rest; ties by where a key came ``first``, else by key."""
    top = counts.orderBy(F.desc(n), *([first] if first else []), key).limit(k)
    rest = counts.join(F.broadcast(top.select(key)), key, "left_anti").agg(F.coalesce(F.sum(n), F.lit(0)).alias(n)).select(F.lit("(other)").alias(key), n)
    return top.select(key, n).unionByName(rest)


def character_names(identities: DataFrame) -> DataFrame:
    """``doc_uuid, player, bot``: names of the first player and first bot of each document."""
    pick = lambda flag: F.get(F.filter("identities", lambda i: i["is_player_controlled"] == flag), F.lit(0))["name"]
    return identities.select("doc_uuid", pick(True).alias("player"), pick(False).alias("bot"))


def source_ranges(ordered: DataFrame, key: str, source: str) -> DataFrame:
    """Runs of consecutive rows of one source in key order: ``source, first_key, last_key, n``.

    Positions come from per-partition counts of a range-partitioned sort, so no task sees all rows.
    """
    n = positions(ordered.select(key, source), key, source)
    runs = numbered(n, source, "pos").withColumn("run", F.col("pos") - F.col("n"))
    return runs.groupBy(F.col(source).alias("source"), "run").agg(F.min(key).alias("first_key"), F.max(key).alias("last_key"), F.count("*").alias("n")).drop("run")


def position_samples(df: DataFrame, key: str, step: int = 1000) -> DataFrame:
    """The rows at positions step, step + 1, 2 step, 2 step + 1, ... (from 1) in key order."""
    return positions(df, key, *(c for c in df.columns if c != key)).where((F.col("pos") > 1) & (F.col("pos") % step).isin(0, 1 % step))


def ledger_orphans(meta: DataFrame, ledger: DataFrame) -> DataFrame:
    """``uuid, side``: documents without a ledger entry and ledger entries without a document."""
    a, b = meta.select(F.col("doc_uuid").alias("uuid"), F.lit(True).alias("d")).distinct(), ledger.select("uuid", F.lit(True).alias("l")).distinct()
    return a.join(b, "uuid", "full_outer").where("d is null or l is null").select("uuid", F.when(F.col("l").isNull(), "document").otherwise("ledger").alias("side"))


def _health_section(c: Corpus) -> dict[str, DataFrame]:
    h = health(c)
    return {"breakdown": stage_breakdown(h), "issues": issue_counts(h), "sources": shares(h, "source"), "conversion": conversion_summary(h)}


def _stats_section(c: Corpus) -> dict[str, DataFrame]:
    s, r = stats(c), resolve(c.items)
    axes = c.meta.select("doc_uuid").join(r, "doc_uuid", "left")
    unset = lambda a: shares(axes.select(F.coalesce(a, F.lit("Unset")).alias(a)), a)
    return {a: unset(a) for a in ("sexuality", "violence", "toxicity", "genre")} | {"items": distribution(s, "items"), "item_histogram": histogram(s, "items"), "words": distribution(s, "words")}


def _items_section(c: Corpus) -> dict[str, DataFrame]:
    return {"kinds": item_kinds(c.items), "variants": variant_counts(c.items, c.variants), "keys": structured_keys(c.items), "shapes": content_shapes(c.items, c.variants), "malformed": malformed(c.items, c.variants)}


SECTIONS: dict[str, Callable[[Corpus], dict[str, DataFrame]]] = {
    "health": _health_section,
    "stats": _stats_section,
    "items": _items_section,
    "char_names": lambda c: {"names": character_names(c.complete().meta)},
    "turn_distribution": lambda c: {"turns": distribution(stats(c), "turns"), "turn_histogram": histogram(stats(c), "turns")},
}


def report(corpus: Corpus, sections: list[str] | None = None) -> dict[str, dict[str, DataFrame]]:
    """Chosen sections in the order named; unknown names are left out, as :func:`unknown_sections` tells."""
    return {s: SECTIONS[s](corpus) for s in sections or list(SECTIONS) if s in SECTIONS}


def unknown_sections(sections: list[str]) -> list[str]:
    return [s for s in sections if s not in SECTIONS]
