"""Refinements that add to documents, their roll-backs (scalpels), and purges."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions.html import html_to_markdown
from lectern.functions.text import strip
from lectern.model import KINDS, Corpus
from lectern.operators.meta import annotate, unannotate
from lectern.operators.select import delivery, of_kinds, preferred_text, uuid_targets
from lectern.plans.ordering import numbered


def upsert_variant(variants: DataFrame, new: DataFrame, name: str) -> DataFrame:
    """Variants with those of ``new`` (doc_uuid, item_id, text) under ``name``; other columns come from the latest original.

    Items that have the variant already get the new text in its place. Each new variant has an id of its own, which
    follows from document, item and name.
    """
    base = variants.where("name = 'original'").groupBy("doc_uuid", "item_id").agg(F.max_by(F.struct(*(c for c in variants.columns if c not in ("doc_uuid", "item_id"))), delivery(variants)).alias("v")).select("doc_uuid", "item_id", "v.*").join(new.withColumnRenamed("text", "__text"), ["doc_uuid", "item_id"]).withColumns({"name": F.lit(name), "text": F.col("__text")}).drop("__text")
    if "variant_id" in variants.columns:
        base = base.withColumn("variant_id", F.xxhash64("doc_uuid", "item_id", "name").cast(variants.schema["variant_id"].dataType))
    rest = variants.join(new.select("doc_uuid", "item_id", F.lit(name).alias("name")), ["doc_uuid", "item_id", "name"], "left_anti")
    return rest.select(variants.columns).unionByName(base.select(variants.columns))


def refine_markdown(corpus: Corpus, kinds: tuple[str, ...] = ("narrative",), preferred: tuple[str, ...] = ("original",), name: str = "refine-cdm-html-to-markdown") -> Corpus:
    """Add a Markdown variant to the items of ``kinds`` that have a preferred variant; no other variant stands in."""
    corpus = corpus.complete()
    at = of_kinds(corpus.items, list(kinds)).select("doc_uuid", "item_id")
    rank = F.array_position(F.array(*map(F.lit, preferred)), F.col("name"))
    texts = corpus.variants.where(F.col("name").isin(*preferred)).groupBy("doc_uuid", "item_id").agg(F.max_by("text", F.struct(-rank, delivery(corpus.variants))).alias("text"))
    new = texts.join(at, ["doc_uuid", "item_id"], "left_semi").where("text is not null").withColumn("text", html_to_markdown("text"))
    done = new.select("doc_uuid").distinct().withColumn("__done", F.lit(True))
    meta = corpus.meta.join(done, "doc_uuid", "left").withColumn("annotations", F.when(F.col("__done"), annotate(unannotate(F.col("annotations"), name), name, "HTML converted to Markdown")).otherwise(F.col("annotations"))).drop("__done")
    return replace(corpus, meta=meta, variants=upsert_variant(corpus.variants, new, name))


def language_windows(items: DataFrame, variants: DataFrame, targets: dict[str, list[str]], size: int = 5) -> DataFrame:
    """``doc_uuid, window_no, text``: texts of each ``size`` consecutive target items, joined by line feeds.

    Blank texts are left out of their window; windows without text don't appear.
    """
    out = None
    at = items.where(F.col("kind").isin(*targets)).select("doc_uuid", "item_id", "kind", "item_pos")
    at = numbered(at, "doc_uuid", "item_pos", "item_id").withColumn("window_no", F.floor((F.col("n") - 1) / size).cast("int")).drop("n")
    for kind, preferred in targets.items():
        part = at.where(F.col("kind") == kind).join(preferred_text(variants, preferred), ["doc_uuid", "item_id"])
        out = part if out is None else out.unionByName(part)
    rows = F.array_sort(F.collect_list(F.struct("item_pos", "item_id", "text")))
    return out.groupBy("doc_uuid", "window_no").agg(F.array_join(F.transform(rows, lambda r: r["text"]), "\n").alias("text"))


def trigram_scores(windows: DataFrame, samples: DataFrame, smooth: float = 0.5, max_samples: int = 20_000) -> DataFrame:
    """``doc_uuid, window_no, lang, score``: softmax over languages of mean trigram log-probability of a window.

    The profile goes to the workers, fitted on at most ``max_samples`` samples (those of the smallest hashes); each window is cut into trigrams and summed where it is
    read, without a row per trigram.
    """
    clean = lambda c: F.concat(F.lit(" "), F.lower(strip(F.regexp_replace(c, r"(?U)[^\p{L}]+", " "))), F.lit(" "))
    known: dict[str, dict[str, int]] = {}
    for r in samples.where("text is not null and lang is not null").orderBy(F.xxhash64("text", "lang")).limit(max_samples).select("lang", clean(F.col("text")).alias("c")).collect():
        mine = known.setdefault(r.lang, {})
        for i in range(len(r.c) - 2):
            mine[r.c[i : i + 3]] = mine.get(r.c[i : i + 3], 0) + 1
    profile = _Profile(known, smooth)
    shared = windows.sparkSession.sparkContext.broadcast(profile)
    kinds = ", ".join(f"{k} {windows.schema[k].dataType.simpleString()}" for k in ("doc_uuid", "window_no"))
    return windows.select("doc_uuid", "window_no", clean(F.col("text")).alias("c")).where("length(c) > 2").mapInArrow(lambda it: shared.value.scores(it), f"{kinds}, lang string, score double")


class _Profile:
    """Gains in log-probability of trigrams over unseen ones, a row per trigram and a column per language."""

    def __init__(self, known: dict[str, dict[str, int]], smooth: float) -> None:
        self.langs = sorted(known)
        self.at = {g: i for i, g in enumerate(sorted({g for m in known.values() for g in m}))}
        self.gain = np.zeros((len(self.at) + 1, len(self.langs)))  # the last row: unseen
        self.floor = np.zeros(len(self.langs))
        for j, lang in enumerate(self.langs):
            for g, n in known[lang].items():
                self.gain[self.at[g], j] = math.log(n / smooth + 1)
            self.floor[j] = math.log(smooth / (sum(known[lang].values()) + smooth * len(known[lang])))

    def scores(self, batches: Iterator[pa.RecordBatch], most: int = 40) -> Iterator[pa.RecordBatch]:
        get, unseen, n = self.at.get, len(self.at), len(self.langs)
        for b in batches:
            out = np.zeros((len(b), n))
            for i, c in enumerate(b.column("c").to_pylist()):
                ids = [get(c[k : k + 3], unseen) for k in range(len(c) - 2)]
                mean = self.floor + self.gain[ids].sum(axis=0) / len(ids)
                e = np.exp((mean - mean.max()) * min(len(ids), most))
                out[i] = e / e.sum()
            row = pa.array(np.repeat(np.arange(len(b)), n))
            langs = pa.array(self.langs * len(b), pa.string())
            yield pa.RecordBatch.from_arrays([b.column("doc_uuid").take(row), b.column("window_no").take(row), langs, pa.array(out.ravel())], ["doc_uuid", "window_no", "lang", "score"])


def detected_languages(scores: DataFrame, least: float = 0.05, most: int = 999) -> DataFrame:
    """``doc_uuid, languages, trace, n_windows``: each language's best window score, from the highest down."""
    # every window has a score for every language, so each language's rows count the windows
    best = scores.groupBy("doc_uuid", "lang").agg(F.max("score").alias("score"), F.count("*").alias("n")).where(F.col("score") >= least)
    rows = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "lang"))), 1, most)
    out = best.groupBy("doc_uuid").agg(rows.alias("r"), F.max("n").alias("n_windows"))
    return out.select("doc_uuid", F.transform("r", lambda x: x["lang"]).alias("languages"), F.array_join(F.transform("r", lambda x: F.concat(x["lang"], F.lit(":"), F.format_number(-x["s"], 2))), " ").alias("trace"), "n_windows")


def refine_language(corpus: Corpus, samples: DataFrame, targets: dict[str, list[str]] | None = None, size: int = 5, least: float = 0.05, most: int = 999, mode: str = "recompute") -> Corpus:
    """Upsert each document's ``language`` categorization; ``skip-if-present`` leaves documents that have one."""
    if mode not in ("recompute", "overwrite", "skip-if-present"):
        raise ValueError(f"unknown mode {mode}")
    corpus = corpus.complete()
    held = corpus.items.where("kind = 'categorization' and category = 'language'")
    items = corpus.items if mode != "skip-if-present" else corpus.items.join(held.select("doc_uuid").distinct(), "doc_uuid", "left_anti")
    found = detected_languages(trigram_scores(language_windows(items, corpus.variants, targets or {"turn": ["original"]}, size), samples), least, most)
    new = found.select("doc_uuid", F.col("languages").alias("value"), F.col("trace").alias("reasoning"))
    return replace(corpus, items=upsert_category(corpus.items, new, "language"), meta=noted(corpus.meta, new, "refine-cdm-language", "languages detected"))


def noted(meta: DataFrame, docs: DataFrame, kind: str, content: str) -> DataFrame:
    """The metadata with the annotation of a step, once, for the documents of ``docs``."""
    done = docs.select("doc_uuid").distinct().withColumn("__done", F.lit(True))
    return meta.join(done, "doc_uuid", "left").withColumn("annotations", F.when(F.col("__done"), annotate(unannotate(F.col("annotations"), kind), kind, content)).otherwise(F.col("annotations"))).drop("__done")


def upsert_category(items: DataFrame, new: DataFrame, category: str) -> DataFrame:
    """Items with one categorization of ``category`` for each document of ``new`` (doc_uuid, value, reasoning).

    It takes the place of those there; a new one goes to the end with the next free number.
    """
    mine = (F.col("kind") == "categorization") & (F.col("category") == category)
    number = F.regexp_extract("item_id", r"^categorization-(\d+)$", 1).try_cast("int")
    at = items.groupBy("doc_uuid").agg(F.min(F.when(mine, F.struct("item_pos", "item_id"))).alias("old"), F.max("item_pos").alias("last"), F.coalesce(F.max(number), F.lit(0)).alias("n"))
    row = new.join(at, "doc_uuid", "left").select(
        "doc_uuid",
        F.coalesce("old.item_pos", F.col("last") + 1, F.lit(0)).cast("int").alias("item_pos"),
        F.coalesce("old.item_id", F.format_string("categorization-%06d", F.coalesce("n", F.lit(0)) + 1)).alias("item_id"),
        F.lit("categorization").alias("kind"),
        F.lit(category).alias("category"),
        "value",
        F.lit(True).alias("value_is_list"),
        "reasoning",
    )
    rest = items.join(new.select("doc_uuid").distinct().withColumn("__new", F.lit(True)), "doc_uuid", "left").where(~(mine & F.col("__new")) | F.col("__new").isNull() | mine.isNull()).drop("__new")
    return rest.select(items.columns).unionByName(row, allowMissingColumns=True).select(items.columns)


def append_categories(items: DataFrame, new: DataFrame, *categories: str) -> DataFrame:
    """Items with the categorizations of ``new`` (doc_uuid, category, value) that documents lack."""
    have = items.where(F.col("category").isin(*categories)).select("doc_uuid", "category").distinct()
    lack = new.where(F.col("category").isin(*categories)).join(have, ["doc_uuid", "category"], "left_anti")
    last = items.groupBy("doc_uuid").agg(F.max("item_pos").alias("last"), F.coalesce(F.max(F.regexp_extract("item_id", r"^categorization-(\d+)$", 1).try_cast("int")), F.lit(0)).alias("n"))
    k = F.row_number().over(Window.partitionBy("doc_uuid").orderBy("category"))
    rows = lack.join(last, "doc_uuid", "left").withColumn("k", k).select("doc_uuid", (F.coalesce("last", F.lit(-1)) + F.col("k")).cast("int").alias("item_pos"), F.format_string("categorization-%06d", F.coalesce("n", F.lit(0)) + F.col("k")).alias("item_id"), F.lit("categorization").alias("kind"), "category", "value", ((F.size("value") != 1) | F.col("category").isin("theme", "language")).alias("value_is_list"))
    return items.unionByName(rows, allowMissingColumns=True).select(items.columns)


def prepend_characters(items: DataFrame, new: DataFrame) -> DataFrame:
    """Items with the character items of ``new`` (doc_uuid, item_id, entity_id, place) before all others."""
    shift = new.groupBy("doc_uuid").agg(F.count("*").cast("int").alias("__k"))
    moved = items.join(shift, "doc_uuid", "left").withColumn("item_pos", F.col("item_pos") + F.coalesce("__k", F.lit(0))).select(items.columns)
    rows = new.select("doc_uuid", F.col("place").cast("int").alias("item_pos"), "item_id", F.lit("character").alias("kind"), "entity_id")
    return moved.unionByName(rows, allowMissingColumns=True).select(items.columns)


def history(turns: DataFrame, text: str = "text", n: int = 5, block: int = 1_000) -> DataFrame:
    """With ``history``: the texts of the ``n`` items before, in order, joined by line feeds.

    Items are numbered without gathering a document, cut into blocks of ``block``, and the last ``n`` of a block are
    copied into the next, so a window never holds more than ``block + n`` rows.
    """
    at = numbered(turns, "doc_uuid", "item_pos", "item_id", name="__n").withColumn("__b", F.floor((F.col("__n") - 1) / block))
    tail = at.where((F.col("__n") - 1) % block >= block - n).withColumns({"__b": F.col("__b") + 1, "__copy": F.lit(True)})
    both = at.withColumn("__copy", F.lit(False)).unionByName(tail)
    before = Window.partitionBy("doc_uuid", "__b").orderBy("__n").rowsBetween(-n, -1)
    return both.withColumn("history", F.array_join(F.collect_list(text).over(before), "\n")).where(~F.col("__copy")).drop("__n", "__b", "__copy")


def opening(turns: DataFrame, n: int = 100) -> DataFrame:
    """``doc_uuid, prompt``: the first ``n`` turns as ``ROLE: text`` lines."""
    rank = F.row_number().over(Window.partitionBy("doc_uuid").orderBy("item_pos", "item_id"))
    line = F.concat(F.when(F.col("actor_id") == "user", "USER").otherwise("CHARACTER"), F.lit(": "), F.col("text"))
    rows = turns.withColumn("r", rank).where(F.col("r") <= n).groupBy("doc_uuid").agg(F.array_sort(F.collect_list(F.struct("r", line.alias("line")))).alias("x"))
    return rows.select("doc_uuid", F.array_join(F.transform("x", lambda x: x["line"]), "\n").alias("prompt"))


def character_card(name: Column, pronouns: Column, traits: Column, looks: Column) -> Column:
    """A character profile as text; empty parts are left out."""
    part = lambda head, list_: F.when(F.size(list_) > 0, F.concat(F.lit(head), F.array_join(list_, "; ")))
    said = F.concat_ws("/", pronouns["subjective"], pronouns["objective"], pronouns["possessive"])
    return F.concat_ws("\n", F.concat(F.lit("Name: "), name), F.concat(F.lit("Pronouns: "), said), part("Traits: ", traits), part("Appearance: ", looks))


# --- scalpels ---


def drop_categories(corpus: Corpus, *categories: str, annotation: str | None = None) -> Corpus:
    """Without the categorizations, and without the annotation of the step that made them."""
    corpus = corpus.complete()
    hit = (F.col("kind") == "categorization") & F.col("category").isin(*categories)
    meta = corpus.meta if annotation is None else corpus.meta.withColumn("annotations", unannotate(F.col("annotations"), annotation))
    return replace(corpus, items=corpus.items.where(~F.coalesce(hit, F.lit(False))), meta=meta)


def scalpel_language(corpus: Corpus) -> Corpus:
    return drop_categories(corpus, "language", annotation="refine-cdm-language")


def scalpel_genre_theme(corpus: Corpus) -> Corpus:
    return drop_categories(corpus, "genre", "theme", annotation="refine-chat-genre-theme")


def scalpel_safety_dials(corpus: Corpus) -> Corpus:
    return drop_categories(corpus, "sexuality", "violence", "toxicity", annotation="refine-chat-safety-dials")


def drop_variants(corpus: Corpus, name: str, kinds: tuple[str, ...] = (), documents: DataFrame | None = None) -> Corpus:
    """Without variants of a name, on items of ``kinds`` (all if none given), in ``documents`` (all if none given)."""
    corpus = corpus.complete()
    hit = corpus.variants.where(F.col("name") == name)
    if kinds:
        hit = hit.join(corpus.items.where(F.col("kind").isin(*kinds)).select("doc_uuid", "item_id"), ["doc_uuid", "item_id"], "left_semi")
    if documents is not None:
        hit = hit.join(documents.select("doc_uuid").distinct(), "doc_uuid", "left_semi")
    keys = hit.select("doc_uuid", "item_id", "name").distinct()
    touched = keys.select("doc_uuid").distinct().withColumn("__hit", F.lit(True))
    meta = corpus.meta.join(touched, "doc_uuid", "left").withColumn("annotations", F.when(F.col("__hit"), unannotate(F.col("annotations"), name)).otherwise(F.col("annotations"))).drop("__hit")
    return replace(corpus, variants=corpus.variants.join(keys, ["doc_uuid", "item_id", "name"], "left_anti").select(corpus.variants.columns), meta=meta)


def scalpel_markdown(corpus: Corpus) -> Corpus:
    return drop_variants(corpus, "refine-cdm-html-to-markdown")


def scalpel_grammar(corpus: Corpus, healths: DataFrame | None = None, sentinel: bool = False) -> Corpus:
    """Without grammar variants of turns; with ``sentinel`` only where the health breakdown has the user's profile."""
    docs = None
    if sentinel:
        docs = healths.where(F.coalesce(F.col("breakdown")["refine-chat-characters"]["user info"], F.lit(False)))
    return drop_variants(corpus, "refine-chat-grammar", ("turn",), docs)


def scalpel_characters(corpus: Corpus, names: list[str] | None = None) -> Corpus:
    """Without character items and identities; with ``names`` only where the first player's name is one of them."""
    corpus = corpus.complete()
    first = F.get(F.filter("identities", lambda i: i["is_player_controlled"]), F.lit(0))["name"]
    hit = F.lit(True) if names is None else F.coalesce(F.lower(strip(first)).isin(*[n.strip().lower() for n in names]), F.lit(False))
    docs = corpus.meta.where(hit).select("doc_uuid").distinct()
    gone = corpus.items.where("kind = 'character'").join(docs, "doc_uuid", "left_semi").select("doc_uuid", "item_id")
    keep = lambda df: df.join(gone, ["doc_uuid", "item_id"], "left_anti").select(df.columns)
    meta = corpus.meta.withColumn("identities", F.when(hit, F.expr("array()").cast(corpus.meta.schema["identities"].dataType)).otherwise(F.col("identities"))).withColumn("annotations", F.when(hit, unannotate(F.col("annotations"), "refine-chat-characters")).otherwise(F.col("annotations")))
    return Corpus(meta, keep(corpus.items), keep(corpus.variants), corpus.ledger)


# --- purges ---


def purge_records(corpus: Corpus, targets: str | list[str] | None = None, start: str | None = None, stop: str | None = None) -> Corpus:
    """Without the named documents or those in the range; refuses to run without any scope."""
    wanted = uuid_targets(targets)
    if not wanted and start is None and stop is None:
        raise ValueError("name documents or a range to purge")
    hit = F.col("doc_uuid").isin(*wanted) if wanted else F.lit(True)
    for bound, ok in ((start, lambda b: F.col("doc_uuid") >= b), (stop, lambda b: F.col("doc_uuid") <= b)):
        if bound is not None:
            hit = hit & ok(str(bound))
    return corpus.without(corpus.meta.where(hit))


def corrupt_documents(corpus: Corpus) -> DataFrame:
    """``doc_uuid, reason`` of documents that break the model: unknown item kinds, ids repeated or missing, bad JSON data."""
    bad = corpus.items.where(~F.coalesce(F.col("kind"), F.lit("")).isin(*KINDS)).select("doc_uuid", F.lit("item kind").alias("reason"))
    twice = corpus.items.groupBy("doc_uuid", "item_id").agg(F.count("*").alias("n")).where("n > 1 or item_id is null").select("doc_uuid", F.lit("item id").alias("reason"))
    data = corpus.items.where("data is not null").where(F.try_parse_json("data").isNull()).select("doc_uuid", F.lit("data").alias("reason"))
    kind = corpus.meta.where("kind is null or kind <> 'document'").select("doc_uuid", F.lit("document kind").alias("reason"))
    return bad.unionByName(twice).unionByName(data).unionByName(kind).distinct()


def purge_corrupt(corpus: Corpus, corrupt: DataFrame | None = None) -> Corpus:
    return corpus.without(corrupt_documents(corpus) if corrupt is None else corrupt)


def dangling_sequence_ids(items: DataFrame) -> DataFrame:
    """``doc_uuid, item_id, n_ids, n_dangling, n_repeated`` of sequences: ids of no item, and repeats of ids."""
    ids = items.where("kind = 'sequence'").select("doc_uuid", F.col("item_id").alias("seq"), F.explode("item_ids").alias("id")).groupBy("doc_uuid", "seq", "id").agg(F.count("*").alias("k"))
    known = items.select("doc_uuid", F.col("item_id").alias("id"), F.lit(True).alias("known")).distinct()
    j = ids.join(known, ["doc_uuid", "id"], "left")
    return j.groupBy("doc_uuid", F.col("seq").alias("item_id")).agg(F.sum("k").alias("n_ids"), F.coalesce(F.sum(F.when(F.col("known").isNull(), F.col("k"))), F.lit(0)).alias("n_dangling"), F.sum(F.col("k") - 1).alias("n_repeated"))


