"""Derived metadata: resolved axes, health rules and statistics."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.text import word_count
from lectern.model import SCALES, Corpus
from lectern.operators.select import source_identity


def _latest(axis: str) -> Column:
    """The last valid single value of an axis; invalid ones keep what was before."""
    value = F.get("value", F.lit(0))
    good = (F.col("category") == axis) & ~F.col("value_is_list") & value.isin(*SCALES[axis])
    return F.max_by(F.when(good, value), F.when(good, F.col("item_pos")))


def _gathered(category: str) -> Column:
    """All values of a category in item order, first occurrences only."""
    mine = F.when((F.col("category") == category) & F.col("value").isNotNull(), F.struct("item_pos", "value"))
    return F.array_distinct(F.flatten(F.transform(F.array_sort(F.collect_list(mine)), lambda x: x["value"])))


def resolve(items: DataFrame) -> DataFrame:
    """``doc_uuid, sexuality, violence, toxicity, genre, themes, languages`` per document with categorizations."""
    c = items.where("kind = 'categorization'")
    return c.groupBy("doc_uuid").agg(*(_latest(a).alias(a) for a in SCALES), _gathered("theme").alias("themes"), _gathered("language").alias("languages"))


def carried_identities(resolved: Column, source: Column) -> Column:
    """Identities of the metadata: once resolved, even an empty list wins over the source's."""
    return F.coalesce(resolved, source, F.array())


class Rules:
    """Which source each refinement is due for; null for all."""

    def __init__(self, forum: str = "hollowquill/forum-raw", chat: str = "emberlamp/chatlogs", markdown: str = "refine-cdm-html-to-markdown", grammar: str = "refine-chat-grammar") -> None:
        self.forum, self.chat, self.markdown, self.grammar = forum, chat, markdown, grammar
        self.due = {"refine-cdm-language": None, markdown: forum, "refine-chat-characters": chat, "refine-chat-safety-dials": chat, "refine-chat-genre-theme": chat, grammar: chat}


def _converted(items: DataFrame, variants: DataFrame, rules: Rules) -> DataFrame:
    """Per document: narratives and turns, and how many have the original and the refined variant."""
    names = variants.where(F.col("name").isin("original", rules.markdown, rules.grammar)).groupBy("doc_uuid", "item_id").agg(
        *(F.bool_or(F.col("name") == n).alias(a) for n, a in (("original", "o"), (rules.markdown, "m"), (rules.grammar, "g")))
    )
    at = items.where(F.col("kind").isin("narrative", "turn")).select("doc_uuid", "item_id", "kind").join(names, ["doc_uuid", "item_id"], "left")
    return at.groupBy("doc_uuid").agg(
        F.count_if(F.col("kind") == "narrative").alias("narratives"),
        F.count_if((F.col("kind") == "narrative") & F.col("o") & F.col("m")).alias("narratives_done"),
        F.count_if(F.col("kind") == "turn").alias("turns"),
        F.count_if((F.col("kind") == "turn") & F.col("o") & F.col("g")).alias("turns_done"),
        F.count_if((F.col("kind") == "turn") & F.col("g")).alias("turns_converted"),
    )


def health(corpus: Corpus, rules: Rules | None = None) -> DataFrame:
    """One row per document: ``doc_uuid, source, is_healthy, issues, total_turns, converted_turns, breakdown``.

    ``breakdown`` maps a stage to its checks, ``passed`` among them; stages due for another source are absent. A
    document without turns has no grammar issue though that stage isn't passed.
    """
    rules = rules or Rules()
    corpus = corpus.complete()
    present = corpus.items.groupBy("doc_uuid").agg(
        F.bool_or((F.col("category") == "language") & F.when(F.col("value_is_list"), F.size("value") > 0).otherwise(F.get("value", F.lit(0)) != "")).alias("language"),
        F.bool_or((F.col("kind") == "character") & ~F.col("entity_id").eqNullSafe("user")).alias("bot"),
        F.bool_or((F.col("kind") == "character") & F.col("entity_id").eqNullSafe("user")).alias("user"),
    )
    d = corpus.meta.select("doc_uuid", source_identity().alias("source"), F.transform("annotations", lambda a: a["kind"]).alias("kinds"))
    d = d.join(present, "doc_uuid", "left").join(resolve(corpus.items), "doc_uuid", "left").join(_converted(corpus.items, corpus.variants, rules), "doc_uuid", "left")
    yes = lambda c: F.coalesce(c, F.lit(False))
    num = lambda c: F.coalesce(F.col(c), F.lit(0))
    full = lambda done, of: (num(of) > 0) & (num(done) == num(of))
    filled = {a: F.col(a).isNotNull() for a in SCALES}
    checks = {
        "refine-cdm-language": {"categorization_item": (yes(F.col("language")), "Unset or empty language categorization")},
        rules.markdown: {"narrative": (full("narratives_done", "narratives"), None)},
        "refine-chat-characters": {"bot detail": (yes(F.col("bot")), "Missing bot character profile"), "user info": (yes(F.col("user")), "Missing user character profile")},
        "refine-chat-safety-dials": {f"{a} axis": (filled[a], f"Unset {a} categorization") for a in ("sexuality", "violence", "toxicity")},
        "refine-chat-genre-theme": {"primary genre": (filled["genre"], "Unset genre categorization"), "themes": (F.coalesce(F.size("themes"), F.lit(0)) > 0, "Unset thematic categorization")},
        rules.grammar: {"prose": (full("turns_done", "turns"), None)},
    }
    issues, stages = [], []
    for stage, source in rules.due.items():
        due = F.lit(True) if source is None else F.col("source") == source
        noted = F.array_contains("kinds", stage)
        own = {"annotation": (noted, f"Missing '{stage}' annotation")} | checks[stage]
        passed = F.lit(True)
        for _, (ok, _) in own.items():
            passed = passed & ok
        issues += [F.when(due & ~ok, F.lit(text)) for ok, text in own.values() if text]
        for of, done, s in (("narratives", "narratives_done", rules.markdown), ("turns", "turns_done", rules.grammar)):
            if stage == s:
                lack = num(of) - num(done)
                issues.append(F.when(due & (lack > 0), F.concat(lack.cast("string"), F.lit(f" {of} lack variant '{s}'"))))
        entries = F.map_from_arrays(F.array(F.lit("passed"), *map(F.lit, own)), F.array(passed, *(ok for ok, _ in own.values())))
        stages.append(F.when(due, F.struct(F.lit(stage).alias("key"), entries.alias("value"))))
    listed = F.array_compact(F.array(*issues))
    return d.select(
        "doc_uuid",
        "source",
        (F.size(listed) == 0).alias("is_healthy"),
        listed.alias("issues"),
        num("turns").alias("total_turns"),
        num("turns_converted").alias("converted_turns"),
        F.map_from_entries(F.array_compact(F.array(*stages))).alias("breakdown"),
    )


def stats(corpus: Corpus) -> DataFrame:
    """``doc_uuid, items, turns, narratives, characters, words`` per document; words of all variants are summed."""
    kinds = corpus.items.groupBy("doc_uuid").agg(
        F.count("*").alias("items"),
        F.count_if(F.col("kind") == "turn").alias("turns"),
        F.count_if(F.col("kind") == "narrative").alias("narratives"),
        F.count_if(F.col("kind") == "character").alias("characters"),
    )
    words = corpus.variants.groupBy("doc_uuid").agg(F.sum(word_count(F.col("text")).cast("long")).alias("words"))
    out = corpus.meta.select("doc_uuid").join(kinds, "doc_uuid", "left").join(words, "doc_uuid", "left")
    return out.fillna(0)


def described(corpus: Corpus) -> DataFrame:
    """Statistics with the resolved axes: ``Unset`` where an axis has no value, empty lists where there are no themes or languages."""
    d = stats(corpus).join(resolve(corpus.items), "doc_uuid", "left")
    none = F.array().cast("array<string>")
    return d.select("doc_uuid", "items", "turns", "narratives", "characters", "words", *(F.coalesce(a, F.lit("Unset")).alias(a) for a in SCALES), F.coalesce("themes", none).alias("themes"), F.coalesce("languages", none).alias("languages"))


def refresh(corpus: Corpus, rules: Rules | None = None) -> Corpus:
    """The corpus with resolved axes, then health, then statistics recomputed in its metadata."""
    corpus = corpus.complete()
    drop = ("sexuality", "violence", "toxicity", "genre", "themes", "languages", "is_healthy", "issues", "total_turns", "converted_turns", "breakdown", "turns", "narratives", "characters", "words", "item_count")
    meta = corpus.meta.drop(*drop).join(resolve(corpus.items), "doc_uuid", "left").join(health(corpus, rules).drop("source"), "doc_uuid", "left").join(stats(corpus).withColumnRenamed("items", "item_count"), "doc_uuid", "left")
    return replace(corpus, meta=meta)


def annotate(annotations: Column, kind: str, content: str, reasoning: str | None = None) -> Column:
    """Annotations with one more at the end."""
    new = F.struct(F.lit(kind).alias("kind"), F.lit(content).alias("content"), F.lit(reasoning).cast("string").alias("reasoning"))
    return F.concat(F.coalesce(annotations, F.array().cast("array<struct<kind:string,content:string,reasoning:string>>")), F.array(new))


def unannotate(annotations: Column, kind: str) -> Column:
    return F.filter(annotations, lambda a: ~a["kind"].eqNullSafe(kind))


def annotated(annotations: Column, kind: str) -> Column:
    return F.coalesce(F.exists(annotations, lambda a: a["kind"] == kind), F.lit(False))
