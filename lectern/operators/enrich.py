"""Refinements by a model: safety dials, genre and themes, characters, grammar.

Each step takes the documents that still lack its result, asks the backend once a document (grammar: once a turn, in
order), checks answers against a schema, and adds items with the step's annotation. Answers that fail leave their
document as it was, to be taken up by the next run. Answers are checkpointed, so a step that is recomputed doesn't ask again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.text import normal_gender, sanitize_tags
from lectern.inference import Backend, answers, refine_turns
from lectern.model import GENDERS, GENRES, IDENTITY, SEXUAL, TOXICITY, VIOLENCE, Corpus
from lectern.operators.refine import noted, append_categories, character_card, opening, prepend_characters, upsert_variant
from lectern.operators.select import of_source, preferred_text, with_variant, without_categories
from lectern.plans import cut_lineage

Make = Callable[[], Backend]


def _text(*allowed: str) -> dict[str, Any]:
    return {"type": "string", "enum": list(allowed)} if allowed else {"type": "string"}


def _list() -> dict[str, Any]:
    return {"type": "array", "items": {"type": "string"}}


def _object(**properties: dict[str, Any]) -> dict[str, Any]:
    return {"type": "object", "properties": properties}


_PROFILE = _object(
    name=_text(),
    gender=_text(*GENDERS),
    pronouns=_object(subjective=_text(), objective=_text(), possessive=_text()),
    core_traits=_list(),
    appearance_details=_list(),
)
SCHEMAS = {
    "safety": _object(sexual_axis=_text(*SEXUAL), violence_axis=_text(*VIOLENCE), toxicity_axis=_text(*TOXICITY)),
    "genre": _object(primary_genre=_text(*GENRES), themes=_list()),
    "characters": _object(user_character=_PROFILE, bot_character=_PROFILE),
    "grammar": _object(text=_text()),
}


def prompts(corpus: Corpus, documents: DataFrame, preferred: tuple[str, ...] = ("original",), turns: int = 100) -> DataFrame:
    """``key, prompt``: the opening turns of each document as ``ROLE: text`` lines."""
    at = corpus.items.where("kind = 'turn'").join(documents.select("doc_uuid"), "doc_uuid", "left_semi")
    texts = at.join(preferred_text(corpus.variants, list(preferred)).select("doc_uuid", "item_id", "text"), ["doc_uuid", "item_id"])
    return opening(texts, turns).select(F.col("doc_uuid").alias("key"), "prompt")


def _answered(corpus: Corpus, documents: DataFrame, make: Make, schema: str, fields: str, preferred: tuple[str, ...], **options: Any) -> DataFrame:
    got = cut_lineage(answers(prompts(corpus, documents, preferred), make, SCHEMAS[schema], **options))
    return got.where("answer is not null").select(F.col("key").alias("doc_uuid"), F.from_json("answer", fields).alias("a"))


def refine_safety(corpus: Corpus, make: Make, source: str = "emberlamp/chatlogs", preferred: tuple[str, ...] = ("original",), **options: Any) -> Corpus:
    """Append the axes of the safety dials that documents lack."""
    corpus = corpus.complete()
    axes = ("sexuality", "violence", "toxicity")
    a = _answered(corpus, without_categories(of_source(corpus.meta, source), corpus.items, *axes), make, "safety", "sexual_axis string, violence_axis string, toxicity_axis string", preferred, **options)
    cells = F.explode(F.array(*(F.struct(F.lit(c).alias("category"), F.array(F.col(f"a.{f}")).alias("value")) for c, f in zip(axes, ("sexual_axis", "violence_axis", "toxicity_axis")))))
    new = a.select("doc_uuid", cells.alias("c")).select("doc_uuid", "c.*")
    return replace(corpus, items=append_categories(corpus.items, new, *axes), meta=noted(corpus.meta, new, "refine-chat-safety-dials", "safety dials set"))


def refine_genre(corpus: Corpus, make: Make, source: str = "emberlamp/chatlogs", preferred: tuple[str, ...] = ("original",), **options: Any) -> Corpus:
    """Append genre and sanitised themes that documents lack."""
    corpus = corpus.complete()
    a = _answered(corpus, without_categories(of_source(corpus.meta, source), corpus.items, "genre", "theme"), make, "genre", "primary_genre string, themes array<string>", preferred, **options)
    cells = F.explode(F.array(F.struct(F.lit("genre").alias("category"), F.array("a.primary_genre").alias("value")), F.struct(F.lit("theme").alias("category"), sanitize_tags(F.col("a.themes")).alias("value"))))
    new = a.select("doc_uuid", cells.alias("c")).select("doc_uuid", "c.*")
    return replace(corpus, items=append_categories(corpus.items, new, "genre", "theme"), meta=noted(corpus.meta, new, "refine-chat-genre-theme", "genre and themes set"))


def without_user_profile(meta: DataFrame, items: DataFrame) -> DataFrame:
    """Documents without a character item of the user."""
    return meta.join(items.where("kind = 'character' and entity_id = 'user'").select("doc_uuid").distinct(), "doc_uuid", "left_anti")


def _identity(profile: Column, entity: Column, player: bool) -> Column:
    return F.struct(entity.alias("entity_id"), profile["name"].alias("name"), normal_gender(profile["gender"]).alias("gender"), profile["pronouns"].alias("pronouns"), F.lit(player).alias("is_player_controlled"))


def refine_characters(corpus: Corpus, make: Make, source: str = "emberlamp/chatlogs", preferred: tuple[str, ...] = ("original",), **options: Any) -> Corpus:
    """Set the identities of user and bot, and put a profile of each before all items."""
    corpus = corpus.complete()
    profile = "struct<name:string,gender:string,pronouns:struct<subjective:string,objective:string,possessive:string>,core_traits:array<string>,appearance_details:array<string>>"
    a = _answered(corpus, without_user_profile(of_source(corpus.meta, source), corpus.items), make, "characters", f"user_character {profile}, bot_character {profile}", preferred, **options)
    number = F.regexp_extract("item_id", r"^character-(\d+)$", 1).try_cast("int")
    per = corpus.items.groupBy("doc_uuid").agg(F.coalesce(F.max(number), F.lit(0)).alias("n"), F.min(F.when((F.col("kind") == "turn") & (F.col("actor_id") != "user"), F.col("actor_id"))).alias("bot"))
    a = cut_lineage(a.join(per, "doc_uuid", "left").withColumn("bot", F.coalesce("bot", F.lit("bot"))))
    two = F.explode(F.array(*(F.struct(F.lit(i).alias("place"), e.alias("entity_id"), F.col(f"a.{p}").alias("p")) for i, (e, p) in enumerate(((F.lit("user"), "user_character"), (F.col("bot"), "bot_character"))))))
    rows = a.select("doc_uuid", "n", two.alias("x")).select("doc_uuid", F.format_string("character-%06d", F.coalesce("n", F.lit(0)) + F.col("x.place") + 1).alias("item_id"), "x.entity_id", "x.place", "x.p")
    card = character_card(F.col("p.name"), F.col("p.pronouns"), F.col("p.core_traits"), F.col("p.appearance_details"))
    texts = rows.select("doc_uuid", "item_id", F.lit("original").alias("name"), card.alias("text"))
    known = F.array(_identity(F.col("a.user_character"), F.lit("user"), True), _identity(F.col("a.bot_character"), F.col("bot"), False)).cast(f"array<{IDENTITY}>")
    meta = corpus.meta.join(a.select("doc_uuid", known.alias("__new")), "doc_uuid", "left").withColumn("identities", F.coalesce("__new", "identities")).drop("__new")
    return Corpus(
        noted(meta, rows, "refine-chat-characters", "characters described"),
        prepend_characters(corpus.items, rows.select("doc_uuid", "item_id", "entity_id", "place")),
        corpus.variants.unionByName(texts, allowMissingColumns=True),
        corpus.ledger,
    )


def actor_names(turns: DataFrame, meta: DataFrame, default: str = "the character") -> DataFrame:
    """Turns with ``actor_name`` from their document's identities; of several with one id the last counts."""
    who = meta.select("doc_uuid", F.posexplode("identities").alias("i", "p")).groupBy("doc_uuid", F.col("p.entity_id").alias("actor_id")).agg(F.max_by("p.name", "i").alias("actor_name"))
    return turns.join(who, ["doc_uuid", "actor_id"], "left").withColumn("actor_name", F.coalesce("actor_name", F.lit(default)))


def grammar_prompt(text: Column, actor: Column, others: Column, rules: tuple[str, ...] = ("third person", "past tense", "keep every fact")) -> Column:
    """The instructions for one turn: who speaks, who else is there, the rules, the text."""
    return F.concat_ws("\n", F.concat(F.lit("Speaker: "), actor), F.when(F.size(others) > 0, F.concat(F.lit("Others: "), F.array_join(others, ", "))), F.lit("Rules: " + "; ".join(rules)), F.concat(F.lit("Text: "), text))


def refine_grammar(corpus: Corpus, make: Make, source: str = "emberlamp/chatlogs", name: str = "refine-chat-grammar", budget: int | None = None) -> Corpus:
    """Add a rewritten variant to turns that lack one; ``budget`` takes the first turns by document and place."""
    corpus = corpus.complete()
    turns = corpus.items.where("kind = 'turn'").join(of_source(corpus.meta, source).select("doc_uuid"), "doc_uuid", "left_semi")
    todo = turns.join(with_variant(turns, corpus.variants, "original", name).select("doc_uuid", "item_id"), ["doc_uuid", "item_id"], "left_anti").select("doc_uuid", "item_id", "item_pos", "actor_id")
    if budget is not None:
        todo = todo.orderBy("doc_uuid", "item_pos", "item_id").limit(budget)
    named = actor_names(todo, corpus.meta)
    others = corpus.meta.select("doc_uuid", F.transform("identities", lambda i: i["name"]).alias("__all"))
    texts = named.join(others, "doc_uuid", "left").join(preferred_text(corpus.variants, ["original"]).select("doc_uuid", "item_id", "text"), ["doc_uuid", "item_id"])
    asked = texts.select("doc_uuid", "item_id", "item_pos", grammar_prompt(F.col("text"), F.col("actor_name"), F.array_remove(F.coalesce("__all", F.array().cast("array<string>")), F.col("actor_name"))).alias("text"))
    new = cut_lineage(refine_turns(asked, make, schema=SCHEMAS["grammar"]))
    return replace(corpus, variants=upsert_variant(corpus.variants, new, name), meta=noted(corpus.meta, new, name, "turns rewritten"))
