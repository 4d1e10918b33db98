"""The queries of the core operators on the driver's tables, each with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions.html import html_to_markdown
from lectern.functions.text import content_address, joined_lines, paragraphs, sanitize_tag, sanitize_tags, theme_term, token_budget, token_estimate
from lectern.model import SCALES, Corpus
from lectern.operators import ingest, meta, package, refine, report, resolve, select
from lectern.operators.components import connected_components
from lectern.oracle import SQL
from lectern.plans import table
from lectern.plans.ordering import numbered
from lectern.streaming.merge import windowed_counts

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

LOW, HIGH = "01961283", "01961290"  # an id range of the range queries
PAIR_CUT = 0.7


def query(f: Query) -> Query:
    _QUERIES[f.__name__] = f
    return f


def queries() -> dict[str, Query]:
    from lectern import catalog_flows

    return _QUERIES | catalog_flows.queries()


def oracle_sql() -> dict[str, str]:
    from lectern import oracle_flows

    return {k: v for k, v in (SQL | oracle_flows.SQL).items() if k in queries()}


def _corpus(spark: SparkSession, folder: str) -> Corpus:
    """The corpus; documents marked healthy carry the annotations of all steps."""
    c = Corpus.load(spark, folder)
    note = lambda k: F.struct(F.lit(k).alias("kind"), F.lit("done").alias("content"), F.lit(None).cast("string").alias("reasoning"))
    notes = F.array(*(note(k) for k in meta.Rules().due))
    return replace(c, meta=c.meta.withColumn("annotations", F.when(F.coalesce("is_healthy", F.lit(False)), notes).otherwise(F.col("annotations"))))


def _tags(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "genre_themes").select("response_id", "doc_uuid", "primary_genre", F.posexplode("themes").alias("tag_no", "tag"))


# --- ingestion and ledger ---


@query
def ingest_turn_items(spark, folder):
    turns = table(spark, folder, "doc_items").where("kind = 'turn'").select("doc_uuid", "item_pos", F.col("item_id").alias("old_id"), "actor_id")
    actor = F.when(F.col("actor_id") == "user", F.lit("user")).otherwise(F.coalesce("actor_id", F.lit("bot")))
    return numbered(turns, "doc_uuid", "item_pos", "old_id").select("doc_uuid", ingest.item_id("turn", F.col("n")).alias("item_id"), F.col("n").alias("turn_no"), actor.alias("actor"))


@query
def ingest_sequence_items(spark, folder):
    ids = F.collect_list(F.struct("item_pos", "item_id"))
    per = table(spark, folder, "doc_items").where("kind = 'turn'").groupBy("doc_uuid").agg(F.array_sort(ids).alias("r"))
    return per.select("doc_uuid", F.size("r").cast("long").alias("n_ids"), F.array_join(F.transform("r", lambda r: r["item_id"]), ",").alias("ids"))


@query
def content_addresses(spark, folder):
    return table(spark, folder, "content_variants").where("text is not null").select("variant_id", content_address(F.col("text")).alias("address"))


@query
def content_dedup(spark, folder):
    v = table(spark, folder, "content_variants").where("name = 'original' and text is not null")
    return v.groupBy(content_address(F.col("text")).alias("address")).agg(F.min("variant_id").alias("first_id"), F.count("*").alias("copies"))


@query
def exact_dup_groups(spark, folder):
    d = table(spark, folder, "documents").where("text is not null")
    return d.groupBy(F.md5("text").alias("md5")).agg(F.count("*").alias("copies"), F.min("doc_id").alias("first_id")).where("copies > 1")


@query
def ledger_latest(spark, folder):
    led = table(spark, folder, "ledger")
    return led.groupBy("source", "native_id").agg(F.max_by("uuid", F.struct("recorded_at", "uuid")).alias("uuid"), F.count("*").alias("n_entries"), F.count_distinct("uuid").alias("n_uuids"))


@query
def ledger_register(spark, folder):
    records = table(spark, folder, "doc_meta").select(select.source_identity().alias("source"), "native_id")
    out = ingest.register(records, table(spark, folder, "ledger"), F.lit("2025-01-01"))
    return out.select("source", "native_id", "is_new", F.when(~F.col("is_new"), F.col("uuid")).alias("known_uuid"))


@query
def ledger_source_ranges(spark, folder):
    m = table(spark, folder, "doc_meta").select("doc_uuid", select.source_identity().alias("src"))
    return report.source_ranges(m, "doc_uuid", "src")


@query
def ledger_position_samples(spark, folder):
    m = table(spark, folder, "doc_meta").select("doc_uuid", select.source_identity().alias("src"))
    return report.position_samples(m, "doc_uuid", 100)


@query
def ledger_orphans(spark, folder):
    return report.ledger_orphans(table(spark, folder, "doc_meta"), table(spark, folder, "ledger"))


@query
def reconcile_upsert(spark, folder):
    events = table(spark, folder, "events").select("user_id", "event_type", "ts", "event_id", "value")
    half = F.to_timestamp(F.lit("2024-01-15"))
    return ingest.merge_latest(events.where(F.col("ts") < half), events.where(F.col("ts") >= half), ["user_id", "event_type"], ["ts", "event_id"])


@query
def redelivered_variants(spark, folder):
    v = table(spark, folder, "content_variants").select("doc_uuid", "item_id", "name", "variant_id", "ingested_at", "post_id")
    per = v.groupBy("doc_uuid", "item_id", "name").agg(F.max_by("variant_id", F.struct("ingested_at", "variant_id")).alias("latest_id"), F.count("*").alias("deliveries"))
    return per.where("deliveries > 1")


@query
def reconcile_changes(spark, folder):
    v = table(spark, folder, "content_variants").where("name = 'original'")
    key = F.concat_ws("/", "doc_uuid", "item_id")
    first = v.groupBy(key.alias("k")).agg(F.min_by("text", "variant_id").alias("text"))
    last = v.where("ingested_at >= timestamp '2024-09-01'").groupBy(key.alias("k")).agg(F.max_by("text", F.struct("ingested_at", "variant_id")).alias("text"))
    return ingest.reconcile(first, last, "k", ["text"]).groupBy("change").agg(F.count("*").alias("n"))


@query
def thread_sequence(spark, folder):
    posts = table(spark, folder, "content_variants").where("name = 'original' and post_id is not null").select("doc_uuid", "item_id", "posted_at", "post_id").distinct()
    return ingest.thread_sequences(posts, "doc_uuid").select("doc_uuid", F.size("item_ids").cast("long").alias("n_ids"), F.array_join("item_ids", ",").alias("ids"))


@query
def paragraph_split(spark, folder):
    d = table(spark, folder, "documents")
    p = d.select("doc_id", F.posexplode(paragraphs(F.col("text"))).alias("paragraph_no", "p"))
    return p.select("doc_id", "paragraph_no", joined_lines(F.col("p")).alias("paragraph"))


@query
def dangling_sequences(spark, folder):
    return refine.dangling_sequence_ids(table(spark, folder, "doc_items"))


# --- filters and choices ---


@query
def range_filter(spark, folder):
    return select.in_range(table(spark, folder, "doc_meta"), LOW, HIGH).select("doc_uuid", "native_id")


@query
def source_scope(spark, folder):
    m = select.of_source(table(spark, folder, "doc_meta"), "emberlamp/chatlogs", "unknown")
    return m.groupBy(select.source_identity().alias("source")).agg(F.count("*").alias("n"))


@query
def variant_select(spark, folder):
    return select.preferred_text(table(spark, folder, "content_variants"), ["refine-chat-grammar", "original"])


@query
def variants_present(spark, folder):
    items = table(spark, folder, "doc_items").select("doc_uuid", "item_id", "kind")
    return select.with_variant(items, table(spark, folder, "content_variants"), "original", "refine-chat-grammar")


@query
def pending_categories(spark, folder):
    m = table(spark, folder, "doc_meta")
    return select.without_categories(m, table(spark, folder, "doc_items"), "genre", "theme").select("doc_uuid")


@query
def inference_budget(spark, folder):
    turns = table(spark, folder, "doc_items").where("kind = 'turn'").select("doc_uuid", "item_pos", "item_id")
    done = table(spark, folder, "content_variants").where("name = 'refine-chat-grammar'").select("doc_uuid", "item_id").distinct()
    return select.pending(turns.join(done, ["doc_uuid", "item_id"], "left_anti"), 50, "doc_uuid", "item_pos", "item_id")


# --- reports ---


@query
def doc_stats(spark, folder):
    return meta.stats(Corpus.load(spark, folder))


@query
def item_kind_counts(spark, folder):
    return report.item_kinds(table(spark, folder, "doc_items"))


@query
def variant_counts(spark, folder):
    return report.variant_counts(table(spark, folder, "doc_items"), table(spark, folder, "content_variants"))


@query
def structured_keys(spark, folder):
    return report.structured_keys(table(spark, folder, "doc_items"))


@query
def content_shapes(spark, folder):
    return report.content_shapes(table(spark, folder, "doc_items"), table(spark, folder, "content_variants"))


@query
def malformed_counts(spark, folder):
    return report.malformed(table(spark, folder, "doc_items"), table(spark, folder, "content_variants"))


def _turns(spark, folder):
    m, i = table(spark, folder, "doc_meta").select("doc_uuid"), table(spark, folder, "doc_items")
    return m.join(i.where("kind = 'turn'").groupBy("doc_uuid").agg(F.count("*").alias("turns")), "doc_uuid", "left").fillna(0)


@query
def turn_distribution(spark, folder):
    return report.distribution(_turns(spark, folder), "turns")


@query
def turn_buckets(spark, folder):
    return report.histogram(_turns(spark, folder), "turns")


@query
def narrative_distribution(spark, folder):
    return report.distribution(table(spark, folder, "documents").select(F.length("text").cast("long").alias("chars")), "chars")


@query
def safety_distribution(spark, folder):
    docs = table(spark, folder, "doc_meta").select("doc_uuid")
    axes = ("sexual_axis", "violence_axis", "toxicity_axis")
    last = table(spark, folder, "safety_dials").groupBy("doc_uuid").agg(F.max_by(F.struct(*axes), F.struct("responded_at", "response_id")).alias("x"))
    each = docs.join(last, "doc_uuid", "left").select(*(F.coalesce(f"x.{a}", F.lit("Unset")).alias(a) for a in axes))
    out = None
    for a in axes:
        one = report.shares(each.withColumnRenamed(a, "value"), "value").withColumn("axis", F.lit(a))
        out = one if out is None else out.unionByName(one)
    return out


@query
def genre_mix(spark, folder):
    return report.shares(table(spark, folder, "genre_themes").select(F.coalesce("primary_genre", F.lit("Unset")).alias("genre")), "genre")


@query
def theme_top25(spark, folder):
    g = table(spark, folder, "genre_themes").select(F.explode(sanitize_tags(F.col("themes"))).alias("tag"))
    return report.top_with_rest(g.groupBy("tag").agg(F.count("*").alias("n")), "tag")


@query
def language_distribution(spark, folder):
    items = select.of_categories(table(spark, folder, "doc_items"), "language")
    records = table(spark, folder, "doc_meta").count()
    return report.exploded_share(items, "value", "lang", records)


def _health(spark, folder):
    return meta.health(_corpus(spark, folder))


@query
def health_flags(spark, folder):
    flag = lambda stage, check: F.coalesce(F.col("breakdown")[stage][check].cast("string"), F.lit("n/a")).alias((stage + "_" + check).replace("-", "_").replace(" ", "_"))
    pairs = (("refine-cdm-language", "passed"), ("refine-cdm-html-to-markdown", "narrative"), ("refine-chat-characters", "bot detail"), ("refine-chat-characters", "user info"), ("refine-chat-genre-theme", "themes"), ("refine-chat-grammar", "prose"))
    return _health(spark, folder).select("doc_uuid", "source", "is_healthy", F.size("issues").cast("long").alias("n_issues"), "total_turns", "converted_turns", *(flag(*p) for p in pairs))


@query
def stage_breakdown(spark, folder):
    return report.stage_breakdown(_health(spark, folder))


@query
def issue_counts(spark, folder):
    return report.issue_counts(_health(spark, folder))


@query
def source_breakdown(spark, folder):
    return report.shares(table(spark, folder, "doc_meta").select(select.source_identity().alias("source")), "source")


@query
def conversion_summary(spark, folder):
    return report.conversion_summary(_health(spark, folder))


@query
def char_names(spark, folder):
    c = table(spark, folder, "doc_items").where("kind = 'character'")
    first = lambda cond: F.min_by(F.when(cond, F.col("entity_id")), F.when(cond, F.struct("item_pos", "item_id")))
    user = F.col("entity_id") == "user"
    return c.groupBy("doc_uuid").agg(first(user).alias("player"), first(~user).alias("bot"))


@query
def url_profile(spark, folder):
    d = table(spark, folder, "documents")
    return d.groupBy("thread_id").agg(F.count("*").alias("n"), F.count_distinct(F.xxhash64("text")).alias("n_texts"), F.sum("n_chars").alias("chars"), F.max("n_chars").alias("longest"))


# --- document semantics ---


@query
def resolve_meta(spark, folder):
    r = meta.resolve(table(spark, folder, "doc_items"))
    return r.select("doc_uuid", *SCALES, F.array_join("themes", "|").alias("themes"), F.array_join("languages", "|").alias("languages"))


@query
def history_context(spark, folder):
    turns = table(spark, folder, "doc_items").where("kind = 'turn'").select("doc_uuid", "item_pos", "item_id")
    return refine.history(turns, "item_id")


def _turn_texts(spark, folder):
    i = table(spark, folder, "doc_items").where("kind = 'turn'").select("doc_uuid", "item_pos", "item_id", "actor_id")
    return i.join(select.preferred_text(table(spark, folder, "content_variants"), ["original"]).select("doc_uuid", "item_id", "text"), ["doc_uuid", "item_id"])


@query
def prompt_first_100(spark, folder):
    return refine.opening(_turn_texts(spark, folder)).select("doc_uuid", F.sha2("prompt", 256).alias("prompt_sha"), F.length("prompt").cast("long").alias("chars"))


@query
def token_budgets(spark, folder):
    v = table(spark, folder, "content_variants")
    return v.select("variant_id", token_estimate(F.col("text")).alias("estimate"), token_budget(F.col("text")).alias("budget"))


@query
def language_windows(spark, folder):
    w = refine.language_windows(table(spark, folder, "doc_items"), table(spark, folder, "content_variants"), {"turn": ["original"], "narrative": ["original"]})
    return w.select("doc_uuid", "window_no", F.sha2("text", 256).alias("text_sha"))


@query
def language_scores(spark, folder):
    w = refine.language_windows(table(spark, folder, "doc_items"), table(spark, folder, "content_variants"), {"turn": ["original"], "narrative": ["original"]})
    d = refine.detected_languages(refine.trigram_scores(w, table(spark, folder, "lang_samples")))
    return d.select("doc_uuid", F.array_join("languages", ",").alias("languages"), "n_windows")


@query
def latest_annotations(spark, folder):
    v = table(spark, folder, "content_variants").where("annotation is not null")
    return v.groupBy("doc_uuid", "item_id").agg(F.max_by("annotation", F.struct("ingested_at", "variant_id")).alias("annotation"), F.count("*").alias("n"))


@query
def html_extract(spark, folder):
    v = table(spark, folder, "content_variants").where("text like '%<%'")
    return v.select("variant_id", F.regexp_extract("text", "^<([a-z0-9]+)", 1).alias("first_tag"), F.size(F.regexp_extract_all("text", F.lit("<(/?[a-z0-9]+)[^<>]*>"), F.lit(1))).cast("long").alias("n_tags"))


@query
def html_markdown(spark, folder):
    v = table(spark, folder, "content_variants").where("name = 'original' and text like '%<%'")
    return v.select("variant_id", html_to_markdown("text").alias("markdown"))


@query
def scalpel_items(spark, folder):
    c = refine.scalpel_language(refine.scalpel_genre_theme(Corpus.load(spark, folder)))
    return c.items.groupBy("doc_uuid").agg(F.count("*").alias("n_items"))


@query
def scalpel_variants(spark, folder):
    return refine.scalpel_grammar(Corpus.load(spark, folder)).variants.groupBy("name").agg(F.count("*").alias("n"))


@query
def purge_records(spark, folder):
    c = refine.purge_records(Corpus.load(spark, folder), start=LOW, stop=HIGH)
    return c.ledger.select("uuid").withColumn("part", F.lit("ledger")).unionAll(c.meta.select(F.col("doc_uuid"), F.lit("meta"))).groupBy("part").agg(F.count("*").alias("n"), F.count_distinct("uuid").alias("n_uuids"))


@query
def corrupt_records(spark, folder):
    return refine.corrupt_documents(Corpus.load(spark, folder))


@query
def package_lines(spark, folder):
    lines = package.documents_json(Corpus.load(spark, folder))
    return lines.select("doc_uuid", F.coalesce(F.json_array_length(F.get_json_object("line", "$.items")), F.lit(0)).cast("long").alias("n_items"), F.get_json_object("line", "$.meta.source.native_id").alias("native_id"), F.get_json_object("line", "$.items[0].id").alias("first_item"))


@query
def flavour_split(spark, folder):
    last = table(spark, folder, "safety_dials").groupBy("doc_uuid").agg(F.max_by(F.struct("sexual_axis", "toxicity_axis"), F.struct("responded_at", "response_id")).alias("x"))
    docs = table(spark, folder, "doc_meta").select("doc_uuid").join(last, "doc_uuid", "left")
    return docs.groupBy(package.flavour(F.col("x.sexual_axis"), F.col("x.toxicity_axis")).alias("flavour")).agg(F.count("*").alias("n"))


# --- themes ---


@query
def theme_sanitize(spark, folder):
    return _tags(spark, folder).select("response_id", "tag_no", sanitize_tag(F.col("tag")).alias("tag"))


@query
def theme_term_frequency(spark, folder):
    return resolve.term_frequency(_tags(spark, folder))


@query
def theme_crosstab(spark, folder):
    opinion = table(spark, folder, "safety_dials").groupBy("doc_uuid").agg(F.max_by(F.struct("sexual_axis", "violence_axis", "toxicity_axis"), F.struct("responded_at", "response_id")).alias("x"))
    t = _tags(spark, folder).withColumn("term", theme_term(F.col("tag"))).where("term <> ''").join(opinion, "doc_uuid", "left")
    t = t.select("term", F.coalesce("primary_genre", F.lit("Unset")).alias("genre"), F.coalesce("x.sexual_axis", F.lit("Clean")).alias("sexuality"), F.coalesce("x.violence_axis", F.lit("None")).alias("violence"), F.coalesce("x.toxicity_axis", F.lit("Safe")).alias("toxicity"))
    return resolve.crosstab(t, ["genre", "sexuality", "violence", "toxicity"])


def _genre_terms(spark, folder):
    t = _tags(spark, folder).select(F.coalesce("primary_genre", F.lit("Unset")).alias("cluster_id"), theme_term(F.col("tag")).alias("term")).where("term <> ''")
    return t.groupBy("cluster_id", "term").agg(F.count("*").alias("n"))


@query
def theme_cluster_rollup(spark, folder):
    r = resolve.roll_up(_genre_terms(spark, folder))
    return r.select("cluster_id", "label", F.col("n_terms"), "freq", F.array_join("top_terms", ", ").alias("top_terms"))


@query
def theme_summary_top3(spark, folder):
    return resolve.summary(_genre_terms(spark, folder), ["cluster_id"], "term")


@query
def theme_curation(spark, folder):
    themes = table(spark, folder, "theme_list")
    manifest = themes.select(F.col("theme_id").cast("string").alias("cluster_id"), F.col("theme").alias("label"), F.concat(F.array("theme"), "aliases").alias("members"))
    decisions = themes.select(F.col("theme_id").alias("row_no"), F.col("theme_id").cast("string").alias("cluster_id"), F.lit("").alias("human_label"), F.when(F.col("theme_id") % 10 == 0, F.lit("drop")).alias("action"))
    out = resolve.curate(_tags(spark, folder), resolve.curation_map(decisions, manifest))
    return out.select("doc_uuid", F.array_join("themes", ",").alias("themes"))


def _vectors(spark, folder):
    return table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))


@query
def embedding_pairs(spark, folder):
    return resolve.near_pairs(_vectors(spark, folder), PAIR_CUT).select("a", "b")


@query
def embedding_components(spark, folder):
    return connected_components(resolve.near_pairs(_vectors(spark, folder), PAIR_CUT), "a", "b")


@query
def theme_clusters(spark, folder):
    terms = resolve.term_frequency(_tags(spark, folder), least=3)
    return resolve.clusters(resolve.hashed_vectors(terms))


@query
def event_windows(spark, folder):
    return windowed_counts(table(spark, folder, "events"))


