"""The queries of the training-text operators: name -> callable(spark, folder)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm import canonical, frequency, language, leakage, mixing, neardup, safety, spans, splitting
from lectern.plans import table


def _segments(spark: SparkSession, folder: str) -> DataFrame:
    originals = table(spark, folder, "content_variants").where("name = 'original'")
    return language.language_segments(originals, table(spark, folder, "lang_samples"))


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return language.missing_labels(_segments(spark, folder), table(spark, folder, "doc_items"))


def p1_documents(spark: SparkSession, folder: str) -> DataFrame:
    return language.document_languages(_segments(spark, folder))


def p1_segments(spark: SparkSession, folder: str) -> DataFrame:
    return _segments(spark, folder)


CASE = 0.5


def _document_scores(spark: SparkSession, folder: str) -> DataFrame:
    texts = table(spark, folder, "content_variants")
    classifier = safety.train(table(spark, folder, "safety_samples"), table(spark, folder, "lang_samples"), table(spark, folder, "safety_dials"), texts)
    return safety.document_scores(safety.safety_scores(texts, classifier))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with a text that scores at least ``CASE`` on an axis."""
    axes = F.explode(F.array(*(F.struct(F.lit(a).alias("axis"), F.col(a).alias("score")) for a in safety.AXES)))
    return _document_scores(spark, folder).select("doc_uuid", axes.alias("x")).where(F.col("x.score") >= CASE).select("doc_uuid", "x.axis")


def p2_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of every document beside the opinions on it."""
    dial = table(spark, folder, "safety_dials").groupBy("doc_uuid").agg(*(F.max_by(safety.axis_value(F.col(f"{a}_axis")), F.struct("responded_at", "response_id")).alias(f"{a}_axis") for a in safety.AXES))
    return _document_scores(spark, folder).join(dial, "doc_uuid", "left")


def p2_rates(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with cases per source."""
    source = F.coalesce(F.nullif("source_identity", F.lit("")), F.lit("unknown")).alias("source")
    docs = table(spark, folder, "doc_meta").select("doc_uuid", source)
    per = docs.join(_document_scores(spark, folder), "doc_uuid").groupBy("source")
    return per.agg(F.count("*").alias("n_docs"), *(F.count_if(F.col(a) >= CASE).alias(f"n_{a}") for a in safety.AXES), *(F.avg((F.col(a) >= CASE).cast("double")).alias(f"rate_{a}") for a in safety.AXES))


def _edited_copies(spark: SparkSession, folder: str) -> neardup.NearDuplicates:
    originals = table(spark, folder, "content_variants").where("name = 'original'")
    return neardup.near_duplicates(originals, "variant_id", "text", threshold=0.5, n=3, min_words=40, strip_tags=True)


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.expanded_pairs(_edited_copies(spark, folder)).select(F.col("id_a").alias("variant_id_a"), F.col("id_b").alias("variant_id_b"))


def p3_groups(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.groups(_edited_copies(spark, folder)).withColumnRenamed("id", "variant_id")


def p4_tags(spark: SparkSession, folder: str) -> DataFrame:
    return canonical.map_tags(table(spark, folder, "genre_themes"), table(spark, folder, "theme_list"))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return p4_tags(spark, folder).select("response_id", "tag_no", "theme_id").distinct()


def p4_unmatched(spark: SparkSession, folder: str) -> DataFrame:
    """The values that mean no entry, with their uses."""
    return p4_tags(spark, folder).where("theme_id = -1").groupBy("tag").agg(F.count("*").alias("n_uses"))


def p5_pieces(spark: SparkSession, folder: str) -> DataFrame:
    texts = splitting.split_texts(table(spark, folder, "content_variants"), "variant_id", "text")
    return texts.unionByName(splitting.split_sequences(table(spark, folder, "doc_items").where("kind = 'sequence'"), "item_key", "item_ids"))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return p5_pieces(spark, folder).where("piece_no = 0").select("obj", "obj_key", "finest").distinct()


def p6_terms(spark: SparkSession, folder: str) -> DataFrame:
    return frequency.term_frequency(table(spark, folder, "genre_themes"), "doc_uuid", "themes")


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return p6_terms(spark, folder).where("mark is not null").select("term", "mark")


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return leakage.leaked_items(table(spark, folder, "documents"), table(spark, folder, "eval_items"))


def p7_edited(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold a whole item of 12 words or more with up to 2 words changed, put in or left out."""
    return leakage.leaked_items(table(spark, folder, "documents"), table(spark, folder, "eval_items"), window=None, max_edits=2, sampled=4)


def p7_items(spark: SparkSession, folder: str) -> DataFrame:
    """Per leaked item, the documents that hold part of it."""
    return p7_found(spark, folder).groupBy("item_id").agg(F.count("*").alias("n_docs"), F.min("doc_id").alias("first_doc"))


def _mix(spark: SparkSession, folder: str) -> mixing.Mix:
    return mixing.mix_sources(table(spark, folder, "documents"), table(spark, folder, "mix_targets"))


def p8_mix(spark: SparkSession, folder: str) -> DataFrame:
    return _mix(spark, folder).chosen


def p8_shares(spark: SparkSession, folder: str) -> DataFrame:
    return _mix(spark, folder).shares


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return spans.shared_records(table(spark, folder, "documents"))


def p9_kept(spark: SparkSession, folder: str) -> DataFrame:
    """The texts without the sentences that a span of an earlier document covers."""
    return spans.without_repeated_spans(table(spark, folder, "documents"))


def p9_shares(spark: SparkSession, folder: str) -> DataFrame:
    return spans.shared_shares(table(spark, folder, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k[:1] == "p" and k[1:2].isdigit()}
