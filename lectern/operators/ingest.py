"""Ingestion: conversations, forum threads and books to the canonical model; the identity ledger."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.functions.books import BLOCK, block_batches, content_batches, mark_batches, outline_batches, segment_batches
from lectern.functions.html import extract_posts
from lectern.functions.text import filled, joined_lines, strip, uuid7
from lectern.model import Corpus
from lectern.plans import cut_lineage, join_checked
from lectern.plans.ordering import numbered


def conversation_address(record: Column) -> Column:
    """SHA-256 of a JSON record with sorted keys, compact, nulls kept: equal records have equal addresses.

    Null for what isn't JSON as a whole, such as a line with more behind the record.
    """
    return _canonical(record)


@F.pandas_udf(T.StringType())
def _canonical(records: pd.Series) -> pd.Series:
    import hashlib
    import json

    def one(r: str | None) -> str | None:
        try:
            read = json.loads(r) if r is not None else None
        except ValueError:
            read = None
        if read is None:
            return None
        return hashlib.sha256(json.dumps(read, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode("utf-8", "surrogatepass")).hexdigest()

    return records.map(one)


def item_id(kind: str, n: Column) -> Column:
    """``kind-000001`` and so on."""
    return F.format_string(f"{kind}-%06d", n.cast("int"))


def next_number(item_ids: Column, kind: str) -> Column:
    """One more than the greatest number of ids of a kind, 1 if there's none."""
    return F.coalesce(F.max(F.regexp_extract(item_ids, rf"^{kind}-(\d+)$", 1).try_cast("int")), F.lit(0)) + 1


def default_identities(bot_id: Column, bot_name: Column) -> Column:
    """The player and the bot of a conversation, with neutral pronouns."""
    they = F.struct(F.lit("they").alias("subjective"), F.lit("them").alias("objective"), F.lit("their").alias("possessive"))
    one = lambda entity, name, player: F.struct(entity.alias("entity_id"), name.alias("name"), F.lit("unknown").alias("gender"), they.alias("pronouns"), F.lit(player).alias("is_player_controlled"))
    return F.array(one(F.lit("user"), F.lit("User"), True), one(bot_id, F.coalesce(filled(bot_name), F.lit("the character")), False))


def register(records: DataFrame, ledger: DataFrame, recorded_at: Column) -> DataFrame:
    """Each distinct (source, native_id) with its uuid: the ledger's latest, or a new one; ``is_new`` tells.

    Keys are distinct before the join, so repeats cost nothing and a key gets one uuid. New uuids follow from
    time and key, so a task that runs again mints the same.
    """
    known = ledger.groupBy("source", "native_id").agg(F.max_by("uuid", F.struct("recorded_at", "uuid")).alias("uuid"))
    keys = records.select("source", "native_id").where("source is not null and native_id is not null").distinct()
    out = keys.join(known, ["source", "native_id"], "left").withColumn("is_new", F.col("uuid").isNull())
    return out.withColumn("uuid", F.coalesce("uuid", uuid7(recorded_at, F.col("source"), F.col("native_id"))))


def _empty_items(doc: Column, **values: Column) -> list[Column]:
    kinds = {"item_pos": "int", "item_id": "string", "kind": "string", "entity_id": "string", "actor_id": "string", "category": "string", "value": "array<string>", "value_is_list": "boolean", "reasoning": "string", "item_ids": "array<string>", "data": "string"}
    return [doc.alias("doc_uuid"), *(values.get(k, F.lit(None)).cast(t).alias(k) for k, t in kinds.items())]


def _variants(doc: str, item: str, text: Column, annotation: Column | None = None, author: Column | None = None, post: Column | None = None, at: Column | None = None) -> list[Column]:
    null = F.lit(None).cast("string")
    return [F.col(doc).alias("doc_uuid"), F.col(item).alias("item_id"), F.lit("original").alias("name"), text.alias("text")] + [(c if c is not None else null).alias(n) for c, n in ((annotation, "annotation"), (author, "author_id"), (post, "post_id"), (at, "posted_at"))]


def conversations(records: DataFrame, ledger: DataFrame, recorded_at: Column, source: str = "emberlamp/chatlogs", limit: int | None = None, existing: DataFrame | None = None) -> Corpus:
    """Documents of the conversation records that the ledger doesn't know.

    With ``existing`` (doc_uuid), documents that the ledger knows but that aren't there are built again under their uuid.

    ``records`` has ``raw`` (JSON text) and ``line_no``. Records that aren't JSON, lack a bot id or a time are left
    out; ``limit`` counts lines. Equal records (whatever their key order) become one document.
    """
    if limit is not None:
        records = records.where(F.col("line_no") < limit)
    fields = "bot_id string, bot_name string, bot_description string, submission_timestamp string, conversation array<struct<message:string,is_human:boolean>>"
    r = records.where(F.try_parse_json("raw").isNotNull()).select("raw", F.from_json("raw", fields).alias("r"), "line_no").where("r.bot_id <> '' and r.submission_timestamp is not null")
    r = r.withColumn("native_id", conversation_address(F.col("raw"))).withColumn("source", F.lit(source)).where("native_id is not null")
    r = r.groupBy("source", "native_id").agg(F.min_by(F.struct("r", "raw"), "line_no").alias("x")).select("source", "native_id", "x.r.*", "x.raw")
    known = register(r, ledger, recorded_at)
    if existing is not None:
        there = existing.select(F.col("doc_uuid").alias("uuid"), F.lit(True).alias("there")).distinct()
        known = known.join(there, "uuid", "left").where(F.col("is_new") | F.col("there").isNull())
    else:
        known = known.where("is_new")
    new = r.join(known.select("source", "native_id", "uuid", "is_new"), ["source", "native_id"]).withColumnRenamed("uuid", "doc")
    turns = new.select("doc", "bot_id", F.posexplode("conversation").alias("i", "t")).withColumn("item_id", item_id("turn", F.col("i") + 1))
    actor = F.when(F.col("t.is_human"), F.lit("user")).otherwise(F.col("bot_id"))
    shown = new.where(strip(F.coalesce("bot_description", F.lit(""))) != "").withColumn("item_id", F.lit("character-000001"))
    told = new.where(F.size("conversation") > 0).withColumn("ids", F.transform(F.sequence(F.lit(1), F.size("conversation")), lambda i: F.format_string("turn-%06d", i)))
    items = (
        shown.select(*_empty_items(F.col("doc"), item_pos=F.lit(0), item_id=F.col("item_id"), kind=F.lit("character"), entity_id=F.col("bot_id")))
        .unionByName(turns.select(*_empty_items(F.col("doc"), item_pos=F.col("i") + 1, item_id=F.col("item_id"), kind=F.lit("turn"), actor_id=actor)))
        .unionByName(told.select(*_empty_items(F.col("doc"), item_pos=F.size("conversation") + 1, item_id=F.lit("sequence-000001"), kind=F.lit("sequence"), item_ids=F.col("ids"), data=F.lit('{"sequence_for":"conversation"}'))))
    )
    texts = shown.select(*_variants("doc", "item_id", strip(F.col("bot_description")))).unionByName(turns.select(*_variants("doc", "item_id", strip(F.coalesce("t.message", F.lit(""))))))
    note = F.array(F.struct(F.lit("ingest").alias("kind"), F.lit("conversation ingested").alias("content"), F.lit(None).cast("string").alias("reasoning")))
    meta = new.select(F.col("doc").alias("doc_uuid"), F.lit("document").alias("kind"), F.col("source").alias("source_identity"), "native_id", default_identities(F.col("bot_id"), F.col("bot_name")).alias("identities"), note.alias("annotations"))
    added = new.where("is_new").select("source", "native_id", F.col("doc").alias("uuid"), F.lit(None).cast("string").alias("meta"), recorded_at.alias("recorded_at"))
    return Corpus(meta, items, texts, added)


def conversation_rejects(records: DataFrame) -> DataFrame:
    """``line_no, reason`` of the records that :func:`conversations` leaves out."""
    r = records.select("line_no", F.when(conversation_address(F.col("raw")).isNotNull(), F.try_parse_json("raw")).alias("v"))
    bot, at = (F.try_variant_get("v", f"$.{k}", "string") for k in ("bot_id", "submission_timestamp"))
    reason = F.when(F.col("v").isNull(), "not JSON").when(F.coalesce(bot, F.lit("")) == "", "no bot").when(at.isNull(), "no time")
    return r.select("line_no", reason.alias("reason")).where("reason is not null")


def page_posts(pages: DataFrame) -> DataFrame:
    """The posts of forum pages (``section_url, contents``), one row each; pages without a post give none."""
    return pages.where("contents <> ''").select("section_url", F.explode(extract_posts("contents")).alias("p")).select("section_url", "p.*")


def canonical_url(thread_id: Column, slug: Column) -> Column:
    return F.concat(F.lit("/index.php?threads/"), slug, F.lit("."), thread_id, F.lit("/"))


def merge_latest(existing: DataFrame, incoming: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Union where, per key, the row with the greatest ``order`` wins; incoming wins ties. Both have the same columns."""
    rest = [c for c in existing.columns if c not in keys]
    both = existing.withColumn("__new", F.lit(0)).unionByName(incoming.withColumn("__new", F.lit(1)))
    best = both.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order, "__new")).alias("r"))
    return best.select(*keys, "r.*")


def reconcile(existing: DataFrame, incoming: DataFrame, key: str, values: list[str]) -> DataFrame:
    """Upsert with what happened: ``<key>, values..., change`` in kept, same, updated, inserted. Incoming wins any difference."""
    a, b = existing.select(key, *(F.col(v).alias(f"old_{v}") for v in values), F.lit(1).alias("a")), incoming.select(key, *values, F.lit(1).alias("b"))
    same = F.lit(True)
    for v in values:
        same = same & F.col(v).eqNullSafe(F.col(f"old_{v}"))
    change = F.when(F.col("b").isNull(), "kept").when(F.col("a").isNull(), "inserted").when(same, "same").otherwise("updated")
    return a.join(b, key, "full_outer").select(key, *(F.when(F.col("b").isNull(), F.col(f"old_{v}")).otherwise(F.col(v)).alias(v) for v in values), change.alias("change"))


def thread_sequences(posts: DataFrame, thread: str = "thread_id", item: str = "item_id", at: str = "posted_at", post: str = "post_id", parse: bool = False) -> DataFrame:
    """``thread, item_ids`` in the order of time, then number of the post. Times compare as strings unless ``parse``."""
    when = F.coalesce(F.try_to_timestamp(at), F.lit("1970-01-01").cast("timestamp")) if parse else F.coalesce(F.col(at), F.lit(""))
    number = F.coalesce(F.col(post).try_cast("long"), F.lit(0))
    rows = F.collect_list(F.struct(when.alias("at"), number.alias("n"), F.col(item).alias("id")))
    return posts.groupBy(thread).agg(F.transform(F.array_sort(rows), lambda r: r["id"]).alias("item_ids"))


def threads(pages: DataFrame, corpus: Corpus, recorded_at: Column, source: str = "hollowquill/forum-raw") -> Corpus:
    """Forum pages merged into the corpus: posts of known threads updated, new ones numbered on, sequences rebuilt."""
    posts = page_posts(pages).groupBy("thread_id", "post_id").agg(F.max_by(F.struct("section_url", "post_index", "author_id", "timestamp", "text", "thread_slug"), F.struct("section_url", "post_index")).alias("p")).select("thread_id", "post_id", "p.*")
    posts = posts.withColumns({"source": F.lit(source), "native_id": F.concat(F.lit("thread:"), "thread_id")})
    posts = cut_lineage(posts)  # pages are parsed once
    known = cut_lineage(register(posts, corpus.ledger, recorded_at))
    posts = posts.join(known, ["source", "native_id"]).withColumnRenamed("uuid", "doc_uuid")
    held = corpus.variants.where("name = 'original' and post_id is not null").groupBy("doc_uuid", "post_id").agg(F.min("item_id").alias("item_id"))
    last = corpus.items.where("kind = 'narrative'").groupBy("doc_uuid").agg((next_number(F.col("item_id"), "narrative") - 1).alias("last"))
    posts = posts.join(held, ["doc_uuid", "post_id"], "left").join(last, "doc_uuid", "left")
    fresh = numbered(posts.where("item_id is null").drop("item_id").withColumn("__no", F.col("post_id").try_cast("long")), "doc_uuid", "timestamp", "__no", "post_id").drop("__no")
    fresh = fresh.withColumn("item_id", item_id("narrative", F.coalesce("last", F.lit(0)) + F.col("n"))).drop("n")
    posts = cut_lineage(posts.where("item_id is not null").unionByName(fresh))
    new_items = posts.join(corpus.items, ["doc_uuid", "item_id"], "left_anti").select(*_empty_items(F.col("doc_uuid"), item_pos=F.regexp_extract("item_id", r"(\d+)$", 1).cast("int"), item_id=F.col("item_id"), kind=F.lit("narrative")))
    texts = posts.select(*_variants("doc_uuid", "item_id", F.col("text"), None, F.col("author_id"), F.col("post_id"), F.col("timestamp")))
    columns = texts.columns
    old = corpus.variants.select(*columns)
    merged = old.join(texts.select("doc_uuid", "item_id", "name"), ["doc_uuid", "item_id", "name"], "left_anti").unionByName(texts)
    seq = thread_sequences(merged.where("post_id is not null").join(posts.select("doc_uuid").distinct(), "doc_uuid", "left_semi"), "doc_uuid")
    seq = seq.select(*_empty_items(F.col("doc_uuid"), item_pos=F.lit(1 << 30), item_id=F.lit("seq-thread-000001"), kind=F.lit("sequence"), item_ids=F.col("item_ids"), data=F.lit('{"sequence_for":"thread"}')))
    shape = seq.columns
    items = corpus.items.select(*shape).join(seq.select("doc_uuid", "item_id"), ["doc_uuid", "item_id"], "left_anti").unionByName(new_items).unionByName(seq)
    there = corpus.meta.select(F.col("doc_uuid").alias("uuid"), F.lit(True).alias("there")).distinct()
    made = known.join(there, "uuid", "left").where("there is null")  # new, or known to the ledger only
    added = made.where("is_new").select("source", "native_id", "uuid", F.lit(None).cast("string").alias("meta"), recorded_at.alias("recorded_at"))
    meta = made.select(F.col("uuid").alias("doc_uuid"), F.lit("document").alias("kind"), F.col("source").alias("source_identity"), "native_id")
    full = corpus.complete().meta
    return Corpus(full.unionByName(meta, allowMissingColumns=True), items, merged, corpus.ledger.select(*added.columns).unionByName(added))


_PLACE, _PARAGRAPHS = ["f", "s", "b"], "ps array<struct<raw: string, mark: string, note: string>>"


def _book_lines(books: DataFrame, key: str, text: str) -> DataFrame:
    """``__key, f, s, text``: texts, or the lines of splits of files, with a place for both."""
    place = [F.col(k) if k in books.columns else F.lit(d).alias(k) for k, d in (("f", ""), ("s", 0))]
    return books.where(F.length(text) >= (0 if "f" in books.columns else 1)).select(F.col(key).alias("__key"), *(c.cast(t).alias(k) for c, t, k in zip(place, ("string", "long"), "fs")), F.col(text).alias("text"))


def _book_outline(lines: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """The segments of blocks with their numbers of paragraphs; and, as ``__key, f, s, b, text``, the blocks that are needed whole.

    Splits of a file are cut where they are; only what stands at their borders, up to a block each, is brought together,
    and blocks with a marker are kept. All others are read again where their paragraphs are asked for.
    """
    kind = lines.schema["__key"].dataType.simpleString()
    seen = cut_lineage(lines.mapInArrow(lambda it: outline_batches(it, size), f"__key {kind}, f string, s long, b int, seg int, title string, opens boolean, foreword boolean, n int, border boolean, text string"))
    upto = Window.partitionBy("__key").orderBy(*_PLACE)
    joined = seen.where("border").withColumn("group", F.sum(F.when(F.col("b") > 0, 1).otherwise(0)).over(upto)).groupBy("__key", "group").agg(F.array_sort(F.collect_list(F.struct(*_PLACE, "text"))).alias("x"))
    joined = joined.select("__key", *(F.col("x")[0][k].alias(k) for k in _PLACE), F.array_join(F.col("x.text"), "").alias("text"))
    whole = seen.where("not border and text is not null").select("__key", *_PLACE, "text").unionByName(joined)
    return seen.where("seg is not null").drop("border", "text"), cut_lineage(whole)


def _book_blocks(books: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """``__key, f, s, b, text``: the texts in blocks of about ``size`` characters, in the order of the other columns."""
    lines = _book_lines(books, key, text)
    kind = lines.schema["__key"].dataType.simpleString()
    inner = lines.mapInArrow(lambda it: block_batches(it, size), f"__key {kind}, f string, s long, b int, text string")
    return inner.unionByName(_book_outline(lines, size)[1])


class _Book:
    """``parts``: ``k, f_, s_, b_, seg_, section_no, title_, before, n``, the segments that hold paragraphs, and how many of the book stand before them."""

    def __init__(self, books: DataFrame, key: str, text: str, size: int) -> None:
        self.key, self.size, self.lines = key, size, _book_lines(books, key, text)
        self.kind = kind = books.schema[key].dataType.simpleString()
        plain, whole = _book_outline(self.lines, size)
        at = F.struct(*_PLACE)
        found = whole.mapInArrow(mark_batches, f"__key {kind}, f string, s long, b int, begin int, end int")
        marks = cut_lineage(found.groupBy("__key").agg(*(F.min(F.when(F.col(k).isNotNull(), F.struct(at.alias("at"), k))).alias(k) for k in ("begin", "end"))))
        if not marks.where("begin is null or end is null").isEmpty():
            raise ValueError("no boundary markers in the book")
        m = marks.select(F.col("__key").alias("k"), F.col("begin").alias("m"), F.col("end").alias("n_"))
        within = lambda df: join_checked(df, m, F.col("__key").eqNullSafe(F.col("k")), row_bytes=400).where(at.between(F.col("m.at"), F.col("n_.at")))
        inner = within(whole).select("__key", *_PLACE, "text", F.when(at == F.col("m.at"), F.col("m.begin")).alias("begin"), F.when(at == F.col("n_.at"), F.col("n_.end")).alias("end"))
        self.whole = inner.mapInArrow(segment_batches, f"__key {kind}, f string, s long, b int, seg int, title string, opens boolean, foreword boolean, {_PARAGRAPHS}")
        segs = cut_lineage(within(plain).drop("k", "m", "n_").unionByName(self.whole.withColumn("n", F.size("ps")).drop("ps")))
        if not m.join(segs.where("seg > 0").select("__key").distinct(), F.col("__key").eqNullSafe(F.col("k")), "left_anti").isEmpty():
            raise ValueError("no section header in the book")
        order = Window.partitionBy("__key").orderBy(*_PLACE, "seg")
        heads = segs.where("seg > 0").withColumns({"no": F.row_number().over(order), "after": F.coalesce(F.lag("foreword").over(order), F.lit(False)).cast("int")})
        # contents list every header once before the text does: the last first chapter counts, and a foreword right before it
        first = heads.groupBy(F.col("__key").alias("k")).agg(F.coalesce(F.max(F.when(F.col("opens"), F.col("no") - F.col("after"))), F.lit(1)).alias("first"))
        upto = order.rowsBetween(Window.unboundedPreceding, 0)
        segs = segs.withColumns({"no": F.sum((F.col("seg") > 0).cast("int")).over(upto), "title": F.last("title", True).over(upto)})
        segs = segs.join(first, F.col("__key").eqNullSafe(F.col("k"))).drop("k").where("no >= first")
        segs = segs.withColumns({"section_no": (F.col("no") - F.col("first") + 1).cast("int"), "before": (F.sum("n").over(upto) - F.col("n")).cast("int")})
        self.parts = cut_lineage(segs.where("n > 0").select(F.col("__key").alias("k"), *(F.col(k).alias(f"{k}_") for k in (*_PLACE, "seg")), "section_no", F.col("title").alias("title_"), "before", "n"))

    def paragraphs(self) -> DataFrame:
        size, place = self.size, ["__key", *_PLACE, "seg"]
        plain = self.lines.mapInArrow(lambda it: content_batches(it, size), f"__key {self.kind}, f string, s long, b int, seg int, {_PARAGRAPHS}")
        same = F.col("__key").eqNullSafe(F.col("k")) & (F.col("f") == F.col("f_")) & (F.col("s") == F.col("s_")) & (F.col("b") == F.col("b_")) & (F.col("seg") == F.col("seg_"))
        p = join_checked(plain.unionByName(self.whole.select(*place, "ps")), self.parts, same, row_bytes=250)
        p = p.select(F.col("__key").alias(self.key), "section_no", F.col("title_").alias("title"), "before", F.posexplode("ps").alias("i", "p")).withColumn("paragraph_no", (F.col("before") + F.col("i") + 1).cast("int"))
        annotation = F.when(F.col("p.mark").isNotNull(), F.concat("p.mark", F.lit(" "), joined_lines(F.col("p.note"))))
        return p.select(self.key, "section_no", "title", "paragraph_no", item_id("narrative", F.col("paragraph_no")).alias("item_id"), joined_lines(F.col("p.raw")).alias("text"), annotation.alias("annotation"))


def book_paragraphs(books: DataFrame, key: str = "native_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """``<key>, section_no, title, paragraph_no, item_id, text, annotation`` of books.

    A row holds a whole text, or, where there are columns ``f`` and ``s`` (file and place in it), a line of a split as
    :func:`lectern.sources.readers.book_lines` reads it. Sections are the foreword and the chapters between the START and
    END markers; the table of contents is skipped. Illustration notes are left out; a footnote becomes the annotation of the
    paragraph before it in its section (the last one, if there are several), and is dropped where there is none.

    Texts are worked on in blocks of about ``block`` characters, so no task holds a book; only headers and counts of
    paragraphs per block are numbered by book.
    """
    return _Book(books, key, text, block).paragraphs()


def book_sequences(rows: DataFrame, key: str = "native_id") -> DataFrame:
    """``<key>, item_id, title, item_ids``: one sequence per section and one over the whole book."""
    per = rows.groupBy(key, "section_no", "title").agg(F.array_sort(F.collect_list(F.struct("paragraph_no", "item_id"))).alias("r"))
    one = per.select(key, item_id("seq-chapter", F.col("section_no")).alias("item_id"), "title", F.transform("r", lambda x: x["item_id"]).alias("item_ids"))
    whole = rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("paragraph_no", "item_id"))).alias("r")).select(key, F.lit("seq-book-000001").alias("item_id"), F.lit(None).cast("string").alias("title"), F.transform("r", lambda x: x["item_id"]).alias("item_ids"))
    return one.unionByName(whole)


def books(texts: DataFrame, ledger: DataFrame, recorded_at: Column, source: str = "quillhouse/books") -> Corpus:
    """Books (native_id, text) as documents: a narrative for each paragraph, a sequence for each section and one for the book.

    Books that the ledger knows keep their uuid; new ones are added to it.
    """
    named = texts.withColumn("source", F.lit(source))
    known = cut_lineage(register(named, ledger, recorded_at))
    book, uuids = _Book(texts, "native_id", "text", BLOCK), known.select("native_id", F.col("uuid").alias("doc"))
    full = book.paragraphs().join(uuids, "native_id")
    # paragraphs of a book are numbered without a gap, so a section is a range of numbers, and ids are listed last
    parts = cut_lineage(book.parts.withColumnRenamed("k", "native_id").join(uuids, "native_id").select("doc", "section_no", F.col("title_").alias("title"), (F.col("before") + 1).alias("first"), (F.col("before") + F.col("n")).alias("last")))
    spread = parts.repartition(max(1, int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "doc", "first")
    number = spread.select("doc", F.explode(F.sequence("first", "last")).alias("no"))
    span = (F.min("first").alias("first"), F.max("last").alias("last"))
    seq = parts.groupBy("doc", "section_no", "title").agg(*span).select("doc", item_id("seq-chapter", F.col("section_no")).alias("item_id"), "title", "first", "last")
    seq = seq.unionByName(parts.groupBy("doc").agg(*span).select("doc", F.lit("seq-book-000001").alias("item_id"), F.lit(None).cast("string").alias("title"), "first", "last"))
    by_doc = Window.partitionBy("doc")
    seq = cut_lineage(seq.withColumn("item_pos", F.max("last").over(by_doc) + F.row_number().over(by_doc.orderBy("item_id"))))
    purpose = F.to_json(F.struct(F.when(F.col("title").isNull(), "book").otherwise("chapter").alias("sequence_for"), "title"))
    ids = F.transform(F.sequence("first", "last"), lambda n: item_id("narrative", n))
    items = number.select(*_empty_items(F.col("doc"), item_pos=F.col("no") - 1, item_id=item_id("narrative", F.col("no")), kind=F.lit("narrative")))
    items = items.unionByName(seq.select(*_empty_items(F.col("doc"), item_pos=F.col("item_pos") - 1, item_id=F.col("item_id"), kind=F.lit("sequence"), item_ids=ids, data=purpose)))
    variants = full.select(*_variants("doc", "item_id", F.col("text"), F.col("annotation")))
    note = F.array(F.struct(F.lit("ingest").alias("kind"), F.lit("book ingested").alias("content"), F.lit(None).cast("string").alias("reasoning")))
    meta = known.select(F.col("uuid").alias("doc_uuid"), F.lit("document").alias("kind"), F.col("source").alias("source_identity"), "native_id", note.alias("annotations"))
    added = known.where("is_new").select("source", "native_id", "uuid", F.lit(None).cast("string").alias("meta"), recorded_at.alias("recorded_at"))
    return Corpus(meta, items, variants, added).complete()
