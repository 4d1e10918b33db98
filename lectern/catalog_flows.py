"""Queries that go through ingestion, refinement, files and steps, on inputs built from the driver's tables."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern import config, inference
from lectern.functions.text import normal_gender, stamp, thread_identity
from lectern.model import GENRES, SEXUAL, TOXICITY, VIOLENCE, Corpus
from lectern.operators import enrich, ingest, meta, package, refine, report, resolve, select
from lectern.plans import checkpoint_dir, counted, cut_lineage, table
from lectern.plans.ordering import positions
from lectern.sources import readers, writers
from lectern.streaming import merge

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
AT = "2025-01-01 00:00:00"


def query(f: Query) -> Query:
    _QUERIES[f.__name__] = f
    return f


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _place(spark: SparkSession, name: str) -> str:
    """A new place in the folder that all executors share."""
    return f"{checkpoint_dir(spark)}/written/{uuid.uuid4().hex}/{name}"


def _empty(spark: SparkSession) -> Corpus:
    items = "doc_uuid string, item_pos int, item_id string, kind string, entity_id string, actor_id string, category string, value array<string>, value_is_list boolean, reasoning string, item_ids array<string>, data string"
    kinds = ("doc_uuid string, kind string, source_identity string, native_id string", items, "doc_uuid string, item_id string, name string, text string, annotation string, author_id string, post_id string, posted_at string", "source string, native_id string, uuid string, meta string, recorded_at timestamp")
    return Corpus(*(spark.createDataFrame([], k) for k in kinds)).complete()


# --- forum pages ---


def _pages(spark: SparkSession, folder: str) -> DataFrame:
    """A page for each delivery of a post, read back from two files; another thread's post is quoted in every body."""
    v = table(spark, folder, "content_variants").where("name = 'original' and post_id is not null and doc_uuid is not null")
    thread = v.groupBy("doc_uuid").agg(F.min("variant_id").alias("thread"))
    safe = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    at = F.format_string("/index.php?threads/a%%20b-%s.%d/", F.substring("doc_uuid", 1, 8), F.col("thread"))
    page = F.concat(
        F.lit('<html><title>t</title><body><article class="message message--post" data-content="'), "post_id", F.lit('">'),
        F.coalesce(F.concat(F.lit('<a class="username" data-user-id="'), "author_id", F.lit('">who</a>')), F.lit("")),
        F.lit('<a href="'), at, "post_id", F.lit('"><time datetime="'), F.coalesce("posted_at", F.lit("")), F.lit('">then</time></a><div class="message-userContent"><div class="bbWrapper">'),
        safe(F.coalesce("text", F.lit(""))), F.lit('</div><a class="username" data-user-id="0" href="/index.php?threads/other.7/post-1">quoted</a></div></article></body></html>'),
    )
    made = v.join(thread, "doc_uuid").select(F.concat(at, F.lit("page-"), F.lpad(F.col("variant_id").cast("string"), 12, "0")).alias("section_url"), page.alias("contents"))
    path = _place(spark, "pages")
    made.repartition(2, "section_url").write.parquet(path)
    return readers.forum_pages(spark, path)


@query
def forum_posts(spark, folder):
    p = ingest.page_posts(_pages(spark, folder))
    return p.select("section_url", "post_index", "post_id", "post_url", "thread_id", "thread_slug", "thread_url", "author_id", "timestamp", F.md5("text").alias("text_md5"))


@query
def forum_threads(spark, folder):
    c = ingest.threads(_pages(spark, folder), _empty(spark), F.lit(AT).cast("timestamp"))
    at = c.meta.select("doc_uuid", "native_id")
    return c.variants.join(at, "doc_uuid").select("native_id", "item_id", "post_id", "author_id", "posted_at", F.md5("text").alias("text_md5"))


@query
def forum_sequences(spark, folder):
    c = ingest.threads(_pages(spark, folder), _empty(spark), F.lit(AT).cast("timestamp"))
    seq = c.items.where("kind = 'sequence'").select("doc_uuid", F.size("item_ids").cast("long").alias("n_ids"), F.array_join("item_ids", ",").alias("ids"))
    return seq.join(c.meta.select("doc_uuid", "native_id"), "doc_uuid").join(c.ledger.select(F.col("uuid").alias("doc_uuid"), F.lit(True).alias("in_ledger")), "doc_uuid", "left").drop("doc_uuid")


# --- conversations ---


def _records(spark: SparkSession, folder: str) -> DataFrame:
    """A line for each chat document in the order of ids; some lack a time, some aren't JSON."""
    docs = table(spark, folder, "doc_meta").where("source_identity = 'emberlamp/chatlogs'").select("doc_uuid", "is_healthy", "native_id")
    turns = table(spark, folder, "doc_items").where("kind = 'turn'").select("doc_uuid", "item_pos", "item_id", F.struct(F.concat(F.lit(" "), "item_id", F.lit(" ")).alias("message"), (F.col("actor_id") == "user").alias("is_human")).alias("t"))
    said = turns.groupBy("doc_uuid").agg(F.transform(F.array_sort(F.collect_list(F.struct("item_pos", "item_id", "t"))), lambda x: x["t"]).alias("conversation"))
    told = F.when(F.col("native_id").isNotNull(), F.concat(F.lit("about "), "native_id"))
    raw = F.to_json(F.struct(F.col("doc_uuid").alias("bot_id"), F.lit("").alias("bot_name"), told.alias("bot_description"), F.when(F.col("is_healthy").isNotNull(), F.lit(AT)).alias("submission_timestamp"), F.coalesce("conversation", F.array()).alias("conversation")))
    lines = positions(docs.join(said, "doc_uuid", "left"), "doc_uuid").select("pos", F.when(F.col("pos") % 9 == 4, F.concat(raw, F.lit("}"))).otherwise(raw).alias("line"))
    path = _place(spark, "records")
    lines.coalesce(1).sortWithinPartitions("pos").select("line").write.text(path)
    return readers.json_lines(spark, path)


def _conversations(spark: SparkSession, folder: str) -> tuple[DataFrame, Corpus, Corpus]:
    """The records, the corpus of the first 40 lines, and that of the rest that its ledger doesn't know."""
    records, at = cut_lineage(_records(spark, folder)), F.lit(AT).cast("timestamp")
    first = ingest.conversations(records, _empty(spark).ledger, at, limit=40)
    return records, first, ingest.conversations(records, first.ledger, at)


def _bot(c: Corpus) -> DataFrame:
    return c.meta.select("doc_uuid", F.get("identities", F.lit(1))["entity_id"].alias("bot_id"), F.get("identities", F.lit(1))["name"].alias("bot_name"), F.get("identities", F.lit(0))["pronouns"]["subjective"].alias("pronoun"))


@query
def conversation_documents(spark, folder):
    _, first, rest = _conversations(spark, folder)
    out = None
    for run, c in ((1, first), (2, rest)):
        n = c.items.groupBy("doc_uuid").agg(F.count("*").alias("n_items"), F.count_if(F.col("kind") == "turn").alias("n_turns"), F.max(F.size("item_ids")).cast("long").alias("n_sequence"), F.count_if(F.col("actor_id") == "user").alias("n_human"))
        texts = c.variants.groupBy("doc_uuid").agg(F.md5(F.min(F.struct("item_id", "text"))["text"]).alias("first_md5"))
        one = _bot(c).join(n, "doc_uuid", "left").join(texts, "doc_uuid", "left").drop("doc_uuid").withColumn("run", F.lit(run))
        out = one if out is None else out.unionByName(one)
    return out.fillna(0)


@query
def conversation_rejects(spark, folder):
    return ingest.conversation_rejects(_records(spark, folder)).groupBy("reason").agg(F.count("*").alias("n"))


@query
def conversation_rebuilt(spark, folder):
    """Documents that the ledger knows and the corpus lost come back under their ids, and nothing else."""
    records, first, rest = _conversations(spark, folder)
    whole = first.joined(rest)
    kept = whole.meta.where(F.col("native_id") < "8")
    again = ingest.conversations(records, whole.ledger, F.lit("2026-01-01").cast("timestamp"), existing=kept)
    old = _bot(whole).select("bot_id", F.col("doc_uuid").alias("old"))
    return _bot(again).join(old, "bot_id").groupBy((F.col("doc_uuid") == F.col("old")).alias("same_id")).agg((F.count("*") + kept.count()).alias("n_documents"), F.lit(again.ledger.count()).cast("long").alias("n_new_entries"))


@query
def record_addresses(spark, folder):
    """Records that differ in the order of keys and in blanks have one address."""
    d = table(spark, folder, "documents").select("doc_id", F.coalesce("n_chars", F.lit(0)).alias("n"))
    one = F.format_string('{"b": %d, "a": {"y": null, "x": [%d, true]}}', F.col("doc_id"), F.col("n"))
    two = F.format_string('{"a":{"x":[%d,true],"y":null},"b":%d}', F.col("n"), F.col("doc_id"))
    return d.select("doc_id", ingest.conversation_address(one).alias("address"), (ingest.conversation_address(one) == ingest.conversation_address(two)).alias("same"))


@query
def minted_ids(spark, folder):
    records = table(spark, folder, "documents").select(F.coalesce("source", F.lit("none")).alias("source"), F.col("doc_id").cast("string").alias("native_id"))
    known = _empty(spark).ledger
    out = ingest.register(records, known, F.lit(AT).cast("timestamp"))
    return out.select("native_id", F.substring("uuid", 1, 15).alias("head"), F.col("uuid").rlike("^[0-9a-f]{8}-[0-9a-f]{4}-7[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$").alias("well_formed"), "is_new")


@query
def thread_identities(spark, folder):
    url = F.concat(F.lit("https://x.test/index.php?threads/"), F.col("doc_id").cast("string"), F.lit("-caf%C3%A9%20"), F.coalesce("lang", F.lit("")), F.lit("."), F.col("n_chars").cast("string"), F.lit("/post-1"))
    thread, slug = thread_identity(F.when(F.col("doc_id") % 10 == 0, F.lit("/other")).otherwise(url))
    return table(spark, folder, "documents").select("doc_id", thread.alias("thread"), F.coalesce(slug, F.lit("")).alias("slug"))


# --- books ---


def _books(spark: SparkSession, folder: str) -> DataFrame:
    """A book of each source: 20 chapters and a foreword of its documents' texts, with notes and pictures, in text files that follow one another."""
    d = table(spark, folder, "documents").where("text is not null and source is not null").select(F.regexp_replace(F.lower("source"), r"[^a-z0-9]+", "").alias("native_id"), "doc_id", "text").where("native_id <> ''")
    d = d.withColumn("chapter", (F.col("doc_id") % 21).cast("int"))
    body = F.concat("text", F.lit("\n\n[Illustration: a picture]\n\nNumber "), F.col("doc_id").cast("string"), F.lit(" ends.\n\n[1] a note\non it\n"))
    roman = F.element_at(F.array(*map(F.lit, "I II III IV V VI VII VIII IX X XI XII XIII XIV XV XVI XVII XVIII XIX XX".split())), F.greatest("chapter", F.lit(1)))
    head = F.when(F.col("chapter") == 0, F.lit("\nFOREWORD\n")).otherwise(F.concat(F.lit("\nCHAPTER "), roman, F.lit("\nThe part "), F.col("chapter").cast("string"), F.lit("\n")))
    chapters = cut_lineage(d.select("native_id", "chapter").distinct())
    ends = chapters.select("native_id").distinct().select("native_id", F.explode(F.array(F.struct(F.lit(-1).alias("chapter"), F.lit("About it\n*** START OF THE BOOK ***\n").alias("value")), F.struct(F.lit(99).alias("chapter"), F.lit("*** END OF THE BOOK ***").alias("value")))).alias("x"))
    lines = d.select("native_id", "chapter", F.lit(1).alias("part"), "doc_id", body.alias("value"))
    lines = lines.unionByName(chapters.select("native_id", "chapter", F.lit(0).alias("part"), F.lit(0).cast("long").alias("doc_id"), head.alias("value")))
    lines = lines.unionByName(ends.select("native_id", "x.chapter", F.lit(0).alias("part"), F.lit(0).cast("long").alias("doc_id"), "x.value"))
    path, order = _place(spark, "books"), ["native_id", "chapter", "part", "doc_id"]
    lines = lines.repartitionByRange(max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))), *order).sortWithinPartitions(*order)
    lines.select("native_id", "value").write.partitionBy("native_id").option("lineSep", "\n").text(path)
    return readers.book_lines(spark, path)


@query
def book_paragraphs(spark, folder):
    p = ingest.book_paragraphs(_books(spark, folder))
    return p.select("native_id", "title", "paragraph_no", "item_id", F.md5("text").alias("text_md5"), F.coalesce("annotation", F.lit("")).alias("annotation"))


@query
def book_corpus(spark, folder):
    """Per book its items, and how many ids its sequences have; the ledger knows it afterwards."""
    c = ingest.books(_books(spark, folder), _empty(spark).ledger, F.lit(AT).cast("timestamp"))
    n = c.items.groupBy("doc_uuid").agg(F.count_if(F.col("kind") == "narrative").alias("n_narratives"), F.count_if(F.col("kind") == "sequence").alias("n_sequences"), F.sum(F.coalesce(F.size("item_ids"), F.lit(0))).alias("n_ids"), F.max("item_pos").cast("long").alias("last_pos"))
    noted = c.variants.groupBy("doc_uuid").agg(F.count("annotation").alias("n_notes"))
    return c.ledger.select("native_id", F.col("uuid").alias("doc_uuid")).join(n, "doc_uuid").join(noted, "doc_uuid").drop("doc_uuid")


# --- files ---


@query
def jsonl_lines(spark, folder):
    d = table(spark, folder, "documents").select("doc_id", F.to_json(F.struct("doc_id", "title")).alias("line"))
    path = _place(spark, "lines")
    d.coalesce(1).sortWithinPartitions("doc_id").select("line").write.text(path)
    return readers.json_lines(spark, path).select("line_no", F.get_json_object("raw", "$.doc_id").cast("long").alias("doc_id"))


@query
def jsonl_counts(spark, folder):
    path = _place(spark, "lines")
    table(spark, folder, "content_variants").select(F.col("variant_id").cast("string")).repartition(3).write.text(path)
    n = readers.line_counts(spark, path)
    return n.agg(F.count("*").alias("n_files"), F.sum("n_lines").alias("n_lines"))


@query
def ledger_appended(spark, folder):
    """Entries written later win, whatever the size of the files they are in."""
    led, path = table(spark, folder, "ledger"), _place(spark, "ledger")
    late = F.col("recorded_at") >= F.lit("2024-07-01").cast("timestamp")
    writers.append_ledger(led.where(late).repartition(3), path)
    writers.append_ledger(led.where(~late | late.isNull()), path)
    return readers.ledger_index(readers.ledger(spark, path))


@query
def ledger_listing(spark, folder):
    led, path = table(spark, folder, "ledger"), _place(spark, "ledger")
    writers.append_ledger(led, path)
    spark.createDataFrame([("",), ("not json",), ("{}",)], "value string").write.mode("append").text(path)
    return readers.ledger(spark, path).select("source", "native_id", "uuid")


@query
def ledger_rewritten(spark, folder):
    led, path = table(spark, folder, "ledger"), _place(spark, "ledger")
    writers.append_ledger(led, path)
    writers.rewrite_ledger(spark, path, table(spark, folder, "doc_meta").where("is_healthy").select(F.col("doc_uuid").alias("uuid")))
    return readers.ledger(spark, path).groupBy("source").agg(F.count("*").alias("n"), F.count_distinct("uuid").alias("n_uuids"))


@query
def stored_corpus(spark, folder):
    """The corpus saved and loaded: rows of each table."""
    path = _place(spark, "corpus")
    c = Corpus.load(spark, folder)
    writers.save(c, path)
    writers.save(c, path)  # takes the place of what is there
    back = Corpus.load(spark, path)
    out = None
    for name, df in (("meta", back.meta), ("items", back.items), ("variants", back.variants), ("ledger", back.ledger)):
        one = df.agg(F.count("*").alias("n")).withColumn("part", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


def _packed(spark: SparkSession, folder: str) -> str:
    path = _place(spark, writers.package_name("lectern", "test"))
    writers.json_lines(package.documents_json(Corpus.load(spark, folder)), path)
    return path


@query
def package_restored(spark, folder):
    """Items of the packaged lines, read back."""
    c = readers.restore(spark, _packed(spark, folder), table(spark, folder, "ledger"))
    return c.items.select("doc_uuid", "item_id", "kind", "entity_id", "actor_id", "category", F.array_join("value", "|").alias("value"), "reasoning", F.coalesce(F.size("item_ids"), F.lit(-1)).cast("long").alias("n_ids"))


@query
def package_variants(spark, folder):
    c = readers.restore(spark, _packed(spark, folder), table(spark, folder, "ledger"))
    return c.variants.select("doc_uuid", "item_id", "name", F.md5("text").alias("text_md5"), "annotation")


@query
def package_parts(spark, folder):
    """Documents in lines of at most 20 items."""
    p = package.part_lines(Corpus.load(spark, folder), 20)
    return p.select("doc_uuid", "part_no", F.coalesce(F.json_array_length(F.get_json_object("line", "$.items")), F.lit(0)).cast("long").alias("n_items"), F.get_json_object("line", "$.items[0].id").alias("first_item"))


@query
def package_order(spark, folder):
    """Packaged lines stand in the order of ids."""
    return readers.json_lines(spark, _packed(spark, folder)).select("line_no", F.get_json_object("raw", "$.id").alias("doc_uuid"))


@query
def records_overwritten(spark, folder):
    """Records written again take the place of theirs, and of no others."""
    m, path = table(spark, folder, "doc_meta"), _place(spark, "records")
    writers.overwrite_records(m.select("doc_uuid", F.lit("old").alias("line")), path)
    writers.overwrite_records(m.where("is_healthy").select("doc_uuid", F.lit("new").alias("line")), path)
    return spark.read.parquet(path).select("doc_uuid", "line")


@query
def record_listing(spark, folder):
    """Names and sizes of record files, blank ones among them."""
    path = _place(spark, "files").removeprefix("file:")
    writers.stage_workspace(path, [])
    for name, text in (("a.json", '{"id":"a"}'), ("b.json", ""), ("c.txt", "x")):
        with open(f"{path}/{name}", "w", encoding="utf-8") as f:
            f.write(text)
    return readers.record_files(spark, path)


@query
def acquired_files(spark, folder):
    """Files fetched where they are missing, and left alone where they are there."""
    path = _place(spark, "raw").removeprefix("file:")
    writers.stage_workspace(path, [])
    with open(f"{path}/one.jsonl", "w", encoding="utf-8") as f:
        f.write("old\n")

    def fetch(name, file, to):
        with open(to, "w", encoding="utf-8") as f:
            f.write(f"{name}/{file}\n")

    got = readers.acquire_dataset("set", path, fetch, ("one.jsonl", "two.jsonl"))
    return spark.read.text(got).select("value")


@query
def rendered_templates(spark, folder):
    path = _place(spark, "templates").removeprefix("file:")
    writers.stage_workspace(path, [])
    with open(f"{path}/t.txt", "w", encoding="utf-8") as f:
        f.write("Say $what to ${who}.")
    return spark.createDataFrame([(readers.template(f"{path}/t.txt").substitute(what=w, who="all"),) for w in ("hello", "no")], "text string")


@query
def run_stamps(spark, folder):
    return table(spark, folder, "ledger").select("uuid", "recorded_at", stamp(F.col("recorded_at")).alias("stamp"))


@query
def ranked_sources(spark, folder):
    """The three sources with most documents; ties by where a source came first."""
    m = positions(table(spark, folder, "doc_meta").select("doc_uuid", select.source_identity().alias("source")), "doc_uuid")
    return report.top_with_rest(m.groupBy("source").agg(F.count("*").alias("n"), F.min("pos").alias("first")), "source", k=3, first="first")


@query
def validated_documents(spark, folder):
    """Lines of which some are cut short, without id, or with an item of no kind."""
    lines = package.documents_json(Corpus.load(spark, folder)).join(table(spark, folder, "doc_meta").select("doc_uuid", "is_healthy", "source_identity"), "doc_uuid")
    hurt = F.when(F.col("is_healthy").isNull(), F.substring("line", 1, 60)).when(F.col("source_identity").isNull(), F.regexp_replace("line", '^\\{"id":"[^"]*",', "{")).when(~F.col("is_healthy"), F.regexp_replace("line", '"kind":"turn"', '"kind":"verse"')).otherwise(F.col("line"))
    d = readers.parsed(lines.select(F.col("doc_uuid").alias("file"), hurt.alias("value")))
    return d.groupBy("corrupt").agg(F.count("*").alias("n"), F.sum(F.coalesce(F.size("items"), F.lit(0))).alias("n_items"))


@query
def cluster_manifest(spark, folder):
    themes = table(spark, folder, "genre_themes").select(F.coalesce("primary_genre", F.lit("Unset")).alias("cluster_id"), F.explode("themes").alias("tag"))
    terms = themes.select("cluster_id", resolve.theme_term(F.col("tag")).alias("term")).where("term <> ''").groupBy("cluster_id", "term").agg(F.count("*").alias("n"))
    path = _place(spark, "clusters")
    writers.cluster_file(resolve.roll_up(terms), 7).write.text(path)
    return readers.cluster_manifest(spark, path).select("cluster_id", "label", F.size("members").cast("long").alias("n_members"), F.get("members", F.lit(0)).alias("first_member"))


@query
def worklist_decisions(spark, folder):
    """A worklist written and read as decisions: its rows keep their order."""
    terms = table(spark, folder, "genre_themes").select(F.coalesce(F.nullif("primary_genre", F.lit("")), F.lit("Unset")).alias("cluster_id"), F.explode("themes").alias("tag"))
    terms = terms.select("cluster_id", resolve.theme_term(F.col("tag")).alias("term")).where("term <> ''")
    members = terms.groupBy("cluster_id", "term").agg(F.count("*").alias("n"))
    cells = members.select("cluster_id", F.concat(F.lit("uses="), F.when(F.col("n") > 1, "many").otherwise("one")).alias("cell"), "n")
    path = _place(spark, "worklist")
    writers.worklist_csv(resolve.worklist(resolve.roll_up(members), cells), path)
    back = spark.read.option("header", True).csv(path)
    return readers.decisions(spark, path).join(back.select("cluster_id", F.col("freq").cast("long").alias("freq"), F.col("`uses=one`").cast("long").alias("uses_one")), "cluster_id").select("row_no", "cluster_id", "freq", "uses_one")


@query
def cluster_counters(spark, folder):
    tags = table(spark, folder, "genre_themes").select(F.coalesce("primary_genre", F.lit("Unset")).alias("genre"), F.explode("themes").alias("tag")).withColumn("term", resolve.theme_term(F.col("tag"))).where("term <> ''")
    members = tags.select("term", F.substring("term", 1, 1).alias("cluster_id")).distinct()
    out = resolve.cluster_counters(members, resolve.crosstab(tags, ["genre"]))
    return out.select("cluster_id", "axis", F.to_json("counts").alias("counts"))


@query
def report_lines(spark, folder):
    """A report as text, line by line."""
    kinds = report.item_kinds(table(spark, folder, "doc_items")).orderBy("kind")
    lines = writers.text_report({"items": {"kinds": kinds}}).split("\n")
    return spark.createDataFrame(list(enumerate(lines)), "line_no int, line string")


@query
def report_sections(spark, folder):
    got = report.report(Corpus.load(spark, folder), ["items", "turn_distribution", "nothing"])
    rows = [(s, name, df.count()) for s, tables in got.items() for name, df in tables.items() if name in ("kinds", "turns", "turn_histogram")]
    return spark.createDataFrame([*rows, *(("unknown", s, 0) for s in report.unknown_sections(["items", "nothing"]))], "section string, name string, n long")


@query
def workspace_folders(spark, folder):
    root = _place(spark, "work").removeprefix("file:")
    made = writers.stage_workspace(root, ["raw", "processed"])
    return spark.createDataFrame([(m.removeprefix(root),) for m in made], "folder string")


# --- configuration and model calls ---


@query
def manifest_settings(spark, folder):
    """A manifest read from a file, with variables and overrides."""
    path = _place(spark, "manifest").removeprefix("file:")
    writers.stage_workspace(path, [])
    with open(f"{path}/m.yml", "w", encoding="utf-8") as f:
        f.write("pipeline: [init]\nvolumes: {raw: '${PLACE}/raw', other: $UNSET}\nparameters: {limit: 5, keep: [a, $PLACE]}\n")
    got = config.load(f"{path}/m.yml", ["--limit", "7", "--flag", "--rate=.5", "--start_uuid", "0123", "--mode", "none", "--name", "x"], {"PLACE": "/data"})
    flat = {"raw": got["volumes"]["raw"], "other": got["volumes"]["other"], **got["parameters"]}
    return spark.createDataFrame([(k, json.dumps(v)) for k, v in flat.items()], "name string, value string")


@query
def closed_schemas(spark, folder):
    rows = [(k, json.dumps(inference.closed(s), sort_keys=True).count('"additionalProperties": false'), len(inference.violations({"a": 1}, inference.closed(s)))) for k, s in enrich.SCHEMAS.items()]
    return spark.createDataFrame(rows, "name string, n_closed int, n_violations int")


@query
def retry_delays(spark, folder):
    return spark.createDataFrame([(i, inference.delay(i), inference.delay(i, 3.5)) for i in range(1, 15)], "attempt int, seconds double, told double")


class Counting:
    """A backend whose answers follow from the length of the prompt."""

    def generate(self, prompt, schema, temperature=0.2, max_tokens=None):
        n = len(prompt)
        one = {"name": f"N{n}", "gender": " Female" if n % 2 else "robot", "pronouns": {"subjective": "she", "objective": "her", "possessive": "hers"}, "core_traits": ["calm"] if n % 3 else [], "appearance_details": ["tall", "grey"]}
        answers = {
            "sexual_axis": {"sexual_axis": SEXUAL[n % 3], "violence_axis": VIOLENCE[n % 3], "toxicity_axis": TOXICITY[n // 3 % 3] if n % 7 else "Bad"},
            "primary_genre": {"primary_genre": GENRES[n % 8], "themes": ["Slow Burn", "slow-burn", f"T {n % 5}", ""]},
            "user_character": {"user_character": one | {"gender": "neutral"}, "bot_character": one | {"gender": "female"}},
            "text": {"text": prompt.rsplit("Text: ", 1)[-1][::-1]},
        }
        return next(v for k, v in answers.items() if k in schema["properties"])


@query
def enriched_safety(spark, folder):
    """Axes that documents lacked; answers off the scale leave theirs as it was."""
    c = enrich.refine_safety(Corpus.load(spark, folder), Counting)
    return select.of_categories(c.items, "sexuality", "violence", "toxicity").select("doc_uuid", "category", F.array_join("value", "|").alias("value")).groupBy("category", "value").agg(F.count("*").alias("n"))


@query
def enriched_genre(spark, folder):
    c = enrich.refine_genre(Corpus.load(spark, folder), Counting)
    noted = c.meta.where(meta.annotated(F.col("annotations"), "refine-chat-genre-theme")).select("doc_uuid")
    return select.of_categories(c.items, "genre", "theme").join(noted, "doc_uuid").select("doc_uuid", "category", F.array_join("value", "|").alias("value"))


@query
def enriched_characters(spark, folder):
    c = enrich.refine_characters(Corpus.load(spark, folder), Counting)
    new = c.meta.where(F.size("identities") > 0).select("doc_uuid", F.get("identities", F.lit(1))["gender"].alias("bot_gender"))
    cards = c.items.where("kind = 'character' and item_pos < 2").join(new, "doc_uuid").join(c.variants.where("variant_id is null").select("doc_uuid", "item_id", "text"), ["doc_uuid", "item_id"])
    return cards.select("doc_uuid", "item_pos", "entity_id", "bot_gender", "text")


@query
def enriched_grammar(spark, folder):
    """The rewritten variants that turns lacked."""
    c = Corpus.load(spark, folder)
    new = enrich.refine_grammar(c, Counting).variants.where("name = 'refine-chat-grammar'")
    had = c.variants.where("name = 'refine-chat-grammar'").select("doc_uuid", "item_id")
    return new.join(had, ["doc_uuid", "item_id"], "left_anti").select("doc_uuid", "item_id", F.md5("text").alias("text_md5"))


@query
def genders(spark, folder):
    return table(spark, folder, "safety_dials").select("response_id", normal_gender(F.coalesce("violence_axis", F.lit("  Male "))).alias("gender"))


# --- refinement, roll-back and purges ---


@query
def markdown_variants(spark, folder):
    """The variants of the Markdown step: one an item, each with an id of its own, from the latest delivery."""
    c = refine.refine_markdown(Corpus.load(spark, folder))
    md = c.variants.where("name = 'refine-cdm-html-to-markdown'")
    twice = c.variants.groupBy("variant_id").agg(F.count("*").alias("n")).where("n > 1").select("variant_id", F.lit(True).alias("shared_id"))
    return md.join(twice, "variant_id", "left").select("doc_uuid", "item_id", "post_id", "posted_at", F.coalesce("shared_id", F.lit(False)).alias("shared_id"))


@query
def refined_language(spark, folder):
    """With ``skip-if-present`` documents that have a language item keep it; the others get one."""
    c = Corpus.load(spark, folder)
    out = refine.refine_language(c, table(spark, folder, "lang_samples"), {"turn": ["original"], "narrative": ["original"]}, mode="skip-if-present")
    per = select.of_categories(out.items, "language").groupBy("doc_uuid").agg(F.count("*").alias("n_items"))
    return per.join(out.meta.select("doc_uuid", meta.annotated(F.col("annotations"), "refine-cdm-language").alias("detected")), "doc_uuid")


@query
def scalpel_documents(spark, folder):
    """What each scalpel leaves: items, variants, annotations."""
    c = _noted(spark, folder)
    out = None
    for name in ("scalpel-cdm-language", "scalpel-cdm-html-to-markdown", "scalpel-chat-characters", "scalpel-chat-genre-theme", "scalpel-chat-safety-dials", "scalpel-chat-grammar"):
        s = config.STEPS[name](c, {})
        one = s.items.agg(F.count("*").alias("n")).withColumn("part", F.lit("items")).unionByName(s.variants.agg(F.count("*").alias("n")).withColumn("part", F.lit("variants"))).unionByName(s.meta.agg(F.sum(F.size("annotations")).alias("n")).withColumn("part", F.lit("annotations"))).withColumn("step", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


def _noted(spark: SparkSession, folder: str) -> Corpus:
    """The corpus with the annotations of all steps on healthy documents."""
    c = Corpus.load(spark, folder)
    for k in meta.Rules().due:
        c = replace(c, meta=refine.noted(c.meta, c.meta.where("is_healthy"), k, "done"))
    return c


@query
def scalpel_named(spark, folder):
    """Characters go where the player has one of the names."""
    c = Corpus.load(spark, folder)
    who = c.meta.select("*").drop("identities").join(c.items.where("kind = 'character' and entity_id = 'user'").select("doc_uuid").distinct().withColumn("u", F.lit(True)), "doc_uuid", "left")
    one = F.struct(F.lit("user").alias("entity_id"), F.when(F.col("is_healthy"), " Ann ").otherwise("Bo").alias("name"), F.lit("unknown").alias("gender"), F.lit(None).cast("struct<subjective:string,objective:string,possessive:string>").alias("pronouns"), F.lit(True).alias("is_player_controlled"))
    c = replace(c, meta=who.withColumn("identities", F.when(F.col("u"), F.array(one)).otherwise(F.array().cast(c.meta.schema["identities"].dataType))).drop("u").select(*c.meta.columns))
    s = refine.scalpel_characters(c, ["ANN"])
    return s.items.groupBy("doc_uuid").agg(F.count_if(F.col("kind") == "character").alias("n_characters")).join(s.meta.select("doc_uuid", F.size("identities").cast("long").alias("n_identities")), "doc_uuid")


@query
def scalpel_sentinel(spark, folder):
    """Grammar variants go where the user's profile was made."""
    c = Corpus.load(spark, folder)
    s = refine.scalpel_grammar(c, meta.health(c), sentinel=True)
    return s.variants.groupBy("doc_uuid").agg(F.count_if(F.col("name") == "refine-chat-grammar").alias("n_grammar"))


def _hurt(spark: SparkSession, folder: str) -> Corpus:
    """A corpus with faults: an unknown kind, a repeated item, broken data, a document of another kind."""
    c = Corpus.load(spark, folder)
    end = F.substring("doc_uuid", -1, 1)
    items = c.items.withColumn("kind", F.when((end == "a") & (F.col("kind") == "world"), "globe").otherwise(F.col("kind")))
    items = items.withColumn("data", F.when((end == "b") & (F.col("kind") == "sequence"), '{"sequence_for":').otherwise(F.col("data")))
    items = items.unionByName(items.where((end == "c") & (F.col("kind") == "summary")))
    return replace(c, items=items, meta=c.meta.withColumn("kind", F.when(end == "d", "page").otherwise(F.col("kind"))))


@query
def corrupt_found(spark, folder):
    return refine.corrupt_documents(_hurt(spark, folder))


@query
def purged_corrupt(spark, folder):
    c = refine.purge_corrupt(_hurt(spark, folder))
    return c.meta.select("doc_uuid").join(c.items.groupBy("doc_uuid").agg(F.count("*").alias("n_items")), "doc_uuid", "left").fillna(0)


@query
def annotation_steps(spark, folder):
    """An annotation put on, put on again, taken off."""
    m = Corpus.load(spark, folder).meta
    m = refine.noted(refine.noted(m, m, "a", "first"), m.where("is_healthy"), "a", "second").withColumn("annotations", meta.annotate(F.col("annotations"), "b", "more"))
    m = m.withColumn("annotations", F.when(F.coalesce(F.col("item_count") > 10, F.lit(False)), meta.unannotate(F.col("annotations"), "b")).otherwise(F.col("annotations")))
    return m.select("doc_uuid", meta.annotated(F.col("annotations"), "b").alias("has_b"), F.array_join(F.transform("annotations", lambda a: F.concat(a["kind"], F.lit(":"), a["content"])), ",").alias("notes"))


@query
def refreshed_meta(spark, folder):
    m = meta.refresh(Corpus.load(spark, folder)).meta
    return m.select("doc_uuid", "item_count", "turns", "words", "genre", "is_healthy", F.size("issues").cast("long").alias("n_issues"), F.coalesce(F.size("themes"), F.lit(0)).cast("long").alias("n_themes"))


@query
def described_documents(spark, folder):
    d = meta.described(Corpus.load(spark, folder))
    return d.select("doc_uuid", "items", "words", "sexuality", "violence", "toxicity", "genre", F.array_join("themes", "|").alias("themes"), F.array_join("languages", "|").alias("languages"))


# --- filters and choices ---


@query
def kind_items(spark, folder):
    return select.of_kinds(table(spark, folder, "doc_items"), ["narrative", "character"]).select("doc_uuid", "item_id", "kind")


@query
def targeted_documents(spark, folder):
    m = table(spark, folder, "doc_meta")
    first, last = (m.agg(f("doc_uuid")).first()[0] for f in (F.min, F.max))
    return m.where(F.col("doc_uuid").isin(*select.uuid_targets(f" {last},,{first} , {first}"))).select("doc_uuid", "source_identity")


@query
def pending_characters(spark, folder):
    return enrich.without_user_profile(table(spark, folder, "doc_meta"), table(spark, folder, "doc_items")).select("doc_uuid")


@query
def next_numbers(spark, folder):
    return table(spark, folder, "doc_items").groupBy("doc_uuid").agg(*(ingest.next_number(F.col("item_id"), k).alias(k) for k in ("narrative", "turn", "character")))


@query
def actor_names(spark, folder):
    """Turns with the names of who speaks; identities come from the character items."""
    who = table(spark, folder, "doc_items").where("kind = 'character' and entity_id is not null").select("doc_uuid", "item_pos", "entity_id")
    ident = who.groupBy("doc_uuid").agg(F.transform(F.array_sort(F.collect_list(F.struct("item_pos", "entity_id"))), lambda x: F.struct(x["entity_id"].alias("entity_id"), F.concat(F.lit("Name "), x["item_pos"].cast("string")).alias("name"))).alias("identities"))
    turns = table(spark, folder, "doc_items").where("kind = 'turn'").select("doc_uuid", "item_id", "actor_id")
    return enrich.actor_names(turns, ident).select("doc_uuid", "item_id", "actor_name")


@query
def player_names(spark, folder):
    who = table(spark, folder, "doc_items").where("kind = 'character'").select("doc_uuid", "item_pos", "item_id", "entity_id")
    ident = who.groupBy("doc_uuid").agg(F.transform(F.array_sort(F.collect_list(F.struct("item_pos", "item_id", "entity_id"))), lambda x: F.struct(F.concat(F.lit("N "), x["item_id"]).alias("name"), x["entity_id"].eqNullSafe("user").alias("is_player_controlled"))).alias("identities"))
    return report.character_names(ident)


# --- themes ---


@query
def theme_axes(spark, folder):
    """Documents' terms against their axes, languages among them."""
    return resolve.corpus_crosstab(Corpus.load(spark, folder))


@query
def theme_curated(spark, folder):
    """The theme items after curation, and which documents were touched."""
    themes = table(spark, folder, "theme_list")
    manifest = themes.select(F.col("theme_id").cast("string").alias("cluster_id"), F.col("theme").alias("label"), F.concat(F.array("theme"), "aliases").alias("members"))
    decisions = themes.select(F.col("theme_id").alias("row_no"), F.col("theme_id").cast("string").alias("cluster_id"), F.lit("").alias("human_label"), F.when(F.col("theme_id") % 10 == 0, F.lit("drop")).alias("action"))
    c = resolve.curate_corpus(Corpus.load(spark, folder), resolve.curation_map(decisions, manifest))
    touched = c.meta.select("doc_uuid", meta.annotated(F.col("annotations"), "resolve-theme-curation").alias("touched"))
    return meta.resolve(c.items).where(F.size("themes") > 0).select("doc_uuid", F.array_join("themes", "|").alias("themes")).join(touched, "doc_uuid")


# --- steps, streams, counters ---


@query
def manifest_run(spark, folder):
    """Steps of a manifest on a range of documents; another dataset's name in a step's name changes nothing."""
    c = config.run(Corpus.load(spark, folder), {"pipeline": ["scalpel-x-genre-theme", "scalpel-chat-grammar", "refresh-meta"], "parameters": {"start_uuid": "01961283", "stop_uuid": "01961290"}})
    n = c.items.groupBy("doc_uuid").agg(F.count("*").alias("n_items"))
    v = c.variants.groupBy("doc_uuid").agg(F.count("*").alias("n_variants"))
    return c.meta.select("doc_uuid", F.col("item_count").cast("long").alias("item_count")).join(n, "doc_uuid", "left").join(v, "doc_uuid", "left").fillna(0, ["n_items", "n_variants"])


@query
def prepared_lines(spark, folder):
    path = _place(spark, "prepared")
    config.run(Corpus.load(spark, folder), {"pipeline": ["prepare"], "parameters": {"path": path}})
    return spark.read.text(path).groupBy("flavour").agg(F.count("*").alias("n"))


@query
def stream_merge(spark, folder):
    """Files that arrive, merged batch by batch."""
    source, target, at = _place(spark, "in"), _place(spark, "table"), _place(spark, "at")
    events = table(spark, folder, "events").select("user_id", "event_type", "ts", "event_id", "value")
    events.repartition(6, "event_id").write.parquet(source)
    merge.merge_stream(spark, source, events.schema, target, at, ["user_id", "event_type"], ["ts", "event_id"], files_per_trigger=2, buckets=8).awaitTermination()
    return merge.merged(spark, target)


@query
def run_counters(spark, folder):
    """What a step counts while it runs."""
    df, seen = counted(table(spark, folder, "content_variants"), f"run-{uuid.uuid4().hex[:6]}", blank="coalesce(trim(text), '') = ''", html="text like '%<%'")
    df.write.format("noop").mode("overwrite").save()
    got = seen.get
    return spark.createDataFrame([(k, int(v)) for k, v in got.items()], "counter string, n long")
