"""Document steps: ingest, refine, roll back, purge, report, package, streaming, configuration, inference."""

import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern import config, inference
from lectern.model import Corpus
from lectern.operators import ingest, meta, package, refine, report, resolve, select
from lectern.operators.components import connected_components
from lectern.plans import join_checked
from lectern.plans.ordering import numbered, positions
from lectern.sources import readers, writers
from lectern.streaming.merge import merge_stream

CHAT, FORUM = "emberlamp/chatlogs", "hollowquill/forum-raw"
ITEMS = "doc_uuid string, item_pos int, item_id string, kind string, entity_id string, actor_id string, category string, value array<string>, value_is_list boolean, reasoning string, item_ids array<string>, data string"
VARIANTS = "variant_id long, doc_uuid string, item_id string, name string, text string, annotation string, author_id string, post_id string, posted_at string"


def item(doc, pos, id_, kind, **kw):
    cols = ["entity_id", "actor_id", "category", "value", "value_is_list", "reasoning", "item_ids", "data"]
    return (doc, pos, id_, kind, *(kw.get(c) for c in cols))


def corpus(spark, metas, items, variants):
    m = spark.createDataFrame(metas, "doc_uuid string, kind string, source_identity string, native_id string, notes array<string>")
    note = F.transform("notes", lambda k: F.struct(k.alias("kind"), F.lit("").alias("content"), F.lit(None).cast("string").alias("reasoning")))
    m = m.withColumn("annotations", F.coalesce(note, F.array())).drop("notes")
    v = spark.createDataFrame([(i, *r, None, None, None, None) for i, r in enumerate(variants)], VARIANTS)
    led = spark.createDataFrame([(x[2] or "unknown", x[3], x[0], None, i) for i, x in enumerate(metas)], "source string, native_id string, uuid string, meta string, recorded_at int")
    return Corpus(m, spark.createDataFrame(items, ITEMS), v, led).complete()


def chat_items(doc, turns, category=True):
    rows = [item(doc, 0, "c1", "character", entity_id="user"), item(doc, 1, "c2", "character", entity_id="bot")]
    rows += [item(doc, 2 + i, f"turn-{i:06d}", "turn", actor_id="user") for i in range(turns)]
    values = {"language": ["en"], "sexuality": ["Clean"], "violence": ["None"], "toxicity": ["Safe"], "genre": ["Drama"], "theme": ["a", "b"]}
    if category:
        rows += [item(doc, 50 + i, f"categorization-{i + 1:06d}", "categorization", category=k, value=v, value_is_list=k in ("language", "theme")) for i, (k, v) in enumerate(values.items())]
    return rows


@pytest.fixture(scope="module")
def sample(spark):
    steps = list(meta.Rules().due)
    metas = [("ok", "document", CHAT, "1", steps), ("noturn", "document", CHAT, "2", steps), ("partial", "document", CHAT, "3", steps), ("forum", "document", FORUM, "4", steps), ("book", "document", "oldshelf/novels", "5", ["refine-cdm-language"]), ("bare", "document", "", "6", None)]
    items = chat_items("ok", 2) + chat_items("noturn", 0) + chat_items("partial", 3)
    items += [item("forum", 0, "n1", "narrative"), item("forum", 1, "n2", "narrative"), item("forum", 2, "l", "categorization", category="language", value=["en"], value_is_list=True), item("book", 0, "n1", "narrative"), item("book", 1, "l", "categorization", category="language", value=[""], value_is_list=False), item("book", 2, "g", "categorization", category="genre", value=["Noir"], value_is_list=False)]
    v = [(d, f"turn-{i:06d}", n, f"Said {i}") for d, k in (("ok", 2), ("partial", 3)) for i in range(k) for n in ("original", "refine-chat-grammar") if not (d == "partial" and i == 2 and n != "original")]
    v += [("forum", "n1", "original", "<p>One <b>x</b></p>"), ("forum", "n1", "refine-cdm-html-to-markdown", "One **x**"), ("forum", "n2", "original", "<p>Two</p>"), ("book", "n1", "original", "Three words here")]
    return corpus(spark, metas, items, v)


def test_health(spark, sample):
    h = {r.doc_uuid: r for r in meta.health(sample).collect()}
    assert h["ok"].is_healthy and h["ok"].breakdown["refine-chat-grammar"]["passed"] and h["ok"].total_turns == 2
    assert h["noturn"].is_healthy and not h["noturn"].breakdown["refine-chat-grammar"]["passed"]
    assert h["partial"].issues == ["1 turns lack variant 'refine-chat-grammar'"] and h["partial"].converted_turns == 2
    assert not h["forum"].is_healthy and "1 narratives lack" in h["forum"].issues[0]
    assert h["book"].issues == ["Unset or empty language categorization"] and set(h["book"].breakdown) == {"refine-cdm-language"}
    assert h["bare"].source == "unknown" and len(h["bare"].issues) == 2
    b = {(r.stage, r.check): (r.n_passed, r.n_due) for r in report.stage_breakdown(meta.health(sample)).collect()}
    assert b["refine-chat-grammar", "prose"] == (1, 3) and b["refine-cdm-language", "annotation"] == (5, 6) and b["refine-cdm-html-to-markdown", "narrative"] == (0, 1)


def test_resolve_ignores_invalid_values(spark, sample):
    r = {x.doc_uuid: x for x in meta.resolve(sample.items).collect()}
    assert r["ok"].genre == "Drama" and r["ok"].themes == ["a", "b"] and r["book"].genre is None and r["book"].languages == [""]


def test_annotations(spark):
    df = spark.createDataFrame([(None,)], "a array<struct<kind:string,content:string,reasoning:string>>")
    df = df.withColumn("a", meta.annotate(F.col("a"), "x", "1")).withColumn("a", meta.annotate(F.col("a"), "y", "2", "why"))
    assert df.select(meta.annotated(F.col("a"), "x")).first()[0]
    r = df.select(meta.unannotate(F.col("a"), "x").alias("a")).first().a
    assert [(a.kind, a.content, a.reasoning) for a in r] == [("y", "2", "why")]


def test_markdown_round_trip(spark, sample):
    done = refine.refine_markdown(sample)
    texts = {(r.doc_uuid, r.item_id): r.text for r in done.variants.where("name = 'refine-cdm-html-to-markdown'").collect()}
    assert texts == {("forum", "n1"): "One **x**", ("forum", "n2"): "Two", ("book", "n1"): "Three words here"}
    again = refine.refine_markdown(done)
    assert again.variants.count() == done.variants.count()
    back = refine.scalpel_markdown(done).variants
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, sample.variants.where("name <> 'refine-cdm-html-to-markdown'").collect()), key=repr)
    with pytest.raises(ValueError):
        refine.refine_markdown(sample, kinds=("sequence",))


def test_language_refinement(spark, sample, data):
    samples = spark.read.parquet(f"{data}/lang_samples.parquet")
    text = samples.where("lang = 'de'").first().text
    v = [("bare", "t1", "original", text)]
    c = corpus(spark, [("bare", "document", CHAT, "1", None)], [item("bare", 0, "t1", "turn"), item("bare", 1, "categorization-000004", "categorization", category="theme", value=["x"], value_is_list=True)], v)
    done = refine.refine_language(c, samples)
    got = done.items.where("category = 'language'").collect()
    assert len(got) == 1 and got[0].value[0] == "de" and got[0].item_id == "categorization-000005" and got[0].item_pos == 2
    twice = refine.refine_language(done, samples)
    assert twice.items.where("category = 'language'").count() == 1 and twice.items.count() == done.items.count()
    assert meta.annotated(F.col("annotations"), "refine-cdm-language") is not None
    assert refine.scalpel_language(done).items.count() == c.items.count()
    with pytest.raises(ValueError):
        refine.refine_language(c, samples, mode="guess")


def test_scalpels(spark, sample):
    assert refine.scalpel_safety_dials(sample).items.where("category in ('sexuality', 'violence', 'toxicity')").count() == 0
    gone = refine.scalpel_grammar(sample)
    assert gone.variants.where("name = 'refine-chat-grammar'").count() == 0 and gone.variants.where("name = 'original'").count() == sample.variants.where("name = 'original'").count()
    h = meta.health(sample)
    assert refine.scalpel_grammar(sample, h.where("doc_uuid = 'ok'"), sentinel=True).variants.where("name = 'refine-chat-grammar'").count() == 2
    assert refine.scalpel_characters(sample).items.where("kind = 'character'").count() == 0
    assert refine.scalpel_characters(sample, ["Nobody"]).items.count() == sample.items.count()


def test_purge(spark, sample):
    c = refine.purge_records(sample, "ok, book")
    assert c.meta.count() == 4 and c.ledger.count() == 4 and c.items.where("doc_uuid = 'ok'").count() == 0
    assert refine.purge_records(sample, start="f", stop="o").meta.count() == 4
    with pytest.raises(ValueError):
        refine.purge_records(sample)
    bad = corpus(spark, [("d", "document", CHAT, "1", None), ("e", "document", CHAT, "2", None)], [item("d", 0, "a", "odd"), item("e", 0, "a", "turn"), item("e", 1, "a", "turn", data="{")], [("e", "a", "original", "x")])
    assert {tuple(r) for r in refine.corrupt_documents(bad).collect()} == {("d", "item kind"), ("e", "item id"), ("e", "data")}
    assert refine.purge_corrupt(bad).meta.count() == 0


def test_append_and_prepend(spark, sample):
    new = spark.createDataFrame([("bare", "genre", ["Drama"]), ("bare", "theme", ["x", "y"]), ("ok", "genre", ["Comedy"])], "doc_uuid string, category string, value array<string>")
    out = refine.append_categories(sample.items, new, "genre", "theme")
    assert [(r.item_id, r.category) for r in out.where("doc_uuid = 'bare'").orderBy("item_pos").collect()] == [("categorization-000001", "genre"), ("categorization-000002", "theme")]
    assert out.where("doc_uuid = 'ok'").count() == sample.items.where("doc_uuid = 'ok'").count()
    chars = spark.createDataFrame([("forum", "c1", "user", 0), ("forum", "c2", "bot", 1)], "doc_uuid string, item_id string, entity_id string, place int")
    assert [r.item_id for r in refine.prepend_characters(sample.items, chars).where("doc_uuid = 'forum'").orderBy("item_pos").collect()] == ["c1", "c2", "n1", "n2", "l"]


def test_conversations_are_ingested_once(spark, tmp_path):
    rec = {"bot_id": "b1", "bot_name": None, "bot_description": " A bot ", "submission_timestamp": 5, "conversation": [{"message": " hi ", "is_human": True}, {"message": None, "is_human": False}]}
    lines = [json.dumps(rec), "", json.dumps(dict(reversed(rec.items()))), "{bad", json.dumps(rec | {"bot_id": ""}), json.dumps(rec | {"submission_timestamp": None}), json.dumps(rec | {"conversation": [], "bot_description": None})]
    (tmp_path / "in.jsonl").write_text("\n".join(lines), encoding="utf-8")
    raw = readers.json_lines(spark, str(tmp_path / "in.jsonl"))
    assert sorted(r.line_no for r in raw.collect()) == [0, 2, 3, 4, 5, 6]
    empty = spark.createDataFrame([], "source string, native_id string, uuid string, meta string, recorded_at string")
    at = F.lit("2025-01-01 00:00:00")
    c = ingest.conversations(raw, empty, at)
    assert c.meta.count() == 2 and c.ledger.count() == 2
    kinds = {r.kind: r.n_items for r in report.item_kinds(c.items).collect()}
    assert kinds == {"character": 1, "turn": 2, "sequence": 1}
    assert {r.text for r in c.variants.collect()} == {"A bot", "hi", ""} and {r.actor_id for r in c.items.where("kind = 'turn'").collect()} == {"user", "b1"}
    known = c.ledger.withColumn("recorded_at", F.col("recorded_at").cast("string"))
    assert ingest.conversations(raw, known, at).meta.count() == 0
    assert ingest.conversations(raw, empty, at, limit=1).meta.count() == 1


def test_threads_are_upserted(spark):
    from test_functions import PAGE

    none = Corpus(spark.createDataFrame([], "doc_uuid string, kind string, source_identity string, native_id string"), spark.createDataFrame([], ITEMS), spark.createDataFrame([], VARIANTS).drop("variant_id"), spark.createDataFrame([], "source string, native_id string, uuid string, meta string, recorded_at string"))
    pages = spark.createDataFrame([("s1", PAGE), ("s2", ""), ("s3", None)], "section_url string, contents string")
    at = F.lit("2025-01-01")
    one = ingest.threads(pages, none.complete(), at)
    assert one.meta.count() == 2 and one.items.where("kind = 'narrative'").count() == 3 and one.items.where("kind = 'sequence'").count() == 2
    more = PAGE.replace("Two", "Two changed").replace('data-content="post-14"', 'data-content="post-14"><a href="/index.php?threads/the-thread.5/">t</a')
    two = ingest.threads(spark.createDataFrame([("s1", more)], "section_url string, contents string"), one, at)
    assert two.meta.count() == 2 and two.ledger.count() == 2
    texts = {r.post_id: (r.item_id, r.text) for r in two.variants.collect()}
    assert texts["12"][1] == "Two changed" and len(texts) == 4 and len({v[0] for k, v in texts.items() if k in ("11", "12", "14")}) == 3
    same = ingest.threads(spark.createDataFrame([("s1", more)], "section_url string, contents string"), two, at)
    assert sorted(map(tuple, same.variants.collect()), key=repr) == sorted(map(tuple, two.variants.collect()), key=repr)


def test_reconcile(spark):
    a, b = (spark.createDataFrame(r, "k int, v string") for r in ([(1, "x"), (2, "y"), (3, None)], [(2, "z"), (3, None), (4, "n")]))
    assert {tuple(r) for r in ingest.reconcile(a, b, "k", ["v"]).collect()} == {(1, "x", "kept"), (2, "z", "updated"), (3, None, "same"), (4, "n", "inserted")}


def test_record_files_and_package(spark, sample, tmp_path):
    doc = {"id": "d1", "kind": "document", "meta": {"source": {"source": CHAT, "native_id": "9"}, "annotations": [{"kind": "ingest", "content": "c"}]}, "items": [{"id": "t1", "kind": "turn", "actor_id": "user", "content": [{"name": "original", "text": "hi"}]}, {"id": "k1", "kind": "categorization", "category": "genre", "value": "Drama"}, {"id": "k2", "kind": "categorization", "category": "theme", "value": ["a", "b"]}]}
    (tmp_path / "d1.json").write_text(json.dumps(doc, indent=2))
    (tmp_path / "cut.json").write_text(json.dumps(doc)[:40])
    (tmp_path / "blank.json").write_text("")
    (tmp_path / "odd.json").write_text(json.dumps(doc | {"id": "d2", "items": [{"id": "x", "kind": "odd"}]}))
    docs = readers.documents(spark, str(tmp_path))
    assert {r.file: r.corrupt for r in docs.collect()} == {"d1.json": False, "cut.json": True, "blank.json": True, "odd.json": True}
    c = readers.to_corpus(docs, spark.createDataFrame([], "source string, native_id string, uuid string"))
    by = {r.item_id: r for r in c.items.collect()}
    assert by["k1"].value == ["Drama"] and not by["k1"].value_is_list and by["k2"].value == ["a", "b"] and by["k2"].value_is_list and c.meta.first().source_identity == CHAT
    lines = package.documents_json(sample)
    writers.json_lines(lines, str(tmp_path / "out"))
    back = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert len(back) == 6 and sorted(b["id"] for b in back) == ["bare", "book", "forum", "noturn", "ok", "partial"]
    ok = next(b for b in back if b["id"] == "ok")
    assert [i["id"] for i in ok["items"]][:4] == ["c1", "c2", "turn-000000", "turn-000001"] and ok["items"][2]["content"][0]["text"] == "Said 0"
    assert package.rejects(lines).count() == 0 and writers.package_name("p", "g1") == "p-dataset-g1.jsonl"


def test_ledger_files(spark, tmp_path):
    p = str(tmp_path / "ledger")
    writers.append_ledger(spark.createDataFrame([("s", "1", "u1", None), ("s", "1", "u2", None), ("t", "2", "u3", '{"a":1}')], "source string, native_id string, uuid string, meta string").coalesce(1), p)
    with open(os.path.join(p, "part-hand"), "w") as f:
        f.write("\nnot json\n")
    assert readers.ledger(spark, p).count() == 3
    assert {tuple(r) for r in readers.ledger_index(readers.ledger(spark, p)).select("native_id", "uuid").collect()} == {("1", "u2"), ("2", "u3")}
    writers.rewrite_ledger(spark, p, spark.createDataFrame([("u3",), ("none",)], "uuid string"))
    assert readers.ledger(spark, p).count() == 2 and spark.read.text(p).where("value = 'not json'").count() == 1


def test_stream_merge_is_repeatable(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    for i in range(3):
        spark.createDataFrame([(k, i, f"v{i}") for k in range(i, 4)], "k int, at int, v string").coalesce(1).write.mode("append").parquet(src)
    for _ in range(2):
        merge_stream(spark, src, "k int, at int, v string", out, str(tmp_path / "cp"), ["k"], ["at"], 1).awaitTermination()
    assert {(r.k, r.v) for r in spark.read.parquet(out).collect()} == {(0, "v0"), (1, "v1"), (2, "v2"), (3, "v2")}


def test_reports(spark, sample):
    r = report.report(sample, ["items", "nope", "turn_distribution"])
    assert list(r) == ["items", "turn_distribution"] and report.unknown_sections(["nope"]) == ["nope"]
    t = r["turn_distribution"]["turns"].first()
    assert (t.n, t.total, t.least, t.greatest, t.median) == (6, 5, 0, 3, 0)
    assert {x.bucket: x.n for x in r["turn_distribution"]["turn_histogram"].collect()}["1-10"] == 2
    assert "== items ==" in writers.text_report(r)
    assert {x.kind: x.n_items for x in report.content_shapes(sample.items, sample.variants).where("shape = 'missing'").collect()} == {"character": 6}
    even = spark.createDataFrame([(v,) for v in (1, 3, 5, 9)], "v long")
    assert report.distribution(even, "v").first().median == 5
    assert {tuple(x) for x in report.top_with_rest(spark.createDataFrame([("a", 3), ("b", 2), ("c", 2)], "k string, n long"), "k", k=2).collect()} == {("a", 3), ("b", 2), ("(other)", 2)}


def test_order_helpers(spark):
    df = spark.createDataFrame([(k, i) for i in range(300) for k in ("hot", "hot", "b" if i % 7 else "a")], "k string, i int").repartition(5)
    got = numbered(df, "k", "i").collect()
    for k in ("hot", "a", "b"):
        mine = sorted((r.n, r.i) for r in got if r.k == k)
        assert [n for n, _ in mine] == list(range(1, len(mine) + 1)) and [i for _, i in mine] == sorted(i for _, i in mine)
    assert sorted(r.pos for r in positions(df, "i", "k").collect()) == list(range(1, 901))
    runs = spark.createDataFrame([(f"{i:03d}", "x" if i < 40 or i > 70 else "y") for i in range(100)], "k string, s string")
    assert sorted((r.source, r.first_key, r.n) for r in report.source_ranges(runs, "k", "s").collect()) == [("x", "000", 40), ("x", "071", 29), ("y", "040", 31)]
    turns = spark.createDataFrame([("d", i, f"t{i}", f"x{i}") for i in range(25)], "doc_uuid string, item_pos int, item_id string, text string")
    got = {r.item_pos: r.history for r in refine.history(turns, block=7).collect()}
    assert len(got) == 25 and all(got[i] == "\n".join(f"x{j}" for j in range(max(0, i - 5), i)) for i in range(25))


def test_join_falls_back_when_large(spark):
    big, small = spark.range(100).withColumnRenamed("id", "k"), spark.range(0, 100, 2).withColumnRenamed("id", "k")
    assert join_checked(big, small, "k", limit=0).count() == join_checked(big, small, "k").count() == 50
    assert "BroadcastHashJoin" in join_checked(big, small, "k")._jdf.queryExecution().executedPlan().toString()


def test_components(spark):
    r = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in r.integers(0, 60, (45, 2))] + [(100 + i, 101 + i) for i in range(40)] + [(500, 500)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    got = {x.node: x.component for x in connected_components(spark.createDataFrame([*edges, (None, 1)], "src int, dst int")).collect()}
    assert got == {x: root(x) for x in parent}
    assert connected_components(spark.createDataFrame([], "src int, dst int")).count() == 0


def test_average_linkage_by_component(spark):
    r = np.random.default_rng(5)
    x = r.normal(size=(40, 6))
    whole = resolve.average_linkage(x / np.linalg.norm(x, axis=1, keepdims=True), 0.35)
    rows = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "id int, vector array<double>")
    got = {c.id: c.cluster_id for c in resolve.clusters(rows).collect()}
    assert got == {i: int(min(np.flatnonzero(whole == whole[i]))) for i in range(40)}
    small = {(p.a, p.b) for p in resolve.near_pairs(rows, 0.5, block=7).collect()}
    assert small == {(p.a, p.b) for p in resolve.near_pairs(rows, 0.5).collect()} and small


def test_curation(spark):
    manifest = spark.createDataFrame([("1", "slow-burn", ["slow burn", "slowburn"]), ("2", "x", ["noise"]), ("3", "own-label", ["third"])], "cluster_id string, label string, members array<string>")
    d = spark.createDataFrame([(0, "1", "Gentle Romance", ""), (1, "2", "", "drop"), (2, "9", "lost", ""), (3, "3", None, None)], "row_no int, cluster_id string, human_label string, action string")
    tags = spark.createDataFrame([("d", t) for t in ("Slow-Burn", "slowburn", "noise", "third", "Other Tag", None, " ")], "doc_uuid string, tag string")
    assert resolve.curate(tags, resolve.curation_map(d, manifest)).first().themes == ["gentle-romance", "other-tag", "own-label"]


def test_worklist_and_files(spark, tmp_path):
    terms = spark.createDataFrame([("c", "a b", 3), ("c", "d", 1)], "cluster_id string, term string, n long")
    r = resolve.roll_up(terms)
    w = resolve.worklist(r, spark.createDataFrame([("c", "genre=Drama", 2), ("c", "genre=Comedy", 1)], "cluster_id string, cell string, n long"))
    assert w.first()["genre=Drama"] == 2 and w.first().label == "a-b"
    writers.worklist_csv(w, str(tmp_path / "w"))
    assert readers.decisions(spark, str(tmp_path / "w")).first().cluster_id == "c"
    body = json.loads(writers.cluster_file(r, 2).first().json)
    assert body["meta"]["total_terms"] == 2 and body["clusters"][0]["members"] == ["a b", "d"]
    (tmp_path / "m.json").write_text(json.dumps(body))
    assert readers.cluster_manifest(spark, str(tmp_path / "m.json")).first().label == "a-b"


def test_saving_and_loading(spark, sample, tmp_path):
    c = Corpus(sample.meta, sample.items, sample.variants, sample.ledger)
    for _ in range(2):
        writers.save(c, str(tmp_path / "c"))
    assert Corpus.load(spark, str(tmp_path / "c")).items.count() == sample.items.count() and len(os.listdir(tmp_path / "c")) == 4
    part = c.only(spark.createDataFrame([("ok",)], "doc_uuid string"))
    assert part.meta.count() == 1 and c.without(part.meta).meta.count() == 5


def test_choices(spark, sample):
    with pytest.raises(ValueError):
        select.of_kinds(sample.items, ["sequence"])
    assert select.uuid_targets(" b, a,,b ") == ["a", "b"] == select.uuid_targets(["b", "a"]) and select.uuid_targets(None) == []
    v = spark.createDataFrame([(1, "d", "i", "refined", "  "), (2, "d", "i", "other", " o "), (3, "d", "i", "original", "x"), (4, "d", "j", "original", None)], "variant_id long, doc_uuid string, item_id string, name string, text string")
    assert [tuple(r) for r in select.preferred_text(v, ["refined", "original"]).collect()] == [("d", "i", "original", "x")]
    assert select.preferred_text(v, ["refined"]).first().text == "o"
    assert select.first_per(v, ["doc_uuid"], [F.desc("variant_id")], 2).count() == 2


def test_config(tmp_path):
    assert config.overrides(["--limit", "5", "--rate", ".5", "--odd", "12.5", "--on", "--no", "false", "--start_uuid", "0196", "--x", "none"]) == {"limit": 5, "rate": 0.5, "odd": "12.5", "on": True, "no": False, "start_uuid": "0196", "x": None}
    assert config.interpolate({"a": ["$A/${B}/$C"]}, {"A": "1", "B": "2"}) == {"a": ["1/2/$C"]}
    (tmp_path / "p.yml").write_text("pipeline: [refresh-meta]\nparameters: {limit: 1}\nservices: {m: {url: x}}\n")
    c = config.load(str(tmp_path / "p.yml"), ["--limit", "2"])
    assert c["parameters"]["limit"] == 2
    for bad in ("services: {m: x}\npipeline: [a]", "pipeline: x"):
        (tmp_path / "b.yml").write_text(bad)
        with pytest.raises(ValueError):
            config.load(str(tmp_path / "b.yml"))
    assert config.truthy("YES") and not config.truthy("no")


def test_steps_run_in_order(sample):
    out = config.run(sample, {"pipeline": ["refine-cdm-html-to-markdown", "purge-cdm-record", "refresh-meta"], "parameters": {"target_uuid": "ok"}})
    m = {r.doc_uuid: r for r in out.meta.collect()}
    assert set(m) == {"noturn", "partial", "forum", "book", "bare"} and m["forum"].is_healthy and m["book"].words == 6
    with pytest.raises(ValueError):
        config.run(sample, {"pipeline": ["nope"]})


def test_inference(spark):
    class Echo:
        def generate(self, prompt, schema, **options):
            if "fail" in prompt:
                return {"text": 5}
            return {"text": prompt.splitlines()[-1].upper() + f"({prompt.count(chr(10))})"}

    schema = {"type": "object", "properties": {"text": {"type": "string"}}}
    assert inference.closed(schema)["additionalProperties"] is False
    assert [inference.delay(n) for n in (1, 2, 12)] == [2.0, 4.0, 2480.0] and inference.delay(3, 7.0) == 7.0
    assert inference.violations({"text": "x", "y": 1}, schema) == ["$.y: unknown"] and inference.violations({}, schema) == ["$.text: missing"]

    class Busy:
        n = 0

        def generate(self, prompt, schema, **options):
            self.n += 1
            if self.n < 3:
                raise inference.RateLimited(None if self.n == 1 else 9.0)
            return {"text": "ok"}

    waits = []
    assert inference.call(Busy(), "p", schema, wait=waits.append) == {"text": "ok"} and waits == [2.0, 9.0]
    prompts = spark.createDataFrame([(1, "a"), (2, "fail"), (3, "c")], "key long, prompt string")
    got = {r.key: (r.answer, r.error) for r in inference.answers(prompts, Echo, schema).collect()}
    assert got[1] == ('{"text": "A(0)"}', None) and got[2][0] is None and "not string" in got[2][1]
    assert inference.answers(prompts, Echo, schema, budget=2).count() == 2
    turns = spark.createDataFrame([("d", i, f"t{i}", "fail" if i == 1 else f"w{i}") for i in range(4)], "doc_uuid string, item_pos int, item_id string, text string")
    assert [r.text for r in inference.refine_turns(turns, Echo).orderBy("item_id").collect()] == ["W0(0)", "W2(2)", "W3(3)"]


def test_linkage_by_chains_gives_the_same_clusters():
    import numpy as np
    from lectern.operators.resolve import average_linkage, chained_linkage

    for seed in range(6):
        r = np.random.default_rng(seed)
        x = r.normal(size=(12, 8))[r.integers(0, 12, 90)] + r.normal(size=(90, 8)) * 0.5
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        for cut in (0.1, 0.35, 0.7):
            a, b = average_linkage(x, cut), chained_linkage(x, cut)
            assert len(set(zip(a, b))) == len(set(a)) == len(set(b))
