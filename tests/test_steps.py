"""Manifests: every kind of step runs on a small corpus, on a range where one is given."""

import json

import pytest
from pyspark.sql import functions as F

from lectern import catalog_flows, config
from lectern.model import Corpus
from lectern.operators import ingest
from lectern.sources import readers, writers


@pytest.fixture(scope="module")
def corpus(spark, data):
    return Corpus.load(spark, data)


@pytest.fixture
def files(spark, data, tmp_path):
    record = {"bot_id": "b1", "submission_timestamp": "2024-01-01", "conversation": [{"message": "hi", "is_human": True}]}
    (tmp_path / "c.jsonl").write_text(json.dumps(record) + "\n")
    (tmp_path / "book.txt").write_text("*** START OF IT ***\nFOREWORD\n\nOne.\n\nCHAPTER I\nName\n\nTwo.\n*** END OF IT ***\n")
    page = '<article class="message message--post" data-content="post-5"><a href="/index.php?threads/s.987654321/post-5">x</a><div class="bbWrapper">text</div></article>'
    spark.createDataFrame([("/index.php?threads/s.987654321/", page)], "section_url string, contents string").write.parquet(str(tmp_path / "pages"))
    return tmp_path


STOP = "01961281-a6"
NEEDS = {
    "init": lambda d: {"root": f"{d}/w", "volumes": ["raw"]},
    "acquire": lambda d: {"path": f"{d}/new.txt", "fetch": lambda p: open(p, "w").close()},
    "ingest-conversations": lambda d: {"path": f"{d}/c.jsonl", "limit": 5},
    "ingest-forum": lambda d: {"path": f"{d}/pages"},
    "ingest-book": lambda d: {"path": f"{d}/book.txt", "native_id": "62"},
    "report-cdm": lambda d: {"out": f"{d}/r.txt", "report_sections": ["items", "no such"]},
    "report-cdm-records": lambda d: {"out": f"{d}/r.txt"},
    "resolve-theme-proposal": lambda d: {"clusters": f"{d}/clusters", "worklist": f"{d}/worklist"},
    "package": lambda d: {"path": f"{d}/package"},
    "prepare": lambda d: {"path": f"{d}/prepared"},
    "train": lambda d: {"run": lambda c, p: None},
    "bake": lambda d: {"run": lambda c, p: None},
    "purge-cdm-record": lambda d: {"stop_uuid": STOP},
}
ADDS = {"ingest-conversations": 1, "ingest-forum": 1, "ingest-book": 1}


@pytest.mark.parametrize("name", sorted(set(config.STEPS) - {"resolve-theme-curation"}))
def test_every_step_runs(spark, data, corpus, files, name):
    p = NEEDS.get(name, lambda d: {})(files)
    if name.startswith("refine-chat"):
        p = {"backend": catalog_flows.Counting, "max_inference_budget": 20}
    if name == "refine-cdm-language":
        p = {"samples": spark.read.parquet(f"{data}/lang_samples.parquet"), "mode": "skip-if-present"}
    out = config.run(corpus, {"pipeline": [name], "parameters": p})
    n = corpus.meta.count()
    gone = corpus.meta.where(f"doc_uuid <= '{STOP}'").count() if name == "purge-cdm-record" else 0
    assert out.meta.count() == n + ADDS.get(name, 0) - gone
    assert out.variants.count() >= 0 and out.items.count() > 0
    if name.startswith("report"):
        assert "==" in (files / "r.txt").read_text()


def test_curation_after_proposal(spark, corpus, files):
    parameters = {"clusters": f"{files}/clusters", "worklist": f"{files}/worklist", "decisions": f"{files}/worklist"}
    out = config.run(corpus, {"pipeline": ["resolve-theme-proposal", "resolve-theme-curation"], "parameters": parameters})
    assert out.items.count() == corpus.items.count()
    assert out.meta.where(F.exists("annotations", lambda a: a["kind"] == "resolve-theme-curation")).count() > 0


def test_a_range_leaves_the_rest_alone(corpus):
    ids = [r[0] for r in corpus.meta.select("doc_uuid").orderBy("doc_uuid").collect()]
    out = config.run(corpus, {"pipeline": ["scalpel-chat-grammar"], "parameters": {"start_uuid": ids[3], "stop_uuid": ids[20]}})
    grammar = lambda c, inside: c.variants.where(F.col("name") == "refine-chat-grammar").where(F.col("doc_uuid").between(ids[3], ids[20]) == inside).count()
    assert grammar(out, True) == 0 and grammar(out, False) == grammar(corpus, False) and out.ledger.count() == corpus.ledger.count()


def test_names_of_datasets_in_steps(corpus):
    assert config.step("refine-any-genre-theme") is config.STEPS["refine-chat-genre-theme"]
    assert config.step("ingest-any", {"format": "book"}) is config.STEPS["ingest-book"]
    with pytest.raises(ValueError):
        config.run(corpus, {"pipeline": ["refine-any-nothing", "ingest-any", "nothing"]})
    with pytest.raises(NotImplementedError):
        config.run(corpus, {"pipeline": ["train"]})


def test_the_last_entry_of_a_ledger_wins(spark, tmp_path):
    path = str(tmp_path / "ledger")
    one = "source string, native_id string, uuid string, meta string"
    writers.append_ledger(spark.createDataFrame([("s", "k", "old", None)], one), path)
    writers.append_ledger(spark.createDataFrame([("s", f"n{i}", f"u{i}", None) for i in range(500)] + [("s", "k", "new", None)], one).coalesce(1), path)
    assert readers.ledger_index(readers.ledger(spark, path)).where("native_id = 'k'").first().uuid == "new"


def test_what_a_post_quotes_is_not_its_own():
    from lectern.functions.html import posts

    head = '<a href="/index.php?threads/mine.9/post-5"><time datetime="t1">x</time></a><a class="username" data-user-id="3">me</a>'
    body = '<div class="message-userContent"><div class="bbWrapper"><a href="/index.php?threads/other.7/post-1">q</a><a class="username" data-user-id="8">you</a><time datetime="t2">y</time>hello</div></div>'
    got = posts(f'<article class="message message--post" data-content="post-5">{head}{body}</article><article class="message message--post" data-content="post-6">{body}{head}</article>')
    assert [(p["thread_id"], p["author_id"], p["timestamp"], p["post_url"], p["post_index"]) for p in got] == [("9", "3", "t1", "/index.php?threads/mine.9/post-5", 1), ("9", "3", "t1", "/index.php?threads/mine.9/post-5", 2)]
    assert posts(f'<article class="message message--post" data-content="post-5">{body}</article>') == []


def test_broken_records_do_not_stop_ingestion(spark):
    rows = spark.createDataFrame([(0, '{"bot_id":"b","submission_timestamp":"t","conversation":[]}}'), (1, "nope"), (2, '{"bot_id":""}'), (3, '{"bot_id":"b","submission_timestamp":"t","conversation":[]}')], "line_no long, raw string")
    empty = catalog_flows._empty(spark)
    assert ingest.conversations(rows, empty.ledger, F.lit("2024-01-01").cast("timestamp")).meta.count() == 1
    assert {(r.line_no, r.reason) for r in ingest.conversation_rejects(rows).collect()} == {(0, "not JSON"), (1, "not JSON"), (2, "no bot")}


def test_answers_that_fail_in_two_stages():
    from lectern import inference

    class Bad:
        def generate(self, prompt, schema, **_):
            return {"text": 5}

    with pytest.raises(inference.OffSchema):
        inference.call(Bad(), "x", {"type": "object", "properties": {"text": {"type": "string"}}})
    assert issubclass(inference.NotJson, ValueError)
    b = inference.HttpBackend("http://x", "m", think=False, extra={"top_k": 1})
    assert b.extra == {"chat_template_kwargs": {"enable_thinking": False}, "top_k": 1} and b.calls == 0
