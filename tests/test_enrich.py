import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark.sql import functions as F
from test_pipeline import chat_items, corpus

from lectern import inference
from lectern.operators import enrich, meta, package, refine, resolve
from lectern.plans import counted
from lectern.sources import readers, writers

CHAT = "emberlamp/chatlogs"


def _make():
    def backend():
        class Fixed:
            def generate(self, prompt, schema, **options):
                keys = set(schema["properties"])
                if "sexual_axis" in keys:
                    return {"sexual_axis": "Clean", "violence_axis": "None", "toxicity_axis": "Bad" if "fail" in prompt else "Safe"}
                if "primary_genre" in keys:
                    return {"primary_genre": "Drama", "themes": ["Slow Burn", "slow-burn", "--"]}
                if "text" in keys:
                    return {"text": prompt.splitlines()[-1].removeprefix("Text: ").upper()}
                one = {"name": "Ann", "gender": "female", "pronouns": {"subjective": "she", "objective": "her", "possessive": "her"}, "core_traits": ["calm", "kind"], "appearance_details": []}
                return {"user_character": one, "bot_character": one | {"name": "Bob", "gender": "male"}}

        return Fixed()

    return backend


backend = _make()  # nested, so that workers get it by value


@pytest.fixture(scope="module")
def raw(spark):
    metas = [("a", "document", CHAT, "1", None), ("b", "document", CHAT, "2", None), ("c", "document", "other", "3", None)]
    items = [r for d in "abc" for r in chat_items(d, 2, category=False) if r[3] == "turn"]
    v = [(d, f"turn-{i:06d}", "original", "fail now" if d == "b" and i else f"said {i}") for d in "abc" for i in range(2)]
    return corpus(spark, metas, items, v)


def test_all_steps_make_a_healthy_document(spark, raw, data):
    c = raw
    for step in (enrich.refine_safety, enrich.refine_genre, enrich.refine_characters, enrich.refine_grammar):
        c = step(c, backend)
    c = refine.refine_language(c, spark.read.parquet(f"{data}/lang_samples.parquet"))
    h = {r.doc_uuid: r for r in meta.health(c).collect()}
    assert h["a"].is_healthy, h["a"].issues
    assert {i for i in h["b"].issues if "safety" in i or "toxicity" in i} == {"Missing 'refine-chat-safety-dials' annotation", "Unset toxicity categorization"} | {i for i in h["b"].issues if "axis" in i}
    first = c.items.where("doc_uuid = 'a'").orderBy("item_pos").collect()
    assert [(r.item_id, r.entity_id) for r in first[:2]] == [("character-000001", "user"), ("character-000002", "bot")]
    assert meta.resolve(c.items).where("doc_uuid = 'a'").first().themes == ["slow-burn"]
    ids = c.meta.where("doc_uuid = 'a'").first().identities
    assert [(i.entity_id, i.name, i.gender, i.is_player_controlled) for i in ids] == [("user", "Ann", "female", True), ("bot", "Bob", "male", False)]
    assert c.variants.where("name = 'refine-chat-grammar'").count() == 4 and c.variants.where("doc_uuid = 'a' and text like 'Name: Ann%Traits: calm; kind'").count() == 1
    again = enrich.refine_safety(enrich.refine_grammar(c, backend), backend)
    assert again.variants.count() == c.variants.count() and again.items.count() == c.items.count()


def test_budget(raw):
    assert enrich.refine_grammar(raw, backend, budget=3).variants.where("name = 'refine-chat-grammar'").count() == 3


def test_http_backend():
    class Handler(BaseHTTPRequestHandler):
        calls = 0

        def do_POST(self):
            Handler.calls += 1
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            code = {1: 429, 3: 500}.get(Handler.calls, 200)
            self.send_response(code)
            if code == 429:
                self.send_header("Retry-After", "7")
            self.end_headers()
            answer = json.dumps({"text": body["messages"][0]["content"] + self.headers["Authorization"]})
            self.wfile.write(json.dumps({"choices": [{"message": {"content": answer}}]}).encode() if code == 200 else b"")

        def log_message(self, *args):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    b, waits = inference.HttpBackend(f"http://127.0.0.1:{server.server_port}/", "m", "k"), []
    assert inference.call(b, "hi ", enrich.SCHEMAS["grammar"], wait=waits.append) == {"text": "hi Bearer k"} and waits == [7.0]
    with pytest.raises(ValueError):
        inference.call(b, "hi", enrich.SCHEMAS["grammar"])
    server.shutdown()


def test_package_and_restore(spark, raw, tmp_path):
    writers.json_lines(package.documents_json(raw), str(tmp_path / "p"))
    back = readers.restore(spark, str(tmp_path / "p"), raw.ledger)
    rows = lambda c: sorted(tuple(r) for r in c.items.select("doc_uuid", "item_pos", "item_id", "kind", "actor_id").withColumn("item_pos", F.col("item_pos") % 2).collect())
    assert rows(back) == rows(raw) and back.meta.where(f"source_identity = '{CHAT}'").count() == 2
    texts = lambda c: sorted(tuple(r) for r in c.variants.select("doc_uuid", "item_id", "name", "text").collect())
    assert texts(back) == texts(raw)


def test_proposal(spark):
    tags = spark.createDataFrame([(t, g) for t, g in [("slow burn", "Drama"), ("slow-burns", "Drama"), ("Slow Burn", "Comedy"), ("slow burns", None), ("heist", "Drama"), ("heist", "Drama"), ("once", "Drama")]], "tag string, genre string")
    clusters, work = resolve.proposal(tags, ["genre"], cut=0.5)
    assert {tuple(r.members) for r in clusters.collect()} == {("slow burn", "slow burns"), ("heist",)}
    w = {r.label: r for r in work.collect()}
    assert w["slow-burn"]["genre=Drama"] == 2 and w["slow-burn"]["genre=Unset"] == 1 and w["heist"]["genre=Drama"] == 2
    members = clusters.select("cluster_id", F.explode("members").alias("term"))
    cells = resolve.crosstab(tags.where("tag = 'heist'").withColumnRenamed("tag", "term"), ["genre"])
    assert resolve.cluster_counters(members, cells).first().counts == {"Drama": 2}


def test_counters(spark):
    df, seen = counted(spark.range(10), "job", even="id % 2 = 0")
    df.write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 10, "even": 5}
