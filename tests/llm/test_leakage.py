import random

import numpy as np

from lectern.llm.leakage import cgk, edit_distance, leaked_items, repetitions
from lectern.llm.words import words

DOCS, ITEMS = "doc_id long, text string, item_id long, k int", "item_id long, text string, t string"


def frames(spark, docs, items):
    return spark.createDataFrame([(k, t, 1, 2) for k, t in docs], DOCS), spark.createDataFrame([(k, t, "x") for k, t in items], ITEMS)


def brute(docs, items, n=12):
    ix = {}
    for k, t in items:
        ws = words(t or "")
        for i in range(len(ws) - n + 1):
            ix.setdefault(tuple(ws[i : i + n]), set()).add(k)
    return {(d, i) for d, t in docs if d is not None for j in range(len(words(t or "")) - n + 1) for i in ix.get(tuple(words(t)[j : j + n]), ())}


def test_matches_brute_force(spark):
    r = random.Random(2)
    w = lambda n: [f"x{r.randrange(40)}" for _ in range(n)]
    items = [(k, " ".join(w(r.choice([8, 12, 20, 40])))) for k in range(60)]
    docs = []
    for k in range(80):
        ws = w(30)
        for _ in range(2):
            src = r.choice(items)[1].split()
            i = r.randrange(len(src))
            ws[10:10] = src[i : i + r.choice([11, 12, 13])]
        docs.append((k, "; ".join(ws).upper()))
    d, i = frames(spark, docs, items)
    assert {(r.doc_id, r.item_id) for r in leaked_items(d, i).collect()} == brute(docs, items)
    assert {(r.doc_id, r.item_id) for r in leaked_items(d, i, block_items=13).collect()} == brute(docs, items)


def test_cases(spark):
    t = " ".join(f"w{i}" for i in range(14))
    docs = [(1, t), (1, t), (2, None), (3, ""), (None, t), (4, t.replace(" ", " -- ")), (5, " ".join(t.split()[:11])), (6, "z " * 20000 + t)]
    items = [(1, t), (2, t), (3, None), (4, "too short"), (5, "")]
    d, i = frames(spark, docs, items)
    assert {(r.doc_id, r.item_id) for r in leaked_items(d, i).collect()} == {(k, x) for k in (1, 4, 6) for x in (1, 2)}
    d, i = frames(spark, [], items)
    assert leaked_items(d, i).count() == 0
    d, i = frames(spark, docs, [])
    assert leaked_items(d, i).count() == 0


def test_edited_passages_reach_the_recall(spark):
    r = random.Random(5)
    items = [(k, " ".join(f"y{k}z{i}" for i in range(40))) for k in range(60)]
    docs = []
    for k, t in items:
        ws = t.split()
        at = r.randrange(14, 26)
        ws[at] = "changed"
        docs.append((k, " ".join(ws[10:34])))
    d, i = frames(spark, docs, items)
    got = {(x.doc_id, x.item_id) for x in leaked_items(d, i, window=20, max_edits=1, recall=0.95, sampled=4).collect()}
    assert len(got) >= 0.95 * len(items) and all(a == b for a, b in got)


def test_whole_items_with_edits_match_brute_force(spark):
    """Windows of the items' own lengths, 0 to 4 random edits: recall against all pairs, and no wrong pair; both ways of searching."""
    r = random.Random(8)
    items = [(k, " ".join(f"y{r.randrange(300)}" for _ in range(r.choice([11, 12, 15, 20, 33])))) for k in range(150)]
    docs = []
    for k, t in items:
        ws = t.split()
        for _ in range(r.randrange(5)):
            i, kind = r.randrange(len(ws)), r.randrange(3)
            if kind == 0:
                ws[i] = "changed"
            elif kind == 1:
                ws.insert(i, "more")
            else:
                del ws[i]
        docs.append((k, " ".join([f"b{r.randrange(50)}" for _ in range(r.randrange(20))] + ws + [f"a{r.randrange(50)}" for _ in range(r.randrange(20))])))
    want = set()
    for d, text in docs:
        ws = text.split()
        for i, t in items:
            x = t.split()
            if len(x) >= 12 and any(edit_distance(ws[a : a + len(x)], x, 2) <= 2 for a in range(len(ws) - len(x) + 1)):
                want.add((d, i))
    a, b = frames(spark, docs, items)
    for block in (20_000, 10):
        got = {(x.doc_id, x.item_id) for x in leaked_items(a, b, window=None, max_edits=2, recall=0.95, sampled=4, block_items=block).collect()}
        assert got <= want and len(got) >= 0.9 * len(want) > 50, (len(got), len(want))


def test_embedding_keeps_equal_windows_and_distances():
    rng = np.random.default_rng(1)
    h = rng.integers(1, 1 << 60, 200).astype(np.uint64)
    two = np.concatenate([h, h])
    e = cgk(two, 12, 3, np.array([5, 205]))
    assert (e[0] == e[1]).all()
    far = cgk(two, 12, 3, np.array([5, 60]))
    inside = (far != 0).all(axis=0)
    assert inside.sum() >= 12 and (far[0] != far[1])[inside].all()
    assert edit_distance([1, 2, 3, 4], [1, 3, 4, 5], 4) == 2 and edit_distance([1] * 9, [2] * 9, 3) == 4
    assert repetitions(0, 0.95, 6, 12) == 1 and repetitions(2, 0.99, 6, 20) > repetitions(1, 0.9, 6, 20)
