import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lectern.llm.spans import Chunk, Cuts, shared_records, shared_shares, shared_spans, without_repeated_spans

SCHEMA = "doc_id long, text string, h string, __key string, at int"


def brute(rows, size=240):
    own, hit = {}, set()
    for k, t in rows:
        for i in range(len(t or "") - size + 1):
            o = own.setdefault(t[i : i + size], k)
            if o != k:
                hit |= {o, k}
    return hit


def frame(spark, rows):
    return spark.createDataFrame([(k, t, "x", "y", 1) for k, t in rows], SCHEMA)


def corpus(seed):
    r = random.Random(seed)
    letters = "abcdefgh drn,. ;\n" if seed % 2 else "abcdefghijk    mnopqrst"
    make = lambda n: "".join(r.choice(letters) for _ in range(n))
    rows = []
    for k in range(0, 24, 2):
        shared = make(r.choice([200, 238, 239, 240, 241, 260, 400]))
        rows += [(k, make(r.randrange(0, 300)) + shared + make(r.randrange(0, 300))), (k + 1, make(r.randrange(0, 300)) + shared + make(r.randrange(0, 300)))]
    return rows


def test_matches_brute_force(spark):
    for seed in range(6):
        rows = corpus(seed)
        got = {r.doc_id for r in shared_spans(frame(spark, rows)).collect()}
        assert got == brute(rows) == {r.doc_id for r in shared_records(frame(spark, rows)).collect()}


def test_cases(spark, sentence):
    body = " ".join(sentence() for _ in range(8))
    rows = [(1, body), (2, body), (2, body), (3, None), (4, ""), (5, "x" * 5000), (6, "y" * 100 + "x" * 4000), (None, body), (7, "é" * 239), (8, "é" * 239 + "a"), (9, body[:230])]
    got = {(r.doc_id, r.span_begin, r.span_end, r.is_first) for r in shared_spans(frame(spark, rows)).collect()}
    assert got == {(1, 0, len(body), True), (2, 0, len(body), False), (5, 0, 5000, True), (6, 100, 4100, False)}
    assert shared_spans(frame(spark, [])).count() == 0
    shares = {r.doc_id: r for r in shared_shares(frame(spark, rows)).collect()}
    assert shares[1].shared_share == 1.0 and shares[1].removable_chars == 0 and shares[2].removable_chars == len(body)
    assert shares[3].n_chars == 0 and shares[4].shared_share == 0.0 and set(shares) == set(range(1, 10))


def test_repeated_sentences_are_removed_once(spark, sentence):
    shared = " ".join(sentence() for _ in range(6))
    own = [sentence() for _ in range(2)]
    rows = [(1, f"{own[0]} {shared}"), (2, f"{own[1]} {shared} tail stays")]
    kept = {r.doc_id: r.kept_text for r in without_repeated_spans(frame(spark, rows)).collect()}
    assert kept[1] == rows[0][1]
    assert kept[2].startswith(own[1]) and "tail stays" in kept[2] and len(kept[2]) < len(own[1]) + 40


def test_hot_span_is_found_in_every_record(spark, sentence):
    passage = " ".join(sentence() for _ in range(5))
    rows = [(k, f"{sentence()} {passage} {sentence()}") for k in range(60)] + [(100 + k, " ".join(sentence() for _ in range(4))) for k in range(120)]
    assert {r.doc_id for r in shared_spans(frame(spark, rows)).collect()} == set(range(60))


@pytest.mark.parametrize("size", [12, 28, 60, 130])
def test_other_lengths_match_brute_force(spark, size):
    r = random.Random(size)
    rows = []
    for k in range(0, 40, 2):
        make = lambda n: "".join(r.choice("abcdefghk drn,. ;\n") for _ in range(n))
        shared = make(r.choice([size - 2, size - 1, size, size + 1, 2 * size, 5 * size]))
        rows += [(k, make(r.randrange(0, 2 * size)) + shared + make(r.randrange(0, 99))), (k + 1, make(r.randrange(0, 99)) + shared + make(r.randrange(0, 2 * size)))]
    assert {x.doc_id for x in shared_records(frame(spark, rows), min_chars=size).collect()} == brute(rows, size)


def test_spans_and_shares_match_brute_force(spark):
    """Copies, passages inside longer copies and boilerplate, character by character."""
    r = random.Random(7)
    make = lambda n: "".join(r.choice("abcdefgh drn,. ;\n") for _ in range(n))
    long, foot = make(1500), make(270)
    rows = [(0, make(90) + long[300:560] + make(80)), (1, make(100) + long + make(50)), (2, make(33) + long + foot), (3, long[:700] + make(90) + foot + make(9)), (4, make(40) + long[650:1100] + make(70))]
    rows += [(k, make(60) + foot + make(60)) for k in range(5, 20)] + [(20, long), (21, long), (22, make(400))]
    own: dict[str, set[int]] = {}
    for k, t in rows:
        for i in range(len(t) - 239):
            own.setdefault(t[i : i + 240], set()).add(k)
    want, removable = {}, {}
    for k, t in rows:
        at, late = np.zeros(len(t) + 1, bool), np.zeros(len(t) + 1, bool)
        for i in range(len(t) - 239):
            keys = own[t[i : i + 240]]
            at[i : i + 240] |= len(keys) > 1
            late[i : i + 240] |= min(keys) < k
        want[k], removable[k] = int(at.sum()), int(late.sum())
    got = {x.doc_id: (x.shared_chars, x.removable_chars) for x in shared_shares(frame(spark, rows)).collect()}
    assert got == {k: (want[k], removable[k]) for k in want}
    spans = {}
    for x in shared_spans(frame(spark, rows)).collect():
        spans[x.doc_id] = spans.get(x.doc_id, 0) + x.span_end - x.span_begin
    assert spans == {k: n for k, n in want.items() if n}


def test_record_that_shares_only_with_one_that_has_a_run_elsewhere(spark, sentence):
    """What 3 shares with 1 lies beside the run that 1 shares with 2, and begins and ends within sentences."""
    a, b = (" ".join(sentence() for _ in range(6)) for _ in "ab")
    rows = [(1, f"{a} {b}"), (2, f"{sentence()} {a} {sentence()}"), (3, f"{sentence(3)} {b[30:275]} {sentence(3)}"), (4, f"{sentence(3)} {b[30:260]} {sentence(3)}")]
    assert {x.doc_id for x in shared_records(frame(spark, rows)).collect()} == brute(rows) == {1, 2, 3}
    assert {x.doc_id for x in shared_spans(frame(spark, rows)).collect()} == {1, 2, 3}


def test_first_holder_keeps_its_part(spark, sentence):
    """A stretch made of a passage first seen here and one seen before loses only the latter."""
    a, b = (" ".join(sentence() for _ in range(6)) + " " for _ in "ab")
    rows = [(1, f"{sentence()} {b}"), (2, a + b), (3, f"{a}{sentence()}")]
    kept = {x.doc_id: x.kept_text for x in without_repeated_spans(frame(spark, rows)).collect()}
    assert kept[1] == rows[0][1] and kept[2].startswith(a[:-1]) and len(kept[2]) < len(a) + 60 and len(kept[3]) < 200


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab .,;dn\né", max_size=600), min_size=1, max_size=4), st.sampled_from([28, 60, 240]))
def test_cuts_are_ordered_and_close(texts, size):
    rule = Cuts(size)
    c = Chunk(texts, rule)
    assert (np.diff(c.cuts) > 0).all() and np.isin(c.begin, c.cuts).all() and np.isin(c.end, c.cuts).all() and np.isin(c.firm, c.cuts).all()
    joined = "\0".join([*texts, ""])
    assert all(b - a <= rule.long for a, b in zip(c.cuts.tolist(), c.cuts[1:].tolist()) if joined[a:b].strip())
    assert all(rule.run <= b - a < rule.run + rule.long for a, b in zip(c.seed.tolist(), c.stop.tolist()) if joined[a:b].strip())
    assert all(c.begin[k] <= a < b <= c.end[k] for a, b, k in zip(c.seed, c.stop, c.of))
