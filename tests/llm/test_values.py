"""Canonical values, term frequency, splitting and mixing."""

import random
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lectern.llm import canonical, frequency, mixing, splitting

LIST = [(1, "slow-burn", ["gradual romance"]), (2, "magic-school", ["wizard academy", "school of magic"]), (3, "treasure-hunt", None), (4, None, ["heist"]), (5, "ghost-story", ["phantom tale"])]


def entries(spark, rows=LIST):
    return spark.createDataFrame(rows, "theme_id int, theme string, aliases array<string>")


def tags(spark, rows):
    return spark.createDataFrame([(k, t, "v", 7) for k, t in rows], "response_id long, themes array<string>, value string, theme_id int")


def test_tags_find_their_entry(spark):
    said = ["slow-burn", "Slow_Burn", "slwo-burn", "lots of magic school", "theme: wizard academy", "MagicSchool", "treasure hutn!!", "heist", "treasure", "plumbing", None, " ", "", "phàntom tale"]
    got = {r.tag_no: r.theme_id for r in canonical.map_tags(tags(spark, [(1, said)]), entries(spark)).collect()}
    assert got == {1: 1, 2: 1, 3: 2, 4: 2, 5: 2, 6: 3, 7: 4, 8: 3, 9: -1, 13: 5}


def test_tag_cases(spark):
    rows = [(1, None), (2, []), (3, ["x" * 20000]), (3, ["x" * 20000]), (4, ["Slow Burn", "Slow Burn"])]
    got = sorted(tuple(r) for r in canonical.map_tags(tags(spark, rows), entries(spark)).select("response_id", "tag_no", "theme_id").collect())
    assert got == [(3, 0, -1), (3, 0, -1), (4, 0, 1), (4, 1, 1)]
    assert canonical.map_tags(tags(spark, []), entries(spark)).count() == 0
    assert [r.theme_id for r in canonical.map_tags(tags(spark, [(1, ["a"])]), entries(spark, [])).collect()] == [-1]


def test_ties_between_entries_stay_unmatched(spark):
    listed = [(1, "red house", ["home", "cabin"]), (2, "red mouse", ["home"])]
    got = {r.tag: r.theme_id for r in canonical.map_tags(tags(spark, [(1, ["red louse", "Red-House", "home", "HOME ", "cabins"])]), entries(spark, listed)).collect()}
    assert got == {"red louse": -1, "Red-House": 1, "home": -1, "HOME ": -1, "cabins": 1}


def test_blocks_of_entries_give_the_same(spark):
    r = random.Random(2)
    word = lambda: "".join(r.choice("bcdfglmnprst") + r.choice("aeiou") for _ in range(r.randrange(2, 5)))
    listed = [(i, f"{word()} {word()}", [word()] if i % 3 else None) for i in range(120)]
    said = [(i, [x.replace("a", "e", 1), x[1:], x + " x", word()]) for i, (_, x, _) in enumerate(listed)]
    one = {tuple(x)[:2] for x in canonical.map_values(tags(spark, [(k, t) for k, t in said]).selectExpr("explode(themes) as v"), entries(spark, listed), "v").collect()}
    many = {tuple(x)[:2] for x in canonical.map_values(tags(spark, [(k, t) for k, t in said]).selectExpr("explode(themes) as v"), entries(spark, listed), "v", block_entries=17).collect()}
    assert one == many and sum(k >= 0 for _, k in one) > 150


def test_index_equals_dense_cosine():
    import numpy as np

    rows = [(1, "red house"), (1, "crimson home"), (5, "blue bird"), (9, "green apple tree")]
    weight = np.random.default_rng(3).random(1 << canonical.BITS)
    e, g = canonical.Entries(rows, weight), canonical.Grams()

    def vector(text):
        v = np.zeros(1 << canonical.BITS)
        np.add.at(v, g.of(canonical.fold(text)), 1)
        v *= weight
        return v / np.linalg.norm(v)

    for value in ("reed house", "tree green apple", "birds", "blue home"):
        best = {k: max(vector(value) @ vector(f) for i, n in rows if i == k for f in canonical.turned(n)) for k, _ in rows}
        order = sorted(best.values())
        k, top, other = e.best([value])
        assert best[int(k[0])] == order[-1] and abs(top[0] - order[-1]) < 1e-9 and abs(other[0] - order[-2]) < 1e-9
        for least in (0.35, 0.48):
            k2, top2, other2 = e.best([value, "zzz"], least)
            if top[0] >= least:
                assert k2[0] == k[0] and abs(top2[0] - top[0]) < 1e-9 and (other[0] < least or abs(other2[0] - other[0]) < 1e-9)
            assert k2[1] == -1 and top2[1] == 0


def test_term_frequency_matches_counting(spark):
    r = random.Random(1)
    rows = [(f"d{r.randrange(30)}", [r.choice(["A b", "a-b", "a_b ", "c", "C", "e f", " ", None, "zz%d" % r.randrange(20)]) for _ in range(r.randrange(5))]) for _ in range(80)] + [("hot", ["c", "c", "a b"])] * 150 + [("n", None), (None, ["c"])]
    got = {x.term: (x.n_uses, x.n_records, x.mark) for x in frequency.term_frequency(spark.createDataFrame([(d, t, "q", 1) for d, t in rows], "doc_uuid string, themes array<string>, term string, id int"), "doc_uuid", "themes").collect()}
    uses, held = Counter(), set()
    for d, ts in rows:
        for t in ts or []:
            t = re.sub(r"[\s_\-]+", " ", (t or "").lower()).strip()
            if t:
                uses[t] += 1
                held.add((d, t))
    n = Counter(t for _, t in held)
    every = len({d for d, _ in held})
    assert got == {t: (uses[t], n[t], "rare" if n[t] < 3 else "common" if n[t] > every / 10 else None) for t in uses}
    assert frequency.term_frequency(spark.createDataFrame([], "doc_uuid string, themes array<string>"), "doc_uuid", "themes").count() == 0


def test_terms_beyond_one_range_of_identifiers(spark):
    rows = [(f"d{i % 7}", [f"t{i}", "same"]) for i in range(3 * frequency.RANGE)]
    got = frequency.term_frequency(spark.createDataFrame(rows, "r string, t array<string>").repartition(5), "r", "t")
    assert got.count() == len(rows) + 1 and got.where("term = 'same'").first().n_records == 7


TEXT = st.lists(st.sampled_from(["word", "an", "extraordinarily", ". ", "! ", " ", " ", "\n\n", "\n", "é…  ", "x" * 60]), max_size=120).map("".join)


@settings(max_examples=200, deadline=None)
@given(TEXT, st.integers(20, 90), st.integers(0, 15))
def test_pieces_cover_the_text(text, limit, overlap):
    ends = splitting.boundaries(text)
    parts = splitting.pieces(len(text), limit, overlap, [(k, ends[k]) for k in ("paragraph", "sentence", "word")])
    assert parts[0][0] == 0 and parts[-1][1] == len(text)
    assert all(b - a <= limit for a, b, _ in parts) and all(y[0] == x[1] - overlap for x, y in zip(parts, parts[1:]))
    back = text[: parts[0][1]] + "".join(text[a + overlap : b] for a, b, _ in parts[1:])
    assert back == text
    for a, b, kind in parts[:-1]:
        inside = lambda k: [e for e in ends[k] if a + overlap < e <= a + limit]  # noqa: B023,E731
        want = next((k for k in ("paragraph", "sentence", "word") if inside(k)), "hard")
        assert kind == want and (b == max(inside(kind)) if kind != "hard" else b == a + limit)


def test_splitting_cases(spark):
    p = "Short paragraph here.\n\n"
    rows = [(1, p * 200), (2, None), (3, ""), (4, "a" * 2000), (5, "a" * 2001), (6, "w " * 1500), (7, ("s" * 50 + ". ") * 60), (None, "a" * 3000), (1, p * 200)]
    got = splitting.split_texts(spark.createDataFrame([(k, t, "z") for k, t in rows], "variant_id long, text string, obj string"), "variant_id", "text").collect()
    assert {(r.obj_key, r.finest) for r in got} == {(1, "paragraph"), (5, "none"), (6, "word"), (7, "sentence")}
    assert all(len(r.piece_text) <= 2000 for r in got)
    items = spark.createDataFrame([(1, ["i"] * 100), (2, ["i"] * 101), (3, None), (4, []), (5, [str(i) for i in range(1000)])], "item_key long, item_ids array<string>")
    seq = splitting.split_sequences(items, "item_key", "item_ids").orderBy("obj_key", "piece_no").collect()
    assert {r.obj_key for r in seq} == {2, 5} and [(r.piece_begin, r.piece_end) for r in seq if r.obj_key == 2] == [(0, 100), (90, 101)]
    assert splitting.split_texts(spark.createDataFrame([], "k long, t string"), "k", "t").count() == 0
    with pytest.raises(ValueError):
        splitting.split_texts(items, "item_key", "item_ids", limit=5, overlap=5)


def mix(spark, rows, targets, **kw):
    docs = spark.createDataFrame([(k, t, s, 1, 2) for k, t, s in rows], "doc_id long, text string, source string, block int, shard int")
    return mixing.mix_sources(docs, spark.createDataFrame(targets, "source string, target_share double, max_repeats int"), **kw)


def test_mix_reaches_its_shares(spark):
    r = random.Random(3)
    rows = [(k, "some words " * r.randrange(1, 30), r.choice(["big", " BIG", "B i g", "big", "mid", "small"])) for k in range(3000)] + [(9000, None, "big"), (9001, "", "big"), (9002, "lost", None), (9003, "lost", "other")]
    m = mix(spark, rows, [("big", 0.5, 1), ("mid", 0.3, 3), ("small", 0.15, 4), ("absent", 0.05, 2)], shards=8)
    chosen = m.chosen.collect()
    shares = {s.source: s for s in m.shares.collect()}
    assert not shares["absent"].reachable and shares["absent"].n_chosen == 0
    for s, share in (("big", 0.5), ("mid", 0.3), ("small", 0.15)):
        assert abs(shares[s].share_reached - share / 0.95) < 0.005 and shares[s].repeats <= shares[s].max_repeats
    assert len({(c.doc_id, c.pass_no) for c in chosen}) == len(chosen) and max(Counter(c.doc_id for c in chosen).values()) <= 4
    assert {c.doc_id for c in chosen} & {9000, 9001, 9002, 9003} == set() and {c.shard for c in chosen} == set(range(8))
    again = {(c.doc_id, c.pass_no, c.shard) for c in mix(spark, rows, [("big", 0.5, 1), ("mid", 0.3, 3), ("small", 0.15, 4), ("absent", 0.05, 2)], shards=8).chosen.collect()}
    assert again == {(c.doc_id, c.pass_no, c.shard) for c in chosen}


def test_mix_of_nothing(spark):
    m = mix(spark, [], [("a", 1.0, 1)])
    assert m.chosen.count() == 0 and m.shares.first().share_reached == 0.0
    assert mix(spark, [(1, "x", "a")], []).chosen.count() == 0


def test_quotas_sum_exactly():
    import numpy as np

    q = mixing.split_quotas([100, 7, 0, 33], 12, np.random.default_rng(1))
    assert q.sum(axis=0).tolist() == [100, 7, 0, 33] and q.sum(axis=1).max() - q.sum(axis=1).min() <= 4


def test_tokens_read_back(spark):
    import tiktoken
    import public_tokenizers as P
    import base64

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(mixing.vocabulary_path(), "rb"))}
    code = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    text = "Héllo <|endoftext|> wörld\n\n 12345"
    assert code.decode(code.encode_ordinary(text)) == text
    docs = spark.createDataFrame([(1, text, "S x")], "k long, text string, source string")
    r = mixing.token_counts(docs, "k", "text", "source").first()
    assert r.n_tokens == len(code.encode_ordinary(text)) and r.source == "sx"


@pytest.mark.parametrize("fine", [1, 7, 2_000])
def test_a_block_is_cut_where_its_room_ends(spark, fine):
    r = random.Random(6)
    rows = [(k, s, r.randrange(-(1 << 63), 1 << 63), r.randrange(1, 50)) for k, s in enumerate(["a"] * 300 + ["b"] * 40 + ["c"] * 5)]
    room = {"a": 2_500, "b": 1, "c": 10_000}
    want = set()
    for s, left in room.items():
        for k, _, _, n in sorted((x for x in rows if x[1] == s), key=lambda x: x[2]):
            left -= n
            if left < 0:
                break
            want.add(k)
    df = spark.createDataFrame(rows, "doc_id long, source string, shuffle_key long, n_tokens int")
    got = mixing._upto(df, {s: (0, 0, left, 0) for s, left in room.items()}, "doc_id", fine)
    assert {x.doc_id for x in got.collect()} == want
