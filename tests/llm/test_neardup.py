import random
import re

import numpy as np
import pytest

from lectern.llm import neardup
from lectern.llm.neardup import expanded_pairs, groups, near_duplicates

SCHEMA = "id long, text string, c string, frag int, __key string"


def sets(rows, n, least):
    out = {}
    for k, t in rows:
        ws = [w.lower() for w in re.findall(r"[^\W_]+", t or "")]
        if k is not None and len(ws) >= max(n, least):
            out[k] = set(zip(*(ws[i:] for i in range(n))))
    return out


def brute(rows, t, n, least=0):
    s = sorted(sets(rows, n, least).items())
    return {(a, b) for i, (a, x) in enumerate(s) for b, y in s[i + 1 :] if len(x & y) >= t * len(x | y) - 1e-12}


def frame(spark, rows):
    return spark.createDataFrame([(k, t, "x", 1, "y") for k, t in rows], SCHEMA)


def edited(seed, n_docs=50):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(120)]
    rows, k = [], 0
    for _ in range(n_docs):
        ws = [r.choice(vocabulary) for _ in range(r.choice([12, 45, 60, 130, 300]))]
        rows.append((k, " ".join(ws)))
        k += 1
        for _ in range(r.randrange(3)):
            v = list(ws)
            for _ in range(r.randrange(0, max(1, len(v) // 8))):
                i = r.randrange(len(v))
                op = r.randrange(3)
                if op == 0:
                    v[i] = r.choice(vocabulary)
                elif op == 1:
                    v.insert(i, r.choice(vocabulary))
                elif len(v) > 6:
                    del v[i]
            rows.append((k, ", ".join(v)))
            k += 1
    return rows


@pytest.mark.parametrize("t,n,least", [(0.5, 3, 40), (0.8, 5, 0), (0.5, 1, 0)])
def test_matches_brute_force(spark, t, n, least):
    rows = edited(int(t * 10) + n)
    got = {(r.id_a, r.id_b) for r in expanded_pairs(near_duplicates(frame(spark, rows), "id", "text", t, n, least)).collect()}
    assert got == brute(rows, t, n, least)


@pytest.mark.parametrize("load,hot", [(50, 1), (300, 3)])
def test_many_ranges_and_split_lists(spark, load, hot):
    rows = edited(9) + [(1_000 + i, " ".join(["same words stand in each of these texts"] * 6 + [f"end{i % 7}"])) for i in range(25)]
    got = {(r.id_a, r.id_b) for r in expanded_pairs(near_duplicates(frame(spark, rows), "id", "text", 0.5, 3, 0, load=load, hot=hot)).collect()}
    assert got == brute(rows, 0.5, 3)


def test_cases(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(1, text), (2, text.upper()), (3, text.replace(" ", ". ")), (4, None), (5, ""), (6, "short text"), (None, text), (7, text + " more"), (8, "q " * 3000), (9, "q " * 3000), (1, text)]
    found = near_duplicates(frame(spark, rows), "id", "text", 0.5, 3, 40)
    got = {(r.id_a, r.id_b) for r in expanded_pairs(found).collect()}
    assert got == {(1, 2), (1, 3), (2, 3), (1, 7), (2, 7), (3, 7), (8, 9)}
    per = {r.id: r for r in groups(found).collect()}
    assert {per[k].group_id for k in (1, 2, 3, 7)} == {1} and per[9].group_id == 8 and per[7].n_links == 1 and per[1].n_copies == 3
    empty = near_duplicates(frame(spark, []), "id", "text")
    assert expanded_pairs(empty).count() == 0 and groups(empty).count() == 0


def test_threshold_is_inclusive_and_tags_count_as_blanks(spark):
    a = " ".join(f"a{i}" for i in range(8))
    rows = [(1, a), (2, " ".join(a.split()[:4] + [f"b{i}" for i in range(4)])), (3, a.replace(" ", "<b>"))]
    got = {(r.id_a, r.id_b): r.similarity for r in expanded_pairs(near_duplicates(frame(spark, rows), "id", "text", 1 / 3, 1, 0, True)).collect()}
    assert got == {(1, 2): 1 / 3, (2, 3): 1 / 3, (1, 3): 1.0}


def test_hot_group_of_copies(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(k, text + "!" * k) for k in range(200)] + [(1000 + k, " ".join(f"v{k}x{i}" for i in range(50))) for k in range(100)]
    found = near_duplicates(frame(spark, rows), "id", "text", 0.5, 3, 40)
    assert found.links.count() == 0
    assert {r.group_id for r in groups(found).where("id < 1000").collect()} == {0}


def test_only_pairs_within_the_bounds_are_made():
    """Long lists give the pairs that sizes and places let through, each once, and no others: before, all pairs were made and then dropped."""
    rng = np.random.default_rng(1)
    for t in (0.3, 0.5, 2 / 3, 0.8, 1.0) * 12:
        m = int(rng.integers(0, 60))
        group, n = np.sort(rng.integers(0, 4, m)), rng.integers(1, 60, m)
        place = (rng.random(m) * (n - np.ceil(t * n - 1e-9) + 1)).astype(np.int64)
        need = neardup.needed(n[:, None], n, t)
        within = (group[:, None] == group) & (need <= (n - place)[:, None]) & (need <= n - place)
        want = list(zip(*np.nonzero(np.triu(within, 1))))
        for limit in (7, 1 << 20):
            got = [(min(x), max(x)) for i, j in neardup._near(group, n, place, t, limit) for x in zip(i, j)]
            assert sorted(got) == want
