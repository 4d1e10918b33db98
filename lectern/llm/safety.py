"""Abusive, hateful or sexual content (problem 2).

Method: a bidirectional gated recurrent network with attention pooling over character and word inputs,
trained in numpy on labelled passages, which scores all overlapping windows of a text.

* Tokens are words and the marks ``" “ ” « » ! ?``. A token's input is the sum of a learnt word vector (if
  the word was seen in training) and of learnt vectors of its hashed character n-grams, so that misspelt
  and unseen words are read by their letters. Characters written for letters (``$`` for s and so on) and
  letters drawn out are undone first.
* Two GRUs read the whole text in both directions. For every run of ``WINDOW`` tokens, beginning at every token (the
  whole text if it is shorter), attention weights over their joint states, one set for each axis, pool them, and a
  logistic unit per axis gives the window's score. As weights and values are sums over tokens, all windows of
  a text come from sliding sums.
* A text's score is the greatest of its windows'.

A label of a passage says that some window of it is a case, so in training the greatest window of a passage bears its
label. Training data is small, so each step builds new passages: labelled ones are put at random places
between clean passages, names are exchanged, and words are dropped from the word input. Documents with
a noisy label (an opinion, not the truth) add weakly labelled sentences: of a flagged document the sentence
whose words are many times more frequent in flagged than in clean documents, if such words occur together
in flagged documents mostly; and clean sentences that the network scores high, over several rounds.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.words import plain
from lectern.plans import cut_lineage, join_checked

WINDOW, WIDTH, HIDDEN, GRAMS = 24, 24, 16, 1 << 12
#: Bound of the attention's exponents, and least length of a training passage.
STEEP, LONG = 20.0, 48
#: Tokens that are scored side by side.
PLACES = 1 << 18
AXES = ("sexual", "toxicity")
TOKEN = re.compile(r"[^\W_]+(?:[$@*!]+[^\W_]+|[$@]+(?=\W|$))*|[\"“”«»!?]")
_HIDDEN = re.compile("[\u00ad\u200b-\u200f\u2060\ufeff]")
_SPACED = re.compile(r"(?<![^\W_])[^\W\d_](?:[ ._-][^\W\d_]){3,}(?![^\W_])")
_SPLIT = re.compile(r"(?<=[a-zà-ÿа-я])[._](?=[a-zà-ÿа-я])")

# Characters written for letters.
LOOKALIKE = str.maketrans({"$": "s", "@": "a", "0": "o", "1": "i", "!": "i", "3": "e", "4": "a", "5": "s", "*": "u"})
_DRAWN = re.compile(r"([^\W\d_])\1{2,}")


def apart(letters: str, words: set[str] | frozenset[str]) -> str:
    """Letters written one by one, as the fewest known words that they make up, or else as one word."""
    low, best = letters.lower(), [(0, 0)]
    for j in range(1, len(letters) + 1):
        best.append(min(((best[i][0] + 1, i) for i in range(max(0, j - 24), j) if low[i:j] in words), default=(len(letters) + 1, 0)))
    if best[-1][0] > len(letters):
        return letters
    out, j = [], len(letters)
    while j:
        out.append(letters[best[j][1] : j])
        j = best[j][1]
    return " ".join(reversed(out))


def tokens(text: str, words: set[str] | frozenset[str] = frozenset()) -> list[str]:
    """Tokens of a text after undoing invisible characters, letters spaced out and marks put into words."""
    text = plain(text)
    if not text.isascii():
        text = _HIDDEN.sub("", text)
    text = _SPACED.sub(lambda m: apart(m[0][::2], words), text)
    return TOKEN.findall(_SPLIT.sub("", text))


@functools.lru_cache(1 << 16)
def normal(token: str) -> str:
    """A token in lower case, with letters restored that other characters stand for or that are drawn out."""
    t = token.lower()
    if any(c.isalpha() for c in t):
        if "**" in t:
            return t
        if not t.isalpha():
            t = t.translate(LOOKALIKE)
        t = _DRAWN.sub(r"\1", t)
    elif t[0].isdigit():
        t = "0"
    return t


def char_grams(token: str) -> list[int]:
    p = f"<{token}>"
    return [xxhash.xxh32_intdigest(p[i : i + k]) % GRAMS for k in (3, 4) for i in range(max(1, len(p) - k + 1))]


class Network:
    """Parameters and passes of the network; float32 throughout."""

    def __init__(self, vocabulary: list[str], rng: np.random.Generator) -> None:
        self.ids = {w: i + 1 for i, w in enumerate(vocabulary)}  # 0: no word
        k, h = WIDTH, HIDDEN
        s = lambda *shape, a=0.1: rng.normal(0, a, shape).astype(np.float32)
        self.p = {"word": s(len(vocabulary) + 1, k), "char": s(GRAMS, k)}
        self.p["word"][0] = 0
        for d in "fb":
            self.p |= {f"W{d}": s(k, 3 * h, a=0.3), f"U{d}": s(h, 3 * h, a=0.3), f"c{d}": np.zeros(3 * h, np.float32)}
        self.p |= {"A": s(2 * h, 2, a=0.3), "v": s(2, 2 * h, a=0.3), "o": np.array([-1.0, -1.0], np.float32)}

    @staticmethod
    def _gate(x: np.ndarray) -> np.ndarray:
        return 0.5 + 0.5 * np.tanh(0.5 * x)

    def read(self, z: np.ndarray, d: str, mask: np.ndarray) -> tuple[np.ndarray, list]:
        """States of one direction. z: (time, batch, 3h) inputs to the gates, bias included; places off the mask have state 0."""
        h, U = HIDDEN, self.p[f"U{d}"]
        T, B, _ = z.shape
        state = np.zeros((B, h), np.float32)
        out, tape = np.empty((T, B, h), np.float32), []
        for t in range(T) if d == "f" else range(T - 1, -1, -1):
            u = state @ U
            g = self._gate(z[t, :, : 2 * h] + u[:, : 2 * h])
            r, a = g[:, :h], g[:, h:]
            n = np.tanh(z[t, :, 2 * h :] + r * u[:, 2 * h :])
            new = (n + a * (state - n)) * mask[t][:, None]
            tape.append((t, state, u[:, 2 * h :], r, a, n))
            out[t] = state = new
        return out, tape

    def best_windows(self, e: np.ndarray, value: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """(T, B, 2): the places of each passage's greatest window on each axis."""
        T, B, _ = e.shape
        p = np.where(mask[..., None], np.exp(np.clip(e, -STEEP, STEEP)), 0).astype(np.float64)
        total, mean = sliding(p), sliding(p * value)
        logit = mean / np.maximum(total, 1e-30)
        first = np.arange(T)[:, None, None]
        last = np.maximum(mask.sum(axis=0) - WINDOW, 0)[None, :, None]
        at = np.where(first <= last, logit, -np.inf).argmax(axis=0)[None]
        return (first >= at) & (first < at + WINDOW) & mask[..., None]

    def pool(self, s: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, ...]:
        """Attention over each axis' own places (T, B, 2): weights, pooled (B, 2, 2h), logits (B, 2)."""
        e = np.clip(s @ self.p["A"], -STEEP, STEEP)
        e = np.where(mask, e, -1e9)
        w = np.exp(e - e.max(axis=0))
        w /= w.sum(axis=0)
        c = np.einsum("tba,tbh->bah", w, s)
        return w, c, np.einsum("bah,ah->ba", c, self.p["v"]) + self.p["o"]

    @staticmethod
    def _sums(n: int, at: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Rows summed by their number in ``at``."""
        o = np.argsort(at, kind="stable")
        begin = np.flatnonzero(np.append(True, np.diff(at[o]) != 0))
        out = np.zeros((n, rows.shape[1]), rows.dtype)
        out[at[o][begin]] = np.add.reduceat(rows[o], begin)
        return out

    def step(self, word: np.ndarray, rows: np.ndarray, grams: tuple[np.ndarray, np.ndarray], mask: np.ndarray, y: np.ndarray, share: np.ndarray | None = None) -> tuple[float, dict[str, np.ndarray]]:
        """Loss and gradients. word, rows: (T, B) ids of words and of tokens, whose n-grams ``grams`` lists (ids, counts by token)."""
        p, h = self.p, HIDDEN
        T, B = word.shape
        share = np.ones((T, B, 1), p["char"].dtype) if share is None else share[..., None]
        used, of = np.unique(rows, return_inverse=True)
        of, (flat_grams, count) = of.reshape(T, B), _picked(*grams, used)
        x = p["word"][word] + share * _mean_grams(p["char"], flat_grams, count)[of]
        z = {d: x @ p[f"W{d}"] + p[f"c{d}"] for d in "fb"}
        run = {d: self.read(z[d], d, mask) for d in "fb"}
        s = np.concatenate([run["f"][0], run["b"][0]], axis=2)
        live, mask = mask, self.best_windows(s @ p["A"], s @ p["v"].T, mask)
        w, c, logit = self.pool(s, mask)
        prob = self._gate(logit)
        loss = -np.mean(y * np.log(prob + 1e-7) + (1 - y) * np.log(1 - prob + 1e-7))
        dl = (prob - y) / B
        g = {"o": dl.sum(axis=0), "v": np.einsum("ba,bah->ah", dl, c)}
        dc = dl[:, :, None] * p["v"]
        dw = np.einsum("bah,tbh->tba", dc, s)
        ds = np.einsum("tba,bah->tbh", w, dc)
        de = w * (dw - (w * dw).sum(axis=0))
        g["A"] = np.einsum("tbh,tba->ha", s, de)
        ds += de @ p["A"].T
        dx = np.zeros_like(x)
        for i, d in enumerate("fb"):
            U, dz = p[f"U{d}"], np.empty_like(z[d])
            dU, dstate = np.zeros_like(U), np.zeros((B, h), np.float32)
            for t, state, un, r, a, n in reversed(run[d][1]):
                dn_ = (dstate + ds[t, :, i * h : (i + 1) * h]) * live[t][:, None]
                da = dn_ * (state - n) * a * (1 - a)
                dn = dn_ * (1 - a) * (1 - n * n)
                dr = dn * un * r * (1 - r)
                du = np.concatenate([dr, da, dn * r], axis=1)
                dz[t] = np.concatenate([dr, da, dn], axis=1)
                dU += state.T @ du
                dstate = dn_ * a + du @ U.T
            g[f"U{d}"] = dU
            flat = dz.reshape(-1, 3 * h)
            g[f"W{d}"], g[f"c{d}"] = x.reshape(-1, WIDTH).T @ flat, flat.sum(axis=0)
            dx += dz @ p[f"W{d}"].T
        flat = dx.reshape(-1, WIDTH)
        g["word"] = self._sums(len(p["word"]), word.ravel(), flat)
        each = self._sums(len(used), of.ravel(), (dx * share).reshape(-1, WIDTH))
        g["char"] = self._sums(GRAMS, flat_grams, np.repeat(each * (count**-0.5)[:, None], count, axis=0).astype(np.float32))
        g["word"][0] = 0
        return float(loss), g


def sliding(x: np.ndarray) -> np.ndarray:
    """Sums over ``WINDOW`` places from each place on along the first axis; places after the end count 0."""
    out, part, width, left = np.zeros_like(x), x, 1, WINDOW
    at = 0
    while left:  # WINDOW in powers of two
        if left & 1:
            out[: max(0, len(x) - at)] += part[at:]
            at += width
        left >>= 1
        wider = part.copy()
        wider[: max(0, len(x) - width)] += part[width:]
        part, width = wider, 2 * width
    return out


def _picked(grams: np.ndarray, count: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists of the given rows, one after another, and their lengths."""
    begin, n = (np.cumsum(count) - count)[rows], count[rows]
    return grams[np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))], n


def _mean_grams(table: np.ndarray, grams: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Sum of each list's vectors over the root of its length; no list is empty."""
    return np.add.reduceat(table[grams], np.cumsum(count) - count) * (count**-0.5)[:, None].astype(np.float32)


SENTENCE = re.compile(r"(?<=[.!?…])[*\"”»)]*\s+|\n+")


def _word_set(text: str) -> list[str]:
    return sorted({w for w in map(normal, tokens(text)) if w.isalpha()})


class Weak:
    """Sentences of noisily labelled documents, and how often their words come with each label.

    Of each kind (sexual, toxic, clean) sentences are kept with the numbers of their telling words only.
    """

    LIFT, LEAST = 15.0, 3

    def __init__(self, sexual: list[tuple[str, str]], toxic: list[tuple[str, str]], clean: list[tuple[str, str]]) -> None:
        kinds = [sorted(rows) for rows in (sexual, toxic, clean)]
        n = [len({d for d, _ in rows}) for rows in kinds]
        df: list[dict[str, int]] = []
        for rows in kinds:
            count: dict[str, int] = {}
            for _, same in groupby(rows, key=lambda r: r[0]):
                for w in {w for _, text in same for w in _word_set(text)}:
                    count[w] = count.get(w, 0) + 1
            df.append(count)
        self.clean_rate = {w: k / max(1, n[2]) for w, k in df[2].items()}
        rate = lambda w: (df[2].get(w, 0) + 1) / max(1, n[2])
        some = [{w: x / max(1, n[k]) / rate(w) for w, x in df[k].items() if x >= self.LEAST} for k in (0, 1)]
        self.lift = [{w: v for w, v in x.items() if v >= self.LIFT} for x in some]
        telling = self.lift[0].keys() | self.lift[1].keys()
        #: Documents of each kind by sentence, found by telling word.
        self.at: dict[str, set[int]] = {}
        self.raw: list[str] = []
        self.doc: list[str] = []
        self.kind: list[int] = []
        self.plain: set[str] = set()
        for kind, rows in enumerate(kinds):
            for d, text in rows:
                for x in SENTENCE.split(plain(text)):
                    if kind == 2 and x:
                        self.plain.add(x)
                    ws = telling.intersection(_word_set(x))
                    if ws:
                        for w in ws:
                            self.at.setdefault(w, set()).add(len(self.raw))
                        self.raw.append(x)
                        self.doc.append(d)
                        self.kind.append(kind)
        self.seen: dict[tuple[int, tuple[str, ...]], bool] = {}

    def _means(self, words: list[str], k: int) -> float:
        """Evidence that a sentence is a case of axis k; 0 if there's too little."""
        top = tuple(sorted((w for w in words if w in self.lift[k]), key=lambda w: (-self.lift[k][w], w))[:3])
        if len(top) < 2:
            return 0.0
        if (k, top) not in self.seen:
            both = set.intersection(*(self.at[w] for w in top))
            flagged, clean = (len({self.doc[i] for i in both if self.kind[i] == j}) for j in (k, 2))
            self.seen[k, top] = flagged >= 2 and clean * 2 <= flagged
        return sum(np.log(self.lift[k][w]) for w in top) if self.seen[k, top] else 0.0

    def cases(self, k: int) -> list[str]:
        """The best sentence of each document flagged on axis k, if there is a good one."""
        best: dict[str, tuple[float, str]] = {}
        for x, d, kind in zip(self.raw, self.doc, self.kind):
            if kind == k:
                ws = _word_set(x)
                if (z := self._means(ws, k)) > self._means(ws, 1 - k) and z > best.get(d, (0.0, ""))[0]:
                    best[d] = (z, x)
        return sorted(x for _, x in best.values())

    def is_case(self, text: str) -> bool:
        ws = _word_set(text)
        return any(self._means(ws, k) > 0 for k in (0, 1))

    def clean_sentences(self) -> list[str]:
        return sorted(self.plain)


class Classifier:
    """A trained network, with inputs to the gates kept for every distinct token."""

    ROUNDS = 4

    def __init__(self, passages: list[tuple[str, float, float]], clean: list[str] = (), bags: tuple[list, list, list] | None = None, find_more=None, steps: int = 700, batch: int = 96, seed: int = 3) -> None:
        """``passages``: text and labels on both axes; ``clean``: further texts without cases.

        ``bags``: (document, text) rows of documents flagged as sexual, flagged as toxic, and clean, all noisy;
        ``find_more`` gives texts of clean documents that hold any of the given words.
        """
        weak = Weak(*bags) if bags else None
        texts = [x for x, _, _ in passages] + list(clean)
        #: Words as they are written out, to read those whose letters stand apart.
        self.written = {w for x in texts for w in map(normal, tokens(_SPACED.sub(" ", plain(x)))) if w.isalpha() and (len(w) > 1 or w in "ai")}
        rows = [(self.tokens(x), a, b) for x, a, b in passages] + [(self.tokens(x), None, None) for x in clean]
        if weak:
            rows += [(self.tokens(x), 1.0, 0.0) for x in weak.cases(0)] + [(self.tokens(x), 0.0, 1.0) for x in weak.cases(1)]
            rows += [(self.tokens(x), None, None) for _, x in bags[2][:: max(1, len(bags[2]) // 4_000)]]
        self._fit(rows, steps, batch, seed)
        if weak:
            # clean sentences that score high are learnt until none is left, but for those that look like cases
            some = [x for x in weak.clean_sentences() if not weak.is_case(x)]
            if find_more is not None:
                told = {w for ws, a, b in rows if a or b for w in map(normal, ws) if w.isalpha() and len(w) > 2 and weak.clean_rate.get(w, 0) < 0.01}
                more = {x for text in find_more(sorted(told)) for x in SENTENCE.split(plain(text)) if told.intersection(_word_set(x))}
                some = sorted(set(some) | {x for x in more if not weak.is_case(x)})
            hard: set[str] = set()
            for again in range(self.ROUNDS):
                new = {x for x, z in zip(some, self.scores(some)[0].max(axis=1)) if z > 0.2} - hard if some else set()
                if not new:
                    break
                hard |= new
                rows += [(self.tokens(x), 0.0, 0.0) for x in sorted(new)]
                self._fit(rows, steps // 2, batch, seed + 1 + again, more=True)

    def _fit(self, rows: list, steps: int, batch: int, seed: int, more: bool = False) -> None:
        """Train a new network, or the present one on with ``more`` rows."""
        rng = np.random.default_rng(seed)
        texts = [([normal(t) for t in ws], a, b, [t[:1].isupper() for t in ws]) for ws, a, b in rows if ws]
        df: dict[str, list[int]] = {}
        for ws, a, b, _ in texts:
            for w in set(ws):
                df.setdefault(w, [0, 0])[bool(a or b)] += 1
        if not more:
            self.net = Network(sorted(w for w, n in df.items() if sum(n) > 1), rng)
        #: Words of cases by first letter, last letter and length, to read words masked by ``*``.
        self.masked = {(w[0], w[-1], len(w)): w for w, n in sorted(df.items(), key=lambda x: (x[1][1], x[0])) if n[1] > 1 and n[1] > n[0] and w.isalpha() and len(w) > 3}
        self.known: dict[str, int] = {}
        self._train(texts, steps, batch, rng, more)
        self.table = {d: np.zeros((1, 3 * HIDDEN), np.float32) for d in "fb"}

    def tokens(self, text: str) -> list[str]:
        return tokens(text, self.written)

    def _read(self, token: str) -> str:
        t = normal(token)
        return self.masked.get((t[0], t[-1], len(t)), t) if "**" in t else t

    def _inputs(self, tokens: list[str]) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray]]:
        """Word ids, and all character n-grams with their number by token."""
        grams = [char_grams(t) for t in tokens]
        return np.array([self.net.ids.get(t, 0) for t in tokens], np.int64), (np.array([g for gs in grams for g in gs], np.int64), np.array([len(g) for g in grams], np.int64))

    def _train(self, texts: list, steps: int, batch: int, rng: np.random.Generator, more: bool = False) -> None:
        vocabulary = sorted({w for ws, *_ in texts for w in ws})
        at = {w: i + 1 for i, w in enumerate(vocabulary)}
        word, (grams, count) = self._inputs(vocabulary)
        word, grams, count = np.append(0, word), np.append(0, grams), np.append(1, count)  # row 0: no token
        seen: dict[str, int] = {}
        names = []
        for ws, _, _, upper in texts:
            for w, u in zip(ws, upper):
                seen[w] = seen.get(w, 0) + (not u)
        names = [at[w] for w in vocabulary if w.isalpha() and not seen[w]]
        is_name = np.zeros(len(vocabulary) + 1, bool)
        is_name[names] = True
        coded = [(np.array([at[w] for w in ws]), a, b) for ws, a, b, _ in texts]
        safe = [i for i, (_, a, b) in enumerate(coded) if a == 0 and b == 0]
        pool = [i for i, (_, a, _b) in enumerate(coded) if a is None] or safe
        hard = [i for i in safe if len(coded[i][0]) <= 20]
        kinds = [[i for i, (_, a, b) in enumerate(coded) if a], [i for i, (_, a, b) in enumerate(coded) if b], hard, safe, pool, pool]
        kinds = [k or pool or list(range(len(coded))) for k in kinds]
        pool = pool or kinds[0]
        m = {k: np.zeros_like(v) for k, v in self.net.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.net.p.items()}
        for step in range(1, steps + 1):
            rows: list[np.ndarray] = []
            y = np.zeros((batch, 2), np.float32)
            for b in range(batch):
                kind = b % 6
                of = kinds[kind]
                x, s, t = coded[of[rng.integers(len(of))]]
                y[b] = s or 0, t or 0
                most = int(rng.integers(1, 9)) if kind == 5 and rng.random() < 0.4 else LONG
                room = LONG
                if not (s or t):
                    k = int(rng.integers(0, max(1, len(x) - min(most, room) + 1)))
                    x = x[k : k + min(most, room)]
                room -= len(x)
                if room > 0 and kind < 4 and rng.random() < 0.75:
                    before, after = (coded[pool[rng.integers(len(pool))]][0] for _ in "ba")
                    k = int(rng.integers(0, room + 1))
                    x = np.concatenate([before[len(before) - min(k, len(before)) :], x, after[: room - k]])
                rows.append(x)
            ids = np.zeros((max(map(len, rows)), batch), np.int64)
            for b, x in enumerate(rows):
                ids[: len(x), b] = x
            if names:
                swap = is_name[ids] & (rng.random(ids.shape) < 0.5)
                ids[swap] = rng.choice(names, swap.sum())
            w = np.where(rng.random(ids.shape) < 0.3, 0, word[ids])
            drop = (rng.random(ids.shape) > 0.05).astype(np.float32)
            loss, g = self.net.step(w, ids, (grams, count), ids > 0, y, drop)
            rate = (0.005 if more else 0.01) * min(1.0, 2 * (1 - step / (steps + 1)))
            for k, x in self.net.p.items():
                m[k] += 0.1 * (g[k] - m[k])
                v[k] += 0.01 * (g[k] ** 2 - v[k])
                x -= rate * ((m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8) + 1e-3 * x)
            self.loss = loss

    def learn(self, tokens: set[str]) -> None:
        """Gate inputs of new tokens."""
        if len(self.known) > 1 << 18:
            self.known.clear()
            self.table = {d: t[:1] for d, t in self.table.items()}
        new = [t for t in tokens if t not in self.known]
        p = self.net.p
        self.known.update({t: len(self.known) + 1 + i for i, t in enumerate(new)})
        for low in range(0, len(new), 4096):
            word, (grams, count) = self._inputs([self._read(t) for t in new[low : low + 4096]])
            x = p["word"][word] + _mean_grams(p["char"], grams, count)
            for d in "fb":
                self.table[d] = np.concatenate([self.table[d], x @ p[f"W{d}"] + p[f"c{d}"]])

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """For each text the greatest window score on each axis, and the number of windows."""
        split = [self.tokens(t) for t in texts]
        self.learn({w for ws in split for w in ws})
        get = self.known.__getitem__
        n = np.array([len(ws) for ws in split], np.int64)
        windows = np.where(n > 0, np.maximum(1, n - WINDOW + 1), 0)
        out = np.zeros((len(texts), 2), np.float32)
        order = np.argsort(-n, kind="stable")[: int((n > 0).sum())]
        if not len(order):
            return out, windows
        room = np.cumsum(n[order] + WINDOW)
        low = 0
        while low < len(order):  # some PLACES at a time, of texts of about one length
            high = max(low + 1, int(np.searchsorted(room, (room[low - 1] if low else 0) + PLACES, "right")))
            part = order[low:high]
            out[part] = self._best(n[part], windows[part], np.fromiter((get(w) for k in part.tolist() for w in split[k]), np.int64, int(n[part].sum())))
            low = high
        return out, windows

    def _best(self, size: np.ndarray, windows: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """The greatest window score of texts on each axis; texts are sorted, longest first, ``ids`` are all their tokens."""
        # texts lie one after another, each with WINDOW empty places behind it
        room = size + WINDOW
        begin = np.cumsum(room) - room
        at = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(len(ids))
        placed = np.zeros(int(room.sum()), np.int64)
        placed[at] = ids
        view = self._views(placed, begin, size)
        e, value = np.clip(view[:, :2], -STEEP, STEEP).astype(np.float64), view[:, 2:].astype(np.float64)
        weight = np.zeros_like(e)
        weight[at] = np.exp(e[at])
        total, mean = sliding(weight), sliding(weight * value)
        start = np.cumsum(windows) - windows
        first = np.repeat(begin - start, windows) + np.arange(int(windows.sum()))
        top = np.maximum.reduceat(mean[first] / total[first], start)
        return self.net._gate((top + self.net.p["o"]).astype(np.float32))

    def _views(self, ids: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        """What the pooling needs of every place's state: attention and value on both axes. Texts are sorted, longest first."""
        p, h = self.net.p, HIDDEN
        out = np.zeros((len(ids), 4), np.float32)
        live = np.searchsorted(-size, -np.arange(int(size[0])), "left")
        for i, d in enumerate("fb"):
            U, table = p[f"U{d}"], self.table[d]
            view = np.concatenate([p["A"][i * h : (i + 1) * h], p["v"][:, i * h : (i + 1) * h].T], axis=1)
            state = np.zeros((len(size), h), np.float32)
            for t, m in enumerate(live.tolist()):
                at = begin[:m] + t if d == "f" else begin[:m] + size[:m] - 1 - t
                z, old = table[ids[at]], state[:m]
                u = old @ U
                g = np.tanh(0.5 * (z[:, : 2 * h] + u[:, : 2 * h])) * 0.5 + 0.5
                new = np.tanh(z[:, 2 * h :] + g[:, :h] * u[:, 2 * h :])
                new += g[:, h:] * (old - new)
                state[:m] = new
                out[at] += new @ view
        return out


def _score_batches(batches: Iterator[pa.RecordBatch], classifier: Classifier) -> Iterator[pa.RecordBatch]:
    for b in batches:
        score, windows = classifier.scores(b.column("__text").to_pylist())
        yield pa.RecordBatch.from_arrays([b.column("__doc"), b.column("__key"), *(pa.array(score[:, i].astype(np.float64)) for i in (0, 1)), pa.array(windows.astype(np.int32))], ["__doc", "__key", *AXES, "n_windows"])


def axis_value(column):
    """A dial's value in the scale's own spelling, else null."""
    bare = F.lower(F.trim(column))
    out = F.lit(None).cast("string")
    for v in ("Clean", "Suggestive", "Explicit", "Safe", "Harassment", "Dangerous"):
        out = F.when(bare == v.lower(), F.lit(v)).otherwise(out)
    return out


def _least(df: DataFrame, columns: list[str], n: int) -> list:
    """``n`` rows by hash, so that the choice depends on the rows alone."""
    return df.withColumn("__h", F.xxhash64(*columns)).orderBy("__h", *columns).limit(n).select(*columns).collect()


_FITTED: dict[str, Classifier] = {}


def train(
    samples: DataFrame,
    clean: DataFrame | None = None,
    opinions: DataFrame | None = None,
    docs: DataFrame | None = None,
    doc: str = "doc_uuid",
    text: str = "text",
    max_samples: int = 5_000,
    max_documents: int = 1_200,
    max_texts: int = 12_000,
    max_chars: int = 4_000,
) -> Classifier:
    """Fit on the driver, on bounded samples of labelled rows.

    ``samples`` has ``text, sexual_axis, toxicity_axis`` (trusted), ``clean`` has ``text``; ``opinions`` has
    ``<doc>, sexual_axis, toxicity_axis`` (noisy; other spellings of the scale are read, values outside it
    and nulls are no opinion) on the texts of ``docs``. Of the opinions at most ``max_documents`` documents of
    each flag and twice as many clean ones are used, with at most ``max_texts`` of their texts up to
    ``max_chars`` characters long, and at most half as many texts of any clean document that hold a word of the
    cases. Every bound takes the rows with the smallest hashes.
    """
    rows = _least(samples.where("text is not null and sexual_axis is not null and toxicity_axis is not null"), ["text", "sexual_axis", "toxicity_axis"], max_samples)
    if not rows:
        raise ValueError("no labelled samples")
    passages = [(r.text, float(r.sexual_axis == "Explicit"), float(r.toxicity_axis != "Safe")) for r in rows]
    more = [] if clean is None else [r.text for r in _least(clean.where("text is not null"), ["text"], max_samples)]
    bags = None
    if opinions is not None and docs is not None:
        per = opinions.groupBy(doc).agg(
            F.bool_or(axis_value(F.col("sexual_axis")) == "Explicit").alias("s"),
            F.bool_or(axis_value(F.col("toxicity_axis")).isin("Harassment", "Dangerous")).alias("t"),
            F.bool_and(F.coalesce((axis_value(F.col("sexual_axis")) == "Clean") & (axis_value(F.col("toxicity_axis")) == "Safe"), F.lit(False))).alias("c"),
        )
        kinds = {k: {r[0] for r in _least(per.where(k), [doc], n)} for k, n in (("s", max_documents), ("t", max_documents), ("c", 2 * max_documents))}
        spark = docs.sparkSession
        wanted = sorted(set().union(*kinds.values()))
        if wanted:
            chosen = F.broadcast(spark.createDataFrame([(x,) for x in wanted], f"{doc} {docs.schema[doc].dataType.simpleString()}"))
            texts = docs.where(F.col(text).isNotNull() & (F.length(text) <= max_chars)).select(doc, text).join(chosen, doc, "left_semi").distinct()
            found = [(r[0], r[1]) for r in _least(texts, [doc, text], 3 * max_texts)]
            bags = tuple([x for x in found if x[0] in kinds[k]][:max_texts] for k in ("s", "t", "c"))

            def find_more(words: list[str]) -> list[str]:
                hit = F.arrays_overlap(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), F.array(*map(F.lit, words)))
                held = docs.where(F.col(text).isNotNull() & (F.length(text) <= max_chars) & hit).select(doc, text)
                held = join_checked(held, cut_lineage(per.where("c").select(doc)), doc, "left_semi")
                return [r[0] for r in _least(held.select(text).distinct(), [text], max_texts // 2)]

    read = sorted(docs.inputFiles()) if bags else []
    mark = hashlib.sha256(repr((SparkSession.active().sparkContext.applicationId, passages, more, bags, read)).encode("utf-8", "surrogatepass")).hexdigest()
    if mark not in _FITTED:  # one network serves all queries of a session on the same rows
        _FITTED.clear()
        _FITTED[mark] = Classifier(passages, more, bags, find_more if bags else None)
    return _FITTED[mark]


def safety_scores(docs: DataFrame, classifier: Classifier, doc: str = "doc_uuid", key: str = "variant_id", text: str = "text") -> DataFrame:
    """``<doc>, <key>, sexual, toxicity, n_windows``: each text's greatest score on each axis, in [0, 1].

    Texts without a token score 0.0 with no window; null texts and null document ids give no rows; empty
    tables give none; repeated rows give their rows again; other columns are not read.
    """
    kinds = {c: docs.schema[c].dataType.simpleString() for c in (doc, key)}
    base = docs.where(F.col(text).isNotNull() & F.col(doc).isNotNull()).select(F.col(doc).alias("__doc"), F.col(key).alias("__key"), F.col(text).alias("__text"))
    shared = docs.sparkSession.sparkContext.broadcast(classifier)
    out = base.mapInArrow(lambda it: _score_batches(it, shared.value), f"__doc {kinds[doc]}, __key {kinds[key]}, sexual double, toxicity double, n_windows int")
    return out.withColumnsRenamed({"__doc": doc, "__key": key})


def document_scores(scores: DataFrame, doc: str = "doc_uuid") -> DataFrame:
    """Greatest score of each document on each axis."""
    return scores.groupBy(doc).agg(*(F.max(a).alias(a) for a in AXES), F.count("*").alias("n_texts"))
