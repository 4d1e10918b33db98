"""Language of documents and of stretches in another language (problem 1).

Method: hyperdimensional profiles. Every letter has a random vector of +1 and -1; a letter trigram is
bound by multiplying the vectors of its letters, permuted once per place (here: rotated); the
trigrams of a language's samples are bundled by adding them. Prototypes are refined by the usual retraining (windows
of samples that go to the wrong prototype are added to the right one and taken from the wrong one), then the mean of all
languages is taken from each and they are brought to length 1. A text's bundle is compared with them by cosine.

As bundling is linear, a product of a bundle with a prototype is the sum of those of its trigrams, so each distinct
trigram and word is computed once per worker and kept; the length of a bundle is that of independent
vectors, the root of the sum of squared trigram counts. Stretches come from the best path through all words of a text
(Viterbi) with a price for each change of language. Capitalised words that no sample holds in lower case are taken for names,
and like numbers and words with digits in them they go with their surroundings. A stretch whose cosine is under ``FLOOR`` is of no
known language (``und``): names, numbers, codes, other scripts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.words import TAG, WORD

TOKEN = re.compile(r"[^\W_]+|[.!?…\n]+")
FLOOR = 0.08
UNKNOWN = "und"
_CELLS = 1 << 21

# Spellings of language labels, as ISO 639-1, ISO 639-2 (both kinds) and English names.
LABELS = {
    "en": ("en", "eng", "english"),
    "fr": ("fr", "fra", "fre", "french"),
    "de": ("de", "deu", "ger", "german"),
    "es": ("es", "spa", "spanish"),
    "it": ("it", "ita", "italian"),
    "pt": ("pt", "por", "portuguese"),
    "nl": ("nl", "nld", "dut", "dutch"),
    "sv": ("sv", "swe", "swedish"),
    "pl": ("pl", "pol", "polish"),
    "ru": ("ru", "rus", "russian"),
}


def label_code(column):
    """The two-letter code that a label spelling names, else null (blank, ``und``, ``unknown``, others)."""
    bare = F.lower(F.regexp_extract(F.trim(column), r"^\s*([A-Za-z]+)(?:[-_][A-Za-z0-9]+)*\s*$", 1))
    out = F.lit(None).cast("string")
    for code, names in LABELS.items():
        out = F.when(bare.isin(*names), F.lit(code)).otherwise(out)
    return out


class Profiles:
    """Prototypes of languages, and cached scores of letters' trigrams and of words."""

    def __init__(self, samples: list[tuple[str, str]], dim: int = 2048, seed: int = 5, rounds: int = 12, window: int = 12) -> None:
        self.langs = sorted({lang for lang, _ in samples})
        self.dim, self.rng = dim, seed
        self.letters: dict[str, int] = {}
        self.vectors = np.zeros((0, dim), np.int8)
        texts = [(self.langs.index(lang), [w for w in TOKEN.findall(t) if w[0].isalnum()]) for lang, t in samples]
        self.lower = {w for _, ws in texts for w in ws if w == w.lower()}
        vocabulary = sorted({w for _, ws in texts for w in ws})
        grams = sorted({g for w in vocabulary for g in self._cut(w)})
        at = {g: i for i, g in enumerate(grams)}
        bound = self._bind(grams)
        k = len(self.langs)
        windows, truth = [], []
        counts = np.zeros((k, len(grams)), np.float32)
        for lang, ws in texts:
            ws = [w for w in ws if not self._name(w)]
            for i in range(0, max(1, len(ws) - window // 2), window // 2):
                row = np.zeros(len(grams), np.float32)
                for w in ws[i : i + window]:
                    for g in self._cut(w):
                        row[at[g]] += 1
                windows.append(row)
                truth.append(lang)
            for w in ws:
                for g in self._cut(w):
                    counts[lang, at[g]] += 1
        bundle = np.sqrt(counts) @ bound.astype(np.float32)
        x = np.stack(windows) @ bound.astype(np.float32)
        x /= np.linalg.norm(x, axis=1, keepdims=True) + 1e-9
        y = np.array(truth)
        bundle /= np.linalg.norm(bundle, axis=1, keepdims=True)
        for _ in range(rounds):
            cos = x @ (bundle / np.linalg.norm(bundle, axis=1, keepdims=True)).T
            cos[np.arange(len(y)), y] -= 0.15  # a margin, so that near misses teach too
            wrong = cos.argmax(axis=1)
            bad = np.flatnonzero(wrong != y)
            if not len(bad):
                break
            np.add.at(bundle, y[bad], 0.02 * x[bad])
            np.add.at(bundle, wrong[bad], -0.02 * x[bad])
        bundle /= np.linalg.norm(bundle, axis=1, keepdims=True)
        bundle -= bundle.mean(axis=0)
        self.prototype = bundle / np.maximum(np.linalg.norm(bundle, axis=1, keepdims=True), 1e-9)
        self.forget()

    def forget(self) -> None:
        k = len(self.langs)
        self.letters, self.vectors = {}, np.zeros((0, self.dim), np.int8)
        self.grams, self.words = {}, {}
        self.gram_score = np.zeros((0, k), np.float32)
        self.word_score = np.zeros((0, k), np.float32)
        #: Trigrams of all words one after another, and where each word's begin; words that tell nothing have none.
        self.flat, self.first = np.zeros(0, np.int64), np.zeros(1, np.int64)

    def _name(self, w: str) -> bool:
        return w[0].isupper() and w[1:] == w[1:].lower() and w.lower() not in self.lower

    @staticmethod
    def _cut(w: str) -> list[str]:
        p = f" {w.lower()} "
        return [p[i : i + 3] for i in range(len(p) - 2)]

    def _bind(self, grams: list[str]) -> np.ndarray:
        """The vectors of trigrams; letters get theirs by code point, so every worker draws the same."""
        new = sorted({c for g in grams for c in g} - self.letters.keys())
        if new:
            drawn = [np.random.default_rng((self.rng, ord(c))).integers(0, 2, self.dim, np.int8) * 2 - 1 for c in new]
            self.letters.update({c: len(self.letters) + i for i, c in enumerate(new)})
            self.vectors = np.concatenate([self.vectors, np.stack(drawn).astype(np.int8)])
        if not grams:
            return np.zeros((0, self.dim), np.int8)
        i = np.array([[self.letters[c] for c in g] for g in grams])
        return np.roll(self.vectors, 2, axis=1)[i[:, 0]] * np.roll(self.vectors, 1, axis=1)[i[:, 1]] * self.vectors[i[:, 2]]

    def learn(self, tokens: set[str]) -> None:
        """Add the scores of new words."""
        if len(self.words) > 1 << 18 or len(self.grams) > 1 << 18 or len(self.letters) > 1 << 14:
            self.forget()
        new = [w for w in tokens if w not in self.words]
        if not new:
            return
        cuts = [() if self._name(w) or not w.isalpha() else self._cut(w) for w in new]
        grams = sorted({g for c in cuts for g in c} - self.grams.keys())
        for low in range(0, len(grams), 4096):
            part = grams[low : low + 4096]
            self.grams.update({g: len(self.grams) + i for i, g in enumerate(part)})
            score = self._bind(part).astype(np.float32) @ self.prototype.T / np.sqrt(self.dim)
            self.gram_score = np.concatenate([self.gram_score, score.astype(np.float32)])
        flat = np.array([self.grams[g] for c in cuts for g in c], np.int64)
        n = np.array([len(c) for c in cuts])
        sums = np.zeros((len(new), len(self.langs)), np.float32)
        sums[n > 0] = np.add.reduceat(self.gram_score[flat], (np.cumsum(n) - n)[n > 0]) if len(flat) else 0
        self.words.update({w: len(self.word_score) + i for i, w in enumerate(new)})
        self.word_score = np.concatenate([self.word_score, sums])
        self.flat, self.first = np.concatenate([self.flat, flat]), np.concatenate([self.first, self.first[-1] + np.cumsum(n)])

    def cosines(self, ids: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
        """(n, languages): cosine of each of n stretches; ``ids`` are the words of stretch ``of``."""
        k = self.first[ids + 1] - self.first[ids]
        gram = self.flat[np.repeat(self.first[ids] - (np.cumsum(k) - k), k) + np.arange(int(k.sum()))]
        code, count = np.unique(np.repeat(of, k) * len(self.grams) + gram, return_counts=True) if len(gram) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        square = np.bincount(code // max(1, len(self.grams)), count.astype(np.float64) ** 2, minlength=n)
        begin = np.flatnonzero(np.append(True, np.diff(of) != 0)) if len(of) else np.zeros(0, np.int64)
        sums = np.zeros((n, len(self.langs)))
        if len(of):
            sums[of[begin]] = np.add.reduceat(self.word_score[ids].astype(np.float64), begin)
        return sums / np.sqrt(np.maximum(square, 1.0))[:, None]

    def paths(self, texts: list[str], change: float, inside: float) -> list[list[tuple[int, int, int, float]]]:
        """For each text its stretches (first word, end word, language or -1, confidence)."""
        split = [TOKEN.findall(t) for t in texts]
        self.learn({w for ws in split for w in ws if w[0].isalnum()})
        get = self.words.get
        rows, ends, owner = [], [], []
        for k, tokens in enumerate(split):
            ids = np.array([get(w, -1) for w in tokens], np.int64)
            word = ids >= 0
            stop = np.zeros(int(word.sum()) + 1, bool)
            stop[np.cumsum(word)[~word]] = True
            if word.any():
                rows.append(ids[word])
                ends.append(stop[:-1])
                owner.append(k)
        out: list[list[tuple[int, int, int, float]]] = [[] for _ in texts]
        order = sorted(range(len(rows)), key=lambda i: -len(rows[i]))
        low = 0
        while low < len(order):  # texts side by side, the longest first
            part = order[low : low + max(1, _CELLS // len(rows[order[low]]))]
            low += len(part)
            found = self._viterbi([rows[i] for i in part], [ends[i] for i in part], change, inside)
            size = np.array([len(x) for x in found])
            lang = np.concatenate(found)
            begin = np.cumsum(size) - size
            new = np.append(True, np.diff(lang) != 0)
            new[begin] = True
            edge = np.flatnonzero(new)
            of = np.cumsum(new) - 1
            cos = self.cosines(np.concatenate([rows[i] for i in part]), of, len(edge))
            which = lang[edge].astype(int)
            sure = self.confidence(cos)[np.arange(len(edge)), which]
            own = cos[np.arange(len(edge)), which]
            text = np.searchsorted(begin, edge, "right") - 1
            stop = np.append(edge[1:], len(lang))
            for t, a, z, w, c, p in zip(text.tolist(), edge.tolist(), stop.tolist(), which.tolist(), own.tolist(), sure.tolist()):
                if c < FLOOR:
                    w, p = -1, 1 - max(0.0, c) / FLOOR
                parts, a, z = out[owner[part[t]]], a - int(begin[t]), z - int(begin[t])
                if parts and parts[-1][2] == w:  # both of no known language
                    q = parts.pop()
                    a, p = q[0], (q[3] * (q[1] - q[0]) + p * (z - a)) / (z - q[0])
                parts.append((a, z, w, p))
        return out

    @staticmethod
    def confidence(cos: np.ndarray, sharp: float = 20.0) -> np.ndarray:
        """Softmax of cosines over languages."""
        e = np.exp(sharp * (cos - cos.max(axis=1, keepdims=True)))
        return e / e.sum(axis=1, keepdims=True)

    def _viterbi(self, rows: list[np.ndarray], ends: list[np.ndarray], change: float, inside: float) -> list[np.ndarray]:
        """Best language of every word; rows are sorted by length, longest first."""
        n = np.array([len(r) for r in rows])
        k = len(self.langs)
        width = int(n[0])
        ids = np.zeros((width, len(rows)), np.int64)
        price = np.zeros((width, len(rows)), np.float32)
        for i, (r, e) in enumerate(zip(rows, ends)):
            ids[: len(r), i] = r
            price[: len(r), i] = np.where(e, change, inside)
        live = np.searchsorted(-n, -np.arange(width), "left")
        best = self.word_score[ids[0], :k].copy()
        stay = np.zeros((width, len(rows), k), bool)
        lead = np.zeros((width, len(rows)), np.int8)
        for t in range(1, width):
            m = live[t]
            b = best[:m]
            lead[t, :m] = top = b.argmax(axis=1)
            other = b[np.arange(m), top] - price[t, :m]
            keep = b >= other[:, None]
            stay[t, :m] = keep
            best[:m] = np.where(keep, b, other[:, None]) + self.word_score[ids[t, :m], :k]
        lang = np.zeros((width, len(rows)), np.int8)
        now = best.argmax(axis=1).astype(np.int8)
        each = np.arange(len(rows))
        for t in range(width - 1, -1, -1):
            m = live[t] if t else len(rows)
            lang[t, :m] = now[:m]
            if t:
                go = ~stay[t, each[:m], now[:m]]
                now[:m] = np.where(go, lead[t, :m], now[:m])
        return [lang[: len(r), i] for i, r in enumerate(rows)]


def _segment_batches(batches: Iterator[pa.RecordBatch], profiles: Profiles, change: float, inside: float) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = [TAG.sub(lambda m: " " * len(m[0]), t) if "<" in t else t for t in b.column("__text").to_pylist()]
        paths = profiles.paths(texts, change, inside)
        owner, cols = [], ([], [], [], [], [], [])
        for k, parts in enumerate(paths):
            spans = [m.span() for m in WORD.finditer(texts[k])] if len(parts) > 1 else []
            for i, (a, z, lang, sure) in enumerate(parts):
                owner.append(k)
                row = (i, profiles.langs[lang] if lang >= 0 else UNKNOWN, float(sure), z - a, spans[a][0] if i else 0, spans[z][0] if i < len(parts) - 1 else len(texts[k]))
                for c, x in zip(cols, row):
                    c.append(x)
        idx = pa.array(owner, pa.int64())
        kinds = (pa.int32(), pa.string(), pa.float64(), pa.int32(), pa.int32(), pa.int32())
        yield pa.RecordBatch.from_arrays([b.column("__doc").take(idx), b.column("__key").take(idx), *(pa.array(c, t) for c, t in zip(cols, kinds))], ["__doc", "__key", "segment_no", "lang", "confidence", "n_words", "char_begin", "char_end"])


def language_segments(
    docs: DataFrame,
    samples: DataFrame,
    doc: str = "doc_uuid",
    key: str = "variant_id",
    text: str = "text",
    max_samples: int = 5_000,
    change: float = 0.6,
    inside: float = 0.7,
) -> DataFrame:
    """The stretches of each text by language.

    One row per stretch: ``<doc>, <key>, segment_no, lang, confidence, n_words, char_begin, char_end``;
    stretches cover the text without gaps. Texts without a word, null texts and null document ids give
    no rows; empty tables give none; repeated rows give their rows again; other columns are not read.
    Ties between languages go to the code that sorts first; stretches of no known language are ``und``. The profiles are fitted on at most
    ``max_samples`` labelled rows (the smallest by text hash), on the driver.
    """
    rows = samples.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text").orderBy(F.xxhash64("text"), "lang").limit(max_samples).collect()
    if not rows:
        raise ValueError("no labelled samples")
    profiles = Profiles([(r.lang, r.text) for r in rows])
    kinds = {c: docs.schema[c].dataType.simpleString() for c in (doc, key)}
    base = docs.where(F.col(text).isNotNull() & F.col(doc).isNotNull()).select(F.col(doc).alias("__doc"), F.col(key).alias("__key"), F.col(text).alias("__text"))
    shared = docs.sparkSession.sparkContext.broadcast(profiles)
    out = base.mapInArrow(
        lambda it: _segment_batches(it, shared.value, change, inside),
        f"__doc {kinds[doc]}, __key {kinds[key]}, segment_no int, lang string, confidence double, n_words int, char_begin int, char_end int",
    )
    return out.withColumnsRenamed({"__doc": doc, "__key": key})


def document_languages(segments: DataFrame, doc: str = "doc_uuid", min_words: int = 12) -> DataFrame:
    """Per document its main language: ``<doc>, lang, confidence, share, n_langs, n_words``.

    The main language has most words (ties: the code that sorts first); ``confidence`` is the mean over its
    stretches by words, ``share`` its part of all words, ``n_langs`` the languages with a stretch of
    ``min_words``.
    """
    per = segments.groupBy(doc, "lang").agg(F.sum("n_words").alias("w"), F.sum(F.col("confidence") * F.col("n_words")).alias("cw"), F.max("n_words").alias("longest"))
    top = per.groupBy(doc).agg(F.max_by(F.struct("lang", "w", "cw"), F.struct("w", F.ascii("lang") * -1000 - F.ascii(F.substring("lang", 2, 1)))).alias("m"), F.sum("w").alias("n_words"), F.count_if(F.col("longest") >= min_words).alias("n_langs"))
    return top.select(doc, F.col("m.lang").alias("lang"), (F.col("m.cw") / F.col("m.w")).alias("confidence"), (F.col("m.w") / F.col("n_words")).alias("share"), "n_langs", "n_words")


def missing_labels(segments: DataFrame, items: DataFrame, doc: str = "doc_uuid", min_words: int = 12) -> DataFrame:
    """``<doc>, lang`` of stretches of ``min_words`` whose language no ``language`` item of the document names."""
    found = segments.where((F.col("n_words") >= min_words) & (F.col("lang") != UNKNOWN)).select(doc, "lang").distinct()
    named = items.where((F.col("kind") == "categorization") & (F.col("category") == "language")).select(doc, F.explode("value").alias("label"))
    named = named.select(doc, label_code(F.col("label")).alias("lang")).where("lang is not null").distinct()
    return found.join(named, [doc, "lang"], "left_anti")
