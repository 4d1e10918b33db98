"""Evaluation texts leaking into training text (problem 7).

Method: the CGK random walk embeds a window of words so that edit distance becomes Hamming
distance: while reading the window, a random bit of (step, current word) says whether to advance,
and the word read at each step is written out. Windows of the length of the items (or of a stated number of words) are
embedded in corpus and items alike; bit-sampling LSH reads a few random places of the
embedding, once per repetition, with a fresh walk each time; equal readings are candidates, and
each candidate is verified by exact edit distance over words.

With ``max_edits = 0`` equal windows embed alike, so one repetition finds every case; with edits the
number of repetitions follows from ``recall`` and collisions measured on random windows of that length with that many edits
(see :func:`repetitions`).

A window can only match within ``k`` edits if enough of its adjacent word pairs occur in some item:
one edit spoils two pairs. That test costs one table lookup a word and drops nothing that could
match. The items are the stated query set: up to ``block_items`` of them are indexed once and sent to the workers, and
nothing is shuffled; more are joined with the corpus by their readings, and neither side is collected.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.words import WORD, WordHash, mix, shingles

PAIR_BITS = 22
_LADDER = [int(8 * 1.3**k) for k in range(24)]


def cgk(h: np.ndarray, window: int, seed: int, at: np.ndarray) -> np.ndarray:
    """The CGK embedding (3 * window steps) of the windows of word hashes that begin at ``at``.

    Steps after the end of the window write 0.
    """
    steps = 3 * window
    read = np.zeros(len(at), np.int64)
    out = np.zeros((len(at), steps), np.uint64)
    for s in range(steps):
        inside = read < window
        w = np.where(inside, h[np.minimum(at + read, len(h) - 1)], np.uint64(0))
        out[:, s] = w
        key = np.uint64((seed * 1_000_003 + s * 7_919 + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
        read += (mix(w + key) & np.uint64(1)).astype(np.int64)
    return out


def readings(h: np.ndarray, at: np.ndarray, window: int, seed: int, sampled: int) -> np.ndarray:
    """What repetition ``seed`` reads from the windows that begin at ``at``, as one hash each."""
    # places late in a walk differ most after an edit: the first two windows' worth of steps is read
    places = np.sort(np.random.default_rng((7, window, seed)).choice(2 * window, min(sampled, 2 * window), replace=False))
    out = np.zeros(len(at), np.uint64)
    for low in range(0, len(at), 1 << 15):
        rows = cgk(h, window, seed, at[low : low + (1 << 15)])
        s = np.full(len(rows), window, np.uint64)
        for p in places:
            s = mix(s * np.uint64(0x9E3779B97F4A7C15) + rows[:, p])
        out[low : low + len(rows)] = s
    return out


@functools.cache
def repetitions(max_edits: int, recall: float, sampled: int, window: int, pairs: int = 200, tries: int = 40) -> int:
    """Repetitions for ``recall``: one where nothing may be edited.

    Random windows get ``max_edits`` random edits (words exchanged, put in, left out) and are read ``tries`` times beside
    their originals. From each pair's share of equal readings follows its chance to be found in r repetitions;
    the least r for which the mean chance reaches ``recall`` is taken.
    """
    if max_edits == 0:
        return 1
    rng = np.random.default_rng((3, window, max_edits))
    both = []
    for _ in range(pairs):
        x = rng.integers(1, 1 << 62, window + max_edits).tolist()
        y = x[:window]
        for _ in range(max_edits):
            i, kind = int(rng.integers(0, len(y))), int(rng.integers(0, 3))
            if kind == 0:
                y[i] = int(rng.integers(1, 1 << 62))
            elif kind == 1:
                y.insert(i, int(rng.integers(1, 1 << 62)))
            elif len(y) > 1:
                del y[i]
        # the window of the corpus has the item's length: what is put in pushes words out, what is left out lets some in
        both += [x[:window], (y + x[window:])[:window]]
    h = np.array(both, np.uint64).ravel()
    at = np.arange(0, len(h), window)
    equal = np.zeros(pairs)
    for t in range(tries):
        r = readings(h, at, window, 1_000 + t, sampled)
        equal += r[::2] == r[1::2]
    chance = (equal + 0.5) / (tries + 1)  # a pair that never met may still meet
    for r in range(1, 400):
        if (1 - (1 - chance) ** r).mean() >= recall:
            return r
    return 400


def edit_distance(a: list, b: list, limit: int) -> int:
    """Levenshtein distance over words, or ``limit + 1`` if above ``limit``."""
    if abs(len(a) - len(b)) > limit:
        return limit + 1
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        left, diagonal = i, i - 1
        new = [i]
        for j, y in enumerate(b, 1):
            left = min(row[j] + 1, left + 1, diagonal + (x != y))
            diagonal = row[j]
            new.append(left)
        row = new
        if min(row) > limit:
            return limit + 1
    return row[-1]


def edited_within(a: np.ndarray, b: np.ndarray, limit: int) -> bool:
    if limit == 0 or np.array_equal(a, b):
        return bool(np.array_equal(a, b))
    return edit_distance(a.tolist(), b.tolist(), limit) <= limit


def windows_of(lens: np.ndarray, window: int | None, least: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(words, text, begin within it) of the windows of texts: of ``window`` words each, or each text's own length from ``least`` on."""
    if window is None:
        return [(int(n), np.flatnonzero(lens == n), np.zeros(int((lens == n).sum()), np.int64)) for n in np.unique(lens) if n >= least]
    k = np.maximum(0, lens - window + 1)
    text = np.repeat(np.arange(len(lens)), k)
    return [(window, text, np.arange(len(text)) - np.repeat(np.cumsum(k) - k, k))] if len(text) else []


def pair_places(h: np.ndarray) -> np.ndarray:
    """Where each adjacent pair of words is in a table of ``1 << PAIR_BITS`` places."""
    return (shingles(h, 2) >> np.uint64(64 - PAIR_BITS)).astype(np.int64)


def likely(h: np.ndarray, doc: np.ndarray, pairs: np.ndarray, window: int, max_edits: int) -> np.ndarray:
    """Begins of the windows that lie in one text and have enough pairs of an item."""
    if len(h) < window:
        return np.zeros(0, np.int64)
    good = pairs[pair_places(h)] & (doc[1:] == doc[:-1])
    run = np.concatenate(([0], np.cumsum(good)))
    held = run[window - 1 :] - run[: len(run) - window + 1]
    return np.flatnonzero((held >= window - 1 - 2 * max_edits) & (doc[window - 1 :] == doc[: len(doc) - window + 1]))


class Search:
    """The parameters of a search."""

    def __init__(self, window: int | None, max_edits: int, recall: float, sampled: int, least: int) -> None:
        self.window, self.max_edits, self.recall, self.sampled, self.least = window, max_edits, recall, sampled, least

    def repetitions(self, window: int) -> int:
        # measured at a few lengths: edits disturb a shorter window more, so the next one below is on the safe side
        step = max((n for n in _LADDER if n <= window), default=window)
        return repetitions(self.max_edits, self.recall, self.sampled, step)


class ItemIndex:
    """LSH tables over all item windows by length, and the pairs of adjacent words that occur in items."""

    def __init__(self, items: list[tuple[int, list[int]]], how: Search) -> None:
        self.how = how
        self.ids = np.array([k for k, _ in items], np.int64)
        lens = np.array([len(h) for _, h in items], np.int64)
        first = np.cumsum(lens) - lens
        self.words = np.array([x for _, h in items for x in h], np.uint64)
        self.pairs = np.zeros(1 << PAIR_BITS, bool)
        self.tables = []
        for n, text, begin in windows_of(lens, how.window, how.least):
            at = first[text] + begin
            for low in range(0, len(at), 1 << 16):
                inner = at[low : low + (1 << 16), None] + np.arange(n - 1)
                two = mix(mix(self.words[inner]) * np.uint64(0x9E3779B97F4A7C15) + self.words[inner + 1])
                self.pairs[(two >> np.uint64(64 - PAIR_BITS)).astype(np.int64).ravel()] = True
            for seed in range(how.repetitions(n)):
                sign = readings(self.words, at, n, seed, how.sampled)
                o = np.argsort(sign, kind="stable")
                self.tables.append((n, seed, sign[o], at[o], text[o]))

    def search(self, h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (doc, item) of verified matches; ``h`` holds word hashes, ``doc`` the text of each."""
        found, at, last = [], None, None
        for n, seed, sign, begin, item in self.tables:
            if n != last:
                at, last = likely(h, doc, self.pairs, n, self.how.max_edits), n
            if not len(at):
                continue
            mine = readings(h, at, n, seed, self.how.sampled)
            lo, hi = np.searchsorted(sign, mine, "left"), np.searchsorted(sign, mine, "right")
            k = hi - lo
            q = np.repeat(np.arange(len(at)), k)
            if not len(q):
                continue
            c = np.arange(len(q)) - np.repeat(np.cumsum(k) - k, k) + np.repeat(lo, k)
            if self.how.max_edits == 0:
                same = np.ones(len(q), bool)
                for i in range(n):
                    same &= h[at[q] + i] == self.words[begin[c] + i]
            else:
                same = np.array([edited_within(h[at[x] : at[x] + n], self.words[begin[y] : begin[y] + n], self.how.max_edits) for x, y in zip(q, c)], bool)
            found.append(np.stack([doc[at[q[same]]], item[c[same]]], 1))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        u = np.unique(np.concatenate(found), axis=0)
        return u[:, 0], self.ids[u[:, 1]]


def _hashed(texts: list[str], known: WordHash) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of texts end to end, and the text of each."""
    flat: list[int] = []
    count: list[int] = []
    for text in texts:
        ws = WORD.findall(text)
        flat.extend(map(known.__getitem__, ws))
        count.append(len(ws))
    return np.array(flat, np.uint64), np.repeat(np.arange(len(count)), count)


def _match(batches: Iterator[pa.RecordBatch], index: ItemIndex) -> Iterator[pa.RecordBatch]:
    known = WordHash()
    for b in batches:
        doc, item = index.search(*_hashed(b.column("__text").to_pylist(), known))
        yield pa.RecordBatch.from_arrays([b.column("__key").take(pa.array(doc)), pa.array(item)], ["__key", "item_id"])


def _item_pairs(batches: Iterator[pa.RecordBatch], how: Search) -> Iterator[pa.RecordBatch]:
    known, seen = WordHash(), np.zeros(1 << PAIR_BITS, bool)
    sizes: set[int] = set()
    for b in batches:
        h, doc = _hashed(b.column("t").to_pylist(), known)
        lens = np.bincount(doc, minlength=len(b)) if len(b) else np.zeros(0, np.int64)
        long = lens >= (how.window or how.least)
        if len(h) > 1:
            seen[pair_places(h)[(doc[1:] == doc[:-1]) & long[doc[1:]]]] = True
        sizes |= set(lens[long].tolist())
    at = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([at, -np.array(sorted(sizes), np.int64)]).astype(np.int32))], ["place"])


def _reading_batches(batches: Iterator[pa.RecordBatch], how: Search, sizes: list[int], pairs: np.ndarray | None, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """(reading, key, words) of all windows of items (no ``pairs``), or of those windows of the corpus that may match."""
    known = WordHash()
    for b in batches:
        h, doc = _hashed(b.column(1).to_pylist(), known)
        if pairs is None:
            lens = np.bincount(doc, minlength=len(b)) if len(b) else np.zeros(0, np.int64)
            first = np.cumsum(lens) - lens
            some = [(n, first[text] + begin, text) for n, text, begin in windows_of(lens, how.window, how.least)]
        else:
            some = [(n, at, doc[at]) for n in sizes if len(at := likely(h, doc, pairs, n, how.max_edits))]
        for n, at, text in some:
            for low in range(0, len(at), 1 << 14):
                mine, of = at[low : low + (1 << 14)], pa.array(text[low : low + (1 << 14)])
                body = np.ascontiguousarray(h[mine[:, None] + np.arange(n)])
                words = pa.Array.from_buffers(pa.binary(), len(mine), [None, pa.py_buffer((np.arange(len(mine) + 1) * 8 * n).astype(np.int32)), pa.py_buffer(body)])
                for seed in range(how.repetitions(n)):
                    sign = mix(readings(h, mine, n, seed, how.sampled) + np.uint64(seed)).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(sign), b.column(0).take(of).cast(kind), words], ["sign", "k", "words"])


def _verify(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        both = zip(b.column("words").to_pylist(), b.column("item_words").to_pylist())
        ok = [x == y or (limit > 0 and edited_within(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), limit)) for x, y in both]
        keep = b.filter(pa.array(ok, pa.bool_()))
        yield pa.RecordBatch.from_arrays([keep.column("__key"), keep.column("item_id")], ["__key", "item_id"])


def _joined(base: DataFrame, query: DataFrame, kind: str, how: Search) -> DataFrame:
    """Matches by a join on readings; only the table of pairs and the lengths of items come to the driver."""
    from pyspark.sql.pandas.types import to_arrow_type

    held = [r.place for r in query.mapInArrow(lambda it: _item_pairs(it, how), "place int").distinct().collect()]
    pairs = np.zeros(1 << PAIR_BITS, bool)
    pairs[[p for p in held if p >= 0]] = True
    sizes = [how.window] if how.window else sorted(-p for p in held if p < 0)
    shared = base.sparkSession.sparkContext.broadcast(pairs)
    key_type = to_arrow_type(base.schema["__key"].dataType)
    items = query.mapInArrow(lambda it: _reading_batches(it, how, sizes, None, pa.int64()), "sign long, k long, words binary").withColumnsRenamed({"k": "item_id", "words": "item_words"})
    docs = base.mapInArrow(lambda it: _reading_batches(it, how, sizes, shared.value, key_type), f"sign long, k {kind}, words binary").withColumnRenamed("k", "__key")
    met = docs.join(items, "sign").where(F.length("words") == F.length("item_words"))
    return met.select("__key", "item_id", "words", "item_words").mapInArrow(lambda it: _verify(it, how.max_edits), f"__key {kind}, item_id long")


def leaked_items(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    window: int | None = 12,
    max_edits: int = 0,
    recall: float = 0.95,
    sampled: int = 6,
    least: int = 12,
    block_items: int = 20_000,
) -> DataFrame:
    """Every record that holds ``window`` consecutive words of an item, up to ``max_edits`` edits.

    Without ``window`` the window is the whole item, for items of at least ``least`` words: records come out that hold as many
    consecutive words within ``max_edits`` edits of it. Pairs are found with a probability of about ``recall``, for sure
    where nothing may be edited. Returns ``<key>, item_id`` without repeats. Null texts, null keys, and texts or items of fewer
    words than a window match nothing; empty tables give no rows; equal items each get their own rows;
    other columns are not read. Item keys must be integers.
    """
    kind = docs.schema[key].dataType.simpleString()
    how = Search(window, max_edits, recall, sampled, least)
    base = docs.where(F.col(text).isNotNull() & F.col(key).isNotNull()).select(F.col(key).alias("__key"), F.col(text).alias("__text"))
    query = items.where(F.col(item_text).isNotNull() & F.col(item_key).isNotNull()).select(F.col(item_key).cast("long").alias("k"), F.col(item_text).alias("t")).distinct()
    rows = query.limit(block_items + 1).collect()
    if len(rows) <= block_items:
        known = WordHash()
        index = docs.sparkSession.sparkContext.broadcast(ItemIndex([(r.k, [known[w] for w in WORD.findall(r.t)]) for r in rows], how))
        out = base.mapInArrow(lambda it: _match(it, index.value), f"__key {kind}, item_id long")
    else:
        out = _joined(base, query, kind, how)
    return out.distinct().withColumnRenamed("__key", key)
