"""Near-duplicate records with small edits (problem 3).

Method: vertical partitioning. All word n-grams stand in one global order (rare first); the order is cut
into fragments, which are contiguous ranges of it; each record's set is sorted by the order and cut at the
same places; a pair's overlap is counted in every fragment separately, and the sum of the partial
overlaps decides about the pair.

* The order comes from a count sketch of fixed size over *all* n-grams (``order_bits``); it only
  decides how much work is done, never the result.
* Early bounds keep pairs away that no sum could accept. A pair of similarity ``t`` must share one of the first
  ``n - O + 1`` n-grams of both (``O`` the overlap it needs), so records post that part of their fragments first,
  with places and a parity bitmap of the whole set (256 bits, doubled with its size). Pairs that meet in a fragment
  within the place, length and bitmap bounds, all lossless, are counted; no others.
* For those pairs every fragment of both sets is sent to its own row, the partial overlap is counted there, and the
  counts are summed per pair.

Fragments of the first step are so many that none holds more than about ``LOAD`` postings, and a task reads
them one after another. An n-gram that the sketch finds in more than ``HOT`` records has its list cut into blocks, and
each pair of blocks is a unit of its own, so that no list has to be held by one task.

Records with equal n-gram sets form one class, are posted once per map task, and take part by one
representative; classes are expanded only where a result asks for it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.words import WORD, WordHash, mix, plain, shingles
from lectern.operators.components import connected_components
from lectern.plans import cut_lineage, join_checked, semi_checked

ORDER_PARTS, MAP_BITS, MAP_LOAD = 16, 256, 120
LOAD, HOT, COARSE = 1 << 19, 20_000, 8
MOST_RANGES, MOST_PARTS = 1 << 20, 10_000
_SIDE, _CROSS = 1 << 31, 1 << 30


class Sets:
    """The distinct n-grams of a batch of texts: ``h`` and the text ``rec`` of each, sorted by text."""

    def __init__(self, texts: list[str], known: WordHash, n: int, min_words: int, strip_tags: bool) -> None:
        flat: list[int] = []
        count: list[int] = []
        for t in texts:
            ws = WORD.findall(plain(t) if strip_tags else t)
            flat.extend(map(known.__getitem__, ws))
            count.append(len(ws))
        c = np.array(count, np.int64)
        rec = np.repeat(np.arange(len(c)), c)
        h = shingles(np.array(flat, np.uint64), n)
        rec_end = rec[n - 1 :]
        keep = (rec[: len(h)] == rec_end) & (c[rec_end] >= min_words) if len(h) else np.zeros(0, bool)
        h, rec = h[keep], rec_end[keep]
        o = np.lexsort((h, rec))
        h, rec = h[o], rec[o]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (rec[1:] != rec[:-1])
        self.h, self.rec, self.long = h[new], rec[new], c >= max(min_words, n)
        self.size = np.bincount(self.rec, minlength=len(c)) if len(c) else np.zeros(0, np.int64)
        self.begin = np.concatenate(([0], np.cumsum(self.size)))


def _bucket(h: np.ndarray, bits: int) -> np.ndarray:
    return (mix(h) >> np.uint64(64 - bits)).astype(np.int64)


def _sketch(batches: Iterator[pa.RecordBatch], args: tuple, bits: int) -> Iterator[pa.RecordBatch]:
    known, total = WordHash(), np.zeros(1 << bits, np.uint32)
    for b in batches:
        s = Sets(b.column("__text").to_pylist(), known, *args)
        total += np.bincount(_bucket(s.h, bits), minlength=1 << bits).astype(np.uint32)
    blocks = [zlib.compress(x.tobytes(), 1) for x in np.split(total, ORDER_PARTS)]
    yield pa.RecordBatch.from_arrays([pa.array(range(ORDER_PARTS), pa.int32()), pa.array(blocks, pa.binary())], ["part", "counts"])


def _sum_sketch(group: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(zlib.decompress(x), np.uint32).astype(np.uint64) for x in group.column("counts").to_pylist())
    level = np.minimum(255, np.round(8 * np.log2(total + 1.0))).astype(np.uint8)
    return pa.table({"part": group.column("part").slice(0, 1), "level": pa.array([level.tobytes()], pa.binary())})


def order_levels(base: DataFrame, args: tuple, bits: int) -> np.ndarray:
    """Rarity level of every bucket of n-grams; 2**bits bytes, whatever the size of the data."""
    sums = base.select("__text").mapInArrow(lambda it: _sketch(it, args, bits), "part int, counts binary").groupBy("part").applyInArrow(_sum_sketch, "part int, level binary")
    rows = {r.part: r.level for r in sums.collect()}
    return np.concatenate([np.frombuffer(rows[i], np.uint8) for i in range(ORDER_PARTS)]) if rows else np.zeros(1 << bits, np.uint8)


def needed(x: np.ndarray, y: np.ndarray, t: float) -> np.ndarray:
    """Least overlap of sets of x and y elements with similarity t."""
    return np.ceil(t / (1 + t) * (x + y) - 1e-9).astype(np.int64)


def bitmaps(h: np.ndarray, rec: np.ndarray, size: np.ndarray) -> dict[int, bytes]:
    """Parity bitmap of each record's n-grams; bits fold: the halves of a map XOR to the smaller map."""
    out = {}
    bit = mix(h + np.uint64(99))
    width = map_bits(size)
    for w in np.unique(width[rec]).tolist():
        keep = width[rec] == w
        ids, slot = np.unique(rec[keep], return_inverse=True)
        parity = np.bincount(slot * w + (bit[keep] & np.uint64(w - 1)).astype(np.int64), minlength=len(ids) * w).reshape(-1, w) & 1
        packed = np.packbits(parity.astype(np.uint8), axis=1)
        out |= {r: x.tobytes() for r, x in zip(ids.tolist(), packed)}
    return out


def map_bits(size: np.ndarray) -> np.ndarray:
    """Bits of the map of a set: MAP_BITS for up to MAP_LOAD elements, twice as many for twice as many."""
    return MAP_BITS << np.maximum(0, np.ceil(np.log2(np.maximum(1, size) / MAP_LOAD))).astype(np.int64)


class Maps:
    """Bitmaps of many rows, folded to the width that two rows have in common."""

    def __init__(self, data: np.ndarray, words: np.ndarray) -> None:
        self.words, self.at, self.level = words, {}, {}
        begin = np.cumsum(words) - words
        for w in sorted(np.unique(words).tolist(), reverse=True):
            rows = np.flatnonzero(words >= w)
            own = np.zeros((len(rows), w), np.uint64)
            at = np.full(len(words), -1)
            at[rows] = np.arange(len(rows))
            if self.level:
                wide = min(self.level)
                big = self.level[wide]
                while big.shape[1] > w:
                    half = big.shape[1] // 2
                    big = big[:, :half] ^ big[:, half:]
                up = np.flatnonzero(words >= wide)
                own[at[up]] = big
            same = np.flatnonzero(words == w)
            own[at[same]] = data[(begin[same][:, None] + np.arange(w)).ravel()].reshape(-1, w)
            self.level[w], self.at[w] = own, at

    def apart(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Lower bound of the number of elements that only one of each two rows has."""
        w = np.minimum(self.words[x], self.words[y])
        out = np.zeros(len(x), np.int64)
        for k, rows in self.level.items():
            at, m = self.at[k], np.flatnonzero(w == k)
            out[m] = np.bitwise_count(rows[at[x[m]]] ^ rows[at[y[m]]]).sum(axis=1, dtype=np.int64)
        return out


def _runs(*keys: np.ndarray) -> np.ndarray:
    new = np.ones(len(keys[0]), bool)
    new[1:] = False
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


class Order:
    """The global order: rare buckets first, by hash within a level; and its cuts into fragments."""

    def __init__(self, level: np.ndarray, bits: int, threshold: float, least: int, load: int = LOAD, hot: int = HOT) -> None:
        self.level, self.bits = level, bits
        weight = np.bincount(level, minlength=256) * self.count(np.arange(256))
        self.total = float(weight.sum())
        early = (1 - threshold) * self.total  # about what is posted, the rarest part of every record
        n = min(max(least, int(np.ceil(early / load))), max(least, MOST_RANGES))
        # a bucket holds many n-grams where data are large: only what stands out of them is a long list
        self.hot = max(hot, 8 * self.total / (1 << bits))
        late = max(1, n // 5)
        self.cuts = self._at(np.concatenate([np.linspace(0, early, n - late + 1)[1:], np.linspace(early, self.total, late + 1)[1:-1]]), weight)
        self.coarse = self._at(np.linspace(0, self.total, COARSE + 1)[1:-1], weight)

    @staticmethod
    def count(level: np.ndarray) -> np.ndarray:
        """Upper bound of the records that an n-gram of a level is in (but for the level's rounding)."""
        return np.exp2(np.asarray(level, np.float64) / 8) - 1

    @staticmethod
    def _at(sums: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Keys at which the n-grams before make up each of the sums; hashes are even within a level."""
        upto = np.cumsum(weight)
        lev = np.minimum(np.searchsorted(upto, sums), 255)
        part = np.clip((sums - (upto[lev] - weight[lev])) / np.maximum(weight[lev], 1e-9), 0, 1 - 1e-9)
        return (lev.astype(np.uint64) << np.uint64(56)) | (part * float(1 << 56)).astype(np.uint64)

    def key(self, h: np.ndarray) -> np.ndarray:
        return (self.level[_bucket(h, self.bits)].astype(np.uint64) << np.uint64(56)) | (h >> np.uint64(8))

    def fragments(self) -> int:
        return len(self.cuts) + 1


_POST = pa.schema([("unit", pa.int32()), ("c", pa.int64()), ("n", pa.int32()), ("p", pa.binary())])
_POST_DDL = "unit int, c long, n int, p binary"


def _packed(parts: list[np.ndarray], lens: list[np.ndarray]) -> pa.Array:
    """A binary value per row: the row's elements of each part (flat uint32 arrays) one after another."""
    total = sum(lens)
    ends = np.concatenate(([0], np.cumsum(total)))
    flat, at = np.empty(int(ends[-1]), np.uint32), ends[:-1].copy()
    for x, n in zip(parts, lens):
        flat[np.repeat(at - (np.cumsum(n) - n), n) + np.arange(len(x))] = x
        at = at + n
    return pa.Array.from_buffers(pa.binary(), len(total), [None, pa.py_buffer((ends * 4).astype(np.int32)), pa.py_buffer(flat)])


def _classes(s: Sets, live: np.ndarray) -> np.ndarray:
    raw = memoryview(s.h.tobytes())
    return np.array([xxhash.xxh3_64_intdigest(raw[8 * s.begin[r] : 8 * s.begin[r + 1]]) for r in live], np.uint64).view(np.int64)


def _posting_batches(batches: Iterator[pa.RecordBatch], args: tuple, order: Order, t: float) -> Iterator[pa.RecordBatch]:
    """Rows with n > 0 are postings; those with n = 0 tell the class c of the record in p."""
    known, seen, F_ = WordHash(), set(), order.fragments()
    for b in batches:
        s = Sets(b.column("__text").to_pylist(), known, *args)
        ids = b.column("__key").to_numpy(zero_copy_only=False)
        live = np.flatnonzero(s.size)
        cls = _classes(s, live)
        of_id = pa.Array.from_buffers(pa.binary(), len(live), [None, pa.py_buffer((np.arange(len(live) + 1) * 8).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(ids[live], np.int64))])
        yield pa.RecordBatch.from_arrays([pa.array((mix(ids[live].astype(np.uint64)) % np.uint64(F_)).astype(np.int32)), pa.array(cls), pa.array(np.zeros(len(live), np.int32)), of_id], schema=_POST)
        if len(seen) > 1 << 20:
            seen.clear()
        first = np.zeros(len(s.size), bool)
        for r, c in zip(live.tolist(), cls.tolist()):
            if c not in seen:
                seen.add(c)
                first[r] = True
        of_class = np.zeros(len(s.size), np.int64)
        of_class[live] = cls
        keep = first[s.rec]
        h, rec = s.h[keep], s.rec[keep]
        if not len(h):
            continue
        maps = bitmaps(h, rec, s.size)
        key = order.key(h)
        o = np.lexsort((key, rec))
        h, rec, key = h[o], rec[o], key[o]
        start = _runs(rec)
        place = np.arange(len(rec)) - np.repeat(start, np.diff(np.append(start, len(rec))))
        size = s.size[rec]
        prefix = place < size - np.ceil(t * size - 1e-9).astype(np.int64) + 1
        h, rec, place, key = h[prefix], rec[prefix], place[prefix], key[prefix]
        unit = np.searchsorted(order.cuts, key, "right")
        blocks = np.ceil(order.count(key >> np.uint64(56)) / order.hot).astype(np.int64)
        hot = blocks > 1
        if hot.any():  # one row for each pair of blocks that the record's own is in
            k, hr, hh = blocks[hot], rec[hot], h[hot]
            own = (mix(of_class[hr].view(np.uint64)) % k.astype(np.uint64)).astype(np.int64)
            x = np.repeat(np.arange(len(k)), k)
            other = np.arange(len(x)) - np.repeat(np.cumsum(k) - k, k)
            lo, hi = np.minimum(own[x], other), np.maximum(own[x], other)
            mark = np.where(lo == hi, 0, _CROSS) | np.where((own[x] == hi) & (lo != hi), _SIDE, 0)
            pair_unit = F_ + (mix(hh[x] + mix((lo * 65_537 + hi).astype(np.uint64))) % np.uint64(1 << 30)).astype(np.int64)
            h, rec, unit = np.concatenate([h[~hot], hh[x]]), np.concatenate([rec[~hot], hr[x]]), np.concatenate([unit[~hot], pair_unit])
            place = np.concatenate([place[~hot], place[hot][x] | mark])
        o = np.lexsort((place, unit, rec))
        h, rec, place, unit = h[o], rec[o], place[o], unit[o]
        at = _runs(rec, unit)
        n = np.diff(np.append(at, len(h)))
        rows = rec[at]
        bits = [np.frombuffer(maps[r], np.uint32) for r in rows.tolist()]
        p = _packed([np.concatenate(bits), (h & np.uint64(0xFFFFFFFF)).astype(np.uint32), place.astype(np.uint32)], [np.array([len(x) for x in bits]), n, n])
        yield pa.RecordBatch.from_arrays([pa.array(unit[at].astype(np.int32)), pa.array(of_class[rows]), pa.array(s.size[rows].astype(np.int32)), p], schema=_POST)


def _binary(column: pa.ChunkedArray | pa.Array, dtype) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column as one array, and the length of each value in elements."""
    flat, lens = [], []
    for c in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        off = np.frombuffer(c.buffers()[1], np.int32)[c.offset : c.offset + len(c) + 1]
        data = c.buffers()[2]
        flat.append(np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None and len(c) else np.zeros(0, np.uint8))
        lens.append(np.diff(off))
    width = np.dtype(dtype).itemsize
    joined = np.concatenate(flat) if flat else np.zeros(0, np.uint8)
    return joined.view(dtype), (np.concatenate(lens) if lens else np.zeros(0, np.int32)) // width


def _within(low: np.ndarray, high: np.ndarray, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j) with low[i] <= j < high[i], at most about ``limit`` at a time."""
    count = np.maximum(0, high - low)
    upto, at = np.cumsum(count), 0
    while at < len(count):
        stop = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + limit, "right")))
        c = count[at:stop]
        if total := int(c.sum()):
            yield np.repeat(np.arange(at, stop), c), np.arange(total) + np.repeat(low[at:stop] - (np.cumsum(c) - c), c)
        at = stop


def _near(group: np.ndarray, n: np.ndarray, place: np.ndarray, t: float, limit: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of one group (ids from 0) that the bounds on size and place let through, at most about ``limit`` at a time.

    An element reaches sizes up to ``reach``, where its place still leaves the overlap that the two need; each of a pair must
    reach the other. The smaller of them then reaches its own size. Those that do are looked up by size among
    themselves, where the bounds are met on both sides, and beside those that don't, from the side with fewer to look at.
    """
    least = needed(np.arange(2 * int(n.max(initial=0)) + 2), np.zeros(1, np.int64), t)  # by the sum of two sizes
    reach = np.searchsorted(least, n - place, "right") - 1 - n
    wide = int(max(n.max(initial=0), reach.max(initial=0))) + 2
    own = reach >= n

    def upto(keys: np.ndarray, g: np.ndarray, size: np.ndarray) -> np.ndarray:
        """How many keys come before the ones of the group with more than the size."""
        return np.searchsorted(keys, g * wide + np.clip(size, -1, wide - 2) + 1, "right")

    e, f = np.flatnonzero(own), np.flatnonzero(~own)
    e, f = e[np.lexsort((n[e], group[e]))], f[np.lexsort((n[f], group[f]))]
    keys, others = group[e] * wide + n[e] + 1, group[f] * wide + n[f] + 1
    for i, j in _within(np.arange(len(e)) + 1, upto(keys, group[e], reach[e]), limit):
        yield e[i], e[j]
    if not len(e) or not len(f):
        return
    low, high = upto(others, group[e], n[e]), upto(others, group[e], reach[e])
    back, top = upto(keys, group[f], np.ceil(t * n[f] - 1e-6).astype(np.int64) - 1), upto(keys, group[f], reach[f])
    groups = int(group.max()) + 1
    ahead = np.bincount(group[e], np.maximum(0, high - low), groups) <= np.bincount(group[f], np.maximum(0, top - back), groups)
    for i, j in _within(low, np.where(ahead[group[e]], high, low), limit):
        ok = n[e[i]] <= reach[f[j]]
        yield e[i[ok]], f[j[ok]]
    for j, i in _within(back, np.where(ahead[group[f]], back, top), limit):
        ok = n[f[j]] <= reach[e[i]]
        yield e[i[ok]], f[j[ok]]


_OUT = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("member", pa.bool_())])


def _meet_batches(batches: Iterator[pa.RecordBatch], t: float) -> Iterator[pa.RecordBatch]:
    """Pairs of classes (a, b) that meet within the bounds; (class, id) with ``member`` set for records.

    Rows come sorted by unit; whole units are worked on once enough rows are there, so a task holds a unit, not all of its own.
    """
    held: list[pa.RecordBatch] = []
    waiting = 0
    for b in batches:
        member = b.column("n").to_numpy() == 0
        m = b.filter(pa.array(member))
        ids = _binary(m.column("p"), np.int64)[0]
        yield pa.RecordBatch.from_arrays([m.column("c"), pa.array(ids), pa.array(np.ones(len(m), bool))], schema=_OUT)
        b = b.filter(pa.array(~member))
        if not len(b):
            continue
        unit = b.column("unit").to_numpy()
        if waiting + len(b) > 1 << 15:
            last = int(np.searchsorted(unit, unit[-1], "left"))  # rows before it belong to units that are complete
            if held and (last or held[-1].column("unit")[-1].as_py() != unit[0]):
                yield from _meet(pa.Table.from_batches([*held, b.slice(0, last)]), t)
                held, waiting, b = [], 0, b.slice(last)
        held.append(b)
        waiting += len(b)
    if held:
        yield from _meet(pa.Table.from_batches(held), t)


def _meet(tab: pa.Table, t: float) -> Iterator[pa.RecordBatch]:
    c, unit = tab.column("c").to_numpy(), tab.column("unit").to_numpy().astype(np.int64)
    n = tab.column("n").to_numpy().astype(np.int64)
    flat, lens = _binary(tab.column("p"), np.uint32)
    lens = lens.astype(np.int64)
    width = map_bits(n) // 32
    begin = np.cumsum(lens) - lens
    k = (lens - width) // 2
    inner = np.arange(int(k.sum())) - np.repeat(np.cumsum(k) - k, k)
    row = np.repeat(np.arange(len(c)), k)
    gram = flat[(begin + width)[row] + inner]
    mark = flat[(begin + width + k)[row] + inner]
    at_map = np.repeat(begin - (np.cumsum(width) - width), width) + np.arange(int(width.sum()))
    maps = Maps(flat[at_map].view(np.uint64), width // 2)
    o = np.lexsort((c, unit))
    dup = np.zeros(len(c), bool)  # copies that other map tasks posted
    dup[o[1:]] = (c[o][1:] == c[o][:-1]) & (unit[o][1:] == unit[o][:-1])
    keep = ~dup[row]
    gram, mark, row = gram[keep], mark[keep], row[keep]
    o = np.lexsort((gram, unit[row]))
    gram, mark, row = gram[o], mark[o], row[o]
    start = _runs(unit[row], gram) if len(row) else np.zeros(0, np.int64)
    length = np.diff(np.append(start, len(row)))
    shared = np.repeat(length > 1, length)
    mark, row, length = mark[shared], row[shared], length[length > 1]
    place, cross, side = (mark & np.uint32(_CROSS - 1)).astype(np.int64), (mark & np.uint32(_CROSS)) > 0, (mark & np.uint32(_SIDE)) > 0
    found: list[np.ndarray] = []
    crossed = bool(cross.any())
    least = needed(np.arange(2 * int(n.max(initial=0)) + 2), np.zeros(1, np.int64), t)
    for i, j in _near(np.repeat(np.arange(len(length)), length), n[row], place, t):
        if crossed:
            ok = ~cross[i] | (side[i] != side[j])
            i, j = i[ok], j[ok]
        x, y = row[i], row[j]
        both = n[x] + n[y]
        ok = both - maps.apart(x, y) >= 2 * least[both]
        x, y = c[x[ok]], c[y[ok]]
        found.append(np.stack([np.minimum(x, y), np.maximum(x, y)], 1)[x != y])
        if sum(map(len, found)) > 1 << 20:
            yield _distinct(found)
            found = []
    if found:
        yield _distinct(found)


def _distinct(found: list[np.ndarray]) -> pa.RecordBatch:
    u = np.unique(np.concatenate(found), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(u[:, 0]), pa.array(u[:, 1]), pa.array(np.zeros(len(u), bool))], schema=_OUT)


def _fragment_batches(batches: Iterator[pa.RecordBatch], args: tuple, order: Order) -> Iterator[pa.RecordBatch]:
    """(class, size, fragment, n-grams): the sets of records cut at the coarse cuts of the order."""
    known = WordHash()
    for b in batches:
        s = Sets(b.column("__text").to_pylist(), known, *args)
        live = np.flatnonzero(s.size)
        of_class = np.zeros(len(s.size), np.int64)
        of_class[live] = _classes(s, live)
        frag = np.searchsorted(order.coarse, order.key(s.h), "right")
        o = np.lexsort((s.h, frag, s.rec))
        h, rec, frag = s.h[o], s.rec[o], frag[o]
        at = _runs(rec, frag) if len(h) else np.zeros(0, np.int64)
        n = np.diff(np.append(at, len(h)))
        grams = _packed([h.view(np.uint32)], [2 * n])
        yield pa.RecordBatch.from_arrays([pa.array(of_class[rec[at]]), pa.array(s.size[rec[at]].astype(np.int32)), pa.array(frag[at].astype(np.int32)), grams], ["c", "n", "frag", "grams"])


def _overlap_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The partial overlap of each pair in one fragment; n-grams are distinct on either side."""
    for b in batches:
        h, rec = [], []
        for side in ("grams_a", "grams_b"):
            x, k = _binary(b.column(side), np.uint64)
            h.append(x)
            rec.append(np.repeat(np.arange(len(b)), k))
        h, rec = np.concatenate(h), np.concatenate(rec)
        o = np.lexsort((h, rec))
        h, rec = h[o], rec[o]
        same = rec[1:][(h[1:] == h[:-1]) & (rec[1:] == rec[:-1])]
        yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(np.bincount(same, minlength=len(b)).astype(np.int64))], ["a", "b", "shared"])


class NearDuplicates:
    """``links``: (class_a, class_b, similarity) of classes that differ; ``members``: (id, class)."""

    def __init__(self, links: DataFrame, members: DataFrame) -> None:
        self.links, self.members = links, members


def near_duplicates(
    docs: DataFrame,
    key: str,
    text: str,
    threshold: float = 0.8,
    n: int = 5,
    min_words: int = 0,
    strip_tags: bool = False,
    order_bits: int = 20,
    fragments: int | None = None,
    load: int = LOAD,
    hot: int = HOT,
) -> NearDuplicates:
    """Classes of equal n-gram sets and the links between classes of similarity >= ``threshold``.

    Similarity is Jaccard over distinct runs of ``n`` consecutive words. Texts of fewer than
    ``max(n, min_words)`` words, null texts and null keys take no part; a repeated key counts once
    per distinct text. Ties at the threshold are links. Empty tables give no rows. Other columns
    are not read. Keys must be integers.

    ``fragments`` is the least number of ranges of the order, ``spark.sql.shuffle.partitions`` by default; there are more
    where the n-grams of all records ask for it (about ``load`` postings a range, up to ``MOST_RANGES``); lists longer than ``hot``,
    and 8 times what a bucket of the sketch holds on average, are cut into blocks, so ``order_bits`` should grow with data
    beyond some hundred GB. None of these changes the result. Sets have 64-bit keys.
    """
    spark = docs.sparkSession
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be in (0, 1]")
    least = fragments or int(spark.conf.get("spark.sql.shuffle.partitions"))
    args = (n, max(n, min_words), strip_tags)
    base = docs.where(F.col(text).isNotNull() & F.col(key).isNotNull()).select(F.col(key).cast("long").alias("__key"), F.col(text).alias("__text"))
    order = Order(order_levels(base, args, order_bits), order_bits, threshold, least, load, hot)
    shared = spark.sparkContext.broadcast(order)
    posted = base.mapInArrow(lambda it: _posting_batches(it, args, shared.value, threshold), _POST_DDL)
    parts = min(order.fragments(), max(least, MOST_PARTS))
    spread = posted.repartitionById(parts, F.pmod("unit", F.lit(parts))).sortWithinPartitions("unit")
    met = cut_lineage(spread.mapInArrow(lambda it: _meet_batches(it, threshold), "a long, b long, member boolean"))
    members = met.where("member").select(F.col("b").alias("id"), F.col("a").alias("class")).distinct()
    pairs = cut_lineage(met.where("not member").select("a", "b").distinct())
    wanted = pairs.select(F.col("a").alias("class")).union(pairs.select("b")).distinct()
    rep = cut_lineage(members.join(wanted, "class").groupBy("class").agg(F.min("id").alias("__key")).select("__key"))
    cut = semi_checked(base, rep, "__key").mapInArrow(lambda it: _fragment_batches(it, args, shared.value), "c long, n int, frag int, grams binary")
    # a repeated key may bring several sets: those that no pair names fall out of the joins
    cut = cut_lineage(cut.groupBy("c", "frag").agg(F.max("n").alias("n"), F.max("grams").alias("grams")))
    both = pairs.join(cut.withColumnsRenamed({"c": "a", "n": "n_a", "grams": "grams_a"}), "a").join(cut.select(F.col("c").alias("b"), "frag", F.col("grams").alias("grams_b")), ["b", "frag"])
    partial = both.select("a", "b", "grams_a", "grams_b").mapInArrow(_overlap_batches, "a long, b long, shared long")
    sums = partial.groupBy("a", "b").agg(F.sum("shared").alias("shared"))
    size = cut.groupBy("c").agg(F.max("n").alias("n"))
    sums = sums.join(size.withColumnsRenamed({"c": "a", "n": "n_a"}), "a").join(size.withColumnsRenamed({"c": "b", "n": "n_b"}), "b")
    similarity = F.col("shared") / (F.col("n_a") + F.col("n_b") - F.col("shared"))
    links = sums.select(F.col("a").alias("class_a"), F.col("b").alias("class_b"), similarity.alias("similarity")).where(F.col("similarity") >= threshold - 1e-12)
    return NearDuplicates(cut_lineage(links), members)


def expanded_pairs(found: NearDuplicates) -> DataFrame:
    """All pairs of records: (id_a, id_b, similarity), the smaller key first; 1.0 within a class."""
    m = found.members
    a, b = m.withColumnsRenamed({"id": "id_a", "class": "class_a"}), m.withColumnsRenamed({"id": "id_b", "class": "class_b"})
    across = found.links.join(a, "class_a").join(b, "class_b").select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b"), "similarity").where("id_a <> id_b")
    large = cut_lineage(m.groupBy("class").agg(F.count("*").alias("k")).where("k > 1").select("class"))
    inner = semi_checked(m, large, "class", row_bytes=16)
    within = inner.withColumnRenamed("id", "id_a").join(inner.withColumnRenamed("id", "id_b"), "class").where("id_a < id_b").select("id_a", "id_b", F.lit(1.0).alias("similarity"))
    return across.unionByName(within).groupBy("id_a", "id_b").agg(F.max("similarity").alias("similarity"))


def groups(found: NearDuplicates) -> DataFrame:
    """One row per record: (id, group_id, n_copies, n_links).

    ``group_id`` is the smallest id that links reach; ``n_copies`` counts the records with an equal
    set, ``n_links`` the different sets linked to it.
    """
    links = found.links
    rep = cut_lineage(found.members.groupBy("class").agg(F.min("id").alias("rep"), F.count("*").alias("n_copies")))
    edges = links.join(rep.select(F.col("class").alias("class_a"), F.col("rep").alias("src")), "class_a").join(rep.select(F.col("class").alias("class_b"), F.col("rep").alias("dst")), "class_b").select("src", "dst")
    label = connected_components(edges)
    ends = links.select(F.col("class_a").alias("class")).unionAll(links.select("class_b")).groupBy("class").agg(F.count("*").alias("n_links"))
    per = rep.join(ends, "class", "left").join(label.withColumnRenamed("node", "rep"), "rep", "left").select("class", F.coalesce("component", "rep").alias("group_id"), "n_copies", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    return found.members.join(per, "class").select("id", "group_id", "n_copies", "n_links")
