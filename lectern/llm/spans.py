"""Long spans that stand character for character in more than one record (problem 9).

Method: runs of consecutive sentences are hashed and joined globally. A "sentence" is cut
after ``. ! ? … , ; :`` and one white space, and after a line feed; a stretch longer than ``Cuts.long`` without
such an end is cut at blanks after some letters, and where it is still longer, where the hash of a short
gram is the least of its neighbourhood, so that equal text is cut alike in both records whatever
stands around it. Two lengths of runs begin at each cut:

* *seeds*, the shortest runs of ``Cuts.run`` characters, a third of ``min_chars``. Any shared span of ``min_chars`` or more
  holds a whole seed that is a seed in both records, and every seed between firm cuts (those of the first two kinds)
  that it holds is shared;
* *whole runs*, the shortest of ``min_chars``, whose seeds are all shared. One that another record has too is a shared
  span by itself.

Spans begin and end anywhere, so the ends of spans (and spans that hold no whole run) are decided by windows of exactly
``min_chars`` characters, but only where sentences leave it open: windows that hold a shared seed, no firm
seed that isn't shared, and lie within no shared run. Windows within shared runs are hashed only where they hold a seed of
an open window. So a long copy costs a row for each of its sentences and a few rows for each end.

Stages work on records with shared seeds only, after the first two. No pairs are formed at any stage, so a span
that stands in a third of all records costs one row per record. Hashes have 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.words import mix
from lectern.plans import cut_lineage, join_checked, semi_checked

CHUNK = 1 << 20
_BASE = 0x9E3779B97F4A7C15


class Cuts:
    """Lengths that follow from ``min_chars``: with 2 * long + run + 2 <= min_chars every shared span holds a common seed."""

    def __init__(self, min_chars: int) -> None:
        self.run = min_chars // 3
        self.long = (min_chars - self.run - 2) // 2
        self.gram = min(8, self.long // 3)
        self.reach = max(1, (self.long - self.gram - 5) // 2)
        self.min_chars = min_chars
        if self.gram < 1:
            raise ValueError("min_chars must be at least 12")


def _table(chars: str) -> np.ndarray:
    out = np.zeros(1 << 16, bool)
    out[[ord(c) for c in chars]] = True
    return out


_STOP, _LETTER = _table(".!?…,;:"), _table("dnrнй")
_SPACE = _table("".join(c for c in map(chr, range(1 << 16)) if c.isspace()))


class _Powers:
    """Powers of the hash base and of its inverse, grown as needed and kept per worker."""

    up = down = np.zeros(0, np.uint64)

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            cls.up = np.cumprod(np.full(n, _BASE, np.uint64))
            cls.down = np.cumprod(np.full(n, pow(_BASE, -1, 1 << 64), np.uint64))
        return cls.up[:n], cls.down[:n]


class Chunk:
    """Some texts end to end, a place apart: their cuts and seeds, and hashes of any of their stretches."""

    def __init__(self, texts: list[str], cuts: Cuts) -> None:
        self.rule = cuts
        size = np.array([len(t) for t in texts], np.int64)
        self.begin = np.cumsum(size + 1) - (size + 1)
        self.end = self.begin + size
        self.code = np.frombuffer("\0".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
        up, self._down = _Powers.get(len(self.code))
        self._sum = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(self.code.astype(np.uint64) + np.uint64(1)) * up)))
        self._cut()
        last = np.searchsorted(self.cuts, self.cuts + cuts.run)
        to = self.cuts[np.minimum(last, len(self.cuts) - 1)]
        self.of = np.searchsorted(self.begin, self.cuts, "right") - 1
        ok = (last < len(self.cuts)) & (to <= self.end[self.of])
        #: Seeds: begin, end, text, and whether they lie between firm cuts.
        self.seed, self.stop, self.of = self.cuts[ok], to[ok], self.of[ok]

    def hash(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self._sum[end] - self._sum[begin]) * self._down[begin]
        return mix(h + (end - begin).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)

    def _cut(self) -> None:
        """``cuts`` and ``firm``, both with the begins and ends of texts. Firm ones depend on two characters only."""
        c = np.minimum(self.code, 0xFFFF)
        ends = (c == 10) | np.append(False, _STOP[c[:-1]] & _SPACE[c[1:]])
        edges = np.concatenate([self.begin, self.end])
        self.firm = firm = np.unique(np.concatenate([edges, np.flatnonzero(ends) + 1]))
        wide = np.append(np.diff(firm) > self.rule.long, False)
        wide[np.searchsorted(firm, self.end)] = False  # from a text to the next
        part = np.flatnonzero(np.append(False, _LETTER[c[:-1]] & (c[1:] == 32))) + 1
        at = np.searchsorted(firm, part, "right") - 1
        cuts = np.unique(np.concatenate([firm, part[wide[at]]]))
        gap = np.flatnonzero(np.diff(cuts) > self.rule.long)
        gap = gap[wide[np.searchsorted(firm, cuts[gap], "right") - 1]]
        more = [cuts[i] + self._winnowed(int(cuts[i]), int(cuts[i + 1])) for i in gap.tolist()]
        self.cuts = np.unique(np.concatenate([cuts, *more])) if more else cuts

    def _winnowed(self, a: int, b: int) -> np.ndarray:
        """Places of the least hash of a gram in every window of ``reach`` places."""
        g = self.rule.gram
        at = np.arange(a, b - g + 1)
        h = self.hash(at, at + g).view(np.uint64)
        least = np.lib.stride_tricks.sliding_window_view(h, self.rule.reach).argmin(axis=1)
        p = np.unique(least + np.arange(len(least)))
        return p[p > 0]

    def is_firm(self) -> np.ndarray:
        """Seeds that begin and end at a firm cut within their text."""
        inner = np.isin(self.seed, self.firm) & np.isin(self.stop, self.firm)
        return inner & (self.seed > self.begin[self.of]) & (self.stop < self.end[self.of])


def _chunks(b: pa.RecordBatch, cuts: Cuts) -> Iterator[tuple[int, Chunk]]:
    """(first row, chunk) of a batch, about CHUNK characters at a time."""
    texts, low, size = b.column("__text").to_pylist(), 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= CHUNK or i == len(texts) - 1:
            yield low, Chunk(texts[low : i + 1], cuts)
            low, size = i + 1, 0


def _seed_batches(batches: Iterator[pa.RecordBatch], cuts: Cuts) -> Iterator[pa.RecordBatch]:
    """(h, t): seeds with the hash of their text."""
    for b in batches:
        t = b.column("__hash").to_numpy(zero_copy_only=False)
        for low, c in _chunks(b, cuts):
            yield pa.RecordBatch.from_arrays([pa.array(c.hash(c.seed, c.stop)), pa.array(t[low + c.of])], ["h", "t"])


def _place_batches(batches: Iterator[pa.RecordBatch], cuts: Cuts) -> Iterator[pa.RecordBatch]:
    """(h, __key, at): seeds with their record and place."""
    for b in batches:
        for low, c in _chunks(b, cuts):
            yield pa.RecordBatch.from_arrays([pa.array(c.hash(c.seed, c.stop)), b.column("__key").take(pa.array(low + c.of)), pa.array((c.seed - c.begin[c.of]).astype(np.int32))], ["h", "__key", "at"])


def _lists(column: pa.Array, low: int, c: Chunk) -> np.ndarray:
    """The places listed for the texts of a chunk, as places of the chunk."""
    part = column.slice(low, len(c.begin))
    n = np.asarray(pc.fill_null(pc.list_value_length(part), 0))
    return np.repeat(c.begin, n) + np.asarray(part.flatten(), np.int64)


def _whole_runs(c: Chunk, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and text of the shortest runs of ``min_chars`` characters whose seeds are all shared."""
    last = np.searchsorted(c.cuts, c.seed + c.rule.min_chars)
    to = c.cuts[np.minimum(last, len(c.cuts) - 1)]
    other = np.concatenate(([0], np.cumsum(~shared)))
    inside = np.searchsorted(c.stop, to, "right")  # seeds that end within
    ok = (last < len(c.cuts)) & (to <= c.end[c.of]) & (other[np.maximum(inside, np.arange(len(to)))] == other[np.arange(len(to))])
    return c.seed[ok], to[ok], c.of[ok]


def _run_batches(batches: Iterator[pa.RecordBatch], cuts: Cuts) -> Iterator[pa.RecordBatch]:
    """(h, __key, b, e) of whole runs."""
    for batch in batches:
        for low, c in _chunks(batch, cuts):
            b, e, of = _whole_runs(c, np.isin(c.seed, _lists(batch.column("shared"), low, c)))
            yield pa.RecordBatch.from_arrays([pa.array(c.hash(b, e)), batch.column("__key").take(pa.array(low + of)), pa.array((b - c.begin[of]).astype(np.int32)), pa.array((e - c.begin[of]).astype(np.int32))], ["h", "__key", "b", "e"])


def _cover(n: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """For each of n places, in how many of the ranges low..high (both included) it lies."""
    ok = low <= high
    return np.cumsum(np.bincount(low[ok], minlength=n + 1) - np.bincount(high[ok] + 1, minlength=n + 1))[:n]


def _within(c: Chunk, batch: pa.RecordBatch, low: int) -> np.ndarray:
    """Windows of a chunk that lie within a shared run."""
    b, e = (_lists(batch.column(k), low, c) for k in ("b", "e"))
    return _cover(len(c.code), b, e - c.rule.min_chars) > 0


def _window_batches(batches: Iterator[pa.RecordBatch], cuts: Cuts) -> Iterator[pa.RecordBatch]:
    """(h, __key, at) of open windows; rows without a place are the seeds that open windows hold."""
    m = cuts.min_chars
    for batch in batches:
        keys = batch.column("__key")
        for low, c in _chunks(batch, cuts):
            n = len(c.code)
            shared = np.isin(c.seed, _lists(batch.column("shared"), low, c))
            first, last = np.maximum(c.begin[c.of], c.stop - m), np.minimum(c.seed, c.end[c.of] - m)  # windows with the seed
            held = _cover(n, first[shared], last[shared]) > 0
            apart = ~shared & c.is_firm()
            # the two characters that make the cut before a seed must lie in the window for its cut to be there too
            other = _cover(n, first[apart], np.minimum(c.seed[apart] - 2, last[apart])) > 0
            at = np.flatnonzero(held & ~other & ~_within(c, batch, low))
            of = np.searchsorted(c.begin, at, "right") - 1
            yield pa.RecordBatch.from_arrays([pa.array(c.hash(at, at + m)), keys.take(pa.array(low + of)), pa.array((at - c.begin[of]).astype(np.int32))], ["h", "__key", "at"])
            upto = np.concatenate(([0], np.cumsum(np.bincount(at, minlength=n))))
            some = shared & (first <= last)
            some[some] = upto[last[some] + 1] > upto[first[some]]
            h = np.unique(c.hash(c.seed[some], c.stop[some]))
            none = pa.nulls(len(h), keys.type)
            yield pa.RecordBatch.from_arrays([pa.array(h), none, pa.nulls(len(h), pa.int32())], ["h", "__key", "at"])


def _partner_batches(batches: Iterator[pa.RecordBatch], cuts: Cuts, anywhere: bool) -> Iterator[pa.RecordBatch]:
    """(h, __key, at) of windows that hold one of the seeds at ``open``: those within shared runs, or ``anywhere``."""
    m = cuts.min_chars
    for batch in batches:
        for low, c in _chunks(batch, cuts):
            seed = np.isin(c.seed, _lists(batch.column("open"), low, c))
            first, last = np.maximum(c.begin[c.of], c.stop - m), np.minimum(c.seed, c.end[c.of] - m)
            held = _cover(len(c.code), first[seed], last[seed]) > 0
            at = np.flatnonzero(held if anywhere else held & _within(c, batch, low))
            of = np.searchsorted(c.begin, at, "right") - 1
            yield pa.RecordBatch.from_arrays([pa.array(c.hash(at, at + m)), batch.column("__key").take(pa.array(low + of)), pa.array((at - c.begin[of]).astype(np.int32))], ["h", "__key", "at"])


class _Shared:
    """``parts``: (__key, b, e, is_first) stretches that another record has; their unions are the shared spans."""

    def __init__(self, docs: DataFrame, key: str, text: str, min_chars: int, records_only: bool = False) -> None:
        cuts = Cuts(min_chars)
        kind = docs.schema[key].dataType.simpleString()
        base = docs.where(F.col(text).isNotNull() & F.col(key).isNotNull() & (F.length(text) >= min_chars)).select(F.col(key).alias("__key"), F.col(text).alias("__text"), F.xxhash64(text).alias("__hash"))
        copies = cut_lineage(base.groupBy("__hash").agg(F.countDistinct("__key").alias("n"), F.min("__key").alias("first")).where("n > 1"))
        whole = join_checked(base.select("__key", "__hash", F.length("__text").alias("e")), copies.select("__hash", "first"), "__hash")
        whole = cut_lineage(whole.groupBy("__key").agg(F.max("e").alias("e"), F.bool_and(F.col("first") == F.col("__key")).alias("is_first")).select("__key", F.lit(0).alias("b"), "e", "is_first"))
        seeds = base.select("__hash", "__text").mapInArrow(lambda it: _seed_batches(it, cuts), "h long, t long")
        hot = cut_lineage(seeds.groupBy("h").agg(F.min("t").alias("lo"), F.max("t").alias("hi")).where("lo < hi").select("h"))
        found = cut_lineage(semi_checked(base.select("__key", "__text").mapInArrow(lambda it: _place_batches(it, cuts), f"h long, __key {kind}, at int"), hot, "h"))
        held = cut_lineage(found.groupBy("__key").agg(F.collect_set("at").alias("shared")))
        size = 40 + 4 * F.size("shared")
        texts = join_checked(base.select("__key", "__text"), held, "__key", row_bytes=size)
        runs = cut_lineage(texts.mapInArrow(lambda it: _run_batches(it, cuts), f"h long, __key {kind}, b int, e int"))
        both = cut_lineage(runs.groupBy("h").agg(F.min("__key").alias("first"), F.max("__key").alias("last")).where("first < last").select("h", "first"))
        sure = cut_lineage(join_checked(runs, both, "h").select("__key", "b", "e", (F.col("first") == F.col("__key")).alias("is_first")).unionByName(whole))
        # windows within any of these runs need no hash of their own; where only records are asked for, no window of their records does,
        # but then all those with a seed of an open window are its possible partners
        inside = cut_lineage(sure.groupBy("__key").agg(F.collect_list("b").alias("b"), F.collect_list("e").alias("e")))
        listed = join_checked(held, inside, "__key", "left", row_bytes=40 + 8 * F.size("b"))
        asked = listed.where("b is null") if records_only else listed
        asked = cut_lineage(asked)
        open_ = join_checked(base.select("__key", "__text"), asked, "__key", row_bytes=size + 8 * F.greatest(F.size("b"), F.lit(0)))
        windows = cut_lineage(open_.mapInArrow(lambda it: _window_batches(it, cuts), f"h long, __key {kind}, at int"))
        wanted = cut_lineage(windows.where("at is null").select("h").distinct())
        places = join_checked(found, wanted, "h", "left_semi", row_bytes=24).groupBy("__key").agg(F.collect_set("at").alias("open"))
        places = cut_lineage(join_checked(places, inside, "__key", row_bytes=40 + 8 * F.size("b")))
        partners = join_checked(base.select("__key", "__text"), places, "__key", row_bytes=40 + 4 * F.size("open") + 8 * F.size("b"))
        windows = windows.where("at is not null").unionByName(partners.mapInArrow(lambda it: _partner_batches(it, cuts, records_only), f"h long, __key {kind}, at int"))
        two = windows.groupBy("h").agg(F.min("__key").alias("first"), F.max("__key").alias("last")).where("first < last").select("h", "first")
        hits = windows.join(two, "h").select("__key", F.col("at").alias("b"), (F.col("at") + min_chars).alias("e"), (F.col("first") == F.col("__key")).alias("is_first"))
        self.parts = sure.unionByName(hits)


def _merged(parts: DataFrame) -> DataFrame:
    """``__key, span_begin, span_end, is_first``: unions of stretches that overlap or touch."""
    before = Window.partitionBy("__key").orderBy("b", "e").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("__key").orderBy("b", "e").rowsBetween(Window.unboundedPreceding, 0)
    new = parts.groupBy("__key", "b", "e").agg(F.bool_and("is_first").alias("is_first")).withColumn("new", (F.col("b") > F.coalesce(F.max("e").over(before), F.lit(-1))).cast("int"))
    return new.withColumn("span", F.sum("new").over(upto)).groupBy("__key", "span").agg(F.min("b").alias("span_begin"), F.max("e").alias("span_end"), F.bool_and("is_first").alias("is_first")).drop("span")


def shared_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = 240) -> DataFrame:
    """The maximal stretches made up of spans of ``min_chars`` characters that stand in another record too.

    One row per record and stretch: ``<key>, span_begin, span_end`` (code points, end excluded) and
    ``is_first``, true if no record with a smaller key holds any part of ``min_chars`` of it. Records
    whose whole text stands elsewhere have one stretch over all of it.

    Null texts and null keys give no rows, nor do texts under ``min_chars``; an empty table gives
    no rows; repeated rows with the same key count once; other columns of ``docs`` are not read,
    so their names can't clash. ``min_chars`` must be at least 12.
    """
    return _merged(_Shared(docs, key, text, min_chars).parts).withColumnRenamed("__key", key)


def shared_records(docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = 240) -> DataFrame:
    """``<key>`` of the records that :func:`shared_spans` has a stretch for, without looking for its ends."""
    return _Shared(docs, key, text, min_chars, records_only=True).parts.select("__key").distinct().withColumnRenamed("__key", key)


def shared_shares(docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = 240) -> DataFrame:
    """How much of every record stands elsewhere too.

    One row per distinct non-null key: ``<key>, n_chars, shared_chars, shared_share`` (0.0 where nothing
    is shared) and ``removable_chars``, the characters in spans of ``min_chars`` that an earlier key holds too. A key
    that is repeated counts with its longest text; null texts have 0 characters.
    """
    parts = cut_lineage(_Shared(docs, key, text, min_chars).parts)
    total = lambda df, name: _merged(df).groupBy("__key").agg(F.sum(F.col("span_end") - F.col("span_begin")).alias(name))
    per = total(parts, "shared_chars").join(total(parts.where("not is_first"), "removable_chars"), "__key", "left")
    rows = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("__key"), F.coalesce(F.length(text), F.lit(0)).alias("n")).groupBy("__key").agg(F.max("n").alias("n_chars"))
    out = rows.join(per, "__key", "left").select(
        F.col("__key").alias(key),
        F.col("n_chars").cast("long"),
        F.coalesce("shared_chars", F.lit(0)).cast("long").alias("shared_chars"),
        F.coalesce("removable_chars", F.lit(0)).cast("long").alias("removable_chars"),
    )
    return out.withColumn("shared_share", F.when(F.col("n_chars") > 0, F.col("shared_chars") / F.col("n_chars")).otherwise(F.lit(0.0)))


def _trim_batches(batches: Iterator[pa.RecordBatch], cuts: Cuts) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, kept = batch.column("__text").to_pylist(), []
        for low, c in _chunks(batch, cuts):
            b, e = (_lists(batch.column(k), low, c) for k in ("b", "e"))
            gone = _cover(len(c.code), b, e - 1) > 0
            holes = np.concatenate(([0], np.cumsum(~gone)))
            a, z = c.cuts[:-1], c.cuts[1:]
            of = np.searchsorted(c.begin, a, "right") - 1
            mine = z <= c.end[of]  # sentences, not the step from a text to the next
            stay = mine & (holes[z] > holes[a])
            for i in range(len(c.begin)):
                t = texts[low + i]
                s = np.arange(*np.searchsorted(of, [i, i + 1]))
                s = s[stay[s]]
                kept.append("".join(t[x:y] for x, y in zip((a[s] - c.begin[i]).tolist(), (z[s] - c.begin[i]).tolist())))
        yield pa.RecordBatch.from_arrays([batch.column("__key"), pa.array(kept, pa.string())], ["__key", "kept_text"])


def without_repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = 240) -> DataFrame:
    """``<key>, kept_text``: every non-null text without the sentences that spans of an earlier key cover.

    A sentence goes if each of its characters lies in a span of ``min_chars`` that a smaller key holds too, so the first
    holder keeps it. Only texts with such a span pass through Python. A repeated key keeps one row per input row.
    """
    kind = docs.schema[key].dataType.simpleString()
    spans = _merged(_Shared(docs, key, text, min_chars).parts.where("not is_first"))
    per = cut_lineage(spans.groupBy("__key").agg(F.collect_list("span_begin").alias("b"), F.collect_list("span_end").alias("e")))
    base = docs.where(F.col(text).isNotNull() & F.col(key).isNotNull()).select(F.col(key).alias("__key"), F.col(text).alias("__text"))
    cuts = Cuts(min_chars)
    cut = join_checked(base, per, "__key", row_bytes=40 + 8 * F.size("b")).mapInArrow(lambda it: _trim_batches(it, cuts), f"__key {kind}, kept_text string")
    rest = join_checked(base, per.select("__key"), "__key", "left_anti", row_bytes=24).withColumnRenamed("__text", "kept_text")
    return rest.unionByName(cut).withColumnRenamed("__key", key)
