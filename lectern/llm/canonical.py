"""Mapping free-entered values to a canonical list (problem 4).

Method: values are made distinct and normalised; candidates come from an inverted index of character
n-grams over the list's entries (names, aliases, and both with their words turned round); each is scored by
weighted cosine; the best is accepted if its score reaches a threshold and leads that of the best other entry by
a margin.

N-grams are runs of one to three letters, and runs of three with their letters in sorted order, which letters that
changed places still share. They are hashed to ``1 << BITS`` places. A weight is the log of the inverse frequency among
all distinct values, so what people put around a value counts little; n-grams of no entry keep
``FAINT`` of their weight, as they tell how much of a value no entry explains.

Entries go out in blocks of at most ``block_entries``, each of which sees all values; weights don't depend on blocks, so
any number of entries gives the same result.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.plans import cut_lineage, join_checked

BITS, FAINT, TAIL = 20, 0.1, 0.1

_CAMEL = re.compile(r"(?<=[a-zà-ÿ])(?=[A-ZÀ-Þ])")
_OTHER = re.compile(r"[^\w]+|_+")


def fold(value: str) -> str:
    """Letters without marks in lower case, words apart by one blank."""
    v = unicodedata.normalize("NFKD", _CAMEL.sub(" ", value))
    v = "".join(c for c in v if not unicodedata.combining(c))
    return _OTHER.sub(" ", v).strip().lower()


def turned(folded: str) -> list[str]:
    """A spelling and those with its first or last word at the other end."""
    w = folded.split()
    return list(dict.fromkeys([folded, " ".join(w[1:] + w[:1]), " ".join(w[-1:] + w[:-1])])) if w else []


class Grams(dict):
    """n-gram -> its place, kept per task."""

    def __missing__(self, g: str) -> int:
        if len(self) >= 1 << 18:
            self.clear()
        at = self[g] = xxhash.xxh32_intdigest(g.encode("utf-8", "surrogatepass")) >> (32 - BITS)
        return at

    def of(self, folded: str) -> list[int]:
        p = f"^{folded.replace(' ', '')}$"
        three = [p[i : i + 3] for i in range(len(p) - 2)]
        return [self[g] for g in (*p, *(p[i : i + 2] for i in range(len(p) - 1)), *three, *("~" + "".join(sorted(g)) for g in three))]


def _flat(lists: list[list[int]], weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place, weight) of lists of places as unit vectors; places may repeat."""
    n = np.array([len(x) for x in lists], np.int64)
    row = np.repeat(np.arange(len(n)), n)
    code, count = np.unique(row << BITS | np.fromiter((g for x in lists for g in x), np.int64, int(n.sum())), return_counts=True)
    row, at = code >> BITS, code & ((1 << BITS) - 1)
    w = count * weight[at]
    norm = np.sqrt(np.bincount(row, w * w, minlength=len(n)))
    return row, at, w / np.maximum(norm[row], 1e-12)


class Entries:
    """Inverted n-gram index over a block of entries: (id, spelling) rows, sorted by id."""

    def __init__(self, rows: list[tuple[int, str]], weight: np.ndarray) -> None:
        self.weight, self.grams = weight, Grams()
        forms = sorted({(k, f) for k, name in rows for f in turned(fold(name))})
        self.ids = np.array([k for k, _ in forms], np.int64)
        self.n = len(forms)
        row, at, w = _flat([self.grams.of(f) for _, f in forms], weight)
        #: Weights by spelling and place, and the same as postings by place.
        self.key, self.key_w = row << BITS | at, w
        o = np.argsort(at, kind="stable")
        self.at, self.form, self.w = at[o], row[o], w[o]

    def best(self, values: list[str], least: float = 0.0, room: int = 1 << 22) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each value the entry with the greatest cosine, that cosine, and the greatest of the other entries.

        Cosines under ``least`` may come out as 0. That spares the long postings: a value's n-grams of least weight, which
        together can't add more than ``TAIL``, are looked up only for spellings that the others bring near enough.
        """
        k, top, other = np.full(len(values), -1, np.int64), np.zeros(len(values)), np.zeros(len(values))
        tail = TAIL if least > TAIL else 0.0
        step = max(1, room // max(1, self.n))
        for low in range(0, len(values) if self.n else 0, step):
            part = [self.grams.of(fold(v)) for v in values[low : low + step]]
            row, at, w = _flat(part, self.weight)
            o = np.lexsort((-w, row))
            row, at, w = row[o], at[o], w[o]
            upto = np.concatenate(([0.0], np.cumsum(w * w)))
            start = np.searchsorted(row, np.arange(len(part) + 1))
            left = upto[start[row + 1]] - upto[:-1]  # squared weight from this n-gram on
            head = left > tail * tail
            lo, hi = np.searchsorted(self.at, at[head], "left"), np.searchsorted(self.at, at[head], "right")
            n = hi - lo
            post = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            score = np.bincount(np.repeat(row[head], n) * self.n + self.form[post], np.repeat(w[head], n) * self.w[post], minlength=len(part) * self.n)
            near = np.flatnonzero(score > max(0.0, least - tail - 1e-9))
            of, form, score = near // self.n, near % self.n, score[near]
            rest = np.flatnonzero(~head)
            first = np.searchsorted(row[rest], np.arange(len(part) + 1))
            m = (first[1:] - first[:-1])[of]
            pair = np.repeat(np.arange(len(near)), m)
            g = rest[np.repeat(first[of] - (np.cumsum(m) - m), m) + np.arange(int(m.sum()))] if len(rest) else np.zeros(0, np.int64)
            want = form[pair[: len(g)]] << BITS | at[g]
            i = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
            score += np.bincount(pair[: len(g)], np.where(self.key[i] == want, w[g] * self.key_w[i], 0.0), minlength=len(near))
            o = np.lexsort((self.ids[form], -score, of))
            of, entry, score = of[o], self.ids[form][o], score[o]
            lead = np.flatnonzero(np.append(True, of[1:] != of[:-1])) if len(of) else np.zeros(0, np.int64)
            k[low + of[lead]], top[low + of[lead]] = entry[lead], score[lead]
            differ = entry != k[low + of]
            np.maximum.at(other, low + of[differ], score[differ])
        return k, top, other


def _best_batches(batches: Iterator[pa.RecordBatch], rows: list[tuple[int, str]], weight: np.ndarray, least: float) -> Iterator[pa.RecordBatch]:
    entries = Entries(rows, weight)
    for b in batches:
        k, top, other = entries.best(b.column("value").to_pylist(), least)
        yield pa.RecordBatch.from_arrays([b.column("value"), pa.array(k), pa.array(top), pa.array(other)], ["value", "k", "top", "other"])


def _place_counts(batches: Iterator[pa.RecordBatch], turn: bool = False) -> Iterator[pa.RecordBatch]:
    """(place, n): in how many values each n-gram is; place -1 counts the values. With ``turn``, turned spellings count too."""
    grams, total = Grams(), np.zeros((1 << BITS) + 1, np.int64)
    for b in batches:
        for v in b.column(0).to_pylist():
            for f in turned(fold(v)) if turn else [fold(v)]:
                total[list({*grams.of(f), -1})] += 1
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(np.where(at == 1 << BITS, -1, at).astype(np.int32)), pa.array(total[at])], ["place", "n"])


def weights(values: DataFrame, spellings: DataFrame) -> np.ndarray:
    """The weight of every place, from all distinct values and all spellings of the entries (one column each)."""
    count = lambda df, turn=False: {r.place: r.n for r in df.mapInArrow(lambda it: _place_counts(it, turn), "place int, n long").groupBy("place").agg(F.sum("n").alias("n")).collect()}
    df = np.zeros(1 << BITS)
    held = count(values)
    total = held.pop(-1, 0)
    df[list(held)] = list(held.values())
    w = np.log1p(total / np.maximum(df, 1))
    faint = np.ones(1 << BITS, bool)
    faint[[p for p in count(spellings, True) if p >= 0]] = False
    w[faint] *= FAINT
    return w


def map_values(
    values: DataFrame,
    entries: DataFrame,
    value: str,
    entry_id: str = "theme_id",
    name: str = "theme",
    aliases: str = "aliases",
    accept: float = 0.5,
    margin: float = 0.02,
    block_entries: int = 20_000,
) -> DataFrame:
    """``value, entry, score`` for every distinct non-blank value; ``entry`` is -1 where none is accepted.

    ``score`` is the cosine of the entry, or of the best one where none is accepted (0 where it is too small to count). A value whose best entries tie, such as an
    alias of two, is unmatched (the margin). Null and blank values give no rows, an empty list leaves all values
    unmatched, an empty table gives no rows, null entry ids are no entries.
    """
    each = values.select(F.col(value).alias("value")).where(F.trim(F.regexp_replace("value", r"(?U)\s+", " ")) != "").distinct()
    # few values are worth many tasks: what is done with each outweighs moving it
    parts = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    each = cut_lineage(each.repartition(parts, "value"))
    listed = entries.where(F.col(entry_id).isNotNull()).select(F.col(entry_id).cast("long").alias("k"), F.explode(F.array_compact(F.array_append(F.coalesce(F.col(aliases), F.array().cast("array<string>")), F.col(name)))).alias("spelling"))
    listed = cut_lineage(listed)
    weight = each.sparkSession.sparkContext.broadcast(weights(each, listed.select("spelling")))
    blocks = max(1, -(-listed.select("k").distinct().count() // block_entries))
    found = None
    for i in range(blocks):
        rows = [(r.k, r.spelling) for r in (listed if blocks == 1 else listed.where(F.pmod(F.xxhash64("k"), F.lit(blocks)) == i)).collect()]
        mine = each.mapInArrow(lambda it, rows=rows: _best_batches(it, rows, weight.value, accept - margin), "value string, k long, top double, other double")
        found = mine if found is None else found.unionByName(mine)
    if blocks > 1:  # the best of all blocks; the best other is one of theirs, or the second of its own
        first = F.max_by(F.struct("k", "top", "other"), F.struct("top", -F.col("k")))
        tops = F.array_sort(F.collect_list("top"))
        found = found.groupBy("value").agg(first.alias("f"), F.coalesce(F.get(tops, F.size(tops) - 2), F.lit(0.0)).alias("second")).select("value", "f.k", "f.top", F.greatest("f.other", "second").alias("other"))
    sure = (F.col("top") >= accept) & (F.col("top") - F.col("other") >= margin)
    return found.select("value", F.when(sure, F.col("k")).otherwise(-1).cast("int").alias("entry"), F.col("top").alias("score"))


def map_tags(rows: DataFrame, entries: DataFrame, key: str = "response_id", tags: str = "themes", **parameters) -> DataFrame:
    """``<key>, tag_no, tag, theme_id, score`` of every tag that isn't null, blank or spelled like a ``theme``."""
    placed = rows.select(F.col(key).alias("__key"), F.posexplode(tags).alias("tag_no", "value"))
    names = cut_lineage(entries.where("theme is not null").select(F.col("theme").alias("value")).distinct())
    placed = join_checked(placed.where(F.trim(F.regexp_replace("value", r"(?U)\s+", " ")) != ""), names, "value", "left_anti")
    mapped = cut_lineage(map_values(placed, entries, "value", **parameters))
    out = join_checked(placed, mapped, "value", row_bytes=64)
    return out.select(F.col("__key").alias(key), "tag_no", F.col("value").alias("tag"), F.col("entry").alias("theme_id"), "score")
