"""Splitting oversized items at natural boundaries (problem 5).

Method: every boundary of an item is an offset in a sorted array per kind (paragraph, sentence, word), with
prefix sums of sizes (characters of a text are their own prefix sums; sequence ids count one each). From
the start of a piece the last boundary within the limit is found by binary search, first among
paragraph ends, then sentence ends, then word ends; where there is none the cut is hard, at the limit. The
next piece begins ``overlap`` units before the cut, so consecutive pieces repeat exactly that much.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_PARAGRAPH = re.compile(r"\n\n")
_SENTENCE = re.compile(r"(?<=[.!?…])\s")
_WORD = re.compile(r"\s")
#: Characters of the separator after each kind of part.
SEPARATORS = {"paragraph": 2, "sentence": 1, "word": 1}


def boundaries(text: str) -> dict[str, list[int]]:
    """Offsets after which a piece may end, by kind; each kind also holds the end of the text.

    A paragraph ends at two line feeds in a row, a sentence at white space right after ``. ! ? …`` within its
    paragraph, a word at white space. The separators belong to the part before them. A separator that ends the text
    gives its end twice.
    """
    ends = {"paragraph": [m.end() for m in _PARAGRAPH.finditer(text)], "sentence": [m.end() for m in _SENTENCE.finditer(text)], "word": [m.end() for m in _WORD.finditer(text)]}
    for v in ends.values():
        v.append(len(text))
    return ends


def finest(kinds: list[tuple[str, list[int], int]], room: int) -> str:
    """The coarsest kind of part of which none has more than ``room`` characters, read off the gaps between boundaries.

    ``kinds`` has name, offsets after the boundaries (the end of the text last) and width of the separator, coarse to fine;
    a part also ends at the boundaries of coarser kinds.
    """
    ends: list[tuple[int, int]] = []  # begin and end of the separators so far; the last is the end of the text
    for name, at, width in kinds:
        ends = sorted([*ends, *((e - width, e) for e in at[:-1])])
        begin = widest = 0
        for a, b in [*ends, (at[-1], at[-1])]:
            widest, begin = max(widest, a - begin), max(begin, b)
        if widest <= room:
            return name
    return "none"


def pieces(length: int, limit: int, overlap: int, ends: list[tuple[str, list[int]]]) -> list[tuple[int, int, str]]:
    """(begin, end, kind of cut) of the pieces; the last is cut at ``end``. Needs overlap < limit."""
    out, begin = [], 0
    while length - begin > limit:
        for kind, at in ends:
            i = bisect_right(at, begin + limit)
            if i and at[i - 1] > begin + overlap:
                cut = at[i - 1]
                break
        else:
            kind, cut = "hard", begin + limit
        out.append((begin, cut, kind))
        begin = cut - overlap
    out.append((begin, length, "end"))
    return out


_SCHEMA = "obj string, obj_key long, finest string, piece_no int, piece_begin int, piece_end int, cut string, piece_text string"


def _emit(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string())
    names = [x.split()[0] for x in _SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * len(kinds), kinds)], names)


def _text_pieces(batches: Iterator[pa.RecordBatch], limit: int, overlap: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for key, text in zip(b.column("k").to_pylist(), b.column("t").to_pylist()):
            ends = boundaries(text)
            fine = finest([(k, ends[k], w) for k, w in SEPARATORS.items()], limit - overlap)
            for i, (a, z, cut) in enumerate(pieces(len(text), limit, overlap, [(k, ends[k]) for k in SEPARATORS])):
                rows.append(("text", key, fine, i, a, z, cut, text[a:z]))
        yield _emit(rows)


def _sequence_pieces(batches: Iterator[pa.RecordBatch], limit: int, overlap: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for key, n in zip(b.column("k").to_pylist(), b.column("n").to_pylist()):
            for i, (a, z, cut) in enumerate(pieces(n, limit, overlap, [("item", range(1, n + 1))])):
                rows.append(("sequence", key, "item", i, a, z, cut, None))
        yield _emit(rows)


def split_texts(texts: DataFrame, key: str, text: str, limit: int = 2_000, overlap: int = 200) -> DataFrame:
    """Pieces of the texts above ``limit`` code points.

    ``obj ('text'), obj_key, finest, piece_no, piece_begin, piece_end, cut, piece_text``. Texts within the limit,
    null texts and null keys give no rows (only what is above the limit passes through Python); a repeated
    row gives its pieces again; an empty table gives none; other columns are not read.
    """
    _check(limit, overlap)
    long = texts.where((F.length(text) > limit) & F.col(key).isNotNull()).select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"))
    return long.mapInArrow(lambda it: _text_pieces(it, limit, overlap), _SCHEMA)


def split_sequences(items: DataFrame, key: str, ids: str, limit: int = 100, overlap: int = 10) -> DataFrame:
    """Pieces of the sequences of more than ``limit`` ids, as places from ``piece_begin`` up to ``piece_end``.

    Same columns as :func:`split_texts` with ``obj`` 'sequence' and no text; repeated ids and ids of no item
    count like others. Null lists give no rows.
    """
    _check(limit, overlap)
    long = items.where((F.size(ids) > limit) & F.col(key).isNotNull()).select(F.col(key).cast("long").alias("k"), F.size(ids).alias("n"))
    return long.mapInArrow(lambda it: _sequence_pieces(it, limit, overlap), _SCHEMA)


def _check(limit: int, overlap: int) -> None:
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be at least 0 and below limit")
