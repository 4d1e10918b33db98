"""Books as blocks: a text is cut between paragraphs, where no header, marker or note reaches across."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from lectern.functions import patterns

BLOCK = 1 << 17
_HEADER = re.compile(patterns.BOOK_HEADER, re.M)
_START, _END = (re.compile(rf"\*\*\* {w} OF [^\n]*\*\*\*") for w in ("START", "END"))
# white space, digits and blanks as the column functions of lectern.functions.text have them; Python's own \s holds more
_SPACE = "\t\n\x0b\x0c\r \x85\xa0     　" + "".join(map(chr, range(0x2000, 0x200B)))
_PARTED = re.compile(f"\n(?:[{_SPACE.replace(chr(10), '')}]*\n)+")
_NOTE, _PICTURE = re.compile(patterns.FOOTNOTE, re.A), re.compile(patterns.ILLUSTRATION)

_PLACE = [("f", pa.string()), ("s", pa.int64()), ("b", pa.int32())]
_SEGMENT = [("seg", pa.int32()), ("title", pa.string()), ("opens", pa.bool_()), ("foreword", pa.bool_())]


class _Cutter:
    """Blocks of the lines of one split of a text; the first may go on from the split before, the last into the next."""

    def __init__(self, size: int) -> None:
        self.size, self.lines, self.chars, self.no = size, [], 0, 0
        self.before = ["CHAPTER", "CHAPTER"]  # the last two lines before the block; what stands before the split isn't known

    def add(self, lines: list[str]) -> Iterator[str]:
        """The blocks that end within the lines."""
        at = np.concatenate(([0], np.cumsum(np.fromiter(map(len, lines), np.int64, len(lines)) + 1)))
        begin, j = 0, 0
        while True:
            if self.no:  # only where a block is long enough are lines looked at
                j = max(j, int(np.searchsorted(at, at[begin] + self.size - self.chars)))
            while j < len(lines) and not self._begins(lines, begin, j):
                j += 1
            if j >= len(lines):
                break
            yield "\n".join([*self.lines, *lines[begin:j], ""])
            self.before = self._last(lines, begin, j)
            self.lines, self.chars, self.no, begin, j = [], 0, self.no + 1, j, j + 1
        self.lines += lines[begin:]
        self.chars += int(at[-1] - at[begin])

    def _begins(self, lines: list[str], begin: int, j: int) -> bool:
        """A block begins after a blank line, not with a note or a picture (they belong to what precedes), nor where either
        of the two lines before may begin a header, whose name stands up to two lines further."""
        line = lines[j].strip()
        if not line or line[0] == "[" or not (j > begin or self.lines):
            return False
        return not (lines[j - 1] if j > begin else self.lines[-1]).strip(" \t\r") and not any("CHAPTER" in x for x in self._last(lines, begin, j))

    def _last(self, lines: list[str], begin: int, j: int) -> list[str]:
        """The last two lines before line j that aren't blank, the later one first."""
        out: list[str] = []
        for part, upto in ((lines, j), (self.lines, len(self.lines))):
            for k in range(upto - 1, (begin if part is lines else 0) - 1, -1):
                if x := part[k].strip():
                    out.append(x)
                    if len(out) == 2:
                        return out
        return (out + self.before)[:2]

    def text(self) -> str:
        return "\n".join([*self.lines, ""])


def _cuts(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.DataType, list[tuple]]]:
    """The key's type and (key, f, s, no, border, text) of the blocks that end in each batch of rows (__key, f, s, text); border: the first or last of a split."""
    at, cutter, kind = None, None, None
    for batch in batches:
        out: list[tuple] = []
        kind = batch.schema.field("__key").type
        new = np.zeros(len(batch), bool)
        new[:1] = True
        for k in ("__key", "f", "s"):
            code = batch.column(k).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
            new[1:] |= code[1:] != code[:-1]
        runs = np.flatnonzero(new).tolist()
        for a, z in zip(runs, [*runs[1:], len(batch)]):
            here = tuple(batch.column(k)[a].as_py() for k in ("__key", "f", "s"))
            if at != here:
                if cutter:
                    out.append((*at, cutter.no, True, cutter.text()))
                at, cutter = here, _Cutter(size)
            no = cutter.no
            for no, text in enumerate(cutter.add("\n".join(batch.column("text").slice(a, z - a).to_pylist()).split("\n")), no):
                out.append((*at, no, no == 0, text))
        yield kind, out
    if cutter:
        yield kind, [(*at, cutter.no, True, cutter.text())]


def _segments(text: str) -> Iterator[tuple[int, str | None, bool, bool, str]]:
    """(seg, title, opens, foreword, body): what follows each header; segment 0 stands before the first one. ``opens`` tells the headers of a first chapter."""
    heads = list(_HEADER.finditer(text)) if "CHAPTER" in text or "FOREWORD" in text else []
    for k, (a, z) in enumerate(zip([0, *(m.end() for m in heads)], [*(m.start() for m in heads), len(text)])):
        yield (k, *(_named(heads[k - 1][0]) if k else (None, False, False)), text[a:z])


def _named(head: str) -> tuple[str, bool, bool]:
    lines = [x.strip() for x in head.splitlines() if x.strip()]
    title = lines[0] if len(lines) == 1 else f"{lines[0]}: {' '.join(lines[1:])}"
    return title, bool(re.match(r"CHAPTER\s+I\s", head)), head == "FOREWORD"


def noted_paragraphs(body: str) -> list[tuple[str, str | None, str | None]]:
    """(paragraph, mark, note): paragraphs without pictures; a note goes with the paragraph before it, the last one if there are several."""
    out: list[tuple[str, str | None, str | None]] = []
    for p in _PARTED.split(body):
        p = p.strip(_SPACE)
        if p[:1] == "[":
            if _PICTURE.match(p):
                continue
            if m := _NOTE.match(p):
                out[-1:] = [(x, m[1], m[2]) for x, _, _ in out[-1:]]
                continue
        if p:
            out.append((p, None, None))
    return out


def _marked(text: str) -> bool:
    return "*** START OF " in text or "*** END OF " in text


def _batch(rows: list[tuple], key: pa.DataType, fields: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    names, kinds = zip(("__key", key), *fields)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * len(kinds), kinds)], names)


def _with_paragraphs(rows: list[tuple], key: pa.DataType, fields: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    """The rows with their last value, a list of paragraphs, as ``ps``."""
    b = _batch([r[:-1] for r in rows], key, fields)
    flat = [p for r in rows for p in r[-1]]
    ends = np.concatenate(([0], np.cumsum(np.array([len(r[-1]) for r in rows], np.int64)))).astype(np.int32)
    values = pa.StructArray.from_arrays([pa.array(c, pa.string()) for c in (list(zip(*flat)) or [()] * 3)], ["raw", "mark", "note"])
    return pa.RecordBatch.from_arrays([*b.columns, pa.ListArray.from_arrays(pa.array(ends), values)], [*b.schema.names, "ps"])


def outline_batches(batches: Iterator[pa.RecordBatch], size: int = BLOCK) -> Iterator[pa.RecordBatch]:
    """(__key, f, s, b, seg, title, opens, foreword, n, border, text) of rows (__key, f, s, text) in the order of the text within (f, s).

    Blocks at the borders of a split and those with a marker come whole; of all others the segments, with the number of their paragraphs.
    """
    fields = [*_PLACE, *_SEGMENT, ("n", pa.int32()), ("border", pa.bool_()), ("text", pa.string())]
    for key, blocks in _cuts(batches, size):
        rows: list[tuple] = []
        for *at, border, text in blocks:
            if border or _marked(text):
                rows.append((*at, None, None, None, None, None, border, text))
            else:
                rows.extend((*at, *head, len(noted_paragraphs(body)), False, None) for *head, body in _segments(text))
        yield _batch(rows, key, fields)


def content_batches(batches: Iterator[pa.RecordBatch], size: int = BLOCK) -> Iterator[pa.RecordBatch]:
    """(__key, f, s, b, seg, ps): the paragraphs of the segments that :func:`outline_batches` counts."""
    for key, blocks in _cuts(batches, size):
        rows = [(*at, seg, noted_paragraphs(body)) for *at, border, text in blocks if not (border or _marked(text)) for seg, _, _, _, body in _segments(text)]
        yield _with_paragraphs(rows, key, [*_PLACE, ("seg", pa.int32())])


def block_batches(batches: Iterator[pa.RecordBatch], size: int = BLOCK) -> Iterator[pa.RecordBatch]:
    """(__key, f, s, b, text): the blocks that :func:`outline_batches` counts."""
    for key, blocks in _cuts(batches, size):
        yield _batch([(*at, text) for *at, border, text in blocks if not (border or _marked(text))], key, [*_PLACE, ("text", pa.string())])


def mark_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(__key, f, s, b, begin, end): where the first START marker of a block ends and its first END marker begins."""
    for batch in batches:
        begin, end = [], []
        for t in batch.column("text").to_pylist():
            m, n = _START.search(t), _END.search(t)
            begin.append(m and m.end())
            end.append(n and n.start())
        yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in ("__key", "f", "s", "b")), pa.array(begin, pa.int32()), pa.array(end, pa.int32())], ["__key", "f", "s", "b", "begin", "end"])


def segment_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(__key, f, s, b, seg, title, opens, foreword, ps) of whole blocks, which are read from ``begin`` and up to ``end`` where these are set."""
    columns = ("__key", "f", "s", "b", "text", "begin", "end")
    for batch in batches:
        rows = [(*at, *head, noted_paragraphs(body)) for *at, t, begin, end in zip(*(batch.column(k).to_pylist() for k in columns)) for *head, body in _segments(t[begin or 0 : end])]
        yield _with_paragraphs(rows, batch.schema.field("__key").type, [*_PLACE, *_SEGMENT])
