"""Frequency of every distinct term (problem 6).

Method: a global dictionary gives every term an integer, terms are encoded, each block of rows
accumulates arrays of counts for occurrences and for records that hold the term, and the arrays are
summed by ranges of identifiers.

Rows are first reduced to one per (record, term), so that a record with very many rows is
pre-aggregated where it is read and its presence counts once wherever its rows lie. Identifiers are
dense: they are numbered within hash partitions of the dictionary, and partition offsets (one number
a partition) are added. A block is up to ``BLOCK`` rows; of its count arrays only the places in use are sent, packed
into one row for each identifier range, so a shuffle carries as much as blocks have distinct terms. Ranges are spread
evenly, as identifiers follow the hash of terms, and a task adds the arrays of a range as they come in.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.plans import cut_lineage, join_checked

RANGE, BLOCK = 4096, 1 << 20


def normal_term(column):
    """Lower case, each run of white space, ``_`` and ``-`` made one blank, trimmed."""
    return F.trim(F.regexp_replace(F.lower(column), r"(?U)[\s_\-]+", " "))


def term_dictionary(terms: DataFrame) -> DataFrame:
    """``term, id`` for the distinct terms, ids dense from 0."""
    named = cut_lineage(terms.select("term").distinct().select("term", F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("m")))
    parts = named.groupBy("p").agg(F.count("*").alias("n"), F.min("m").alias("low")).orderBy("p").collect()
    if not parts:
        return named.select("term", F.lit(0).cast("long").alias("id"))
    total, offsets = 0, []
    for r in parts:
        offsets.append((r.p, total - r.low))
        total += r.n
    offset = terms.sparkSession.createDataFrame(offsets, "p int, shift long")
    return named.join(F.broadcast(offset), "p").select("term", (F.col("m") + F.col("shift")).alias("id"))


_CELLS = "range long, cells binary"


def _count_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, n) rows to one row per block and identifier range: (place, occurrences, records) of the ids in use."""

    def out(ids: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        o = np.argsort(ids, kind="stable")
        at = np.flatnonzero(np.append(True, np.diff(ids[o]) != 0))
        cells = np.empty((len(at), 3), np.int64)
        cells[:, 1] = np.add.reduceat(n[o], at)
        cells[:, 2] = np.diff(np.append(at, len(o)))
        of, cells[:, 0] = np.divmod(ids[o][at], RANGE)
        new = np.flatnonzero(np.append(True, np.diff(of) != 0))
        packed = [x.tobytes() for x in np.split(cells, new[1:])]
        return pa.RecordBatch.from_arrays([pa.array(of[new]), pa.array(packed, pa.binary())], ["range", "cells"])

    held: list[tuple[np.ndarray, np.ndarray]] = []
    for b in batches:
        held.append((b.column("id").to_numpy(), b.column("n").to_numpy()))
        if sum(len(x) for x, _ in held) >= BLOCK:
            yield out(*map(np.concatenate, zip(*held)))
            held = []
    if any(len(x) for x, _ in held):
        yield out(*map(np.concatenate, zip(*held)))


def _sum_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by range to (id, n_uses, n_records); one array of RANGE counts is held."""
    now, total = None, np.zeros((RANGE, 2), np.int64)

    def out() -> pa.RecordBatch:
        used = np.flatnonzero(total[:, 1])
        return pa.RecordBatch.from_arrays([pa.array(now * RANGE + used), pa.array(total[used, 0]), pa.array(total[used, 1])], ["id", "n_uses", "n_records"])

    for b in batches:
        for r, cells in zip(b.column("range").to_pylist(), b.column("cells").to_pylist()):
            if r != now:
                if now is not None:
                    yield out()
                now = r
                total[:] = 0
            x = np.frombuffer(cells, np.int64).reshape(-1, 3)
            total[x[:, 0]] += x[:, 1:]
    if now is not None:
        yield out()


def term_frequency(rows: DataFrame, record: str, terms: str, min_records: int = 3, max_share: float = 0.1) -> DataFrame:
    """``term, n_uses, n_records, mark`` for every distinct term of array column ``terms``.

    A use is one place in a list; a record is a distinct value of ``record`` with at least one term (nulls
    of ``record`` form one record). ``mark`` is ``rare`` under ``min_records`` records, ``common`` above
    ``max_share`` of all records (a term that is both is ``rare``), else null. Null lists, null tags and tags
    that are empty after normalising aren't terms; an empty table gives no rows.
    """
    uses = rows.select(F.col(record).alias("__record"), F.explode(terms).alias("t")).select("__record", normal_term(F.col("t")).alias("term")).where("term <> ''")
    held = cut_lineage(uses.groupBy("__record", "term").agg(F.count("*").alias("n")))
    total = held.select(F.coalesce(F.col("__record").cast("string"), F.lit("\0")).alias("r")).distinct().count()
    names = cut_lineage(term_dictionary(held))
    coded = join_checked(held, names, "term", row_bytes=80).select("id", "n")
    blocks = coded.mapInArrow(_count_blocks, _CELLS)
    sums = blocks.repartition("range").sortWithinPartitions("range").mapInArrow(_sum_ranges, "id long, n_uses long, n_records long")
    mark = F.when(F.col("n_records") < min_records, "rare").when(F.col("n_records") > F.lit(max_share) * total, "common")
    return sums.join(names, "id").select("term", "n_uses", "n_records", mark.alias("mark"))
