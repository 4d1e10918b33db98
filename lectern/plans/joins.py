"""Joins that broadcast only behind a check of the broadcast side's size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Most bytes (estimated from a real row count) that a side may have to be broadcast.
BROADCAST_BYTES = 8 << 20


def join_checked(big: DataFrame, small: DataFrame, on, how: str = "inner", row_bytes: int | Column = 64, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Join ``big`` with ``small``, broadcasting ``small`` only if its counted rows fit ``limit``.

    ``small`` should be a checkpointed or cheap frame, as it is counted first. Beyond the
    limit the join is left to Catalyst (sort-merge, with AQE's skew splitting). Where rows hold lists, ``row_bytes``
    is an expression of their size, which is summed.
    """
    size = small.agg(F.sum(row_bytes)).first()[0] or 0 if isinstance(row_bytes, Column) else small.count() * row_bytes
    if size <= limit:
        small = F.broadcast(small)
    return big.join(small, on, how)


def semi_checked(big: DataFrame, keys: DataFrame, on, row_bytes: int | Column = 24, limit: int = BROADCAST_BYTES) -> DataFrame:
    """The rows of ``big`` whose key is in ``keys``; same size check as :func:`join_checked`."""
    return join_checked(big, keys, on, "left_semi", row_bytes, limit)
