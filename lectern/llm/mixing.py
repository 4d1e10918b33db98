"""Mixing sources to target weights (problem 8).

Method: a multivariate-hypergeometric splitting tree. Every source is cut into blocks by a hash of its keys.
The total is the largest for which no source must be repeated more than allowed; it gives each source
an exact quota of tokens: whole passes over all its blocks, then blocks in random order, then part of
one block: sub-blocks by the next bits of the hash, and at last record by record. The drawn blocks are partitioned among output shards by a tree: each node
splits its counts by source between its halves with one multivariate-hypergeometric draw, so quotas
hold exactly and every shard is a random sample of the whole mix. Each source's blocks are permuted and dealt
to the shards without overlap, and records are shuffled within their shard by a hash.

Only block totals (at most ``max_blocks`` a source) come to the driver; records are sent by a join with the
dealt blocks. Sizes are tokens of a public byte-level BPE vocabulary whose file is a parameter.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.plans import cut_lineage, join_checked


def vocabulary_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _count_batches(batches: Iterator[pa.RecordBatch], ranks: dict[bytes, int], pattern: str) -> Iterator[pa.RecordBatch]:
    import tiktoken

    code = tiktoken.Encoding("mix", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    for b in batches:
        n = [len(code.encode_ordinary(t)) for t in b.column("__text").to_pylist()]
        keep = [b.column(c) for c in b.schema.names if c != "__text"]
        yield pa.RecordBatch.from_arrays([*keep, pa.array(n, pa.int64())], [*(c for c in b.schema.names if c != "__text"), "n_tokens"])


def token_counts(docs: DataFrame, key: str, text: str, source: str, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``<key>, source, n_tokens``; sources lower-cased without white space. Null keys, texts and sources give no rows."""
    if pattern is None:
        import public_tokenizers

        pattern = public_tokenizers.PATTERN
    with open(path or vocabulary_path(), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    kind = docs.schema[key].dataType.simpleString()
    base = docs.where(F.col(key).isNotNull() & F.col(text).isNotNull() & F.col(source).isNotNull())
    base = base.select(F.col(key).alias("__key"), F.regexp_replace(F.lower(source), r"(?U)\s+", "").alias("source"), F.col(text).alias("__text"))
    return base.mapInArrow(lambda it: _count_batches(it, shared.value, pattern), f"__key {kind}, source string, n_tokens long").withColumnRenamed("__key", key)


def split_quotas(counts: list[int], shards: int, rng: np.random.Generator) -> np.ndarray:
    """(shards, sources) counts that sum to ``counts``, shard sizes equal within one, by the splitting tree."""
    out = np.zeros((shards, len(counts)), np.int64)

    def node(low: int, high: int, left: np.ndarray) -> None:
        if high - low == 1:
            out[low] = left
            return
        mid = (low + high) // 2
        total = int(left.sum())
        n = total * (mid - low) // (high - low)
        part = rng.multivariate_hypergeometric(left, n, method="marginals") if total else left * 0
        node(low, mid, part)
        node(mid, high, left - part)

    node(0, shards, np.array(counts, np.int64))
    return out


def _upto(part: DataFrame, rooms: dict[str, tuple], key: str, fine: int = 2_000) -> DataFrame:
    """Of each source's last block the records, by ``shuffle_key``, that fit its room (one block a source).

    The range of keys is narrowed in 256 steps at a time by sums, until the step in which the room ends has at most
    ``fine`` records; only those are ranked.
    """
    low = {s: (-(1 << 63), 64, r[2]) for s, r in rooms.items()}  # first key, bits of the range, room left
    open_ = sorted(low)
    rank = F.lit(False)
    while open_:
        at, inside = F.lit(None).cast("long"), F.lit(False)
        for s in open_:
            first, bits, _ = low[s]
            mine = F.col("source") == s
            if bits < 64:
                mine = mine & F.col("shuffle_key").between(first, first + (1 << bits) - 1)
            at = F.when(mine, F.shiftright(F.col("shuffle_key"), bits - 8)).otherwise(at)
            inside = inside | mine
        steps: dict[str, list] = {s: [] for s in open_}
        for r in part.where(inside).groupBy("source", at.alias("k")).agg(F.sum("n_tokens").alias("t"), F.count("*").alias("n")).collect():
            steps[r.source].append((r.k, r.t, r.n))
        still = []
        for s in open_:
            first, bits, left = low[s]
            for k, t, n in sorted(steps[s]):
                if t > left:
                    low[s] = (k << (bits - 8), bits - 8, left)
                    if n > fine and bits > 8:
                        still.append(s)
                    break
                left -= t
        open_ = still
    before = F.lit(False)
    for s, (first, bits, left) in low.items():
        mine = F.col("source") == s
        before = before | (mine & (F.col("shuffle_key") < F.lit(first)))
        rank = rank | (mine & F.col("shuffle_key").between(first, first + (1 << bits) - 1))
    room = F.lit(0).cast("long")
    for s, (_, _, left) in low.items():
        room = F.when(F.col("source") == s, F.lit(left)).otherwise(room)
    upto = F.sum("n_tokens").over(Window.partitionBy("source").orderBy("shuffle_key", key).rowsBetween(Window.unboundedPreceding, 0))
    return part.where(before).unionByName(part.where(rank).withColumn("upto", upto).where(F.col("upto") <= room).drop("upto"))


class Mix:
    """``chosen``: one row per chosen copy of a record; ``shares``: one row per target."""

    def __init__(self, chosen: DataFrame, shares: DataFrame) -> None:
        self.chosen, self.shares = chosen, shares


def mix_sources(
    docs: DataFrame,
    targets: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    path: str | None = None,
    total_tokens: int | None = None,
    shards: int = 16,
    block_records: int = 64,
    max_blocks: int = 4_096,
    seed: int = 11,
) -> Mix:
    """Choose records so that each source has its ``target_share`` of all tokens.

    ``targets`` has ``source, target_share, max_repeats``; sources are compared lower-cased without white
    space. A target without tokens can't be met: the others keep their proportions, and the report says so.
    ``total_tokens`` defaults to (and can't exceed) the largest total that ``max_repeats`` allows.

    ``chosen``: ``<key>, source, pass_no, shard, shuffle_key, n_tokens``, where each record has at most
    ``max_repeats`` rows with different ``pass_no``; sort a shard by ``shuffle_key``. Records of null source, of no
    target, or without a token are never chosen; empty tables give an empty choice; keys are taken to be
    unique (repeated rows are so many records); other columns are not read.
    """
    spark: SparkSession = docs.sparkSession
    goal = {}
    for r in targets.where("source is not null and target_share > 0 and max_repeats > 0").collect():
        name = "".join(r.source.lower().split())
        share, most = goal.get(name, (0.0, 0))
        goal[name] = (share + r.target_share, max(most, r.max_repeats))
    # texts of other sources aren't tokenised
    named_rows = docs.where(F.regexp_replace(F.lower(source), r"(?U)\s+", "").isin(*goal) if goal else F.lit(False))
    sized = cut_lineage(token_counts(named_rows, key, text, source, path).where("n_tokens > 0"))
    size = {r.source: (r.n, r.t) for r in sized.groupBy("source").agg(F.count("*").alias("n"), F.sum("n_tokens").alias("t")).collect()}
    named = sorted(s for s in goal if s in size)
    whole = sum(goal[s][0] for s in named)
    most = min((goal[s][1] * size[s][1] * whole / goal[s][0] for s in named), default=0)
    total = min(most, total_tokens) if total_tokens else most
    quota = {s: min(goal[s][1] * size[s][1], round(total * goal[s][0] / whole)) for s in named}
    number = {s: int(min(max_blocks, max(1, size[s][0] // block_records))) for s in named}

    blocks = F.lit(None).cast("int")
    for s in named:
        blocks = F.when(F.col("source") == s, F.lit(number[s])).otherwise(blocks)
    placed = sized.withColumn("block", F.pmod(F.xxhash64(key, F.lit(seed)), blocks).cast("int")).where("block is not null")
    weight: dict[str, dict[int, int]] = {s: {} for s in named}
    for r in placed.groupBy("source", "block").agg(F.sum("n_tokens").alias("t")).collect():
        weight[r.source][r.block] = r.t

    rng = np.random.default_rng(seed)
    draws: dict[str, list[tuple[int, int, int | None]]] = {}
    for s in named:
        passes, rest = divmod(quota[s], size[s][1])
        have = sorted(weight[s])
        mine: list[tuple[int, int, int | None]] = [(p, b, None) for p in range(passes) for b in have]
        for b in rng.permutation(have).tolist():
            if rest <= 0:
                break
            mine.append((passes, b, None if weight[s][b] <= rest else rest))
            rest -= weight[s][b]
        draws[s] = [mine[i] for i in rng.permutation(len(mine))]
    dealt = split_quotas([len(draws[s]) for s in named], shards, rng) if named else np.zeros((shards, 0), np.int64)
    rows = []
    for j, s in enumerate(named):
        shard_of = np.repeat(np.arange(shards), dealt[:, j])
        rows += [(s, b, p, rest, int(k)) for (p, b, rest), k in zip(draws[s], shard_of)]
    plan = spark.createDataFrame(rows, "source string, block int, pass_no int, room long, shard int")
    order = F.xxhash64(key, "pass_no", F.lit(seed + 1))
    # at most sources * max_blocks * (max_repeats + 1) rows
    joined = join_checked(placed, cut_lineage(plan), ["source", "block"], row_bytes=64).withColumn("shuffle_key", order)
    full = joined.where("room is null")
    part = _upto(joined.where("room is not null"), {s: (b, p, rest, k) for s, b, p, rest, k in rows if rest is not None}, key)
    chosen = full.unionByName(part).select(key, "source", "pass_no", "shard", "shuffle_key", "n_tokens")

    listed = spark.createDataFrame([(s, float(w), int(m), int(size[s][0]) if s in size else 0, int(size[s][1]) if s in size else 0) for s, (w, m) in sorted(goal.items())], "source string, target_share double, max_repeats int, n_available long, tokens_available long")
    got = chosen.groupBy("source").agg(F.count("*").alias("n_chosen"), F.sum("n_tokens").alias("tokens_chosen"), (F.max("pass_no") + 1).alias("repeats"))
    shares = listed.join(got, "source", "left").fillna(0, ["n_chosen", "tokens_chosen", "repeats"])
    every = F.sum("tokens_chosen").over(Window.partitionBy())
    shares = shares.withColumn("share_reached", F.when(every > 0, F.col("tokens_chosen") / every).otherwise(F.lit(0.0))).withColumn("reachable", F.col("tokens_available") > 0)
    return Mix(chosen, shares)


def write_mix(mix: Mix, docs: DataFrame, path: str, key: str = "doc_id", shards: int = 16) -> None:
    """Write the chosen records, one folder of shards, shuffled within each."""
    full = mix.chosen.join(docs.drop("source"), key)
    full.repartition(shards, "shard").sortWithinPartitions("shard", "shuffle_key").write.partitionBy("shard").parquet(path)
