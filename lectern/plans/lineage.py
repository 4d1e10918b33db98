"""Cutting lineage through the folder that all executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder.

    ``spark.checkpoint.dir`` is used where the session names one; a folder of our
    own is made only where it is unset (local tests).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    wanted = spark.conf.get("spark.checkpoint.dir", None)
    if not wanted:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        wanted = tempfile.mkdtemp(prefix="lectern-checkpoint-")
    sc.setCheckpointDir(wanted)
    return wanted


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` once in reliable storage; a lost executor costs no recomputation."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def counted(df: DataFrame, name: str, **flags: str) -> tuple[DataFrame, Observation]:
    """``df`` with counters that fill while it runs: ``rows``, and the rows for which each SQL condition holds."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *(F.count_if(F.expr(c)).alias(k) for k, c in flags.items())), seen
