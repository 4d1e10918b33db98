"""Numbering rows in order without gathering a group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.plans.lineage import cut_lineage


def positions(df: DataFrame, *order: str, name: str = "pos") -> DataFrame:
    """``name``: each row's place from 1 in the order of the columns, nulls first.

    Rows are range-partitioned and sorted where they are; a place is the row's place in its partition plus the
    counts of the partitions before, so neither a hot key nor the whole table meets in one task.
    """
    spark = df.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    placed = cut_lineage(df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumns({"__p": F.spark_partition_id(), "__m": F.monotonically_increasing_id()}))
    sizes = placed.groupBy("__p").agg(F.count("*").alias("n"), F.min("__m").alias("low")).orderBy("__p").collect()
    at, shift = 1, []
    for r in sizes:
        shift.append((r["__p"], at - r.low))
        at += r.n
    offsets = spark.createDataFrame(shift, "__p int, __shift long")
    return placed.join(F.broadcast(offsets), "__p").withColumn(name, F.col("__m") + F.col("__shift")).drop("__p", "__m", "__shift")


def numbered(df: DataFrame, key: str, *order: str, name: str = "n") -> DataFrame:
    """``name``: each row's number from 1 within its non-null ``key``, in the order of the columns.

    Only the first place of every key is aggregated and joined back, which AQE may split or broadcast.
    """
    placed = positions(df.where(F.col(key).isNotNull()), key, *order, name="__pos")  # from a checkpoint, so reading it twice is cheap
    first = placed.groupBy(key).agg(F.min("__pos").alias("__first"))
    return placed.join(first, key).withColumn(name, F.col("__pos") - F.col("__first") + 1).drop("__pos", "__first")
