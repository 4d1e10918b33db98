"""Streaming upserts: files that arrive are merged into a table, the latest row of a key wins.

The table is partitioned by buckets of the key; a batch reads and replaces the buckets that it touches, no others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lectern.operators.ingest import merge_latest
from lectern.plans import cut_lineage

BUCKET = "key_bucket"


def merge_stream(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, keys: list[str], order: list[str], files_per_trigger: int = 25, buckets: int = 64) -> StreamingQuery:
    """Merge Parquet files appearing in ``source`` into ``target`` until there are none; safe to run again.

    A batch of ``files_per_trigger`` files replaces the buckets of its keys (:func:`merged` reads the table). A batch that is
    repeated after a failure changes nothing: the same rows win again.
    """
    if files_per_trigger <= 0 or buckets <= 0:
        raise ValueError("files_per_trigger and buckets must be above 0")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(source)

    def merge(batch: DataFrame, _: int) -> None:
        s = batch.sparkSession
        path = s.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
        there = path.getFileSystem(s.sparkContext._jsc.hadoopConfiguration()).exists(path)
        batch = cut_lineage(batch.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")))
        touched = [r[0] for r in batch.select(BUCKET).distinct().collect()]
        old = s.read.parquet(target).where(F.col(BUCKET).isin(*touched)).select(*batch.columns) if there and touched else s.createDataFrame([], batch.schema)
        new = cut_lineage(merge_latest(old, batch, [*keys, BUCKET], order))
        new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(target)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def merged(spark: SparkSession, target: str) -> DataFrame:
    """The rows of a table that :func:`merge_stream` keeps."""
    return spark.read.parquet(target).drop(BUCKET)


def windowed_counts(events: DataFrame, at: str = "ts", by: str = "event_type", width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Rows per tumbling window and key, with a watermark for late rows; works on streams and tables."""
    if events.isStreaming:
        events = events.withWatermark(at, late)
    per = events.groupBy(F.window(at, width).alias("w"), by).agg(F.count("*").alias("n"))
    return per.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), by, "n")
