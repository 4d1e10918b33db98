"""Writers: staged overwrites, JSON lines, ledgers, cluster files, worklists, text reports."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.model import Corpus
from lectern.plans import cut_lineage


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm.org.apache.hadoop.fs.Path


def replace_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Overwrite a table by writing beside it and renaming, so a failed job leaves the old one whole."""
    spark, stage = df.sparkSession, f"{path}.staged-{uuid.uuid4().hex[:8]}"
    df.write.partitionBy(*partition_by).parquet(stage)
    _put(spark, stage, path)


def _put(spark: SparkSession, stage: str, path: str) -> None:
    """Move what is staged to its place; the old content is moved aside first and deleted last."""
    fs, at, path_of = _fs(spark, path)
    old = path_of(f"{path}.old-{uuid.uuid4().hex[:8]}")
    had = fs.exists(at)
    if had and not fs.rename(at, old):
        raise OSError(f"can't move {path} aside")
    if not fs.rename(path_of(stage), at):
        raise OSError(f"can't put {stage} in place")
    if had:
        fs.delete(old, True)


def overwrite_records(lines: DataFrame, path: str, key: str = "doc_uuid", buckets: int = 64) -> None:
    """Write records (``key``, line) in the place of those with their keys; other records stay.

    Records lie in buckets of their key, and only the buckets that are touched are read and replaced.
    """
    spark = lines.sparkSession
    new = cut_lineage(lines.select(key, "line").withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")))
    fs, at, _ = _fs(spark, path)
    if fs.exists(at):
        touched = [r[0] for r in new.select("bucket").distinct().collect()]
        old = spark.read.schema(new.schema).parquet(path).where(F.col("bucket").isin(*touched) if touched else F.lit(False))
        new = cut_lineage(new.unionByName(old.join(new.select(key).distinct(), key, "left_anti")))
    new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)


def save(corpus: Corpus, folder: str) -> None:
    for name, df in (("doc_meta", corpus.meta), ("doc_items", corpus.items), ("content_variants", corpus.variants), ("ledger", corpus.ledger)):
        replace_table(df, f"{folder}/{name}.parquet")


def package_name(project: str, mark: str) -> str:
    return f"{project}-dataset-{mark}.jsonl"


def json_lines(lines: DataFrame, path: str, key: str = "doc_uuid") -> None:
    """One document per line in the order of ids, as part files that sort by name."""
    lines.orderBy(key).select("line").write.mode("overwrite").text(path)


def append_ledger(entries: DataFrame, path: str) -> None:
    """Add entries; without a ``recorded_at`` of their own they get the time of writing, so that the last one written counts."""
    at = F.col("recorded_at") if "recorded_at" in entries.columns else F.current_timestamp()
    at = F.date_format(at.cast("timestamp"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("recorded_at")
    entries.select(F.to_json(F.struct("source", "native_id", "uuid", "meta", at)).alias("line")).write.mode("append").text(path)


def rewrite_ledger(spark: SparkSession, path: str, gone: DataFrame) -> None:
    """Without the entries of ``gone`` (uuid); lines that don't read are kept."""
    lines = spark.read.text(path).withColumn("uuid", F.get_json_object("value", "$.uuid"))
    kept = lines.join(gone.select("uuid").where("uuid is not null").distinct(), "uuid", "left_anti").select("value")
    stage = f"{path}.staged-{uuid.uuid4().hex[:8]}"
    kept.write.text(stage)
    _put(spark, stage, path)


def cluster_file(clusters: DataFrame, total_terms: int) -> DataFrame:
    """``json``: one row, all clusters with most frequent first. The clusters are bounded by the term threshold."""
    one = F.array_sort(F.collect_list(F.struct((-F.col("freq")).alias("k"), "cluster_id", "label", "freq", "members")))
    body = clusters.agg(F.transform(one, lambda c: c.dropFields("k")).alias("clusters"))
    return body.select(F.to_json(F.struct(F.struct(F.lit(total_terms).alias("total_terms")).alias("meta"), "clusters")).alias("json"))


def worklist_csv(rows: DataFrame, path: str) -> None:
    rows.orderBy(F.desc("freq"), "cluster_id").coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def text_report(sections: dict[str, dict[str, DataFrame]], rows: int | None = None) -> str:
    """Reports as fixed-width text; with ``rows`` at most so many of each table, and a line that tells how many more there are."""
    out = []
    for section, tables in sections.items():
        out.append(f"== {section} ==")
        for name, df in tables.items():
            data = [[("" if v is None else f"{v:.2f}" if isinstance(v, float) else str(v)) for v in r] for r in (df if rows is None else df.limit(rows)).collect()]
            width = [max(map(len, c)) for c in zip(df.columns, *data)]
            out.append(f"-- {name}")
            out += ["  ".join(v.ljust(w) for v, w in zip(r, width)).rstrip() for r in [df.columns, *data]]
            if rows is not None and (more := df.count() - len(data)) > 0:
                out.append(f"({more} more)")
    return "\n".join(out)


def stage_workspace(root: str, volumes: list[str]) -> list[str]:
    """Make a folder per volume, and those for models and exports."""
    import os

    made = [os.path.join(root, v) for v in (*volumes, "models", "exports")]
    for d in made:
        os.makedirs(d, exist_ok=True)
    return made
