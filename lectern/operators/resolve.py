"""Themes: frequencies, cross tables, clusters, curation."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions.text import slug, theme_term
from lectern.model import SEXUAL, TOXICITY, VIOLENCE, Corpus
from lectern.operators.components import connected_components
from lectern.operators.meta import resolve
from lectern.operators.refine import noted, upsert_category
from lectern.plans import cut_lineage, join_checked

CUT = 0.35


def term_frequency(tags: DataFrame, column: str = "tag", least: int = 2) -> DataFrame:
    """``term, n`` of terms that occur at least ``least`` times."""
    return tags.select(theme_term(F.col(column)).alias("term")).where("term <> ''").groupBy("term").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def crosstab(tags: DataFrame, axes: list[str], term: str = "term") -> DataFrame:
    """``term, axis, value, n``: all axes counted in one pass over the tags."""
    cells = F.explode(F.array(*(F.struct(F.lit(a).alias("axis"), F.col(a).cast("string").alias("value")) for a in axes)))
    return tags.select(term, cells.alias("c")).groupBy(term, "c.axis", "c.value").agg(F.count("*").alias("n"))


def summary(counts: DataFrame, keys: list[str], value: str, n: str = "n", limit: int = 3) -> DataFrame:
    """``keys, summary``: the most frequent values with their percent, as ``a 60% | b 30%``."""
    by = Window.partitionBy(*keys)
    ranked = counts.withColumns({"r": F.row_number().over(by.orderBy(F.desc(n), value)), "all": F.sum(n).over(by)}).where(F.col("r") <= limit)
    part = F.concat(F.col(value), F.lit(" "), F.round(F.col(n) * 100 / F.col("all")).cast("int").cast("string"), F.lit("%"))
    return ranked.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", part.alias("p")))), lambda x: x["p"]), " | ").alias("summary"))


def roll_up(members: DataFrame, top: int = 5) -> DataFrame:
    """``cluster_id, label, n_terms, freq, top_terms, members`` from (cluster_id, term, n); the label is the most frequent term's slug."""
    rows = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), "term")))
    per = members.groupBy("cluster_id").agg(rows.alias("r"), F.count("*").alias("n_terms"), F.sum("n").alias("freq"))
    names = F.transform("r", lambda x: x["term"])
    return per.select("cluster_id", slug(F.get(names, F.lit(0))).alias("label"), "n_terms", "freq", F.slice(names, 1, top).alias("top_terms"), names.alias("members"))


def worklist(clusters: DataFrame, axes: DataFrame) -> DataFrame:
    """One row per cluster for a person to decide on: label, frequency, members, and counts by axis value in columns."""
    wide = axes.groupBy("cluster_id").pivot("cell").agg(F.sum("n")).fillna(0)
    return clusters.select("cluster_id", "label", "freq", "n_terms", F.array_join("top_terms", "; ").alias("top_terms"), F.lit("").alias("human_label"), F.lit("").alias("action"), F.lit("").alias("notes")).join(wide, "cluster_id", "left")


def cluster_counters(members: DataFrame, cells: DataFrame) -> DataFrame:
    """``cluster_id, axis, counts``: the cross table of terms summed per cluster, as a map from value to count."""
    per = cells.join(members.select("cluster_id", "term"), "term").groupBy("cluster_id", "axis", "value").agg(F.sum("n").alias("n"))
    return per.groupBy("cluster_id", "axis").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("value", "n")))).alias("counts"))


def proposal(tags: DataFrame, axes: list[str], least: int = 2, cut: float = CUT, vectors: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(clusters, worklist) of the terms of ``tags`` (tag and the axes): frequent terms are clustered and rolled up.

    ``vectors`` (id, vector) may bring embeddings of the terms; else hashed letter trigrams stand in.
    """
    terms = cut_lineage(term_frequency(tags, least=least))
    named = cut_lineage(clusters(hashed_vectors(terms) if vectors is None else vectors.join(terms.select(F.col("term").alias("id")), "id", "left_semi"), cut).withColumnRenamed("id", "term").join(terms, "term"))
    rolled = roll_up(named)
    cells = crosstab(tags.withColumn("term", theme_term(F.col("tag"))), axes).join(named.select("term", "cluster_id"), "term")
    wide = cells.groupBy("cluster_id", F.concat_ws("=", "axis", F.coalesce("value", F.lit("Unset"))).alias("cell")).agg(F.sum("n").alias("n"))
    return rolled, worklist(rolled, wide)


def hashed_vectors(terms: DataFrame, term: str = "term", size: int = 256) -> DataFrame:
    """``id, vector``: normalised counts of hashed letter trigrams, a stand-in for a text embedding."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        for b in it:
            rows = np.zeros((len(b), size), np.float32)
            for i, t in enumerate(b.column(0).to_pylist()):
                p = f"  {t} "
                for k in range(len(p) - 2):
                    rows[i, zlib.crc32(p[k : k + 3].encode("utf-8", "surrogatepass")) % size] += 1
            rows /= np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(list(rows), pa.list_(pa.float32()))], ["id", "vector"])

    return terms.select(F.col(term).alias("id")).where("id is not null").distinct().mapInArrow(batches, "id string, vector array<float>")


def _unit(vectors: pd.Series | list) -> np.ndarray:
    m = np.array([np.asarray(v, np.float64) for v in vectors])
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12)


def near_pairs(vectors: DataFrame, cut: float = CUT, block: int = 2_000) -> DataFrame:
    """``a, b, distance`` of ids (a < b) with cosine distance below ``cut``.

    Vectors lie in blocks of about ``block``; each pair of blocks is one task-sized matrix product, so no task
    or driver holds more than two blocks. All pairs of blocks are compared: the set is the terms above the
    frequency threshold, which is small beside the corpus.
    """
    v = cut_lineage(vectors.where("vector is not null"))
    n = max(1, -(-v.count() // block))
    v = v.withColumn("blk", F.pmod(F.xxhash64("id"), F.lit(n)).cast("int"))
    kind = vectors.schema["id"].dataType.simpleString()
    left = v.withColumn("other", F.explode(F.sequence(F.col("blk"), F.lit(n - 1)))).select(F.col("blk").alias("i"), F.col("other").alias("j"), "id", "vector", F.lit(0).alias("side"))
    right = v.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blk")))).where("other < blk").select(F.col("other").alias("i"), F.col("blk").alias("j"), "id", "vector", F.lit(1).alias("side"))

    def pairs(p: pd.DataFrame) -> pd.DataFrame:
        a = p[p.side == 0]
        b = p[p.side == 1] if p.i.iloc[0] != p.j.iloc[0] else a
        if not len(a) or not len(b):
            return pd.DataFrame({"a": [], "b": [], "distance": []})
        d = 1 - _unit(a.vector) @ _unit(b.vector).T
        x, y = np.nonzero(d < cut)
        ia, ib = a.id.to_numpy()[x], b.id.to_numpy()[y]
        keep = ia != ib if a is not b else x < y
        ia, ib, d = ia[keep], ib[keep], d[x[keep], y[keep]]
        swap = ia > ib
        return pd.DataFrame({"a": np.where(swap, ib, ia), "b": np.where(swap, ia, ib), "distance": d})

    return left.unionByName(right).groupBy("i", "j").applyInPandas(pairs, f"a {kind}, b {kind}, distance double")


def average_linkage(x: np.ndarray, cut: float) -> np.ndarray:
    """Labels of average-linkage clusters of unit vectors by cosine distance, merged below ``cut``."""
    n = len(x)
    d = 1 - x @ x.T
    np.fill_diagonal(d, np.inf)
    size, label, live = np.ones(n), np.arange(n), np.ones(n, bool)
    while live.sum() > 1:
        i, j = divmod(int(np.argmin(d)), n)
        if d[i, j] >= cut:
            break
        i, j = min(i, j), max(i, j)
        row = (d[i] * size[i] + d[j] * size[j]) / (size[i] + size[j])
        d[i], d[:, i] = row, row
        d[i, i] = np.inf
        d[j], d[:, j] = np.inf, np.inf
        size[i] += size[j]
        live[j] = False
        label[label == j] = i
    return label


def chained_linkage(x: np.ndarray, cut: float) -> np.ndarray:
    """The same clusters (ties apart) without a matrix of all pairs, by chains of nearest neighbours.

    The mean cosine of two clusters of unit vectors is the product of their sums over the product of their sizes. A cluster
    whose nearest other is not below the cut is final: merging others never brings one nearer than they were.
    """
    n = len(x)
    sums, size, live, label = x.copy(), np.ones(n), np.ones(n, bool), np.arange(n)
    chain: list[int] = []
    while live.any():
        if not chain:
            chain.append(int(live.argmax()))
        a = chain[-1]
        near = np.where(live, (sums @ sums[a]) / (size * size[a]), -np.inf)
        near[a] = -np.inf
        b = int(near.argmax())
        if len(chain) > 1 and near[chain[-2]] >= near[b]:
            b = chain[-2]
        if 1 - near[b] >= cut:
            live[a] = False
            chain.pop()
        elif len(chain) > 1 and b == chain[-2]:
            keep, gone = min(a, b), max(a, b)
            sums[keep] += sums[gone]
            size[keep] += size[gone]
            live[gone] = False
            label[label == gone] = keep
            del chain[-2:]
        else:
            chain.append(b)
    return label


def clusters(vectors: DataFrame, cut: float = CUT, dense: int = 2_000) -> DataFrame:
    """``id, cluster_id``: average-linkage clusters; the cluster's id is its least member.

    A merge below the cut never crosses connected components of the graph of pairs below it, so each component is
    clustered by itself; one of more than ``dense`` members without the matrix of its pairs.
    """
    kind = vectors.schema["id"].dataType.simpleString()
    edges = cut_lineage(near_pairs(vectors, cut))
    comp = connected_components(edges, "a", "b")
    alone = vectors.select("id").distinct().join(comp.select(F.col("node").alias("id")), "id", "left_anti").select("id", F.col("id").alias("cluster_id"))

    def one(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values("id")
        label = (average_linkage if len(p) <= dense else chained_linkage)(_unit(p.vector), cut)
        ids = p.id.to_numpy()
        return pd.DataFrame({"id": ids, "cluster_id": ids[label]})

    joined = join_checked(vectors, comp.withColumnRenamed("node", "id"), "id", row_bytes=64)
    return joined.groupBy("component").applyInPandas(one, f"id {kind}, cluster_id {kind}").unionByName(alone)


def curation_map(decisions: DataFrame, manifest: DataFrame) -> DataFrame:
    """``term, canonical`` from a person's decisions and the cluster members; null canonical means drop.

    The label is ``human_label`` if given, else the cluster's; decisions on unknown clusters count for nothing; of several
    on one term the last (by ``row_no``) counts.
    """
    j = decisions.join(manifest.select("cluster_id", F.col("label").alias("own"), F.explode("members").alias("term")), "cluster_id")
    label = F.when(F.lower(F.coalesce("action", F.lit(""))) == "drop", F.lit(None)).otherwise(slug(F.coalesce(F.nullif(F.trim("human_label"), F.lit("")), "own")))
    return j.select(theme_term(F.col("term")).alias("term"), label.alias("canonical"), "row_no").groupBy("term").agg(F.max_by(F.struct("canonical"), "row_no").alias("c")).select("term", "c.canonical")


def curate(tags: DataFrame, mapping: DataFrame, key: str = "doc_uuid", tag: str = "tag") -> DataFrame:
    """``<key>, themes``: each document's canonical themes, sorted and distinct. Dropped terms go, unmapped pass as slugs."""
    named = tags.select(key, theme_term(F.col(tag)).alias("term")).where("term <> ''")
    j = join_checked(named, mapping.withColumn("mapped", F.lit(True)), "term", "left", row_bytes=96)
    canonical = F.when(F.col("mapped"), F.col("canonical")).otherwise(slug(F.col("term")))
    return j.select(key, canonical.alias("theme")).groupBy(key).agg(F.array_sort(F.collect_set("theme")).alias("themes"))


def theme_tags(items: DataFrame) -> DataFrame:
    """``doc_uuid, tag`` of the theme categorizations."""
    return items.where("kind = 'categorization' and category = 'theme'").select("doc_uuid", F.explode("value").alias("tag"))


def document_axes(corpus: Corpus) -> DataFrame:
    """``doc_uuid, genre, sexuality, violence, toxicity, language``: a row per document and language, with the values of what isn't set."""
    r = corpus.meta.select("doc_uuid").join(resolve(corpus.items), "doc_uuid", "left")
    spoken = F.when(F.size("languages") > 0, F.col("languages")).otherwise(F.array(F.lit("en")))
    unset = {"genre": "Unset", "sexuality": SEXUAL[0], "violence": VIOLENCE[0], "toxicity": TOXICITY[0]}
    return r.select("doc_uuid", *(F.coalesce(c, F.lit(v)).alias(c) for c, v in unset.items()), F.explode(spoken).alias("language"))


def corpus_crosstab(corpus: Corpus) -> DataFrame:
    """``term, axis, value, n``: documents' theme terms against their axes; a document counts once for each of its languages."""
    axes = document_axes(corpus)
    tags = theme_tags(corpus.items).withColumn("term", theme_term(F.col("tag"))).where("term <> ''")
    single = axes.drop("language").distinct()
    one = crosstab(tags.join(single, "doc_uuid"), ["genre", "sexuality", "violence", "toxicity"])
    return one.unionByName(crosstab(tags.join(axes.select("doc_uuid", "language"), "doc_uuid"), ["language"]))


def curate_corpus(corpus: Corpus, mapping: DataFrame, step: str = "resolve-theme-curation") -> Corpus:
    """Put each document's canonical themes in place of its themes; documents whose themes stay the same aren't touched."""
    corpus = corpus.complete()
    new = curate(theme_tags(corpus.items), mapping).withColumnRenamed("themes", "value")
    old = resolve(corpus.items).select("doc_uuid", F.col("themes").alias("old"))
    changed = cut_lineage(new.join(old, "doc_uuid").where(~F.col("value").eqNullSafe(F.col("old"))).select("doc_uuid", "value", F.lit(None).cast("string").alias("reasoning")))
    return replace(corpus, items=upsert_category(corpus.items, changed, "theme"), meta=noted(corpus.meta, changed, step, "themes curated"))
