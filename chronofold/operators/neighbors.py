"""Nearest neighbours, synthetic minority rows, and pairs of mutual neighbours of unlike labels."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronofold.operators.sampling import capped
from chronofold.session import materialize

#: Query vectors compared in one pass over the points.
BLOCK = 4096


def knn(queries: DataFrame, points: DataFrame, id_col: str, vec_col: str, k: int, *, block: int = BLOCK) -> DataFrame:
    """(query_id, neighbor_id, distance, rank): the k nearest points of every query other than itself, exact, ties by id.

    Queries are taken in blocks of ``block`` vectors, each against all points: a task keeps the k best of its points for
    each query, so at most k rows per query and task are shuffled. Null vectors, and those of another length than the queries', are no neighbours.
    """
    kind = dict(points.dtypes)[id_col]
    asked = queries.where(F.col(vec_col).isNotNull()).select(F.col(id_col).alias("i"), F.col(vec_col).cast("array<double>").alias("v"))
    n = asked.count()
    blocks = max(1, math.ceil(n / block))
    slim = points.where(F.col(vec_col).isNotNull()).select(F.col(id_col).alias("i"), F.col(vec_col).cast("array<double>").alias("v"))
    out = queries.sparkSession.createDataFrame([], f"query_id {kind}, neighbor_id {kind}, distance double")
    for b in range(blocks):
        rows = (asked if blocks == 1 else asked.where(F.pmod(F.xxhash64("i"), F.lit(blocks)) == b)).collect()
        if rows:
            part = slim.mapInPandas(_nearest([r[0] for r in rows], np.array([r[1] for r in rows], float), k), out.schema)
            out = part if not b else out.unionByName(part)
    best = Window.partitionBy("query_id").orderBy("distance", "neighbor_id")
    return out.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def _nearest(ids: list, vectors: np.ndarray, k: int):
    """Keeps the k best points of a task for each query. A block of points is first compared by one matrix product; distances are then worked out exactly for those that may be among the best."""
    lengths, place = (vectors**2).sum(axis=1), {i: j for j, i in enumerate(ids)}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: list[list[tuple[float, int]]] = [[] for _ in ids]
        for b in batches:
            good = [len(v) == vectors.shape[1] for v in b["v"]]
            if not any(good):
                continue
            points, names = np.array(b["v"][good].tolist(), float), b["i"][good].to_numpy()
            for lo in range(0, len(points), 1024):
                p, q = points[lo : lo + 1024], names[lo : lo + 1024]
                sizes = (p**2).sum(axis=1)
                rough = lengths[:, None] + sizes[None, :] - 2 * vectors @ p.T
                for c, name in enumerate(q.tolist()):
                    if name in place:
                        rough[place[name], c] = np.inf
                slack = 1e-9 * (lengths[:, None] + sizes[None, :])
                edge = np.partition(rough + slack, k - 1, axis=1)[:, k - 1] if rough.shape[1] > k else np.full(len(ids), np.inf)
                known = np.array([of[-1][0] ** 2 * (1 + 1e-9) if len(of) == k else np.inf for of in best])
                near = (rough - slack <= np.minimum(edge, known)[:, None]) & np.isfinite(rough)
                for j in np.flatnonzero(near.any(axis=1)).tolist():
                    mine = np.flatnonzero(near[j])
                    d = np.sqrt(((p[mine] - vectors[j]) ** 2).sum(axis=1))
                    best[j] = sorted([*best[j], *zip(d.tolist(), q[mine].tolist(), strict=True)])[:k]
        flat = [(ids[j], i, d) for j, of in enumerate(best) for d, i in of]
        yield pd.DataFrame(flat, columns=["query_id", "neighbor_id", "distance"])

    return run


def _hash_unit(start: int, *parts: Column) -> Column:
    text = F.md5(F.concat_ws("|", *parts))
    return F.conv(F.substring(text, start, 8), 16, 10).cast("long")


def smote(points: DataFrame, id_col: str, vec_col: str, label_col: str, minority: int, *, k: int = 5, copies: int = 1, seed: int = 42) -> DataFrame:
    """(id, neighbor_id, copy, lambda, vector): ``copies`` synthetic rows per minority row, on the line to one of its k nearest minority rows. Neighbour and position are a hash of id, copy and ``seed``."""
    mine = points.where(F.col(label_col) == minority).select(id_col, F.col(vec_col).cast("array<double>").alias("v"))
    near = knn(mine, mine, id_col, "v", k).groupBy("query_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "neighbor_id"))), lambda x: x["neighbor_id"]).alias("near"))
    drawn = near.select(F.col("query_id").alias(id_col), "near", F.explode(F.sequence(F.lit(1), F.lit(copies))).alias("copy"))
    parts = F.col(id_col).cast("string"), F.col("copy").cast("string"), F.lit(str(seed))
    drawn = drawn.select(id_col, "copy", F.element_at("near", (F.pmod(_hash_unit(9, *parts), F.size("near")) + 1).cast("int")).alias("neighbor_id"), (_hash_unit(1, *parts) / F.lit(4294967296.0)).alias("lambda"))
    other = mine.select(F.col(id_col).alias("neighbor_id"), F.col("v").alias("w"))
    return drawn.join(mine, id_col).join(other, "neighbor_id").select(id_col, "neighbor_id", "copy", "lambda", F.zip_with("v", "w", lambda a, b: a + (b - a) * F.col("lambda")).alias("vector"))


def tomek_links(points: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """(id_a, id_b), a below b: each the other's nearest, with different labels."""
    near = knn(points, points, id_col, vec_col, 1).select(F.col("query_id").alias("a"), F.col("neighbor_id").alias("b"))
    mutual = near.join(near.select(F.col("b").alias("a"), F.col("a").alias("b")), ["a", "b"]).where("a < b")
    label = lambda c: points.select(F.col(id_col).alias(c), F.col(label_col).alias(f"l{c}"))
    return mutual.join(label("a"), "a").join(label("b"), "b").where("la <> lb").select(F.col("a").alias("id_a"), F.col("b").alias("id_b"))


def smote_tomek(train: DataFrame, id_col: str, vec_col: str, label_col: str, minority: int, *, k: int = 5, copies: int = 1, seed: int = 42) -> DataFrame:
    """(id, label, vector): the training rows with ``copies`` synthetic rows per minority row, less both rows of every Tomek link among them. Ids are texts: a row's own, or ``<id>#<copy>`` for a synthetic one. For training rows only, never for rows that a model is judged on."""
    kind = dict(train.dtypes)[label_col]
    own = train.where(F.col(vec_col).isNotNull()).select(F.col(id_col).cast("string").alias("id"), F.col(label_col).alias("label"), F.col(vec_col).cast("array<double>").alias("vector"))
    made = smote(train, id_col, vec_col, label_col, minority, k=k, copies=copies, seed=seed).select(F.concat_ws("#", F.col(id_col).cast("string"), F.col("copy").cast("string")).alias("id"), F.lit(minority).cast(kind).alias("label"), "vector")
    both = materialize(own.unionByName(made))
    links = tomek_links(both, "id", "vector", "label")
    linked = links.select(F.explode(F.array("id_a", "id_b")).alias("id"))
    return both.join(linked, "id", "left_anti")


def context_scores(context: DataFrame, df: DataFrame, id_col: str, vec_col: str, label_col: str, *, cap: int = 50_000, chunk: int = 512, k: int = 50) -> DataFrame:
    """(id, score) of every row of ``df``: the distance-weighted share of positives among its k nearest rows of a context of at most ``cap`` labelled rows, a sample by hash with each label in proportion.

    The context is all that such a model learns from, so it is broadcast whole; rows are scored ``chunk`` at a time. Null vectors have no score and are left out.
    """
    held = capped(context.where(F.col(vec_col).isNotNull()), cap, [label_col], [id_col]).select(F.col(vec_col).cast("array<double>"), F.col(label_col).cast("double")).collect()
    points, labels = np.array([r[0] for r in held], float), np.array([r[1] for r in held], float)
    lengths = (points**2).sum(axis=1) if len(points) else np.empty(0)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for lo in range(0, len(b), chunk):
                part = b.iloc[lo : lo + chunk]
                q = np.array(part["v"].tolist(), float)
                d = np.sqrt(np.maximum(0, (q**2).sum(axis=1)[:, None] + lengths[None, :] - 2 * q @ points.T))
                near = np.argpartition(d, k - 1, axis=1)[:, :k] if d.shape[1] > k else np.tile(np.arange(d.shape[1]), (len(part), 1))
                weight = 1 / (1e-6 + np.take_along_axis(d, near, axis=1))
                yield pd.DataFrame({"id": part["i"], "score": (weight * labels[near]).sum(axis=1) / weight.sum(axis=1)})

    kind = dict(df.dtypes)[id_col]
    asked = df.where(F.col(vec_col).isNotNull()).select(F.col(id_col).alias("i"), F.col(vec_col).cast("array<double>").alias("v"))
    return asked.mapInPandas(run, f"id {kind}, score double") if len(points) else df.sparkSession.createDataFrame([], f"id {kind}, score double")
