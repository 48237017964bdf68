"""Exact Shapley values of MLlib trees, with the training weights of branches as background."""

from __future__ import annotations

from collections.abc import Iterator
from math import factorial

import numpy as np
import pandas as pd
from pyspark.ml import Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame


def leaf_paths(model: Transformer) -> list[list[tuple[float, list[tuple[int, float, bool, float]]]]]:
    """For each tree its leaves: (weighted value, conditions on the way as (feature, threshold, goes left, share of the node's rows))."""
    java = model._java_obj
    trees = list(java.trees()) if hasattr(model, "trees") else [java]
    weights = list(java.treeWeights()) if hasattr(model, "trees") else [1.0]
    classify = type(model).__name__ in ("DecisionTreeClassificationModel", "RandomForestClassificationModel")
    total = sum(weights)
    out = []
    for tree, weight in zip(trees, weights, strict=True):
        leaves: list = []

        def walk(node, way, weight=weight, leaves=leaves) -> None:
            if node.subtreeDepth() == 0:
                stats = node.impurityStats()
                value = stats.prob(1.0) / total if classify else node.prediction()
                leaves.append((value * weight, way))
                return
            split, left, right = node.split(), node.leftChild(), node.rightChild()
            n = node.impurityStats().count()
            for child, goes_left in ((left, True), (right, False)):
                walk(child, [*way, (split.featureIndex(), split.threshold(), goes_left, child.impurityStats().count() / n)])

        walk(tree.rootNode(), [])
        out.append(leaves)
    return out


def shapley(paths, x: np.ndarray) -> tuple[np.ndarray, float]:
    """(values by row and feature, expected value). A leaf is a product over the features on its way, whose Shapley value has a closed form; leaves add up."""
    phi, base = np.zeros(x.shape), 0.0
    for leaves in paths:
        for value, way in leaves:
            meets: dict[int, np.ndarray] = {}
            share: dict[int, float] = {}
            for f, t, left, part in way:
                ok = (x[:, f] <= t) == left
                meets[f] = meets[f] & ok if f in meets else ok
                share[f] = share.get(f, 1.0) * part
            base += value * float(np.prod(list(share.values())))
            d = len(share)
            for j in share:
                poly = [np.ones(len(x))]  # by the number of known features among the others
                for i in share:
                    if i != j:
                        grown = [np.zeros(len(x)) for _ in range(len(poly) + 1)]
                        for k, c in enumerate(poly):
                            grown[k] += c * share[i]
                            grown[k + 1] += c * meets[i]
                        poly = grown
                weight = sum(c * (factorial(k) * factorial(d - k - 1) / factorial(d)) for k, c in enumerate(poly))
                phi[:, j] += value * (meets[j] - share[j]) * weight
    return phi, base


def explain(model: Transformer, df: DataFrame, id_col: str, names: list[str]) -> DataFrame:
    """(id, base, total, one value per feature) of each row: base plus the values is the tree output (a probability for tree and forest, the margin for boosted trees)."""
    paths = leaf_paths(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if not len(b):
                continue
            phi, base = shapley(paths, np.array(b["x"].tolist(), float))
            yield pd.concat([b[["id"]].reset_index(drop=True), pd.DataFrame({"base": base, "total": base + phi.sum(axis=1)}), pd.DataFrame(phi, columns=names)], axis=1)

    kind = dict(df.dtypes)[id_col]
    slim = df.select(df[id_col].alias("id"), vector_to_array("features").alias("x"))
    return slim.mapInPandas(run, f"id {kind}, base double, total double, " + ", ".join(f"`{n}` double" for n in names))
