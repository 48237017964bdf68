"""Joins, set operations, de-duplication and column layout."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronofold.operators.skew import salted_join


class CardinalityError(ValueError):
    """Keys that should be unique aren't."""


def reindex(df: DataFrame, columns: Sequence[str], fill: Any = None) -> DataFrame:
    """Exactly ``columns`` in that order: missing ones hold ``fill``, others are dropped."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(fill).alias(c) for c in columns])


def follow_template(df: DataFrame, template: Sequence[str] | None) -> DataFrame:
    """The template's columns that there are first, new ones after them; as it is without a template."""
    if not template:
        return df
    return df.select(*[c for c in template if c in df.columns], *[c for c in df.columns if c not in template])


def move_last(df: DataFrame, name: str) -> DataFrame:
    return df.select(*[c for c in df.columns if c != name], name)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key by ``order`` and then by all columns. Aggregated partially before the shuffle, so copies of a key meet as one row."""
    rank = F.struct(*[F.col(c).alias(f"o{i}") if isinstance(c, str) else c.alias(f"o{i}") for i, c in enumerate(order)], *[F.col(c).alias(f"c{i}") for i, c in enumerate(df.columns)])
    best = df.groupBy(*keys).agg(F.min(rank).alias("__r"))
    return best.select(*[F.col("__r")[f"c{i}"].alias(c) for i, c in enumerate(df.columns)])


def left_lookup(df: DataFrame, lookup: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Left join with the first row per key of ``lookup``: no row is multiplied. Hot keys are salted."""
    return salted_join(df, keep_first(lookup, keys, order), keys, "left")


def semi(df: DataFrame, keys_of: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys occur in ``keys_of``. Null keys never do."""
    return df.join(keys_of.select(*keys).distinct(), list(keys), "left_semi")


def anti(df: DataFrame, keys_of: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys don't occur in ``keys_of``, those with null keys included."""
    return df.join(keys_of.select(*keys).distinct(), list(keys), "left_anti")


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, n) of the keys with several rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def one_to_one(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """A join that raises CardinalityError if either side repeats a key."""
    for name, side in (("left", left), ("right", right)):
        if (bad := repeated_keys(side, keys).take(3)):
            raise CardinalityError(f"the {name} side repeats keys, such as {[tuple(r) for r in bad]}")
    return left.join(right, list(keys), how)


def union_all(*dfs: DataFrame) -> DataFrame:
    """All rows by name; columns that a table lacks are null."""
    out = dfs[0]
    for df in dfs[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def coverage(parts: Sequence[DataFrame], whole: DataFrame, key: str) -> DataFrame:
    """One row: values of ``key`` in several parts, in none, and in a part but not in the whole."""
    tagged = union_all(*[p.select(F.col(key).alias("k"), F.lit(i).alias("part")).distinct() for i, p in enumerate(parts)]).groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    both = tagged.join(whole.select(F.col(key).alias("k")).distinct().withColumn("there", F.lit(1)), "k", "full")
    return both.agg(F.count_if(F.col("n") > 1).alias("n_overlap"), F.count_if(F.col("n").isNull()).alias("n_uncovered"), F.count_if(F.col("there").isNull()).alias("n_foreign"))


def with_thresholds(df: DataFrame, thresholds: Sequence[float]) -> DataFrame:
    """Each row once per threshold: the thresholds are an array literal that is exploded, there is no join."""
    return df.withColumn("threshold", F.explode(F.array(*[F.lit(float(t)) for t in thresholds])))
