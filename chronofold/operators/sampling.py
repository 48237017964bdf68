"""Samples and splits by hash: the same rows whatever the partitioning."""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronofold.operators.profile import group_label
from chronofold.operators.relational import coverage
from chronofold.operators.skew import distributed_rank, salted_join
from chronofold.session import materialize


def hash_text(keys: Sequence[str], seed: int | str) -> Column:
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))


def sample_n(df: DataFrame, n: int, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """``n`` rows, the least by a hash of their keys."""
    return df.orderBy(hash_text(keys, seed), *keys).limit(n)


def capped(df: DataFrame, n: int, strata: Sequence[str], keys: Sequence[str], seed: int = 42) -> DataFrame:
    """About ``n`` rows, each stratum in proportion (at least one row of each): the least by hash. All rows if there are no more."""
    ranked = distributed_rank(df, strata, hash_text(keys, seed), keys, "__rk", total="__n")
    total = df.agg(F.count(F.lit(1))).scalar()
    quota = F.greatest(F.lit(1), F.floor(F.col("__n") * F.lit(n) / total))
    return ranked.where((total <= n) | (F.col("__rk") <= quota)).drop("__rk", "__n")


def grid_sample(grid: dict[str, Sequence], n: int, seed: int = 42) -> list[dict]:
    """``n`` different points of a grid of parameters, in the order of a hash."""
    points = [dict(zip(grid, p, strict=True)) for p in itertools.product(*grid.values())]
    return sorted(points, key=lambda p: hashlib.md5(f"{seed}|{sorted(p.items())}".encode()).hexdigest())[:n]


def _by_share(ranked: DataFrame, shares: dict[str, float]) -> Column:
    position, upto, out = (F.col("__rk") - 1) / F.col("__n"), 0.0, None
    names = list(shares)
    for name in names[:-1]:
        upto += shares[name]
        hit = position < F.lit(round(upto, 10))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise(names[-1]) if out is not None else F.lit(names[-1])


def group_split(df: DataFrame, group: str, shares: dict[str, float], *, label: str | None = None, seed: int = 42) -> DataFrame:
    """``df`` with ``split``: all rows of a group together; with ``label``, groups with and without a positive are shared out apart.

    Groups are ordered by a hash of their name within their stratum and cut at the shares. A null group is one group.
    """
    groups = group_label(df, group, label) if label else df.select(group).distinct()
    ranked = distributed_rank(groups, [label] if label else [], hash_text([group], seed), [group], "__rk", total="__n")
    placed = ranked.select(F.col(group).alias("__g"), _by_share(ranked, shares).alias("split"))
    named = df.withColumn("__g", F.col(group)) if group else df
    known = salted_join(named.where(F.col("__g").isNotNull()), placed, ["__g"]).drop("__g")
    none = placed.where(F.col("__g").isNull()).select("split").limit(1)
    orphans = df.where(F.col(group).isNull()).withColumn("split", none.scalar())
    return known.unionByName(orphans)


def row_split(df: DataFrame, keys: Sequence[str], label: str, shares: dict[str, float], seed: int = 42) -> DataFrame:
    """``df`` with ``split``, shared out row by row within each label."""
    ranked = distributed_rank(df, [label], hash_text(keys, seed), keys, "__rk", total="__n")
    return ranked.withColumn("split", _by_share(ranked, shares)).drop("__rk", "__n")


def check_split(df: DataFrame, group: str, split: str, whole: DataFrame, *, most: int = 1000) -> dict[str, int]:
    """Raises ValueError if splits share a group, miss one, have a foreign one, or are more than ``most``; else the counts."""
    names = [r[0] for r in df.select(split).distinct().limit(most + 1).collect()]
    if len(names) > most:
        raise ValueError(f"more than {most} splits")
    found = coverage([df.where(F.col(split) == n) for n in names], whole, group).first().asDict()
    if any(found.values()):
        raise ValueError(f"the split isn't sound: {found}")
    return found


def check_positive_groups(df: DataFrame, group: str, label: str, shares: dict[str, float], *, least: int = 3) -> int:
    """The number of groups with a positive. ValueError if the shares aren't positive numbers that add up to 1, or if there are fewer than ``least`` such groups or than splits, so that a split would be without any."""
    if any(x <= 0 for x in shares.values()) or abs(sum(shares.values()) - 1) > 1e-9:
        raise ValueError(f"shares must be positive and add up to 1: {shares}")
    n = df.where((F.col(label) == 1) & F.col(group).isNotNull()).select(group).distinct().limit(max(least, len(shares))).count()
    if n < max(least, len(shares)):
        raise ValueError(f"only {n} values of {group} have a positive {label}; {max(least, len(shares))} are needed")
    return n


def ordinal(df: DataFrame, order: Sequence[str], out: str = "row_no") -> DataFrame:
    """Row numbers from 0 in the order of ``order``, without one task sorting all rows: range partitions, counted, then offset."""
    local = materialize(df.orderBy(*order).withColumn("__part", F.spark_partition_id()).withColumn("__local", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    sizes = local.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    starts, at = {}, 0
    for r in sorted(sizes.collect(), key=lambda r: r["__part"]):  # a row a partition
        starts[r["__part"]], at = at, at + r["__n"]
    table = df.sparkSession.createDataFrame(list(starts.items()), "__part int, __start long")
    return local.join(F.broadcast(table), "__part").withColumn(out, F.col("__local") + F.col("__start")).drop("__part", "__local", "__start")
