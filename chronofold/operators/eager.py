"""Eager aggregation: a join and an aggregation whose inputs are reduced to compact states first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def eager_join_aggregate(left: DataFrame, right: DataFrame, on: Sequence[str], group_by: Sequence[str], aggs: dict[str, tuple[str, str, str | None]], how: str = "inner") -> DataFrame:
    """The same rows as ``left.join(right, on, how).groupBy(group_by).agg(...)``, without joining raw rows.

    Each side is first aggregated (map-side partially) by its join keys and the grouping columns it
    owns; the compact states are joined; counts are multiplied, sums are multiplied by the other
    side's count, extremes are taken as they are; then everything is rolled up to ``group_by``. A key
    with a third of all rows becomes one row a task before the shuffle.

    ``aggs`` maps an output to (count | sum | avg | min | max, left | right, column or None for rows).
    ``how`` is inner or left. Null join keys match nothing (``left`` keeps them as a group of their
    own). Grouping columns of both names belong to ``left``. NaN is treated as null in numeric columns.
    """
    own = {"left": [c for c in group_by if c in left.columns], "right": [c for c in group_by if c not in left.columns]}
    sides = {"left": left, "right": right}
    state = {}
    for side, df in sides.items():
        cols = sorted({col for _, s, col in aggs.values() if s == side and col})
        parts = [F.count(F.lit(1)).alias(f"__{side}_n")]
        for c in cols:
            v = F.nanvl(F.col(c), F.lit(None).cast(dict(df.dtypes)[c])) if dict(df.dtypes)[c] in ("double", "float") else F.col(c)
            kinds = {kind for kind, s, col in aggs.values() if (s, col) == (side, c)}
            if kinds & {"sum", "avg"}:
                parts.append(F.sum(v).alias(f"__{side}_sum_{c}"))
            if kinds & {"count", "avg"}:
                parts.append(F.count(v).alias(f"__{side}_cnt_{c}"))
            parts += [f(v).alias(f"__{side}_{k}_{c}") for k, f in (("min", F.min), ("max", F.max)) if k in kinds]
        state[side] = df.groupBy(*dict.fromkeys([*on, *own[side]])).agg(*parts)
    joined = state["left"].join(state["right"], list(on), how)
    n = {"left": F.col("__left_n"), "right": F.coalesce("__right_n", F.lit(1))}
    pieces: dict[str, Column] = {}
    final: dict[str, Column] = {}
    rolled = set(group_by) != {*on, *own["left"], *own["right"]}
    up = lambda f, c: f(c) if rolled else F.col(c)
    for out, (kind, side, col) in aggs.items():
        other = n["right" if side == "left" else "left"]
        if kind == "count" and col is None:
            pieces[f"__a_{out}"] = n["left"] * n["right"] if side == "left" else n["left"] * F.coalesce("__right_n", F.lit(0))
        elif kind in ("count", "sum"):
            pieces[f"__a_{out}"] = F.col(f"__{side}_{'cnt' if kind == 'count' else 'sum'}_{col}") * other
        elif kind == "avg":
            pieces[f"__a_{out}"], pieces[f"__b_{out}"] = F.col(f"__{side}_sum_{col}") * other, F.col(f"__{side}_cnt_{col}") * other
        else:
            pieces[f"__a_{out}"] = F.col(f"__{side}_{kind}_{col}")
        if kind == "avg":
            final[out] = F.try_divide(up(F.sum, f"__a_{out}"), up(F.sum, f"__b_{out}"))
        else:
            final[out] = up({"min": F.min, "max": F.max}.get(kind, F.sum), f"__a_{out}")
            final[out] = F.coalesce(final[out], F.lit(0)) if kind == "count" else final[out]
    wide = joined.select(*group_by, *[v.alias(k) for k, v in pieces.items()])
    cols = [v.alias(k) for k, v in final.items()]
    return wide.groupBy(*group_by).agg(*cols) if rolled else wide.select(*group_by, *cols)


def with_share(states: DataFrame, count: str, out: str) -> DataFrame:
    """Add each row's share of the sum of ``count``: a scalar subquery over the compact states, no window over all of them."""
    total = states.agg(F.sum(count)).scalar()
    return states.withColumn(out, F.col(count) / F.nullif(total, F.lit(0).cast("long")))
