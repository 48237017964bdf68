"""Profiles and class statistics, each in one pass over the table."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def _unpivot(df: DataFrame, cells: dict[str, dict[str, Column]], name: str) -> DataFrame:
    """One aggregate per column and figure, then a row per column."""
    row = df.agg(*[agg.alias(f"{c}\x01{k}") for c, of in cells.items() for k, agg in of.items()])
    rows = F.array(*[F.struct(F.lit(c).alias(name), *[F.col(f"`{c}\x01{k}`").alias(k) for k in of]) for c, of in cells.items()])
    return row.select(F.explode(rows).alias("r")).select("r.*")


def value_counts(df: DataFrame, c: str) -> DataFrame:
    """(value, n, share) with null as a value. The total is a scalar subquery."""
    counts = df.groupBy(F.col(c).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / counts.agg(F.sum("n")).scalar())


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, n_distinct) without null: one small aggregate per column, so no row is expanded by the number of columns."""
    out = None
    for c in columns:
        one = df.where(F.col(c).isNotNull()).select(c).distinct().agg(F.lit(c).alias("column"), F.count(F.lit(1)).alias("n_distinct")).select("column", "n_distinct")
        out = one if out is None else out.unionByName(one)
    return out


def missing_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, n_missing, pct_missing): nulls, and NaN in numbers. An empty table has null percentages."""
    kinds = dict(df.dtypes)
    gone = lambda c: F.col(c).isNull() | F.isnan(c) if kinds[c] in ("double", "float") else F.col(c).isNull()
    cells = {c: {"n_missing": F.count_if(gone(c)), "pct_missing": F.round(F.try_divide(F.count_if(gone(c)) * F.lit(100.0), F.count(F.lit(1))), 4)} for c in columns or df.columns}
    return _unpivot(df, cells, "column")


def zero_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, n_zero, pct_zero) of the columns that there are."""
    cells = {c: {"n_zero": F.count_if(F.col(c) == 0), "pct_zero": F.round(F.try_divide(F.count_if(F.col(c) == 0) * F.lit(100.0), F.count(F.lit(1))), 4)} for c in columns if c in df.columns}
    return _unpivot(df, cells, "column")


def exact_quantiles(df: DataFrame, columns: Sequence[str], shares: Sequence[float], *, bins: int = 1024, keep: int = 10_000) -> dict[str, list[float | None]]:
    """For each column its quantiles at ``shares``, interpolated between the two nearest ranks; exact, null and NaN left out, infinities counted as the largest numbers; None without a value.

    The ranks are narrowed down: a pass counts the rows of ``bins`` equal bins of every range that still holds a wanted rank (partial aggregates, at most
    ``bins`` rows a range), until a range is one value or holds at most ``keep`` rows, whose values are then listed. No task sees a column's distinct values. Ranges are
    cut between the values that occur, so most columns take two or three passes.
    """
    top = 1.7976931348623157e308
    number = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in columns}
    v = {c: F.when(x > top, top).when(x < -top, -top).otherwise(x) for c, x in number.items()}
    row = df.agg(*[f(x).alias(f"{k}{i}") for i, x in enumerate(v.values()) for k, f in (("n", F.count), ("lo", F.min), ("hi", F.max))]).first()
    n = {c: row[f"n{i}"] for i, c in enumerate(columns)}
    wanted = {c: sorted({r for q in shares for r in (math.floor(q * (n[c] - 1)), math.ceil(q * (n[c] - 1)))}) if n[c] else [] for c in columns}
    # A range: column, ends, rows before it, rows in it, wanted ranks in it.
    todo = [(c, row[f"lo{i}"], row[f"hi{i}"], 0, n[c], wanted[c]) for i, c in enumerate(columns) if n[c]]
    at: dict[tuple[str, int], float] = {}
    listed = []
    while todo:
        wide = []
        for r in todo:
            c, lo, hi, _, rows, ranks = r
            if lo == hi:
                at |= {(c, k): lo for k in ranks}
            else:
                (listed if rows <= keep else wide).append(r)
        todo = []
        if not wide:
            break
        cells = [F.when(v[c].between(lo, hi), F.struct(F.lit(i).alias("i"), F.least(F.lit(bins - 1), F.floor((v[c] / 2 - lo / 2) / F.lit(hi / 2 - lo / 2) * bins)).alias("bin"), v[c].alias("v"))) for i, (c, lo, hi, *_) in enumerate(wide)]
        counts = df.select(F.explode(F.array_compact(F.array(*cells))).alias("x")).groupBy("x.i", "x.bin").agg(F.count(F.lit(1)).alias("n"), F.min("x.v").alias("lo"), F.max("x.v").alias("hi")).collect()
        for i, (c, _, _, before, _, ranks) in enumerate(wide):
            for x in sorted((x for x in counts if x["i"] == i), key=lambda x: x["bin"]):
                inside = [k for k in ranks if before <= k < before + x["n"]]
                if inside:
                    todo.append((c, x["lo"], x["hi"], before, x["n"], inside))
                before += x["n"]
    if listed:
        cells = [F.when(v[c].between(lo, hi), F.struct(F.lit(i).alias("i"), v[c].alias("v"))) for i, (c, lo, hi, *_) in enumerate(listed)]
        values: list[list[tuple[float, int]]] = [[] for _ in listed]
        for x in df.select(F.explode(F.array_compact(F.array(*cells))).alias("x")).groupBy("x.i", "x.v").agg(F.count(F.lit(1)).alias("n")).collect():
            values[x["i"]].append((x["v"], x["n"]))
        for (c, _, _, before, _, ranks), found in zip(listed, values, strict=True):
            for value, many in sorted(found):
                at |= {(c, k): value for k in ranks if before <= k < before + many}
                before += many
    out: dict[str, list[float | None]] = {}
    for c in columns:
        out[c] = []
        for q in shares:
            if not n[c]:
                out[c].append(None)
                continue
            place = q * (n[c] - 1)
            low, high = at[(c, math.floor(place))], at[(c, math.ceil(place))]
            out[c].append(low + (high - low) * (place - math.floor(place)))
    return out


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, n, mean, std, min, q25, q50, q75, max): exact, sample deviation, null and NaN left out. A row a column."""
    v = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in columns}
    row = df.agg(*[f(x).alias(f"{k}{i}") for i, x in enumerate(v.values()) for k, f in (("n", F.count), ("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))]).first()
    q = exact_quantiles(df, columns, (0.25, 0.5, 0.75))
    rows = [(c, row[f"n{i}"], row[f"mean{i}"], row[f"std{i}"], row[f"min{i}"], *q[c], row[f"max{i}"]) for i, c in enumerate(columns)]
    return df.sparkSession.createDataFrame(rows, "column string, n long, mean double, std double, min double, q25 double, q50 double, q75 double, max double")


def medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the exact median of each column, null and NaN left out."""
    q = exact_quantiles(df, columns, (0.5,))
    return df.sparkSession.createDataFrame([tuple(q[c][0] for c in columns)], ", ".join(f"`{c}` double" for c in columns))


def repeats(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows, keys, rows beyond the first of their key, rows whose key repeats."""
    n = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return n.agg(zero(F.sum("n")).alias("n_rows"), F.count(F.lit(1)).alias("n_keys"), zero(F.sum(F.col("n") - 1)).alias("n_extra"), zero(F.sum(F.when(F.col("n") > 1, F.col("n")))).alias("n_in_repeats"))


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """One row: positives, negatives, negatives per positive (null without a positive)."""
    pos, neg = F.count_if(F.col(label) == 1), F.count_if(F.col(label) == 0)
    return df.agg(pos.alias("n_pos"), neg.alias("n_neg"), F.try_divide(neg, pos).alias("ratio"))


def class_ratio(df: DataFrame, label: str) -> float:
    """Negatives per positive; ValueError without a positive."""
    r = class_balance(df, label).first()
    if not r["n_pos"]:
        raise ValueError(f"{label} has no positive")
    return r["ratio"]


def balanced_weights(df: DataFrame, label: str) -> DataFrame:
    """(label, n, weight): rows / (classes * rows of the class)."""
    counts = df.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n") / F.count(F.lit(1))).scalar()
    return counts.withColumn("weight", total / F.col("n"))


def positive_rates(df: DataFrame, split: str, group: str, label: str) -> DataFrame:
    """(split, n_rows, n_groups, row_rate, group_rate): a group is positive if any of its rows is."""
    by = df.groupBy(split, group).agg(F.count(F.lit(1)).alias("n"), F.sum(label).alias("p"), F.max(label).alias("any"))
    return by.groupBy(split).agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_groups"), (F.sum("p") / F.sum("n")).alias("row_rate"), F.avg("any").alias("group_rate"))


def mean_abs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, mean_abs), null and NaN left out."""
    return _unpivot(df, {c: {"mean_abs": F.avg(F.abs(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))))} for c in columns}, "column")


def best_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], columns: Sequence[str]) -> DataFrame:
    """The greatest row of each group by ``order``: a partial aggregate, no sort."""
    best = df.groupBy(*group).agg(F.max_by(F.struct(*columns), F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])).alias("b"))
    return best.select(*group, *[F.col("b")[c].alias(c) for c in columns])


def group_label(df: DataFrame, group: str, label: str) -> DataFrame:
    """(group, label): the greatest label of its rows."""
    return df.groupBy(group).agg(F.max(label).alias(label))


def observed(df: DataFrame, name: str, **figures: Column) -> tuple[DataFrame, Observation]:
    """``df`` with an observer that counts ``n_rows`` and ``figures`` while some action runs over it, without a pass of its own: progress and totals of a running job. ``observation.get`` waits for that action."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("n_rows"), *[c.alias(k) for k, c in figures.items()]), seen
