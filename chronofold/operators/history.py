"""Strictly prior history of each event: counts, distinct counts, sums, means, extremes, ratios, last values."""

from __future__ import annotations

import heapq
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

from chronofold.operators.asof import Fact, asof_state
from chronofold.operators.skew import hot_keys

#: Rows of an entity up to which a running median is a plain window.
LONG = 500


@dataclass(frozen=True)
class History:
    """Facts with a time, and the features they give: output -> (kind, column).

    Kinds: count (rows, or non-null values), distinct, sum, avg, max, min, ratio (sum / rows; 0 without a row), last (the latest row's
    own value, null included). ``order`` breaks ties in time for last.
    """

    df: DataFrame
    time: str
    features: dict[str, tuple[str, str | None]]
    order: tuple[str, ...] = ()


def prior_features(events: DataFrame, histories: Sequence[History], entity: str, at: str, **sharding: int) -> DataFrame:
    """``events`` with the features of their entity's facts strictly before ``at``.

    All facts are merged with the events on one timeline, in one shuffle (asof_state). A distinct count is a count of
    first occurrences, which are found by an aggregate on (entity, value). Counts and ratios are 0 without history, the others null.
    """
    facts, final = [], {}
    for h in histories:
        states: dict[str, tuple[str, str | None]] = {}
        for out, (kind, c) in h.features.items():
            if kind == "distinct":
                firsts = h.df.where(F.col(c).isNotNull()).groupBy(entity, c).agg(F.min(h.time).alias(h.time))
                facts.append(Fact(firsts, h.time, {out: ("count", c)}))
                final[out] = F.col(out)
            elif kind in ("avg", "ratio"):
                states[f"__sum_{out}"], states[f"__n_{out}"] = ("sum", c), ("count", c if kind == "avg" else None)
                value = F.try_divide(F.col(f"__sum_{out}").cast("double"), F.col(f"__n_{out}"))
                final[out] = F.coalesce(value, F.lit(0.0)) if kind == "ratio" else value
            else:
                states[out] = (kind, c)
                final[out] = F.col(out)
        if states:
            facts.append(Fact(h.df, h.time, states, order=h.order))
    merged = asof_state(events, facts, entity, at, **sharding)
    return merged.select(*[F.col(c) for c in events.columns if c not in final], *[v.alias(k) for k, v in final.items()])


def at_visit_time(facts: DataFrame, visits: DataFrame, visit_key: str, entity: str, time: str) -> DataFrame:
    """Facts of a visit, dated by it: a fact counts for the visits after its own. Facts of unknown visits are left out; entity and time are the visit's."""
    when = visits.groupBy(visit_key).agg(F.min(entity).alias(entity), F.min(time).alias(time))
    return facts.drop(entity, time).join(when, visit_key)


def default_zero(value: Column, n_earlier: Column) -> Column:
    """0 where there is no earlier visit; else the value, which may be null."""
    return F.when(n_earlier == 0, F.lit(0).cast("double")).otherwise(value)


def visit_sequence(visits: DataFrame, entity: str, time: str, tie: str, lengths: dict[str, str], **sharding: int) -> DataFrame:
    """Visits with what the entity's visits before them by (time, tie) give.

    ``n_prev``; ``days_since_last`` and ``avg_gap_days`` (the mean of the gaps between the visits before this one); for each length ``c``
    named ``name``: ``avg_prev_<name>``, ``max_prev_<name>`` (nulls skipped) and ``last_<name>`` (not skipped). Null without what they need.
    """
    states = {"n_prev": ("count", None), "__first": ("min", time), "__prev": ("max", time)}
    for name, c in lengths.items():
        states |= {f"__s_{name}": ("sum", c), f"__c_{name}": ("count", c), f"max_prev_{name}": ("max", c), f"last_{name}": ("last", c)}
    one = asof_state(visits, [Fact(visits, time, states, tie=tie, order=(tie,))], entity, time, tie, **sharding)
    one = one.withColumn("days_since_last", F.timestamp_diff("MICROSECOND", "__prev", time) / 8.64e10)
    for name in lengths:
        one = one.withColumn(f"avg_prev_{name}", F.try_divide(F.col(f"__s_{name}"), F.col(f"__c_{name}"))).drop(f"__s_{name}", f"__c_{name}")
    # The mean of earlier gaps telescopes: from the first visit to the one before this, over the number of gaps between them.
    gap = F.timestamp_diff("MICROSECOND", "__first", "__prev") / 8.64e10
    return one.withColumn("avg_gap_days", F.when(F.col("n_prev") >= 2, gap / (F.col("n_prev") - 1))).drop("__first", "__prev")


def prior_median(df: DataFrame, entity: str, order: Sequence[str], columns: dict[str, str], *, floor: int = LONG) -> DataFrame:
    """The exact median of each column (output -> column) over the entity's rows before, null and NaN left out.

    A running median has no state of bounded size, so an entity's rows must fit one task. Entities of up to ``floor`` rows go through a plain window, whose
    cost is quadratic in an entity's rows; longer ones keep two heaps (n log n). Without a long entity there is no Python. Rows without an entity are one entity.
    """
    w = Window.partitionBy(entity).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    windowed = lambda d: d.withColumns({out: F.percentile(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")), F.lit(0.5)).over(w) for out, c in columns.items()})
    long = hot_keys(df.select(entity), [entity], floor=floor)
    if not long:
        return windowed(df)
    names = df.sparkSession.createDataFrame([(r[entity], True) for r in long], StructType([StructField("__long_e", df.schema[entity].dataType), StructField("__long", BooleanType())]))
    told = df.join(F.broadcast(names), F.col(entity).eqNullSafe(F.col("__long_e")), "left").drop("__long_e")
    schema = StructType([*[f for f in df.schema.fields if f.name not in columns], *[StructField(out, DoubleType()) for out in columns]])

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.take(pc.sort_indices(rows, [(c, "ascending") for c in order], null_placement="at_start"))
        found = {out: _running_medians(pc.cast(rows[c], pa.float64(), safe=False).to_numpy(zero_copy_only=False)) for out, c in columns.items()}
        rows = rows.drop_columns([c for c in columns if c in rows.column_names])
        for out, values in found.items():
            rows = rows.append_column(out, pa.array(values, from_pandas=True))  # NaN, where there is nothing before, is null
        return rows

    heaps = told.where(F.col("__long")).drop("__long").groupBy(entity).applyInArrow(run, schema)
    return windowed(told.where(F.col("__long").isNull()).drop("__long")).select(*schema.fieldNames()).unionByName(heaps)


def _running_medians(values: np.ndarray) -> np.ndarray:
    """The median of the values before each, NaN left out; NaN where there is none. The lower half is a heap of negated values, never smaller than the upper one."""
    low: list[float] = []
    high: list[float] = []
    out = np.full(len(values), np.nan)
    for i, v in enumerate(values.tolist()):
        if low:
            out[i] = -low[0] if len(low) > len(high) else (high[0] - low[0]) / 2
        if v != v:
            continue
        heapq.heappush(high, -heapq.heappushpop(low, -v))
        if len(high) > len(low):
            heapq.heappush(low, -heapq.heappop(high))
    return out
