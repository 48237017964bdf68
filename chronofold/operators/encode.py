"""Encoding for models: fixed one-hots, alignment, scaling with frozen parameters."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The levels of the category features in their order.
LEVELS = {
    "admission_type": ("elective", "emergency", "other", "unknown", "urgent"),
    "marital_status": ("divorced", "married", "other", "single", "unknown", "widowed"),
    "race": ("asian", "black", "hispanic_latino", "other", "unknown", "white"),
}


def one_hot(df: DataFrame, levels: dict[str, Sequence[str]], *, drop_first: bool = True, missing: str = "unknown") -> DataFrame:
    """``<column>_<level>`` as 1.0 or 0.0 in place of each category column; null counts as ``missing``; a value that is no level is all zeros."""
    out = [F.col(c) for c in df.columns if c not in levels]
    for c, of in levels.items():
        value = F.coalesce(F.trim(F.col(c)), F.lit(missing))
        out += [(value == level).cast("double").alias(f"{c}_{level}") for level in list(of)[drop_first:]]
    return df.select(*out)


def category_levels(df: DataFrame, allowed: dict[str, Sequence[str]], *, missing: str = "unknown") -> dict[str, list[str]]:
    """The levels that occur, in the order of ``allowed``; null is ``missing``. ValueError for one that isn't allowed, with ten such values. One pass that counts the allowed levels and the rest; no other value comes to the driver."""
    value = {c: F.coalesce(F.trim(F.col(c)), F.lit(missing)) for c in allowed}
    row = df.agg(*[F.count_if(value[c] == level).alias(f"{i}|{k}") for i, (c, of) in enumerate(allowed.items()) for k, level in enumerate(of)], *[F.count_if(~value[c].isin(*of)).alias(f"{i}|odd") for i, (c, of) in enumerate(allowed.items())]).first()
    for i, (c, of) in enumerate(allowed.items()):
        if row[f"{i}|odd"]:
            odd = df.select(value[c].alias("v")).where(~F.col("v").isin(*of)).distinct().limit(10).collect()
            raise ValueError(f"{c} has levels that aren't allowed: {sorted(r[0] for r in odd)}")
    return {c: [level for k, level in enumerate(of) if row[f"{i}|{k}"]] for i, (c, of) in enumerate(allowed.items())}


def align(df: DataFrame, columns: Sequence[str], fill: float = 0.0) -> DataFrame:
    """Exactly the trained columns; what is missing is ``fill``, what is unknown is dropped."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(fill).alias(c) for c in columns])


def fit_scaler(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation of each column; a constant column has deviation 1."""
    v = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in columns}
    row = df.agg(*[F.avg(x).alias(f"m{i}") for i, x in enumerate(v.values())], *[F.stddev_pop(x).alias(f"s{i}") for i, x in enumerate(v.values())]).first()
    return {c: (row[f"m{i}"], row[f"s{i}"] or 1.0) for i, c in enumerate(columns)}


def scale(df: DataFrame, params: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in params.items()})


def scale_vector(train: DataFrame, vec: str) -> Callable[[DataFrame], DataFrame]:
    """A function that scales a vector column by the mean and population deviation its places have in ``train``; a constant place has deviation 1."""
    row = train.select(Summarizer.metrics("mean", "variance", "count").summary(F.col(vec)).alias("x")).select("x.*").first()
    n, mean = row["count"], row["mean"].toArray()
    deviation = np.sqrt(row["variance"].toArray() * (n - 1) / max(n, 1))
    deviation[deviation == 0] = 1.0
    places = F.array(*[F.struct(F.lit(float(m)).alias("m"), F.lit(float(s)).alias("s")) for m, s in zip(mean, deviation, strict=True)])
    return lambda df: df.withColumn(vec, array_to_vector(F.zip_with(vector_to_array(vec), places, lambda v, p: (v - p["m"]) / p["s"])))
