"""Imputation from each entity's past, with the training medians behind it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronofold.operators.history import prior_median
from chronofold.operators.profile import medians


def temporal_median_impute(fit: DataFrame, apply: DataFrame, entity: str, order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Missing values (null, NaN) become the median of the entity's own earlier raw values in ``apply``, else the column's median in ``fit``.

    The training medians are scalar subqueries. A column without any value in ``fit`` may stay null.
    """
    base = medians(fit, columns)
    out = prior_median(apply, entity, order, {f"__m_{c}": c for c in columns})
    filled = {c: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")), F.col(f"__m_{c}"), base.select(c).scalar()) for c in columns}
    return out.withColumns(filled).drop(*[f"__m_{c}" for c in columns])


def numeric_features(df: DataFrame, leave: Sequence[str]) -> list[str]:
    from pyspark.sql.types import NumericType

    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in leave]
