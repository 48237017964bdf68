"""Batch scoring: predictions with their versions, the presentation table, the keyed upsert."""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronofold.functions.exprs import label_at, mapped, right_closed_bins, round_2
from chronofold.operators.contract import SchemaError
from chronofold.operators.relational import CardinalityError, follow_template, one_to_one, semi

KEYS = ("subject_id", "hadm_id", "admittime")


class ScoringResult(NamedTuple):
    """The three tables of a scoring run."""

    master: DataFrame
    model_ready: DataFrame
    predictions: DataFrame


def check_keys(df: DataFrame, name: str) -> None:
    """SchemaError if a key column is missing or a row lacks its time."""
    if (missing := [c for c in KEYS if c not in df.columns]):
        raise SchemaError(f"{name} lacks {missing}")
    if (n := df.agg(F.count_if(F.col("admittime").try_cast("timestamp_ntz").isNull())).first()[0]):
        raise SchemaError(f"{name} has {n} rows without a valid admittime")


def predictions(scored: DataFrame, score: str, threshold: float, versions: dict[str, str], now: dt.datetime | None = None) -> DataFrame:
    """Keys, probability, threshold, label, versions and one timestamp for the whole run."""
    at = (now or dt.datetime.now(dt.timezone.utc)).isoformat()
    return scored.select(*KEYS, F.col(score).alias("predicted_probability"), F.lit(float(threshold)).alias("applied_threshold"), label_at(score, threshold).alias("predicted_label"), *[F.lit(v).alias(k) for k, v in versions.items()], F.lit(at).alias("scoring_timestamp"))


def dashboard(master: DataFrame, preds: DataFrame, template: list[str] | None = None, *, checked: bool = True) -> DataFrame:
    """Master rows with their predictions (one to one) and presentation columns, in the template's order."""
    joined = one_to_one(master, preds, KEYS) if checked else master.join(preds, list(KEYS), "left")
    text = {0: "Survived", 1: "Died"}
    out = joined.withColumns({
        "predicted_label_text": mapped("predicted_label", text), "actual_label_text": mapped("target", text),
        "age_group_dashboard": right_closed_bins("age", [39, 59], ["<40", "40-59", "60+"]), "predicted_probability_pct": round_2(F.col("predicted_probability") * 100),
    })
    return follow_template(out, template)


def deployment_rows(table: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of the given keys; CardinalityError if a key has no row or several."""
    wanted = keys.select(*KEYS).distinct()
    found = semi(table, wanted, KEYS)
    n, rows, distinct = wanted.count(), found.count(), found.select(*KEYS).distinct().count()
    if not n == rows == distinct:
        raise CardinalityError(f"{n} keys, {rows} rows of {distinct} keys")
    return found
