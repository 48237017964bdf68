"""Contracts: what a table must look like, checked in one pass, with the offences counted."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from chronofold.functions.exprs import TEXT_PLACEHOLDERS, missing_to_null, moment, number


class SchemaError(ValueError):
    """A table breaks its contract."""


@dataclass(frozen=True)
class ModelSchema:
    """The frozen input of a model: numeric and category features in order, and columns that may be there."""

    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    optional: tuple[str, ...] = ("subject_id", "hadm_id", "admittime", "target", "_original_order")
    version: str = "1.0"

    @property
    def features(self) -> tuple[str, ...]:
        return self.numeric + self.categorical

    def to_metadata(self) -> dict:
        return {"schema_version": self.version, "numeric_feature_columns": list(self.numeric), "categorical_feature_columns": list(self.categorical), "optional_columns": list(self.optional)}

    @classmethod
    def from_metadata(cls, data: dict) -> ModelSchema:
        return cls(tuple(data["numeric_feature_columns"]), tuple(data["categorical_feature_columns"]), tuple(data.get("optional_columns", ())), data["schema_version"])

    def check_columns(self, columns: Sequence[str]) -> None:
        if (missing := [c for c in self.features if c not in columns]):
            raise SchemaError(f"columns are missing: {missing}")
        if (extra := [c for c in columns if c not in self.features and c not in self.optional]):
            raise SchemaError(f"columns aren't expected: {extra}")

    def unreadable(self, df: DataFrame) -> DataFrame:
        """One row: for each numeric feature the values that are there but are no number."""
        text = lambda c: missing_to_null(F.col(c).cast("string"))
        return df.agg(*[F.count_if(text(c).isNotNull() & text(c).try_cast("double").isNull()).alias(c) for c in self.numeric])

    def prepare(self, df: DataFrame) -> DataFrame:
        """The features in order: numbers as double, placeholders as null. SchemaError if a column or a number isn't as agreed."""
        self.check_columns(df.columns)
        bad = {c: n for c, n in self.unreadable(df).first().asDict().items() if n}
        if bad:
            raise SchemaError(f"values that are no numbers: {bad}")
        return df.select(*[number(missing_to_null(F.col(c).cast("string"))).alias(c) for c in self.numeric], *[missing_to_null(c).alias(c) for c in self.categorical], *[c for c in df.columns if c in self.optional])


def column_differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """(name, side): the columns that only one of two tables has; side is ``left`` or ``right``."""
    rows = [(c, "left") for c in a.columns if c not in b.columns] + [(c, "right") for c in b.columns if c not in a.columns]
    return a.sparkSession.createDataFrame(rows, "name string, side string")


def exact_columns(df: DataFrame, columns: Sequence[str], *, ordered: bool = False) -> None:
    missing, extra = [c for c in columns if c not in df.columns], [c for c in df.columns if c not in columns]
    if missing or extra:
        raise SchemaError(f"missing {missing}, not expected {extra}")
    if ordered and list(columns) != df.columns:
        raise SchemaError("the columns aren't in the agreed order")


def standardize_missing(df: DataFrame, placeholders: Sequence[str] = TEXT_PLACEHOLDERS) -> DataFrame:
    """All text columns stripped, placeholders null, case kept."""
    return df.select(*[missing_to_null(f.name, placeholders).alias(f.name) if isinstance(f.dataType, StringType) else F.col(f.name) for f in df.schema.fields])


def violations(df: DataFrame, keys: Sequence[str], required: Sequence[str], label: str, time: str | None = None) -> DataFrame:
    """One row: n_rows, n_key_repeats, n_null_required, n_bad_label (null or neither 0 nor 1), n_bad_time."""
    v = number(label)
    per_key = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(x).alias(name) for name, x in (("r", _any([F.col(c).isNull() for c in required])), ("l", F.coalesce(~v.isin(0.0, 1.0), F.lit(True))), ("t", moment(F.col(time).cast("string")).isNull() if time else F.lit(False)))],
    )
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return per_key.agg(total("n").alias("n_rows"), total(F.col("n") - 1).alias("n_key_repeats"), total("r").alias("n_null_required"), total("l").alias("n_bad_label"), total("t").alias("n_bad_time"))


def _any(conditions):
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


def check(df: DataFrame, keys: Sequence[str], required: Sequence[str], label: str, time: str | None = None) -> None:
    """SchemaError for an empty table, missing columns, repeated keys, nulls where none may be, or labels other than 0 and 1."""
    if (missing := [c for c in [*keys, *required, label] if c not in df.columns]):
        raise SchemaError(f"columns are missing: {missing}")
    found = violations(df, keys, required, label, time).first().asDict()
    if not found.pop("n_rows"):
        raise SchemaError("the table is empty")
    if any(found.values()):
        raise SchemaError(f"rows break the contract: {found}")
