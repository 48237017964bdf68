"""One artefact from raw feature rows to probabilities: validator, encoder, aligner, missing values, model, threshold and versions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel, Transformer
from pyspark.sql import DataFrame, SparkSession

from chronofold.operators import encode, models, scoring
from chronofold.operators.contract import ModelSchema
from chronofold.operators.models import Features
from chronofold.sources.readers import columns_of, exists, read_table
from chronofold.sources.writers import read_json, write_json

PIPELINE_VERSION = "1.0"
DEFAULT_THRESHOLD = 0.5


@dataclass
class Scorer:
    """A frozen pipeline. ``schema`` is what it takes, ``levels`` the category levels it was trained on, ``features`` the columns the model sees, in order."""

    schema: ModelSchema
    levels: dict[str, tuple[str, ...]]
    features: Features
    model: Transformer
    threshold: float = DEFAULT_THRESHOLD
    metadata: dict = field(default_factory=dict)

    @classmethod
    def fit(cls, train: DataFrame, schema: ModelSchema, label: str, kind: str = "boosted", *, allowed: dict[str, Sequence[str]] | None = None, threshold: float | None = None, metadata: dict | None = None, balanced: bool = True, **params) -> Scorer:
        """Validate, learn levels, medians and the model from ``train``. The threshold is the given one, else the metadata's ``best_threshold``, else DEFAULT_THRESHOLD."""
        allowed = allowed or encode.LEVELS
        clean = schema.prepare(train)
        levels = {c: tuple(v) for c, v in encode.category_levels(clean, {c: allowed[c] for c in schema.categorical}).items()}
        coded = encode.one_hot(clean, levels)
        columns = [*schema.numeric, *[f"{c}_{v}" for c, of in levels.items() for v in of[1:]]]
        features = Features.fit(coded, columns)
        meta = dict(metadata or {})
        model = models.fit(features.apply(coded), kind, label, balanced=balanced, **params)
        return cls(schema, levels, features, model, threshold if threshold is not None else meta.get("best_threshold", DEFAULT_THRESHOLD), meta)

    def prepare(self, df: DataFrame) -> DataFrame:
        """The optional columns of ``df`` and ``features``: contract checked, categories coded, columns aligned to the trained ones, missing values filled. SchemaError if a column or number isn't as agreed."""
        coded = encode.one_hot(self.schema.prepare(df), self.levels)
        kept = [c for c in coded.columns if c in self.schema.optional]
        return self.features.apply(encode.align(coded, [*kept, *self.features.columns])).select(*kept, "features")

    def score(self, df: DataFrame, out: str = "score") -> DataFrame:
        return models.positive_score(self.model, self.prepare(df), out).drop("features")

    def predict(self, df: DataFrame, now: dt.datetime | None = None) -> DataFrame:
        """Keys, probability, threshold, label, versions and one timestamp. SchemaError if a key is missing or a row has no valid admittime."""
        scoring.check_keys(df, "the model input")
        versions = {"model_version": str(self.metadata.get("model_name", type(self.model).__name__)), "pipeline_version": PIPELINE_VERSION, "schema_version": self.schema.version}
        return scoring.predictions(self.score(df), "score", self.threshold, versions, now)

    def save(self, spark: SparkSession, folder: str) -> dict:
        """The model, and one document with everything else; returns the document."""
        (self.model if isinstance(self.model, PipelineModel) else PipelineModel([self.model])).write().overwrite().save(f"{folder}/model")
        meta = self.metadata | {
            "threshold": self.threshold, "pipeline_version": PIPELINE_VERSION, "schema": self.schema.to_metadata(), "levels": {c: list(v) for c, v in self.levels.items()}, "feature_columns": list(self.features.columns), "fill": self.features.fill,
            "flagged": list(self.features.flagged), "trained_model_feature_count": len(self.features.columns),
        }
        write_json(spark, meta, f"{folder}/metadata.json")
        return meta

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> Scorer:
        if not exists(spark, f"{folder}/metadata.json"):
            raise FileNotFoundError(f"no packaged model in {folder}")
        meta = read_json(spark, f"{folder}/metadata.json")
        features = Features(tuple(meta["feature_columns"]), meta["fill"], tuple(meta["flagged"]))
        return cls(ModelSchema.from_metadata(meta["schema"]), {c: tuple(v) for c, v in meta["levels"].items()}, features, PipelineModel.load(f"{folder}/model"), meta["threshold"], meta)


def model_input(spark: SparkSession, path: str, columns: Sequence[str], rebuild: Callable[[], DataFrame], drop: Sequence[str] = ()) -> DataFrame:
    """The model input at ``path`` if there is one with all ``columns`` (only its footer or header is read to tell), else what ``rebuild`` gives, written to ``path`` (parquet). ValueError if that lacks a column, too. Without ``drop``."""
    if not exists(spark, path) or set(columns) - set(columns_of(spark, path)):
        made = rebuild()
        if (missing := [c for c in columns if c not in made.columns]):
            raise ValueError(f"the rebuilt model input lacks {missing}")
        made.write.mode("overwrite").parquet(path)
    return read_table(spark, path).drop(*drop)
