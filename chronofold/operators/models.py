"""Training on MLlib: a small zoo, class weights, calibration, random search, artefacts."""

from __future__ import annotations

import time
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml import classification as C
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronofold.operators import metrics
from chronofold.operators.profile import class_ratio, medians
from chronofold.operators.sampling import grid_sample
from chronofold.sources.readers import exists
from chronofold.sources.writers import read_json, write_json

KINDS = {
    "logistic": (C.LogisticRegression, {"maxIter": 30, "regParam": 0.01}),
    "tree": (C.DecisionTreeClassifier, {"maxDepth": 5, "seed": 42}),
    "forest": (C.RandomForestClassifier, {"numTrees": 40, "maxDepth": 6, "seed": 42}),
    "boosted": (C.GBTClassifier, {"maxIter": 20, "maxDepth": 4, "stepSize": 0.1, "seed": 42}),
    "mlp": (C.MultilayerPerceptronClassifier, {"maxIter": 40, "seed": 42}),
}


#: Units of the hidden layers of a multilayer perceptron.
HIDDEN = (128, 64, 32)
# What a preset tries, and how many seconds it may begin new models.
PRESETS = {"core": (("logistic", "tree", "forest"), 1800), "full": (("logistic", "tree", "forest", "boosted", "mlp"), 3600)}
#: Ten dimensions of a forest, drawn from by random_search().
SEARCH_SPACE = {
    "numTrees": (10, 20, 40), "maxDepth": (3, 5, 7), "minInstancesPerNode": (1, 10, 50), "minInfoGain": (0.0, 0.001, 0.01), "subsamplingRate": (0.6, 0.8, 1.0), "featureSubsetStrategy": ("sqrt", "log2", "onethird"), "maxBins": (16, 32, 64),
    "impurity": ("gini", "entropy"), "minWeightFractionPerNode": (0.0, 0.001), "bootstrap": (True, False),
}


@dataclass
class Features:
    """Numeric columns with training medians in place of missing values, and a flag for each column (``flagged``) that had any in training."""

    columns: tuple[str, ...]
    fill: dict[str, float] = field(default_factory=dict)
    flagged: tuple[str, ...] = ()

    @classmethod
    def fit(cls, df: DataFrame, columns: Sequence[str]) -> Features:
        row = medians(df, columns).first()
        value = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in columns}
        gone = df.agg(*[F.count_if(value[c].isNull()).alias(c) for c in columns]).first()
        return cls(tuple(columns), {c: float(row[c]) if row[c] is not None else 0.0 for c in columns}, tuple(c for c in columns if gone[c]))

    @property
    def names(self) -> list[str]:
        """What the places of the vector hold."""
        return [*self.columns, *[f"{c}_missing" for c in self.flagged]]

    def apply(self, df: DataFrame) -> DataFrame:
        v = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in self.columns}
        cells = [*[F.coalesce(v[c], F.lit(self.fill[c])) for c in self.columns], *[v[c].isNull().cast("double") for c in self.flagged]]
        return df.withColumn("features", array_to_vector(F.array(*cells)))


def fit(df: DataFrame, kind: str, label: str, *, balanced: bool = False, **params) -> Transformer:
    """A model of one of KINDS on column ``features``; ``balanced`` weighs positives by the class ratio (the mlp takes no weights: it sees each positive as often as the ratio says, rounded)."""
    make, defaults = KINDS[kind]
    est = make(featuresCol="features", labelCol="__y", **(defaults | params))
    data = df.withColumn("__y", F.col(label).cast("double"))
    if balanced:
        ratio = float(class_ratio(df, label))
        if kind == "mlp":
            data = repeated(data, "__y", ratio)
        else:
            data = data.withColumn("__w", F.when(F.col("__y") == 1, F.lit(ratio)).otherwise(1.0))
            est = est.setWeightCol("__w")
    if kind == "mlp" and "layers" not in params:
        est = est.setLayers([_width(df), *HIDDEN, 2])
    return without_summary(est.fit(data))


def without_summary(model: Transformer) -> Transformer:
    """The model without its training summary, which holds the training rows' plan and the session: neither belongs in the tasks that score, and a session that observes queries can't be sent to them."""
    if getattr(model, "hasSummary", False):
        model._java_obj.setSummary(model._java_obj.getClass().getClassLoader().loadClass("scala.None$").getField("MODULE$").get(None))
    return model


def repeated(df: DataFrame, label: str, times: float) -> DataFrame:
    """Rows with label 1 as often as ``times`` says, rounded, at least once."""
    return df.withColumn("__i", F.explode(F.when(F.col(label) == 1, F.sequence(F.lit(1), F.lit(max(1, round(times))))).otherwise(F.array(F.lit(1))))).drop("__i")


def _width(df: DataFrame) -> int:
    return len(df.select("features").first()[0])


def fit_mlp(train: DataFrame, held: DataFrame, label: str, *, hidden: Sequence[int] = HIDDEN, epochs: int = 25, steps: int = 4, patience: int = 5, delta: float = 1e-4, balanced: bool = True, seed: int = 42) -> tuple[Transformer, list[float]]:
    """A multilayer perceptron with early stopping, and its losses on ``held``: every epoch continues from the last one's weights for ``steps`` iterations, until the log loss hasn't
    fallen by ``delta`` for ``patience`` epochs; the model of the best epoch is returned. ``balanced`` as in fit()."""
    data = train.withColumn("__y", F.col(label).cast("double"))
    if balanced:
        data = repeated(data, "__y", float(class_ratio(train, label)))
    data = data.select("features", "__y").cache()
    best, losses, weights, stale = None, [], None, 0
    try:
        for _ in range(epochs):
            est = C.MultilayerPerceptronClassifier(featuresCol="features", labelCol="__y", layers=[_width(train), *hidden, 2], maxIter=steps, seed=seed, tol=1e-9)
            model = (est.setInitialWeights(weights) if weights is not None else est).fit(data)
            without_summary(model)
            weights = model.weights
            losses.append(metrics.probability_losses(positive_score(model, held), label, "score").first()["log_loss"])
            if best is None or losses[-1] < best[0] - delta:
                best, stale = (losses[-1], model), 0
            else:
                stale += 1
            if stale >= patience:
                break
    finally:
        data.unpersist()
    return best[1], losses


def positive_score(model: Transformer, df: DataFrame, out: str = "score") -> DataFrame:
    """``df`` with the probability of the positive class, or the hard label of a model that gives none."""
    scored = model.transform(df)
    value = vector_to_array("probability")[1] if "probability" in scored.columns else F.col("prediction")
    return scored.withColumn(out, value).drop("rawPrediction", "probability", "prediction")


def calibrate(scored: DataFrame, score: str, label: str, method: str):
    """A function that adds ``calibrated`` to scored rows: none, sigmoid (a logistic curve over the score) or isotonic."""
    if method == "none":
        return lambda df: df.withColumn("calibrated", F.col(score))
    data = scored.withColumn("__x", array_to_vector(F.array(F.col(score)))).withColumn("__y", F.col(label).cast("double"))
    if method == "sigmoid":
        model = C.LogisticRegression(featuresCol="__x", labelCol="__y", maxIter=100).fit(data)
        a, b = float(model.coefficients[0]), float(model.intercept)
        return lambda df: df.withColumn("calibrated", 1 / (1 + F.exp(-(F.col(score) * a + b))))
    if method == "isotonic":
        model = IsotonicRegression(featuresCol="__x", labelCol="__y", predictionCol="calibrated").fit(data)
        return lambda df: model.transform(df.withColumn("__x", array_to_vector(F.array(F.col(score))))).drop("__x")
    raise ValueError(f"no calibration {method}")


def rank_metrics(df: DataFrame, label: str, score: str) -> dict[str, float]:
    r = metrics.ranking(metrics.score_groups(df, label, score)).first()
    return {"roc_auc": r["roc_auc"], "pr_auc": r["pr_auc"]} if r else {"roc_auc": None, "pr_auc": None}


def random_search(train: DataFrame, held: DataFrame, kind: str, label: str, grid: dict[str, Sequence], draws: int, *, seed: int = 42, parallel: int = 2) -> list[dict]:
    """The drawn parameters with their metrics on ``held``, best first by (pr_auc, roc_auc). Fits run ``parallel`` at a time on cached tables."""
    train, held = train.cache(), held.cache()
    try:
        def one(params: dict) -> dict:
            return {"params": params, **rank_metrics(positive_score(fit(train, kind, label, balanced=True, **params), held), label, "score")}

        with ThreadPoolExecutor(parallel) as pool:
            found = list(pool.map(one, grid_sample(grid, draws, seed)))
    finally:
        train.unpersist(), held.unpersist()
    return sorted(found, key=lambda r: (-(r["pr_auc"] or 0), -(r["roc_auc"] or 0), str(r["params"])))


def leaderboard(train: DataFrame, held: DataFrame, label: str, preset: str = "full", *, kinds: Sequence[str] | None = None, seconds: float | None = None, fitted: dict[str, Transformer] | None = None) -> list[dict]:
    """Every kind of a preset (or of ``kinds``), plain and balanced, ranked by (pr_auc, recall, f1) on ``held``. No further model is begun once ``seconds`` (else the preset's) are over. ``fitted`` gets the models by name."""
    of, limit = PRESETS[preset]
    began, out = time.monotonic(), []
    for kind in kinds or of:
        for balanced in (False, True):
            if out and time.monotonic() - began > (limit if seconds is None else seconds):
                break
            model, name = fit(train, kind, label, balanced=balanced), kind + ("_balanced" if balanced else "")
            if fitted is not None:
                fitted[name] = model
            out.append({"model": name, **metrics.binary_metrics(positive_score(model, held), label, "score", 0.5).first().asDict()})
    return _ranked(out)


def _ranked(found: list[dict]) -> list[dict]:
    return sorted(found, key=lambda r: (-(r["pr_auc"] or 0), -r["recall"], -r["f1"], r["model"]))


def rerank(board: list[dict], fitted: dict[str, Transformer], test: DataFrame, label: str, n: int = 5) -> list[dict]:
    """The first ``n`` of a leaderboard, ranked anew by the same measures on ``test``."""
    return _ranked([{"model": r["model"], **metrics.binary_metrics(positive_score(fitted[r["model"]], test), label, "score", 0.5).first().asDict()} for r in board[:n]])


def pipeline(columns: Sequence[str], model: Transformer) -> PipelineModel:
    return PipelineModel([VectorAssembler(inputCols=list(columns), outputCol="features", handleInvalid="keep"), model])


def save_packaged(model: Transformer, folder: str, spark: SparkSession, metadata: dict, *, threshold: float | None = None) -> dict:
    """The model and its metadata; the threshold is the given one, else the metadata's, else 0.5."""
    meta = dict(metadata)
    meta["threshold"] = threshold if threshold is not None else meta.get("threshold", 0.5)
    (model if isinstance(model, PipelineModel) else PipelineModel([model])).write().overwrite().save(f"{folder}/model")
    write_json(spark, meta, f"{folder}/metadata.json")
    return meta


def load_packaged(spark: SparkSession, folder: str) -> tuple[PipelineModel, dict]:
    if not exists(spark, f"{folder}/metadata.json"):
        raise FileNotFoundError(f"no packaged model in {folder}")
    return PipelineModel.load(f"{folder}/model"), read_json(spark, f"{folder}/metadata.json")


def summarize(model: PipelineModel, meta: dict) -> dict:
    """Class, threshold (selected_threshold, else threshold, else 0.5), calibration and number of features of an artefact."""
    return {"model_class": type(model.stages[-1]).__name__, "threshold": meta.get("selected_threshold", meta.get("threshold", 0.5)), "calibration": meta.get("calibration_method", "none"), "n_features": len(meta.get("feature_columns", []))}


__all__ = ["Features", "KINDS", "Pipeline", "calibrate", "fit", "leaderboard", "load_packaged", "fit_mlp", "pipeline", "positive_score", "random_search", "rank_metrics", "repeated", "rerank", "save_packaged", "summarize"]
