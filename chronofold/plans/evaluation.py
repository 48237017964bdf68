"""Queries of metrics, thresholds, subgroups, scoring, neighbours and models."""

from __future__ import annotations

import datetime as dt

import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from chronofold.operators import encode, explain, metrics, models, neighbors, relational, sampling, scoring
from chronofold.plans import clinical
from chronofold.functions.exprs import right_closed_bins
from chronofold.plans.registry import Registry
from chronofold.session import materialize, table
from chronofold.sources.writers import upserted

query = Registry()
QUERIES, SQL = query.queries, query.sql

# A score with ties that every engine computes alike: a hash of the key, raised for positives.
PRED = "pred AS (SELECT *, target AS y, (((hadm_id::BIGINT * 7919) % 997) + 300 * target) / 1400.0::DOUBLE AS p, CASE WHEN age IS NULL THEN NULL WHEN age <= 39 THEN '<40' WHEN age <= 59 THEN '40-59' ELSE '60+' END AS age_group FROM master_table_model_ready)"
CELLS = "count(*) FILTER (WHERE y = 1 AND p >= {t}) AS tp, count(*) FILTER (WHERE y = 0 AND p >= {t}) AS fp, count(*) FILTER (WHERE y = 0 AND p < {t}) AS tn, count(*) FILTER (WHERE y = 1 AND p < {t}) AS fn"
RATES = "round((tp + tn) / (tp + fp + tn + fn), 6) AS accuracy, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1"
GROUPS = "g AS (SELECT p, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y = 0) AS neg FROM pred GROUP BY p), c AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS n_pos, sum(neg) OVER () AS n_neg FROM g WINDOW w AS (ORDER BY p DESC))"
THRESHOLDS = [round(i / 100, 2) for i in range(1, 100)]


def pred(s, d):
    df = table(s, d, "master_table_model_ready")
    p = (F.pmod(F.col("hadm_id").cast("long") * 7919, F.lit(997)) + 300 * F.col("target")) / F.lit(1400.0)
    return df.withColumn("y", F.col("target")).withColumn("p", p).withColumn("age_group", right_closed_bins("age", [39, 59], ["<40", "40-59", "60+"]))


def _round(df, *cols):
    return df.withColumns({c: F.round(c, 6) for c in cols})


@query(f"""WITH {PRED}, {GROUPS}, x AS (SELECT {CELLS.format(t=0.5)} FROM pred) SELECT {RATES}, (tp + fp)::BIGINT AS predicted_positives,
round((SELECT sum(neg * (tp - pos / 2)) / (max(n_pos) * max(n_neg)) FROM c), 6) AS roc_auc, round((SELECT sum(pos * (tp / (tp + fp))) / max(n_pos) FROM c), 6) AS pr_auc FROM x""")
def binary_metrics(s, d):
    return _round(metrics.binary_metrics(pred(s, d), "y", "p", 0.5), "accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc")


@query(f"WITH {PRED}, r AS (SELECT y, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2 AS r FROM pred) SELECT round((sum(r) FILTER (WHERE y = 1) - count(*) FILTER (WHERE y = 1) * (count(*) FILTER (WHERE y = 1) + 1) / 2) / (count(*) FILTER (WHERE y = 1) * count(*) FILTER (WHERE y = 0)), 6) AS roc_auc FROM r")
def roc_auc_rank(s, d):
    return _round(metrics.ranking(metrics.score_groups(pred(s, d), "y", "p")).select("roc_auc"), "roc_auc")


@query(f"WITH {PRED}, {GROUPS} SELECT round(sum(pos / n_pos * (tp / (tp + fp))), 6) AS pr_auc FROM c")
def average_precision_step(s, d):
    return _round(metrics.ranking(metrics.score_groups(pred(s, d), "y", "p")).select("pr_auc"), "pr_auc")


@query(f"WITH {PRED} SELECT t.a AS y_true, t.b AS y_pred, count(pred.y) AS n FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) t(a, b) LEFT JOIN pred ON pred.y = t.a AND (pred.p >= 0.5)::INT = t.b GROUP BY ALL")
def confusion_matrix(s, d):
    return metrics.confusion_matrix(pred(s, d).withColumn("l", (F.col("p") >= 0.5).cast("int")), "y", "l")


@query(f"WITH {PRED} SELECT round(avg((p - y) ** 2), 8) AS brier, round(avg(CASE WHEN y = 1 THEN -ln(greatest(1e-15, least(1 - 1e-15, p))) ELSE -ln(1 - greatest(1e-15, least(1 - 1e-15, p))) END), 8) AS log_loss FROM pred")
def brier_logloss(s, d):
    return metrics.probability_losses(pred(s, d), "y", "p").select(F.round("brier", 8).alias("brier"), F.round("log_loss", 8).alias("log_loss"))


_SWEEP = f"{PRED}, t AS (SELECT unnest([{', '.join(f'{t}::DOUBLE' for t in THRESHOLDS)}]) AS threshold), x AS (SELECT threshold, {CELLS.format(t='threshold')} FROM pred, t GROUP BY threshold), m AS (SELECT threshold, {RATES}, (tp + fp)::BIGINT AS predicted_positives FROM x)"


def _sweep(s, d):
    return _round(metrics.threshold_table(pred(s, d), "y", "p", THRESHOLDS), "accuracy", "precision", "recall", "f1").drop("tp", "fp", "tn", "fn")


@query(f"WITH {_SWEEP} SELECT * FROM m")
def threshold_sweep(s, d):
    return _sweep(s, d)


@query(f"""WITH {_SWEEP} SELECT 'f1_recall' AS rule, * FROM (SELECT threshold FROM m ORDER BY f1 DESC, recall DESC, precision DESC, threshold LIMIT 1) UNION ALL
SELECT 'recall_f1', * FROM (SELECT threshold FROM m WHERE precision >= 0.05 OR (SELECT max(precision) FROM m) < 0.05 ORDER BY recall DESC, f1 DESC, precision DESC, threshold LIMIT 1) UNION ALL
SELECT 'f1_precision', * FROM (SELECT threshold FROM m ORDER BY f1 DESC, precision DESC, recall DESC, threshold LIMIT 1)""")
def best_threshold(s, d):
    t = _sweep(s, d)
    pick = lambda rule, order, **kw: metrics.choose(t, order, **kw).select(F.lit(rule).alias("rule"), "threshold")
    return relational.union_all(pick("f1_recall", (*metrics.BY_F1_RECALL, "-threshold")), pick("recall_f1", metrics.BY_RECALL_F1, min_precision=0.05), pick("f1_precision", metrics.BY_F1_PRECISION))


@query(f"WITH {PRED}, {GROUPS} SELECT p AS threshold, tp::BIGINT AS tp, fp::BIGINT AS fp, round(tp / (tp + fp), 6) AS precision, round(tp / n_pos, 6) AS recall, round(fp / n_neg, 6) AS fpr, round(2 * tp / (tp + fp + n_pos), 6) AS f1 FROM c")
def pr_roc_curve(s, d):
    return _round(metrics.curve_points(metrics.score_groups(pred(s, d), "y", "p")), "precision", "recall", "fpr", "f1")


@query(f"WITH {PRED}, {GROUPS} SELECT arg_max(p, (2 * tp / (tp + fp + n_pos), -p)) AS threshold, 'curve' AS rule FROM c")
def best_f1_curve(s, d):
    return s.createDataFrame([(metrics.best_f1_threshold(metrics.score_groups(pred(s, d), "y", "p")), "curve")], "threshold double, rule string")


@query(f"WITH {PRED}, {GROUPS}, top AS (SELECT arg_max(p, (2 * tp / (tp + fp + n_pos), -p)) AS t FROM c) SELECT coalesce((SELECT max(p) FROM c WHERE p < t), t) AS threshold, 'shifted' AS rule FROM top")
def best_f1_curve_shifted(s, d):
    return s.createDataFrame([(metrics.best_f1_threshold(metrics.score_groups(pred(s, d), "y", "p"), shifted=True), "shifted")], "threshold double, rule string")


_DIMS = ("gender", "race", "age_group")
_SUB = "SELECT '{0}' AS group_column, {0}::VARCHAR AS group_value, y, p FROM pred"
_SUBSQL = f"""{PRED}, long AS ({' UNION ALL '.join(_SUB.format(x) for x in _DIMS)}),
x AS (SELECT group_column, group_value, count(*) AS n_samples, {CELLS.format(t=0.5)} FROM long GROUP BY ALL),
g AS (SELECT group_column, group_value, p, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y = 0) AS neg FROM long GROUP BY ALL),
c AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER (PARTITION BY group_column, group_value) AS n_pos, sum(neg) OVER (PARTITION BY group_column, group_value) AS n_neg FROM g WINDOW w AS (PARTITION BY group_column, group_value ORDER BY p DESC)),
r AS (SELECT group_column, group_value, CASE WHEN max(n_pos) > 0 AND max(n_neg) > 0 THEN sum(neg * (tp - pos / 2)) / (max(n_pos) * max(n_neg)) END AS roc_auc, CASE WHEN max(n_pos) > 0 AND max(n_neg) > 0 THEN sum(pos * (tp / (tp + fp))) / max(n_pos) END AS pr_auc FROM c GROUP BY ALL),
sub AS (SELECT x.group_column, x.group_value, n_samples, round((tp + fn) / n_samples, 6) AS positive_rate, round((tp + fp) / n_samples, 6) AS predicted_positive_rate, {RATES}, round(roc_auc, 6) AS roc_auc, round(pr_auc, 6) AS pr_auc, tp, fp, tn, fn FROM x JOIN r ON x.group_column = r.group_column AND x.group_value IS NOT DISTINCT FROM r.group_value)"""
_RATED = ("positive_rate", "predicted_positive_rate", "accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc")


@query(f"WITH {_SUBSQL} SELECT * FROM sub")
def subgroup_metrics_gsets(s, d):
    return _round(metrics.subgroup_metrics(pred(s, d), _DIMS, "y", "p", 0.5), *_RATED)


@query(f"WITH {_SUBSQL}, u AS ({' UNION ALL '.join(f'SELECT group_column, {chr(39)}{m}{chr(39)} AS metric, {m} AS v FROM sub' for m in ('precision', 'recall', 'roc_auc'))}) SELECT group_column, metric, min(v) AS min_value, max(v) AS max_value, round(max(v) - min(v), 5) AS absolute_gap FROM u WHERE v IS NOT NULL GROUP BY ALL")
def disparity_summary(s, d):
    return metrics.disparity(_round(metrics.subgroup_metrics(pred(s, d), _DIMS, "y", "p", 0.5), *_RATED), ["precision", "recall", "roc_auc"]).withColumn("absolute_gap", F.round("absolute_gap", 5))


@query(f"WITH {PRED}, t AS (SELECT unnest([0.3, 0.5, 0.7]::DOUBLE[]) AS threshold) SELECT hadm_id, threshold, (p >= threshold)::INT AS label FROM pred, t")
def cross_thresholds(s, d):
    return relational.with_thresholds(pred(s, d).select("hadm_id", "p"), [0.3, 0.5, 0.7]).select("hadm_id", "threshold", (F.col("p") >= F.col("threshold")).cast("int").alias("label"))


@query(f"""WITH {PRED} SELECT 'true_positive' AS kind, arg_max(hadm_id, (p, hadm_id)) AS hadm_id FROM pred WHERE y = 1 AND p >= 0.5 UNION ALL SELECT 'false_negative', arg_max(hadm_id, (-p, hadm_id)) FROM pred WHERE y = 1 AND p < 0.5
UNION ALL SELECT 'false_positive', arg_max(hadm_id, (p, hadm_id)) FROM pred WHERE y = 0 AND p >= 0.5 UNION ALL SELECT 'highest', arg_max(hadm_id, (p, hadm_id)) FROM pred""")
def case_picks(s, d):
    p, up = pred(s, d), F.col("p") >= 0.5
    best = lambda kind, cond, key: p.where(cond).agg(F.lit(kind).alias("kind"), F.max_by("hadm_id", F.struct(key.alias("k"), "hadm_id")).alias("hadm_id"))
    return relational.union_all(best("true_positive", (F.col("y") == 1) & up, F.col("p")), best("false_negative", (F.col("y") == 1) & ~up, -F.col("p")), best("false_positive", (F.col("y") == 0) & up, F.col("p")), best("highest", F.lit(True), F.col("p")))


_NOW = dt.datetime(2025, 1, 1, tzinfo=dt.timezone.utc)


def _predictions(s, d):
    return scoring.predictions(pred(s, d), "p", 0.6, {"model_version": "1", "pipeline_version": "2", "schema_version": "3"}, _NOW)


@query(f"WITH {PRED} SELECT subject_id, hadm_id, admittime, p AS predicted_probability, 0.6::DOUBLE AS applied_threshold, (p >= 0.6)::INT AS predicted_label, '1' AS model_version, '2' AS pipeline_version, '3' AS schema_version, '2025-01-01T00:00:00+00:00' AS scoring_timestamp FROM pred")
def score_and_label(s, d):
    return _predictions(s, d)


@query(f"""WITH {PRED} SELECT m.hadm_id, CASE (p >= 0.6)::INT WHEN 0 THEN 'Survived' ELSE 'Died' END AS predicted_label_text, CASE m.target WHEN 0 THEN 'Survived' WHEN 1 THEN 'Died' END AS actual_label_text,
CASE WHEN m.age IS NULL THEN NULL WHEN m.age <= 39 THEN '<40' WHEN m.age <= 59 THEN '40-59' ELSE '60+' END AS age_group_dashboard, round(p * 100, 2) AS predicted_probability_pct FROM master_table m JOIN pred USING (hadm_id)""")
def dashboard_join(s, d):
    out = scoring.dashboard(table(s, d, "master_table"), _predictions(s, d), ["hadm_id", "subject_id"])
    return out.select("hadm_id", "predicted_label_text", "actual_label_text", "age_group_dashboard", "predicted_probability_pct")


@query("SELECT m.hadm_id, m.subject_id, m.admittime, m.age FROM master_table m WHERE hadm_id IN (SELECT hadm_id FROM split_assignment WHERE lower(trim(split_name)) = 'deployment')")
def deployment_rows(s, d):
    """The rows of the given keys, each of which must have exactly one."""
    given = table(s, d, "split_assignment").where(F.lower(F.trim("split_name")) == "deployment")
    m = table(s, d, "master_table")
    return scoring.deployment_rows(m, relational.semi(m, given, ["hadm_id"])).select("hadm_id", "subject_id", "admittime", "age")


@query(f"""WITH {PRED} SELECT hadm_id, CASE WHEN year(admittime) >= 2012 THEN 0.9::DOUBLE ELSE p END AS predicted_probability FROM pred""")
def upsert_predictions(s, d):
    old = _predictions(s, d)
    new = old.where(F.year("admittime") >= 2012).withColumn("predicted_probability", F.lit(0.9))
    return upserted(old, new, scoring.KEYS).select("hadm_id", "predicted_probability")


# Neighbours

_V = "e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings)"


@query(f"WITH {_V}, k AS (SELECT a.vec_id AS query_id, b.vec_id AS neighbor_id, list_distance(a.v, b.v) AS dist FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY dist, neighbor_id)::INT AS rank FROM k) SELECT query_id, neighbor_id, rank, round(dist, 6) AS distance FROM r WHERE rank <= 5")
def knn_topk(s, d):
    e = table(s, d, "embeddings")
    return neighbors.knn(e.where("vec_id % 100 = 0"), e, "vec_id", "embedding", 5).withColumn("distance", F.round("distance", 6))


_H = "md5(vec_id::VARCHAR || '|' || copy || '|42')"


@query(f"""WITH {_V}, lm AS (SELECT label FROM e GROUP BY label ORDER BY count(*), label LIMIT 1), m AS (SELECT * FROM e WHERE label = (SELECT label FROM lm)),
k AS (SELECT a.vec_id, b.vec_id AS neighbor_id, row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.v, b.v), b.vec_id) AS rank FROM m a JOIN m b ON a.vec_id <> b.vec_id),
n AS (SELECT vec_id, list(neighbor_id ORDER BY rank) AS near FROM k WHERE rank <= 5 GROUP BY vec_id), q AS (SELECT vec_id, near, unnest([1, 2]) AS copy FROM n),
z AS (SELECT vec_id, copy, near[(('0x' || substr({_H}, 9, 8))::BIGINT % len(near) + 1)::INT] AS neighbor_id, ('0x' || substr({_H}, 1, 8))::BIGINT / 4294967296.0 AS lam FROM q)
SELECT z.vec_id, z.neighbor_id, z.copy::INT AS copy, round(z.lam, 8)::DOUBLE AS lambda, round(list_sum(a.v) + (list_sum(b.v) - list_sum(a.v)) * z.lam, 5) AS checksum FROM z JOIN m a ON a.vec_id = z.vec_id JOIN m b ON b.vec_id = z.neighbor_id""")
def smote_points(s, d):
    e = table(s, d, "embeddings")
    minority = e.groupBy("label").count().orderBy("count", "label").first()["label"]
    out = neighbors.smote(e, "vec_id", "embedding", "label", minority, copies=2)
    return out.select("vec_id", "neighbor_id", "copy", F.round("lambda", 8).alias("lambda"), F.round(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x), 5).alias("checksum"))


@query(f"WITH {_V}, k AS (SELECT a.vec_id AS a, a.label AS la, arg_min(b.vec_id, (list_distance(a.v, b.v), b.vec_id)) AS b FROM e a JOIN e b ON a.vec_id <> b.vec_id GROUP BY ALL) SELECT x.a AS id_a, x.b AS id_b FROM k x JOIN k y ON x.b = y.a AND y.b = x.a WHERE x.a < x.b AND x.la <> y.la")
def tomek_links(s, d):
    return neighbors.tomek_links(table(s, d, "embeddings"), "vec_id", "embedding", "label")


_VECTOR = "list_transform(generate_series(1, len(a.v)), lambda i: a.v[i] + (b.v[i] - a.v[i]) * z.lam)"


@query(f"""WITH {_V}, lm AS (SELECT label FROM e GROUP BY label ORDER BY count(*), label LIMIT 1), m AS (SELECT * FROM e WHERE label = (SELECT label FROM lm)),
k AS (SELECT a.vec_id, b.vec_id AS neighbor_id, row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.v, b.v), b.vec_id) AS rank FROM m a JOIN m b ON a.vec_id <> b.vec_id),
n AS (SELECT vec_id, list(neighbor_id ORDER BY rank) AS near FROM k WHERE rank <= 5 GROUP BY vec_id), q AS (SELECT vec_id, near, unnest([1, 2]) AS copy FROM n),
z AS (SELECT vec_id, copy, near[(('0x' || substr({_H}, 9, 8))::BIGINT % len(near) + 1)::INT] AS neighbor_id, ('0x' || substr({_H}, 1, 8))::BIGINT / 4294967296.0 AS lam FROM q),
u AS (SELECT vec_id::VARCHAR AS id, label, v FROM e UNION ALL SELECT z.vec_id || '#' || copy, a.label, {_VECTOR} FROM z JOIN m a ON a.vec_id = z.vec_id JOIN m b ON b.vec_id = z.neighbor_id),
near AS (SELECT a.id AS a, arg_min(b.id, (list_distance(a.v, b.v), b.id)) AS b FROM u a JOIN u b ON a.id <> b.id GROUP BY a.id), links AS (SELECT x.a FROM near x JOIN near y ON x.b = y.a AND y.b = x.a JOIN u p ON p.id = x.a JOIN u q ON q.id = x.b WHERE p.label <> q.label)
SELECT id, label::INT AS label, round(list_sum(v), 5) AS checksum FROM u WHERE id NOT IN (SELECT a FROM links)""")
def smote_tomek(s, d):
    e = table(s, d, "embeddings")
    minority = e.groupBy("label").count().orderBy("count", "label").first()["label"]
    out = neighbors.smote_tomek(e, "vec_id", "embedding", "label", minority, copies=2)
    return out.select("id", "label", F.round(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x), 5).alias("checksum"))


# Models: no SQL says what they do; their rows are checked by tests. All of them see the 39 numbers and the coded categories.


def _model_data(s, d):
    """Training and held rows with features, and the names of these. Filled and coded by what the training rows say."""
    ready = table(s, d, "master_table_model_ready")
    split = sampling.group_split(ready, "subject_id", {"train": 0.7, "held": 0.3}, label="target")
    schema = clinical.SCHEMA
    train, held = (schema.prepare(clinical.contract.standardize_missing(split.where(F.col("split") == name).drop("split"))) for name in ("train", "held"))
    levels = encode.category_levels(train, {c: encode.LEVELS[c] for c in schema.categorical})
    columns = [*schema.numeric, *[f"{c}_{v}" for c, of in levels.items() for v in of[1:]]]
    f = models.Features.fit(encode.one_hot(train, levels), columns)
    ready_rows = lambda df: materialize(f.apply(encode.align(encode.one_hot(df, levels), ["subject_id", "hadm_id", "admittime", "target", *columns])).select("subject_id", "hadm_id", "admittime", "target", "features"))
    return ready_rows(train), ready_rows(held), f.names


def _rows(s, found):
    """A few rows of the driver as a local relation, which no task has to carry."""
    schema = ", ".join(f"`{k}` {'string' if isinstance(v, (str, dict)) else 'double'}" for k, v in found[0].items())
    rows = [tuple(str(v) if isinstance(v, (str, dict)) else None if v is None else float(v) for v in r.values()) for r in found]
    return s.createDataFrame(pd.DataFrame(rows, columns=list(found[0])), schema)


@query()
def ml_leaderboard(s, d):
    """The full preset on held rows, and its first five ranked anew on the other half of them."""
    train, held, _ = _model_data(s, d)
    half = F.pmod(F.xxhash64("subject_id"), F.lit(2)) == 0
    fitted: dict = {}
    board = models.leaderboard(train, held.where(half), "target", "full", fitted=fitted)
    again = models.rerank(board, fitted, held.where(~half), "target")
    return _rows(s, [{"stage": "validation", **r} for r in board] + [{"stage": "test", **r} for r in again])


@query()
def ml_gbt(s, d):
    train, held, _ = _model_data(s, d)
    return models.positive_score(models.fit(train, "boosted", "target", balanced=True), held).select("hadm_id", "target", "score")


@query()
def ml_mlp(s, d):
    """128-64-32 units, positives in balance, early stopping on a part of the training rows."""
    train, held, _ = _model_data(s, d)
    scaled = encode.scale_vector(train, "features")
    part = F.pmod(F.xxhash64("subject_id"), F.lit(5)) == 0
    model, _ = models.fit_mlp(scaled(train).where(~part), scaled(train).where(part), "target")
    return models.positive_score(model, scaled(held)).select("hadm_id", "target", "score")


@query()
def ml_calibrated(s, d):
    train, held, _ = _model_data(s, d)
    scored = models.positive_score(models.fit(train, "logistic", "target", balanced=True), held)
    cut = F.pmod(F.xxhash64("subject_id"), F.lit(2)) == 0
    out = []
    for method in ("none", "sigmoid", "isotonic"):
        apply = models.calibrate(scored.where(cut), "score", "target", method)
        loss = metrics.probability_losses(apply(scored.where(~cut)), "target", "calibrated").first()
        out.append({"method": method, "brier": loss["brier"], "log_loss": loss["log_loss"]})
    return _rows(s, out)


@query()
def ml_random_search(s, d):
    """Thirty draws of ten dimensions of a forest."""
    train, held, _ = _model_data(s, d)
    return _rows(s, models.random_search(train, held, "forest", "target", models.SEARCH_SPACE, 30))


@query()
def ml_context(s, d):
    """Every held row scored from a context of at most 50,000 training rows, 512 at a time."""
    train, held, _ = _model_data(s, d)
    scaled = encode.scale_vector(train, "features")
    vec = lambda df: scaled(df).withColumn("v", vector_to_array("features"))
    return neighbors.context_scores(vec(train), vec(held), "hadm_id", "v", "target").withColumnRenamed("id", "hadm_id")


@query()
def ml_knn(s, d):
    train, held, _ = _model_data(s, d)
    scaled = encode.scale_vector(train, "features")
    vec = lambda df: scaled(df).select("hadm_id", "target", vector_to_array("features").alias("v"))
    asked, points = vec(held).where("hadm_id % 100 = 0"), materialize(vec(train))
    near = neighbors.knn(asked, points, "hadm_id", "v", 5).join(points.select(F.col("hadm_id").alias("neighbor_id"), "target"), "neighbor_id")
    return near.groupBy(F.col("query_id").alias("hadm_id")).agg(F.avg("target").alias("score"))


@query()
def ml_shap(s, d):
    train, held, names = _model_data(s, d)
    model = models.fit(train, "boosted", "target", balanced=True, maxIter=5, maxDepth=3)
    return explain.explain(model, held, "hadm_id", names)
