"""Metrics of scored rows: exact with ties, in aggregates and bounded windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Distinct scores a slice.
SLICE_SCORES = 100_000


def ratio(a: Column, b: Column) -> Column:
    """0 where the divisor is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def rates(tp: Column, fp: Column, tn: Column, fn: Column) -> dict[str, Column]:
    return {
        "accuracy": ratio(tp + tn, tp + fp + tn + fn), "precision": ratio(tp, tp + fp), "recall": ratio(tp, tp + fn),
        "f1": ratio(2 * tp, 2 * tp + fp + fn), "predicted_positives": (tp + fp).cast("long"),
    }


def confusion(y: str, pred: Column) -> dict[str, Column]:
    t = F.col(y) == 1
    return {"tp": F.count_if(t & (pred == 1)), "fp": F.count_if(~t & (pred == 1)), "tn": F.count_if(~t & (pred == 0)), "fn": F.count_if(t & (pred == 0))}


def score_groups(df: DataFrame, y: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """(by, score, pos, neg, tp, fp, n_pos, n_neg): for every distinct score from the highest down, the positives and negatives at and above it.

    Rows are first added up by score. The running sums are local to a slice of the scores' own range, one for every SLICE_SCORES distinct scores, plus
    the sums of the slices above: no task holds all scores. Null scores and labels are left out.
    """
    return running(df.where(F.col(score).isNotNull() & F.col(y).isNotNull()).groupBy(*by, F.col(score).cast("double").alias("score")).agg(F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) != 1).alias("neg")), by)


def running(groups: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """score_groups() of (by, score, pos, neg)."""
    ends = groups.agg(F.struct(F.min("score").alias("lo"), F.max("score").alias("hi"), F.ceil(F.count(F.lit(1)) / F.lit(SLICE_SCORES)).alias("k")).alias("x")).scalar()
    place = (F.col("score") / 2 - ends["lo"] / 2) / F.nullif(ends["hi"] / 2 - ends["lo"] / 2, F.lit(0.0)) * ends["k"]
    cut = groups.withColumn("__slice", F.coalesce(F.floor(place), F.lit(0)))
    keys = [*by, "__slice"]
    sums = cut.groupBy(*keys).agg(F.sum("pos").alias("__p"), F.sum("neg").alias("__n"))
    above = Window.partitionBy(*by).orderBy(F.col("__slice").desc()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    off = sums.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.coalesce(F.sum("__p").over(above), F.lit(0)).alias("__pa"), F.coalesce(F.sum("__n").over(above), F.lit(0)).alias("__na"), F.sum("__p").over(whole).alias("n_pos"), F.sum("__n").over(whole).alias("n_neg"))
    on = F.lit(True)
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    down = Window.partitionBy(*keys).orderBy(F.col("score").desc()).rowsBetween(Window.unboundedPreceding, 0)
    local = cut.withColumns({"__lp": F.sum("pos").over(down), "__ln": F.sum("neg").over(down)})
    return local.join(off, on).select(*by, "score", "pos", "neg", (F.col("__lp") + F.col("__pa")).alias("tp"), (F.col("__ln") + F.col("__na")).alias("fp"), "n_pos", "n_neg")


def ranking(groups: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, roc_auc, pr_auc): Mann-Whitney with half a point for ties, and the step sum of precision over recall. Null where only one class occurs."""
    p, n, both = F.max("n_pos"), F.max("n_neg"), (F.max("n_pos") > 0) & (F.max("n_neg") > 0)
    wins = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2))
    steps = F.sum(F.col("pos") * F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fp")))
    return groups.groupBy(*by).agg(F.when(both, F.try_divide(wins, p * n)).alias("roc_auc"), F.when(both, F.try_divide(steps, p)).alias("pr_auc"))


def curve_points(groups: DataFrame) -> DataFrame:
    """(threshold, tp, fp, precision, recall, fpr, f1) at every distinct score."""
    tp, fp, p, n = (F.col(c) for c in ("tp", "fp", "n_pos", "n_neg"))
    return groups.select(F.col("score").alias("threshold"), "tp", "fp", ratio(tp, tp + fp).alias("precision"), ratio(tp, p).alias("recall"), ratio(fp, n).alias("fpr"), ratio(2 * tp, tp + fp + p).alias("f1"))


def best_f1_threshold(groups: DataFrame, *, shifted: bool = False) -> float:
    """The score with the greatest F1 (the lowest of equals); 0.5 without any. ``shifted`` takes each score's F1 from the next higher score, as code that aligns a curve's points one off does."""
    points = curve_points(groups)
    if shifted:
        top = points.orderBy(F.col("f1").desc(), "threshold").select("threshold").first()
        below = points.where(F.col("threshold") < F.lit(top[0])).agg(F.max("threshold")).first() if top else None
        return (below[0] if below[0] is not None else top[0]) if top else 0.5
    row = points.agg(F.max_by("threshold", F.struct("f1", -F.col("threshold")))).first()
    return row[0] if row[0] is not None else 0.5


def probability_losses(df: DataFrame, y: str, score: str, eps: float = 1e-15) -> DataFrame:
    """One row: brier, log_loss (probabilities kept ``eps`` from 0 and 1)."""
    p = F.greatest(F.lit(eps), F.least(F.lit(1 - eps), F.col(score)))
    return df.where(F.col(y).isNotNull() & F.col(score).isNotNull()).agg(F.avg(F.pow(F.col(score) - F.col(y), F.lit(2.0))).alias("brier"), F.avg(F.when(F.col(y) == 1, -F.log(p)).otherwise(-F.log(1 - p))).alias("log_loss"))


def threshold_table(df: DataFrame, y: str, score: str, thresholds: Sequence[float]) -> DataFrame:
    """(threshold, tp, fp, tn, fn, accuracy, precision, recall, f1, predicted_positives) of each threshold.

    One pass: rows are added up by how many thresholds they reach, at most one more sums than thresholds; those are then accumulated.
    """
    marks = sorted(float(t) for t in thresholds)
    at = F.array(*[F.lit(t) for t in marks])
    reached = df.where(F.col(y).isNotNull() & F.col(score).isNotNull()).groupBy(F.size(F.filter(at, lambda t: t <= F.col(score))).alias("k")).agg(F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) != 1).alias("neg"))
    each = reached.select(F.explode(F.sequence(F.lit(1), F.lit(len(marks)))).alias("i"), "k", "pos", "neg")
    up = F.col("k") >= F.col("i")
    sums = each.groupBy("i").agg(F.sum(F.when(up, F.col("pos")).otherwise(0)).alias("tp"), F.sum(F.when(up, F.col("neg")).otherwise(0)).alias("fp"), F.sum(F.when(~up, F.col("neg")).otherwise(0)).alias("tn"), F.sum(F.when(~up, F.col("pos")).otherwise(0)).alias("fn"))
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    return sums.select(F.element_at(at, F.col("i")).alias("threshold"), "tp", "fp", "tn", "fn", *[v.alias(k) for k, v in rates(tp, fp, tn, fn).items()])


# Orders by which a threshold or a model is chosen.
BY_F1_RECALL = ("f1", "recall", "precision")
BY_RECALL_F1 = ("recall", "f1", "precision", "-threshold")
BY_F1_PRECISION = ("f1", "precision", "recall", "-threshold")


def choose(table: DataFrame, order: Sequence[str], *, min_precision: float | None = None, n: int = 1) -> DataFrame:
    """The first ``n`` rows by ``order`` (greatest first; with ``-`` the least). ``min_precision`` doesn't count if no row reaches it."""
    if min_precision is not None:
        passed = table.agg(F.count_if(F.col("precision") >= min_precision)).scalar()
        table = table.where((F.col("precision") >= min_precision) | (passed == 0))
    return table.orderBy(*[F.col(c[1:]).asc_nulls_last() if c[0] == "-" else F.col(c).desc_nulls_last() for c in order]).limit(n)


def confusion_matrix(df: DataFrame, y: str, pred: str) -> DataFrame:
    """(y_true, y_pred, n): all four cells, 0 included."""
    cells = df.agg(*[c.alias(k) for k, c in confusion(y, F.col(pred)).items()])
    rows = F.array(*[F.struct(F.lit(a).alias("y_true"), F.lit(b).alias("y_pred"), F.col(k).alias("n")) for a, b, k in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))])
    return cells.select(F.explode(rows).alias("r")).select("r.*")


def binary_metrics(df: DataFrame, y: str, score: str, threshold: float) -> DataFrame:
    """One row: accuracy, precision, recall, f1, predicted_positives, roc_auc, pr_auc."""
    pred = (F.col(score) >= threshold).cast("int")
    counts = df.agg(*[c.alias(k) for k, c in confusion(y, pred).items()])
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    rank = ranking(score_groups(df, y, score))
    return counts.select(*[v.alias(k) for k, v in rates(tp, fp, tn, fn).items()]).withColumns({c: rank.select(c).scalar() for c in ("roc_auc", "pr_auc")})


def subgroup_metrics(df: DataFrame, dims: Sequence[str], y: str, score: str, threshold: float) -> DataFrame:
    """A row per dimension and value, null included: n_samples, rates, metrics, roc_auc, pr_auc and the confusion counts.

    The counts of all dimensions come from one grouping-sets aggregate; the ranking metrics from rows added up by value and score.
    """
    texts = df.select(*[F.col(d).cast("string").alias(d) for d in dims], F.col(y).alias("__y"), F.col(score).alias("__s"))
    cells = {k: c for k, c in confusion("__y", (F.col("__s") >= threshold).cast("int")).items()}
    sets = texts.groupingSets([[d] for d in dims], *dims).agg(F.grouping_id().alias("__id"), F.count(F.lit(1)).alias("n_samples"), *[c.alias(k) for k, c in cells.items()])
    full = (1 << len(dims)) - 1
    which, value = None, None
    for i, d in enumerate(dims):
        hit = F.col("__id") == full - (1 << (len(dims) - 1 - i))
        which = F.when(hit, d) if which is None else which.when(hit, d)
        value = F.when(hit, F.col(d)) if value is None else value.when(hit, F.col(d))
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    named = sets.select(which.alias("group_column"), value.alias("group_value"), "n_samples", ratio(tp + fn, F.col("n_samples")).alias("positive_rate"), ratio(tp + fp, F.col("n_samples")).alias("predicted_positive_rate"), *[v.alias(k) for k, v in rates(tp, fp, tn, fn).items() if k != "predicted_positives"], "tp", "fp", "tn", "fn")
    long = texts.groupBy(*dims, "__y", "__s").agg(F.count(F.lit(1)).alias("__n")).select(F.explode(F.array(*[F.struct(F.lit(d).alias("group_column"), F.col(d).alias("group_value")) for d in dims])).alias("g"), "__y", "__s", "__n")
    summed = long.groupBy("g.group_column", "g.group_value", F.col("__s").alias("score")).agg(F.sum(F.when(F.col("__y") == 1, F.col("__n")).otherwise(0)).alias("pos"), F.sum(F.when(F.col("__y") != 1, F.col("__n")).otherwise(0)).alias("neg"))
    rank = ranking(running(summed, ["group_column", "group_value"]), ["group_column", "group_value"]).select(F.col("group_column").alias("__c"), F.col("group_value").alias("__v"), "roc_auc", "pr_auc")
    return named.join(rank, (F.col("group_column") == F.col("__c")) & F.col("group_value").eqNullSafe(F.col("__v")), "left").drop("__c", "__v")


def disparity(groups: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """(group_column, metric, min_value, max_value, absolute_gap) over the values of a dimension; a metric that is null for all is left out."""
    long = groups.select("group_column", F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("v")) for m in metrics])).alias("x")).select("group_column", "x.metric", "x.v").where(F.col("v").isNotNull())
    return long.groupBy("group_column", "metric").agg(F.min("v").alias("min_value"), F.max("v").alias("max_value"), (F.max("v") - F.min("v")).alias("absolute_gap"))
