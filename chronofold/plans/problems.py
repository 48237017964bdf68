"""Queries p1-p5 and p7 over the clinical tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronofold.operators import asof, eager, entity_features, fill, intervals, orphans
from chronofold.session import materialize, table

#: Usable ends of the readings.
RANGES = {"bmi_last": (10.0, 100.0), "last_systolic": (40.0, 300.0)}


#: Time lines of more than a few rows are cut in the queries named _sharded, so that they must agree with the same SQL as the others.
SMALL = {"floor": 4}


def _filled(spark: SparkSession, d: str, categories: dict[str, float] | None = None, **sharding: int) -> DataFrame:
    return fill.fill_along_time(table(spark, d, "master_table_model_ready"), "subject_id", "admittime", "hadm_id", RANGES, categories, **sharding)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return fill.filled_cases(_filled(spark, d), list(RANGES), "hadm_id")


def p1_filled(spark: SparkSession, d: str, **sharding: int) -> DataFrame:
    filled = _filled(spark, d, {"marital_status": 365.0}, **sharding)
    return filled.select(
        "hadm_id",
        *[x for c in RANGES for x in (F.round(f"{c}_filled", 8).alias(f"{c}_filled"), F.col(f"{c}_method"), F.round(f"{c}_days", 8).alias(f"{c}_days"))],
        "marital_status_filled", "marital_status_method", F.round("marital_status_days", 8).alias("marital_status_days"),
    )


def p1_filled_sharded(spark: SparkSession, d: str) -> DataFrame:
    return p1_filled(spark, d, **SMALL)


def _known(spark: SparkSession, d: str, **sharding: int) -> DataFrame:
    return asof.known_at_admission(table(spark, d, "master_table"), table(spark, d, "admissions"), table(spark, d, "drgcodes"), **sharding)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return asof.mismatches(_known(spark, d), {"num_prev_visits": "known_num_prev_visits", "avg_prev_drg_mortality": "known_avg_prev_drg_mortality"}, "hadm_id")


def p2_known(spark: SparkSession, d: str, **sharding: int) -> DataFrame:
    return _known(spark, d, **sharding).select("hadm_id", F.col("known_num_prev_visits").alias("num_prev_visits"), F.round("known_avg_prev_drg_mortality", 6).alias("avg_prev_drg_mortality"))


def p2_known_sharded(spark: SparkSession, d: str) -> DataFrame:
    return p2_known(spark, d, **SMALL)


def _subject_labs(spark: SparkSession, d: str) -> DataFrame:
    people = table(spark, d, "patients").groupBy("subject_id").agg(F.min("anchor_age").alias("anchor_age"))
    aggs = {"n_labs": ("count", "left", None), "n_values": ("count", "left", "valuenum"), "sum_value": ("sum", "left", "valuenum"), "avg_value": ("avg", "left", "valuenum"), "min_value": ("min", "left", "valuenum"), "max_value": ("max", "left", "valuenum"), "anchor_age": ("min", "right", "anchor_age")}
    return eager.eager_join_aggregate(table(spark, d, "labevents"), people, ["subject_id"], ["subject_id"], aggs, "left")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    labs = eager.eager_join_aggregate(table(spark, d, "labevents"), table(spark, d, "patients").select("subject_id").distinct(), ["subject_id"], ["subject_id"], {"n_labs": ("count", "left", "subject_id")}, "left")
    return eager.with_share(labs, "n_labs", "share").where(F.col("share") >= 0.02).select("subject_id")


def p3_subject_labs(spark: SparkSession, d: str) -> DataFrame:
    labs = _subject_labs(spark, d)
    return labs.select("subject_id", "n_labs", "n_values", *[F.round(c, 8).alias(c) for c in ("sum_value", "avg_value", "min_value", "max_value")], "anchor_age")


def p3_labs_by_admission_type(spark: SparkSession, d: str) -> DataFrame:
    stays = table(spark, d, "admissions").groupBy("hadm_id").agg(F.min("subject_id").alias("subject_id"), F.min(F.lower(F.trim("admission_type"))).alias("admission_type"))
    aggs = {"n_pairs": ("count", "left", None), "n_values": ("count", "left", "valuenum"), "avg_value": ("avg", "left", "valuenum"), "max_value": ("max", "left", "valuenum")}
    out = eager.eager_join_aggregate(table(spark, d, "labevents"), stays, ["subject_id"], ["admission_type"], aggs)
    return out.select("admission_type", "n_pairs", "n_values", F.round("avg_value", 6).alias("avg_value"), "max_value")


def _orphans(spark: SparkSession, d: str) -> DataFrame:
    refs = [
        orphans.Reference("diagnoses", table(spark, d, "diagnoses"), "hadm_id", "admissions", table(spark, d, "admissions"), "hadm_id"),
        orphans.Reference("transfers", table(spark, d, "transfers"), "subject_id", "patients", table(spark, d, "patients"), "subject_id"),
    ]
    return orphans.orphan_references(refs, table(spark, d, "removed_keys"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return _orphans(spark, d).select("table_name", "key_id", "load_month", "reason")


def p4_report(spark: SparkSession, d: str) -> DataFrame:
    return orphans.orphan_report(_orphans(spark, d))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    known = entity_features.prior_diagnoses(table(spark, d, "master_table"), table(spark, d, "admissions"), table(spark, d, "diagnoses"))
    return asof.mismatches(known, {"num_prev_diagnoses": "known_num_prev_diagnoses"}, "hadm_id", tolerance=0.0).select("hadm_id")


def _stay_counts(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The figures of every stay and type, and the stays with the midnight after their last event, from which they look back."""
    events = entity_features.clinical_events(table(spark, d, "labevents"), table(spark, d, "drgcodes"), table(spark, d, "diagnoses"))
    store = materialize(entity_features.cumulative_store(events, "hadm_id", "type", "at", "value"))  # read for the last times and for the windows
    last = store.groupBy("hadm_id").agg((F.date_trunc("day", F.max("last_time")).cast("timestamp_ntz") + F.expr("interval 1 day")).alias("as_of"))
    stays = entity_features.stays_of(table(spark, d, "admissions")).select("hadm_id").join(last, "hadm_id", "left")
    return entity_features.window_counts(store, stays, "hadm_id", "as_of", [7, 30]), stays


def p5_stay_features(spark: SparkSession, d: str) -> DataFrame:
    counts, stays = _stay_counts(spark, d)
    return entity_features.as_maps(counts, stays, "hadm_id")


def p5_stay_types(spark: SparkSession, d: str) -> DataFrame:
    return _stay_counts(spark, d)[0]


#: Types shown as columns; any other type can be shown in the same way.
WIDE_TYPES = ["lab_abnormal_routine", "lab_abnormal_stat", "lab_normal_routine", "lab_normal_stat", "drg_severity_1", "drg_severity_4"]


def p5_stay_totals(spark: SparkSession, d: str) -> DataFrame:
    counts, stays = _stay_counts(spark, d)
    out = entity_features.as_columns(counts, stays, "hadm_id", WIDE_TYPES)
    return out.select("hadm_id", *[F.round(c, 8).alias(c) if c.endswith(("__total", "days")) else F.col(c) for c in out.columns if "__" in c])


def _periods(spark: SparkSession, d: str, **sharding: int) -> DataFrame:
    return intervals.sweep_periods(intervals.stay_intervals(table(spark, d, "admissions")), "subject_id", "start", "end", "hadm_id", **sharding)


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    case = lambda kind, a, b: F.struct(F.lit(kind).alias("kind"), text(a).alias("from_ts"), text(b).alias("to_ts"))
    joint = F.when(F.col("first_member") != F.col("last_member"), case("period", "period_start", "period_end"))
    gap = F.when(F.col("gap_end").isNotNull(), case("gap", "period_end", "gap_end"))
    return _periods(spark, d).select("subject_id", F.explode(F.array_compact(F.array(joint, gap))).alias("x")).select("subject_id", "x.*")


def p7_periods(spark: SparkSession, d: str, **sharding: int) -> DataFrame:
    return _periods(spark, d, **sharding).select("subject_id", F.col("period_no").cast("long").alias("period_no"), "period_start", "period_end")


def p7_periods_sharded(spark: SparkSession, d: str) -> DataFrame:
    return p7_periods(spark, d, **SMALL)


QUERIES = {f.__name__: f for f in (p1_found, p1_filled, p1_filled_sharded, p2_found, p2_known, p2_known_sharded, p3_found, p3_subject_labs, p3_labs_by_admission_type, p4_found, p4_report, p5_found, p5_stay_features, p5_stay_types, p5_stay_totals, p7_found, p7_periods, p7_periods_sharded)}

_P2 = """
stays AS (SELECT hadm_id, min(subject_id) AS subject_id, min(admittime) AS admittime FROM admissions GROUP BY hadm_id),
codings AS (SELECT subject_id, hadm_id, drg_severity, drg_mortality, min(loaded_at) AS loaded_at FROM drgcodes GROUP BY ALL),
visits AS (SELECT m.hadm_id, count(s.hadm_id) AS n, count(s.hadm_id) FILTER (WHERE s.admittime < m.admittime) AS strictly
           FROM master_table m LEFT JOIN stays s ON s.subject_id = m.subject_id AND (s.admittime, s.hadm_id) < (m.admittime, m.hadm_id) GROUP BY m.hadm_id),
mort AS (SELECT m.hadm_id, avg(c.drg_mortality) AS a FROM master_table m LEFT JOIN codings c ON c.subject_id = m.subject_id AND c.loaded_at < m.admittime GROUP BY m.hadm_id),
known AS (SELECT v.hadm_id, v.n AS num_prev_visits, CASE WHEN v.strictly = 0 THEN 0.0 ELSE mort.a END AS avg_prev_drg_mortality FROM visits v JOIN mort USING (hadm_id))
"""

_P4 = """
refs AS (SELECT 'diagnoses' AS table_name, 'admissions' AS parent, hadm_id AS key_id, loaded_at FROM diagnoses WHERE hadm_id IS NOT NULL
         UNION ALL SELECT 'transfers', 'patients', subject_id, loaded_at FROM transfers),
parents AS (SELECT 'admissions' AS parent, hadm_id AS key_id, min(loaded_at) AS first FROM admissions GROUP BY 2 UNION ALL SELECT 'patients', subject_id, min(loaded_at) FROM patients GROUP BY 2),
cases AS (SELECT table_name, key_id, strftime(loaded_at, '%Y-%m') AS load_month,
                 CASE WHEN p.first IS NOT NULL THEN 'late' WHEN EXISTS (SELECT 1 FROM removed_keys k WHERE k.parent_table = r.parent AND k.key_id = r.key_id) THEN 'deleted' ELSE 'missing' END AS reason
          FROM refs r LEFT JOIN parents p USING (parent, key_id) WHERE p.first IS NULL OR p.first > r.loaded_at)
"""

_P7 = """
spans AS (SELECT subject_id, hadm_id, admittime AS a, dischtime AS b FROM admissions WHERE dischtime > admittime
          UNION ALL SELECT subject_id, hadm_id, edregtime, edouttime FROM admissions WHERE edouttime > edregtime),
marked AS (SELECT *, CASE WHEN a <= max(b) OVER (PARTITION BY subject_id ORDER BY a, b, hadm_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS begins FROM spans),
numbered AS (SELECT *, sum(begins) OVER (PARTITION BY subject_id ORDER BY a, b, hadm_id ROWS UNBOUNDED PRECEDING) AS period_no FROM marked),
periods AS (SELECT subject_id, period_no, min(a) AS period_start, max(b) AS period_end, count(DISTINCT hadm_id) AS stays FROM numbered GROUP BY ALL)
"""

_LABS = "labs AS (SELECT * REPLACE (CASE WHEN isnan(valuenum) THEN NULL ELSE valuenum END AS valuenum) FROM labevents)"


def _p1_sql() -> str:
    usable = {c: f"CASE WHEN NOT isnan({c}::DOUBLE) AND {c} BETWEEN {lo} AND {hi} THEN {c}::DOUBLE END" for c, (lo, hi) in RANGES.items()}
    parts, cols = [], []
    for c, i in (("bmi_last", 0), ("last_systolic", 1)):
        parts.append(f"""s{i} AS (SELECT hadm_id, subject_id, admittime AS t, {usable[c]} AS v FROM master_table_model_ready),
n{i} AS (SELECT *, last_value(CASE WHEN v IS NOT NULL THEN t END IGNORE NULLS) OVER p AS pt, last_value(v IGNORE NULLS) OVER p AS pv,
   first_value(CASE WHEN v IS NOT NULL THEN t END IGNORE NULLS) OVER f AS nt, first_value(v IGNORE NULLS) OVER f AS nv FROM s{i}
   WINDOW p AS (PARTITION BY subject_id ORDER BY t, hadm_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), f AS (PARTITION BY subject_id ORDER BY t, hadm_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
m{i} AS (SELECT year(t) * 12 + month(t) AS mo, avg(v) AS mv FROM s{i} GROUP BY 1),
k{i} AS (SELECT a.mo, arg_min(b.mv, (abs(a.mo - b.mo), b.mo)) AS mv, min(abs(a.mo - b.mo)) AS dist FROM m{i} a, m{i} b WHERE b.mv IS NOT NULL GROUP BY a.mo),
r{i} AS (SELECT hadm_id, CASE WHEN v IS NOT NULL THEN v WHEN pv IS NOT NULL AND nv IS NOT NULL THEN CASE WHEN pt = nt THEN (pv + nv) / 2 ELSE pv + (nv - pv) * (epoch(t - pt) / epoch(nt - pt)) END
     WHEN pv IS NOT NULL THEN pv WHEN nv IS NOT NULL THEN nv ELSE k.mv END AS filled,
   CASE WHEN v IS NOT NULL THEN 'observed' WHEN pv IS NOT NULL AND nv IS NOT NULL THEN 'interpolated' WHEN pv IS NOT NULL OR nv IS NOT NULL THEN 'carried' WHEN k.dist = 0 THEN 'same_time' ELSE 'near_time' END AS how,
   CASE WHEN v IS NOT NULL THEN 0.0 ELSE least(epoch(t - pt), epoch(nt - t)) / 86400.0 END AS days
   FROM n{i} LEFT JOIN k{i} k ON k.mo = year(t) * 12 + month(t))""")
        cols += [f"round(r{i}.filled, 8) AS {c}_filled", f"r{i}.how AS {c}_method", f"round(r{i}.days, 8) AS {c}_days"]
    parts.append("""s2 AS (SELECT hadm_id, subject_id, admittime AS t, CASE WHEN lower(trim(marital_status)) NOT IN ('', 'nan', 'none', '<na>', 'unknown') THEN trim(marital_status) END AS v FROM master_table_model_ready),
n2 AS (SELECT *, epoch(t - last_value(CASE WHEN v IS NOT NULL THEN t END IGNORE NULLS) OVER p) / 86400.0 AS pd, last_value(v IGNORE NULLS) OVER p AS pv,
   epoch(first_value(CASE WHEN v IS NOT NULL THEN t END IGNORE NULLS) OVER f - t) / 86400.0 AS nd, first_value(v IGNORE NULLS) OVER f AS nv FROM s2
   WINDOW p AS (PARTITION BY subject_id ORDER BY t, hadm_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), f AS (PARTITION BY subject_id ORDER BY t, hadm_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
r2 AS (SELECT hadm_id, CASE WHEN v IS NOT NULL THEN v WHEN pd <= 365 THEN pv WHEN nd <= 365 THEN nv END AS filled, CASE WHEN v IS NOT NULL THEN 'observed' WHEN pd <= 365 OR nd <= 365 THEN 'carried' ELSE 'none' END AS how,
   CASE WHEN v IS NOT NULL THEN 0.0 WHEN pd <= 365 THEN pd WHEN nd <= 365 THEN nd END AS days FROM n2)""")
    cols += ["r2.filled AS marital_status_filled", "r2.how AS marital_status_method", "round(r2.days, 8) AS marital_status_days"]
    return f"WITH {', '.join(parts)} SELECT hadm_id, {', '.join(cols)} FROM r0 JOIN r1 USING (hadm_id) JOIN r2 USING (hadm_id)"


def _events_sql() -> str:
    flag = "lower(trim(coalesce(flag, '')))"
    lab = f"'lab_' || CASE WHEN {flag} IN ('abnormal', 'high', 'low', 'h', 'l', 'hh', 'll', 'a') THEN 'abnormal' ELSE 'normal' END || CASE WHEN lower(priority) LIKE '%stat%' THEN '_stat' ELSE '_routine' END"
    code = "nullif(trim(replace(upper(trim(icd_code)), '.', '')), '')"
    return f"""WITH {_LABS}, events AS (
SELECT hadm_id, {lab} AS type, charttime AS seen_at, valuenum AS value FROM labs WHERE hadm_id IS NOT NULL AND charttime IS NOT NULL
UNION ALL SELECT hadm_id, 'drg_severity_' || drg_severity::INT::VARCHAR, min(loaded_at), drg_severity FROM drgcodes WHERE drg_severity IS NOT NULL GROUP BY hadm_id, drg_severity, drg_mortality
UNION ALL SELECT hadm_id, 'dx_' || {code}, min(loaded_at), 1.0 FROM diagnoses WHERE hadm_id IS NOT NULL AND {code} IS NOT NULL GROUP BY hadm_id, {code}),
dated AS (SELECT *, date_trunc('day', max(seen_at) OVER (PARTITION BY hadm_id))::TIMESTAMP + INTERVAL 1 DAY AS as_of FROM events)
"""


def _types_sql() -> str:
    inside = lambda w: f"FILTER (WHERE seen_at >= as_of - INTERVAL {w} DAY)"
    windows = ", ".join(f"count(*) {inside(w)} AS n_{w}d, round(coalesce(sum(value) {inside(w)}, 0.0), 8) AS total_{w}d" for w in (7, 30))
    return f"""{_events_sql()}SELECT d.hadm_id, type, count(*) AS n, round(coalesce(sum(value), 0.0), 8) AS total, round(epoch(any_value(as_of) - max(seen_at)) / 86400.0, 8) AS recency_days, {windows}
FROM dated d JOIN (SELECT DISTINCT hadm_id FROM admissions) s USING (hadm_id) GROUP BY d.hadm_id, type"""


def _wide_sql() -> str:
    cells = ", ".join(f"coalesce(count(*) FILTER (WHERE type = '{t}'), 0) AS {t}__n, round(coalesce(sum(value) FILTER (WHERE type = '{t}'), 0.0), 8) AS {t}__total, round(epoch(any_value(as_of) - max(seen_at) FILTER (WHERE type = '{t}')) / 86400.0, 8) AS {t}__recency_days" for t in WIDE_TYPES)
    return f"{_events_sql()}SELECT s.hadm_id, {cells} FROM (SELECT DISTINCT hadm_id FROM admissions) s LEFT JOIN dated USING (hadm_id) GROUP BY s.hadm_id"


SQL = {
    "p1_found": " UNION ALL ".join(f"SELECT DISTINCT hadm_id, '{c}' AS field FROM master_table_model_ready WHERE {c} IS NULL OR isnan({c}::DOUBLE) OR {c} < {lo} OR {c} > {hi}" for c, (lo, hi) in RANGES.items()),
    "p1_filled": _p1_sql(),
    "p2_found": f"""WITH {_P2}
SELECT hadm_id, 'num_prev_visits' AS field FROM master_table m JOIN known k USING (hadm_id) WHERE m.num_prev_visits IS DISTINCT FROM k.num_prev_visits
UNION ALL SELECT hadm_id, 'avg_prev_drg_mortality' FROM master_table m JOIN known k USING (hadm_id)
WHERE (m.avg_prev_drg_mortality IS NULL) <> (k.avg_prev_drg_mortality IS NULL) OR abs(m.avg_prev_drg_mortality - k.avg_prev_drg_mortality) > 0.02""",
    "p2_known": f"WITH {_P2} SELECT hadm_id, num_prev_visits, round(avg_prev_drg_mortality, 6) AS avg_prev_drg_mortality FROM known",
    "p3_found": "SELECT subject_id FROM labevents GROUP BY subject_id HAVING count(*) >= 0.02 * (SELECT count(*) FROM labevents)",
    "p3_subject_labs": f"""WITH {_LABS}, people AS (SELECT subject_id, min(anchor_age) AS anchor_age FROM patients GROUP BY subject_id)
SELECT subject_id, count(*) AS n_labs, count(valuenum) AS n_values, round(sum(valuenum), 8) AS sum_value, round(avg(valuenum), 8) AS avg_value, round(min(valuenum), 8) AS min_value, round(max(valuenum), 8) AS max_value, min(anchor_age) AS anchor_age
FROM labs LEFT JOIN people USING (subject_id) GROUP BY subject_id""",
    "p3_labs_by_admission_type": f"""WITH {_LABS}, stays AS (SELECT hadm_id, min(subject_id) AS subject_id, min(lower(trim(admission_type))) AS admission_type FROM admissions GROUP BY hadm_id)
SELECT admission_type, count(*) AS n_pairs, count(valuenum) AS n_values, round(avg(valuenum), 6) AS avg_value, max(valuenum) AS max_value FROM labs JOIN stays USING (subject_id) GROUP BY admission_type""",
    "p4_found": f"WITH {_P4} SELECT DISTINCT table_name, key_id, load_month, reason FROM cases",
    "p4_report": f"WITH {_P4} SELECT table_name, load_month, reason, count(DISTINCT key_id) AS n_keys, count(*) AS n_rows FROM cases GROUP BY ALL",
    "p5_found": """WITH stays AS (SELECT hadm_id, min(subject_id) AS subject_id, min(admittime) AS admittime FROM admissions GROUP BY hadm_id),
codes AS (SELECT hadm_id, count(DISTINCT nullif(trim(replace(upper(trim(icd_code)), '.', '')), '')) AS n FROM diagnoses WHERE hadm_id IS NOT NULL GROUP BY hadm_id),
known AS (SELECT m.hadm_id, coalesce(sum(c.n), 0) AS n FROM master_table m LEFT JOIN stays s ON s.subject_id = m.subject_id AND s.admittime < m.admittime LEFT JOIN codes c ON c.hadm_id = s.hadm_id GROUP BY m.hadm_id)
SELECT hadm_id FROM master_table m JOIN known k USING (hadm_id) WHERE m.num_prev_diagnoses IS DISTINCT FROM k.n""",
    "p5_stay_types": _types_sql(),
    "p5_stay_totals": _wide_sql(),
    "p7_found": f"""WITH {_P7} SELECT subject_id, 'period' AS kind, strftime(period_start, '%Y-%m-%d %H:%M:%S') AS from_ts, strftime(period_end, '%Y-%m-%d %H:%M:%S') AS to_ts FROM periods WHERE stays > 1
UNION ALL SELECT subject_id, 'gap', strftime(period_end, '%Y-%m-%d %H:%M:%S'), strftime(nxt, '%Y-%m-%d %H:%M:%S') FROM (SELECT *, lead(period_start) OVER (PARTITION BY subject_id ORDER BY period_no) AS nxt FROM periods) WHERE nxt IS NOT NULL""",
    "p7_periods": f"WITH {_P7} SELECT subject_id, period_no::BIGINT AS period_no, period_start, period_end FROM periods",
}

SQL |= {f"{name}_sharded": SQL[name] for name in ("p1_filled", "p2_known", "p7_periods")}
