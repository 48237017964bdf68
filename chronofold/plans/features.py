"""Queries of entity-ordered sequences, prior history, splits, imputation, encoding and contracts."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronofold.functions import exprs as x
from chronofold.operators import contract, encode, history, impute, sampling
from chronofold.operators.history import History
from chronofold.plans.registry import Registry
from chronofold.session import table

query = Registry()
QUERIES, SQL = query.queries, query.sql

#: One row per stay, as SQL and as a DataFrame.
STAYS = "stays AS (SELECT hadm_id, min(subject_id) AS subject_id, min(admittime) AS admittime, min(dischtime) AS dischtime, min(edregtime) AS edregtime, min(edouttime) AS edouttime FROM admissions GROUP BY hadm_id)"
_ABN = ", ".join(repr(v) for v in x.ABNORMAL)
LABS = f"labs AS (SELECT subject_id, hadm_id, charttime, CASE WHEN lower(trim(flag)) IN ({_ABN}) THEN 1 ELSE 0 END AS flag, CASE WHEN contains(lower(coalesce(priority, '')), 'stat') THEN 1 ELSE 0 END AS stat, CASE WHEN NOT isnan(valuenum) AND ref_range_upper > ref_range_lower THEN (valuenum - ref_range_lower) / (ref_range_upper - ref_range_lower) END AS norm FROM labevents WHERE charttime IS NOT NULL)"


def stays(s, d):
    return table(s, d, "admissions").groupBy("hadm_id").agg(*[F.min(c).alias(c) for c in ("subject_id", "admittime", "dischtime", "edregtime", "edouttime")])


def labs(s, d):
    df = table(s, d, "labevents").where(F.col("charttime").isNotNull())
    return df.select("subject_id", "hadm_id", "charttime", x.member_flag("flag", x.ABNORMAL).alias("flag"), x.contains_flag("priority", "stat").alias("stat"), x.range_position("valuenum", "ref_range_lower", "ref_range_upper").alias("norm"))


def _visits(s, d):
    v = stays(s, d).withColumns({"los": x.days_between("admittime", "dischtime"), "ed": x.emergency_hours("edregtime", "edouttime")})
    return history.visit_sequence(v, "subject_id", "admittime", "hadm_id", {"los": "los", "ed": "ed"})


_W = "w AS (PARTITION BY subject_id ORDER BY admittime, hadm_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), o AS (PARTITION BY subject_id ORDER BY admittime, hadm_id)"
_V = f"{STAYS}, v AS (SELECT *, epoch(dischtime - admittime) / 86400.0 AS los, CASE WHEN edregtime IS NULL AND edouttime IS NULL THEN 0.0 ELSE round_even(epoch(edouttime - edregtime) / 3600.0, 2) END AS ed FROM stays)"


@query(f"WITH {STAYS} SELECT hadm_id, (row_number() OVER o - 1)::BIGINT AS n_prev, round(epoch(admittime - lag(admittime) OVER o) / 86400.0, 8) AS days_since_last FROM stays WINDOW {_W}")
def visit_sequence(s, d):
    return _visits(s, d).select("hadm_id", "n_prev", F.round("days_since_last", 8).alias("days_since_last"))


@query(f"WITH {STAYS}, g AS (SELECT *, epoch(admittime - lag(admittime) OVER o) / 86400.0 AS gap FROM stays WINDOW {_W}) SELECT hadm_id, round(avg(gap) OVER w, 6) AS avg_gap_days FROM g WINDOW {_W}")
def visit_gaps(s, d):
    return _visits(s, d).select("hadm_id", F.round("avg_gap_days", 6).alias("avg_gap_days"))


@query(f"WITH {_V} SELECT hadm_id, round(avg(los) OVER w, 6) AS avg_prev_los, round(max(los) OVER w, 6) AS max_prev_los, round(avg(ed) OVER w, 6) AS avg_prev_ed, round(max(ed) OVER w, 6) AS max_prev_ed FROM v WINDOW {_W}")
def prior_los_stats(s, d):
    return _visits(s, d).select("hadm_id", *[F.round(c, 6).alias(c) for c in ("avg_prev_los", "max_prev_los", "avg_prev_ed", "max_prev_ed")])


@query(f"WITH {_V} SELECT hadm_id, round(lag(los) OVER o, 6) AS last_los, round(lag(ed) OVER o, 6) AS last_ed FROM v WINDOW {_W}")
def last_value_lag(s, d):
    return _visits(s, d).select("hadm_id", F.round("last_los", 6).alias("last_los"), F.round("last_ed", 6).alias("last_ed"))


@query(f"WITH {_V} SELECT hadm_id, round(median(los) OVER w, 6) AS median_prev_los FROM v WINDOW {_W}")
def prior_median(s, d):
    v = stays(s, d).withColumn("los", x.days_between("admittime", "dischtime"))
    return history.prior_median(v, "subject_id", ["admittime", "hadm_id"], {"m": "los"}).select("hadm_id", F.round("m", 6).alias("median_prev_los"))


@query(f"WITH {STAYS} SELECT hadm_id, (row_number() OVER (ORDER BY admittime, hadm_id) - 1)::BIGINT AS row_no FROM stays")
def row_ordinal(s, d):
    return sampling.ordinal(stays(s, d).select("hadm_id", "admittime"), ["admittime", "hadm_id"]).select("hadm_id", "row_no")


_J = "FROM stays v LEFT JOIN {0} f ON f.subject_id = v.subject_id AND f.{1} < v.admittime GROUP BY v.hadm_id"


@query(f"WITH {STAYS}, t AS (SELECT subject_id, coalesce(intime, outtime) AS at_time FROM transfers) SELECT v.hadm_id, count(f.subject_id) AS num_prev_transfers {_J.format('t', 'at_time')}")
def history_counts(s, d):
    t = table(s, d, "transfers").select("subject_id", F.coalesce("intime", "outtime").alias("at_time"))
    return history.prior_features(stays(s, d), [History(t, "at_time", {"num_prev_transfers": ("count", None)})], "subject_id", "admittime").select("hadm_id", "num_prev_transfers")


@query(f"WITH {STAYS}, t AS (SELECT subject_id, hadm_id, coalesce(intime, outtime) AS at_time FROM transfers WHERE regexp_matches(lower(coalesce(careunit, '')), '{'|'.join(x.ICU_WORDS)}')) SELECT v.hadm_id, count(DISTINCT f.hadm_id) AS num_prev_icu_visits {_J.format('t', 'at_time')}")
def history_distinct(s, d):
    t = table(s, d, "transfers").where(x.keyword_flag("careunit", x.ICU_WORDS) == 1).select("subject_id", F.col("hadm_id").alias("icu"), F.coalesce("intime", "outtime").alias("at_time"))
    return history.prior_features(stays(s, d), [History(t, "at_time", {"num_prev_icu_visits": ("distinct", "icu")})], "subject_id", "admittime").select("hadm_id", "num_prev_icu_visits")


@query(f"WITH {STAYS}, {LABS} SELECT v.hadm_id, coalesce(sum(f.flag), 0)::BIGINT AS num_abnormal_labs, round(coalesce(avg(f.flag), 0), 6) AS abnormal_lab_ratio, round(coalesce(avg(f.stat), 0), 6) AS stat_lab_ratio {_J.format('labs', 'charttime')}")
def history_flag_ratio(s, d):
    h = History(labs(s, d), "charttime", {"num_abnormal_labs": ("sum", "flag"), "abnormal_lab_ratio": ("ratio", "flag"), "stat_lab_ratio": ("ratio", "stat")})
    out = history.prior_features(stays(s, d), [h], "subject_id", "admittime")
    return out.select("hadm_id", F.coalesce("num_abnormal_labs", F.lit(0)).alias("num_abnormal_labs"), F.round("abnormal_lab_ratio", 6).alias("abnormal_lab_ratio"), F.round("stat_lab_ratio", 6).alias("stat_lab_ratio"))


@query(f"""WITH {STAYS}, f AS (SELECT v.subject_id, v.admittime, c.drg_severity AS sev FROM drgcodes c JOIN stays v USING (hadm_id)),
n AS (SELECT v.hadm_id, count(o.hadm_id) AS n FROM stays v LEFT JOIN stays o ON o.subject_id = v.subject_id AND o.admittime < v.admittime GROUP BY v.hadm_id),
a AS (SELECT v.hadm_id, avg(f.sev) AS a, max(f.sev) AS m {_J.format('f', 'admittime')})
SELECT hadm_id, round(CASE WHEN n = 0 THEN 0 ELSE a END, 6) AS avg_prev_drg_severity, CASE WHEN n = 0 THEN 0 ELSE m END AS max_prev_drg_severity FROM a JOIN n USING (hadm_id)""")
def history_avg_max_default(s, d):
    v = stays(s, d)
    coded = history.at_visit_time(table(s, d, "drgcodes").select("hadm_id", F.col("drg_severity").alias("sev")), v, "hadm_id", "subject_id", "admittime")
    hs = [History(coded, "admittime", {"a": ("avg", "sev"), "m": ("max", "sev")}), History(v, "admittime", {"n": ("count", None)})]
    out = history.prior_features(v, hs, "subject_id", "admittime")
    return out.select("hadm_id", F.round(history.default_zero(F.col("a"), F.col("n")), 6).alias("avg_prev_drg_severity"), history.default_zero(F.col("m"), F.col("n")).alias("max_prev_drg_severity"))


@query(f"""WITH {STAYS}, {LABS}, l AS (SELECT v.hadm_id, arg_max({{'flag': f.flag, 'norm': f.norm}}, (f.charttime, f.flag, f.stat, coalesce(f.norm, -1e300))) AS last {_J.format('labs', 'charttime')})
SELECT hadm_id, coalesce(last.flag, 0) AS last_lab_flag, round(last.norm, 6) AS last_norm_lab FROM l""")
def history_last_struct(s, d):
    facts = labs(s, d).withColumns({"norm_key": F.coalesce("norm", F.lit(-1e300)), "both": F.struct("flag", "norm")})
    out = history.prior_features(stays(s, d), [History(facts, "charttime", {"l": ("last", "both")}, order=("flag", "stat", "norm_key"))], "subject_id", "admittime")
    return out.select("hadm_id", F.coalesce(F.col("l.flag"), F.lit(0)).alias("last_lab_flag"), F.round(F.col("l.norm"), 6).alias("last_norm_lab"))


@query(f"""WITH {STAYS}, u AS (SELECT subject_id, charttime AS at_time, 'lab ' || lower(trim(priority)) AS name FROM labevents UNION ALL SELECT subject_id, intime, careunit FROM transfers)
SELECT v.hadm_id, count(f.name) AS n_items, count(DISTINCT f.name) AS n_names {_J.format('u', 'at_time')}""")
def history_union_bag(s, d):
    from chronofold.operators.relational import union_all

    bag = union_all(table(s, d, "labevents").select("subject_id", F.col("charttime").alias("at_time"), F.concat(F.lit("lab "), F.lower(F.trim("priority"))).alias("name")), table(s, d, "transfers").select("subject_id", F.col("intime").alias("at_time"), F.col("careunit").alias("name")))
    out = history.prior_features(stays(s, d), [History(bag, "at_time", {"n_items": ("count", "name"), "n_names": ("distinct", "name")})], "subject_id", "admittime")
    return out.select("hadm_id", "n_items", "n_names")


@query(f"""WITH {STAYS}, f AS (SELECT v.subject_id, v.admittime, nullif(trim(g.icd_code), '') AS code FROM diagnoses g JOIN stays v USING (hadm_id))
SELECT v.hadm_id, count(f.subject_id) AS num_prev_diagnoses, count(DISTINCT f.code) AS num_unique_codes {_J.format('f', 'admittime')}""")
def history_via_visit(s, d):
    v = stays(s, d)
    code = F.nullif(F.trim("icd_code"), F.lit(""))
    coded = history.at_visit_time(table(s, d, "diagnoses").select("hadm_id", code.alias("code")), v, "hadm_id", "subject_id", "admittime")
    out = history.prior_features(v, [History(coded, "admittime", {"num_prev_diagnoses": ("count", None), "num_unique_codes": ("distinct", "code")})], "subject_id", "admittime")
    return out.select("hadm_id", "num_prev_diagnoses", "num_unique_codes")


@query(f"""WITH {STAYS}, r AS (SELECT subject_id, date_trunc('day', charttime) AS chartdate, charttime, valuenum FROM labevents WHERE charttime IS NOT NULL AND NOT coalesce(isnan(valuenum), false))
SELECT v.hadm_id, round(arg_max(f.valuenum, (f.charttime, f.valuenum)), 6) AS last_value, max(f.charttime) AS last_time FROM stays v LEFT JOIN r f ON f.subject_id = v.subject_id AND f.chartdate < date_trunc('day', v.admittime) AND f.valuenum IS NOT NULL GROUP BY v.hadm_id""")
def history_day_cutoff(s, d):
    v = stays(s, d).withColumn("cutoff", x.midnight("admittime"))
    r = table(s, d, "labevents").withColumn("valuenum", x.number("valuenum")).where(F.col("charttime").isNotNull() & F.col("valuenum").isNotNull()).select("subject_id", "charttime", "valuenum")
    out = history.prior_features(v, [History(r, "charttime", {"last_value": ("last", "valuenum"), "last_time": ("max", "charttime")}, order=("valuenum",))], "subject_id", "cutoff")
    return out.select("hadm_id", F.round("last_value", 6).alias("last_value"), "last_time")


@query("""WITH f AS (SELECT o_custkey AS c, l_shipdate AS t, l_partkey AS p, l_quantity AS q FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT o.o_orderkey, count(f.c) AS n, count(DISTINCT f.p) AS parts, max(f.q) AS max_quantity, round(avg(f.q), 6) AS avg_quantity FROM orders o LEFT JOIN f ON f.c = o.o_custkey AND f.t < o.o_orderdate GROUP BY o.o_orderkey""")
def history_orders(s, d):
    o = table(s, d, "orders").select("o_orderkey", F.col("o_custkey").alias("c"), "o_orderdate")
    f = table(s, d, "lineitem").join(o, F.col("l_orderkey") == F.col("o_orderkey")).select("c", F.col("l_shipdate").alias("t"), F.col("l_partkey").alias("p"), F.col("l_quantity").alias("q"))
    out = history.prior_features(o, [History(f, "t", {"n": ("count", None), "parts": ("distinct", "p"), "max_quantity": ("max", "q"), "avg_quantity": ("avg", "q")})], "c", "o_orderdate")
    return out.select("o_orderkey", "n", "parts", "max_quantity", F.round("avg_quantity", 6).alias("avg_quantity"))


# Splits and samples

SHARES = {"train": 0.70, "test": 0.15, "deployment": 0.15}


def _split_sql(strata: str, label: str) -> str:
    return f"""WITH g AS (SELECT subject_id, {label} AS y FROM master_table GROUP BY subject_id),
r AS (SELECT *, (row_number() OVER (PARTITION BY {strata} ORDER BY md5(subject_id::VARCHAR || '|42'), subject_id) - 1) / count(*) OVER (PARTITION BY {strata})::DOUBLE AS pos FROM g),
s AS (SELECT subject_id, CASE WHEN pos < 0.70 THEN 'train' WHEN pos < 0.85 THEN 'test' ELSE 'deployment' END AS split FROM r)"""


def _split(s, d):
    return sampling.group_split(table(s, d, "master_table").select("subject_id", "hadm_id", "admittime", *_IMPUTED, "target"), "subject_id", SHARES, label="target")


@query(_split_sql("y", "max(target)") + " SELECT m.hadm_id, s.split FROM master_table m JOIN s USING (subject_id)")
def hash_stratified_split(s, d):
    return _split(s, d).select("hadm_id", "split")


@query(_split_sql("1", "0").replace("pos < 0.70 THEN 'train' WHEN pos < 0.85 THEN 'test' ELSE 'deployment'", "pos < 0.80 THEN 'fit' ELSE 'held'") + " SELECT m.hadm_id, s.split FROM master_table m JOIN s USING (subject_id)")
def group_shuffle_split(s, d):
    return sampling.group_split(table(s, d, "master_table").select("subject_id", "hadm_id"), "subject_id", {"fit": 0.8, "held": 0.2}).select("hadm_id", "split")


@query("""WITH r AS (SELECT hadm_id, (row_number() OVER (PARTITION BY target ORDER BY md5(hadm_id::VARCHAR || '|7'), hadm_id) - 1) / count(*) OVER (PARTITION BY target)::DOUBLE AS pos FROM master_table) SELECT hadm_id, CASE WHEN pos < 0.9 THEN 'train' ELSE 'validation' END AS split FROM r""")
def row_stratified_split(s, d):
    return sampling.row_split(table(s, d, "master_table").select("hadm_id", "target"), ["hadm_id"], "target", {"train": 0.9, "validation": 0.1}, seed=7).select("hadm_id", "split")


@query(_split_sql("y", "max(target)") + " SELECT s.split, count(*) AS n_rows, count(DISTINCT m.subject_id) AS n_groups, round(avg(target), 6) AS row_rate FROM master_table m JOIN s USING (subject_id) GROUP BY s.split")
def split_report(s, d):
    from chronofold.operators.profile import positive_rates

    return positive_rates(_split(s, d), "split", "subject_id", "target").select("split", "n_rows", "n_groups", F.round("row_rate", 6).alias("row_rate"))


@query("SELECT 0::BIGINT AS n_overlap, 0::BIGINT AS n_uncovered, 0::BIGINT AS n_foreign")
def split_integrity(s, d):
    from chronofold.operators.relational import coverage

    split = _split(s, d)
    return coverage([split.where(F.col("split") == n) for n in SHARES], table(s, d, "master_table"), "subject_id")


@query("""WITH p AS (SELECT DISTINCT hadm_id, lower(trim(split_name)) AS split FROM split_assignment WHERE lower(trim(split_name)) IN ('train', 'test', 'deployment')), k AS (SELECT hadm_id, count(*) AS n FROM p GROUP BY hadm_id)
SELECT count(*) FILTER (WHERE n > 1) AS n_overlap, (SELECT count(DISTINCT hadm_id) FROM master_table WHERE hadm_id NOT IN (SELECT hadm_id FROM k)) AS n_uncovered, count(*) FILTER (WHERE hadm_id NOT IN (SELECT hadm_id FROM master_table)) AS n_foreign FROM k""")
def given_split_coverage(s, d):
    """How far the earlier assignment is from a sound split: stays in several splits, in none, and stays that the table lacks."""
    from chronofold.operators.relational import coverage

    given = table(s, d, "split_assignment").withColumn("split", F.lower(F.trim("split_name")))
    return coverage([given.where(F.col("split") == n) for n in SHARES], table(s, d, "master_table"), "hadm_id")


@query("SELECT hadm_id, age FROM master_table ORDER BY md5(hadm_id::VARCHAR || '|42'), hadm_id LIMIT 500")
def hash_sample_topn(s, d):
    return sampling.sample_n(table(s, d, "master_table"), 500, ["hadm_id"]).select("hadm_id", "age")


@query("""WITH r AS (SELECT hadm_id, target, row_number() OVER (PARTITION BY target ORDER BY md5(hadm_id::VARCHAR || '|42'), hadm_id) AS rk, count(*) OVER (PARTITION BY target) AS n, count(*) OVER () AS total FROM master_table)
SELECT hadm_id, target FROM r WHERE total <= 1000 OR rk <= greatest(1, floor(n * 1000 / total))""")
def stratified_cap(s, d):
    return sampling.capped(table(s, d, "master_table").select("hadm_id", "target"), 1000, ["target"], ["hadm_id"])


# Imputation, encoding, contracts

#: All measures of the master table, as impute.numeric_features() gives them.
_IMPUTED = tuple("""age gender ed_los_hours came_from_ed admission_hour admission_day_of_week num_prev_visits time_since_last_visit_days avg_time_between_visits_days avg_prev_los max_prev_los last_los avg_prev_ed_los max_prev_ed_los
num_prev_diagnoses num_unique_diagnoses_icd_codes num_prev_procedures num_unique_procedure_icd_codes avg_prev_drg_severity max_prev_drg_severity avg_prev_drg_mortality max_prev_drg_mortality num_abnormal_labs abnormal_lab_ratio stat_lab_ratio
last_lab_flag last_norm_lab num_prev_medications num_unique_drugs num_prev_transfers num_prev_icu_visits num_prev_infections num_unique_organisms num_resistant_cases bmi_last weight_last last_systolic last_diastolic last_pulse_pressure""".split())


@query(_split_sql("y", "max(target)") + ", m AS (SELECT m.*, s.split FROM master_table m JOIN s USING (subject_id)), p AS (SELECT *, " + ", ".join(f"median(CASE WHEN NOT isnan({c}::DOUBLE) THEN {c}::DOUBLE END) OVER w AS m_{c}" for c in _IMPUTED) + " FROM m WINDOW w AS (PARTITION BY subject_id ORDER BY admittime, hadm_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) SELECT hadm_id, " + ", ".join(f"round(coalesce(CASE WHEN NOT isnan({c}::DOUBLE) THEN {c}::DOUBLE END, m_{c}, (SELECT median(CASE WHEN NOT isnan({c}::DOUBLE) THEN {c}::DOUBLE END) FROM m WHERE split = 'train')), 6) AS {c}" for c in _IMPUTED) + " FROM p")
def temporal_median_impute(s, d):
    split = _split(s, d)
    out = impute.temporal_median_impute(split.where("split = 'train'"), split, "subject_id", ["admittime", "hadm_id"], _IMPUTED)
    return out.select("hadm_id", *[F.round(c, 6).alias(c) for c in _IMPUTED])


@query("SELECT " + ", ".join(f"0::BIGINT AS {c}" for c in _IMPUTED))
def residual_nulls(s, d):
    split = _split(s, d)
    out = impute.temporal_median_impute(split.where("split = 'train'"), split, "subject_id", ["admittime", "hadm_id"], _IMPUTED)
    return out.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in _IMPUTED])


_ONEHOT = [(c, v) for c, of in encode.LEVELS.items() for v in of[1:]]


@query("SELECT hadm_id, " + ", ".join(f"(coalesce(trim({c}), 'unknown') = '{v}')::INT::DOUBLE AS {c}_{v}" for c, v in _ONEHOT) + " FROM master_table")
def onehot_drop_first(s, d):
    return encode.one_hot(table(s, d, "master_table").select("hadm_id", *encode.LEVELS), encode.LEVELS)


_TRAINED = ("race_black", "race_white", "marital_status_single", "never_seen", "age")


@query("SELECT hadm_id, (coalesce(race, 'unknown') = 'black')::INT::DOUBLE AS race_black, (coalesce(race, 'unknown') = 'white')::INT::DOUBLE AS race_white, (coalesce(trim(marital_status), 'unknown') = 'single')::INT::DOUBLE AS marital_status_single, 0.0::DOUBLE AS never_seen, age FROM master_table")
def align_features(s, d):
    return encode.align(encode.one_hot(table(s, d, "master_table").select("hadm_id", "age", *encode.LEVELS), encode.LEVELS), ["hadm_id", *_TRAINED])


@query("SELECT hadm_id, round((age - avg(age) OVER ()) / stddev_pop(age) OVER (), 6) AS age, round((ed_los_hours - avg(ed_los_hours) OVER ()) / stddev_pop(ed_los_hours) OVER (), 6) AS ed_los_hours FROM master_table")
def standard_scale_pop(s, d):
    df = table(s, d, "master_table").select("hadm_id", "age", "ed_los_hours")
    return encode.scale(df, encode.fit_scaler(df, ["age", "ed_los_hours"])).select("hadm_id", F.round("age", 6).alias("age"), F.round("ed_los_hours", 6).alias("ed_los_hours"))


@query("SELECT race AS level, count(*) AS n FROM (SELECT coalesce(trim(race), 'unknown') AS race FROM master_table) GROUP BY race")
def category_levels(s, d):
    levels = encode.category_levels(table(s, d, "master_table"), {"race": encode.LEVELS["race"]})["race"]
    return table(s, d, "master_table").select(F.coalesce(F.trim("race"), F.lit("unknown")).alias("level")).where(F.col("level").isin(levels)).groupBy("level").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH k AS (SELECT subject_id, hadm_id, count(*) AS n, count(*) FILTER (WHERE admittime IS NULL OR dischtime IS NULL) AS r, count(*) FILTER (WHERE hospital_expire_flag IS NULL OR hospital_expire_flag NOT IN (0, 1)) AS l, count(*) FILTER (WHERE admittime IS NULL) AS t FROM admissions GROUP BY ALL)
SELECT sum(n)::BIGINT AS n_rows, sum(n - 1)::BIGINT AS n_key_repeats, sum(r)::BIGINT AS n_null_required, sum(l)::BIGINT AS n_bad_label, sum(t)::BIGINT AS n_bad_time FROM k""")
def contract_violations(s, d):
    return contract.violations(table(s, d, "admissions"), ["subject_id", "hadm_id"], ["admittime", "dischtime"], "hospital_expire_flag", "admittime")


@query("SELECT count(*) FILTER (WHERE lower(trim(flag)) NOT IN ('', 'nan', 'none', '<na>') AND TRY_CAST(trim(flag) AS DOUBLE) IS NULL) AS flag, 0::BIGINT AS valuenum FROM labevents")
def unreadable_numbers(s, d):
    return contract.ModelSchema(("flag", "valuenum"), ()).unreadable(table(s, d, "labevents"))
