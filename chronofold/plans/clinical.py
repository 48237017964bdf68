"""The clinical configuration: raw hospital tables to master table, model-ready table, splits, a trained artefact and scores."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronofold.functions import exprs as x
from chronofold.operators import contract, history, relational, sampling, scoring
from chronofold.operators.history import History
from chronofold.operators.inference import Scorer
from chronofold.operators.scoring import ScoringResult
from chronofold.plans import features
from chronofold.plans.registry import Registry
from chronofold.session import materialize, scratch_path, staging, table
from chronofold.sources.readers import read_table

query = Registry()
QUERIES, SQL = query.queries, query.sql

# The source tables with the columns that are read, and their types.
SOURCES = {
    "admissions": "subject_id int, hadm_id int, admittime timestamp_ntz, dischtime timestamp_ntz, edregtime timestamp_ntz, edouttime timestamp_ntz, admission_type string, marital_status string, race string, hospital_expire_flag double",
    "patients": "subject_id int, gender string, anchor_age double, anchor_year double",
    "diagnoses": "subject_id int, hadm_id int, icd_code string",
    "procedures": "subject_id int, hadm_id int, icd_code string",
    "drgcodes": "subject_id int, hadm_id int, drg_severity double, drg_mortality double",
    "labevents": "subject_id int, hadm_id int, charttime timestamp_ntz, valuenum double, ref_range_lower double, ref_range_upper double, flag string, priority string",
    "microbiology": "subject_id int, hadm_id int, chartdate timestamp_ntz, charttime timestamp_ntz, storedate timestamp_ntz, storetime timestamp_ntz, org_name string, interpretation string",
    "omr": "subject_id int, chartdate timestamp_ntz, result_name string, result_value string",
    "pharmacy": "subject_id int, hadm_id int, starttime timestamp_ntz, entertime timestamp_ntz, verifiedtime timestamp_ntz, medication string",
    "prescriptions": "subject_id int, hadm_id int, starttime timestamp_ntz, stoptime timestamp_ntz, drug string",
    "transfers": "subject_id int, hadm_id int, intime timestamp_ntz, outtime timestamp_ntz, careunit string",
}
# The master table's columns in their order.
MASTER = (
    "subject_id", "hadm_id", "admittime", "age", "gender", "admission_type", "marital_status", "race", "ed_los_hours", "came_from_ed", "admission_hour", "admission_day_of_week", "num_prev_visits",
    "time_since_last_visit_days", "avg_time_between_visits_days", "avg_prev_los", "max_prev_los", "last_los", "avg_prev_ed_los", "max_prev_ed_los", "num_prev_diagnoses", "num_unique_diagnoses_icd_codes",
    "num_prev_procedures", "num_unique_procedure_icd_codes", "avg_prev_drg_severity", "max_prev_drg_severity", "avg_prev_drg_mortality", "max_prev_drg_mortality", "num_abnormal_labs", "abnormal_lab_ratio",
    "stat_lab_ratio", "last_lab_flag", "last_norm_lab", "num_prev_medications", "num_unique_drugs", "num_prev_transfers", "num_prev_icu_visits", "num_prev_infections", "num_unique_organisms", "num_resistant_cases",
    "bmi_last", "weight_last", "last_systolic", "last_diastolic", "last_pulse_pressure", "target",
)
KEYS = MASTER[:3]
CATEGORICAL = ("admission_type", "marital_status", "race")
NUMERIC = tuple(c for c in MASTER if c not in (*KEYS, *CATEGORICAL, "target"))
SCHEMA = contract.ModelSchema(NUMERIC, CATEGORICAL)


def source(spark: SparkSession, tables: Mapping[str, DataFrame], name: str) -> DataFrame:
    """The named source with exactly its columns; an empty one if it isn't given. ``loaded_at`` is kept, where there is one, to tell first deliveries."""
    df = tables.get(name)
    if df is None:
        columns = ", ".join(f"CAST(NULL AS {kind}) AS {c}" for c, kind in (x.split() for x in SOURCES[name].split(", ")))
        return spark.sql(f"SELECT {columns} WHERE false")
    cols = [c.split()[0] for c in SOURCES[name].split(", ")]
    return df.select(*cols, *[c for c in df.columns if c == "loaded_at" and c not in cols])


def base_visits(admissions: DataFrame, patients: DataFrame) -> DataFrame:
    """One row per stay, with the patient's first row and the attributes known at admission. A stay or patient sent again counts by its first delivery."""
    known = lambda df: ["loaded_at"] if "loaded_at" in df.columns else []
    visits = relational.keep_first(admissions.dropna(subset=["subject_id", "hadm_id", "admittime"]), ["hadm_id"], known(admissions)).drop("loaded_at")
    people = relational.keep_first(patients.dropna(subset=["subject_id"]), ["subject_id"], known(patients)).drop("loaded_at")
    joined = visits.join(people, "subject_id", "left")
    return joined.select(
        "subject_id", "hadm_id", "admittime", x.age_at("anchor_age", "anchor_year", "admittime").alias("age"), x.gender_code("gender").alias("gender"),
        x.collapse("admission_type", x.ADMISSION_TYPES).alias("admission_type"), x.collapse("marital_status", x.MARITAL).alias("marital_status"), x.collapse("race", x.RACES).alias("race"),
        x.emergency_hours("edregtime", "edouttime").alias("ed_los_hours"), (F.col("edregtime").isNotNull() | F.col("edouttime").isNotNull()).cast("int").alias("came_from_ed"),
        F.hour("admittime").alias("admission_hour"), x.weekday("admittime").alias("admission_day_of_week"), x.days_between("admittime", "dischtime").alias("los"),
        F.coalesce(x.number("hospital_expire_flag").cast("int"), F.lit(0)).alias("target"),
    )


def build_master(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """The 46-column master table: a row per stay, with what its subject's history was strictly before it.

    Facts of time (laboratory, transfers, medication, microbiology) count before the admission, facts of a stay (codes) if
    the stay's admission is before, measurements (OMR) if their date is. All of them share one timeline per subject.
    """
    get = lambda name: source(spark, tables, name)
    visits = materialize(base_visits(get("admissions"), get("patients")))
    seq = history.visit_sequence(visits, "subject_id", "admittime", "hadm_id", {"los": "los", "ed_los": "ed_los_hours"})

    def coded(name: str, *cols):
        return history.at_visit_time(relational.semi(get(name), visits, ["subject_id"]).select("hadm_id", *cols), visits, "hadm_id", "subject_id", "admittime")

    code = F.nullif(x.strip("icd_code"), F.lit(""))
    lab = get("labevents").where(F.col("charttime").isNotNull()).select("subject_id", "charttime", x.member_flag("flag", x.ABNORMAL).alias("flag"), x.contains_flag("priority", "stat").alias("stat"), x.range_position("valuenum", "ref_range_lower", "ref_range_upper").alias("norm"))
    lab = lab.withColumns({"both": F.struct("flag", "norm"), "norm_key": F.coalesce("norm", F.lit(-1e300))})
    timed = lambda name, cols: get(name).withColumn("event_time", x.first_valid(get(name), cols)).where(F.col("event_time").isNotNull())
    moves = timed("transfers", ["intime", "outtime"]).withColumn("icu_stay", F.when(x.keyword_flag("careunit", x.ICU_WORDS) == 1, F.col("hadm_id")))
    named = lambda df, c: df.select("subject_id", "event_time", x.normalize_text(c).alias("name"))
    meds = relational.union_all(named(timed("pharmacy", ["starttime", "entertime", "verifiedtime"]), "medication"), named(timed("prescriptions", ["starttime", "stoptime"]), "drug"))
    micro = timed("microbiology", ["charttime", "chartdate", "storetime", "storedate"]).select("subject_id", "event_time", x.normalize_text("org_name").alias("org"), x.member_flag("interpretation", x.RESISTANT).alias("resistant"))
    facts = [
        History(visits, "admittime", {"__earlier": ("count", None)}),
        History(coded("diagnoses", code.alias("dx")), "admittime", {"num_prev_diagnoses": ("count", None), "num_unique_diagnoses_icd_codes": ("distinct", "dx")}),
        History(coded("procedures", code.alias("px")), "admittime", {"num_prev_procedures": ("count", None), "num_unique_procedure_icd_codes": ("distinct", "px")}),
        History(coded("drgcodes", x.number("drg_severity").alias("sev"), x.number("drg_mortality").alias("mort")), "admittime", {"avg_prev_drg_severity": ("avg", "sev"), "max_prev_drg_severity": ("max", "sev"), "avg_prev_drg_mortality": ("avg", "mort"), "max_prev_drg_mortality": ("max", "mort")}),
        History(lab, "charttime", {"num_abnormal_labs": ("sum", "flag"), "abnormal_lab_ratio": ("ratio", "flag"), "stat_lab_ratio": ("ratio", "stat"), "__lab": ("last", "both")}, order=("flag", "stat", "norm_key")),
        History(meds, "event_time", {"num_prev_medications": ("count", "name"), "num_unique_drugs": ("distinct", "name")}),
        History(moves, "event_time", {"num_prev_transfers": ("count", None), "num_prev_icu_visits": ("distinct", "icu_stay")}),
        History(micro, "event_time", {"num_prev_infections": ("count", None), "num_unique_organisms": ("distinct", "org"), "num_resistant_cases": ("sum", "resistant")}),
    ]
    out = materialize(history.prior_features(seq, facts, "subject_id", "admittime"))
    omr = get("omr").where(F.col("chartdate").isNotNull()).select("subject_id", "chartdate", x.normalize_text("result_name").alias("what"), x.strip("result_value").alias("value"))
    of = lambda word, out_name: History(omr.where(x.contains_flag("what", word) == 1), "chartdate", {out_name: ("last", "value")}, order=("value",))
    if "omr" in tables:
        measured = [of("bmi", "__bmi"), of("weight", "__weight"), of("blood pressure", "__bp")]
        # Written before the last projection: its many expressions over a merged timeline take the optimizer very long.
        out = materialize(history.prior_features(out.withColumn("__day", x.midnight("admittime")), measured, "subject_id", "__day"))
    else:
        out = out.withColumns({c: F.lit(None).cast("string") for c in ("__bmi", "__weight", "__bp")})
    systolic, diastolic = x.parse_pair("__bp")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    final = {
        "num_prev_visits": F.col("n_prev"), "time_since_last_visit_days": zero("days_since_last"), "avg_time_between_visits_days": zero("avg_gap_days"),
        "avg_prev_los": zero("avg_prev_los"), "max_prev_los": zero("max_prev_los"), "last_los": zero("last_los"),
        "avg_prev_ed_los": history.default_zero(F.col("avg_prev_ed_los"), F.col("n_prev")), "max_prev_ed_los": history.default_zero(F.col("max_prev_ed_los"), F.col("n_prev")),
        **{c: history.default_zero(F.col(c), F.col("__earlier")) for c in ("avg_prev_drg_severity", "max_prev_drg_severity", "avg_prev_drg_mortality", "max_prev_drg_mortality")},
        "num_abnormal_labs": F.coalesce("num_abnormal_labs", F.lit(0)), "num_resistant_cases": F.coalesce("num_resistant_cases", F.lit(0)), "last_lab_flag": F.coalesce(F.col("__lab.flag"), F.lit(0)), "last_norm_lab": F.col("__lab.norm"),
        "bmi_last": x.number("__bmi"), "weight_last": x.number("__weight"), "last_systolic": systolic, "last_diastolic": diastolic, "last_pulse_pressure": systolic - diastolic,
    }
    whole = ("age", "last_lab_flag", "last_systolic", "last_diastolic", "last_pulse_pressure")
    rounded = ("ed_los_hours", "time_since_last_visit_days", "avg_time_between_visits_days", "abnormal_lab_ratio", "stat_lab_ratio", "last_norm_lab", *[c for c in MASTER if c.startswith(("avg_prev", "max_prev", "last_los"))])
    out = out.withColumns(final)
    cell = lambda c: x.round_2(c) if c in rounded else x.round_int(c) if c in whole or c.startswith("num_") else F.col(c)
    return out.select(*[cell(c).alias(c) for c in MASTER])


def model_ready(master: DataFrame) -> DataFrame:
    """The master table as a model takes it: placeholders null, keys, numeric and category features, target. SchemaError if the contract is broken."""
    contract.exact_columns(master, MASTER)
    clean = contract.standardize_missing(master)
    contract.check(clean, ["subject_id", "hadm_id"], ["age", "gender"], "target", "admittime")
    return clean.select(*KEYS, *NUMERIC, *CATEGORICAL, "target")


def split_tables(ready: DataFrame, shares: Mapping[str, float] = features.SHARES, seed: int = 42) -> dict[str, DataFrame]:
    """The model-ready table by split, no subject in two of them. ValueError if shares don't add up, a key, time or target is missing, or fewer than three subjects have a positive."""
    gone = ready.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in ("subject_id", "admittime", "target")]).first().asDict()
    if any(gone.values()):
        raise ValueError(f"rows lack {({c: n for c, n in gone.items() if n})}")
    sampling.check_positive_groups(ready, "subject_id", "target", dict(shares))
    placed = sampling.group_split(ready, "subject_id", dict(shares), label="target", seed=seed)
    return {name: placed.where(F.col("split") == name).drop("split") for name in shares}


def train_scorer(train: DataFrame, kind: str = "boosted", *, threshold: float | None = None, metadata: dict | None = None, **params) -> Scorer:
    """The frozen pipeline over the model-ready features of a training split."""
    return Scorer.fit(train, SCHEMA, "target", kind, threshold=threshold, metadata=metadata, **params)


def score_raw(spark: SparkSession, tables: Mapping[str, DataFrame], scorer: Scorer, folder: str, now: dt.datetime | None = None) -> ScoringResult:
    """From raw tables to scores: master, model-ready table and predictions are written to ``folder`` as parquet and read back. What was staged on the way is removed, also if the run fails."""
    with staging(spark):
        build_master(spark, tables).write.mode("overwrite").parquet(f"{folder}/master.parquet")
        master = spark.read.parquet(f"{folder}/master.parquet")
        scoring.check_keys(master, "the master table")
        model_ready(master).write.mode("overwrite").parquet(f"{folder}/model_ready.parquet")
    return score_processed(spark, f"{folder}/master.parquet", f"{folder}/model_ready.parquet", scorer, f"{folder}/predictions.parquet", now)


def score_processed(spark: SparkSession, master: str, ready: str, scorer: Scorer, out: str, now: dt.datetime | None = None) -> ScoringResult:
    """From a processed master and model-ready table (parquet or CSV) to predictions, written to ``out``."""
    features_of = read_table(spark, ready)
    scorer.predict(features_of, now).write.mode("overwrite").parquet(out)
    return ScoringResult(read_table(spark, master), features_of, spark.read.parquet(out))


# The test tables lack five of the eleven sources. They are made of the tables there are, the same in both languages, so that every column has something to count.


def all_sources(s, d) -> dict[str, DataFrame]:
    """All eleven sources: procedures and prescriptions from transfers, pharmacy from laboratory rows, microbiology from codings, measurements from the model-ready table."""
    out = {t: table(s, d, t) for t in ("admissions", "patients", "diagnoses", "drgcodes", "labevents", "transfers")}
    none = F.lit(None).cast("timestamp_ntz")
    out["procedures"] = out["transfers"].select("subject_id", "hadm_id", F.col("careunit").alias("icd_code"))
    out["prescriptions"] = out["transfers"].select("subject_id", "hadm_id", F.col("intime").alias("starttime"), F.col("outtime").alias("stoptime"), F.col("careunit").alias("drug"))
    out["pharmacy"] = out["labevents"].select("subject_id", "hadm_id", F.when(F.col("valuenum").isNotNull(), F.col("charttime")).alias("starttime"), F.col("charttime").alias("entertime"), F.col("loaded_at").alias("verifiedtime"), F.col("flag").alias("medication"))
    organism, grade = F.concat(F.lit(" Org "), F.col("drg_severity").cast("int").cast("string")), F.when(F.col("drg_mortality") >= 3, " R ").otherwise("s")
    out["microbiology"] = out["drgcodes"].select("subject_id", "hadm_id", none.alias("chartdate"), none.alias("charttime"), none.alias("storedate"), F.col("loaded_at").alias("storetime"), organism.alias("org_name"), grade.alias("interpretation"))
    taken = table(s, d, "master_table_model_ready").select("subject_id", x.midnight("admittime").alias("chartdate"), "bmi_last", "weight_last", F.concat(F.lit(" "), F.col("last_systolic").cast("string"), F.lit("/"), F.col("last_diastolic").cast("string"), F.lit(" ")).alias("pressure"))
    named = (("BMI (kg/m2)", F.col("bmi_last").cast("string")), ("Weight (Lbs)", F.col("weight_last").cast("string")), ("Blood Pressure", F.col("pressure")))
    out["omr"] = taken.select("subject_id", "chartdate", F.explode(F.array(*[F.struct(F.lit(n).alias("result_name"), v.alias("result_value")) for n, v in named])).alias("r")).select("subject_id", "chartdate", "r.result_name", "r.result_value")
    return out


def _case(c: str, rules) -> str:
    return f"CASE WHEN {c} IS NULL THEN NULL " + " ".join(f"WHEN contains(lower(trim({c})), '{n}') THEN '{v}'" for n, v in rules) + " ELSE 'other' END"


def _text(c: str) -> str:
    return f"CASE WHEN lower(trim({c})) NOT IN ({', '.join(repr(t) for t in x.TEXT_PLACEHOLDERS)}) THEN lower(trim({c})) END"


def _master_sql() -> str:
    def r2(e: str) -> str:
        """Two decimals, halves to even, in whole numbers of 1e-8."""
        y = f"round(abs({e}) * 1e8)::BIGINT"
        return f"(sign({e}) * CASE WHEN {y} % 1000000 = 500000 THEN {y} // 1000000 + ({y} // 1000000) % 2 ELSE ({y} + 500000) // 1000000 END / 100.0)"

    past = "FROM stays v LEFT JOIN {0} f ON f.subject_id = v.subject_id AND f.at < v.admittime GROUP BY v.hadm_id"
    last = lambda name, column: f"{name} AS MATERIALIZED (SELECT v.hadm_id, arg_max({{'v': f.v}}, (f.at, coalesce(f.v, ''))) AS r FROM stays v LEFT JOIN {column} f ON f.subject_id = v.subject_id AND f.at < date_trunc('day', v.admittime) GROUP BY v.hadm_id)"
    omr = lambda name, value: f"{name} AS (SELECT subject_id, date_trunc('day', admittime)::TIMESTAMP AS at, {value} AS v FROM master_table_model_ready)"
    none = lambda e: f"CASE WHEN n.n = 0 THEN 0 ELSE {e} END"
    ed = lambda e: f"CASE WHEN nv = 0 THEN 0 ELSE {e} END"
    number = lambda e: f"CASE WHEN NOT isnan(TRY_CAST({e} AS DOUBLE)) THEN TRY_CAST({e} AS DOUBLE) END"
    pair = lambda i: f"round_even(TRY_CAST(nullif(regexp_extract(bp.r.v, '{x.PAIR}', {i}), '') AS DOUBLE), 0)::INT"
    first = "row_number() OVER (PARTITION BY {0} ORDER BY loaded_at NULLS FIRST, {1}) = 1"
    return f"""WITH adm AS (SELECT * FROM admissions WHERE subject_id IS NOT NULL AND hadm_id IS NOT NULL AND admittime IS NOT NULL
 QUALIFY {first.format('hadm_id', ', '.join(f'{c} NULLS FIRST' for c in ('subject_id', 'hadm_id', 'admittime', 'dischtime', 'edregtime', 'edouttime', 'admission_type', 'marital_status', 'race', 'hospital_expire_flag')))}),
people AS (SELECT * FROM patients QUALIFY {first.format('subject_id', 'gender NULLS FIRST, anchor_age NULLS FIRST, anchor_year NULLS FIRST')}),
stays AS MATERIALIZED (SELECT a.*, round_even(coalesce(p.anchor_age + (year(a.admittime) - p.anchor_year), p.anchor_age), 0)::INT AS age, CASE lower(trim(p.gender)) WHEN 'm' THEN 1 WHEN 'f' THEN 0 END AS sex,
 epoch(dischtime - admittime) / 86400.0 AS los, CASE WHEN edregtime IS NULL AND edouttime IS NULL THEN 0.0 ELSE {r2('epoch(edouttime - edregtime) / 3600.0')} END AS ed FROM adm a LEFT JOIN people p USING (subject_id)),
{features.LABS.replace('labs AS', 'labs0 AS')}, labs AS (SELECT *, charttime AS at FROM labs0),
seq0 AS (SELECT *, row_number() OVER o - 1 AS nv, epoch(admittime - lag(admittime) OVER o) / 86400.0 AS gap, lag(los) OVER o AS ll FROM stays WINDOW {features._W}),
seq AS MATERIALIZED (SELECT *, avg(gap) OVER w AS ag, avg(los) OVER w AS al, max(los) OVER w AS ml, avg(ed) OVER w AS ae, max(ed) OVER w AS me FROM seq0 WINDOW {features._W}),
n AS MATERIALIZED (SELECT v.hadm_id, count(f.hadm_id) AS n {past.format('(SELECT *, admittime AS at FROM stays)')}),
dxf AS (SELECT v.subject_id, v.admittime AS at, nullif(trim(g.icd_code), '') AS code FROM diagnoses g JOIN stays v USING (hadm_id)),
dx AS MATERIALIZED (SELECT v.hadm_id, count(f.subject_id) AS c, count(DISTINCT f.code) AS u {past.format('dxf')}),
pxf AS (SELECT v.subject_id, v.admittime AS at, nullif(trim(g.careunit), '') AS code FROM transfers g JOIN stays v USING (hadm_id)),
px AS MATERIALIZED (SELECT v.hadm_id, count(f.subject_id) AS c, count(DISTINCT f.code) AS u {past.format('pxf')}),
drf AS (SELECT v.subject_id, v.admittime AS at, drg_severity AS s, drg_mortality AS m FROM drgcodes g JOIN stays v USING (hadm_id)),
dr AS MATERIALIZED (SELECT v.hadm_id, avg(s) AS avs, max(s) AS mas, avg(m) AS avm, max(m) AS mam {past.format('drf')}),
lb AS MATERIALIZED (SELECT v.hadm_id, coalesce(sum(f.flag), 0) AS ab, coalesce(avg(f.flag), 0) AS ar, coalesce(avg(f.stat), 0) AS sr, arg_max({{'flag': f.flag, 'norm': f.norm}}, (f.at, f.flag, f.stat, coalesce(f.norm, -1e300))) AS last {past.format('labs')}),
mdf AS (SELECT subject_id, coalesce(CASE WHEN valuenum IS NOT NULL THEN charttime END, charttime, loaded_at) AS at, {_text('flag')} AS name FROM labevents UNION ALL SELECT subject_id, coalesce(intime, outtime), {_text('careunit')} FROM transfers),
md AS MATERIALIZED (SELECT v.hadm_id, count(f.name) AS c, count(DISTINCT f.name) AS u {past.format('mdf')}),
tf AS (SELECT subject_id, hadm_id, coalesce(intime, outtime) AS at, regexp_matches(lower(coalesce(careunit, '')), '{'|'.join(x.ICU_WORDS)}') AS icu FROM transfers),
tr AS MATERIALIZED (SELECT v.hadm_id, count(f.subject_id) AS c, count(DISTINCT f.hadm_id) FILTER (WHERE f.icu) AS i {past.format('tf')}),
mcf AS (SELECT subject_id, loaded_at AS at, 'org ' || drg_severity::INT::VARCHAR AS org, CASE WHEN drg_mortality >= 3 THEN 1 ELSE 0 END AS r FROM drgcodes),
mc AS MATERIALIZED (SELECT v.hadm_id, count(f.subject_id) AS c, count(DISTINCT f.org) AS u, coalesce(sum(f.r), 0) AS r {past.format('mcf')}),
{omr('o1', 'bmi_last::VARCHAR')}, {omr('o2', 'weight_last::VARCHAR')}, {omr('o3', "last_systolic::VARCHAR || '/' || last_diastolic::VARCHAR")}, {last('bm', 'o1')}, {last('wt', 'o2')}, {last('bp', 'o3')}
SELECT b.subject_id, b.hadm_id, b.admittime, b.age, b.sex AS gender, {_case('b.admission_type', x.ADMISSION_TYPES)} AS admission_type, {_case('b.marital_status', x.MARITAL)} AS marital_status, {_case('b.race', x.RACES)} AS race,
{r2('ed')} AS ed_los_hours, (edregtime IS NOT NULL OR edouttime IS NOT NULL)::INT AS came_from_ed, hour(b.admittime)::INT AS admission_hour, (isodow(b.admittime) - 1)::INT AS admission_day_of_week,
nv::INT AS num_prev_visits, {r2('coalesce(gap, 0)')} AS time_since_last_visit_days, {r2('coalesce(ag, 0)')} AS avg_time_between_visits_days, {r2('coalesce(al, 0)')} AS avg_prev_los, {r2('coalesce(ml, 0)')} AS max_prev_los, {r2('coalesce(ll, 0)')} AS last_los,
{r2(ed('ae'))} AS avg_prev_ed_los, {r2(ed('me'))} AS max_prev_ed_los, dx.c::INT AS num_prev_diagnoses, dx.u::INT AS num_unique_diagnoses_icd_codes, px.c::INT AS num_prev_procedures, px.u::INT AS num_unique_procedure_icd_codes,
{r2(none('avs'))} AS avg_prev_drg_severity, {none('mas')} AS max_prev_drg_severity, {r2(none('avm'))} AS avg_prev_drg_mortality, {none('mam')} AS max_prev_drg_mortality,
ab::INT AS num_abnormal_labs, {r2('ar')} AS abnormal_lab_ratio, {r2('sr')} AS stat_lab_ratio, coalesce(lb.last.flag, 0)::INT AS last_lab_flag, {r2('lb.last.norm')} AS last_norm_lab,
md.c::INT AS num_prev_medications, md.u::INT AS num_unique_drugs, tr.c::INT AS num_prev_transfers, tr.i::INT AS num_prev_icu_visits, mc.c::INT AS num_prev_infections, mc.u::INT AS num_unique_organisms, mc.r::INT AS num_resistant_cases,
{number('bm.r.v')} AS bmi_last, {number('wt.r.v')} AS weight_last, {pair(1)} AS last_systolic, {pair(2)} AS last_diastolic, {pair(1)} - {pair(2)} AS last_pulse_pressure,
coalesce(CASE WHEN NOT isnan(b.hospital_expire_flag) THEN b.hospital_expire_flag END::INT, 0) AS target
FROM seq b JOIN n USING (hadm_id) JOIN dx USING (hadm_id) JOIN px USING (hadm_id) JOIN dr USING (hadm_id) JOIN lb USING (hadm_id) JOIN md USING (hadm_id) JOIN tr USING (hadm_id) JOIN mc USING (hadm_id) JOIN bm USING (hadm_id) JOIN wt USING (hadm_id) JOIN bp USING (hadm_id)"""


@query(_master_sql())
def clinical_master(s, d):
    """The whole master table, 46 columns from eleven sources."""
    return build_master(s, all_sources(s, d))


@query("SELECT subject_id, hadm_id, admittime, true AS is_probability, true AS label_follows, 0.5::DOUBLE AS applied_threshold, 'logistic' AS model_version FROM (SELECT hadm_id, min(subject_id) AS subject_id, min(admittime) AS admittime FROM admissions GROUP BY hadm_id)")
def score_raw_run(s, d):
    """Raw tables to scores through a trained artefact that was saved and loaded: every stay once, with a probability and the label that follows from it."""
    folder = scratch_path(s)
    whole = table(s, d, "master_table_model_ready").dropna(subset=["age", "gender"])  # what the contract asks for; the test table lacks some
    train = split_tables(model_ready(whole))["train"]
    train_scorer(train, "logistic", threshold=0.5, metadata={"model_name": "logistic"}, maxIter=20).save(s, f"{folder}/artefact")
    tables = all_sources(s, d)
    known = tables["patients"].where(x.gender_code("gender").isNotNull() & F.col("anchor_age").isNotNull())
    people = known.unionByName(relational.anti(tables["admissions"].select("subject_id").distinct(), known, ["subject_id"]).select("subject_id", F.lit("F").alias("gender"), F.lit(60.0).alias("anchor_age"), F.lit(2015.0).alias("anchor_year"), F.lit(None).cast("timestamp_ntz").alias("loaded_at")))
    done = score_raw(s, tables | {"patients": people}, Scorer.load(s, f"{folder}/artefact"), f"{folder}/run").predictions
    p = F.col("predicted_probability")
    return done.select("subject_id", "hadm_id", "admittime", p.between(0, 1).alias("is_probability"), (F.col("predicted_label") == (p >= F.col("applied_threshold")).cast("int")).alias("label_follows"), "applied_threshold", "model_version")
