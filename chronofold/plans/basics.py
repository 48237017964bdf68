"""Queries of sources, scalar expressions, joins, set operations and aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronofold.functions import exprs as x
from chronofold.operators import contract, impute, profile, relational
from chronofold.plans.registry import Registry
from chronofold.session import scratch_path, table
from chronofold.sources import readers, writers

query = Registry()
QUERIES, SQL = query.queries, query.sql

_NULLS = ", ".join(f"'{t}'" for t in x.CSV_NULLS)
_HOLD = ", ".join(f"'{t}'" for t in x.TEXT_PLACEHOLDERS)


def _collapse_sql(c: str, rules) -> str:
    return f"CASE WHEN {c} IS NULL THEN NULL " + " ".join(f"WHEN contains(lower(trim({c})), '{n}') THEN '{v}'" for n, v in rules) + " ELSE 'other' END"


@query("SELECT l_orderkey, l_extendedprice, l_shipdate FROM lineitem WHERE l_shipdate < TIMESTAMP '1996-01-01' AND l_quantity > 25")
def scan_project_filter(s, d):
    return table(s, d, "lineitem").where((F.col("l_shipdate") < F.lit("1996-01-01").cast("timestamp_ntz")) & (F.col("l_quantity") > 25)).select("l_orderkey", "l_extendedprice", "l_shipdate")


@query(f"SELECT hadm_id, CASE WHEN marital_status NOT IN ({_NULLS}) THEN marital_status END AS marital_status, CASE WHEN race NOT IN ({_NULLS}) THEN race END AS race, hospital_expire_flag, admittime FROM admissions")
def csv_null_tokens(s, d):
    path = scratch_path(s, ".csv")
    writers.write_csv(table(s, d, "admissions").select("subject_id", "hadm_id", "marital_status", "race", "hospital_expire_flag", "admittime"), path)
    schema = T.StructType.fromDDL("hadm_id int, marital_status string, race string, hospital_expire_flag double, admittime timestamp_ntz")
    return readers.read_table(s, path, schema)


@query("SELECT subject_id, hadm_id, icd_code, mod(subject_id, 16)::INT AS bucket FROM diagnoses WHERE mod(subject_id, 16) = 3")
def bucketed_scan(s, d):
    path = scratch_path(s, ".parquet")
    df = table(s, d, "diagnoses").select("subject_id", "hadm_id", "icd_code")
    writers.write_bucketed(df, path, "subject_id", 16)
    return readers.read_bucket(s, path, 3, df.schema)


@query(f"""SELECT subject_id, loaded_at, CASE WHEN lower(trim(flag)) NOT IN ({_HOLD}) THEN lower(trim(flag)) END AS flag, CASE WHEN lower(trim(priority)) NOT IN ({_HOLD}) THEN lower(trim(priority)) END AS priority FROM labevents""")
def normalize_text(s, d):
    return table(s, d, "labevents").select("subject_id", "loaded_at", x.normalize_text("flag").alias("flag"), x.normalize_text("priority").alias("priority"))


@query(f"SELECT hadm_id, loaded_at, {_collapse_sql('admission_type', x.ADMISSION_TYPES)} AS admission_type, {_collapse_sql('marital_status', x.MARITAL)} AS marital_status, {_collapse_sql('race', x.RACES)} AS race FROM admissions")
def clean_category_chain(s, d):
    return table(s, d, "admissions").select("hadm_id", "loaded_at", x.collapse("admission_type", x.ADMISSION_TYPES).alias("admission_type"), x.collapse("marital_status", x.MARITAL).alias("marital_status"), x.collapse("race", x.RACES).alias("race"))


@query("""SELECT hadm_id, CASE WHEN last_systolic BETWEEN 10 AND 999 AND last_diastolic BETWEEN 10 AND 999 THEN last_systolic::DOUBLE END AS systolic,
CASE WHEN last_systolic BETWEEN 10 AND 999 AND last_diastolic BETWEEN 10 AND 999 THEN last_diastolic::DOUBLE END AS diastolic,
CASE WHEN last_systolic BETWEEN 10 AND 999 AND last_diastolic BETWEEN 10 AND 999 THEN (last_systolic - last_diastolic)::DOUBLE END AS pulse_pressure FROM master_table_model_ready""")
def parse_pair_regex(s, d):
    text = F.concat(F.lit(" "), F.col("last_systolic").cast("string"), F.lit(" / "), F.col("last_diastolic").cast("string"))
    a, b = x.parse_pair(text)
    return table(s, d, "master_table_model_ready").select("hadm_id", a.alias("systolic"), b.alias("diastolic"), (a - b).alias("pulse_pressure"))


@query(f"SELECT subject_id, loaded_at, careunit, CASE WHEN regexp_matches(lower(coalesce(careunit, '')), '{'|'.join(x.ICU_WORDS)}') THEN 1 ELSE 0 END AS is_icu FROM transfers")
def keyword_regex_flag(s, d):
    return table(s, d, "transfers").select("subject_id", "loaded_at", "careunit", x.keyword_flag("careunit", x.ICU_WORDS).alias("is_icu"))


@query(f"SELECT subject_id, loaded_at, CASE WHEN lower(trim(flag)) IN ({', '.join(repr(v) for v in x.ABNORMAL)}) THEN 1 ELSE 0 END AS abnormal, CASE WHEN contains(lower(coalesce(priority, '')), 'stat') THEN 1 ELSE 0 END AS stat FROM labevents")
def member_flags(s, d):
    return table(s, d, "labevents").select("subject_id", "loaded_at", x.member_flag("flag", x.ABNORMAL).alias("abnormal"), x.contains_flag("priority", "stat").alias("stat"))


@query("SELECT hadm_id, loaded_at, year(admittime)::INT AS y, hour(admittime)::INT AS h, (isodow(admittime) - 1)::INT AS weekday, date_trunc('day', admittime)::TIMESTAMP AS midnight FROM admissions")
def time_parts(s, d):
    return table(s, d, "admissions").select("hadm_id", "loaded_at", F.year("admittime").alias("y"), F.hour("admittime").alias("h"), x.weekday("admittime").alias("weekday"), x.midnight("admittime").alias("midnight"))


@query("""SELECT hadm_id, loaded_at, round(epoch(dischtime - admittime) / 86400.0, 6) AS los_days,
CASE WHEN edregtime IS NULL AND edouttime IS NULL THEN 0.0 ELSE round_even(epoch(edouttime - edregtime) / 3600.0, 2) END AS ed_los_hours,
CASE WHEN edregtime IS NOT NULL OR edouttime IS NOT NULL THEN 1 ELSE 0 END AS came_from_ed FROM admissions""")
def durations(s, d):
    return table(s, d, "admissions").select("hadm_id", "loaded_at", F.round(x.days_between("admittime", "dischtime"), 6).alias("los_days"), x.emergency_hours("edregtime", "edouttime").alias("ed_los_hours"), (F.col("edregtime").isNotNull() | F.col("edouttime").isNotNull()).cast("int").alias("came_from_ed"))


_PEOPLE = "(SELECT subject_id, first(anchor_age ORDER BY loaded_at, gender NULLS FIRST, anchor_age NULLS FIRST, anchor_year NULLS FIRST) AS anchor_age, first(anchor_year ORDER BY loaded_at, gender NULLS FIRST, anchor_age NULLS FIRST, anchor_year NULLS FIRST) AS anchor_year, first(gender ORDER BY loaded_at, gender NULLS FIRST, anchor_age NULLS FIRST, anchor_year NULLS FIRST) AS gender FROM patients GROUP BY subject_id)"


@query(f"""SELECT a.hadm_id, a.loaded_at, round_even(coalesce(p.anchor_age + (year(a.admittime) - p.anchor_year), p.anchor_age), 0)::INT AS age, CASE lower(trim(p.gender)) WHEN 'm' THEN 1 WHEN 'f' THEN 0 END AS gender
FROM admissions a LEFT JOIN {_PEOPLE} p USING (subject_id)""")
def anchor_age(s, d):
    people = table(s, d, "patients").select("subject_id", F.col("loaded_at").alias("known_at"), "gender", "anchor_age", "anchor_year")
    joined = relational.left_lookup(table(s, d, "admissions"), people, ["subject_id"], ["known_at"])
    return joined.select("hadm_id", "loaded_at", x.age_at("anchor_age", "anchor_year", "admittime").alias("age"), x.gender_code("gender").alias("gender"))


@query("""SELECT subject_id, loaded_at, valuenum, round(CASE WHEN NOT isnan(valuenum) AND ref_range_upper > ref_range_lower THEN (valuenum - ref_range_lower) / (ref_range_upper - ref_range_lower) END, 6) AS norm_lab FROM labevents""")
def range_normalize(s, d):
    return table(s, d, "labevents").select("subject_id", "loaded_at", "valuenum", F.round(x.range_position("valuenum", "ref_range_lower", "ref_range_upper"), 6).alias("norm_lab"))


@query("SELECT hadm_id, (((subject_id - 10500000) % 128 + 128) % 128)::INT AS bucket FROM master_table")
def bucket_assign(s, d):
    return table(s, d, "master_table").select("hadm_id", x.bucket(F.col("subject_id") - 10_500_000, 128).alias("bucket"))


@query("SELECT l_orderkey, l_linenumber, l_extendedprice, round_even(l_quantity / 8, 2) AS eighth, round_even(l_quantity / 2, 0)::INT AS half FROM lineitem")
def round_half_even(s, d):
    return table(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", x.round_2(F.col("l_quantity") / 8).alias("eighth"), x.round_int(F.col("l_quantity") / 2).alias("half"))


@query("""SELECT hadm_id, CASE gender WHEN 0 THEN 'Female' WHEN 1 THEN 'Male' ELSE gender::VARCHAR END AS gender_text, CASE target WHEN 0 THEN 'Survived' WHEN 1 THEN 'Died' END AS target_text,
CASE WHEN age IS NULL THEN NULL WHEN age <= 39 THEN '<40' WHEN age <= 59 THEN '40-59' ELSE '60+' END AS age_group FROM master_table""")
def value_map_and_bins(s, d):
    return table(s, d, "master_table").select("hadm_id", x.mapped("gender", {0: "Female", 1: "Male"}, F.col("gender").cast("string")).alias("gender_text"), x.mapped("target", {0: "Survived", 1: "Died"}).alias("target_text"), x.right_closed_bins("age", [39, 59], ["<40", "40-59", "60+"]).alias("age_group"))


@query("""SELECT hadm_id, CASE WHEN race IS NULL OR race NOT IN ('asian', 'black', 'hispanic_latino', 'other') THEN 'Unknown' ELSE CASE race WHEN 'asian' THEN 'Asian' WHEN 'black' THEN 'Black' WHEN 'hispanic_latino' THEN 'Hispanic_Latino' ELSE 'Other' END END AS race_group FROM master_table""")
def idxmax_onehot(s, d):
    levels = ["asian", "black", "hispanic_latino", "other"]
    coded = table(s, d, "master_table").select("hadm_id", *[F.coalesce(F.col("race") == v, F.lit(False)).cast("int").alias(f"race_{v}") for v in levels])
    return coded.select("hadm_id", x.title_case(x.widest([f"race_{v}" for v in levels], "race_")).alias("race_group"))


@query("""SELECT o_orderkey, TRY_CAST(split_part(o_orderpriority, '-', 1) AS DOUBLE) AS rank, TRY_CAST(o_orderpriority AS DOUBLE) AS not_a_number, TRY_CAST(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS ordered, TRY_CAST(o_orderstatus AS TIMESTAMP) AS not_a_time FROM orders""")
def coerce_types(s, d):
    return table(s, d, "orders").select("o_orderkey", x.number(F.split_part("o_orderpriority", F.lit("-"), F.lit(1))).alias("rank"), x.number("o_orderpriority").alias("not_a_number"), x.moment(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("ordered"), x.moment("o_orderstatus").alias("not_a_time"))


@query(f"SELECT hadm_id, CASE WHEN lower(trim(marital_status)) NOT IN ({_HOLD}) THEN trim(marital_status) END AS marital_status, CASE WHEN lower(trim(race)) NOT IN ({_HOLD}) THEN trim(race) END AS race, target FROM master_table_model_ready")
def standardize_missing(s, d):
    return contract.standardize_missing(table(s, d, "master_table_model_ready").select("hadm_id", "marital_status", "race", "target"))


@query("SELECT subject_id, loaded_at, coalesce(intime, outtime) AS event_time FROM transfers WHERE coalesce(intime, outtime) IS NOT NULL")
def first_valid_time(s, d):
    df = table(s, d, "transfers")
    return df.select("subject_id", "loaded_at", x.first_valid(df, ["intime", "outtime", "no_such_column"]).alias("event_time")).dropna(subset=["event_time"])


@query("SELECT hadm_id, CASE WHEN race IN ('asian', 'black', 'white') THEN race END AS race, NULL::INT AS not_there, target FROM master_table")
def reindex_and_levels(s, d):
    df = table(s, d, "master_table").withColumn("race", x.only_levels("race", ["asian", "black", "white"]))
    return relational.move_last(relational.follow_template(relational.reindex(df, ["target", "hadm_id", "race", "not_there"]).withColumn("not_there", F.col("not_there").cast("int")), ["hadm_id", "gone", "race"]), "target")


@query("SELECT hadm_id, (avg_prev_drg_mortality >= 2.5)::INT AS at_risk FROM master_table")
def threshold_label(s, d):
    return table(s, d, "master_table").select("hadm_id", x.label_at("avg_prev_drg_mortality", 2.5).alias("at_risk"))


# Joins and sets


@query(f"SELECT a.subject_id, a.hadm_id, a.loaded_at, p.anchor_age, p.anchor_year FROM admissions a LEFT JOIN {_PEOPLE} p USING (subject_id)")
def left_join_dedup(s, d):
    people = table(s, d, "patients").select("subject_id", F.col("loaded_at").alias("known_at"), "gender", "anchor_age", "anchor_year")
    return relational.left_lookup(table(s, d, "admissions"), people, ["subject_id"], ["known_at"]).select("subject_id", "hadm_id", "loaded_at", "anchor_age", "anchor_year")


@query("SELECT subject_id, hadm_id, icd_code, loaded_at FROM diagnoses g WHERE EXISTS (SELECT 1 FROM admissions a WHERE a.subject_id = g.subject_id AND a.hadm_id = g.hadm_id)")
def semi_join_keys(s, d):
    return relational.semi(table(s, d, "diagnoses"), table(s, d, "admissions"), ["subject_id", "hadm_id"])


@query("SELECT p.subject_id, p.loaded_at FROM patients p WHERE NOT EXISTS (SELECT 1 FROM admissions a WHERE a.subject_id = p.subject_id)")
def anti_join(s, d):
    return relational.anti(table(s, d, "patients"), table(s, d, "admissions"), ["subject_id"]).select("subject_id", "loaded_at")


@query("SELECT a.hadm_id, a.target, b.target AS ready_target, a.age FROM master_table a LEFT JOIN master_table_model_ready b USING (subject_id, hadm_id, admittime)")
def one_to_one_join(s, d):
    keys = ["subject_id", "hadm_id", "admittime"]
    return relational.one_to_one(table(s, d, "master_table").select(*keys, "target", "age"), table(s, d, "master_table_model_ready").select(*keys, F.col("target").alias("ready_target")), keys).select("hadm_id", "target", "ready_target", "age")


@query("SELECT hadm_id, n FROM (SELECT hadm_id, count(*) AS n FROM admissions GROUP BY hadm_id) WHERE n > 1")
def cardinality_check(s, d):
    return relational.repeated_keys(table(s, d, "admissions"), ["hadm_id"])


@query("SELECT m.hadm_id, m.age, m.target FROM master_table m WHERE hadm_id IN (SELECT hadm_id FROM split_assignment WHERE lower(trim(split_name)) = 'deployment')")
def keyed_restriction(s, d):
    keys = table(s, d, "split_assignment").where(F.lower(F.trim("split_name")) == "deployment")
    return relational.semi(table(s, d, "master_table"), keys, ["hadm_id"]).select("hadm_id", "age", "target")


@query("SELECT subject_id, arg_min(hadm_id, (admittime, hadm_id)) AS hadm_id, min(admittime) AS admittime FROM admissions GROUP BY subject_id")
def keep_first(s, d):
    return relational.keep_first(table(s, d, "admissions").select("subject_id", "hadm_id", "admittime"), ["subject_id"], ["admittime", "hadm_id"])


@query("SELECT subject_id, hadm_id, admittime AS t, 'admission' AS kind, NULL::VARCHAR AS careunit FROM admissions UNION ALL SELECT subject_id, hadm_id, intime, 'transfer', careunit FROM transfers")
def union_missing_cols(s, d):
    return relational.union_all(table(s, d, "admissions").select("subject_id", "hadm_id", F.col("admittime").alias("t"), F.lit("admission").alias("kind")), table(s, d, "transfers").select("subject_id", "hadm_id", F.col("intime").alias("t"), F.lit("transfer").alias("kind"), "careunit"))


@query("""SELECT subject_id FROM admissions INTERSECT SELECT subject_id FROM labevents""")
def intersect_keys(s, d):
    return table(s, d, "admissions").select("subject_id").intersect(table(s, d, "labevents").select("subject_id"))


@query("""WITH a AS (SELECT DISTINCT hadm_id AS k FROM diagnoses WHERE hadm_id IS NOT NULL), b AS (SELECT DISTINCT hadm_id AS k FROM drgcodes), w AS (SELECT DISTINCT hadm_id AS k FROM admissions)
SELECT (SELECT count(*) FROM a JOIN b USING (k)) AS n_overlap, (SELECT count(*) FROM w WHERE k NOT IN (SELECT k FROM a) AND k NOT IN (SELECT k FROM b)) AS n_uncovered,
(SELECT count(*) FROM (SELECT k FROM a UNION SELECT k FROM b) WHERE k NOT IN (SELECT k FROM w)) AS n_foreign""")
def set_coverage(s, d):
    return relational.coverage([table(s, d, "diagnoses").where("hadm_id IS NOT NULL"), table(s, d, "drgcodes")], table(s, d, "admissions"), "hadm_id")


@query("""WITH old AS (SELECT hadm_id, split_name AS value, 'old' AS source FROM (SELECT *, row_number() OVER (PARTITION BY hadm_id ORDER BY split_name DESC NULLS LAST, assigned_at DESC) AS rn FROM split_assignment) WHERE rn = 1),
new AS (SELECT hadm_id, max(race) AS value, 'new' AS source FROM admissions WHERE year(admittime) >= 2015 GROUP BY hadm_id)
SELECT * FROM new UNION ALL SELECT * FROM old WHERE hadm_id NOT IN (SELECT hadm_id FROM new)""")
def upsert_keep_last(s, d):
    old = writers.upserted(None, table(s, d, "split_assignment").withColumnRenamed("split_name", "value"), ["hadm_id"], ["value", "assigned_at"]).select("hadm_id", "value", F.lit("old").alias("source"))
    new = table(s, d, "admissions").where(F.year("admittime") >= 2015).groupBy("hadm_id").agg(F.max("race").alias("value")).withColumn("source", F.lit("new"))
    return writers.upserted(old, new, ["hadm_id"])


# Aggregates


@query("SELECT subject_id, max(target) AS target FROM master_table GROUP BY subject_id")
def group_max_label(s, d):
    return profile.group_label(table(s, d, "master_table"), "subject_id", "target")


@query("SELECT race AS value, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 8) AS share FROM admissions GROUP BY race")
def value_counts_share(s, d):
    return profile.value_counts(table(s, d, "admissions"), "race").withColumn("share", F.round("share", 8))


@query("SELECT 'subject_id' AS \"column\", count(DISTINCT subject_id) AS n_distinct FROM labevents UNION ALL SELECT 'hadm_id', count(DISTINCT hadm_id) FROM labevents UNION ALL SELECT 'flag', count(DISTINCT flag) FROM labevents")
def distinct_counts(s, d):
    return profile.distinct_counts(table(s, d, "labevents"), ["subject_id", "hadm_id", "flag"])


_MISSING = ("hadm_id", "charttime", "valuenum", "flag", "priority")


@query(" UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL{f' OR isnan({c})' if c == 'valuenum' else ''}) AS n_missing, round(100.0 * count(*) FILTER (WHERE {c} IS NULL{f' OR isnan({c})' if c == 'valuenum' else ''}) / count(*), 4)::DOUBLE AS pct_missing FROM labevents" for c in _MISSING))
def missing_summary(s, d):
    return profile.missing_summary(table(s, d, "labevents"), _MISSING)


_ZERO = ("num_prev_visits", "num_abnormal_labs", "last_los", "target")


@query(" UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} = 0) AS n_zero, round(100.0 * count(*) FILTER (WHERE {c} = 0) / count(*), 4)::DOUBLE AS pct_zero FROM master_table" for c in _ZERO))
def zero_summary(s, d):
    return profile.zero_summary(table(s, d, "master_table"), [*_ZERO, "no_such_column"])


_DESCRIBED = ("age", "ed_los_hours", "weight_last")


@query(" UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(v) AS n, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std, min(v) AS \"min\", round(quantile_cont(v, 0.25), 6) AS q25, round(quantile_cont(v, 0.5), 6) AS q50, round(quantile_cont(v, 0.75), 6) AS q75, max(v) AS \"max\" FROM (SELECT CASE WHEN NOT isnan({c}::DOUBLE) THEN {c}::DOUBLE END AS v FROM master_table)" for c in _DESCRIBED))
def describe_numeric(s, d):
    out = profile.describe(table(s, d, "master_table"), _DESCRIBED)
    return out.select("column", "n", *[F.round(c, 6).alias(c) for c in ("mean", "std")], "min", *[F.round(c, 6).alias(c) for c in ("q25", "q50", "q75")], "max")


@query("SELECT median(age)::DOUBLE AS age, median(ed_los_hours) AS ed_los_hours, median(num_abnormal_labs)::DOUBLE AS num_abnormal_labs FROM master_table")
def column_medians(s, d):
    return profile.medians(table(s, d, "master_table"), ["age", "ed_los_hours", "num_abnormal_labs"])


@query("WITH n AS (SELECT count(*) AS n FROM labevents GROUP BY subject_id, hadm_id, charttime, valuenum) SELECT sum(n)::BIGINT AS n_rows, count(*) AS n_keys, sum(n - 1)::BIGINT AS n_extra, coalesce(sum(n) FILTER (WHERE n > 1), 0)::BIGINT AS n_in_repeats FROM n")
def duplicate_checks(s, d):
    return profile.repeats(table(s, d, "labevents"), ["subject_id", "hadm_id", "charttime", "valuenum"])


@query("SELECT count(*) FILTER (WHERE target = 1) AS n_pos, count(*) FILTER (WHERE target = 0) AS n_neg, round(count(*) FILTER (WHERE target = 0) / count(*) FILTER (WHERE target = 1), 6) AS ratio FROM master_table")
def class_balance(s, d):
    return profile.class_balance(table(s, d, "master_table"), "target").withColumn("ratio", F.round("ratio", 6))


@query("SELECT target AS label, count(*) AS n, round((SELECT count(*) FROM master_table) / (2.0 * count(*)), 6)::DOUBLE AS weight FROM master_table GROUP BY target")
def balanced_weights(s, d):
    return profile.balanced_weights(table(s, d, "master_table"), "target").withColumn("weight", F.round("weight", 6))


@query("""WITH j AS (SELECT lower(trim(a.split_name)) AS split, m.subject_id, m.target FROM master_table m JOIN split_assignment a USING (hadm_id)), g AS (SELECT split, subject_id, count(*) AS n, sum(target) AS p, max(target) AS y FROM j GROUP BY ALL)
SELECT split, sum(n)::BIGINT AS n_rows, count(*) AS n_groups, round(sum(p) / sum(n), 6) AS row_rate, round(avg(y), 6) AS group_rate FROM g GROUP BY split""")
def positive_rates(s, d):
    j = table(s, d, "master_table").join(table(s, d, "split_assignment").select("hadm_id", F.lower(F.trim("split_name")).alias("split")), "hadm_id")
    return profile.positive_rates(j, "split", "subject_id", "target").withColumns({c: F.round(c, 6) for c in ("row_rate", "group_rate")})


@query("SELECT 'age' AS \"column\", round(avg(abs(age)), 6) AS mean_abs FROM master_table UNION ALL SELECT 'last_norm_lab', round(avg(abs(last_norm_lab)) FILTER (WHERE NOT isnan(last_norm_lab)), 6) FROM master_table")
def mean_abs(s, d):
    return profile.mean_abs(table(s, d, "master_table"), ["age", "last_norm_lab"]).withColumn("mean_abs", F.round("mean_abs", 6))


@query("SELECT o_custkey, arg_max(o_orderkey, (o_totalprice, o_orderkey)) AS o_orderkey, max(o_totalprice) AS o_totalprice FROM orders GROUP BY o_custkey")
def best_per_group(s, d):
    return profile.best_per_group(table(s, d, "orders"), ["o_custkey"], [F.col("o_totalprice"), F.col("o_orderkey")], ["o_orderkey", "o_totalprice"])


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def top_k(s, d):
    return table(s, d, "orders").orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(10).select("o_orderkey", "o_totalprice")


@query("""SELECT n_regionkey, n_name, l_returnflag, count(*) AS n, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, grouping(n_regionkey, n_name, l_returnflag)::BIGINT AS level
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY GROUPING SETS ((n_regionkey, n_name), (l_returnflag), ())""")
def grouping_sets_revenue(s, d):
    j = table(s, d, "lineitem").join(table(s, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(table(s, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(F.broadcast(table(s, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    dims = ["n_regionkey", "n_name", "l_returnflag"]
    return j.groupingSets([["n_regionkey", "n_name"], ["l_returnflag"], []], *dims).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.grouping_id().alias("level"))


# Sinks, schemas and progress

_DESCRIBED_TYPES = "(SELECT column_name, column_type, row_number() OVER () AS place FROM (DESCRIBE SELECT * FROM master_table))"


@query(f"SELECT column_name AS name, (place - 1)::BIGINT AS position, column_name IN ('age', 'target') AS in_template FROM {_DESCRIBED_TYPES}")
def schema_probe(s, d):
    """The columns of a CSV table from its header, and those that an earlier output has, too."""
    path = scratch_path(s)
    writers.write_csv(table(s, d, "master_table"), f"{path}/t.csv")
    writers.write_csv(table(s, d, "master_table").select("age", "target"), f"{path}/before.csv")
    names, before = readers.columns_of(s, f"{path}/t.csv"), readers.template_columns(s, f"{path}/before.csv")
    return s.createDataFrame([(c, i, c in before) for i, c in enumerate(names)], "name string, position long, in_template boolean")


@query("SELECT 'csv' AS sink, hadm_id, age, ed_los_hours, race FROM master_table UNION ALL SELECT 'parquet', hadm_id, age, ed_los_hours, race FROM master_table")
def dual_sinks(s, d):
    """A table written to parquet and CSV, and read back from both by suffix."""
    path, df = scratch_path(s), table(s, d, "master_table").select("hadm_id", "age", "ed_los_hours", "race")
    writers.write_both(df, f"{path}/t.parquet", f"{path}/t.csv")
    return relational.union_all(*[readers.read_table(s, f"{path}/t.{kind}", df.schema).select(F.lit(kind).alias("sink"), "*") for kind in ("csv", "parquet")])


@query("""SELECT 'X_test.csv' AS file, 2::BIGINT AS n_columns, count(*) AS n_rows FROM master_table WHERE target IS NOT NULL UNION ALL SELECT 'y_test.csv', 1, count(*) FROM master_table WHERE target IS NOT NULL UNION ALL SELECT 'test_full.csv', 4, count(*) FROM master_table WHERE target IS NOT NULL""")
def split_files(s, d):
    """Features, target and the whole of a split as files, found again by fragments of their names."""
    path = scratch_path(s)
    writers.write_split(table(s, d, "master_table").select("hadm_id", "age", "gender", "target").where(F.col("target").isNotNull()), path, "test", "target", ["hadm_id"])
    out = []
    for fragments in (["x_", "test"], ["y_", "test"], ["full"]):
        found = readers.find_files(s, path, fragments)
        read = readers.read_table(s, found)
        out.append(read.agg(F.lit(found.rpartition("/")[2]).alias("file"), F.lit(len(read.columns)).cast("long").alias("n_columns"), F.count(F.lit(1)).alias("n_rows")))
    return relational.union_all(*out)


@query("SELECT column_name AS name, 'left' AS side FROM (DESCRIBE SELECT * FROM diagnoses) WHERE column_name NOT IN (SELECT column_name FROM (DESCRIBE SELECT * FROM drgcodes)) UNION ALL SELECT column_name, 'right' FROM (DESCRIBE SELECT * FROM drgcodes) WHERE column_name NOT IN (SELECT column_name FROM (DESCRIBE SELECT * FROM diagnoses))")
def column_differences(s, d):
    return contract.column_differences(table(s, d, "diagnoses"), table(s, d, "drgcodes"))


@query(f"SELECT column_name AS name FROM {_DESCRIBED_TYPES} WHERE column_type IN ('INTEGER', 'DOUBLE', 'BIGINT', 'FLOAT') AND column_name NOT IN ('subject_id', 'hadm_id', 'target')")
def numeric_features(s, d):
    names = impute.numeric_features(table(s, d, "master_table"), ["subject_id", "hadm_id", "target"])
    return s.createDataFrame([(c,) for c in names], "name string")


@query("SELECT count(*) AS n_rows, count(*) FILTER (WHERE hadm_id IS NULL) AS n_outside, round(sum(CASE WHEN isnan(valuenum) THEN NULL ELSE valuenum END), 4) AS total FROM labevents")
def progress_totals(s, d):
    """Totals that are counted while another job runs over the rows."""
    df, seen = profile.observed(table(s, d, "labevents"), "labs", n_outside=F.count_if(F.col("hadm_id").isNull()), total=F.round(F.sum(x.number("valuenum")), 4))
    df.write.format("noop").mode("overwrite").save()
    return s.createDataFrame([(seen.get["n_rows"], seen.get["n_outside"], seen.get["total"])], "n_rows long, n_outside long, total double")
