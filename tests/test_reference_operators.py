"""Sources, contracts, splits, metrics, models and the clinical pipeline on small frames."""

import datetime as dt

import numpy as np
import pytest
from helpers import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronofold.functions import exprs as x
from chronofold.operators import contract, encode, explain, history, impute, inference, metrics, models, neighbors, relational, sampling, scoring
from chronofold.operators.history import History
from chronofold.plans import clinical
from chronofold.session import materialize
from chronofold.sources import readers, writers


def test_csv_round_trip_and_tokens(spark, tmp_path):
    df = spark.createDataFrame([(1, " a ", "NA"), (2, 'q"uote, comma', "NULL"), (3, "", "x")], "i int, t string, n string")
    writers.write_csv(df, f"{tmp_path}/t.csv")
    schema = T.StructType.fromDDL("i int, t string, n string")
    assert rows(readers.read_table(spark, f"{tmp_path}/t.csv", schema)) == [(1, " a ", None), (2, 'q"uote, comma', None), (3, None, "x")]
    (tmp_path / "b.csv").write_text("i,at,v\n1,2020-01-01 10:00:00,1.5\nx,soon,n/a\n3,,7\n")
    got = readers.read_csv(spark, str(tmp_path / "b.csv"), T.StructType.fromDDL("i int, at timestamp_ntz, v double"))
    assert rows(got) == [(1, dt.datetime(2020, 1, 1, 10), 1.5), (3, None, 7.0), (None, None, None)]
    assert readers.columns_of(spark, str(tmp_path / "b.csv")) == ["i", "at", "v"]
    assert readers.template_columns(spark, str(tmp_path / "none.csv")) is None
    with pytest.raises(FileNotFoundError):
        readers.read_csv(spark, str(tmp_path / "none.csv"))
    with pytest.raises(ValueError):
        readers.read_table(spark, str(tmp_path / "t.xlsx"))


def test_partitions_split_files_and_json(spark, tmp_path):
    df = spark.createDataFrame([(i - 5, f"v{i}", i % 2) for i in range(20)], "k int, v string, y int")
    writers.write_bucketed(df, f"{tmp_path}/b", "k", 4)
    assert rows(readers.read_bucket(spark, f"{tmp_path}/b", 3, df.schema), "k") == sorted([(k,) for k in range(-5, 15) if k % 4 == 3], key=repr)
    assert readers.read_bucket(spark, f"{tmp_path}/nothing", 3, df.schema).count() == 0
    writers.write_split(df, str(tmp_path), "train", "y", ["k"])
    assert readers.columns_of(spark, f"{tmp_path}/X_train.csv") == ["v"] and readers.columns_of(spark, f"{tmp_path}/y_train.csv") == ["y"]
    assert readers.find_files(spark, str(tmp_path), ["train", "full"]).endswith("train_full.csv")
    with pytest.raises(ValueError):
        readers.find_files(spark, str(tmp_path), ["train"])
    writers.write_json(spark, {"a": [1, None]}, f"{tmp_path}/m.json")
    assert writers.read_json(spark, f"{tmp_path}/m.json") == {"a": [1, None]}
    writers.write_both(df, f"{tmp_path}/p.parquet", f"{tmp_path}/p.csv")
    assert readers.read_table(spark, f"{tmp_path}/p.parquet").count() == readers.read_table(spark, f"{tmp_path}/p.csv").count() == 20


def test_upsert(spark, tmp_path):
    path = f"{tmp_path}/u"
    a = spark.createDataFrame([(1, "a", 1), (2, "a", 1), (None, "a", 1)], "k int, v string, t int")
    b = spark.createDataFrame([(2, "b", 1), (2, "c", 5), (3, "b", 1)], "k int, v string, t int")
    with pytest.raises(FileNotFoundError):
        writers.read_upserted(spark, path)
    assert writers.upsert(a, path, ["k"], ["t"], buckets=8) == 1
    before = writers.read_upserted(spark, path)
    for _ in range(2):
        writers.upsert(b, path, ["k"], ["t"])
    assert rows(writers.read_upserted(spark, path), "k", "v") == sorted([(1, "a"), (2, "c"), (3, "b"), (None, "a")], key=repr)
    assert writers.upsert(b.limit(0), path, ["k"], ["t"]) == 4 and before.columns == ["k", "v", "t"]
    writers.upsert(spark.createDataFrame([(4, "d", 1, 2.5)], "k int, v string, t int, w double"), path, ["k"], ["t"])
    assert rows(writers.read_upserted(spark, path), "k", "w") == sorted([(1, None), (2, None), (3, None), (None, None), (4, 2.5)], key=repr)
    kept = [p.name for p in (tmp_path / "u").iterdir() if p.name.startswith("manifest")]
    assert sorted(kept) == ["manifest-0000000004.json", "manifest-0000000005.json"]


def test_crash_before_the_manifest_leaves_the_last_version(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/u"
    writers.upsert(spark.createDataFrame([(1, "a")], "k int, v string"), path, ["k"])

    def fail(*_):
        raise OSError("disk gone")

    monkeypatch.setattr(writers, "write_json", fail)
    with pytest.raises(OSError):
        writers.upsert(spark.createDataFrame([(1, "b"), (2, "b")], "k int, v string"), path, ["k"])
    assert rows(writers.read_upserted(spark, path)) == [(1, "a")]


def test_exact_quantiles(spark):
    import random

    from chronofold.operators import profile

    r = random.Random(3)
    data = [(r.choice([None, float("nan"), r.gauss(0, 1), r.expovariate(1) ** 9, 7.0]), r.randrange(5), None, 10.0 ** r.randrange(-9, 9)) for _ in range(2000)]
    df = spark.createDataFrame(data, "a double, b int, c double, d double")
    q = (0.0, 0.25, 0.5, 0.9, 1.0)
    for kw in ({}, {"bins": 7, "keep": 5}):
        got = profile.exact_quantiles(df, ["a", "b", "c", "d"], q, **kw)
        for i, c in ((0, "a"), (1, "b"), (3, "d")):
            have = [float(x[i]) for x in data if x[i] is not None and x[i] == x[i]]
            assert got[c] == pytest.approx(np.quantile(have, q).tolist())
        assert got["c"] == [None] * 5
    assert profile.describe(df.limit(0), ["a"]).first()["q50"] is None and profile.medians(df.limit(0), ["b"]).first()[0] is None


def test_running_metrics_of_scores_of_any_range(spark, monkeypatch):
    monkeypatch.setattr(metrics, "SLICE_SCORES", 3)
    for a, b in ((1.0, 0.0), (500.0, -3000.0), (1e-9, 7.0)):
        df = spark.createDataFrame([(p * a + b, y) for p, y in GOLDEN], "p double, y int")
        r = metrics.ranking(metrics.score_groups(df, "y", "p")).first()
        assert (round(r["roc_auc"], 6), round(r["pr_auc"], 6)) == (0.722222, 0.755556)
    assert metrics.ranking(metrics.score_groups(df.limit(0), "y", "p")).first()["roc_auc"] is None


def test_expressions(spark):
    df = spark.createDataFrame([("EW EMER.", " HH ", "120/80", "Medical ICU"), (None, "none", " 90 / 60 ", None), ("urgent ELECTIVE", "", "120", "Coronary Care Unit"), ("EMERGENCY", "other", "1200/80", "Ward")], "a string, f string, p string, u string")
    s, d = x.parse_pair("p")
    got = df.select(x.collapse("a", x.ADMISSION_TYPES), x.member_flag("f", x.ABNORMAL), s, d, x.keyword_flag("u", x.ICU_WORDS)).collect()
    assert [tuple(r) for r in got] == [("other", 1, 120.0, 80.0, 1), (None, 0, 90.0, 60.0, 0), ("elective", 0, None, None, 1), ("emergency", 0, None, None, 0)]
    n = spark.createDataFrame([(0.125, 2.5, -7), (0.375, 3.5, 9), (None, None, None)], "a double, b double, k int")
    assert [tuple(r) for r in n.select(x.round_2("a"), x.round_int("b"), x.bucket("k", 4)).collect()] == [(0.12, 2, 1), (0.38, 4, 1), (None, None, None)]


def test_relational(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 1), (2, "c", 9)], "k int, v string, t int")
    assert rows(relational.keep_first(df, ["k"], ["t"])) == [(1, "a", 1), (2, "c", 9)]
    with pytest.raises(relational.CardinalityError):
        relational.one_to_one(df, df.select("k"), ["k"])
    assert relational.reindex(df, ["t", "new"]).columns == ["t", "new"]
    assert relational.follow_template(df, ["t", "gone"]).columns == ["t", "k", "v"]


def test_contract(spark):
    schema = contract.ModelSchema(("a",), ("c",), ("id",), "9")
    assert contract.ModelSchema.from_metadata(schema.to_metadata()) == schema
    df = spark.createDataFrame([(" 1.5", " X "), ("nan", "None"), (None, "")], "a string, c string")
    assert rows(schema.prepare(df)) == [(1.5, "X"), (None, None), (None, None)]
    for bad in (df.drop("a"), df.withColumn("odd", F.lit(1)), df.withColumn("a", F.lit("two"))):
        with pytest.raises(contract.SchemaError):
            schema.prepare(bad)
    ok = spark.createDataFrame([(1, 1, 0), (2, 2, 1)], "s int, h int, y int")
    contract.check(ok, ["s", "h"], ["h"], "y")
    for bad in (ok.limit(0), ok.union(ok), ok.withColumn("y", F.lit(2)), ok.withColumn("y", F.lit(None).cast("int")), ok.drop("y")):
        with pytest.raises(contract.SchemaError):
            contract.check(bad, ["s", "h"], ["h"], "y")


def test_history_leaks_nothing(spark, day):
    events = spark.createDataFrame([(1, i, day(i * 5)) for i in range(6)], "e int, i int, t timestamp_ntz")
    facts = spark.createDataFrame([(1, day(i), f"v{i % 4}", float(i)) for i in range(30)], "e int, at timestamp_ntz, v string, n double")
    spec = {"n": ("count", None), "d": ("distinct", "v"), "a": ("avg", "n"), "l": ("last", "n")}
    full = {r["i"]: r for r in history.prior_features(events, [History(facts, "at", spec)], "e", "t").collect()}
    for i in (2, 4):
        cut = history.prior_features(events.where(f"i = {i}"), [History(facts.where(F.col("at") < F.lit(day(i * 5))), "at", spec)], "e", "t").first()
        assert cut == full[i]
    assert (full[1]["n"], full[1]["d"], full[1]["a"], full[1]["l"]) == (5, 4, 2.0, 4.0) and full[0]["n"] == 0


def test_prior_median_of_long_entities(spark):
    rng = np.random.default_rng(5)
    data = [(int(e) if e < 3 else None, i, [None, float("nan"), float(rng.integers(0, 9)), 2.5][int(rng.integers(0, 4))], "x") for i, e in enumerate(rng.integers(0, 4, 400))]
    df = spark.createDataFrame(data, "e int, t int, v double, other string")
    plain = history.prior_median(df, "e", ["t"], {"m": "v"})
    got = history.prior_median(df, "e", ["t"], {"m": "v"}, floor=98)
    assert got.columns == plain.columns == ["e", "t", "v", "other", "m"]
    big = df.withColumn("other", F.lit(2**60 + 1))
    assert {r["other"] for r in history.prior_median(big, "e", ["t"], {"m": "v"}, floor=98).collect()} == {2**60 + 1}
    assert repr(rows(got)) == repr(rows(plain)) and len(rows(got)) == 400


def test_impute_scale_encode(spark, day):
    df = spark.createDataFrame([(1, 1, 10.0), (1, 2, None), (1, 3, 20.0), (1, 4, float("nan")), (2, 1, None)], "e int, t int, v double")
    got = rows(impute.temporal_median_impute(df, df, "e", ["t"], ["v"]), "e", "t", "v")
    assert got == [(1, 1, 10.0), (1, 2, 10.0), (1, 3, 20.0), (1, 4, 15.0), (2, 1, 15.0)]
    params = encode.fit_scaler(df, ["t"])
    assert params["t"][1] == pytest.approx(np.std([1, 2, 3, 4, 1]))
    c = spark.createDataFrame([("a",), ("zz",), (None,)], "c string")
    assert [tuple(r) for r in encode.one_hot(c, {"c": ("a", "b", "unknown")}, drop_first=False).collect()] == [(1.0, 0.0, 0.0), (0.0, 0.0, 0.0), (0.0, 0.0, 1.0)]
    with pytest.raises(ValueError):
        encode.category_levels(c, {"c": ("a", "unknown")})
    assert encode.category_levels(c.where("c = 'a' OR c IS NULL"), {"c": ("a", "b", "unknown")}) == {"c": ["a", "unknown"]}


def test_splits_do_not_depend_on_order(spark):
    df = spark.createDataFrame([(i // 3 if i < 390 else None, i, int(i % 50 == 0)) for i in range(400)], "g int, i int, y int")
    a = rows(sampling.group_split(df, "g", {"a": 0.7, "b": 0.3}, label="y"), "i", "split")
    assert a == rows(sampling.group_split(df.orderBy(F.rand(3)).repartition(7), "g", {"a": 0.7, "b": 0.3}, label="y"), "i", "split") and len(a) == 400
    split = sampling.group_split(df.where("g IS NOT NULL"), "g", {"a": 0.7, "b": 0.3}, label="y")
    assert not any(sampling.check_split(split, "g", "split", df.where("g IS NOT NULL")).values())
    with pytest.raises(ValueError):
        sampling.check_split(split.union(split.withColumn("split", F.lit("b"))), "g", "split", df.where("g IS NOT NULL"))
    assert sampling.check_positive_groups(df, "g", "y", {"a": 0.7, "b": 0.3}) == 3
    for few, shares in ((df.where("i < 60"), {"a": 0.7, "b": 0.3}), (df, {"a": 0.7, "b": 0.2}), (df, {"a": 1.0, "b": 0.0})):
        with pytest.raises(ValueError):
            sampling.check_positive_groups(few, "g", "y", shares)
    assert len(sampling.grid_sample({"a": [1, 2, 3], "b": [1, 2]}, 4)) == 4


GOLDEN = [(0.9, 1), (0.8, 0), (0.7, 1), (0.6, 0), (0.6, 1), (0.2, 0)]


def test_metrics_golden(spark):
    df = spark.createDataFrame(GOLDEN, "p double, y int")
    r = metrics.ranking(metrics.score_groups(df, "y", "p")).first()
    assert (round(r["roc_auc"], 6), round(r["pr_auc"], 6)) == (0.722222, 0.755556)
    one = metrics.ranking(metrics.score_groups(df.where("y = 1"), "y", "p")).first()
    assert one["roc_auc"] is None and one["pr_auc"] is None
    table = metrics.threshold_table(df, "y", "p", [0.5, 0.7, 0.95])
    assert rows(table, "threshold", "tp", "fp", "tn", "fn") == [(0.5, 3, 2, 1, 0), (0.7, 2, 1, 2, 1), (0.95, 0, 0, 3, 3)]
    assert metrics.choose(table, metrics.BY_F1_RECALL).first()["threshold"] == 0.5
    assert metrics.choose(table, metrics.BY_RECALL_F1, min_precision=0.99).first()["threshold"] == 0.5
    groups = metrics.score_groups(df, "y", "p")
    assert metrics.best_f1_threshold(groups) == 0.6 and metrics.best_f1_threshold(groups, shifted=True) == 0.2
    assert metrics.best_f1_threshold(groups.limit(0)) == 0.5


def test_models_and_artefact(spark, tmp_path):
    rng = np.random.default_rng(1)
    a = rng.normal(size=(400, 3))
    y = (a[:, 0] + a[:, 1] * a[:, 2] + rng.normal(size=400) * 0.3 > 0.8).astype(int)
    df = spark.createDataFrame([(i, *map(float, r), int(t)) for i, (r, t) in enumerate(zip(a, y, strict=True))], "i int, a double, b double, c double, y int")
    df = df.withColumn("a", F.when(F.col("i") % 17 != 0, F.col("a")))
    data = models.Features.fit(df, ["a", "b", "c"]).apply(df).cache()
    names = models.Features.fit(df, ["a", "b", "c"]).names
    assert names == ["a", "b", "c", "a_missing"]
    for kind in ("tree", "forest", "boosted"):
        model = models.fit(data, kind, "y", **({"maxIter": 4, "maxDepth": 3} if kind == "boosted" else {"numTrees": 5, "maxDepth": 3} if kind == "forest" else {"maxDepth": 3}))
        scored = models.positive_score(model, data)
        assert models.rank_metrics(scored, "y", "score")["roc_auc"] > 0.7
        explained = explain.explain(model, data, "i", names).join(scored.select(F.col("i").alias("id"), "score"), "id").collect()
        for r in explained[:50]:
            assert sum(r[n] for n in names) + r["base"] == pytest.approx(r["total"])
            p = r["score"]
            assert r["total"] == pytest.approx(p if kind != "boosted" else np.log(p / (1 - p)) / 2, abs=1e-6)
    for method in ("none", "sigmoid", "isotonic"):
        assert models.calibrate(scored, "score", "y", method)(scored).select("calibrated").count() == 400
    meta = models.save_packaged(model, f"{tmp_path}/pack", spark, {"feature_columns": names, "threshold": 0.84})
    loaded, back = models.load_packaged(spark, f"{tmp_path}/pack")
    assert back == meta and models.summarize(loaded, back) == {"model_class": "GBTClassificationModel", "threshold": 0.84, "calibration": "none", "n_features": 4}
    assert models.positive_score(loaded, data).count() == 400


def test_neighbors_edge_cases(spark):
    e = spark.createDataFrame([(1, [0.0, 0.0], 0), (2, [0.0, 1.0], 1), (3, [0.0, 1.0], 1), (4, None, 1), (5, [5.0], 0)], "i int, v array<double>, l int")
    q = e.where("i < 3")
    assert rows(neighbors.knn(q, e, "i", "v", 1), "query_id", "neighbor_id") == [(1, 2), (2, 3)]
    assert rows(neighbors.knn(q, e, "i", "v", 1, block=1), "query_id", "neighbor_id") == [(1, 2), (2, 3)]
    assert neighbors.knn(q.limit(0), e, "i", "v", 1).count() == 0


def clinical_tables(spark, day):
    t = lambda *a: day(*a)
    make = lambda name, data: spark.createDataFrame(data, clinical.SOURCES[name])
    return {
        "admissions": make("admissions", [
            (1, 10, t(0), t(2), None, None, "EW EMER.", "MARRIED", "WHITE", 0.0), (1, 11, t(10), t(14), t(9, 20), t(10), "URGENT", "divorced", "BLACK/X", None),
            (1, 12, t(10), t(11), t(9), None, "ELECTIVE", None, "LATINO", 1.0), (1, 13, t(20, 6), None, None, None, None, "WIDOW", "?", 0.0), (2, 20, t(5), t(6), None, None, "x", "x", "x", 0.0),
        ]),
        "patients": make("patients", [(1, "M", 50.0, 2019.0), (2, " f ", 30.0, None)]),
        "diagnoses": make("diagnoses", [(1, 10, "A1 "), (1, 10, "A1"), (1, 11, "B2"), (1, 11, ""), (9, 90, "Z")]),
        "drgcodes": make("drgcodes", [(1, 11, 2.0, None), (1, 11, 4.0, None)]),
        "labevents": make("labevents", [(1, None, t(1), 5.0, 0.0, 10.0, "abnormal", "STAT"), (1, 10, t(10), 5.0, 5.0, 5.0, None, "routine"), (1, 10, t(12), 1.0, 0.0, 4.0, " HH ", "stat")]),
        "transfers": make("transfers", [(1, 10, t(0), None, "Medical ICU"), (1, 10, None, t(1), "Coronary Care Unit"), (1, None, t(1), None, "MICU"), (1, 11, None, None, "MICU")]),
        "omr": make("omr", [(1, t(9), "BMI (kg/m2)", "31.5"), (1, t(10), "BMI", "99"), (1, t(19), "bmi", "n/a"), (1, t(18), "Blood Pressure", "120/80"), (1, t(3), "Weight (Lbs)", "180")]),
        "pharmacy": make("pharmacy", [(1, 10, None, t(1), None, "Aspirin "), (1, 10, None, None, None, "lost")]),
        "prescriptions": make("prescriptions", [(1, 10, None, t(1), "aspirin"), (1, 10, t(1), None, None)]),
        "microbiology": make("microbiology", [(1, 10, t(1), None, None, None, "E. COLI", "R"), (1, 10, None, None, t(2), None, None, "s")]),
    }


@pytest.fixture(scope="module")
def master(spark, day):
    return materialize(clinical.build_master(spark, clinical_tables(spark, day)))


def test_clinical_master(master):
    m = {r["hadm_id"]: r for r in master.collect()}
    assert list(next(iter(m.values())).asDict()) == list(clinical.MASTER) and len(m) == 5
    first, tie, last = m[10], m[12], m[13]
    assert (first["num_prev_visits"], first["avg_prev_drg_severity"], first["bmi_last"], first["last_norm_lab"], first["num_prev_diagnoses"], first["avg_prev_ed_los"]) == (0, 0.0, None, None, 0, 0.0)
    assert (first["admission_type"], first["race"], first["age"], first["gender"], m[20]["age"], m[20]["gender"]) == ("other", "white", 51, 1, 30, 0)
    assert (tie["num_prev_visits"], tie["num_prev_diagnoses"], tie["time_since_last_visit_days"], tie["last_los"], tie["ed_los_hours"], tie["race"], tie["target"]) == (2, 2, 0.0, 4.0, None, "hispanic_latino", 1)
    assert (m[11]["ed_los_hours"], m[11]["came_from_ed"], m[11]["bmi_last"], m[11]["weight_last"], m[11]["avg_prev_drg_severity"]) == (4.0, 1, 31.5, 180.0, None)
    assert (m[11]["num_abnormal_labs"], m[11]["abnormal_lab_ratio"], m[11]["last_lab_flag"], m[11]["last_norm_lab"]) == (1, 1.0, 1, 0.5)
    assert (last["num_prev_visits"], last["num_prev_diagnoses"], last["num_unique_diagnoses_icd_codes"], last["avg_prev_drg_severity"], last["max_prev_drg_severity"], last["avg_prev_drg_mortality"]) == (3, 4, 2, 3.0, 4.0, None)
    assert (last["num_abnormal_labs"], last["abnormal_lab_ratio"], last["stat_lab_ratio"], last["last_lab_flag"], last["last_norm_lab"]) == (2, 0.67, 0.67, 1, 0.25)
    assert (last["num_prev_medications"], last["num_unique_drugs"], last["num_prev_transfers"], last["num_prev_icu_visits"], last["num_prev_infections"], last["num_unique_organisms"], last["num_resistant_cases"]) == (2, 1, 3, 1, 2, 1, 1)
    assert (last["bmi_last"], last["last_systolic"], last["last_pulse_pressure"], last["admission_type"], last["marital_status"]) == (None, 120, 40, None, "widowed")
    assert (last["avg_time_between_visits_days"], last["avg_prev_los"], last["max_prev_los"], last["last_los"]) == (5.0, 2.33, 4.0, 1.0)


def test_clinical_model_ready_and_scores(spark, master):
    ready = clinical.model_ready(master)
    assert ready.columns == [*clinical.KEYS, *clinical.NUMERIC, *clinical.CATEGORICAL, "target"]
    with pytest.raises(ValueError):
        clinical.split_tables(ready)  # one subject has a positive
    many = ready.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(9)))).withColumn("subject_id", F.col("subject_id") + F.col("k") * 10).drop("k")
    parts = clinical.split_tables(many)
    assert sum(p.count() for p in parts.values()) == 50
    with pytest.raises(ValueError):
        clinical.split_tables(many.withColumn("admittime", F.lit(None).cast("timestamp_ntz")))
    scored = ready.withColumn("score", F.lit(0.84))
    preds = scoring.predictions(scored, "score", 0.84, {"model_version": "m"})
    assert {r["predicted_label"] for r in preds.collect()} == {1}
    board = scoring.dashboard(ready, preds, ["hadm_id"])
    assert board.columns[0] == "hadm_id" and board.first()["predicted_probability_pct"] == 84.0
    assert scoring.deployment_rows(ready, ready.where("hadm_id < 12")).count() == 2
    with pytest.raises(relational.CardinalityError):
        scoring.deployment_rows(ready, ready.select(F.lit(77).alias("subject_id"), "hadm_id", "admittime"))
    with pytest.raises(contract.SchemaError):
        scoring.check_keys(ready.drop("admittime"), "ready")
    with pytest.raises(contract.SchemaError):
        clinical.model_ready(master.withColumn("gender", F.lit(None).cast("int")))


def test_stream_history_keeps_state_over_batches(spark, sf):
    import glob

    import duckdb

    from chronofold.plans import streams
    from chronofold.session import checkpoint_root

    root = checkpoint_root(spark).removeprefix("file://")
    before = set(glob.glob(f"{root}/chronofold/*/cp/commits"))
    got = rows(streams.stream_history(spark, sf))
    (commits,) = set(glob.glob(f"{root}/chronofold/*/cp/commits")) - before
    assert len(glob.glob(f"{commits}/[0-9]*")) >= 3
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{sf}/events.parquet'")
    assert got == sorted(con.execute(streams.SQL["stream_history"]).fetchall(), key=repr) and len(got) > 0


def test_ml_shap_explains_every_held_row(spark):
    from chronofold.plans import evaluation

    d = "/root/testdata/sf0.01"
    train, held, names = evaluation._model_data(spark, d)
    held = held.select("hadm_id")
    assert len(names) >= 49 and train.count() > held.count()
    got = evaluation.ml_shap(spark, d).select(F.col("id").alias("hadm_id"))
    assert rows(got) == rows(held) and got.count() > 500


def test_scorer_from_raw_tables(spark, day, master, tmp_path):
    ready = clinical.model_ready(master)
    many = ready.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(9)))).withColumn("subject_id", F.col("subject_id") + F.col("k") * 10).drop("k")
    scorer = clinical.train_scorer(many, "tree", metadata={"best_threshold": 0.84, "model_name": "t"})
    assert scorer.threshold == 0.84 and clinical.train_scorer(many, "tree", threshold=0.2, metadata={"best_threshold": 0.84}).threshold == 0.2
    meta = scorer.save(spark, f"{tmp_path}/art")
    loaded = inference.Scorer.load(spark, f"{tmp_path}/art")
    assert meta["trained_model_feature_count"] == len(loaded.features.columns) == 39 + sum(len(v) - 1 for v in loaded.levels.values())
    now = dt.datetime(2025, 1, 1, tzinfo=dt.timezone.utc)
    done = clinical.score_raw(spark, clinical_tables(spark, day), loaded, f"{tmp_path}/run", now)
    want = rows(scorer.predict(ready, now), "hadm_id", "predicted_probability", "predicted_label", "model_version")
    assert rows(done.predictions, "hadm_id", "predicted_probability", "predicted_label", "model_version") == want and len(want) == 5
    assert done.master.count() == done.model_ready.count() == 5
    again = clinical.score_processed(spark, f"{tmp_path}/run/master.parquet", f"{tmp_path}/run/model_ready.parquet", loaded, f"{tmp_path}/p.parquet", now)
    assert rows(again.predictions) == rows(done.predictions)
    odd = ready.withColumn("race", F.lit("martian"))  # a level that training didn't see is all zeros
    assert loaded.score(odd).count() == 5
    with pytest.raises(contract.SchemaError):
        loaded.score(ready.drop("age"))
    with pytest.raises(contract.SchemaError):
        loaded.predict(ready.drop("hadm_id"))
    with pytest.raises(FileNotFoundError):
        inference.Scorer.load(spark, f"{tmp_path}/nothing")


def test_model_input_is_reused_or_rebuilt(spark, tmp_path):
    path, made = f"{tmp_path}/in.parquet", []

    def rebuild():
        made.append(1)
        return spark.createDataFrame([(1, 2, 0)], "subject_id int, age int, target int")

    for want in (1, 1):
        got = inference.model_input(spark, path, ["age", "target"], rebuild, ["subject_id", "target"])
        assert got.columns == ["age"] and len(made) == want
    with pytest.raises(ValueError):
        inference.model_input(spark, path, ["age", "new"], rebuild)
    assert len(made) == 2


def test_mlp_stops_early_and_balances(spark):
    rng = np.random.default_rng(2)
    a = rng.normal(size=(300, 2))
    df = models.Features.fit(d := spark.createDataFrame([(float(x), float(y), int(x + y > 1.2)) for x, y in a], "a double, b double, y int"), ["a", "b"]).apply(d)
    model, losses = models.fit_mlp(df, df, "y", hidden=(4,), epochs=12, patience=2)
    assert models.rank_metrics(models.positive_score(model, df), "y", "score")["roc_auc"] > 0.9 and len(losses) <= 12 and min(losses) <= losses[0]
    assert models.repeated(df, "y", 3.4).where("y = 1").count() == 3 * df.where("y = 1").count()


def test_leaderboard_reranks_and_keeps_to_its_time(spark):
    rng = np.random.default_rng(3)
    df = models.Features.fit(d := spark.createDataFrame([(float(x), int(x > 1)) for x in rng.normal(size=200)], "a double, y int"), ["a"]).apply(d)
    fitted = {}
    board = models.leaderboard(df, df, "y", kinds=("logistic", "tree"), fitted=fitted)
    assert {r["model"] for r in board} == set(fitted) and len(board) == 4 and board[0]["pr_auc"] == max(r["pr_auc"] for r in board)
    assert len(models.rerank(board, fitted, df, "y", 2)) == 2
    assert len(models.leaderboard(df, df, "y", kinds=("logistic", "tree"), seconds=0)) == 1


def test_smote_tomek_and_context(spark):
    pts = [(i, [float(i % 7), float(i)], 0) for i in range(20)] + [(100 + i, [float(i), 30.0 + i], 1) for i in range(6)] + [(200, [5.1, 19.05], 1), (300, None, 1)]
    df = spark.createDataFrame(pts, "i int, v array<double>, l int")
    out = {r["id"]: r for r in neighbors.smote_tomek(df, "i", "v", "l", 1, k=2, copies=3).collect()}
    links = rows(neighbors.tomek_links(df, "i", "v", "l"))
    assert sum("#" in i for i in out) >= 15 and "300" not in out and links
    assert all(r["label"] == 1 for i, r in out.items() if "#" in i)
    scored = dict(rows(neighbors.context_scores(df, df, "i", "v", "l", k=3, chunk=4)))
    assert len(scored) == 27 and all(0 <= x <= 1 for x in scored.values()) and scored[103] > 0.9 > 0.1 > scored[2]
    assert neighbors.context_scores(df.limit(0), df, "i", "v", "l").count() == 0
