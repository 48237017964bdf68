"""The dealt operators: time shards against no shards, brute force on small frames, edge cases."""

import random

import pytest
from helpers import rows
from pyspark.sql import functions as F

from chronofold.operators import asof, eager, entity_features, fill, intervals, orphans, skew

STAYS = "subject_id int, hadm_id int, admittime timestamp_ntz, v double, c string"


def stays(spark, day, n=400, seed=3):
    r = random.Random(seed)
    data = [(1 if r.random() < 0.4 else r.randrange(2, 30) if r.random() > 0.02 else None, i, day(r.randrange(300), r.randrange(3)) if r.random() > 0.02 else None, r.choice([None, float("nan"), 500.0, *(round(r.uniform(10, 90), 1) for _ in range(5))]), r.choice([None, "", " a ", "b", "Unknown"])) for i in range(n)]
    return spark.createDataFrame(data, STAYS), data


def test_time_shards_keep_instants_whole(spark, day):
    df, data = stays(spark, day)
    cut = skew.with_shards(df, skew.time_shards(df, "subject_id", "admittime", floor=20, parts=50), "subject_id", "admittime").collect()
    hot = [r for r in cut if r["__hot"] and r["admittime"] is not None]
    assert len(cut) == len(data) and {r["subject_id"] for r in hot} == {1}
    by = {}
    for r in hot:
        by.setdefault(r["admittime"], set()).add(r["__shard"])
    assert all(len(s) == 1 for s in by.values()) and len({r["__shard"] for r in hot}) > 3
    order = [r["__shard"] for r in sorted(hot, key=lambda r: r["admittime"])]
    assert order == sorted(order)


def test_bursts_are_cut_again(spark, day):
    """Half of an entity's rows in one second of ten years, a quarter of all at one instant: no shard but the instant's has more than about two parts."""
    import datetime as dt

    burst = [(1, day(1000) + dt.timedelta(microseconds=137 * i)) for i in range(2000)]
    spread = [(1, day(2 * i)) for i in range(1800)]
    data = burst + spread + [(1, day(2001))] * 1000 + [(k, day(k)) for k in range(2, 400)]
    df = spark.createDataFrame(data, "e int, t timestamp_ntz")
    shards = skew.time_shards(df, "e", "t", floor=50, parts=50)
    assert shards.depth >= 2
    cut = [r for r in skew.with_shards(df, shards, "e", "t").collect() if r["__hot"]]
    assert len(cut) == 4800
    order = [r["__shard"] for r in sorted(cut, key=lambda r: r["t"])]
    assert order == sorted(order)
    sizes = {}
    for r in cut:
        sizes.setdefault(r["__shard"], set()).add(r["t"])
    part = max(50, -(-len(data) // 50), min(8 * len(data) // 399, -(-len(data) // 16)))
    assert max(len(x) for x in sizes.values()) <= 2 * part


@pytest.mark.parametrize("small", [dict(floor=10, parts=40), {}])
def test_fill_against_brute_force(spark, day, small):
    df, data = stays(spark, day)
    got = {r["hadm_id"]: r for r in fill.fill_along_time(df, "subject_id", "admittime", "hadm_id", {"v": (10, 100)}, {"c": 20.0}, **small).collect()}
    assert len(got) == len(data)
    ok = lambda v: v is not None and v == v and 10 <= v <= 100
    text = lambda c: c is not None and c.strip().lower() not in ("", "unknown")
    for s, h, t, v, c in data:
        g = got[h]
        line = sorted((x for x in data if s is not None and x[0] == s and x[2] is not None), key=lambda x: (x[2], x[1]))
        a = next((x for x in reversed(line) if t and (x[2], x[1]) < (t, h) and ok(x[3])), None)
        b = next((x for x in line if t and (x[2], x[1]) > (t, h) and ok(x[3])), None)
        if ok(v):
            assert (g["v_method"], g["v_filled"], g["v_days"]) == ("observed", v, 0)
        elif a and b:
            da, db = (t - a[2]).total_seconds(), (b[2] - t).total_seconds()
            want = (a[3] + b[3]) / 2 if da + db == 0 else a[3] + (b[3] - a[3]) * da / (da + db)
            assert g["v_method"] == "interpolated" and g["v_filled"] == pytest.approx(want) and g["v_days"] == pytest.approx(min(da, db) / 86400)
        elif a or b:
            assert g["v_method"] == "carried" and g["v_filled"] == (a or b)[3]
        else:
            assert g["v_method"] in ("same_time", "near_time", "overall") and g["v_filled"] is not None
        a = next((x for x in reversed(line) if t and (x[2], x[1]) < (t, h) and text(x[4])), None)
        b = next((x for x in line if t and (x[2], x[1]) > (t, h) and text(x[4])), None)
        near = next((x for x in (a, b) if x and abs((t - x[2]).total_seconds()) <= 20 * 86400), None)
        assert g["c_filled"] == (c.strip() if text(c) else near and near[4].strip())
        assert g["c_method"] == ("observed" if text(c) else "carried" if near else "none")


def test_fill_empty_table_and_no_reading(spark, day):
    none = spark.createDataFrame([(1, 1, day(0), None, None)], STAYS)
    assert rows(fill.fill_along_time(none, "subject_id", "admittime", "hadm_id", {"v": (1, 2)}), "v_filled", "v_method") == [(None, "none")]
    assert fill.fill_along_time(none.limit(0), "subject_id", "admittime", "hadm_id", {"v": (1, 2)}, {"c": 1}).count() == 0


@pytest.mark.parametrize("small", [dict(floor=10, parts=40), {}])
def test_asof_against_brute_force(spark, day, small):
    df, data = stays(spark, day)
    facts, fdata = stays(spark, day, 500, 8)
    events = df.withColumnRenamed("c", "__shard")  # a name of our own
    got = {r["hadm_id"]: r for r in asof.asof_state(events, [asof.Fact(facts, "admittime", {"n": ("count", None), "s": ("max", "v"), "l": ("last", "c")}, order=("hadm_id",)), asof.Fact(facts, "admittime", {"m": ("count", None), "lo": ("min", "hadm_id")}, tie="hadm_id"), asof.Fact(facts, "admittime", {"i": ("count", "c")}, inclusive=True)], "subject_id", "admittime", "hadm_id", **small).collect()}
    assert len(got) == len(data) and "__shard" in next(iter(got.values())).asDict()
    for s, h, t, _, _ in data:
        of = [x for x in fdata if s is not None and t is not None and x[0] == s and x[2] is not None]
        strict = [x for x in of if x[2] < t]
        tied = [x for x in of if (x[2], x[1]) < (t, h)]
        g = got[h]
        assert (g["n"], g["m"], g["i"]) == (len(strict), len(tied), sum(x[4] is not None for x in of if x[2] <= t))
        assert g["lo"] == min((x[1] for x in tied), default=None)
        assert g["l"] == (max(strict, key=lambda x: (x[2], x[1]))[4] if strict else None)


def test_asof_empty_facts(spark, day):
    df, data = stays(spark, day, 5)
    assert {r["n"] for r in asof.asof_state(df, [asof.Fact(df.limit(0), "admittime", {"n": ("count", None)})], "subject_id", "admittime").collect()} == {0}


def test_mismatches(spark):
    df = spark.createDataFrame([(1, 1.0, 1.01), (2, 1.0, 1.03), (3, None, 0.0), (4, None, None), (5, float("nan"), None)], "id int, a double, b double")
    assert rows(asof.mismatches(df, {"a": "b"}, "id")) == [(2, "a"), (3, "a")]


def test_eager_equals_join_then_aggregate(spark):
    r = random.Random(1)
    left = spark.createDataFrame([(r.choice([1, 1, 1, 2, 3, None]), r.choice("ab"), r.choice([None, float("nan"), 1.0, 2.5])) for _ in range(300)], "k int, g string, x double")
    right = spark.createDataFrame([(r.choice([1, 2, 4, None]), r.choice(["u", "v", None]), r.randrange(9)) for _ in range(50)], "k int, h string, y int")
    aggs = {"n": ("count", "left", None), "nx": ("count", "left", "x"), "sx": ("sum", "left", "x"), "ax": ("avg", "left", "x"), "mx": ("max", "left", "x"), "sy": ("sum", "right", "y"), "ny": ("count", "right", "y"), "my": ("min", "right", "y")}
    left.createOrReplaceTempView("l"), right.createOrReplaceTempView("r")
    for how in ("inner", "left"):
        for by in (["g", "h"], ["k"], ["h"]):
            got = eager.eager_join_aggregate(left, right, ["k"], by, aggs, how)
            cols = ", ".join("l.k" if c == "k" else c for c in by)
            want = spark.sql(f"SELECT {cols}, count(*) n, count(x) nx, sum(x) sx, avg(x) ax, max(x) mx, sum(y) sy, count(y) ny, min(y) my FROM (SELECT k, g, nanvl(x, null) x FROM l) l {how} JOIN r ON l.k = r.k GROUP BY {cols}")
            assert rows(got) == rows(want), (how, by)
    assert eager.eager_join_aggregate(left.limit(0), right, ["k"], ["k"], aggs).count() == 0
    shares = eager.with_share(left.groupBy("g").agg({"*": "count"}).withColumnRenamed("count(1)", "n"), "n", "share").collect()
    assert sum(x["share"] for x in shares) == pytest.approx(1)


def test_salted_join(spark):
    left = spark.createDataFrame([(1 if i % 3 else i, i) for i in range(300)] + [(None, 999)], "k int, a int")
    right = spark.createDataFrame([(1, "x"), (1, "y"), (3, "z"), (None, "n")], "k int, b string")
    for how in ("inner", "left", "left_semi", "left_anti"):
        assert rows(skew.salted_join(left, right, ["k"], how, floor=10, parts=10)) == rows(left.join(right, ["k"], how)), how


def test_distributed_rank(spark):
    from pyspark.sql import Window

    df = spark.createDataFrame([(g, i) for i in range(500) for g in ("a", None)] + [("b", 1), ("b", 1)], "g string, i int")
    text = F.md5(F.col("i").cast("string"))
    got = skew.distributed_rank(df, ["g"], text, ["i"], "rk", total="n")
    w = Window.partitionBy("g")
    assert rows(got, "g", "i", "rk", "n") == rows(df.withColumn("rk", F.row_number().over(w.orderBy(text, "i"))).withColumn("n", F.count("*").over(w)), "g", "i", "rk", "n")


def test_orphans(spark, day):
    kids = spark.createDataFrame([(1, day(0)), (1, day(40)), (1, day(40)), (2, day(0)), (3, day(5)), (3, day(5)), (4, None), (None, day(0)), (5, None)], "k int, loaded_at timestamp_ntz")
    parents = spark.createDataFrame([(1, day(10)), (1, day(90)), (4, day(1)), (None, day(1))], "p int, loaded_at timestamp_ntz")
    removed = spark.createDataFrame([("par", 2, day(1)), ("par", 1, day(1)), ("other", 3, day(1)), (None, None, None)], "parent_table string, key_id int, removed_at timestamp_ntz")
    refs = [orphans.Reference("kids", kids, "k", "par", parents, "p")]
    found = orphans.orphan_references(refs, removed)
    assert rows(found.drop("had_parent")) == sorted([("kids", 1, "2020-01", "late", 1), ("kids", 2, "2020-01", "deleted", 1), ("kids", 3, "2020-01", "missing", 2), ("kids", 5, None, "missing", 1)], key=repr)
    assert rows(found.where("had_parent"), "key_id") == [(2,)]
    wide = kids.select((F.col("k") + 5_000_000_000).alias("k"), "loaded_at")
    assert {r["key_id"] for r in orphans.orphan_references([orphans.Reference("kids", wide, "k", "par", parents, "p")], removed).collect()} == {5_000_000_000 + i for i in range(1, 6)}
    assert rows(orphans.orphan_report(found).where("reason = 'missing'"), "load_month", "n_keys", "n_rows") == [("2020-01", 1, 2), (None, 1, 1)]
    assert orphans.orphan_references([orphans.Reference("kids", kids.limit(0), "k", "par", parents, "p")], removed).count() == 0


@pytest.mark.parametrize("small", [dict(floor=10, parts=40), {}])
def test_sweep_against_brute_force(spark, day, small):
    r = random.Random(5)
    data = []
    for i in range(300):
        a = r.randrange(0, 2000)
        data.append((1 if r.random() < 0.4 else r.choice([None, *range(2, 20)]), i // 2, day(0, a), r.choice([None, day(0, a), day(0, a - 1), *(day(0, a + r.randrange(1, 12)) for _ in range(8))])))
    df = spark.createDataFrame(data + data[:20], "e int, m int, a timestamp_ntz, b timestamp_ntz")
    periods = intervals.sweep_periods(df, "e", "a", "b", "m", **small)
    want, holes = [], []
    for e in {x[0] for x in data} - {None}:
        cur = None
        for a, b, m in sorted((x[2], x[3], x[1]) for x in data if x[0] == e and x[3] and x[3] > x[2]):
            if cur and a <= cur[1]:
                cur[1], cur[2] = max(cur[1], b), cur[2] | {m}
            else:
                if cur:
                    want.append((e, *cur)), holes.append((e, cur[1], a))
                cur = [a, b, {m}]
        want.append((e, *cur))
    assert rows(periods, "e", "period_start", "period_end", "first_member", "last_member") == sorted([(e, a, b, min(m), max(m)) for e, a, b, m in want], key=repr)
    assert rows(intervals.gaps(periods, "e")) == sorted(holes, key=repr)
    assert intervals.sweep_periods(df.limit(0), "e", "a", "b", "m").count() == 0


def test_features_against_brute_force(spark, day):
    r = random.Random(2)
    data = [(r.choice([1, 1, 2, 3, None]), r.choice(["x", "y", None]), day(r.randrange(60), r.randrange(24)) if r.random() > 0.05 else None, r.choice([None, float("nan"), 1.5, 2.0])) for _ in range(300)]
    events = spark.createDataFrame(data, "e int, kind string, at timestamp_ntz, v double")
    probes = spark.createDataFrame([(1, day(40, 12)), (2, day(20)), (3, None), (9, day(1))], "e int, t timestamp_ntz")
    store = entity_features.cumulative_store(events, "e", "kind", "at", "v")
    counts = entity_features.window_counts(store, probes, "e", "t", [10])
    got = {x["e"]: x["features"] for x in entity_features.as_maps(counts, probes, "e").collect()}
    assert got[9] == {} and got[3] == {}
    for e, t in ((1, day(40, 12)), (2, day(20))):
        for kind in "xy":
            upto = [x for x in data if x[0] == e and x[1] == kind and x[2] and x[2].date() < t.date()]
            win = [x for x in upto if x[2] >= day((t - day(0)).days - 10)]
            add = lambda xs: sum(x[3] for x in xs if x[3] is not None and x[3] == x[3])
            f = got[e][kind]
            assert (f["n"], f["total"], f["n_10d"], f["total_10d"]) == (len(upto), add(upto), len(win), add(win))
            assert f["recency_days"] == pytest.approx((t - max(x[2] for x in upto)).total_seconds() / 86400)
    flat = entity_features.as_columns(counts, probes, "e", ["x", "nothing"]).where("e = 9").first()
    assert (flat["x__n"], flat["nothing__total"], flat["x__recency_days"]) == (0, 0.0, None)


def test_features_do_not_look_ahead_within_the_day(spark, day):
    events = spark.createDataFrame([(1, "x", day(0, 9), 1.0), (1, "x", day(1, 9), 1.0), (1, "x", day(1, 23), 1.0)], "e int, kind string, at timestamp_ntz, v double")
    probes = spark.createDataFrame([(1, day(1, 12))], "e int, t timestamp_ntz")
    for grain, want in (("day", (1, 1.125)), ("instant", (2, 0.125))):
        store = entity_features.cumulative_store(events, "e", "kind", "at", "v", grain=grain)
        assert rows(entity_features.window_counts(store, probes, "e", "t", [], grain=grain), "n", "recency_days") == [want]


@pytest.mark.parametrize("small", [dict(floor=10, parts=40), {}])
def test_store_by_instant_equals_plain_sums(spark, day, small):
    df, data = stays(spark, day)
    store = entity_features.cumulative_store(df.withColumn("kind", F.lit("k")), "subject_id", "kind", "admittime", "v", grain="instant", **small)
    known = [(s, t, v) for s, _, t, v, _ in data if s is not None and t is not None]
    for r in store.collect():
        of = [x for x in known if x[0] == r["subject_id"] and x[1] <= r["slot"]]
        assert (r["cum_n"], r["last_time"]) == (len(of), max(x[1] for x in of))
        assert r["cum_total"] == pytest.approx(sum(v for _, _, v in of if v is not None and v == v))


def test_normal_code(spark):
    df = spark.createDataFrame([(" k03.4 ",), ("K034",), (".",), ("  ",), (None,)], "c string")
    assert [r[0] for r in df.select(entity_features.normal_code(df.c)).collect()] == ["K034", "K034", None, None, None]
