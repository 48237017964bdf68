"""One row per entity from events of hundreds of types: a store of cumulative counts and totals, read by subtraction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronofold.operators.asof import Fact, asof_state
from chronofold.operators.skew import PARTS, SHARD_ROWS, carried_in, time_shards, with_shards
from chronofold.session import materialize


def normal_code(col: Column) -> Column:
    """A code without case, dots and outer blanks; null if nothing is left."""
    text = F.regexp_replace(F.upper(F.regexp_replace(col, r"^\s+|\s+$", "")), r"\.", "")
    return F.when(F.trim(text) != "", F.trim(text))


def cumulative_store(events: DataFrame, entity: str, kind: str, time: str, value: str, *, grain: str = "day", floor: int = SHARD_ROWS, parts: int = PARTS) -> DataFrame:
    """(entity, type, slot, cum_n, cum_total, last_time): for each entity, type and day with events, what there was up to its end.

    ``grain`` may be any unit of date_trunc, or ``instant``. Events without entity, type or time are left out; null and NaN
    values count as events but add nothing. The events are added up by slot before the cumulative sum, so with a calendar grain an entity has no more rows than
    types times days, whatever its events, and stays whole; the time line of an entity and type by ``instant`` has no such bound and is cut in time shards with carried-in sums.
    """
    slot = F.col(time) if grain == "instant" else F.date_trunc(grain, time).cast("timestamp_ntz")
    v = F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double"))
    daily = events.where(F.col(entity).isNotNull() & F.col(kind).isNotNull() & F.col(time).isNotNull()).groupBy(entity, F.col(kind).alias("type"), slot.alias("slot")).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(v), F.lit(0.0)).alias("total"), F.max(time).alias("last_time"))
    if grain != "instant":
        # By entity alone: the join with the probes and the sums per entity and type then need no further shuffle.
        upto = Window.partitionBy(entity, "type").orderBy("slot").rowsBetween(Window.unboundedPreceding, 0)
        return daily.repartition(entity).select(entity, "type", "slot", F.sum("n").over(upto).alias("cum_n"), F.sum("total").over(upto).alias("cum_total"), F.max("last_time").over(upto).alias("last_time"))
    keyed = daily.withColumn("__key", F.struct(entity, "type"))
    shards = time_shards(keyed, "__key", "slot", floor=floor, parts=parts)
    cut = with_shards(keyed, shards, "__key", "slot")
    upto = Window.partitionBy("__key", "__shard").orderBy("slot").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("__key").orderBy("__shard").rowsBetween(Window.unboundedPreceding, -1)
    carry = cut.where(F.col("__hot")).groupBy("__key", "__shard").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.max("last_time").alias("at")).select("__key", "__shard", *[f(c).over(before).alias(f"__c_{c}") for f, c in ((F.sum, "n"), (F.sum, "total"), (F.max, "at"))])
    local = cut.select("__key", "__shard", entity, "type", "slot", F.sum("n").over(upto).alias("__n"), F.sum("total").over(upto).alias("__total"), F.max("last_time").over(upto).alias("__at"))
    summed = carried_in(local, shards, carry, "__key")
    return summed.select(entity, "type", "slot", (F.col("__n") + F.coalesce("__c_n", F.lit(0))).alias("cum_n"), (F.col("__total") + F.coalesce("__c_total", F.lit(0.0))).alias("cum_total"), F.greatest("__at", "__c_at").alias("last_time"))


def window_counts(store: DataFrame, probes: DataFrame, entity: str, at: str, windows_days: Sequence[int], *, grain: str = "day", decimals: int = 8) -> DataFrame:
    """(entity, type, n, total, recency_days, n_<w>d and total_<w>d of each window): what the store knew of each type of the probe's entity.

    Only slots that are over at ``at`` count: with grain ``day`` everything before the day of ``at``, never a later event of that day; a probe at
    midnight sees all of the day before. A window of w days is the store at that end less the store w days before it; recency is from the last
    event seen to ``at``. ``grain`` is the store's. Probes must have one row per entity; those without a time, and types without events, give no row.
    """
    end_at = F.col("__at") if grain == "instant" else F.date_trunc(grain, "__at").cast("timestamp_ntz")
    asked = probes.where(F.col(at).isNotNull()).select(F.col(entity), F.col(at).alias("__at")).withColumn("__end_at", end_at)
    seen = store.join(asked, entity).where(F.col("slot") < F.col("__end_at"))
    point = F.struct("slot", "cum_n", "cum_total", "last_time")
    ends = [F.max(point).alias("__end"), *[F.max(F.when(F.col("slot") < F.expr(f"__end_at - interval {int(w)} days"), point)).alias(f"__w{w}") for w in windows_days]]
    by_type = seen.groupBy(entity, "type", "__at").agg(*ends)
    end = F.col("__end")
    less = lambda w, c: end[c] - F.coalesce(F.col(f"__w{w}")[c], F.lit(0))
    cells = [end["cum_n"].alias("n"), F.round(end["cum_total"], decimals).alias("total"), F.round(F.timestamp_diff("SECOND", end["last_time"], F.col("__at")) / 86400, decimals).alias("recency_days")]
    for w in windows_days:
        cells += [less(w, "cum_n").alias(f"n_{w}d"), F.round(less(w, "cum_total"), decimals).alias(f"total_{w}d")]
    return by_type.select(entity, "type", *cells)


def as_maps(counts: DataFrame, probes: DataFrame, entity: str) -> DataFrame:
    """One row per probe: its columns and ``features``, a map from type to the figures of window_counts(); empty without events. The map holds only the types an entity has."""
    cells = [c for c in counts.columns if c not in (entity, "type")]
    maps = counts.groupBy(entity).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col("type"), F.struct(*cells))))).alias("features"))
    shape = next(f.dataType.simpleString() for f in maps.schema if f.name == "features")
    return probes.drop("features").join(maps, entity, "left").withColumn("features", F.coalesce("features", F.map_from_arrays(F.array(), F.array()).cast(shape)))


def as_columns(counts: DataFrame, probes: DataFrame, entity: str, types: Sequence[str]) -> DataFrame:
    """One row per probe: its columns and ``<type>__n``, ``<type>__total`` and ``<type>__recency_days`` for the given types; 0, 0 and null without events."""
    cells = [(t, c) for t in types for c in ("n", "total", "recency_days")]
    of = counts.where(F.col("type").isin(*types)).groupBy(entity).agg(*[F.max(F.when(F.col("type") == t, F.col(c))).alias(f"{t}__{c}") for t, c in cells])
    zero = {"n": F.lit(0), "total": F.lit(0.0)}
    return probes.join(of, entity, "left").select(*probes.columns, *[(F.coalesce(f"{t}__{c}", zero[c]) if c in zero else F.col(f"{t}__{c}")).alias(f"{t}__{c}") for t, c in cells])


def asof_counts(store: DataFrame, probes: DataFrame, entity: str, at: str, kind: str, out_n: str, out_total: str) -> DataFrame:
    """Probes (any number per entity) with the count and total of one type strictly before ``at``: the store's last slot before it.

    The store must have the grain ``instant``. The read is an as-of merge, whose hot entities are cut in time.
    """
    of = store.where(F.col("type") == kind)
    facts = [Fact(of, "slot", {out_n: ("last", "cum_n"), out_total: ("last", "cum_total")})]
    read = asof_state(probes, facts, entity, at)
    return read.withColumns({out_n: F.coalesce(out_n, F.lit(0)), out_total: F.coalesce(out_total, F.lit(0.0))})


def stays_of(admissions: DataFrame) -> DataFrame:
    """One row per hadm_id."""
    return admissions.groupBy("hadm_id").agg(F.min("subject_id").alias("subject_id"), F.min("admittime").alias("admittime"), F.max("dischtime").alias("dischtime"))


def clinical_events(labevents: DataFrame, drgcodes: DataFrame, diagnoses: DataFrame) -> DataFrame:
    """(hadm_id, type, at, value) of the stays' lab results, DRG codings and diagnosis codes."""
    flag = F.coalesce(F.lower(F.trim("flag")), F.lit(""))
    lab = F.concat(F.lit("lab_"), F.when(flag.isin("abnormal", "high", "low", "h", "l", "hh", "ll", "a"), "abnormal").otherwise("normal"), F.when(F.lower("priority").contains("stat"), "_stat").otherwise("_routine"))
    labs = labevents.where(F.col("hadm_id").isNotNull()).select("hadm_id", lab.alias("type"), F.col("charttime").alias("at"), F.col("valuenum").alias("value"))
    drg = drgcodes.groupBy("hadm_id", "drg_severity", "drg_mortality").agg(F.min("loaded_at").alias("at")).where(F.col("drg_severity").isNotNull()).select("hadm_id", F.concat(F.lit("drg_severity_"), F.col("drg_severity").cast("int").cast("string")).alias("type"), "at", F.col("drg_severity").alias("value"))
    code = normal_code(F.col("icd_code"))
    dx = diagnoses.where(F.col("hadm_id").isNotNull() & code.isNotNull()).groupBy("hadm_id", F.concat(F.lit("dx_"), code).alias("type")).agg(F.min("loaded_at").alias("at")).select("hadm_id", "type", "at", F.lit(1.0).alias("value"))
    return labs.unionByName(drg).unionByName(dx)


def prior_diagnoses(master: DataFrame, admissions: DataFrame, diagnoses: DataFrame) -> DataFrame:
    """Master rows with ``known_num_prev_diagnoses``: distinct codes of each of the subject's strictly earlier stays, added up."""
    code = normal_code(F.col("icd_code"))
    per_stay = diagnoses.where(F.col("hadm_id").isNotNull()).select("hadm_id", code.alias("code")).where(F.col("code").isNotNull()).distinct()
    # The store reads its input once to find hot subjects and again to cut them; what aggregates and joins made is written once.
    events = materialize(per_stay.groupBy("hadm_id").agg(F.count(F.lit(1)).alias("n_codes")).join(stays_of(admissions), "hadm_id").select("subject_id", F.lit("dx").alias("type"), "admittime", "n_codes"))
    store = cumulative_store(events, "subject_id", "type", "admittime", "n_codes", grain="instant")
    read = asof_counts(store, master, "subject_id", "admittime", "dx", "__n", "known_num_prev_diagnoses")
    return read.drop("__n").withColumn("known_num_prev_diagnoses", F.col("known_num_prev_diagnoses").cast("long"))
