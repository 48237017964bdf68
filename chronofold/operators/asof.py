"""Attributes as known at event time: an as-of merge of events with timed facts.

Events and facts of an entity are laid on one timeline. Hot entities are cut in time shards; each
shard starts from the state left by the shards before it (its carry-in), so shards are merged
independently and the result is the same as that of one merge over the whole entity.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronofold.operators.skew import PARTS, SHARD_ROWS, carried_in, time_shards, with_shards
from chronofold.session import materialize


@dataclass(frozen=True)
class Fact:
    """Facts that become known at ``time``.

    ``states`` maps an output to (aggregate, column): count, sum, min, max (nulls don't count) or
    last (the latest fact's own value, null included). At the event's own instant a fact counts if
    ``inclusive``, or, given ``tie``, if its tie value is below the event's; otherwise it doesn't.
    """

    df: DataFrame
    time: str
    states: dict[str, tuple[str, str | None]] = field(default_factory=dict)
    tie: str | None = None
    inclusive: bool = False
    order: tuple[str, ...] = ()


def asof_state(events: DataFrame, facts: Sequence[Fact], entity: str, event_time: str, event_tie: str | None = None, *, floor: int = SHARD_ROWS, parts: int = PARTS) -> DataFrame:
    """Every row of ``events`` with the state its entity's earlier facts leave at that moment.

    Count is 0 without a fact, the other aggregates are null. Events without an entity or a time
    know no fact; facts without either are ignored. Repeated events come out once each. A state of
    an event column's name replaces that column. ``last`` breaks ties at an instant by ``order``.
    """
    spark_states = {out: spec for f in facts for out, spec in f.states.items()}
    kept = [c for c in events.columns if c not in spark_states]
    tie_type = dict(events.dtypes)[event_tie] if event_tie else "int"
    no_tie = F.lit(None).cast(tie_type)
    pieces = [
        events.select(
            F.col(entity).alias("__e"), F.col(event_time).alias("__t"), F.lit(0).alias("__rank"), (F.col(event_tie) if event_tie else no_tie).alias("__tie"), F.lit(0).alias("__kind"),
            F.struct(*[F.col(c) for c in kept]).alias("__ev"),
        )
    ]
    for f in facts:
        values = []
        for out, (agg, col) in f.states.items():
            value = F.lit(1).cast("long") if agg == "count" and col is None else F.when(F.col(col).isNotNull(), F.lit(1).cast("long")) if agg == "count" else F.col(col)
            values.append((F.struct(F.col(f.time).alias("t"), *[F.col(c).alias(f"o{i}") for i, c in enumerate(f.order)], value.alias("v")) if agg == "last" else value).alias(f"__s_{out}"))
        rank = -1 if f.inclusive else 0 if f.tie else 1
        pieces.append(f.df.where(F.col(entity).isNotNull() & F.col(f.time).isNotNull()).select(F.col(entity).alias("__e"), F.col(f.time).alias("__t"), F.lit(rank).alias("__rank"), (F.col(f.tie).cast(tie_type) if f.tie else no_tie).alias("__tie"), F.lit(1).alias("__kind"), *values))
    # One layout for all parts before they are put together: aligning them one by one would wrap the plan once more for every part.
    layout = {f.name: f.dataType for piece in pieces for f in piece.schema.fields}
    pieces = [piece.select(*[F.col(c) if c in piece.columns else F.lit(None).cast(kind).alias(c) for c, kind in layout.items()]) for piece in pieces]
    known = pieces[1] if len(pieces) > 1 else pieces[0].limit(0)
    for piece in pieces[2:]:
        known = known.union(piece)
    # The facts are read four times: to find hot entities, to cut them, to merge, to carry states in. What made them (joins, first occurrences) runs once.
    known = materialize(known)
    timeline = pieces[0].union(known)
    points = timeline.select("__e", "__t")
    shards = time_shards(points, "__e", "__t", floor=floor, parts=parts)
    cut = with_shards(timeline, shards, "__e", "__t")
    order = ["__t", "__rank", "__tie", "__kind"]
    earlier = Window.partitionBy("__e", "__shard").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = cut.select("__e", "__shard", "__kind", "__ev", *[_fold(agg, F.col(f"__s_{out}"), earlier).alias(f"__l_{out}") for out, (agg, _) in spark_states.items()]).where(F.col("__kind") == 0)
    carried = with_shards(known, shards, "__e", "__t").where(F.col("__hot")).groupBy("__e", "__shard").agg(*[_fold(agg, F.col(f"__s_{out}")).alias(f"__s_{out}") for out, (agg, _) in spark_states.items()])
    shards_before = Window.partitionBy("__e").orderBy("__shard").rowsBetween(Window.unboundedPreceding, -1)
    carried = carried.select("__e", "__shard", *[_fold(agg, F.col(f"__s_{out}"), shards_before).alias(f"__c_{out}") for out, (agg, _) in spark_states.items()])
    merged = carried_in(local, shards, carried, "__e")
    return merged.select(*[F.col("__ev")[c].alias(c) for c in kept], *[_merge(agg, F.col(f"__c_{out}"), F.col(f"__l_{out}")).alias(out) for out, (agg, _) in spark_states.items()])


def _fold(agg: str, col: Column, window: Window | None = None) -> Column:
    """The aggregate of partial states; ``last`` is the greatest (time, order, value)."""
    out = F.sum(col) if agg in ("count", "sum") else F.min(col) if agg == "min" else F.max(col)
    return out.over(window) if window is not None else out


def _merge(agg: str, carry: Column, local: Column) -> Column:
    if agg == "count":
        return F.coalesce(carry, F.lit(0)) + F.coalesce(local, F.lit(0))
    if agg == "sum":
        return F.when(carry.isNull(), local).when(local.isNull(), carry).otherwise(carry + local)
    if agg == "min":
        return F.least(carry, local)
    if agg == "max":
        return F.greatest(carry, local)
    return F.greatest(carry, local)["v"]


def first_loaded(df: DataFrame, keys: Sequence[str], loaded: str = "loaded_at") -> DataFrame:
    """Rows sent again count once, from their first delivery: distinct ``keys`` (nulls equal) with the least ``loaded``."""
    return df.groupBy(*keys).agg(F.min(loaded).alias(loaded))


def known_at_admission(events: DataFrame, admissions: DataFrame, drgcodes: DataFrame, **sharding: int) -> DataFrame:
    """Events with ``known_num_prev_visits`` and ``known_avg_prev_drg_mortality`` as of their admittime.

    Visits are the distinct hadm_id before the event by (admittime, hadm_id); the mean is over DRG
    rows delivered strictly earlier, 0 without a strictly earlier admittime, null if none is known.
    """
    stays = admissions.groupBy("hadm_id").agg(F.min("subject_id").alias("subject_id"), F.min("admittime").alias("admittime"))
    codings = first_loaded(drgcodes.withColumn("drg_mortality", F.nanvl("drg_mortality", F.lit(None).cast("double"))), ["subject_id", "hadm_id", "drg_severity", "drg_mortality"])
    facts = [
        Fact(stays, "admittime", {"known_num_prev_visits": ("count", None), "__first_stay": ("min", "admittime")}, tie="hadm_id"),
        Fact(codings, "loaded_at", {"__sum": ("sum", "drg_mortality"), "__n": ("count", "drg_mortality")}),
    ]
    known = asof_state(events, facts, "subject_id", "admittime", "hadm_id", **sharding)
    mean = F.when(F.col("__first_stay").isNull() | (F.col("__first_stay") >= F.col("admittime")), F.lit(0.0)).when(F.col("__n") > 0, F.col("__sum") / F.col("__n"))
    return known.withColumn("known_avg_prev_drg_mortality", mean).drop("__first_stay", "__sum", "__n")


def mismatches(df: DataFrame, pairs: dict[str, str], id_col: str, *, tolerance: float = 0.02) -> DataFrame:
    """(id, field) of stored values that differ from the known ones by more than ``tolerance`` or are null on one side only. NaN counts as null."""
    cases = []
    for stored, known in pairs.items():
        a, b = (F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in (stored, known))
        wrong = (a.isNull() != b.isNull()) | F.coalesce(F.abs(a - b) > tolerance, F.lit(False))
        cases.append(F.when(wrong, F.lit(stored)))
    return df.select(id_col, F.explode(F.array_compact(F.array(*cases))).alias("field")).distinct()
