"""Merging overlapping intervals and listing the gaps: one sweep over boundaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronofold.operators.skew import PARTS, SHARD_ROWS, carried_in, time_shards, with_shards
from chronofold.session import materialize


def sweep_periods(intervals: DataFrame, entity: str, start: str, end: str, member: str, *, floor: int = SHARD_ROWS, parts: int = PARTS) -> DataFrame:
    """(entity, period_no, period_start, period_end, first_member, last_member, gap_end): the continuous periods of each entity and the end of the gap behind each.

    Every interval becomes a plus and a minus boundary. Where the prefix sum of an entity's boundaries leaves 0 a period starts, where it returns to 0 the period ends
    and a gap opens, up to the entity's next boundary (null behind the last period). Plus comes before minus at
    an instant, so touching intervals join. A hot entity is cut in time shards, each of which starts from the open intervals and the periods begun in the shards
    before it and closes its last gap with the first boundary of the next; its equal boundaries are added up first. Periods of a shard need no further shuffle; only those of hot entities meet across shards.
    Intervals without an entity or an end, or whose end isn't after the start, are left out. Members are the least and
    greatest ``member`` with an interval in the period (null members don't count): they differ if there are two or more.
    """
    clean = intervals.where(F.col(entity).isNotNull() & (F.col(end) > F.col(start))).select(F.col(entity).alias("__e"), F.col(start).alias("__a"), F.col(end).alias("__b"), F.col(member).alias("__m"))
    sides = F.array(F.struct(F.col("__a").alias("t"), F.lit(1).cast("long").alias("d"), F.col("__m").alias("m")), F.struct(F.col("__b").alias("t"), F.lit(-1).cast("long").alias("d"), F.lit(None).cast(dict(clean.dtypes)["__m"]).alias("m")))
    bounds = clean.select("__e", F.explode(sides).alias("x")).select("__e", F.col("x.t").alias("__t"), F.col("x.d").alias("__d"), F.col("x.m").alias("__m1"), F.col("x.m").alias("__m2"))
    shards = time_shards(bounds, "__e", "__t", floor=floor, parts=parts)
    out = ["__e", "__no", "period_start", "period_end", "first_member", "last_member", "gap_end"]
    if shards is None:
        found = _swept(bounds.withColumn("__shard", F.lit(0)), None, None).select(*out)
    else:
        cut = with_shards(bounds, shards, "__e", "__t")
        summed = cut.where(F.col("__hot")).groupBy("__e", "__shard", "__t", F.signum("__d").alias("__sign")).agg(F.sum("__d").alias("__d"), F.min("__m1").alias("__m1"), F.max("__m2").alias("__m2"))
        summed = materialize(summed)  # read three times
        before, after = Window.partitionBy("__e").orderBy("__shard").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("__e").orderBy("__shard")
        open_in = summed.groupBy("__e", "__shard").agg(F.sum("__d").alias("__s"), F.min("__t").alias("__first")).select("__e", "__shard", F.sum("__s").over(before).alias("__open"), F.lead("__first").over(after).alias("__next"))
        active = carried_in(summed, shards, open_in, "__e")
        begun = _marked(active).groupBy("__e", "__shard").agg(F.sum("__begins").alias("__g")).select("__e", "__shard", F.sum("__g").over(before).alias("__begun"))
        pieces = _swept(active, shards, begun)
        joined = pieces.groupBy("__e", "__no").agg(F.min("period_start").alias("period_start"), F.max("period_end").alias("period_end"), F.min("first_member").alias("first_member"), F.max("last_member").alias("last_member"), F.max("gap_end").alias("gap_end"))
        cold = _swept(cut.where(~F.col("__hot")).withColumn("__shard", F.lit(0)), None, None)
        found = cold.select(*out).unionByName(joined.select(*out))
    return found.select(F.col("__e").alias(entity), F.col("__no").alias("period_no"), *out[2:])


def _marked(bounds: DataFrame) -> DataFrame:
    """Boundaries with the open intervals ``__after`` each, whether a period begins there, and the next boundary's time."""
    line = Window.partitionBy("__e", "__shard").orderBy("__t", F.col("__d").desc())
    upto = line.rowsBetween(Window.unboundedPreceding, 0)
    known = [c for c in ("__open", "__next") if c in bounds.columns]
    after = F.sum("__d").over(upto) + (F.coalesce("__open", F.lit(0)) if known else F.lit(0))
    follows = F.lead("__t").over(line)
    marked = bounds.withColumns({"__after": after, "__follows": F.coalesce(follows, F.col("__next")) if known else follows})
    return marked.withColumn("__begins", (F.col("__after") == F.col("__d")).cast("long") * (F.col("__d") > 0).cast("long"))


def _swept(bounds: DataFrame, shards, begun: DataFrame | None) -> DataFrame:
    """The periods, or in a shard the parts of periods, of boundaries that are cut by (__e, __shard)."""
    marked = _marked(bounds)
    if begun is not None:
        marked = carried_in(marked, shards, begun, "__e")
    upto = Window.partitionBy("__e", "__shard").orderBy("__t", F.col("__d").desc()).rowsBetween(Window.unboundedPreceding, 0)
    numbered = marked.withColumn("__no", F.sum("__begins").over(upto) + (F.coalesce("__begun", F.lit(0)) if begun is not None else F.lit(0)))
    return numbered.groupBy("__e", "__shard", "__no").agg(
        F.min("__t").alias("period_start"), F.max("__t").alias("period_end"), F.min("__m1").alias("first_member"), F.max("__m2").alias("last_member"), F.max(F.when(F.col("__after") == 0, F.col("__follows"))).alias("gap_end"),
    )


def gaps(periods: DataFrame, entity: str) -> DataFrame:
    """(entity, gap_start, gap_end) between consecutive periods, as the sweep found them."""
    return periods.where(F.col("gap_end").isNotNull()).select(entity, F.col("period_end").alias("gap_start"), "gap_end")


def stay_intervals(admissions: DataFrame) -> DataFrame:
    """Inpatient and emergency times of every admissions row as (subject_id, hadm_id, start, end)."""
    spans = F.array(F.struct(F.col("admittime").alias("a"), F.col("dischtime").alias("b")), F.struct(F.col("edregtime").alias("a"), F.col("edouttime").alias("b")))
    return admissions.select("subject_id", "hadm_id", F.explode(spans).alias("x")).select("subject_id", "hadm_id", F.col("x.a").alias("start"), F.col("x.b").alias("end"))
