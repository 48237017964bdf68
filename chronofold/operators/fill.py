"""Filling missing values along each entity's time line, with the method and distance recorded."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronofold.operators.skew import PARTS, SHARD_ROWS, carried_in, time_shards, with_shards

DAY_US = 86_400_000_000


def usable(col: Column, low: float, high: float) -> Column:
    """The value as a double if it is a reading from ``low`` to ``high``; null for null, NaN and anything outside."""
    value = col.cast("double")
    return F.when(~F.isnan(value) & value.between(low, high), value)


def fill_along_time(
    df: DataFrame, entity: str, time: str, tie: str, numerics: dict[str, tuple[float, float]], categories: dict[str, float] | None = None, *, placeholders: Sequence[str] = ("", "nan", "none", "<na>", "unknown"), floor: int = SHARD_ROWS, parts: int = PARTS,
) -> DataFrame:
    """All rows and columns of ``df``; for each numeric and category ``c`` also ``c_filled``, ``c_method``, ``c_days``.

    Numerics (with the ends of the usable range): ``observed``; ``interpolated`` by time between the
    entity's observed neighbours; ``carried`` from the nearest one where only one side has any;
    else ``same_time``, the mean of the usable readings of the calendar month, or ``near_time``, that of
    the nearest month that has any; ``none`` and null only if the table has no usable reading.
    Rows without a time take ``overall``, the mean of all readings. Categories (with the gap limit in days): ``observed``,
    ``carried`` from the last row, else from the next one, if not farther than the limit, else ``none`` and null.
    Texts in ``placeholders`` count as missing. ``c_days`` is the distance to the (nearer) source in days, 0 for an observed
    value and null where there is no single source. Rows without an entity have no neighbours. Ties in time are ordered by ``tie``.
    """
    categories = categories or {}
    names = {c: i for i, c in enumerate([*numerics, *categories])}
    value: dict[str, Column] = {c: usable(F.col("__row")[c], *ends) for c, ends in numerics.items()}
    for c in categories:
        text = F.trim(F.col("__row")[c].cast("string"))
        value[c] = F.when(~F.lower(text).isin(*placeholders), text)
    base = df.select(F.struct(*[F.col(c) for c in df.columns]).alias("__row"), F.col(entity).alias("__e"), F.col(time).alias("__t"), F.col(tie).alias("__k"))
    base = base.withColumns({f"__v{i}": value[c] for c, i in names.items()})
    points = {i: F.when(F.col(f"__v{i}").isNotNull() & F.col("__t").isNotNull() & F.col("__e").isNotNull(), F.struct("__t", "__k", F.col(f"__v{i}").alias("v"))) for i in names.values()}
    shards = time_shards(base, "__e", "__t", floor=floor, parts=parts)
    cut = with_shards(base, shards, "__e", "__t").withColumns({f"__p{i}": p for i, p in points.items()})
    ahead = Window.partitionBy("__e", "__shard").orderBy("__t", "__k").rowsBetween(Window.unboundedPreceding, -1)
    # The next reading is the last one of the reversed order: a frame that ends at the partition's end is rebuilt for every row.
    back = Window.partitionBy("__e", "__shard").orderBy(F.col("__t").desc(), F.col("__k").desc()).rowsBetween(Window.unboundedPreceding, -1)
    local = cut.withColumns({f"__a{i}": F.last(f"__p{i}", ignorenulls=True).over(ahead) for i in names.values()}).withColumns({f"__b{i}": F.last(f"__p{i}", ignorenulls=True).over(back) for i in names.values()})
    ends = cut.where(F.col("__hot")).groupBy("__e", "__shard").agg(*[F.max(f"__p{i}").alias(f"__x{i}") for i in names.values()], *[F.min(f"__p{i}").alias(f"__y{i}") for i in names.values()])
    before = Window.partitionBy("__e").orderBy("__shard").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("__e").orderBy(F.col("__shard").desc()).rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select("__e", "__shard", *[F.max(f"__x{i}").over(before).alias(f"__ca{i}") for i in names.values()], *[F.min(f"__y{i}").over(after).alias(f"__cb{i}") for i in names.values()])
    joined = carried_in(local, shards, carry, "__e").withColumn("__month", F.date_format("__t", "yyyy-MM"))
    if numerics:
        joined = joined.join(F.broadcast(month_means(base, [names[c] for c in numerics])), "__month", "left")
        overall = base.agg(*[F.avg(f"__v{names[c]}").alias(f"__o{names[c]}") for c in numerics])
    out: list[Column] = []
    for c, i in names.items():
        a, b, t = F.coalesce(f"__a{i}", f"__ca{i}"), F.coalesce(f"__b{i}", f"__cb{i}"), F.col("__t")
        da, db = F.timestamp_diff("MICROSECOND", a["__t"], t), F.timestamp_diff("MICROSECOND", t, b["__t"])
        seen, timed = F.col(f"__v{i}").isNotNull(), F.col("__t").isNotNull() & F.col("__e").isNotNull()
        if c in numerics:
            span = da + db
            between = F.when(span == 0, (a["v"] + b["v"]) / 2).otherwise(a["v"] + (b["v"] - a["v"]) * (da / F.nullif(span, F.lit(0).cast("long"))))
            both, one = timed & a.isNotNull() & b.isNotNull(), timed & (a.isNotNull() | b.isNotNull())
            all_mean = overall.select(f"__o{i}").scalar()
            method = F.when(seen, "observed").when(both, "interpolated").when(one, "carried").when(F.col(f"__m{i}").isNotNull(), F.when(F.col(f"__d{i}") == 0, "same_time").otherwise("near_time")).when(all_mean.isNotNull(), "overall").otherwise("none")
            filled = F.when(seen, F.col(f"__v{i}")).when(both, between).when(one, F.coalesce(a["v"], b["v"])).otherwise(F.coalesce(F.col(f"__m{i}"), all_mean))
            days = F.when(seen, F.lit(0.0)).when(one, F.least(da, db) / DAY_US)
        else:
            limit = F.lit(int(categories[c] * DAY_US))
            from_a, from_b = timed & (da <= limit), timed & (db <= limit)
            method = F.when(seen, "observed").when(from_a | from_b, "carried").otherwise("none")
            filled = F.when(seen, F.col(f"__v{i}")).when(from_a, a["v"]).when(from_b, b["v"])
            days = F.when(seen, F.lit(0.0)).when(from_a, da / DAY_US).when(from_b, db / DAY_US)
        out += [filled.alias(f"{c}_filled"), method.alias(f"{c}_method"), days.alias(f"{c}_days")]
    added = {f"{c}_{s}" for c in names for s in ("filled", "method", "days")}
    return joined.select(*[F.col("__row")[c].alias(c) for c in df.columns if c not in added], *out)


def month_means(base: DataFrame, ids: Sequence[int]) -> DataFrame:
    """(__month, __m<i>, __d<i>): the mean usable reading of every month with rows, or of the nearest month that has one, and the months between. A row a month."""
    of = base.where(F.col("__t").isNotNull()).groupBy(F.date_format("__t", "yyyy-MM").alias("__month")).agg((F.min(F.year("__t")) * 12 + F.min(F.month("__t"))).alias("__no"), *[F.avg(f"__v{i}").alias(f"__v{i}") for i in ids])
    up = Window.orderBy("__no").rowsBetween(Window.unboundedPreceding, 0)
    down = Window.orderBy(F.col("__no").desc()).rowsBetween(Window.unboundedPreceding, 0)
    point = {i: F.when(F.col(f"__v{i}").isNotNull(), F.struct("__no", f"__v{i}")) for i in ids}
    near = of.withColumns({f"__up{i}": F.last(p, ignorenulls=True).over(up) for i, p in point.items()}).withColumns({f"__dn{i}": F.last(p, ignorenulls=True).over(down) for i, p in point.items()})
    out = []
    for i in ids:
        a, b = F.col(f"__up{i}"), F.col(f"__dn{i}")
        da, db = F.col("__no") - a["__no"], b["__no"] - F.col("__no")
        out += [F.when(b.isNull() | (da <= db), a[f"__v{i}"]).otherwise(b[f"__v{i}"]).alias(f"__m{i}"), F.least(da, db).alias(f"__d{i}")]
    return near.select("__month", *out)


def filled_cases(filled: DataFrame, fields: Sequence[str], id_col: str) -> DataFrame:
    """(id, field) of every value that was not observed."""
    cases = [F.when(F.col(f"{c}_method") != "observed", F.lit(c)) for c in fields]
    return filled.select(id_col, F.explode(F.array_compact(F.array(*cases))).alias("field")).distinct()
