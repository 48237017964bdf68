"""Primitives that keep hot keys from landing in one task.

What is hot follows from the numbers of rows, keys and tasks: a key is hot if it has more rows than a *part*, and a part is a ``parts``-th of all rows, at least
``floor``, below which cutting saves nothing (time lines: and at least EVEN times the mean of a key, or a quarter of a task's share). So there are fewer than ``parts`` hot keys and fewer than about ``2 * parts`` pieces of them at any size of
the data: that is the bound behind every broadcast here, and no piece grows faster than the data divided by ``parts``.
Hot keys are found by one aggregate, partial before the shuffle. Without a hot key the plain plan is built.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

#: Parts that all rows are thought cut in; the bound of broadcasts and of what comes to the driver.
PARTS = 100_000
#: Rows up to which an entity's time line isn't cut.
SHARD_ROWS = 64
#: Times the mean rows of an entity up to which its time line isn't cut, in tables whose entities are many.
EVEN = 8
#: Rows up to which a key of a join, or a slice of a ranking, is left to one task.
TASK_ROWS = 100_000


def hot_keys(df: DataFrame, keys: Sequence[str], *, floor: int = TASK_ROWS, parts: int = PARTS, tasks: int = 0, extra: Sequence[tuple[str, Column]] = ()) -> list[Row]:
    """(keys, __n, __part, extra aggregates) of the keys with more rows than a part, the most frequent first: fewer than ``parts`` rows. Null keys count as keys.

    With ``tasks``, a part is also at least EVEN times the mean rows of a key, as keys that are all alike need no cutting, unless that is more than a quarter of a task's share.
    """
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), *[c.alias(name) for name, c in extra])
    # The total is taken over the same aggregate, extra columns included, so that both read one exchange.
    total = groups.agg(F.struct(F.sum("__n").alias("n"), F.count(F.lit(1)).alias("k"), *[F.max(name).alias(name) for name, _ in extra]).alias("x")).scalar()
    part = F.greatest(F.lit(floor).cast("long"), F.ceil(total["n"] / F.lit(parts)))
    if tasks:
        part = F.greatest(part, F.least(F.ceil(F.try_divide(total["n"] * EVEN, total["k"])), F.ceil(total["n"] / F.lit(4 * tasks))))
    return groups.withColumn("__part", part).where("__n > __part").orderBy(F.col("__n").desc(), *keys).collect()


def salted_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", *, floor: int = TASK_ROWS, parts: int = PARTS, salt_by: Sequence[str] = (), left_rows: int | None = None) -> DataFrame:
    """Equi-join whose hot keys of ``left`` are spread over as many tasks as they have parts.

    Rows of ``right`` are repeated, once a part, for hot keys only. ``how`` is inner, left,
    left_semi or left_anti. Null keys never match. Columns other than the keys must have different names.
    ``left_rows``, if known, saves the search for hot keys where there are too few rows for one.
    """
    hot = [] if left_rows is not None and left_rows <= floor else hot_keys(left.select(*keys), keys, floor=floor, parts=parts)
    if not hot:
        return left.join(right, list(keys), how)
    fields = [f for k in keys for f in left.schema.fields if f.name == k]
    table = left.sparkSession.createDataFrame([(*[r[k] for k in keys], -(-r["__n"] // r["__part"])) for r in hot], StructType([*fields, StructField("__salts", LongType())]))
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in (salt_by or left.columns)]), F.col("__salts"))
    a = _flagged(left, table, keys).withColumn("__salt", F.when(F.col("__salts").isNotNull(), salt).otherwise(F.lit(0).cast("long"))).drop("__salts")
    many = F.sequence(F.lit(0).cast("long"), F.coalesce("__salts", F.lit(1).cast("long")) - 1)
    b = _flagged(right, table, keys).withColumn("__salt", F.explode(many)).drop("__salts")
    return a.join(b, [*keys, "__salt"], how).drop("__salt")


def _flagged(df: DataFrame, hot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` with ``__salts``; null keys too are told apart, as they may be the hot ones of a left join."""
    named = hot.select(*[F.col(k).alias(f"__h{i}") for i, k in enumerate(keys)], "__salts")
    on = None
    for i, k in enumerate(keys):
        term = df[k].eqNullSafe(F.col(f"__h{i}"))
        on = term if on is None else on & term
    return df.join(F.broadcast(named), on, "left").drop(*[f"__h{i}" for i in range(len(keys))])


def distributed_rank(df: DataFrame, group: Sequence[str], order_text: Column, ties: Sequence[str], out: str, *, total: str | None = None, slice_rows: int = TASK_ROWS) -> DataFrame:
    """1-based row number in each group by (order_text, ties), without a group ever being one task's.

    ``order_text`` is a hash in lower hexadecimal: its first eight digits cut every group in slices of about equal size, one for every
    ``slice_rows`` rows of ``df``; ranks are local to a slice plus the count of the slices before it. ``total`` also gives
    the group's size. Null group values form a group. The offsets are joined by (group, slice).
    """
    keys = [*group, "__slice"]
    slices = F.greatest(F.lit(1), F.ceil(df.agg(F.count(F.lit(1))).scalar() / F.lit(slice_rows)))
    sliced = df.withColumn("__text", order_text).withColumn("__slice", F.floor(F.conv(F.substring("__text", 1, 8), 16, 10).cast("double") / F.lit(4294967296.0) * slices))
    local = F.row_number().over(Window.partitionBy(*keys).orderBy("__text", *ties))
    counts = sliced.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*group).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    named = {c: f"__g{i}" for i, c in enumerate(keys)}
    offsets = counts.select(*[F.col(c).alias(a) for c, a in named.items()], F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"), F.sum("__n").over(Window.partitionBy(*group)).alias("__total"))
    on = None
    for c, a in named.items():
        term = F.col(c).eqNullSafe(F.col(a))
        on = term if on is None else on & term
    ranked = sliced.withColumn("__local", local).join(offsets, on, "inner")
    ranked = ranked.withColumn(out, F.col("__local") + F.col("__before"))
    if total:
        ranked = ranked.withColumn(total, F.col("__total"))
    return ranked.drop("__text", "__slice", "__local", "__before", "__total", *named.values())


@dataclass(frozen=True)
class Shards:
    """Where hot entities are cut in time. ``roots``: (entity, __id, __lo, __span, __k), a row a hot entity. ``cells``: (__id, __cell, __piece, __next, __lo, __span, __k), the
    shard of each cell of a node, or the node that cuts it again. ``depth``: how often cells are cut at most."""

    roots: DataFrame
    cells: DataFrame
    depth: int


def time_shards(timeline: DataFrame, entity: str, time: str, *, floor: int = SHARD_ROWS, parts: int = PARTS) -> Shards | None:
    """Where to cut hot entities in time, so that a shard has about a part's rows; None if no entity is hot.

    The time between a hot entity's first and last row is laid over equal cells, two for every part of its rows, and rows are counted by cell. A cell of more
    than two parts (a burst) is cut again between its own first and last row, and so on, unless it is one instant; then consecutive cells are
    joined to shards. Counted and kept are about ``2 * parts`` cells at most a level. An instant is never cut.
    """
    slim = timeline.select(F.col(entity).alias("__e"), F.col(time).alias("__t")).where(F.col("__e").isNotNull() & F.col("__t").isNotNull())
    tasks = int(timeline.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = hot_keys(slim, ["__e"], floor=floor, parts=parts, tasks=tasks, extra=[("__lo", F.min("__t")), ("__span", F.timestamp_diff("MICROSECOND", F.min("__t"), F.max("__t")) + 1)])
    if not hot:
        return None
    spark, kinds, part = timeline.sparkSession, dict(slim.dtypes), hot[0]["__part"]
    many = lambda n: 2 * -(-n // part)
    node = f"__id long, __lo {kinds['__t']}, __span long, __k long"
    roots = spark.createDataFrame([(r["__e"], i, r["__lo"], r["__span"], many(r["__n"])) for i, r in enumerate(hot)], f"__e {kinds['__e']}, {node}")
    at, found, below, fresh, depth = slim.join(F.broadcast(roots), "__e").drop("__e"), {}, {}, len(hot), 0
    while True:
        depth += 1
        celled = at.withColumn("__cell", _cell("", F.col("__t")))
        heavy = []
        for r in celled.groupBy("__id", "__cell").agg(F.count(F.lit(1)).alias("n"), F.min("__t").alias("lo"), (F.timestamp_diff("MICROSECOND", F.min("__t"), F.max("__t")) + 1).alias("span")).collect():
            found.setdefault(r["__id"], {})[r["__cell"]] = r["n"]
            if r["n"] > 2 * part and r["span"] > 1:
                below[(r["__id"], r["__cell"])] = (fresh, r["lo"], r["span"], many(r["n"]))
                heavy.append((r["__id"], r["__cell"], *below[(r["__id"], r["__cell"])]))
                fresh += 1
        if not heavy:
            break
        finer = spark.createDataFrame(heavy, f"__of long, __cell long, {node}")
        at = celled.select(F.col("__id").alias("__of"), "__cell", "__t").join(F.broadcast(finer), ["__of", "__cell"]).select("__id", "__t", "__lo", "__span", "__k")
    rows: list[tuple] = []
    for i in range(len(hot)):
        _number(i, found, below, part, rows, [0, 0])
    return Shards(roots.withColumnRenamed("__e", entity), spark.createDataFrame(rows, f"__id long, __cell long, __piece long, __next long, __lo {kinds['__t']}, __span long, __k long"), depth)


def _cell(prefix: str, time: Column) -> Column:
    """The cell of a time in its node."""
    return F.floor(F.timestamp_diff("MICROSECOND", F.col(f"{prefix}__lo"), time) / F.col(f"{prefix}__span") * F.col(f"{prefix}__k")).cast("long")


def _number(node: int, found: dict, below: dict, part: int, rows: list[tuple], state: list[int]) -> None:
    """Numbers the shards of a node's cells in order of time; ``state``: the shard that is being filled and the rows it has."""
    for cell in sorted(found.get(node, ())):
        if (node, cell) in below:
            rows.append((node, cell, None, *below[(node, cell)]))
            _number(below[(node, cell)][0], found, below, part, rows, state)
            continue
        n = found[node][cell]
        if state[1] and state[1] + n > part:
            state[:] = [state[0] + 1, 0]
        rows.append((node, cell, state[0], None, None, None, None))
        state[1] += n


def with_shards(timeline: DataFrame, shards: Shards | None, entity: str, time: str) -> DataFrame:
    """Add ``__shard`` (0 but for hot entities) and ``__hot``. Rows without an entity are spread by hash; rows without a time are of shard 0."""
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in timeline.columns]), F.lit(1 << 30))
    if shards is None:
        return timeline.withColumns({"__shard": F.when(F.col(entity).isNull(), spread).otherwise(F.lit(0).cast("long")), "__hot": F.lit(False)})
    # Names of their own: the time line has columns of any name.
    roots = shards.roots.select(F.col(entity), *[F.col(c).alias(f"__s{c}") for c in ("__id", "__lo", "__span", "__k")])
    step = shards.cells.select(*[F.col(c).alias(f"__n{c}") for c in shards.cells.columns])
    out = timeline.withColumn("__spread", spread).join(F.broadcast(roots), entity, "left").withColumns({"__hot": F.col("__s__id").isNotNull(), "__shard": F.lit(None).cast("long")})
    for _ in range(shards.depth):
        out = out.withColumn("__at", _cell("__s", F.col(time))).join(F.broadcast(step), (F.col("__s__id") == F.col("__n__id")) & (F.col("__at") == F.col("__n__cell")), "left")
        out = out.withColumns({"__shard": F.coalesce("__shard", "__n__piece"), "__s__id": F.col("__n__next"), **{f"__s{c}": F.col(f"__n{c}") for c in ("__lo", "__span", "__k")}}).drop(*step.columns)
    shard = F.when(F.col(entity).isNull(), F.col("__spread")).otherwise(F.coalesce("__shard", F.lit(0).cast("long")))
    return out.withColumn("__shard", shard).drop("__spread", "__at", *[c for c in roots.columns if c != entity])


def carried_in(local: DataFrame, shards: Shards | None, carry: DataFrame, entity: str) -> DataFrame:
    """``local`` with the columns of ``carry`` (by entity and shard; a row a shard), null where no entity is hot."""
    if shards is None:
        return local.withColumns({f.name: F.lit(None).cast(f.dataType) for f in carry.schema.fields if f.name not in (entity, "__shard")})
    return local.join(F.broadcast(carry), [entity, "__shard"], "left")
