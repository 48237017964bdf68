"""References to records that are missing, removed or delivered later."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Reference:
    """Column ``key`` of table ``name`` (rows delivered at ``loaded``) refers to ``parent_key`` of ``parent_df``."""

    name: str
    df: DataFrame
    key: str
    parent: str
    parent_df: DataFrame
    parent_key: str
    loaded: str = "loaded_at"


def orphan_references(refs: Sequence[Reference], removed: DataFrame) -> DataFrame:
    """(table_name, key_id, load_month, reason, n_rows, had_parent) of the references that had no parent when they were delivered.

    ``reason`` is late (the parent's first delivery is after the row's), deleted (there is no parent
    and ``removed`` has the key) or missing. ``had_parent`` tells, of the deleted, whether the row was delivered within the parent's validity interval, which then ended at the removal; it is
    false for the others. References are first reduced to one row per key and delivery run, so a hot key is as many rows as there are runs. They and the
    parents' validity intervals (first delivery, or the beginning of time if only the removal is known, up to the last removal of a parent that isn't there any more, or
    without end) are then partitioned and sorted alike and merged in one pass. Null keys are no references. Rows without a delivery time are never late and had no parent; their month is null.
    Keys keep their type; where the references' types differ, the wider one.
    """
    keys, parents = [], []
    kind = _key_type(refs)
    for r in refs:
        keys.append(r.df.where(F.col(r.key).isNotNull()).groupBy(F.lit(r.name).alias("table_name"), F.lit(r.parent).alias("parent"), F.col(r.key).cast(kind).alias("key"), F.col(r.loaded).alias("at")).agg(F.count(F.lit(1)).alias("n")))
    none = F.lit(None).cast("timestamp_ntz")
    for name, (df, key, loaded) in {r.parent: (r.parent_df, r.parent_key, r.loaded) for r in refs}.items():
        parents.append(df.where(F.col(key).isNotNull()).groupBy(F.lit(name).alias("parent"), F.col(key).cast(kind).alias("key")).agg(F.lit(True).alias("present"), F.min(loaded).alias("valid_from"), none.alias("removed_at")))
    gone = removed.where(F.col("key_id").isNotNull()).groupBy(F.col("parent_table").alias("parent"), F.col("key_id").cast(kind).alias("key")).agg(F.lit(False).alias("present"), none.alias("valid_from"), F.max("removed_at").alias("removed_at"))
    union = lambda dfs: dfs[0] if len(dfs) == 1 else dfs[0].unionByName(union(dfs[1:]))
    intervals = union([*parents, gone]).groupBy("parent", "key").agg(F.max("present").alias("present"), F.min("valid_from").alias("valid_from"), F.max("removed_at").alias("removed_at"))
    # A parent that is there again after its removal is valid without end.
    intervals = intervals.select("parent", "key", "present", "valid_from", F.when(~F.col("present"), F.col("removed_at")).alias("valid_to"))
    merged = union(keys).join(intervals.hint("merge"), ["parent", "key"], "left")
    before, ended = F.col("at") < F.col("valid_from"), F.col("present").isNotNull() & ~F.coalesce("present", F.lit(False))
    reason = F.when(F.col("present").isNull(), "missing").when(ended, "deleted").when(before, "late")
    had = F.coalesce(ended & (F.col("at") < F.col("valid_to")), F.lit(False))
    return merged.select("table_name", F.col("key").alias("key_id"), F.date_format("at", "yyyy-MM").alias("load_month"), reason.alias("reason"), "n", had.alias("had")).where(F.col("reason").isNotNull()).groupBy("table_name", "key_id", "load_month", "reason").agg(F.sum("n").alias("n_rows"), F.max("had").alias("had_parent"))


def _key_type(refs: Sequence[Reference]) -> str:
    """The one type of all keys: the widest whole number, else text."""
    order = ["tinyint", "smallint", "int", "bigint"]
    kinds = {dict(df.dtypes)[c] for r in refs for df, c in ((r.df, r.key), (r.parent_df, r.parent_key))}
    return max(kinds, key=order.index) if kinds <= set(order) else "string" if len(kinds) > 1 else kinds.pop()


def orphan_report(orphans: DataFrame) -> DataFrame:
    """Orphan references per table, month and reason: distinct keys and rows."""
    return orphans.groupBy("table_name", "load_month", "reason").agg(F.count(F.lit(1)).alias("n_keys"), F.sum("n_rows").alias("n_rows"))
