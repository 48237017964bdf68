"""Queries that run as streams over a table's files, with the SQL of the batch result they must equal."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from chronofold.plans.registry import Registry
from chronofold.session import scratch_path, table
from chronofold.sources.writers import read_upserted
from chronofold.streaming import incremental

query = Registry()
QUERIES, SQL = query.queries, query.sql


def _stream(s, df, files=3, by=None):
    """The rows of ``df`` as ``files`` files, read one a trigger, and a folder for the results. With ``by``, a number, the first file has the least values of it, and so on; rows of one value are in one file."""
    root = scratch_path(s)
    if by is None:
        df.repartition(files).write.parquet(f"{root}/in")
    else:
        cuts = df.select(F.percentile_approx(by, [k / files for k in range(1, files)])).first()[0] or []
        part = F.lit(0)
        for cut in cuts:
            part = part + F.coalesce((by > cut).cast("int"), F.lit(0))
        for k in range(files):  # one after the other: the stream takes files in the order of their age
            df.where(part == k).repartition(1).write.mode("append").parquet(f"{root}/in")
    return incremental.read_files(s, f"{root}/in", df.schema), root


def _later(s, root, df, rows):
    """One more file for the stream of ``root``: rows of the columns of ``df``."""
    s.createDataFrame(rows, df.schema).repartition(1).write.mode("append").parquet(f"{root}/in")


@query("SELECT o_custkey, arg_max(o_orderkey, o_orderkey) AS o_orderkey, arg_max(o_totalprice, o_orderkey) AS o_totalprice, arg_max(o_orderstatus, o_orderkey) AS o_orderstatus FROM orders GROUP BY o_custkey")
def stream_upsert(s, d):
    """The latest order of every customer, from files in order of the orders: a customer's row is replaced in batch after batch."""
    orders = table(s, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderstatus")
    stream, root = _stream(s, orders, 4, F.col("o_orderkey"))
    incremental.stream_upsert(stream, f"{root}/out", ["o_custkey"], ["o_orderkey"], f"{root}/cp").awaitTermination()
    return read_upserted(s, f"{root}/out")


@query("SELECT flag AS label, count(*) AS n, count(*) FILTER (WHERE hadm_id IS NULL) AS null_hadm_id FROM labevents GROUP BY flag")
def stream_profile(s, d):
    stream, root = _stream(s, table(s, d, "labevents").select(F.col("flag").alias("label"), "hadm_id"))
    return incremental.run_to_table(incremental.stream_profile(stream, "label", ["hadm_id"]), f"{root}/out", f"{root}/cp", "complete")


@query("SELECT date_trunc('day', ts)::TIMESTAMP AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def stream_windows(s, d):
    """Append mode: a window comes out once the watermark has passed it. A row far ahead closes the windows, and a row of the first day that arrives behind it is dropped."""
    events = table(s, d, "events").select("ts", "event_type", "value")
    stream, root = _stream(s, events, 3, F.unix_micros(F.col("ts").cast("timestamp")))
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    _later(s, root, events, [(last + dt.timedelta(days=30), "end", 0.0)])
    _later(s, root, events, [(first, "late", 1.0)])
    out = incremental.run_to_table(incremental.stream_windows(stream, "ts", "event_type", "value"), f"{root}/out", f"{root}/cp")
    return out.withColumn("total", F.round("total", 4))


@query("""SELECT e.user_id, e.ts, count(f.ts) AS n_before, round(coalesce(sum(f.value), 0.0), 4) AS total_before FROM events e LEFT JOIN (SELECT user_id, ts, value FROM events WHERE event_type <> 'purchase') f ON f.user_id = e.user_id AND f.ts < e.ts
WHERE e.event_type = 'purchase' GROUP BY e.event_id, e.user_id, e.ts""")
def stream_history(s, d):
    """Files that overlap by two days: every third event arrives up to two days late, behind purchases it belongs before. A row far ahead of each user lets the last purchases out."""
    events = table(s, d, "events").select("user_id", "ts", "event_type", "value")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    held = F.when(F.pmod(F.xxhash64("user_id", "ts"), F.lit(3)) == 0, F.lit(2 * 86_400_000_000)).otherwise(F.lit(0))
    stream, root = _stream(s, events, 4, micros + held)
    last = events.agg(F.max("ts")).first()[0]
    _later(s, root, events, [(None, last + dt.timedelta(days=30), "end", 0.0)])
    out = incremental.run_to_table(incremental.stream_history(stream, "user_id", "ts", "event_type", "value", probe="purchase", late="3 days"), f"{root}/out", f"{root}/cp")
    return out.select("user_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "n_before", F.round("total_before", 4).alias("total_before"))
