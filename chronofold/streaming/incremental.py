"""Structured Streaming forms: keyed upsert, running profiles, history features per entity."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from chronofold.sources.writers import upsert


def read_files(spark: SparkSession, path: str, schema, files_per_trigger: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def stream_upsert(stream: DataFrame, path: str, keys: Sequence[str], order: Sequence[str], checkpoint: str) -> StreamingQuery:
    """Each batch is upserted into the table at ``path`` (read_upserted()), its buckets with new keys only; takes what there is and ends. Running a batch again gives the same table."""

    def write(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            upsert(batch, path, keys, order)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_windows(stream: DataFrame, time: str, key: str, value: str, *, width: str = "1 day", late: str = "2 days") -> DataFrame:
    """(window start, key, n, total): tumbling windows; rows later than the watermark are dropped by it, which bounds the state."""
    zoned = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)
    return zoned.groupBy(F.window(time, width), key).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total")).select(F.col("window.start").cast("timestamp_ntz").alias("start"), key, "n", "total")


def stream_profile(stream: DataFrame, label: str, columns: Sequence[str]) -> DataFrame:
    """(label, n, nulls of each column): the partial aggregates of all batches so far; for output mode complete."""
    return stream.groupBy(label).agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns])


def stream_history(stream: DataFrame, entity: str, time: str, kind: str, value: str, *, probe: str, late: str = "2 days") -> DataFrame:
    """(entity, time, n_before, total_before) of each row of kind ``probe``: the entity's other rows with an earlier time.

    Rows may arrive out of order by up to ``late``: a probe is held until the watermark has passed it, so facts that arrive in a later batch than the probe count as well, and
    the rows equal those of a batch query. Rows later than that are dropped by the watermark; probes within ``late`` of the newest row wait for newer ones. The state of an entity is the sum
    of its facts before the watermark, and those after it one by one: it is bounded by what arrives within ``late``.
    """
    kinds = dict(stream.dtypes)
    out = f"{entity} {kinds[entity]}, {time} timestamp, n_before long, total_before double"

    def step(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, total, times, values, probes = state.get if state.exists else (0, 0.0, [], [], [])
        frames = [b for b in batches if len(b)] if not state.hasTimedOut else []
        t = np.concatenate([np.array(times, np.int64), *[b[time].to_numpy("datetime64[us]").astype(np.int64)[(b[kind] != probe).to_numpy()] for b in frames]])
        x = np.concatenate([np.array(values, float), *[b[value].fillna(0.0).to_numpy(float)[(b[kind] != probe).to_numpy()] for b in frames]])
        p = np.sort(np.concatenate([np.array(probes, np.int64), *[b[time].to_numpy("datetime64[us]").astype(np.int64)[(b[kind] == probe).to_numpy()] for b in frames]]))
        order = np.argsort(t, kind="stable")
        t, x = t[order], x[order]
        passed = state.getCurrentWatermarkMs() * 1000
        upto = np.concatenate([[0.0], np.cumsum(x)])
        ready, p = p[p < passed], p[p >= passed]
        k = np.searchsorted(t, ready, side="left")
        done = pd.DataFrame({entity: [key[0]] * len(ready), time: ready.astype("datetime64[us]"), "n_before": n + k, "total_before": total + upto[k]})
        # What is older than the watermark comes before every probe still to be answered.
        old = int(np.searchsorted(t, min(passed, p[0]) if len(p) else passed, side="left"))
        state.update((int(n + old), float(total + upto[old]), t[old:].tolist(), x[old:].tolist(), p.tolist()))
        if len(p):
            state.setTimeoutTimestamp(max(int(p[0]) // 1000 + 1, state.getCurrentWatermarkMs() + 1))
        if len(done):
            yield done

    zoned = stream.select(entity, F.col(time).cast("timestamp").alias(time), kind, F.col(value).cast("double").alias(value)).withWatermark(time, late)
    return zoned.groupBy(entity).applyInPandasWithState(step, out, "n long, total double, times array<long>, vals array<double>, probes array<long>", "append", GroupStateTimeout.EventTimeTimeout)


def run_to_table(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Run a streaming plan over all there is into a parquet table (or, for mode complete, keep the last result), and read it."""
    spark = df.sparkSession
    if mode == "append":
        df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()
        return spark.read.schema(df.schema).parquet(path)

    def keep(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    df.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).outputMode("complete").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(path)
