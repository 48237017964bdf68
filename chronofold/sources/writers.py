"""Writing tables: partitioned and dual sinks, split files, metadata, keyed upsert."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from chronofold.functions.exprs import bucket


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """With a header; blanks at the ends of a text and empty texts are kept as they are."""
    df.write.mode(mode).option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).option("emptyValue", "").csv(path)


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int = 128, mode: str = "append") -> None:
    """Parquet partitioned by ``key`` modulo ``buckets``; an empty table writes no bucket."""
    n = bucket(key, buckets)
    df.withColumn("bucket", n).repartition("bucket", F.pmod(F.xxhash64(*df.columns), F.lit(8))).write.partitionBy("bucket").mode(mode).parquet(path)


def write_both(df: DataFrame, parquet: str | None, csv: str | None) -> None:
    """To parquet and CSV, or to one of them; the CSV is made from the parquet, so the plan runs once."""
    if parquet:
        df.write.mode("overwrite").parquet(parquet)
    if csv:
        write_csv(df.sparkSession.read.parquet(parquet) if parquet else df, csv)


def write_split(df: DataFrame, folder: str, name: str, target: str, keys: Sequence[str]) -> None:
    """``X_<name>`` (features), ``y_<name>`` (target) and ``<name>_full`` (all) as CSV."""
    write_csv(df.drop(target, *keys), f"{folder}/X_{name}.csv")
    write_csv(df.select(target), f"{folder}/y_{name}.csv")
    write_csv(df, f"{folder}/{name}_full.csv")


def write_json(spark: SparkSession, data: dict, path: str) -> None:
    """A small document, through the file system of ``path``."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
    try:
        out.write(bytearray(json.dumps(data, indent=2, default=str).encode()))
    finally:
        out.close()


def read_json(spark: SparkSession, path: str) -> dict:
    return json.loads("\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect()))


def upserted(old: DataFrame | None, new: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """``old`` with the rows of ``new``: of a key in both, the new row stays; of a key repeated in ``new``, the last by ``order``. Null keys are keys like others. Columns that one side lacks are null."""
    rest = [c for c in new.columns if c not in keys]
    if old is None:
        tagged = new.withColumn("__new", F.lit(1))
    else:
        tagged = old.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)), allowMissingColumns=True)
    by = [F.col("__new").desc(), *[F.col(c).desc_nulls_last() for c in (order or rest)]]
    return tagged.withColumn("__rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*by))).where("__rn = 1").drop("__rn", "__new")


def _versions(spark: SparkSession, path: str) -> list[int]:
    """The versions of an upserted table that are complete, oldest first."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    names = [x.getPath().getName() for x in fs.listStatus(folder)]
    return sorted(int(n[9:-5]) for n in names if n.startswith("manifest-") and n.endswith(".json"))


def _manifest(spark: SparkSession, path: str, version: int) -> dict:
    return read_json(spark, f"{path}/manifest-{version:010d}.json")


def read_upserted(spark: SparkSession, path: str) -> DataFrame:
    """The last complete version of a table that upsert() writes; FileNotFoundError if there is none."""
    versions = _versions(spark, path)
    if not versions:
        raise FileNotFoundError(f"no such table: {path}")
    return _read_buckets(spark, _manifest(spark, path, versions[-1]), None)


def _read_buckets(spark: SparkSession, manifest: dict, buckets: Sequence[int] | None) -> DataFrame:
    schema = StructType.fromJson(manifest["schema"])
    folders = [f for b, f in manifest["buckets"].items() if buckets is None or int(b) in buckets]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def upsert(new: DataFrame, path: str, keys: Sequence[str], order: Sequence[str] = (), *, buckets: int = 64) -> int:
    """Upsert into the table at ``path`` (read it with read_upserted()); the version written.

    Rows lie in ``buckets`` by a hash of their keys, a number fixed by the first version. Only buckets with new keys are read and written, into a folder of this version; then a manifest that names
    the folder of every bucket is put in place by one rename. Readers see the version before or this one, and a crash leaves the version before; of two
    writers at once the later one fails (OSError). Files of versions before the last but one are removed. New columns are added, null in old rows of the touched buckets and in others.
    """
    spark = new.sparkSession
    versions = _versions(spark, path)
    last = _manifest(spark, path, versions[-1]) if versions else {"buckets": {}, "n": buckets, "schema": None}
    slot = F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(last["n"])).cast("int")
    touched = [r[0] for r in new.select(slot.alias("b")).distinct().collect()]  # at most as many as there are buckets
    old = _read_buckets(spark, last, touched) if versions else None
    rows = upserted(old, new, keys, order)
    if versions:  # buckets that aren't touched are read with the whole schema, too
        known = StructType.fromJson(last["schema"])
        schema = StructType([*known.fields, *[f for f in rows.schema.fields if f.name not in known.fieldNames()]])
        rows = rows.select(*schema.fieldNames())
    else:
        schema = rows.schema
    version, data = (versions[-1] + 1 if versions else 1), f"{path}/data-{uuid.uuid4().hex}"
    rows.withColumn("__bucket", slot).repartition("__bucket").write.partitionBy("__bucket").parquet(data)
    manifest = {"n": last["n"], "schema": schema.jsonValue(), "buckets": last["buckets"] | {str(b): f"{data}/__bucket={b}" for b in touched}}
    side, place = f"{path}/.{uuid.uuid4().hex}", f"{path}/manifest-{version:010d}.json"
    write_json(spark, manifest, side)
    at = spark._jvm.org.apache.hadoop.fs.Path
    fs = at(path).getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(at(place)) or not fs.rename(at(side), at(place)):
        fs.delete(at(side), False)
        fs.delete(at(data), True)
        raise OSError(f"version {version} of {path} is there already")
    for v in versions[:-1]:
        kept = {f for m in (last, manifest) for f in m["buckets"].values()}
        for folder in set(_manifest(spark, path, v)["buckets"].values()) - kept:
            fs.delete(at(folder), True)
        fs.delete(at(f"{path}/manifest-{v:010d}.json"), False)
    return version
