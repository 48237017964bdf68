"""Reading tables: declared schemas, missing tokens, formats by suffix, partitions, probes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronofold.functions.exprs import CSV_NULLS, moment, number


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _need(spark: SparkSession, path: str) -> None:
    if not exists(spark, path):
        raise FileNotFoundError(f"no such table: {path}")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """A CSV table with a header. Missing tokens are null; values that don't parse as their declared type are null too.

    Without a schema all columns are text. Only ``columns`` are parsed. Raises FileNotFoundError.
    """
    _need(spark, path)
    raw = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", False).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    kinds = {f.name: f.dataType for f in schema.fields} if schema else {}
    out = []
    for c in columns or (schema.fieldNames() if schema else raw.columns):
        text = F.when(~F.col(c).isin(*CSV_NULLS), F.col(c))
        kind = kinds.get(c, T.StringType())
        if isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
            value = moment(text)
        elif isinstance(kind, T.NumericType):
            value = number(text).try_cast(kind) if not isinstance(kind, T.LongType) else F.coalesce(text.try_cast("long"), number(text).try_cast("long"))
        else:
            value = text if isinstance(kind, T.StringType) else text.try_cast(kind)
        out.append(value.alias(c))
    return raw.select(*out)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet, CSV or JSON by suffix; ValueError for another one."""
    kind = path.rstrip("/").rpartition(".")[2].lower()
    if kind == "csv":
        return read_csv(spark, path, schema, columns)
    if kind not in ("parquet", "json"):
        raise ValueError(f"can't tell the format of {path}")
    _need(spark, path)
    df = spark.read.parquet(path) if kind == "parquet" else (spark.read.schema(schema) if schema else spark.read).json(path)
    return df.select(*columns) if columns else df


def columns_of(spark: SparkSession, path: str) -> list[str]:
    """The column names, from the footer or the header line only."""
    return read_table(spark, path).columns


def template_columns(spark: SparkSession, path: str) -> list[str] | None:
    """The columns of an earlier output, or None if there is none."""
    return columns_of(spark, path) if exists(spark, path) else None


def read_bucket(spark: SparkSession, path: str, bucket: int, schema: T.StructType) -> DataFrame:
    """One bucket of a partitioned table: other buckets aren't listed into the scan. An empty table if there is no such path."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.parquet(path).where(F.col("bucket") == bucket)


def find_files(spark: SparkSession, folder: str, fragments: Sequence[str]) -> str:
    """The one file or folder whose name contains all fragments; FileNotFoundError if none does, ValueError if several do."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(folder)
    names = sorted(s.getPath().toString() for s in p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p))
    found = [n for n in names if all(x.lower() in n.rpartition("/")[2].lower() for x in fragments)]
    if not found:
        raise FileNotFoundError(f"nothing in {folder} has {fragments} in its name")
    if len(found) > 1:
        raise ValueError(f"several in {folder} have {fragments} in their names: {found}")
    return found[0]
