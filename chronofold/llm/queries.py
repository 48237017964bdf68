"""Queries p6, p8, p9 and p10, with their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronofold.llm import grouped_split, leakage, lookalike, packing, textform
from chronofold.llm.sql import SQL  # noqa: F401
from chronofold.operators.skew import salted_join
from chronofold.session import materialize, table

SHARES = {"train": 0.70, "test": 0.15, "deployment": 0.15}


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    stays = table(spark, d, "master_table_model_ready").select("subject_id", "hadm_id")
    members = grouped_split.related(stays, ["subject_id", "hadm_id"], "hadm_id")
    return grouped_split.torn(members, table(spark, d, "split_assignment"), "hadm_id", "split_name", "subject_id")


def p6_split(spark: SparkSession, d: str) -> DataFrame:
    stays = table(spark, d, "master_table_model_ready").select("subject_id", "hadm_id", "target")
    return grouped_split.grouped_split(stays, ["subject_id", "hadm_id"], "hadm_id", "target", SHARES).select("subject_id", "hadm_id", "target", "split")


def p6_report(spark: SparkSession, d: str) -> DataFrame:
    split = p6_split(spark, d)
    return split.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("subject_id").alias("n_subjects"), F.round(F.avg("target"), 6).alias("target_rate"))


def p6_components(spark: SparkSession, d: str) -> DataFrame:
    """Every stay with the least stay of its component."""
    stays = table(spark, d, "master_table_model_ready").select("subject_id", "hadm_id")
    members = grouped_split.related(stays, ["subject_id", "hadm_id"], "hadm_id")
    least = members.groupBy("component").agg(F.min("hadm_id").alias("first_hadm_id"))
    return salted_join(members, least, ["component"]).select("hadm_id", "first_hadm_id").distinct()


def p6_balance(spark: SparkSession, d: str) -> DataFrame:
    """Of each split: torn components, and whether its rows are within a thousandth of all rows, its positives within two or a hundredth of all, of its share."""
    split = materialize(grouped_split.grouped_split(table(spark, d, "master_table_model_ready").select("subject_id", "hadm_id", "target"), ["subject_id", "hadm_id"], "hadm_id", "target", SHARES))
    ends = split.groupBy("component").agg(F.min("split").alias("lo"), F.max("split").alias("hi"))
    torn = ends.where("lo != hi").agg(F.count(F.lit(1))).scalar()
    rows, positives = (split.agg(x).scalar() for x in (F.count(F.lit(1)), F.sum("target")))
    share = F.element_at(F.create_map(*[F.lit(x) for pair in SHARES.items() for x in pair]), F.col("split"))
    by = split.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum("target").alias("p"))
    return by.select("split", torn.alias("n_torn"), (F.abs(F.col("n") - share * rows) <= F.greatest(F.lit(3.0), rows / 1000)).alias("rows_near"), (F.abs(F.col("p") - share * positives) <= F.greatest(F.lit(2.0), positives / 100)).alias("positives_near"))


def p8_pack_512(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(table(spark, d, "documents"), "doc_id", "text", 512)


def p8_pack_2048(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(table(spark, d, "documents"), "doc_id", "text", 2048)


def p8_buckets_512(spark: SparkSession, d: str) -> DataFrame:
    return packing.bucket_batches(table(spark, d, "documents"), "doc_id", "text", 512)


def p8_buckets_2048(spark: SparkSession, d: str) -> DataFrame:
    return packing.bucket_batches(table(spark, d, "documents"), "doc_id", "text", 2048)


def _restored(spark: SparkSession, d: str, capacity: int) -> DataFrame:
    whole = packing.unpack(packing.pack(table(spark, d, "documents"), "doc_id", "text", capacity), capacity)
    return whole.select(F.col("id").alias("doc_id"), F.length("text").cast("long").alias("n_chars"), F.md5("text").alias("digest"))


def p8_restored_512(spark: SparkSession, d: str) -> DataFrame:
    return _restored(spark, d, 512)


def p8_restored_2048(spark: SparkSession, d: str) -> DataFrame:
    return _restored(spark, d, 2048)


def p8_fill(spark: SparkSession, d: str) -> DataFrame:
    """How full the containers of both capacities are."""
    of = lambda c: packing.fill_report(packing.pack(table(spark, d, "documents"), "doc_id", "text", c), c, "container_id")
    return of(512).unionByName(of(2048))


def p9_runs(spark: SparkSession, d: str) -> DataFrame:
    """The pairs of p9_found with the longest run of words they share."""
    return p9_leaks(spark, d).where(F.col("longest_run") >= 8).groupBy("doc_id", "item_id").agg(F.max("longest_run").alias("longest_run"))


def p9_leaks(spark: SparkSession, d: str) -> DataFrame:
    return leakage.find_leaks(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return p9_leaks(spark, d).where(F.col("longest_run") >= 8).select("doc_id", "item_id").distinct()


def p9_items(spark: SparkSession, d: str) -> DataFrame:
    return p9_leaks(spark, d).groupBy("item_id").agg(F.countDistinct("doc_id").alias("n_docs"), F.max("longest_run").alias("longest_run"), F.round(F.max("share"), 4).alias("best_share"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return lookalike.variant_pairs(lookalike.look_groups(table(spark, d, "documents"), "doc_id", "text")).distinct()


def p10_classes(spark: SparkSession, d: str) -> DataFrame:
    hashed = lookalike.look_groups(table(spark, d, "documents"), "doc_id", "text")
    return lookalike.variant_members(hashed).select(F.col("id").alias("doc_id"), "class_id", "n_forms")


def p10_canonical(spark: SparkSession, d: str) -> DataFrame:
    return textform.canonical_text(table(spark, d, "documents").select("doc_id", "text"), "text", "form").select("doc_id", "form")


QUERIES = {f.__name__: f for f in (
    p6_found, p6_split, p6_report, p6_components, p6_balance, p8_pack_512, p8_pack_2048, p8_restored_512, p8_restored_2048, p8_fill, p8_buckets_512, p8_buckets_2048,
    p9_found, p9_leaks, p9_runs, p9_items, p10_found, p10_classes, p10_canonical,
)}
