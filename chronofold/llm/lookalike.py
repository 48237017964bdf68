"""Texts that look the same but differ in their characters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronofold.llm.textform import look_hashes
from chronofold.operators.skew import TASK_ROWS, salted_join
from chronofold.session import materialize


def look_groups(docs: DataFrame, id_col: str, text_col: str, confusables: str | None = None) -> DataFrame:
    """(id, look, exact) of every text, hashed once and written to the shared folder. ``confusables``: see look_hashes()."""
    return materialize(look_hashes(docs, id_col, text_col, confusables))


def variant_members(hashed: DataFrame) -> DataFrame:
    """(id, look, class_id, n_forms): a row per document, the least id among those that look the same, and the number of different forms."""
    forms = hashed.groupBy("look", "exact").agg(F.min("id").alias("id1"))
    groups = forms.groupBy("look").agg(F.min("id1").alias("class_id"), F.count(F.lit(1)).alias("n_forms"))
    return salted_join(hashed.select("id", "look"), groups, ["look"])


def variant_pairs(hashed: DataFrame, *, floor: int = TASK_ROWS) -> DataFrame:
    """(doc_id_a, doc_id_b), a below b: every two documents of one look and different characters.

    Exact copies are one class each; only classes of a look that has several meet, and the pairs of
    classes are then expanded to their members, the smaller class first, hot classes in salted parts.
    No pair of equal texts is ever formed. Repeated rows of an id give no pair of the id with itself.
    """
    forms = hashed.groupBy("look", "exact").agg(F.count(F.lit(1)).alias("n"))
    several = forms.groupBy("look").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("look")
    forms = forms.join(several, "look", "left_semi")
    b = forms.select("look", F.col("exact").alias("exact_b"), F.col("n").alias("n_b"))
    met = salted_join(forms, b, ["look"], floor=floor).where(F.struct("n", "exact") < F.struct(F.col("n_b").alias("n"), F.col("exact_b").alias("exact")))
    members = hashed.select("id", "exact")
    small = salted_join(members, met.select("exact", "exact_b"), ["exact"], floor=floor).select(F.col("id").alias("id_s"), F.col("exact_b").alias("exact"))
    pairs = salted_join(members, small, ["exact"], floor=floor)
    return pairs.where(F.col("id") != F.col("id_s")).select(F.least("id", "id_s").alias("doc_id_a"), F.greatest("id", "id_s").alias("doc_id_b"))
