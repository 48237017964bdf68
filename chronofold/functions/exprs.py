"""Scalar expressions: text, categories, time, numbers. Every function takes and returns Columns and stays in the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Texts that mean a missing value.
TEXT_PLACEHOLDERS = ("", "nan", "none", "<na>")
# Unquoted fields that a CSV reader takes as missing.
CSV_NULLS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
# Needles in order of priority, and the category of each.
ADMISSION_TYPES = (("elective", "elective"), ("emerg", "emergency"), ("urgent", "urgent"))
MARITAL = (("married", "married"), ("single", "single"), ("divorc", "divorced"), ("widow", "widowed"))
RACES = (("white", "white"), ("black", "black"), ("asian", "asian"), ("hispanic", "hispanic_latino"), ("latino", "hispanic_latino"))
# Words of an intensive care unit's name.
ICU_WORDS = ("icu", "medical intensive care unit", "surgical intensive care unit", "micu", "sicu", "tsicu", "nicu", "ccu", "cardiac care unit", "coronary care unit", "neuro intensive care unit")
# Laboratory flags that mean abnormal, and interpretations that mean resistant.
ABNORMAL = ("abnormal", "high", "low", "h", "l", "hh", "ll", "a")
RESISTANT = ("r", "resistant")


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(col(c), r"^\s+|\s+$", "")


def missing_to_null(c: Column | str, placeholders: Sequence[str] = TEXT_PLACEHOLDERS) -> Column:
    """Stripped, case kept; null if it is a placeholder in any case."""
    text = strip(c)
    return F.when(~F.lower(text).isin(*placeholders), text)


def normalize_text(c: Column | str) -> Column:
    """Stripped and in lower case; null if it is a placeholder."""
    return F.lower(missing_to_null(c))


def normalize_category(c: Column | str) -> Column:
    return F.lower(strip(col(c).cast("string")))


def collapse(c: Column | str, rules: Sequence[tuple[str, str]], other: str = "other") -> Column:
    """The category of the first needle that the text contains, else ``other``; null stays null."""
    text = normalize_category(c)
    out = F.when(text.isNull(), F.lit(None).cast("string"))
    for needle, label in rules:
        out = out.when(text.contains(needle), label)
    return out.otherwise(other)


def gender_code(c: Column | str) -> Column:
    text = normalize_category(c)
    return F.when(text == "m", 1).when(text == "f", 0)


def keyword_flag(c: Column | str, keywords: Sequence[str]) -> Column:
    """1 if the text contains any keyword (in any case), else 0, null included."""
    pattern = "|".join("".join(x if x.isalnum() or x == " " else f"\\{x}" for x in k) for k in keywords)
    return F.coalesce(F.lower(col(c)).rlike(pattern), F.lit(False)).cast("int")


def contains_flag(c: Column | str, needle: str) -> Column:
    return F.coalesce(F.lower(col(c)).contains(needle), F.lit(False)).cast("int")


def member_flag(c: Column | str, values: Sequence[str]) -> Column:
    """1 if the normalised text is one of ``values``, else 0, null included."""
    return F.coalesce(normalize_text(c).isin(*values), F.lit(False)).cast("int")


PAIR = r"^\s*(\d{2,3})\s*/\s*(\d{2,3})\s*$"


def parse_pair(c: Column | str) -> tuple[Column, Column]:
    """Both numbers of a text like ``120/80``; null and null if it isn't one."""
    return tuple(F.nullif(F.regexp_extract(col(c), PAIR, i), F.lit("")).cast("double") for i in (1, 2))


def strip_prefix(c: Column | str, prefix: str) -> Column:
    return F.when(col(c).startswith(prefix), F.substring(col(c), len(prefix) + 1, 1_000_000)).otherwise(col(c))


def title_case(c: Column | str) -> Column:
    """A capital after every blank and underscore."""
    return F.array_join(F.transform(F.split(col(c), "_"), F.initcap), "_")


def weekday(t: Column | str) -> Column:
    """Monday is 0."""
    return F.weekday(col(t))


def midnight(t: Column | str) -> Column:
    return F.date_trunc("day", col(t)).cast("timestamp_ntz")


def hours_between(a: Column | str, b: Column | str) -> Column:
    return F.timestamp_diff("MICROSECOND", col(a), col(b)) / 3.6e9


def days_between(a: Column | str, b: Column | str) -> Column:
    return F.timestamp_diff("MICROSECOND", col(a), col(b)) / 8.64e10


def round_int(c: Column | str) -> Column:
    """The nearest integer, halves to the even one."""
    return F.bround(col(c), 0).cast("int")


def round_2(c: Column | str) -> Column:
    """Two decimals, halves to the even one. The ninth decimal and beyond is taken as the noise of sums, whose order isn't fixed, so a half is a half in any order."""
    return F.bround(F.round(col(c), 8), 2)


def age_at(anchor_age: Column | str, anchor_year: Column | str, t: Column | str) -> Column:
    """The anchor age moved by the years since the anchor year, or as it is without an anchor year."""
    return round_int(F.coalesce(col(anchor_age) + (F.year(col(t)) - col(anchor_year)), col(anchor_age)))


def emergency_hours(start: Column | str, end: Column | str) -> Column:
    """Hours in the emergency department: 0 if neither time is known, null if one is."""
    return F.when(col(start).isNull() & col(end).isNull(), F.lit(0.0)).otherwise(round_2(hours_between(start, end)))


def range_position(value: Column | str, low: Column | str, high: Column | str) -> Column:
    """0 at the low end and 1 at the high end of a reference range; null if the range is empty or anything is missing."""
    v, lo, hi = (number(x) for x in (value, low, high))
    return F.when(hi > lo, (v - lo) / F.nullif(hi - lo, F.lit(0.0)))


def number(c: Column | str) -> Column:
    """As a double; null for null, NaN and anything that is no number."""
    return F.nanvl(col(c).try_cast("double"), F.lit(None).cast("double"))


def moment(c: Column | str) -> Column:
    """As a time without zone, or null."""
    return col(c).try_cast("timestamp_ntz")


def bucket(c: Column | str, n: int) -> Column:
    return F.pmod(col(c), F.lit(n)).cast("int")


def first_valid(df: DataFrame, candidates: Sequence[str], kind: str = "timestamp_ntz") -> Column:
    """The first that isn't null of the candidate columns that the table has."""
    there = [F.col(c) for c in candidates if c in df.columns]
    return F.coalesce(*there) if there else F.lit(None).cast(kind)


def label_at(score: Column | str, threshold: float) -> Column:
    """1 from the threshold on, else 0; null stays null."""
    return (col(score) >= threshold).cast("int")


def mapped(c: Column | str, values: dict, other: Column | None = None) -> Column:
    """The value mapped to; ``other`` (null if not given) for values that aren't in the map."""
    out = None
    for k, v in values.items():
        out = F.when(col(c) == k, v) if out is None else out.when(col(c) == k, v)
    return out.otherwise(other) if other is not None else out


def right_closed_bins(c: Column | str, upper: Sequence[float], labels: Sequence[str]) -> Column:
    """The label of the first bin whose upper end isn't below the value; the last label is for all above; null for null and NaN."""
    v = number(c)
    out = F.when(v.isNull(), F.lit(None).cast("string"))
    for end, label in zip(upper, labels[:-1], strict=True):
        out = out.when(v <= end, label)
    return out.otherwise(labels[-1])


def only_levels(c: Column | str, levels: Sequence[str]) -> Column:
    return F.when(col(c).isin(*levels), col(c))


def widest(columns: Sequence[str], prefix: str = "", none: str = "Unknown") -> Column:
    """The name (without prefix) of the first column that holds the greatest value of a row; ``none`` if all are 0 or null."""
    values = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns]
    top = F.greatest(*values) if len(values) > 1 else values[0]
    out = F.when(top == 0, none)
    for name, v in zip(columns, values, strict=True):
        out = out.when(v == top, name.removeprefix(prefix))
    return out
