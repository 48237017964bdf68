"""One form for texts that look alike: the skeleton, its hash, and words folded for comparison."""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Letters of other scripts and the letter of the same shape, by script; the rest of what looks alike follows from the decompositions of Unicode (_shape).
LOOK_ALIKES = {
    # Cyrillic
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Ү": "Y", "Х": "X", "Ѕ": "S", "І": "I", "Ј": "J", "Ԛ": "Q", "Ԝ": "W", "Ѵ": "V",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "ү": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ѵ": "v", "Ӏ": "l", "ӏ": "l",
    # Greek
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "Ϲ": "C",
    "α": "a", "ι": "i", "ν": "v", "ο": "o", "ρ": "p", "υ": "u", "ϲ": "c", "ϳ": "j",
    # Cyrillic letters of the shape of Greek ones
    "Г": "Γ", "П": "Π", "Ф": "Φ", "Ѳ": "Θ", "к": "κ",
    # Latin
    "ɑ": "a", "ɡ": "g", "ı": "i", "ɩ": "i",
    # Armenian
    "Լ": "L", "Օ": "O", "Ս": "U", "Տ": "S", "օ": "o", "ո": "n", "ս": "u", "հ": "h", "ց": "g", "զ": "q", "յ": "j",
    # Cherokee
    "Ꭺ": "A", "Ᏼ": "B", "Ꮯ": "C", "Ꭰ": "D", "Ꭼ": "E", "Ꮐ": "G", "Ꮋ": "H", "Ꭻ": "J", "Ꮶ": "K", "Ꮮ": "L", "Ꮇ": "M", "Ꮲ": "P", "Ꭱ": "R", "Ꮪ": "S", "Ꭲ": "T", "Ꮩ": "V", "Ꮃ": "W", "Ꮓ": "Z",
    # Coptic
    "Ⲃ": "B", "Ⲏ": "H", "Ⲓ": "I", "Ⲕ": "K", "Ⲙ": "M", "Ⲛ": "N", "Ⲟ": "O", "Ⲣ": "P", "Ⲥ": "C", "Ⲧ": "T", "Ⲩ": "Y", "Ⲭ": "X", "ⲟ": "o", "ⲣ": "p", "ⲥ": "c",
    # Lisu
    "ꓐ": "B", "ꓑ": "P", "ꓓ": "D", "ꓔ": "T", "ꓖ": "G", "ꓗ": "K", "ꓙ": "J", "ꓚ": "C", "ꓜ": "Z", "ꓝ": "F", "ꓟ": "M", "ꓠ": "N", "ꓡ": "L", "ꓢ": "S", "ꓣ": "R", "ꓦ": "V", "ꓧ": "H", "ꓪ": "W", "ꓫ": "X", "ꓬ": "Y", "ꓮ": "A", "ꓰ": "E", "ꓲ": "I", "ꓳ": "O", "ꓴ": "U",
    # The hyphen that is no minus sign
    "\u2010": "-",
}
# Characters without any look of their own.
INVISIBLE = "\u00ad\u034f\u061c\u180e\u200b\u200c\u200d\u200e\u200f\u202a\u202b\u202c\u202d\u202e\u2060\u2061\u2062\u2063\u2064\u2066\u2067\u2068\u2069\ufeff\ufe0e\ufe0f"
# Kinds of blank that don't break the line, beside those whose decomposition is U+0020.
BLANKS = "\t\u1680\u2800\u1160\u115f"
# The kinds of compatibility decomposition that keep the look. Raised, lowered, circled, squared, small and vertical forms and fractions look different.
SAME_LOOK = ("<font>", "<wide>", "<narrow>", "<noBreak>", "<initial>", "<medial>", "<final>", "<isolated>", "<compat>")
# Fixed value: the long s looks like no s.
_OWN_LOOK = "\u017f"


def _shape(c: str) -> str:
    """The character, or what it is composed of if that looks the same: forms of width, font and position, ligatures, kinds of blank; not the accents that stand alone."""
    kind, _, codes = unicodedata.decomposition(c).partition(" ")
    if kind not in SAME_LOOK or c in _OWN_LOOK:
        return c
    parts = [chr(int(x, 16)) for x in codes.split()]
    if parts[0] == " " and len(parts) > 1:
        return c
    return "".join(map(_shape, parts))


class Prototypes(dict):
    """A table for str.translate: the prototype of every character, worked out when it first occurs."""

    def __init__(self, table: dict[str, str]) -> None:
        super().__init__()
        self.table = table | dict.fromkeys(INVISIBLE, "") | dict.fromkeys(BLANKS, " ")

    def __missing__(self, code: int) -> str:
        parts = unicodedata.normalize("NFD", _shape(chr(code)))
        self[code] = out = "".join(self.table.get(x, x) for x in parts)
        return out


@lru_cache(maxsize=4)
def read_confusables(path: str) -> Prototypes:
    """The prototypes of a file in the format of Unicode's confusables data (source ; target ; type), in place of LOOK_ALIKES: a character on the left becomes the characters on the right."""
    table = {}
    with open(path, encoding="utf-8-sig") as f:
        for line in f:
            fields = line.partition("#")[0].split(";")
            if len(fields) >= 2 and len(fields[0].split()) == 1:
                table[chr(int(fields[0], 16))] = unicodedata.normalize("NFD", "".join(chr(int(x, 16)) for x in fields[1].split()))
    return Prototypes(table)


_DEFAULT = Prototypes(LOOK_ALIKES)


def skeleton(text: str, prototypes: Prototypes = _DEFAULT) -> str:
    """Decompose, put the prototype in place of each character, decompose again.

    Full-width forms, kinds of blank, ligatures, invisible characters, look-alike letters and the way an accent is encoded make no
    difference any more; case, accents, punctuation, raised and circled forms, line breaks and order do.
    """
    if text.isascii() and prototypes is _DEFAULT:
        return text.replace("\t", " ")
    out = unicodedata.normalize("NFD", text).translate(prototypes)
    return out if out.isascii() else unicodedata.normalize("NFD", out)


def _fold_table() -> dict[int, str]:
    """Letters that are the same but for case or look, closed over both, each with the first of them: в is B's small letter, and В looks like B, so в is b; ν is N's and looks like v, so v is n."""
    root: dict[str, str] = {}

    def find(c: str) -> str:
        while root.setdefault(c, c) != c:
            c = root[c]
        return c

    for other, like in LOOK_ALIKES.items():
        a, b = sorted((find(other.casefold()), find(like.casefold())))
        root[b] = a
    return {ord(c): find(c) for c in list(root) if find(c) != c and len(c) == 1}


_FOLD = _fold_table()
# A word is a run of letters, digits and their combining marks.
_WORD = re.compile(r"(?:[^\W_][\u0300-\u036f]*)+")


def words(text: str | None) -> list[str]:
    """The words of a text, compared without case, punctuation, blanks and differences of look."""
    if not text:
        return []
    form = skeleton(text).casefold()
    if not form.isascii():
        form = unicodedata.normalize("NFD", form)
    return _WORD.findall(form.translate(_FOLD))


def digest(text: str) -> bytes:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def look_hashes(docs: DataFrame, id_col: str, text_col: str, confusables: str | None = None) -> DataFrame:
    """(id, look, exact): 128-bit hashes of the skeleton and of the characters. Null texts are left out. ``confusables``: a file for read_confusables(), on every executor."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of = read_confusables(confusables) if confusables else _DEFAULT
        for b in batches:
            yield pd.DataFrame({"id": b["id"], "look": [digest(skeleton(t, of)) for t in b["text"]], "exact": [digest(t) for t in b["text"]]})

    kind = dict(docs.dtypes)[id_col]
    slim = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return slim.mapInPandas(run, f"id {kind}, look binary, exact binary")


def canonical_text(docs: DataFrame, text_col: str, out: str, confusables: str | None = None) -> DataFrame:
    """``docs`` with ``out``, the composed skeleton of the text; null stays null."""

    @F.pandas_udf("string")
    def form(s: pd.Series) -> pd.Series:
        of = read_confusables(confusables) if confusables else _DEFAULT
        return s.map(lambda t: None if t is None else unicodedata.normalize("NFC", skeleton(t, of)))

    return docs.withColumn(out, form(F.col(text_col)))
