"""SQL of the llm queries, written independently of the operators."""

from __future__ import annotations

import unicodedata

# What looks alike, written down apart from the operator's table so that a letter missing there shows. Above the letters that occur, below the shapes.
_ALIKE = [
    ("АВЕКМНОРСТУҮХЅІЈԚԜѴаеорсуүхѕіјһԁԛԝѵӀӏГПФѲк",
     "ABEKMHOPCTYYXSIJQWVaeopcyyxsijhdqwvllΓΠΦΘκ"),
    ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹαινορυϲϳɑɡıɩ",
     "ABEZHIKMNOPTYXCaivopucjagii"),
    ("ԼՕՍՏօոսհցզյᎪᏴᏟᎠᎬᏀᎻᎫᏦᏞᎷᏢᎡᏚᎢᏙᏔᏃ",
     "LOUSonuhgqjABCDEGHJKLMPRSTVWZ"),
    ("ⲂⲎⲒⲔⲘⲚⲞⲢⲤⲦⲨⲬⲟⲣⲥꓐꓑꓓꓔꓖꓗꓙꓚꓜꓝꓟꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ‐‑",
     "BHIKMNOPCTYXopcBPDTGKJCZFMNLSRVHWXYAEIOU--"),
]
_SHAPE = {a: b for left, right in _ALIKE for a, b in zip(left, right, strict=True)}
_WIDE = {chr(c): chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)}
_BLANK = dict.fromkeys("\t\u00a0\u1680\u2800\u3000\u202f\u205f\u1160\u115f" + "".join(map(chr, range(0x2000, 0x200B))), " ")
_UNSEEN = "[\\x{00AD}\\x{034F}\\x{061C}\\x{180E}\\x{200B}-\\x{200F}\\x{202A}-\\x{202E}\\x{2060}-\\x{2064}\\x{2066}-\\x{2069}\\x{FE0E}\\x{FE0F}\\x{FEFF}]"
# Accented letters of other scripts whose base has a shape above; each is taken apart, as nfc_normalize doesn't compose across a look-alike.
_ACCENTED = [c for c in map(chr, [*range(0x370, 0x530)]) if len(d := unicodedata.normalize("NFD", c)) > 1 and d[0] in _SHAPE]


def _translate(text: str, table: dict[str, str]) -> str:
    quote = lambda x: x.replace("'", "''")
    return f"translate({text}, '{quote(''.join(table))}', '{quote(''.join(table.values()))}')"


def _look(text: str) -> str:
    """Unseen characters dropped, accents taken apart, shapes put in place, accents composed again."""
    out = f"regexp_replace({text}, '{_UNSEEN}', '', 'g')"
    for c in _ACCENTED:
        out = f"replace({out}, '{c}', '{unicodedata.normalize('NFD', c)}')"
    return f"nfc_normalize({_translate(out, _WIDE | _BLANK | _SHAPE)})"


def _folded() -> dict[str, str]:
    """Small letters that are equal by case or by shape, each with the least of those it is equal to, directly or through others."""
    of: dict[str, set[str]] = {}
    for a, b in _SHAPE.items():
        both = {a.lower(), b.lower()}
        both = both.union(*(of.get(x, ()) for x in both))
        for x in both:
            of[x] = both
    return {x: min(group) for x, group in of.items() if min(group) != x} | {"\u03c2": "\u03c3"}


def _words(text: str) -> str:
    return f"regexp_extract_all({_translate(f'lower({_look(text)})', _folded())}, '(?:[\\p{{L}}\\p{{N}}]\\p{{M}}*)+')"


def _runs(name: str, key: str, source: str, n: int = 8) -> str:
    return f"{name}_w AS (SELECT {key}, {_words('text')} AS w FROM {source}), {name} AS (SELECT DISTINCT {key}, unnest(list_transform(range(1, len(w) - {n - 2}), lambda i: array_to_string(w[i:i + {n - 1}], ' '))) AS run FROM {name}_w WHERE len(w) >= {n})"


_PLACED = "SELECT {key}, w, unnest(range(1, len(w) - 6)) AS pos FROM {name}_w WHERE len(w) >= 8"
_SHARES = {"train": 0.70, "test": 0.15, "deployment": 0.15}


def _restored() -> str:
    return "SELECT doc_id, length(coalesce(text, '')) AS n_chars, md5(coalesce(text, '')) AS digest FROM documents"


SQL = {
    "p6_found": """SELECT m.subject_id FROM master_table_model_ready m JOIN split_assignment a USING (hadm_id) WHERE a.split_name IS NOT NULL
GROUP BY m.subject_id HAVING count(DISTINCT lower(trim(a.split_name))) > 1""",
    "p6_components": """WITH RECURSIVE m AS (SELECT DISTINCT subject_id, hadm_id FROM master_table_model_ready),
reach(subject_id, other) AS (SELECT DISTINCT subject_id, subject_id FROM m UNION SELECT r.subject_id, b.subject_id FROM reach r JOIN m a ON a.subject_id = r.other JOIN m b ON b.hadm_id = a.hadm_id),
least AS (SELECT r.subject_id, min(m.hadm_id) AS first_hadm_id FROM reach r JOIN m ON m.subject_id = r.other GROUP BY r.subject_id)
SELECT m.hadm_id, least.first_hadm_id FROM m JOIN least USING (subject_id)""",
    "p6_balance": " UNION ALL ".join(f"SELECT '{name}' AS split, 0::BIGINT AS n_torn, true AS rows_near, true AS positives_near" for name in _SHARES),
    "p8_restored_512": _restored(),
    "p8_restored_2048": _restored(),
    "p9_found": f"WITH {_runs('d', 'doc_id', 'documents')}, {_runs('e', 'item_id', 'eval_items')} SELECT DISTINCT doc_id, item_id FROM d JOIN e USING (run)",
    "p9_runs": f"""WITH d_w AS (SELECT doc_id, {_words('text')} AS w FROM documents), e_w AS (SELECT item_id, {_words('text')} AS w FROM eval_items),
d AS (SELECT doc_id, pos, array_to_string(w[pos:pos + 7], ' ') AS run FROM ({_PLACED.format(key='doc_id', name='d')})), e AS (SELECT item_id, pos, array_to_string(w[pos:pos + 7], ' ') AS run FROM ({_PLACED.format(key='item_id', name='e')})),
same AS (SELECT DISTINCT doc_id, item_id, d.pos, d.pos - e.pos AS line FROM d JOIN e USING (run)), numbered AS (SELECT *, pos - row_number() OVER (PARTITION BY doc_id, item_id, line ORDER BY pos) AS island FROM same)
SELECT doc_id, item_id, max(n)::INT AS longest_run FROM (SELECT doc_id, item_id, count(*) + 7 AS n FROM numbered GROUP BY doc_id, item_id, line, island) GROUP BY doc_id, item_id""",
    "p10_found": f"""WITH f AS (SELECT doc_id, text, {_look('text')} AS look FROM documents)
SELECT a.doc_id AS doc_id_a, b.doc_id AS doc_id_b FROM f a JOIN f b ON a.look = b.look AND a.doc_id < b.doc_id AND a.text <> b.text""",
    "p10_classes": f"""WITH f AS (SELECT doc_id, text, {_look('text')} AS look FROM documents),
g AS (SELECT look, min(doc_id) AS class_id, count(DISTINCT text) AS n_forms FROM f GROUP BY look) SELECT doc_id, class_id, n_forms FROM f JOIN g USING (look)""",
    "p10_canonical": f"SELECT doc_id, {_look('text')} AS form FROM documents",
}
