"""Text columns: accent folding, the wikipedia test, ids and links."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters whose folded form has more than one letter, or no decomposition.
LONG_FOLDS = {
    "Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "ß": "ss", "Þ": "TH", "þ": "th",
    "Ĳ": "IJ", "ĳ": "ij", "ŉ": "'n", "ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st",
    "«": "<<", "»": ">>", "…": "...", "№": "No", "℡": "TEL", "™": "TM", "©": "(C)", "®": "(R)", "℃": "C", "℉": "F",
    "¼": " 1/4", "½": " 1/2", "¾": " 3/4",
}
SINGLE_FOLDS = {
    "Ø": "O", "ø": "o", "Đ": "D", "đ": "d", "Ð": "D", "ð": "d", "Ł": "L", "ł": "l",
    "Ħ": "H", "ħ": "h", "ı": "i", "Ŋ": "N", "ŋ": "n", "ĸ": "q", "ſ": "s", "Ŧ": "T", "ŧ": "t", "Ё": "Е", "ё": "е",
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "―": "-", "−": "-", "‘": "'", "’": "'", "‚": ",", "‛": "'",
    "“": '"', "”": '"', "„": '"', "‟": '"', "‹": "<", "›": ">", "′": "'", "″": '"', "×": "*", "÷": "/",
}
WEB_ROOT = "https://www.openstreetmap.org/"


def _single_letter_folds() -> dict[str, str]:
    folds = dict(SINGLE_FOLDS)
    for code in [*range(0x00C0, 0x0250), *range(0x1E00, 0x1F00)]:
        base = "".join(c for c in unicodedata.normalize("NFD", chr(code)) if not unicodedata.combining(c))
        if len(base) == 1 and base.isascii() and base.isalpha():
            folds[chr(code)] = base
    folds |= {chr(0xFEE0 + code): chr(code) for code in range(0x21, 0x7F)}  # full-width forms
    return folds


_FOLDS = _single_letter_folds()
_FOLD_FROM = "".join(_FOLDS)
_FOLD_TO = "".join(_FOLDS.values())
_LONG = "[" + "".join(LONG_FOLDS) + "]"


def unaccent(text: Column) -> Column:
    """Letters without accents, case kept."""
    single = F.translate(text, _FOLD_FROM, _FOLD_TO)
    folds = F.array(*[F.struct(F.lit(letter).alias("letter"), F.lit(fold).alias("fold")) for letter, fold in LONG_FOLDS.items()])
    folded = F.aggregate(folds, single, lambda t, f: F.replace(t, f["letter"], f["fold"]))
    # most names are plain ASCII, and few others have a letter of a longer form: cheap tests spare them the replacements
    return F.when(F.octet_length(text) == F.length(text), text).when(~text.rlike(_LONG), single).otherwise(folded)


def _wiki_form(text: Column) -> Column:
    return F.replace(F.lower(unaccent(text)), F.lit("_"), F.lit(" "))


def test_wikipedia(name: Column, wikipedia: Column) -> Column:
    """``wikipedia`` when it contains the name, else NULL.

    The name is a LIKE pattern: ``%`` in it matches any text and a backslash escapes.
    """
    pattern, page = _wiki_form(name), _wiki_form(wikipedia)
    # Spark allows an escape only before a special character: drop the others
    valid = F.regexp_replace(F.concat(F.lit("%"), pattern, F.lit("%")), r"(\\[\\%])|\\(.)", "$1$2")
    special = F.contains(name, F.lit("%")) | F.contains(name, F.lit("\\"))
    found = F.when(special, F.like(page, valid)).otherwise(F.contains(page, pattern))
    return F.when(found, wikipedia)


test_wikipedia.__test__ = False


def to_id(osm_type: Column, osm_id: Column) -> Column:
    """``N123``"""
    return F.concat(osm_type, osm_id.cast("string"))


def to_web(osm_type: Column, osm_id: Column) -> Column:
    """Link of an OSM object; any type but N and W is a relation."""
    kind = F.when(osm_type == "N", "node").when(osm_type == "W", "way").otherwise("relation")
    return F.concat(F.lit(WEB_ROOT), kind, F.lit("/"), osm_id.cast("string"))


def id_to_web(object_id: Column) -> Column:
    """Link of an id such as ``N123``."""
    return to_web(F.substring(object_id, 1, 1), F.substr(object_id, F.lit(2)))


def ids_to_webs(ids: Column) -> Column:
    """Links of a comma list such as ``N1,W2``."""
    return F.array_join(F.transform(F.split(ids, ","), id_to_web), ", ")
