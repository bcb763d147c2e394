"""Text cleaning as native column expressions."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Mapping, Sequence
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "KEEP", "clean_text", "collapse_spaces", "keep_alphanumeric", "map_values",
    "normalize_career", "normalize_institution", "normalize_name", "null_if_token",
    "remove_stopwords", "strip_accents", "strip_spaces", "truncate_text",
    "short_key", "valid_or_null", "zero_pad_code", "clean_category", "NA_TOKENS", "STOP_WORDS",
]

# Words removed from career names, in this order.
STOP_WORDS = ("DE", "EN", "Y", "E", "LA", "DEL", "LAS", "LOS", "PARA")

# The CSV cell texts that mean "missing".
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)

# Every Unicode white-space character, including the four ASCII separators
# that a regex ``\s`` leaves out. Listed in a class, they spare the regex its slow Unicode mode.
_SPACES = "".join(c for c in map(chr, range(0x3001)) if c.isspace())

KEEP = object()


def short_key(col: Column) -> Column:
    """A text to compare and shuffle by: itself below 64 characters, else its SHA-256, which has 64."""
    return F.when(F.length(col) < 64, col).otherwise(F.sha2(col, 256))


def null_if_token(col: Column, tokens: Sequence[str] = NA_TOKENS) -> Column:
    """Null where the cell holds one of the missing-value texts."""
    return F.when(~col.isin(*tokens), col)


def strip_spaces(col: Column) -> Column:
    """Remove white space of any kind from both ends."""
    return F.btrim(col, F.lit(_SPACES))


def clean_text(col: Column, missing: str = "NAN") -> Column:
    """Upper-case, strip, and turn the literal missing marker into null."""
    return F.nullif(strip_spaces(F.upper(col.cast("string"))), F.lit(missing))


def zero_pad_code(col: Column, width: int = 6) -> Column:
    """Strip, left-pad with zeros after any sign, null unless ``width`` long."""
    code = strip_spaces(col.cast("string"))
    signed = code.rlike(r"^[+-]")
    padded = F.when(
        signed,
        F.concat(F.substring(code, 1, 1), F.lpad(F.substr(code, F.lit(2)), width - 1, "0")),
    ).otherwise(F.lpad(code, width, "0"))
    return F.when(F.length(code) <= width, padded)


def map_values(col: Column, mapping: Mapping[str, object], default: object = KEEP) -> Column:
    """Replace by dictionary; other values stay, or become ``default``."""
    pairs = [F.lit(item) for pair in mapping.items() for item in pair]
    hit = F.try_element_at(F.create_map(*pairs), col)
    if default is KEEP:
        return F.coalesce(hit, col)
    return hit if default is None else F.coalesce(hit, F.lit(default))


def valid_or_null(col: Column, valid: Sequence[object]) -> Column:
    """Null out values that are not in the list."""
    return F.when(col.isin(*valid), col)


def clean_category(
    col: Column,
    valid: Sequence[str] | None = None,
    mapping: Mapping[str, str] | None = None,
    normalize: bool = True,
) -> Column:
    """Clean text, then map spellings, then null what is not in the list."""
    out = clean_text(col) if normalize else col
    if mapping:
        out = map_values(out, mapping)
    if valid:
        out = valid_or_null(out, valid)
    return out


def _unaccented(char: str) -> str:
    """The character under its marks, found by undoing one composition at a time."""
    while True:
        parts = unicodedata.decomposition(char).split()
        if not parts or parts[0].startswith("<"):
            return char
        base, *marks = (chr(int(code, 16)) for code in parts)
        if any(unicodedata.category(mark) != "Mn" for mark in marks):
            return char
        char = base


@lru_cache(maxsize=1)
def _accent_table() -> tuple[str, str]:
    """All accented characters of Unicode, and their bases in the same order."""
    composed = [c for c in map(chr, range(0x80, sys.maxunicode + 1)) if unicodedata.decomposition(c)]
    bases = {c: _unaccented(c) for c in composed if unicodedata.category(c) != "Mn"}
    changed = {c: base for c, base in bases.items() if base != c}
    return "".join(changed), "".join(changed.values())


def strip_accents(col: Column) -> Column:
    """Replace accented characters by their base and delete combining marks.

    Characters that come apart into several letters (Hangul, some Indic vowel
    signs) stay whole; name normalisation deletes them in either form.
    """
    source, target = _accent_table()
    plain = F.regexp_replace(F.translate(col, source, target), r"\p{Mn}+", "")
    return F.when(col.rlike(r"[^\x00-\x7F]"), plain).otherwise(col)


def remove_stopwords(col: Column, words: Sequence[str] = STOP_WORDS) -> Column:
    """Replace each ``" WORD "`` by one space, word after word."""
    for word in words:
        col = F.replace(col, F.lit(f" {word} "), F.lit(" "))
    return col


def collapse_spaces(col: Column) -> Column:
    """One blank for each run of white space, none at the ends."""
    blanks = F.translate(col, _SPACES, " " * len(_SPACES))
    return F.btrim(F.regexp_replace(blanks, " {2,}", " "))


def keep_alphanumeric(col: Column) -> Column:
    """Delete all but A-Z, 0-9 and white space."""
    return F.regexp_replace(col, f"[^A-Z0-9{_SPACES}]+", "")


def normalize_name(col: Column, stopwords: Sequence[str] = ()) -> Column:
    """Comparable form of a name; null when nothing is left."""
    plain = strip_accents(clean_text(col))
    # Blanks are the only white space left after collapsing.
    flat = collapse_spaces(remove_stopwords(plain, stopwords))
    return F.nullif(F.regexp_replace(flat, "[^A-Z0-9 ]+", ""), F.lit(""))


def normalize_career(col: Column) -> Column:
    return normalize_name(col, STOP_WORDS)


def normalize_institution(col: Column) -> Column:
    return normalize_name(col)


def truncate_text(col: Column, n: int) -> Column:
    """First ``n`` characters, followed by dots when the text is longer."""
    return F.when(F.length(col) > n, F.concat(F.substring(col, 1, n), F.lit("..."))).otherwise(col)
