"""Text columns: whitespace, normalisation, membership flags."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every white-space character of Unicode; Spark's own trim knows only the blank.
WHITESPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())

# Outcome terms, German and English.
FIXED_OUTCOMES = ("fehler behoben", "problem behoben", "problem fixed", "fixed")
NOTHING_FOUND_OUTCOMES = ("kein fehler gefunden", "kein fehler", "no problem found", "no fault found")
# Spellings of "no part".
NO_PART = ("", "nan", "none", "na", "n a")
# The spellings a CSV reader should treat as missing.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def strip(c: Column) -> Column:
    return F.trim(c, F.lit(WHITESPACE))


def blank_if_null(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


@lru_cache(maxsize=1)
def _ascii_foldings() -> tuple[str, str, str, str]:
    """Compatibility decomposition followed by dropping non-ASCII maps each code point on its own,
    so the whole rule is a character table: (one-to-one source, target, one-to-many source, map text).
    """
    source, target, many, pairs = [], [], [], []
    for code in range(0x80, 0x20000):  # beyond this plane nothing decomposes to ASCII
        char = chr(code)
        if unicodedata.decomposition(char) == "":
            continue
        folded = "".join(p for p in unicodedata.normalize("NFKD", char) if p.isascii())
        if len(folded) == 1:
            source.append(char)
            target.append(folded)
        elif folded:
            many.append(char)
            pairs.append(f"{char}\x02{folded}")
    return "".join(source), "".join(target), "".join(many), "\x01".join(pairs)


def fold_to_ascii(c: Column) -> Column:
    """NFKD, then keep ASCII only. Pure-ASCII values (the usual case) pass through untouched."""
    source, target, many, pairs = _ascii_foldings()
    expansions = F.str_to_map(F.lit(pairs), F.lit("\x01"), F.lit("\x02"))
    expanded = F.array_join(
        F.transform(F.split(c, ""), lambda ch: F.coalesce(F.try_element_at(expansions, ch), ch)), ""
    )
    # a translate is a hash lookup per character; a regex class of this size is a long chain of tests
    has_many = F.char_length(F.translate(c, many, "")) < F.char_length(c)
    wide = F.when(has_many, expanded).otherwise(c)
    folded = F.regexp_replace(F.translate(wide, source, target), r"[^\x00-\x7f]+", "")
    return F.when(F.octet_length(c) > F.char_length(c), folded).otherwise(c)


def normalize_text(c: Column) -> Column:
    """Null to empty, strip, lower, fold to ASCII, collapse runs of white space."""
    lowered = F.lower(strip(blank_if_null(c)))
    return F.regexp_replace(fold_to_ascii(lowered), r"[\t-\r\x1c-\x20]+", " ")


def is_one_of(c: Column, terms: Iterable[str]) -> Column:
    """0/1 membership flag; null is 0."""
    return F.coalesce(c.isin(*terms), F.lit(False)).cast("int")


def part_replaced(normalized: Column, none_terms: Iterable[str] = NO_PART) -> Column:
    return (~normalized.isin(*none_terms)).cast("int")


def binary_target(category: Column, positive: str = "schlecht") -> Column:
    """1 where the trimmed, lower-cased category is the positive class, else 0 (null included)."""
    return is_one_of(F.lower(strip(category.cast("string"))), [positive])
