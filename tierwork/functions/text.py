"""String expressions and column-name cleaning."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

MISSING = "NaN"


def normalise_missing(col: Column, placeholder: str = MISSING, trim: bool = True) -> Column:
    """NULL and blank text become the placeholder.

    With ``trim=False`` only the empty string and one single space count as blank.
    """
    blank = (F.trim(col) == "") if trim else col.isin("", " ")
    return F.when(col.isNull() | blank, F.lit(placeholder)).otherwise(col)


def denormalise_missing(col: Column, placeholder: str = MISSING) -> Column:
    return F.nullif(col, F.lit(placeholder))


def is_missing(col: Column) -> Column:
    """True for NULL, empty and whitespace-only text."""
    return col.isNull() | (F.regexp_replace(col, r"\s", "") == "")


def after_marker(col: Column, marker: str, length: int) -> Column:
    """The ``length`` characters that follow the first occurrence of ``marker``; NULL when it is absent."""
    at = F.locate(marker, col)
    return F.when(at > 0, F.substr(col, at + len(marker), F.lit(length)))


def leading_int(col: Column) -> Column:
    """Integer at the start of the text, 0 when there is none."""
    return F.coalesce(F.nullif(F.regexp_extract(col, r"^(\d+)", 1), F.lit("")).cast("int"), F.lit(0))


def similarity(a: Column, b: Column) -> Column:
    """1 - edit distance / length of the longer text; 1 for two empty texts."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, F.lit(1.0)).otherwise(1.0 - F.levenshtein(a, b) / longest.cast("double"))


def case_insensitive_regex(pattern: str) -> str:
    return f"(?i){pattern}"


def parquet_name(name: str) -> str:
    """Drop the characters Parquet column names may not carry."""
    return re.sub(r"[ ,;{}()\[\]\n\t=]", "", name)


def snake_name(name: str) -> str:
    return re.sub(r"_+", "_", re.sub(r"[^0-9a-zA-Z]", "_", name)).strip("_").lower()
