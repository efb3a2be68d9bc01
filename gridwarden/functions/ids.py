"""Gateway id forms: bare 12 hex digits or six colon-separated pairs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

# The two valid forms of an id.
BARE_ID = "^[0-9A-Fa-f]{12}$"
COLON_ID = "^([0-9A-Fa-f]{2}:){5}[0-9A-Fa-f]{2}$"


def clean_id(c: Column, drop_spaces: bool = False) -> Column:
    """Remove colons, upper-case, strip; ``drop_spaces`` also removes inner blanks. Null stays null."""
    text = F.replace(c.cast("string"), F.lit(":"), F.lit(""))
    if drop_spaces:
        text = F.replace(text, F.lit(" "), F.lit(""))
    return strip(F.upper(text))


def canonical_id(c: Column) -> Column:
    """Bare upper-case id when the value is one of the two valid forms, else null."""
    text = strip(c.cast("string"))
    return F.when(text.rlike(BARE_ID), F.upper(text)).when(
        text.rlike(COLON_ID), F.upper(F.replace(text, F.lit(":"), F.lit("")))
    )
