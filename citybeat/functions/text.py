"""String normalisation used by traffic counts and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from citybeat.constants import QUARTER_PATTERN


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def normalize_direction(col: Column | str, parity: bool = False) -> Column:
    """Trim + upper; empty becomes 'UNK' (P10).

    A null direction also becomes 'UNK'.  With ``parity=True`` it becomes
    'NAN', which is what stringifying a missing value produced originally.
    """
    s = F.upper(F.trim(_c(col)))
    null_label = "NAN" if parity else "UNK"
    return F.when(s.isNull(), F.lit(null_label)).when(s == "", F.lit("UNK")).otherwise(s)


def normalize_borough(col: Column | str) -> Column:
    """Trim + title case: a letter is upper case unless it follows a letter."""
    chars = F.split(F.lower(F.trim(_c(col))), "")
    titled = F.transform(
        chars, lambda c, i: F.when((i > 0) & F.get(chars, i - 1).rlike(r"\p{L}"), c).otherwise(F.upper(c))
    )
    return F.array_join(titled, "")


def corridor_label(parts: Sequence[Column | str], sep: str = " | ", empty: str = "Unknown") -> Column:
    """Non-empty trimmed parts joined by ``sep``; 'Unknown' when none."""
    cleaned = [F.nullif(F.trim(_c(p)), F.lit("")) for p in parts]
    joined = F.concat_ws(sep, *cleaned)
    return F.when(joined == "", F.lit(empty)).otherwise(joined)


def collapse_whitespace(col: Column | str) -> Column:
    """Trim and squeeze internal whitespace runs to one space."""
    return F.trim(F.regexp_replace(_c(col), r"\s+", " "))


def quarter_from_name(col: Column | str) -> Column:
    """'Q1-2024' style quarter found in a file name, else 'UNKNOWN' (P18)."""
    found = F.regexp_extract(F.lower(_c(col)), QUARTER_PATTERN, 0)
    return F.when(found == "", F.lit("UNKNOWN")).otherwise(F.upper(found))


def metadata_value(col: Column | str, key: str) -> Column:
    """Value of a 'KEY: value' cell whose upper-cased text starts with ``key``."""
    s = F.trim(_c(col))
    parts = F.split(s, ":", 2)
    return F.when(F.upper(s).startswith(key.upper()) & (F.size(parts) == 2), F.trim(parts[1]))
