"""Timestamp parsing and calendar parts."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Shapes of a value, told apart by their digits and separators.
_YEAR_FIRST = r"^(\d{4})[-/](\d{1,2})[-/](\d{1,2})(?!\d)"
_MONTH_FIRST = r"^(\d{1,2})/(\d{1,2})/(\d{4})(?!\d)"
_SHORT_YEAR = r"^(\d{1,2})/(\d{1,2})/(\d{2})(?!\d)"
_DIGITS = r"^(\d{4})(\d{2})(\d{2})(?:[T ]?(\d{2})(\d{2})(\d{2})?)?$"
_NAMED = r"(?i)^(?:[a-z]{3,9},? )?([a-z]{3})[a-z]*\.? (\d{1,2})(?:st|nd|rd|th)?,? (\d{4})(?!\d)"
_DAY_NAMED = r"(?i)^(?:[a-z]{3,9},? )?(\d{1,2})[ -]([a-z]{3})[a-z]*\.?,?[ -](\d{4})(?!\d)"
# What may follow the date: a time of day with fraction and offset, or one with AM or PM.
_DAY = r"\d{4}-\d{1,2}-\d{1,2}"
_PLAIN = rf"^{_DAY}(?:[ T]\d{{1,2}}:\d{{1,2}}(?::\d{{1,2}}(?:\.\d+)?(?:Z|[+-]\d{{2}}:\d{{2}})?)?)?$"
_TWELVE = rf"(?i)^({_DAY})[ T](\d{{1,2}}):(\d{{2}})(?::(\d{{2}}))?(?:\.\d+)? ?([ap])\.?m\.?$"
_MONTHS = "JanFebMarAprMayJunJulAugSepOctNovDec"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _named(s: Column, pattern: str, month: int, day: int) -> Column:
    """A date with a month's name as yyyy-m-d and what follows it; month 0 for an unknown name."""
    name = F.initcap(F.regexp_extract(s, pattern, month))
    number = F.ceil(F.call_function("instr", F.lit(_MONTHS), name) / 3)
    return F.concat(
        F.regexp_extract(s, pattern, 3), F.lit("-"), number.cast("string"), F.lit("-"), F.regexp_extract(s, pattern, day),
        F.regexp_replace(s, pattern, ""),
    )


def parse_mixed_timestamp(col: Column | str, formats: Sequence[str] | None = None) -> Column:
    """Parse strings in mixed formats; unparsable values become null.

    The value's shape picks the order of its date (year first, month first,
    digits only, month by name); the date is written as yyyy-m-d, and one parser
    reads the result.  Two-digit years from 69 on are in the 1900s.  Offsets
    ('Z', '+02:00', '+0200') are converted to UTC; digits of a second beyond the
    sixth are cut.  Blank tokens ('', 'NaT', 'nan', 'None') have no such shape.
    With ``formats`` these are tried in their order instead.
    """
    s = F.trim(_c(col).cast("string"))
    if formats:
        return F.coalesce(*[F.try_to_timestamp(s, F.lit(fmt)) for fmt in formats])
    # most values are plain already; the others go through the shapes, each step evaluated once
    return F.when(s.rlike(_PLAIN), s.try_cast("timestamp")).otherwise(_let(s, lambda v: _let(_dated(v), _parsed)))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def _dated(s: Column) -> Column:
    """The value with its date as yyyy-m-d, or null for an unknown shape."""
    century = F.when(F.regexp_extract(s, _SHORT_YEAR, 3) >= "69", F.lit("19")).otherwise(F.lit("20"))
    clock = F.when(F.regexp_extract(s, _DIGITS, 4) != "", F.regexp_replace(s, _DIGITS, " $4:$5:0$6")).otherwise(F.lit(""))
    # seconds are there or not: '0' in front of two digits goes
    digits = F.regexp_replace(F.concat(F.regexp_replace(s, _DIGITS, "$1-$2-$3"), clock), r":0(\d{2})$", ":$1")
    return (
        F.when(s.rlike(_MONTH_FIRST), F.regexp_replace(s, _MONTH_FIRST, "$3-$1-$2"))
        .when(s.rlike(_YEAR_FIRST), F.regexp_replace(s, _YEAR_FIRST, "$1-$2-$3"))
        .when(s.rlike(_SHORT_YEAR), F.concat(century, F.regexp_replace(s, _SHORT_YEAR, "$3-$1-$2")))
        .when(s.rlike(_DIGITS), digits)
        .when(s.rlike(_NAMED), _named(s, _NAMED, 1, 2))
        .when(s.rlike(_DAY_NAMED), _named(s, _DAY_NAMED, 2, 1))
    )


def _parsed(dated: Column) -> Column:
    # one blank between date and time, none before an offset, a colon in it, seconds in front of it
    tidy = F.regexp_replace(dated, rf"^({_DAY})[ ,T]+", "$1 ")
    tidy = F.regexp_replace(tidy, r"(:\d{1,2}(?:\.\d+)?) ?(?:UTC|GMT|z)$", "$1Z")
    tidy = F.regexp_replace(tidy, r"(:\d{1,2}(?:\.\d+)?) ?([+-]\d{2}):?(\d{2})$", "$1$2:$3")
    tidy = F.regexp_replace(tidy, r"([ T]\d{1,2}:\d{1,2})(Z|[+-]\d{2}:\d{2})$", "$1:00$2")

    def read(t: Column) -> Column:
        parts = [F.regexp_extract(t, _TWELVE, i) for i in range(1, 6)]
        clock = F.concat(parts[0], F.lit(" "), parts[1], F.lit(":"), parts[2], F.lit(":"), F.lpad(parts[3], 2, "0"), F.lit(" "), F.upper(parts[4]), F.lit("M"))
        return F.when(t.rlike(_PLAIN), t.try_cast("timestamp")).when(
            t.rlike(_TWELVE), F.try_to_timestamp(clock, F.lit("yyyy-M-d h:mm:ss a"))
        )

    return _let(tidy, read)


def _floor_div(v: Column, by: int) -> Column:
    """Whole-number division rounding down."""
    return F.call_function("div", v - F.pmod(v, F.lit(by)), F.lit(by))


def epoch_to_timestamp(col: Column | str, integral: bool = False) -> Column:
    """Epoch number to timestamp, unit inferred from magnitude.

    >= 1e17 nanoseconds, >= 1e14 microseconds, >= 1e11 milliseconds, else
    seconds.  The reference decides per batch from the batch median; this is
    decided per row so the result does not depend on how rows are batched.
    ``integral`` columns are converted in whole numbers (a nanosecond count
    does not fit a double), others through doubles.
    """
    if integral:
        n = _c(col).cast("long")
        size = F.abs(n)
        return F.timestamp_micros(
            F.when(size >= 10**17, _floor_div(n, 1000))
            .when(size >= 10**14, n)
            .when(size >= 10**11, n * 1000)
            .otherwise(n * 1_000_000)
        )
    v = _c(col).cast("double")
    mag = F.abs(v)
    micros = (
        F.when(mag >= 1e17, v / 1000.0)
        .when(mag >= 1e14, v)
        .when(mag >= 1e11, v * 1000.0)
        .otherwise(v * 1_000_000.0)
    )
    return F.timestamp_micros(F.floor(micros).cast("long"))


def compact_digits_to_timestamp(col: Column | str) -> Column:
    """Digit-only dates of 14, 12 or 8 characters (P4), e.g. 20240131235959."""
    s = F.trim(_c(col).cast("string"))
    return (
        F.when(s.rlike(r"^[0-9]{14}$"), F.try_to_timestamp(s, F.lit("yyyyMMddHHmmss")))
        .when(s.rlike(r"^[0-9]{12}$"), F.try_to_timestamp(s, F.lit("yyyyMMddHHmm")))
        .when(s.rlike(r"^[0-9]{8}$"), F.try_to_timestamp(s, F.lit("yyyyMMdd")))
    )


def as_utc_timestamp(col: Column | str) -> Column:
    """Local-time timestamp (session zone UTC) from NTZ or LTZ input."""
    return _c(col).cast("timestamp")


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """(end - start) in minutes as double, null when either side is null."""
    s = F.unix_micros(as_utc_timestamp(start))
    e = F.unix_micros(as_utc_timestamp(end))
    return (e - s) / F.lit(60_000_000.0)


def weekday_mon0(col: Column | str) -> Column:
    """Day of week with Monday = 0 ... Sunday = 6."""
    return F.weekday(_c(col))


def calendar_parts(col: Column | str) -> dict[str, Column]:
    """year, month, hour, dow (Mon=0), date and is_weekend of a timestamp."""
    ts = _c(col)
    dow = weekday_mon0(ts)
    return {
        "year": F.year(ts),
        "month": F.month(ts),
        "hour": F.hour(ts),
        "dow": dow,
        "date": F.to_date(ts),
        "is_weekend": dow >= 5,
    }


def valid_calendar_date(year: Column | str, month: Column | str, day: Column | str) -> Column:
    """Date from parts, null when the combination is impossible (Feb 30)."""
    return F.try_make_timestamp(_c(year), _c(month), _c(day), F.lit(0), F.lit(0), F.lit(0))
