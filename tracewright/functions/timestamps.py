"""Mixed-format timestamp parsing as Column expressions.

Every format becomes an anchored pattern plus a rewrite to ``y-m-d h:m:s``,
which is cast to TIMESTAMP_NTZ with ``try_cast``. The result does not depend on
the session time zone and impossible dates give null instead of an error.

A parser is a function of a Column. ``parsed`` and ``readable`` bind the text
once with a one-element array: the text is used by every pattern, and without
the binding its own expression would be repeated for each of them.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import WHITESPACE_CLASS, trimmed

# The format lists, tried in order.
PIPELINE_FORMATS = (
    "%Y/%m/%d %H:%M:%S",
    "%d/%m/%Y %I:%M:%S %p",
    "%d/%m/%Y %I:%M %p",
    "%d/%m/%Y %H:%M:%S",
    "%d/%m/%Y %H:%M",
    "%m/%d/%y %H:%M",
)
FORENSIC_FORMATS = ("%d/%m/%Y %H:%M", "%d/%m/%y %H:%M", "%m/%d/%y %H:%M")
DAY_FIRST_FORMATS = ("%d/%m/%Y %H:%M",)
# Reasons for a dropped row.
MISSING = "DROP_TIMESTAMP_MISSING"
INVALID = "DROP_TIMESTAMP_INVALID"

# What strptime accepts for each directive.
_DIRECTIVES = {
    "%Y": r"(?!0000)\d{4}",
    "%m": r"0?[1-9]|1[0-2]",
    "%d": r"[0 ]?[1-9]|[12]\d|3[01]",
    "%H": r"[01]?\d|2[0-3]",
    "%I": r"0?[1-9]|1[0-2]",
    "%M": r"[0-5]?\d",
    "%S": r"[0-5]?\d",
    "%p": r"am|pm",
}
# Two-digit years turn over at 69.
_CENTURIES = (("20", r"[0-5]\d|6[0-8]"), ("19", r"69|[7-9]\d"))


def _pattern_and_rewrite(fmt: str, century: str, short_year: str) -> tuple[str, str]:
    pattern, group = "", {}
    for token in re.findall(r"%.|\s+|[^%\s]+", fmt):
        if token.isspace():
            pattern += WHITESPACE_CLASS + "+"
        elif token.startswith("%"):
            group[token] = f"${len(group) + 1}"
            pattern += f"({short_year if token == '%y' else _DIRECTIVES[token]})"
        else:
            pattern += re.escape(token)
    year = group["%Y"] if "%Y" in group else century + group["%y"]
    hour = group.get("%H") or group.get("%I", "0")
    date = f"{year}-{group['%m']}-{group['%d']}"
    rewrite = f"{date} {hour}:{group.get('%M', '0')}:{group.get('%S', '0')}"
    flags = "(?i)" if "%p" in group else ""
    return rf"{flags}^{pattern}\z", rewrite


def strptime(value: Column, fmt: str) -> Column:
    """Parse with one strptime format; null where it does not fit."""
    parsed = None
    for century, short_year in _CENTURIES if "%y" in fmt else (("", ""),):
        pattern, rewrite = _pattern_and_rewrite(fmt, century, short_year)
        text = F.regexp_replace(value, pattern, rewrite)
        if "%d" in fmt:  # a blank may stand for the leading zero of the day
            text = F.replace(text, F.lit("- "), F.lit("-"))
        moment = text.try_cast("timestamp_ntz")
        if "%I" in fmt:
            noon = F.regexp_like(value, F.lit(rf"{WHITESPACE_CLASS}12:"))
            later = F.lower(F.right(value, F.lit(2))) == "pm"
            shift = F.when(noon & ~later, -12).when(~noon & later, 12).otherwise(0)
            moment = moment + F.make_dt_interval(hours=shift)
        attempt = F.when(value.rlike(pattern), moment)
        parsed = attempt if parsed is None else F.coalesce(parsed, attempt)
    return parsed


_DATE = r"(?:(?!0000)\d{4}-\d{2}-\d{2}|(?!0000)\d{8})"
_CLOCK = (
    r"(?:\d{2}(?::\d{2}(?::\d{2}(?:[.,]\d+)?)?)?"
    r"|\d{4}(?:\d{2}(?:[.,]\d+)?)?)"
)
_OFFSET = r"[+-](?:[01]\d|2[0-3])(?::[0-5]\d(?::[0-5]\d)?|[0-5]\d(?:[0-5]\d)?)?"
_ISO = rf"(?s)^{_DATE}(?:Z|\D{_CLOCK}(?:Z|{_OFFSET})?)?\z"
_ISO_PARTS = r"(?s)^(\d{4})-?(\d{2})-?(\d{2})(?:\D(\d{2}):?(\d{2})?:?(\d{2})?.*)?Z?\z"
_ISO_OFFSET = r"(?s)^.{8,10}\D\d{2}.*?([+-])(\d{2}):?(\d{2})?:?(\d{2})?\z"
_ISO_ZULU = r"(?s)^.{8,10}\D\d{2}.*Z\z"


def _with_colons(digits: Column, start: int) -> Column:
    """Complete hhmmss digits from place ``start`` with zeros, write them h:m:s."""
    full = F.rpad(digits, start + 5, "0")
    late = F.overlay(full, F.lit(":"), F.lit(start + 4), F.lit(0))
    return F.overlay(late, F.lit(":"), F.lit(start + 2), F.lit(0))


def _iso(value: Column, timezone: str) -> Column:
    """ISO-8601 calendar dates, extended or basic; null where it does not fit."""
    digits = F.regexp_replace(value, _ISO_PARTS, "$1-$2-$3 $4$5$6")
    moment = _with_colons(digits, 12).try_cast("timestamp_ntz")
    offset = _with_colons(F.regexp_replace(value, _ISO_OFFSET, "$1$2$3$4"), 2)
    return F.when(
        value.rlike(_ISO),
        F.when(value.rlike(_ISO_OFFSET), moment - offset.try_cast("interval hour to second"))
        .when(value.rlike(_ISO_ZULU) & (F.length(value) > 11), moment)
        .otherwise(_to_utc(moment, timezone)),
    )


# Year, week, day of the week if there is one, and what follows the date.
_WEEK = r"(?s)^(?!0000)(\d{4})(?:-W(\d{2})(?:-(\d)(?!\d))?|W(\d{2})(?:(\d)(?!\d))?)(\D.*)?\z"


def _week_date(value: Column) -> Column:
    """The day of an ISO week date; null if there is no such week or day."""

    def part(*groups: int) -> Column:
        texts = [F.nullif(F.regexp_extract(value, _WEEK, group), F.lit("")) for group in groups]
        return F.coalesce(*texts).cast("int")

    year, week, day = part(1), part(2, 4), F.coalesce(part(3, 5), F.lit(1))
    fourth = F.make_date(year, F.lit(1), F.lit(4))  # always in the first week
    monday = F.date_add(F.date_sub(fourth, F.weekday(fourth)), (week - 1) * 7)
    # A week belongs to the year of its Thursday: so the 53rd is one only in long years.
    real = (week >= 1) & (F.year(F.date_add(monday, 3)) == year) & day.between(1, 7)
    return F.when(real, F.date_add(monday, day - 1))


def _iso_week(value: Column, timezone: str) -> Column:
    """ISO-8601 week dates, extended or basic, with or without a time; null where it does not fit."""
    dated = F.concat(_week_date(value).cast("string"), F.regexp_extract(value, _WEEK, 6))
    found = F.transform(F.array(dated), lambda text: _iso(text, timezone))
    return F.when(value.rlike(_WEEK), F.get(found, F.lit(0)))


def _to_utc(moment: Column, timezone: str) -> Column:
    if timezone == "UTC":
        return moment
    return F.convert_timezone(F.lit(timezone), F.lit("UTC"), moment)


Parser = Callable[[Column], Column]


def local_parser(formats: Sequence[str] = FORENSIC_FORMATS) -> Parser:
    """Wall-clock time by the first fitting format, no ISO form and no time zone."""
    return lambda text: F.coalesce(*[strptime(text, fmt) for fmt in formats])


def utc_parser(formats: Sequence[str] = PIPELINE_FORMATS, timezone: str = "UTC") -> Parser:
    """UTC time in whole seconds: ISO-8601 first, then the formats in order; week dates fit none of these."""

    def parse(text: Column) -> Column:
        local = [_to_utc(strptime(text, fmt), timezone) for fmt in formats]
        return F.coalesce(_iso(text, timezone), *local, _iso_week(text, timezone))

    return parse


def _attempts(value: Column, parser: Parser) -> Column:
    return F.transform(F.array(trimmed(value)), parser)


def parsed(value: Column, parser: Parser) -> Column:
    """The time, null where the text cannot be read."""
    return F.get(_attempts(value, parser), F.lit(0))


def readable(value: Column, parser: Parser) -> Column:
    """An array with the time, empty where the text cannot be read.

    Exploding it parses once and drops the other rows. A filter on ``parsed``
    would be pushed below the projection and parse every text twice.
    """
    return F.array_compact(_attempts(value, parser))


def drop_reason(raw: Column, parsed: Column) -> Column:
    """Why a row has no timestamp; null for rows that have one."""
    text = F.lower(trimmed(F.coalesce(raw, F.lit(""))))
    return F.when(parsed.isNull(), F.when(text.isin("", "null"), MISSING).otherwise(INVALID))


def iso_local(moment: Column) -> Column:
    """``2025-08-15T14:51:00``, the form used by the reports.

    The cast keeps the wall clock; ``date_format`` would go through the session
    time zone and shift times that fall into one of its gaps.
    """
    return F.translate(F.substring(moment.cast("string"), 1, 19), " ", "T")


def iso_utc(moment: Column) -> Column:
    """``2025-08-15T14:51:00Z``, the form used by the sinks."""
    return F.concat(iso_local(moment), F.lit("Z"))


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from start to end, free of the session time zone."""
    days = F.date_diff(F.to_date(end), F.to_date(start)).cast("bigint")

    def of_day(moment: Column) -> Column:
        return F.hour(moment) * 3600 + F.minute(moment) * 60 + F.second(moment)

    return days * 86400 + of_day(end) - of_day(start)


def is_strict_utc(value: Column) -> Column:
    """True for a real ``YYYY-MM-DDTHH:MM:SS[.f]Z`` time without outer blanks."""
    shape = value.rlike(r"^(?!0000)\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?Z\z")
    real = F.substring(value, 1, 19).try_cast("timestamp_ntz").isNotNull()
    return F.coalesce(shape & real, F.lit(False))


def shape_label(raw: Column) -> Column:
    """Coarse label of a raw timestamp's shape."""
    first, second = F.split_part(raw, F.lit("/"), F.lit(1)), F.split_part(raw, F.lit("/"), F.lit(2))
    return (
        F.when(F.contains(raw, F.lit("/202")), "DD/MM/YYYY HH:MM")
        .when((F.length(first) == 1) | (F.length(second) == 1), "D/M/YY HH:MM")
        .otherwise("other")
    )
