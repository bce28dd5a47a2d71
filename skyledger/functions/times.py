"""Time expressions. All results are timestamp_ntz holding UTC.

Nothing here depends on the session time zone.
"""

from __future__ import annotations

from zoneinfo import available_timezones

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let, strip

_STRICT = r"^\d{4}-\d\d-\d\d[T ]\d\d:\d\d:\d\d(\.\d{1,6})?(Z|[+-]\d\d:\d\d)?$"
_HALF_DAY = r"\s*([AaPp])\.?[Mm]\.?$"
_MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"


# Names of the zone files that stand for no zone in the JVM.
_NOT_IN_JVM = ("Factory", "GMT+0", "GMT-0", "ROC", "localtime")


def known_zone(name: str) -> Column:
    """Column `name` where it holds a zone Spark can convert from, else null.

    An unknown zone would fail the job. The names go in as one SQL text because a
    literal per name makes the plan slow to build.
    """
    zones = ", ".join(f"'{z}'" for z in sorted(available_timezones()) if z not in _NOT_IN_JVM)
    return F.expr(f"CASE WHEN `{name}` IN ({zones}) OR `{name}` RLIKE '^[+-][0-9]{{2}}:?[0-9]{{2}}$' THEN `{name}` END")


def _as_iso(s: Column) -> Column:
    """Rearrange the supported non-ISO date forms into ISO text.

    Day and month in digits are read month-first unless the first number exceeds 12.
    """
    named = F.regexp_replace(s, r"^(\d{1,2})\s+([A-Za-z]{3})[A-Za-z]*\.?,?\s+(\d{4})", "$3 $2 $1")
    named = F.regexp_replace(named, r"^([A-Za-z]{3})[A-Za-z]*\.?\s+(\d{1,2}),?\s+(\d{4})", "$3 $1 $2")
    month = F.floor((F.position(F.lower(F.substring(named, 6, 3)), F.lit(_MONTHS)) + 2) / 3)
    x = F.when(
        named.rlike(r"^\d{4} [A-Za-z]{3} \d"),
        F.concat_ws("-", F.substring(named, 1, 4), month.cast("string"), F.substring(named, 10, 64)),
    ).otherwise(named)
    for pattern, iso in (
        (r"^(\d{4})[./](\d{1,2})[./](\d{1,2})", "$1-$2-$3"),
        (r"^(1[3-9]|2\d|3[01])[./-](\d{1,2})[./-](\d{4})", "$3-$2-$1"),
        (r"^(\d{1,2})[./-](\d{1,2})[./-](\d{4})", "$3-$1-$2"),
        (r"^(\d{4})(\d{2})(\d{2})(?=$|[T ]?\d{4,6}$)", "$1-$2-$3"),
        (r"^(\d{4}-\d{2}-\d{2})[T ]?(\d{2})(\d{2})(\d{2})$", "$1 $2:$3:$4"),
        (r"^(\d{4}-\d{2}-\d{2})[T ]?(\d{2})(\d{2})$", "$1 $2:$3"),
        (r"^([\d-]+),?\s+(?=\d)", "$1 "),
        (r"(\d:\d\d),(\d+)$", "$1.$2"),
        (_HALF_DAY, ""),
    ):
        x = F.regexp_replace(x, pattern, iso)
    return F.coalesce(_from_day_or_week(x), x)


def _from_day_or_week(x: Column) -> Column:
    """ISO ordinal dates (2024-015) and week dates (2024-W03-1) as calendar dates; else null."""

    def part(pattern: str, group: int) -> Column:
        return F.nullif(F.regexp_extract(x, pattern, group), F.lit(""))

    ordinal, week = r"^(\d{4})-(\d{3})(?!\d)(.*)$", r"^(\d{4})-?W(\d\d)(?:-?([1-7]))?(.*)$"
    new_year = F.concat(part(ordinal, 1), F.lit("-01-01")).try_cast("date")
    day = F.date_add(new_year, part(ordinal, 2).try_cast("int") - 1)
    # The fourth of January is in the first week.
    fourth = F.concat(part(week, 1), F.lit("-01-04")).try_cast("date")
    weekday = F.coalesce(part(week, 3).try_cast("int"), F.lit(1))
    in_week = F.date_add(fourth, -F.weekday(fourth) + (part(week, 2).try_cast("int") - 1) * 7 + weekday - 1)
    return F.when(x.rlike(ordinal), F.concat(day.cast("string"), F.regexp_extract(x, ordinal, 3))).when(
        x.rlike(week), F.concat(in_week.cast("string"), F.regexp_extract(x, week, 4))
    )


def _half_day_shift(s: Column) -> Column:
    """Hours to add to a clock time that carries AM or PM."""
    hours = (
        F.when(s.rlike(r"\b12:[\d:.]+\s*[Aa]\.?[Mm]\.?$"), -12)
        .when(s.rlike(r"\b(?!12:)\d{1,2}:[\d:.]+\s*[Pp]\.?[Mm]\.?$"), 12)
        .otherwise(0)
    )
    return F.make_dt_interval(F.lit(0), hours)


def _offset(s: Column) -> Column:
    """Zone suffix of a time text: Z, UTC, GMT, or a sign with 2 or 4 digits; else empty."""

    def signed(n: int) -> Column:
        return (F.length(s) >= 13 + n) & F.substring(s, -n, 1).isin("+", "-")

    return (
        F.when(F.substring(s, -1, 1).isin("Z", "z"), F.lit("Z"))
        .when(F.substring(s, -3, 3).isin("UTC", "GMT"), F.lit("UTC"))
        .when(signed(6), F.substring(s, -6, 6))
        .when(signed(5), F.substring(s, -5, 5))
        .when(signed(3), F.substring(s, -3, 3))
        .otherwise("")
    )


def _body(s: Column, offset: Column) -> Column:
    return F.rtrim(F.left(s, F.length(s) - F.length(offset)))


def _is_iso(body: Column) -> Column:
    """Looks like ISO text with a full date and no zone; the cast decides the rest."""
    return (
        (F.substring(body, 5, 1) == "-")
        & (F.length(body) >= 8)
        & ~body.rlike(r"[^0-9\-:.T ]|^\d{4}-\d{3}(?!\d)")
        & (F.instr(F.substring(body, 11, 32), "-") == 0)
    )


def _local(body: Column) -> Column:
    iso = _as_iso(body)
    other = F.when(_is_iso(iso), iso.try_cast("timestamp_ntz") + _half_day_shift(body))
    return F.when(_is_iso(body), body.try_cast("timestamp_ntz")).otherwise(other)


def _source_zone(offset: Column, fallback: Column) -> Column:
    explicit = (
        F.when(offset.isin("Z", "UTC"), F.lit("UTC"))
        .when(F.length(offset) == 3, F.concat(offset, F.lit(":00")))
        .otherwise(offset)
    )
    return F.when(offset != "", explicit).otherwise(fallback)


def _to_utc(local: Column, source: Column) -> Column:
    return F.when(source == "UTC", local).otherwise(F.convert_timezone(source, F.lit("UTC"), local))


def parse_utc(text: Column, fallback: Column | None = None) -> Column:
    """Timestamp text to UTC.

    An explicit offset in the text wins, otherwise `fallback` (a zone column, see
    `known_zone`; default UTC) is the zone. Text without a full date is null.

    Strict ISO text, the usual case, takes a short way: the cast ignores the zone suffix,
    which is applied afterwards. All other forms go through `_parse_lenient`.
    """
    zone = F.lit("UTC") if fallback is None else fallback
    t = F.trim(text)
    suffix = F.substring(t, -6, 6)
    source = (
        F.when(F.endswith(t, F.lit("Z")), F.lit("UTC"))
        .when(suffix.startswith("+") | suffix.startswith("-"), suffix)
        .otherwise(zone)
    )
    strict = _to_utc(t.try_cast("timestamp_ntz"), source)
    return F.when(t.rlike(_STRICT), strict).otherwise(_parse_lenient(text, zone))


def _parse_lenient(text: Column, zone: Column) -> Column:
    split = let(strip(text), lambda s: F.struct(s.alias("s"), _offset(s).alias("o")))
    parts = let(split, lambda r: F.struct(_body(r.s, r.o).alias("b"), r.o.alias("o")))
    local = let(parts, lambda r: F.struct(_local(r.b).alias("t"), _source_zone(r.o, zone).alias("z")))
    return let(local, lambda r: _to_utc(r.t, r.z))


def whole_minutes(start: Column, end: Column) -> Column:
    """Whole minutes from start to end, cut towards zero."""
    gap = end - start
    return (
        F.extract(F.lit("DAY"), gap) * 1440
        + F.extract(F.lit("HOUR"), gap) * 60
        + F.extract(F.lit("MINUTE"), gap)
    ).cast("long")


def second_text(ts: Column) -> Column:
    """`YYYY-MM-DD HH:MM:SS`, fraction cut off."""
    return F.substring(ts.cast("string"), 1, 19)


def offset_text(ts: Column, separator: str = " ") -> Column:
    """`YYYY-MM-DD HH:MM:SS[.ffffff]+00:00`; the fraction shows six digits or none."""
    s = ts.cast("string")
    fraction = F.when(F.length(s) > 19, F.rpad(F.substring(s, 20, 7), 7, "0")).otherwise("")
    return F.concat(
        F.substring(s, 1, 10), F.lit(separator), F.substring(s, 12, 8), fraction, F.lit("+00:00")
    )


def zulu_text(ts: Column) -> Column:
    """`YYYY-MM-DDTHH:MM:SSZ`."""
    s = ts.cast("string")
    return F.concat(F.substring(s, 1, 10), F.lit("T"), F.substring(s, 12, 8), F.lit("Z"))
