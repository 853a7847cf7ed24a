"""Publish dates: many source notations to ``yyyy-MM-dd HH:mm:ss``, and that to epoch seconds.

Each notation is one built-in expression that yields the text form or NULL, never an error. The
session time zone must be UTC (see ``session.build_session``).
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from newslake.functions.text import part_before, remove_all, strip
from newslake.schema import DATE_FORMAT, NO_DATE

_OFFSET = r"(?:Z|[+-]\d{2}:?\d{2})"
_SECONDS = r"\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}"
_ISO_FORM = (
    r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d{1,6})?)?" + _OFFSET + r"?)?$"
)

# Time zone names of one source and the offsets they stand for.
ZONE_OFFSETS = {"EST": "-0500", "EDT": "-0400", "UTC": "+0000"}


def _text(ts: Column) -> Column:
    return F.date_format(ts, DATE_FORMAT)


def _parse(raw: Column, pattern: str) -> Column:
    return F.try_to_timestamp(raw, F.lit(pattern))


def _matching(raw: Column, regex: str) -> Column:
    return F.when(raw.rlike(regex), raw)


def _colon_offset(raw: Column) -> Column:
    return F.regexp_replace(raw, r"([+-]\d{2})(\d{2})$", "$1:$2")


def _without_offset(raw: Column) -> Column:
    return F.regexp_replace(raw, r"(?:\.\d{1,6})?" + _OFFSET + "$", "")


def _offset_to_utc(raw, tz_policy):
    """Seconds with a required offset, converted to UTC."""
    return _parse(_colon_offset(_matching(raw, f"^{_SECONDS}{_OFFSET}$")), "yyyy-M-d'T'H:m:sXXX")


def _offset_dropped(raw, tz_policy):
    """Seconds with a required offset; the digits stay as written unless tz_policy is 'utc'."""
    if tz_policy == "utc":
        return _offset_to_utc(raw, tz_policy)
    return _parse(_without_offset(_matching(raw, f"^{_SECONDS}{_OFFSET}$")), "yyyy-M-d'T'H:m:s")


def _iso_to_utc(raw, tz_policy):
    return _matching(raw, _ISO_FORM).try_cast("timestamp")


def _iso_offset_dropped(raw, tz_policy):
    iso = _matching(raw, _ISO_FORM)
    if tz_policy == "utc":
        return iso.try_cast("timestamp")
    # A bare date has no offset, although its day looks like one ("-02").
    return F.when(F.length(iso) > 10, _without_offset(iso)).otherwise(iso).try_cast("timestamp")


def _fraction_z(raw, tz_policy):
    whole = F.regexp_extract(raw, rf"^({_SECONDS})\.\d{{1,6}}Z$", 1)
    return _parse(whole, "yyyy-M-d'T'H:m:s")


def _seconds_z(raw, tz_policy):
    return _parse(raw, "yyyy-M-d'T'H:m:s'Z'")


def _seconds(raw, tz_policy):
    return _parse(raw, "yyyy-M-d'T'H:m:s")


def _published_line(raw, tz_policy):
    """``Published Jan 2, 2024, 3:04 p.m. UTC``"""
    halves = F.replace(F.replace(raw, F.lit(" p.m."), F.lit(" PM")), F.lit(" a.m."), F.lit(" AM"))
    return _parse(strip(remove_all(halves, "UTC", "Published")), "MMM d, yyyy, h:m a")


def _dotted_month(raw, tz_policy):
    """``Jan. 2, 2024 at 3:04 PM UTC``; the word "at" may be absent."""
    plain = F.replace(strip(remove_all(raw, "Published")), F.lit(" at "), F.lit(" "))
    return _parse(plain, "MMM. d, yyyy h:m a 'UTC'")


def _zone_name_ignored(raw, tz_policy):
    """``Jan 2, 2024 15:04 UTC``; only the names of UTC are known."""
    return _parse(F.regexp_extract(raw, r"^(.*?)\s+(?:UTC|GMT)$", 1), "MMM d, yyyy H:m")


def _short_month_day(raw, tz_policy):
    return _parse(raw, "MMM d, yyyy")


def _long_month_day(raw, tz_policy):
    # A long-month format takes full names only; "May" is both.
    return _parse(raw, "MMMM d, yyyy")


def _slashed_day(raw, tz_policy):
    """``1/2/24``; two-digit years from 69 on belong to the last century."""
    ts = _parse(strip(remove_all(raw, "·")), "M/d/yy")
    return F.when(F.year(ts) >= 2069, ts - F.expr("INTERVAL 100 YEARS")).otherwise(ts)


def _day_dash_time(raw, tz_policy):
    return _parse(raw, "MMM d, yyyy - H:m")


def _zone_name_to_utc(raw, tz_policy):
    """``Jan 2, 2024, 3:04PM EST``"""
    offset = part_before(raw, "•")
    for name, value in ZONE_OFFSETS.items():
        offset = F.replace(offset, F.lit(name), F.lit(value))
    return _parse(offset, "MMM d, yyyy, h:ma Z")


def _epoch(raw, tz_policy):
    return F.timestamp_seconds(raw.try_cast("bigint"))


# Notation name -> parser. The names are the ids of SURVEY §2.4; D11 has three spellings.
_PARSERS = {
    "D1": _offset_to_utc,
    "D2": _offset_dropped,
    "D3": _iso_to_utc,
    "D4": _iso_offset_dropped,
    "D5": _fraction_z,
    "D6": _seconds_z,
    "D7": _seconds,
    "D8": _published_line,
    "D9": _dotted_month,
    "D10": _zone_name_ignored,
    "D11a": _short_month_day,
    "D11b": _long_month_day,
    "D11c": _slashed_day,
    "D12": _day_dash_time,
    "D13": _zone_name_to_utc,
    "D15": _epoch,
}
NOTATIONS = [*_PARSERS, "D14"]


def parse_published_at(raw: Column, notation: str, tz_policy: str = "wall") -> Column:
    """``raw`` in the given notation as ``yyyy-MM-dd HH:mm:ss``; NULL when it cannot be read.

    ``tz_policy`` acts on the notations that carry an offset which the sources ignore (D2, D4):
    'wall' keeps the digits as written, 'utc' converts. D13 yields the sentinel itself.
    """
    if tz_policy not in ("wall", "utc"):
        raise ValueError(f"tz_policy must be 'wall' or 'utc', not {tz_policy!r}")
    if notation == "D14":
        # No parsing at the source: a missing day becomes text that publishing turns into NULL.
        return F.concat(F.coalesce(raw, F.lit("None")), F.lit(" 00:00:00"))
    text = _text(_PARSERS[notation](strip(raw.cast("string")), tz_policy))
    return F.coalesce(text, F.lit(NO_DATE)) if notation == "D13" else text


def parse_by_notation(raw: Column, notation: Column, used=None, tz_policy: str = "wall") -> Column:
    """As ``parse_published_at`` with the notation in a column."""
    branches = F.lit(None).cast("string")
    for name in NOTATIONS if used is None else used:
        branches = F.when(notation == name, parse_published_at(raw, name, tz_policy)).otherwise(branches)
    return branches


def epoch_to_text(seconds: Column) -> Column:
    return _text(F.timestamp_seconds(seconds))


def finalize_published_at(published_at: Column) -> Column:
    """Epoch seconds for publishing; NULL for the sentinel, for unreadable text and for NULL."""
    # Fields need no leading zeros and may be apart by any white space, but nothing may surround them.
    known = F.nullif(published_at, F.lit(NO_DATE))
    dated = _matching(known, r"^\d{4}-\d{1,2}-\d{1,2}\s+\d{1,2}:\d{1,2}:\d{1,2}$")
    return F.unix_timestamp(_parse(F.regexp_replace(dated, r"\s+", " "), "yyyy-M-d H:m:s"))
