"""Epoch milliseconds <-> text, independent of the session time zone.

Values go through ``TIMESTAMP_NTZ`` (wall-clock) arithmetic on its calendar
fields. Nothing is cast to a zoned timestamp on the way (``date_format`` and
``timestamp_diff`` do that, and lose the hour that a zone's clock change
skips), so results do not depend on ``spark.sql.session.timeZone``. ``tz``
names the zone the text is written in; the default is UTC.

Inventory: F1-F4.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col

# The two patterns the reference helpers use.
DEFAULT_PATTERN = "yyyy-MM-dd HH:mm:ss"
TIME_PATTERN = "HH:mm:ss"

def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def ms_to_wallclock(ms, tz: str = "UTC") -> Column:
    """Epoch ms -> TIMESTAMP_NTZ wall-clock time in ``tz``."""
    ntz = F.timestamp_add("MILLISECOND", as_col(ms), _epoch())
    if tz.upper() != "UTC":
        ntz = F.convert_timezone(F.lit("UTC"), F.lit(tz), ntz)
    return ntz


def _day_ms(ntz: Column) -> Column:
    """Milliseconds since midnight of a TIMESTAMP_NTZ."""
    seconds = F.extract(F.lit("SECOND"), ntz)                    # with its fraction
    return (F.hour(ntz).cast("bigint") * 3_600_000 + F.minute(ntz) * 60_000
            + F.floor(seconds * 1000).cast("bigint"))


def wallclock_to_ms(ntz, tz: str = "UTC") -> Column:
    """TIMESTAMP_NTZ wall-clock time in ``tz`` -> epoch ms."""
    c = as_col(ntz)
    if tz.upper() != "UTC":
        c = F.convert_timezone(F.lit(tz), F.lit("UTC"), c)
    return F.unix_date(c.cast("date")).cast("bigint") * 86_400_000 + _day_ms(c)


def wallclock_to_seconds(ntz) -> Column:
    """TIMESTAMP_NTZ (UTC wall clock) -> whole epoch seconds (the past rounds down)."""
    return F.floor(wallclock_to_ms(ntz) / F.lit(1000)).cast("bigint")


def instant_to_wallclock(ts) -> Column:
    """TIMESTAMP (an instant) -> TIMESTAMP_NTZ in UTC, whatever the session zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(as_col(ts)), _epoch())


# Fixed-width fields of ``cast(ntz as string)``: pattern letters -> start, width.
_FIELDS = {"yyyy": (1, 4), "MM": (6, 2), "dd": (9, 2), "HH": (12, 2), "mm": (15, 2), "ss": (18, 2)}
_TOKEN = re.compile(r"([A-Za-z])\1*|[^A-Za-z]+")          # a run of one letter, or what is between


def wallclock_to_text(ntz, pattern: str = DEFAULT_PATTERN) -> Column:
    """Format a TIMESTAMP_NTZ with a datetime pattern, without any zone.

    Patterns of plain fields and separators are substrings of the ISO text
    (years 0 to 9999); all others go through the JSON writer, which has a
    zone-free format option.
    """
    c = as_col(ntz)
    written = F.get_json_object(F.to_json(F.struct(c.alias("t")), {"timestampNTZFormat": pattern}), "$.t")
    tokens = [m.group(0) for m in _TOKEN.finditer(pattern)]
    if any(t[0].isalpha() and t not in _FIELDS for t in tokens) or any(x in pattern for x in "'[]{}#"):
        return written
    iso = c.cast("string")
    plain = F.concat(*[F.substring(iso, *_FIELDS[t]) if t in _FIELDS else F.lit(t) for t in tokens])
    return F.when(F.year(c).between(0, 9999), plain).otherwise(written)


def epoch_ms_to_text(ms, pattern: str = DEFAULT_PATTERN, tz: str = "UTC") -> Column:
    """Format epoch ms with ``pattern``; sub-pattern precision is truncated."""
    return wallclock_to_text(ms_to_wallclock(ms, tz), pattern)


# Field letters that lenient parsing knows: their unit.
_UNITS = {"yyyy": "year", "MM": "month", "dd": "day", "HH": "hour", "mm": "minute", "ss": "second", "SSS": "ms"}
_DEFAULTS = {"year": 1970, "month": 1, "day": 1, "hour": 0, "minute": 0, "second": 0, "ms": 0}
_YEARS = (-9_999, 99_999)


def _rolled_over(text: Column, pattern: str) -> Column:
    """Epoch ms of the fields of ``text``, each rolled over into the next:
    month 13 is January, day 0 the last day before, hour 25 the next day's
    first. What follows the last field is ignored; null if a field is missing.

    A field that another one follows directly has its own width; any other
    takes all digits there are, after blanks and with a sign.
    """
    tokens = [m.group(0) for m in _TOKEN.finditer(pattern)]
    for t in tokens:
        if t[0].isalpha() and t not in _UNITS:
            raise ValueError(f"lenient parsing knows the fields {', '.join(_UNITS)}, not {t}")
    parts, units = [], []
    for t, after in zip(tokens, [*tokens[1:], ""]):
        if t in _UNITS:
            parts.append(rf"(\d{{{len(t)}}})" if after in _UNITS else r"[ \t]*(-?\d{1,9})")
            units.append(_UNITS[t])
        else:
            parts.append("".join(rf"\x{{{ord(c):x}}}" for c in t))
    expr = "^" + "".join(parts)
    found = F.regexp_like(text, F.lit(expr))
    field = {u: F.regexp_extract(text, expr, i + 1).cast("bigint") for i, u in enumerate(units)}
    f = {u: field.get(u, F.lit(d).cast("bigint")) for u, d in _DEFAULTS.items()}
    months = f["month"] - 1
    year = f["year"] + F.floor(months / 12)
    first = F.unix_date(F.make_date(year.cast("int"), (F.pmod(months, F.lit(12)) + 1).cast("int"), F.lit(1)))
    days = first.cast("bigint") + f["day"] - 1
    ms = days * 86_400_000 + f["hour"] * 3_600_000 + f["minute"] * 60_000 + f["second"] * 1000 + f["ms"]
    return F.when(found, F.when(year.between(*_YEARS), ms))


def text_to_epoch_ms(text, pattern: str = DEFAULT_PATTERN, tz: str = "UTC",
                     on_error: str = "raise", lenient: bool = False) -> Column:
    """Parse ``text`` with ``pattern`` to epoch ms.

    Parsing is strict (no month roll-over, no trailing text) unless ``lenient``
    (patterns of plain number fields). ``on_error``: ``"raise"`` fails the task
    on bad text, ``"null"`` yields null. Neither passes through a zone.
    """
    c = as_col(text)
    if on_error not in ("raise", "null"):
        raise ValueError("on_error must be 'raise' or 'null'")
    if lenient:
        ntz = ms_to_wallclock(_rolled_over(c, pattern))
    else:
        ntz = F.to_timestamp_ntz(c, F.lit(pattern))
        if on_error == "null":           # the zoned parser only tells whether the text can be read
            ntz = F.when(F.try_to_timestamp(c, F.lit(pattern)).isNotNull(), ntz)
    if on_error == "null":
        return wallclock_to_ms(ntz, tz)
    bad = F.raise_error(F.concat(F.lit(f"unparseable time for pattern {pattern}: "), c))
    return wallclock_to_ms(F.when(c.isNull() | ntz.isNotNull(), ntz).otherwise(bad.cast("timestamp_ntz")), tz)
