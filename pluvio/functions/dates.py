"""Date and time parsing, flooring and binning. All timestamps are TIMESTAMP_NTZ
(wall-clock readings); text that does not parse gives null, never an error."""
from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: formats that the free-form date parser knows
ANY_DATE_FORMATS = (
    "yyyy-MM-dd", "yyyy/MM/dd", "yyyy-MM-dd HH:mm:ss", "yyyy/MM/dd HH:mm",
    "d/M/yyyy", "MMM d, yyyy", "d MMM yyyy", "yyyyMMdd",
)
_LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_timestamp(c, fmt: str) -> Column:
    """Parse text with a datetime pattern into TIMESTAMP_NTZ; failure -> null.
    The wall-clock value is kept whatever the session time zone (no round trip
    through a zone-bound TIMESTAMP, which would move times in a DST gap)."""
    c, f = _c(c), F.lit(fmt)
    return F.when(F.try_to_timestamp(c, f).isNotNull(), F.to_timestamp_ntz(c, f))


def ntz_literal(value) -> Column:
    """A TIMESTAMP_NTZ literal from a Python datetime, independent of the Python
    process and session time zones."""
    if value is None:
        return F.lit(None).cast("timestamp_ntz")
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def parse_date(c, fmt: str) -> Column:
    """Parse text into DATE; failure -> null."""
    return F.try_to_date(_c(c), fmt)


def _shapes(fmt: str) -> list[str]:
    """The shapes of the texts of a format: 9 for each digit, a for each letter. A single
    letter of a format stands for one digit or two, three Ms for three letters."""
    out = [""]
    for m in re.finditer(r"([A-Za-z])\1*|[^A-Za-z]", fmt):
        part = m.group()
        if not part[0].isalpha():
            kinds = [part]
        elif part == "MMM":
            kinds = ["aaa"]
        else:
            kinds = ["9", "99"] if len(part) == 1 else ["9" * len(part)]
        out = [o + k for o in out for k in kinds]
    return out


def any_date(c, formats=ANY_DATE_FORMATS) -> Column:
    """Free-form date text. The text's shape (which characters are digits, letters and
    signs) tells its format, so a row is parsed once; of formats with one shape the first
    counts. A shape of no format gives null."""
    c = F.trim(_c(c))
    shape = F.translate(c, "0123456789" + _LETTERS, "9" * 10 + "a" * len(_LETTERS))
    known: set[str] = set()
    out = None
    for fmt in formats:
        own = [s for s in _shapes(fmt) if s not in known]
        known.update(own)
        if own:
            parsed = parse_date(c, fmt)
            out = F.when(shape.isin(own), parsed) if out is None else out.when(shape.isin(own), parsed)
    return out


def floor_minutes(ts, minutes: int) -> Column:
    """Round a timestamp down to a multiple of ``minutes`` (epoch-aligned). Pure
    arithmetic: a TIMESTAMP_NTZ stays NTZ and the session time zone plays no part
    (``date_trunc`` would return a zone-bound TIMESTAMP). Rows without a time go."""
    return F.window(_c(ts), f"{minutes} minutes").start


def slot_start(ts, minutes: int) -> Column:
    """Start of the slot of ``minutes``, counted from midnight, that ``ts`` lies in. A null
    stays a null row (rows without a time are lost where ``floor_minutes`` is used)."""
    of_day = F.hour(_c(ts)) * 60 + F.minute(_c(ts))
    return F.to_date(_c(ts)).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), of_day - of_day % minutes)


def anchored_bin(ts, anchor, minutes: int) -> Column:
    """Start of the ``minutes``-long bin containing ``ts``, bins anchored at ``anchor``
    (the series' first timestamp cut to the minute), not at midnight."""
    step = minutes * 60
    diff = F.timestamp_diff("SECOND", _c(anchor), _c(ts))
    return F.timestamp_add("SECOND", F.floor(diff / step) * step, _c(anchor))


def ampm_timestamp(date_text, time_text, shift_hours: int = 0,
                   fmt: str = "M/d/yy h:mm a") -> Column:
    """12-hour clock text whose time carries a one-letter suffix ('a'/'p'): the
    suffix is upper-cased and completed with 'M', parsed, then shifted by
    ``shift_hours`` (a station whose clock runs behind)."""
    text = F.concat(_c(date_text), F.lit(" "), F.upper(_c(time_text)), F.lit("M"))
    ts = parse_timestamp(text, fmt)
    if shift_hours:
        ts = ts + F.make_dt_interval(F.lit(0), F.lit(shift_hours))
    return ts


def day_month_ambiguous(text, year: int = 2020) -> Column:
    """Date text written either day-first or month-first. If the first two
    characters read as a number above 12 they are the day, otherwise the month;
    the month's slash is stripped; the year is forced to ``year``. A first field
    that is not a number (one-digit '5/') yields null."""
    t = _c(text)
    first = (F.substring(t, 1, 2)).try_cast("double")
    day_first = first > 12
    day = F.when(day_first, F.substring(t, 1, 2)).when(~day_first, F.substring(t, 4, 2))
    month2 = F.when(day_first, F.substring(t, 4, 2)).when(~day_first, F.substring(t, 1, 2))
    month = (F.regexp_replace(month2, "/", "")).try_cast("double")
    month_txt = month.cast("int").cast("string")
    return parse_date(F.concat(day, F.lit("/"), month_txt, F.lit(f"/{year}")), "d/M/yyyy")


def days_in_month(d) -> Column:
    return F.dayofmonth(F.last_day(_c(d)))


def month_label(d) -> Column:
    """Abbreviated English month name ('Jan')."""
    return F.date_format(_c(d), "MMM")
