"""Time expressions: fixed-offset local dates and multi-format timestamp detection."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping

from pyspark.sql import Column, functions as F

# Date and time parts that a load recognises by itself, each with the shape of its text. No text has
# two shapes of dates or two of times.
AUTO_DATES = {
    "yyyy-MM-dd": r"\d{4}-\d\d-\d\d",
    "M/d/yyyy": r"\d\d?/\d\d?/\d{4}",
    "yyyyMMdd": r"\d{8}",
    "yyyy/MM/dd": r"\d{4}/\d\d/\d\d",
    "M-d-yyyy": r"\d\d?-\d\d?-\d{4}",
    "MMM d[,] yyyy": r"[A-Za-z]{3} \d\d?,? \d{4}",
    "MMMM d[,] yyyy": r"[A-Za-z]{4,9} \d\d?,? \d{4}",
    "d MMM yyyy": r"\d\d? [A-Za-z]{3} \d{4}",
    "d MMMM yyyy": r"\d\d? [A-Za-z]{4,9} \d{4}",
}
AUTO_TIMES = {
    "H:mm:ss[.SSSSSS][.SSSSS][.SSSS][.SSS][.SS][.S]": r"\d\d?:\d\d:\d\d(?:[.]\d{1,6})?",
    "H:mm": r"\d\d?:\d\d",
    "h:mm:ssa": r"\d\d?:\d\d:\d\d\s*[AaPp][.]?[Mm][.]?",
    "h:mma": r"\d\d?:\d\d\s*[AaPp][.]?[Mm][.]?",
    "HHmmss": r"\d{6}",
}


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def offset_seconds(offset: str) -> int:
    """Seconds east of UTC of an offset like ``-05:00``."""
    m = re.fullmatch(r"([+-])(\d{2}):(\d{2})", offset)
    if not m:
        raise ValueError(f"offset must look like -05:00, got {offset!r}")
    sign = -1 if m.group(1) == "-" else 1
    return sign * (int(m.group(2)) * 3600 + int(m.group(3)) * 60)


def local_date(ts: Column | str, offset: str = "-05:00") -> Column:
    """Calendar date of an instant seen at a fixed offset (no DST rules), whatever the session's zone.

    TIMESTAMP_NTZ holds UTC wall-clock time; TIMESTAMP is the instant itself.
    """
    c, secs = _c(ts), offset_seconds(offset)
    wall = F.to_date(c + F.expr(f"INTERVAL {secs} SECONDS"))
    instant = F.date_from_unix_date(F.floor((F.unix_seconds(c.cast("timestamp")) + F.lit(secs)) / F.lit(86400)).cast("int"))
    return F.when(F.typeof(c) == "timestamp_ntz", wall).otherwise(instant)


def offset_instant(c: Column | str) -> Column:
    """X11: text ``yyyy-MM-dd HH:mm:ss+-hh:mm`` (or with ``T``) as the instant in UTC, TIMESTAMP_NTZ; null if it is neither."""
    c = F.replace(F.trim(_c(c)), F.lit("T"), F.lit(" "))
    offset = F.regexp_extract(c, r"([+-]\d{2}:\d{2})$", 1)
    wall = F.try_to_timestamp(F.regexp_replace(c, r"\s*[+-]\d{2}:\d{2}$", ""), F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")
    minutes = (F.substring(offset, 2, 2).try_cast("int") * 60 + F.substring(offset, 5, 2).try_cast("int")) * F.when(
        F.startswith(offset, F.lit("-")), F.lit(-1)).otherwise(F.lit(1))
    return F.when(offset != "", wall - F.make_interval(mins=minutes))


def auto_timestamp(c: Column | str, dates: Mapping[str, str] = AUTO_DATES, times: Mapping[str, str] = AUTO_TIMES) -> Column:
    """A date, alone or with a time after white space or ``T``, each read once, by the form that its shape calls for.

    Months may be names or numbers, seconds may have a fraction of up to six digits or be left out,
    AM and PM may be in any case, with or without dots. Null when no form fits. Result is TIMESTAMP_NTZ.
    The shapes are tested on the text itself, so that nothing is worked out again for each of them.
    """
    text, between = _c(c), r"(?:[Tt]|\s+)"
    any_date, any_time = (f"(?:{'|'.join(x.values())})" for x in (dates, times))

    def first(forms: Mapping[str, str], test: str, cut: str, clean: Callable[[Column], Column]) -> Column:
        cases = [(text.rlike(test % shape), F.try_to_timestamp(clean(F.regexp_extract(text, cut % shape, 1)), F.lit(form)))
                 for form, shape in forms.items()]
        out = F.when(*cases[0])
        for fits, value in cases[1:]:
            out = out.when(fits, value)
        return out.cast("timestamp_ntz")

    date = first(dates, r"^\s*%s(?:[Tt\s]|$)", r"^\s*(%s)", lambda x: x)
    time = first(times, between + r"%s\s*$", between + r"(%s)\s*$", lambda x: F.regexp_replace(x, r"\s+|[.](?=[Mm]|$)", ""))
    plain = text.rlike(rf"^\s*{any_date}\s*$")
    timed = text.rlike(rf"^\s*{any_date}{between}{any_time}\s*$")
    return F.when(plain, date).when(timed, date + (time - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")))
