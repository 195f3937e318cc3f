"""Time buckets by frequency alias, as columns.

Month, quarter, year and week ends are closed and labelled on the right; counts
of days and hours start at the first day of the data and are labelled on the left.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_ALIAS = re.compile(r"(\d*)\s*([A-Za-z]+)(?:-([A-Z]{3}))?$")
#: Weekday names as Spark's next_day takes them.
_DAYS = ("MON", "TUE", "WED", "THU", "FRI", "SAT", "SUN")
ANCHORED = {"D", "H", "T", "MIN", "S"}


def parse(freq: str) -> tuple[int, str, str | None]:
    m = _ALIAS.match(freq)
    if not m:
        raise ValueError(f"not a frequency: {freq!r}")
    unit = {"M": "ME", "Q": "QE", "Y": "YE", "A": "YE", "AS": "YS"}.get(m[2].upper(), m[2].upper())
    if unit not in {"ME", "MS", "QE", "QS", "YE", "YS", "W", *ANCHORED}:
        raise ValueError(f"unknown frequency unit {m[2]!r} in {freq!r}")
    return int(m[1] or 1), unit, m[3]


def needs_origin(freq: str) -> bool:
    n, unit, _ = parse(freq)
    return unit in ANCHORED and not (n == 1 and unit == "D") or unit not in ANCHORED and n > 1


def step_of(freq: str) -> str | None:
    """The length of a period shorter than a day, as Spark writes intervals; None where periods are days or more."""
    n, unit, _ = parse(freq)
    names = {"H": "hours", "T": "minutes", "MIN": "minutes", "S": "seconds"}
    return f"{n} {names[unit]}" if unit in names else None


def bucket(time: Column, freq: str, origin: Column | None = None) -> Column:
    """The label of the bucket that ``time`` is in; ``origin`` is the first time of the data where buckets are counted from it."""
    n, unit, day = parse(freq)
    date = F.to_date(time)
    if unit in ("ME", "MS", "QE", "QS", "YE", "YS"):
        months = {"M": 1, "Q": 3, "Y": 12}[unit[0]]
        first = F.trunc(date, {1: "MM", 3: "quarter", 12: "year"}[months])
        if n > 1:
            if origin is None:
                raise ValueError(f"{freq!r} needs an origin")
            start = F.trunc(F.to_date(origin), {1: "MM", 3: "quarter", 12: "year"}[months])
            step = F.floor(F.months_between(first, start) / (n * months)) * (n * months)
            first = F.add_months(start, step.cast("int"))
        return first if unit[1] == "S" else F.last_day(F.add_months(first, n * months - 1))
    if unit == "W":
        end = F.next_day(F.date_sub(date, 1), day or _DAYS[6])
        if n == 1:
            return end
        if origin is None:
            raise ValueError(f"{freq!r} needs an origin")
        begin = F.next_day(F.date_sub(F.to_date(origin), 1), day or _DAYS[6])
        return F.date_add(begin, (F.ceil(F.datediff(end, begin) / (7 * n)) * 7 * n).cast("int"))
    if unit == "D":
        if n == 1:
            return date
        if origin is None:
            raise ValueError(f"{freq!r} needs an origin")
        start = F.to_date(origin)
        return F.date_add(start, (F.floor(F.datediff(date, start) / n) * n).cast("int"))
    size = n * {"H": 3600, "T": 60, "MIN": 60, "S": 1}[unit] * 1_000_000
    at = F.unix_micros(time.cast("timestamp"))
    if origin is None:
        raise ValueError(f"{freq!r} needs an origin")
    start = F.unix_micros(F.to_date(origin).cast("timestamp"))
    return F.timestamp_micros(start + F.floor((at - start) / size) * size).cast("timestamp_ntz")
