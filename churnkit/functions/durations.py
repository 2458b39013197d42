"""ISO-8601 durations (``P0Y2M0DT0H0M0S``) applied to date columns."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

_ISO = re.compile(
    r"^P(?:(?P<y>\d+)Y)?(?:(?P<mo>\d+)M)?(?:(?P<w>\d+)W)?(?:(?P<d>\d+)D)?"
    r"(?:T(?:(?P<h>\d+)H)?(?:(?P<mi>\d+)M)?(?:(?P<s>\d+)S)?)?$"
)


@dataclass(frozen=True)
class IsoDuration:
    months: int = 0
    days: int = 0
    seconds: int = 0

    def iso(self) -> str:
        y, m = divmod(self.months, 12)
        h, rem = divmod(self.seconds, 3600)
        mi, s = divmod(rem, 60)
        return f"P{y}Y{m}M{self.days}DT{h}H{mi}M{s}S"


def parse_duration(text: str) -> IsoDuration:
    m = _ISO.match(text.strip())
    if not m:
        raise ValueError(f"not an ISO-8601 duration: {text!r}")
    g = {k: int(v) if v else 0 for k, v in m.groupdict().items()}
    return IsoDuration(months=12 * g["y"] + g["mo"], days=7 * g["w"] + g["d"],
                       seconds=3600 * g["h"] + 60 * g["mi"] + g["s"])


def duration_string(years: int = 0, months: int = 0, days: int = 0) -> str:
    """Build a duration string the way the service helper does."""
    return IsoDuration(months=12 * years + months, days=days).iso()


def shift_date(c: str | Column, duration: str | IsoDuration, sign: int = 1) -> Column:
    """Move a date by a duration: months first (end-of-month clamped), then days."""
    d = parse_duration(duration) if isinstance(duration, str) else duration
    col = F.col(c) if isinstance(c, str) else c
    if d.months:
        col = F.add_months(col, sign * d.months)
    if d.days:
        col = F.date_add(col, sign * d.days)
    return col
