"""Sliding windows over panes.

Windows of a length and slide are made of panes as long as the greatest common divisor of both. Readings are
folded per pane once, and only panes are dealt to the windows they lie in, so a reading does not travel once
for each window. Windows begin at multiples of the slide since 1970.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, functions as F

_UNITS = {"millisecond": 1, "second": 1_000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000, "week": 604_800_000}


def duration_ms(text: str) -> int:
    """Milliseconds of a duration such as ``90 seconds`` or ``1 hour 30 minutes``."""
    parts = re.findall(r"(\d+)\s*([a-z]+?)s?\b", text.lower())
    if not parts or any(unit not in _UNITS for _, unit in parts) or re.sub(r"(\d+)\s*[a-z]+", "", text.lower()).strip():
        raise ValueError(f"not a duration: {text!r}")
    return sum(int(n) * _UNITS[unit] for n, unit in parts)


def pane_ms(window: str, slide: str | None) -> int:
    length, step = duration_ms(window), duration_ms(slide or window)
    if not 0 < step <= length:
        raise ValueError("a slide is no longer than its window, and longer than nothing")
    return math.gcd(length, step)


def pane_start(ts: Column, pane: int) -> Column:
    return F.call_function("floor", ts / F.lit(pane)).cast("bigint") * pane


def window_starts(pane: Column, window: str, slide: str | None) -> Column:
    """The starts of all windows that a pane, given by its start, lies in."""
    length, step = duration_ms(window), duration_ms(slide or window)
    floor = lambda c: F.call_function("floor", c).cast("bigint")
    last = floor(pane / F.lit(step)) * step
    first = -floor((F.lit(length - pane_ms(window, slide)) - pane) / F.lit(step)) * step
    return F.sequence(first, last, F.lit(step).cast("bigint"))
