"""Durations written as text, such as ``20min`` or ``1.5 hours``."""

from __future__ import annotations

import re

MICROS = {"us": 1, "ms": 1_000, "s": 1_000_000, "min": 60_000_000, "h": 3_600_000_000, "d": 86_400_000_000, "w": 604_800_000_000}
#: The accepted unit names, by the unit they stand for.
UNITS = {
    "us": ("us", "micro", "micros", "microsecond", "microseconds"),
    "ms": ("ms", "milli", "millis", "millisecond", "milliseconds"),
    "s": ("s", "sec", "secs", "second", "seconds"),
    "min": ("min", "mins", "minute", "minutes", "m", "t"),
    "h": ("h", "hr", "hrs", "hour", "hours"),
    "d": ("d", "day", "days"),
    "w": ("w", "week", "weeks"),
}
BY_NAME = {name: MICROS[unit] for unit, names in UNITS.items() for name in names}


def to_micros(duration: str | int | float) -> int:
    """Microseconds; plain numbers are seconds."""
    if isinstance(duration, (int, float)):
        return round(duration * 1_000_000)
    parts = re.findall(r"([+-]?\d+(?:\.\d+)?)\s*([A-Za-z]+)", duration)
    if not parts or re.sub(r"[+-]?\d+(?:\.\d+)?\s*[A-Za-z]+|[\s,]+", "", duration):
        raise ValueError(f"not a duration: {duration!r}")
    try:
        return round(sum(float(n) * BY_NAME[unit if unit in BY_NAME else unit.lower()] for n, unit in parts))
    except KeyError as e:
        raise ValueError(f"unknown unit {e} in {duration!r}") from None
