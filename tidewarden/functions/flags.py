"""The ordered quality flag and its three-valued checks.

Ranks are the flag's codes, so that merging is ``greatest``; a missing side counts as NO_QC.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NO_QC, GOOD, PROBABLY_GOOD, PROBABLY_BAD, BAD, MISSING = 0, 1, 2, 3, 4, 9
NAMES = {NO_QC: "NO_QUALITY_CONTROL", GOOD: "GOOD", PROBABLY_GOOD: "PROBABLY_GOOD", PROBABLY_BAD: "PROBABLY_BAD", BAD: "BAD", MISSING: "MISSING"}
CODES = {name: code for code, name in NAMES.items()}


def from_bool(check: Column, on_true: int, on_false: int = NO_QC, on_nan: int = NO_QC) -> Column:
    """Flag of a check that is true, false or missing."""
    return F.when(check.isNull(), F.lit(on_nan)).when(check, F.lit(on_true)).otherwise(F.lit(on_false))


def merge(*flags: Column | str) -> Column:
    """The worst of the flags; null sides are NO_QC."""
    cols = [F.col(f) if isinstance(f, str) else f for f in flags]
    return F.greatest(F.lit(NO_QC), *cols)


def take_new(old: Column | str, new: Column) -> Column:
    """Merge by replacement where the new flag is there."""
    return F.coalesce(new, F.col(old) if isinstance(old, str) else old)


def name_of(flag: Column) -> Column:
    out = F.when(flag == NO_QC, NAMES[NO_QC])
    for code, name in list(NAMES.items())[1:]:
        out = out.when(flag == code, name)
    return out


def code_of(name: Column) -> Column:
    out = F.when(name == NAMES[NO_QC], NO_QC)
    for code, text in list(NAMES.items())[1:]:
        out = out.when(name == text, code)
    return out
