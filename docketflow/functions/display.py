"""Sizes and shares as people read them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docketflow.functions.text import col

UNITS = ("B", "KiB", "MiB", "GiB", "TiB")


def _by_unit(n: Column, render) -> Column:
    """Pick the unit by size and render ``n`` scaled to it."""
    out = render(n / F.lit(1024.0**4), "TiB")
    for power in (3, 2, 1, 0):
        scaled = n / F.lit(1024.0**power)
        out = F.when(n < F.lit(1024.0 ** (power + 1)), render(scaled, UNITS[power])).otherwise(out)
    return out


def human_size(n: Column | str) -> Column:
    """One decimal above bytes, ties to even."""

    def render(v: Column, unit: str) -> Column:
        if unit == "B":
            return F.concat(v.cast("long").cast("string"), F.lit(" B"))
        return F.format_string(f"%.1f {unit}", F.bround(v, 1))

    return _by_unit(col(n).cast("double"), render)


def short_size(n: Column | str) -> Column:
    """One decimal below ten, whole numbers above, ties upward; a dash for NULL."""

    def render(v: Column, unit: str) -> Column:
        whole = F.concat(F.floor(v + 0.5).cast("string"), F.lit(f" {unit}"))
        if unit == "B":
            return whole
        return F.when(v < 10, F.format_string(f"%.1f {unit}", F.round(v, 1))).otherwise(whole)

    n = col(n)
    return F.when(n.isNull(), "–").otherwise(_by_unit(n.cast("double"), render))


def share_of_cap(used: Column | str, cap: Column | str) -> Column:
    """Used bytes as a percentage of the cap; 0 without a cap."""
    used, cap = col(used), col(cap)
    return F.when(cap == 0, F.lit(0.0)).otherwise(F.round(used / cap * 100, 2))
