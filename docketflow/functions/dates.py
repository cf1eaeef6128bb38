"""Decision dates, clocks and retry delays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docketflow.functions.text import col, strip

# The date shapes the collections use.
YEAR_RUN = r"(?:19|20)\d{2}"
ISO_DAY = r"^(?:19|20)\d{2}-\d{2}-\d{2}"
DAY_FIRST = r"^\d{1,2}[-/]\d{1,2}[-/](?:19|20)\d{2}"


def decision_year(value: Column | str) -> Column:
    """First run of four digits opening with 19 or 20, wherever it stands."""
    found = F.regexp_extract(col(value).cast("string"), YEAR_RUN, 0)
    return found.try_cast("int")


def decision_date(value: Column | str) -> Column:
    """ISO text of a reported date, ISO prefix first and day-first otherwise.

    Impossible days, and the empty text of a pattern that is not found, give NULL:
    ``try_cast`` neither clamps nor raises.
    """
    text = strip(col(value).cast("string"))
    iso = F.regexp_extract(text, ISO_DAY, 0)
    day_first = F.regexp_replace(
        F.regexp_extract(text, DAY_FIRST, 0), r"^(\d+)[-/](\d+)[-/](\d+)$", "$3-$2-$1"
    )
    return F.coalesce(iso.try_cast("date"), day_first.try_cast("date")).cast("string")


def backoff_seconds(attempts: Column | str, base: int = 60, cap: int = 900) -> Column:
    """Delay before the next try: doubling from ``base``, never above ``cap``."""
    tries = F.least(col(attempts) - 1, F.lit(30))
    return F.least(F.lit(base) * F.pow(F.lit(2.0), tries), F.lit(float(cap))).cast("long")


def clock(value: Column | str) -> Column:
    """Wall-clock text of a timestamp in the session time zone."""
    return F.date_format(col(value), "HH:mm:ss")
