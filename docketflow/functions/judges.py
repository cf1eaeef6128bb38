"""Judge names and bench composition.

The list of names is handled as one string (separators become a marker character), so the
whole computation stays in generated code without per-element lambdas.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docketflow.functions.text import col, strip

_MARK, _OTHER = "\u0001", "\u0002"
_BLANK = r"[\s\x1c-\x1f]"

# Separators between judges, and the titles taken off the front of a name.
# The order of the titles matters: "mr" is tried before "mrs".
SEPARATORS = r"\||;|,|\band\b"
TITLES = r"mr\.?|mrs\.?|ms\.?|dr\.?|justice|chief" + _BLANK + r"+justice"

# Composition by number of judges, the last one for that many or more.
COMPOSITIONS = (None, "single_judge", "division_bench", "full_bench", "full_bench",
                "constitution_bench")

_SPLIT = f"(?iU){_BLANK}*(?:{SEPARATORS}){_BLANK}*"
_FRONT = (
    f"(?iU)(^|{_MARK})"
    f"(?:(?:hon'?ble{_BLANK}+)?(?:the{_BLANK}+)?(?:{TITLES}){_BLANK}*)+"
)


def _plain(names: Column) -> Column:
    untitled = F.regexp_replace(names, _FRONT, "$1")
    return F.regexp_replace(F.lower(untitled), f"[^a-z0-9{_MARK}]+", "")


def judge_name(name: Column | str) -> Column:
    """Comparable form of one name: no titles, lower case, letters and digits only."""
    return _plain(strip(F.translate(col(name), _MARK, _OTHER)))


def judge_names(judges: Column | str) -> Column:
    """Distinct comparable names on a record."""
    text = strip(F.translate(col(judges), _MARK, _OTHER))
    names = F.split(_plain(F.regexp_replace(text, _SPLIT, _MARK)), _MARK, -1)
    return F.array_remove(F.array_distinct(names), "")


def bench_type(judges: Column | str) -> Column:
    """Composition label from the number of distinct judges; NULL when none is recorded.

    A lookup by position: the name list is built once, which a chain of comparisons would not do.
    """
    n = F.coalesce(F.size(judge_names(judges)), F.lit(0))
    labels = F.array(*[F.lit(label) for label in COMPOSITIONS])
    return F.get(labels, F.least(n, F.lit(len(COMPOSITIONS) - 1)))
