"""Text normalisation as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Unicode text stripping removes (wider than a plain SQL trim).
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def strip(value: Column | str) -> Column:
    """Drop leading and trailing blanks of any kind."""
    return F.btrim(col(value), F.lit(BLANKS))


def nonblank(value: Column | str) -> Column:
    """Empty text becomes NULL."""
    return F.nullif(col(value), F.lit(""))


def clip(value: Column | str, limit: int) -> Column:
    """Stripped text of at most ``limit`` characters; blank becomes NULL."""
    return F.substring(nonblank(strip(col(value).cast("string"))), 1, limit)


def first_nonblank(*values: Column | str) -> Column:
    """The first value that is neither NULL nor empty."""
    return F.coalesce(*[nonblank(v) for v in values])


def basename(path: Column | str) -> Column:
    return F.substring_index(col(path), "/", -1)


def stem(name: Column | str) -> Column:
    """File name without its last extension; a name that is only an extension stays whole."""
    name = col(name)
    ext = F.substring_index(name, ".", -1)
    cut = F.length(name) - F.length(ext) - 1
    return F.when((cut > 0) & (ext != ""), F.substring(name, F.lit(1), cut)).otherwise(name)


def suffix_split(value: Column | str) -> tuple[Column, Column]:
    """(text before the last underscore, text after it); without one the first part is empty."""
    value = col(value)
    tail = F.substring_index(value, "_", -1)
    cut = F.length(value) - F.length(tail) - 1
    head = F.when(cut > 0, F.substring(value, F.lit(1), cut)).otherwise(F.lit(""))
    return head, tail


def parties(title: Column | str) -> Column:
    """The text after the first " of ", or the whole title."""
    title = col(title)
    at = F.instr(title, " of ")
    body = F.when(at > 0, F.substring(title, at + 4, F.length(title))).otherwise(title)
    return nonblank(strip(body))


def joined(separator: str, *values: Column | str) -> Column:
    """Non-NULL values joined by ``separator``; NULL when there is none."""
    return nonblank(F.concat_ws(separator, *[col(v) for v in values]))


def bare_url(value: Column | str) -> Column:
    """The value when it is a plain link without blanks, else NULL."""
    value = col(value)
    return F.when(value.startswith("http") & ~value.contains(" "), value)


def error_text(value: Column | str) -> Column:
    return F.substring(col(value), 1, 500)
