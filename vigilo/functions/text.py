"""Text normalisation.

``canon`` is the matching key used for every natural key in the model (drug
names, reaction and condition terms, patient profiles): runs of whitespace
collapse to one space, then trim and upper-case.  ``\\s`` is Java's class
``[ \\t\\n\\x0B\\f\\r]``; Spark's ``upper`` applies full case mapping, so
``'ß'`` becomes ``'SS'``.
"""

from functools import reduce

from pyspark.sql import Column, functions as F

from vigilo.functions._col import col

WHITESPACE_RUN = r"\s+"
# A text without any of these has no run to collapse: a byte search, before the pattern.
RUN_MARKS = ("  ", "\t", "\n", "\x0b", "\f", "\r")


def canon(c) -> Column:
    c = col(c).cast("string")
    has_run = reduce(Column.__or__, [c.contains(m) for m in RUN_MARKS])
    return F.upper(F.trim(F.when(has_run, F.regexp_replace(c, WHITESPACE_RUN, " ")).otherwise(c)))


def canon_nonblank(c) -> Column:
    """``nonblank(canon(c))`` without building the key: some character is not
    whitespace.  Case mapping makes no character blank."""
    return col(c).rlike(r"\S")


def nonblank(c) -> Column:
    """True when the value is present and not only spaces (``trim`` strips spaces only)."""
    c = col(c)
    return c.isNotNull() & (F.trim(c) != F.lit(""))


def blank_to_null(c) -> Column:
    """Trimmed value, NULL when nothing is left."""
    return F.nullif(F.trim(col(c)), F.lit(""))
