"""Column -> Column scalar functions; all built-in Spark expressions."""

from vigilo.functions.text import blank_to_null, canon, canon_nonblank, nonblank
from vigilo.functions.parse import date_key, date_precision, digits_to_int, in_key_range, parse_date, to_bigint
from vigilo.functions.keys import composite_key, surrogate_key

__all__ = [
    "blank_to_null",
    "canon",
    "canon_nonblank",
    "composite_key",
    "date_key",
    "date_precision",
    "digits_to_int",
    "in_key_range",
    "nonblank",
    "parse_date",
    "surrogate_key",
    "to_bigint",
]
