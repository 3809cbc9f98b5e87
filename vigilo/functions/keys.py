"""Surrogate and composite keys.

A surrogate key is the first 60 bits of the key's MD5, as BIGINT.  It is a
pure function of the natural key, so a fact can compute it inline instead of
joining the dimension; with about n^2/2^61 expected colliding pairs it is
collision-free in practice (a 32-bit hash already collides at ~65k keys).
"""

from pyspark.sql import Column, functions as F

from vigilo.functions._col import col
from vigilo.functions.text import blank_to_null, canon

# Fixed value: the default for a missing profile attribute.
UNKNOWN = "UNK"


def surrogate_key(c) -> Column:
    return F.conv(F.substring(F.md5(col(c).cast("string")), 1, 15), 16, 10).cast("bigint")


def composite_key(*cols, default: str = UNKNOWN) -> Column:
    """canon of the '|'-joined parts; blank or NULL parts become ``default``."""
    parts = [F.coalesce(blank_to_null(c), F.lit(default)) for c in cols]
    return canon(F.concat_ws("|", *parts))
