"""Typed parsing of external text.  Every function is ANSI-safe: bad input
gives NULL instead of failing the job."""

from pyspark.sql import Column, functions as F

from vigilo.functions._col import col

# The accepted date layouts, matched by shape before parsing.
DATE_LAYOUTS = [
    # (length, shape, pieces of the text, suffix appended before parsing, precision)
    (10, r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$", None, "", "day"),
    (8, r"^[0-9]{8}$", ((1, 4), (5, 2), (7, 2)), "", "day"),
    (7, r"^[0-9]{4}-[0-9]{2}$", None, "-01", "month"),
    (6, r"^[0-9]{6}$", ((1, 4), (5, 2)), "-01", "month"),
    (4, r"^[0-9]{4}$", None, "-01-01", "year"),
]

# A date key is kept only inside this yyyyMMdd range.
DATE_KEY_MIN = 19000101
DATE_KEY_MAX = 20991231


def digits_to_int(c) -> Column:
    """Keep digits and '-', then cast to INT; '12.5' -> 125, '1,234' -> 1234,
    '' / '1-2' / out of range -> NULL."""
    return F.regexp_replace(col(c).cast("string"), r"[^0-9\-]", "").try_cast("int")


def to_bigint(c) -> Column:
    """Trimmed text to BIGINT, NULL when it is not a whole number."""
    return F.trim(col(c).cast("string")).try_cast("bigint")


def _layouts(c):
    """(shape test, parsed date, precision) per accepted layout.  The lengths
    differ, so a text meets one pattern at most; its ISO form is cast, which
    takes no formatter."""
    s = F.trim(col(c).cast("string"))
    for length, shape, pieces, suffix, precision in DATE_LAYOUTS:
        text = F.concat_ws("-", *[F.substring(s, *p) for p in pieces]) if pieces else s
        text = F.concat(text, F.lit(suffix)) if suffix else text
        yield (F.length(s) == length) & s.rlike(shape), text.try_cast("date"), precision


def parse_date(c) -> Column:
    """Parse yyyy-MM-dd, yyyyMMdd, yyyy-MM, yyyyMM and yyyy; anything else,
    including impossible dates such as month 13, gives NULL."""
    out = F
    for is_shape, parsed, _ in _layouts(c):
        out = out.when(is_shape, parsed)
    return out


def date_precision(c) -> Column:
    """'day', 'month' or 'year' for text that ``parse_date`` accepts, else NULL."""
    out = F
    for is_shape, parsed, precision in _layouts(c):
        out = out.when(is_shape & parsed.isNotNull(), F.lit(precision))
    return out


def in_key_range(c, lo: int = DATE_KEY_MIN, hi: int = DATE_KEY_MAX) -> Column:
    """The value when lo <= value <= hi, else NULL."""
    c = col(c)
    return F.when(c.between(lo, hi), c)


def date_key(d, guard: bool = True) -> Column:
    """yyyyMMdd as INT, computed arithmetically (no string formatting)."""
    d = col(d)
    k = F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)
    return in_key_range(k) if guard else k
