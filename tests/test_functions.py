import datetime as dt
import hashlib

from pyspark.sql import functions as F

from vigilo.functions import (
    canon,
    canon_nonblank,
    composite_key,
    date_key,
    date_precision,
    digits_to_int,
    nonblank,
    parse_date,
    surrogate_key,
)


def _one_col(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {typ}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_canon(spark):
    got = _one_col(spark, ["  acetyl\t salicylic\nacid ", "Straße", "   ", None, "a\u000bb"], canon)
    assert got == ["ACETYL SALICYLIC ACID", "STRASSE", "", None, "A B"]


def test_nonblank(spark):
    got = _one_col(spark, ["a", "   ", "", None, "\t"], nonblank)
    # trim strips spaces only, so a lone tab counts as a value (as in Spark's trim)
    assert got == [True, False, False, False, True]


def test_digits_to_int(spark):
    got = _one_col(spark, ["1,234", "12.5", "", "abc", "1-2", "3,000,000,000", None, "-7"], digits_to_int)
    assert got == [1234, 125, None, None, None, None, None, -7]


def test_parse_date_and_precision(spark):
    raw = ["2019-01-05", "20190105", "201901", "2019", "2019-13-01", "", "abc", "2019-02", " 2019-01-05 ", "2019-02-30"]
    got = _one_col(spark, raw, parse_date)
    d = dt.date
    assert got == [d(2019, 1, 5), d(2019, 1, 5), d(2019, 1, 1), d(2019, 1, 1), None, None, None, d(2019, 2, 1), d(2019, 1, 5), None]
    prec = _one_col(spark, raw, date_precision)
    assert prec == ["day", "day", "month", "year", None, None, None, "month", "day", None]


def test_date_key_guard(spark):
    dates = [dt.date(1899, 12, 31), dt.date(1900, 1, 1), dt.date(2099, 12, 31), dt.date(2100, 1, 1), None]
    got = _one_col(spark, dates, date_key, "date")
    assert got == [None, 19000101, 20991231, None, None]
    raw = _one_col(spark, dates, lambda c: date_key(c, guard=False), "date")
    assert raw == [18991231, 19000101, 20991231, 21000101, None]


def test_surrogate_key_is_md5_prefix(spark):
    keys = ["ASPIRIN", "IBUPROFEN", "", None]
    got = _one_col(spark, keys, surrogate_key)
    expect = [int(hashlib.md5(k.encode()).hexdigest()[:15], 16) if k is not None else None for k in keys]
    assert got == expect
    assert all(v is None or 0 <= v < 2**60 for v in got)


def test_composite_key_defaults_blank_and_null(spark):
    df = spark.createDataFrame(
        [(None, "yr", "us", "us"), (" ", "yr", "us", "us"), ("F", None, " ", "de  x")],
        "sex string, age string, rep string, occ string",
    )
    got = [r[0] for r in df.select(composite_key("sex", "age", "rep", "occ")).collect()]
    assert got == ["UNK|YR|US|US", "UNK|YR|US|US", "F|UNK|UNK|DE X"]


def test_a_blank_key_is_known_without_building_it(spark):
    texts = [None, "", " ", "\t", " \n ", "\x0b\f\r", "a", "  a \t b ", "\x85", "ß"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = df.select(F.coalesce(canon_nonblank("t"), F.lit(False)), F.coalesce(nonblank(canon("t")), F.lit(False)), canon("t")).collect()
    assert [r[0] for r in found] == [r[1] for r in found] == [False] * 6 + [True] * 4
    assert [r[2] for r in found] == [None, "", "", "", "", "", "A", "A B", "\x85", "SS"]
