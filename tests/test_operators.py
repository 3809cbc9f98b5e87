import datetime as dt

from pyspark.sql import functions as F

from vigilo.operators import SaltPlan, SkewSpec, calendar, code_flags, first_by, latest_by, pick_by_priority, skew_join
from vigilo.operators.flags import any_flag


def test_latest_version_numeric_nulls_last_and_ties(spark):
    rows = [
        ("c1", 1, 100), ("c1", 2, 101), ("c1", 10, 102),  # 10 wins numerically
        ("c2", None, 200), ("c2", 3, 201),  # NULL version last
        ("c3", 5, 300), ("c3", 5, 301),  # tie: highest id
        ("c4", None, 400),
    ]
    df = spark.createDataFrame(rows, "caseid string, v int, pid int")
    got = {r.caseid: (r.v, r.pid) for r in latest_by(df, ["caseid"], "v", [("pid", "desc")]).collect()}
    assert got == {"c1": (10, 102), "c2": (3, 201), "c3": (5, 301), "c4": (None, 400)}


def test_first_by_is_deterministic_under_reshuffle(spark):
    rows = [(k % 7, f"n{k % 3}", k % 5, None if k % 11 == 0 else float(k)) for k in range(500)]
    df = spark.createDataFrame(rows, "k int, name string, a int, b double")
    one = sorted(first_by(df, ["k"], [("name", "desc")]).collect())
    two = sorted(first_by(df.repartition(13, "b").orderBy(F.rand(7)), ["k"], [("name", "desc")]).collect())
    assert one == two and len(one) == 7


def test_pick_by_priority(spark):
    rows = [("ASPIRIN", "Aspirin", 2), ("ASPIRIN", "aspirin", 1), ("ASPIRIN", "ASA", 1), ("IBU", "Ibu", 2)]
    df = spark.createDataFrame(rows, "k string, name string, p int")
    got = {r.k: (r.name, r.p) for r in pick_by_priority(df, ["k"], "p", [("name", "asc")]).collect()}
    assert got == {"ASPIRIN": ("ASA", 1), "IBU": ("Ibu", 2)}


def test_code_flags_and_any(spark):
    rows = [(1, "DE"), (2, "HO"), (2, "DE"), (3, "CA"), (4, None)]
    df = spark.createDataFrame(rows, "r int, code string")
    codes = {"death": "DE", "hosp": "HO", "other": "OT"}
    out = code_flags(df, ["r"], "code", codes).withColumn("any", any_flag(list(codes)))
    got = {r.r: (r.death, r.hosp, r.other, r.any) for r in out.collect()}
    assert got == {1: (1, 0, 0, 1), 2: (1, 1, 0, 1), 3: (0, 0, 0, 0), 4: (0, 0, 0, 0)}


def test_calendar(spark):
    cal = calendar(spark, dt.date(2000, 1, 1), dt.date(2026, 12, 31))
    assert cal.count() == (dt.date(2026, 12, 31) - dt.date(2000, 1, 1)).days + 1
    leap = cal.filter(F.col("full_date") == F.lit(dt.date(2000, 2, 29))).collect()
    assert len(leap) == 1 and leap[0].date_key == 20000229 and leap[0].quarter == "2000Q1"
    last = cal.orderBy(F.col("full_date").desc()).first()
    assert last.full_date == dt.date(2026, 12, 31) and last.month_name == "December"
    sat = cal.filter(F.col("full_date") == F.lit(dt.date(2024, 1, 6))).first()
    assert sat.day_of_week == "Saturday" and sat.is_weekend == 1
    mon = cal.filter(F.col("full_date") == F.lit(dt.date(2024, 1, 8))).first()
    assert mon.is_weekend == 0


def _skewed(spark, hot_drugs=1000, hot_reacs=1000):
    drugs = spark.range(hot_drugs).select(F.lit(7).cast("long").alias("r"), F.col("id").alias("d"))
    reacs = spark.range(hot_reacs).select(F.lit(7).cast("long").alias("r"), F.col("id").alias("x"))
    small_d = spark.range(300).select((F.col("id") % 100 + 100).alias("r"), F.col("id").alias("d"))
    small_x = spark.range(200).select((F.col("id") % 100 + 100).alias("r"), F.col("id").alias("x"))
    return drugs.unionByName(small_d), reacs.unionByName(small_x)


def test_skew_join_splits_hot_key_and_keeps_every_pair(spark):
    left, right = _skewed(spark)
    spec = SkewSpec(pairs_per_cell=10_000)
    plan = SaltPlan.detect(left, right, ["r"], spec)
    assert [tuple(r) for r in plan.hot.collect()] == [(7, 10, 10)]
    out = skew_join(left, right, ["r"], spec=spec)
    # 1,000 x 1,000 pairs for the hot report plus 3 x 2 for each of 100 small ones
    assert out.count() == 1_000_000 + 600
    assert out.select("r", "d", "x").distinct().count() == 1_000_000 + 600
    # The hot key's pairs are spread over the 10 x 10 grid, not one task.
    cells = plan.left(left).join(plan.right(right), plan.join_keys).groupBy("_salt_i", "_salt_j").count()
    assert cells.filter(F.col("count") >= 5000).count() == 100


def test_skew_join_left_outer_keeps_unmatched_once(spark):
    left, right = _skewed(spark, hot_drugs=500, hot_reacs=0)
    out = skew_join(left, right, ["r"], how="left", spec=SkewSpec(pairs_per_cell=100))
    plain = left.join(right, ["r"], "left")
    assert sorted(out.collect(), key=str) == sorted(plain.collect(), key=str)


def test_skew_join_left_splits_keys_hot_on_the_right(spark):
    left, right = _skewed(spark, hot_drugs=3, hot_reacs=900)
    left = left.unionByName(spark.createDataFrame([(-1, 1), (None, 2)], left.schema))
    spec = SkewSpec(pairs_per_cell=100)
    assert [tuple(r) for r in SaltPlan.detect(left, right, ["r"], spec).hot.collect()] == [(7, 1, 27)]
    out = skew_join(left, right, ["r"], how="left", spec=spec)
    assert sorted(out.collect(), key=str) == sorted(left.join(right, ["r"], "left").collect(), key=str)


def test_many_pairs_of_moderate_sides_are_split(spark):
    left, right = _skewed(spark, hot_drugs=20_000, hot_reacs=20_000)
    hot = SaltPlan.detect(left, right, ["r"]).hot.collect()
    assert [tuple(r) for r in hot] == [(7, 10, 10)]  # 400 million pairs, 4 million a cell


def test_no_hot_keys_is_a_plain_join(spark):
    left, right = _skewed(spark, hot_drugs=3, hot_reacs=3)
    assert SaltPlan.detect(left, right, ["r"]).hot.isEmpty()
    off = SaltPlan.detect(left, right, ["r"], SkewSpec(pairs_per_cell=0))
    assert off.hot is None and off.join_keys == ["r"]


def test_skew_join_on_key_only_frames(spark):
    left = spark.range(400).select(F.lit(1).cast("long").alias("r")).unionByName(spark.range(5).select(F.col("id").alias("r")))
    right = spark.range(3).select(F.lit(1).cast("long").alias("r"))
    out = skew_join(left, right, ["r"], spec=SkewSpec(pairs_per_cell=50))
    assert out.count() == 401 * 3


def test_calendar_spanning_follows_the_data(spark):
    from vigilo.operators import calendar_spanning

    df = spark.createDataFrame(
        [(dt.datetime(2023, 12, 30, 10, 0),), (dt.datetime(2024, 1, 2, 23, 59),), (None,)], "ts timestamp"
    )
    cal = calendar_spanning(df, "ts").orderBy("full_date").collect()
    assert [r.date_key for r in cal] == [20231230, 20231231, 20240101, 20240102]
    assert [r.quarter for r in cal] == ["2023Q4", "2023Q4", "2024Q1", "2024Q1"]
    assert calendar_spanning(df.filter("ts IS NULL"), "ts").count() == 0
