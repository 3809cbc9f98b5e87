"""A report holding most of the rows: the fact splits it and stays exact."""

from pyspark.sql import functions as F

from vigilo.operators.joins import SkewSpec
from vigilo.plans import facts, silver

DEMO = "primaryid string, caseid string, caseversion string, sex string, age string, age_cod string, event_dt string, occr_country string, reporter_country string"


def _raw(spark, n_drugs=1000, n_reacs=1000):
    demo = spark.createDataFrame(
        [("1", "1", "1", "F", "40", "YR", "2024-01-01", "US", "US")]
        + [(str(100 + i), str(100 + i), "1", "M", "50", "YR", "2024-02-01", "DE", "DE") for i in range(20)],
        DEMO,
    )
    hot_drugs = spark.range(n_drugs).select(
        F.lit("1").alias("primaryid"), F.lit("1").alias("caseid"), F.col("id").cast("string").alias("drug_seq"),
        F.lit("PS").alias("role_cod"), F.concat(F.lit("drug "), F.col("id").cast("string")).alias("drugname"),
        F.lit(None).cast("string").alias("prod_ai"), F.lit(None).cast("string").alias("route"),
    )
    cold_drugs = spark.range(20).select(
        (F.col("id") + 100).cast("string").alias("primaryid"), (F.col("id") + 100).cast("string").alias("caseid"),
        F.lit("1").alias("drug_seq"), F.lit("SS").alias("role_cod"), F.lit("aspirin").alias("drugname"),
        F.lit(None).cast("string").alias("prod_ai"), F.lit(None).cast("string").alias("route"),
    )
    reacs = spark.range(n_reacs).select(
        F.lit("1").alias("primaryid"), F.lit("1").alias("caseid"), F.concat(F.lit("reaction "), F.col("id").cast("string")).alias("pt")
    ).unionByName(spark.range(20).select(
        (F.col("id") + 100).cast("string").alias("primaryid"), (F.col("id") + 100).cast("string").alias("caseid"), F.lit("rash").alias("pt")
    ))
    outc = spark.createDataFrame([("1", "1", "HO")], "primaryid string, caseid string, outc_cod string")
    indi = spark.createDataFrame([("1", "1", "1", "pain")], "primaryid string, caseid string, indi_drug_seq string, indi_pt string")
    return (silver.demo(demo), silver.drug(hot_drugs.unionByName(cold_drugs)), silver.reac(reacs), silver.indi(indi), silver.outc(outc))


def test_hot_report_fact_is_split_and_exact(spark):
    s = _raw(spark)
    salted = facts.report_fact(*s[:3], s[3], s[4], skew=SkewSpec(pairs_per_cell=10_000))
    plain = facts.report_fact(*s[:3], s[3], s[4], skew=SkewSpec(pairs_per_cell=0))
    assert salted.count() == 1_000_000 + 20
    hot = salted.filter(F.col("primaryid") == 1)
    assert hot.select("drug_sk", "reaction_sk").distinct().count() == 1_000_000
    assert hot.filter((F.col("outc_hosp") != 1) | F.col("condition_sk").isNull()).count() == 0
    diff = salted.exceptAll(plain).count() + plain.exceptAll(salted).count()
    assert diff == 0


def test_hot_study_trial_fact(spark):
    n = 300
    studies = silver.studies(spark.createDataFrame(
        [("N1", None, None, None, None, None, None, None), ("N2", None, None, None, None, None, None, None)],
        "nct_id string, overall_status string, phase string, study_type string, enrollment string, start_date string, completion_date string, last_update_posted_date string"))
    inter = silver.interventions(spark.range(n).select(
        F.lit("N1").alias("nct_id"), F.lit("Drug").alias("intervention_type"), F.concat(F.lit("d"), F.col("id").cast("string")).alias("name")
    ).unionByName(spark.createDataFrame([("N2", "Drug", "x")], "nct_id string, intervention_type string, name string")))
    cond = silver.conditions(spark.range(n).select(
        F.lit("N1").alias("nct_id"), F.concat(F.lit("c"), F.col("id").cast("string")).alias("name")
    ).unionByName(spark.createDataFrame([("N2", "y")], "nct_id string, name string")))
    salted = facts.trial_fact(studies, inter, cond, skew=SkewSpec(pairs_per_cell=2_500))
    assert salted.count() == n * n + 1
    assert salted.distinct().count() == n * n + 1


def test_summaries_equal_the_summed_fact(spark):
    s = _raw(spark, n_drugs=30, n_reacs=20)
    fact = facts.report_fact(*s, skew=SkewSpec(pairs_per_cell=0))
    rest = [c for c in fact.columns if c not in ("drug_sk", "reaction_sk", "event_count")]
    for frame, keys in ((facts.report_summary(*s), rest), (facts.report_drugs(*s), [*rest, "drug_sk"])):
        summed = fact.groupBy(*keys).agg(F.sum("event_count").alias("event_count"))
        frame = frame.select(*summed.columns)
        assert frame.count() == summed.count()
        assert frame.exceptAll(summed).isEmpty()
