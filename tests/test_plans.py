"""Silver, dimension, fact and measure semantics on hand-made rows."""

import time

import pytest
from pyspark.sql import functions as F

from vigilo.functions import canon, surrogate_key
from vigilo.plans import dims, facts, measures, model, silver

DEMO = "primaryid string, caseid string, caseversion string, sex string, age string, age_cod string, event_dt string, occr_country string, reporter_country string"
DRUG = "primaryid string, caseid string, drug_seq string, role_cod string, drugname string, prod_ai string, route string"
REAC = "primaryid string, caseid string, pt string"
OUTC = "primaryid string, caseid string, outc_cod string"
INDI = "primaryid string, caseid string, indi_drug_seq string, indi_pt string"


def sk(spark, key):
    return spark.range(1).select(surrogate_key(F.lit(key))).first()[0]


def test_role_filter(spark):
    rows = [("1", "1", "1", r, "x", None, None) for r in ["PS", "SS", "I", "C", "ps", None]]
    got = sorted(r.role_cod for r in silver.drug(spark.createDataFrame(rows, DRUG)).collect())
    assert got == ["I", "PS", "SS"]  # 'ps' upper-cases onto the identical 'PS' row


def test_intervention_filter(spark):
    rows = [("N1", t, f"d{i}") for i, t in enumerate(["Drug", "DRUG", "Device", None])]
    df = spark.createDataFrame(rows, "nct_id string, intervention_type string, name string")
    assert sorted(r.name for r in silver.interventions(df).collect()) == ["d0", "d1"]


def test_silver_demo_latest_version(spark):
    rows = [
        ("101", "C1", "1", "f", "30", "yr", "2019-01-05", "us", "us"),
        ("102", "C1", "2", "F", "30", "YR", "20190105", "US", "US"),
        ("110", "C1", "10", "M", "31", "YR", "2019", "US", "US"),
        ("201", "C2", None, "F", None, None, None, None, None),
        ("202", "C2", "1", "F", None, None, "201902", None, None),
        ("301", "C3", "4", "F", None, None, None, None, None),
        ("302", "C3", "4", "M", None, None, None, None, None),
    ]
    got = {r.caseid: (r.primaryid, r.caseversion, r.event_dt_precision) for r in silver.demo(spark.createDataFrame(rows, DEMO)).collect()}
    assert got == {"C1": ("110", 10, "year"), "C2": ("202", 1, "month"), "C3": ("302", 4, None)}


def test_dim_drug_report_source_wins(spark):
    drug = silver.drug(spark.createDataFrame(
        [("1", "1", "1", "PS", "aspirin ", "ASA", "oral"), ("2", "2", "1", "PS", "Aspirin", "ASA", "oral")], DRUG))
    trials = spark.createDataFrame([("N1", "DRUG", "ASPIRIN"), ("N1", "DRUG", "Metformin")], "nct_id string, intervention_type string, name string")
    got = {r.drug_key: (r.drug_name, r.source) for r in dims.dim_drug(drug, trials).collect()}
    # both report spellings compete at priority 1; the smallest name wins the tie
    assert got == {"ASPIRIN": ("Aspirin", "FAERS"), "METFORMIN": ("Metformin", "AACT")}


def test_dim_condition_priority_and_keys(spark):
    indi = silver.indi(spark.createDataFrame([("1", "1", "1", " Type 2  diabetes ")], INDI))
    cond = silver.conditions(spark.createDataFrame([("N1", "TYPE 2 DIABETES"), ("N1", "asthma")], "nct_id string, name string"))
    rows = {r.condition_key: r for r in dims.dim_condition(indi, cond).collect()}
    assert rows["TYPE 2 DIABETES"].source == "FAERS" and rows["TYPE 2 DIABETES"].condition_name == "Type 2  diabetes"
    assert rows["ASTHMA"].source == "AACT"
    assert rows["ASTHMA"].condition_sk == sk(spark, "ASTHMA")


def test_dim_patient_unknowns(spark):
    demo = spark.createDataFrame(
        [("1", "C1", "1", None, None, "YR", None, "US", "US"), ("2", "C2", "1", " ", None, "YR", None, "US", "US"),
         ("3", "C3", "1", None, None, None, None, None, None)], DEMO)
    got = sorted(r.patient_key for r in dims.dim_patient(silver.demo(demo)).collect())
    assert got == ["UNK|UNK|UNK|UNK", "UNK|YR|US|US"]


def _fact_inputs(spark):
    demo = spark.createDataFrame([
        ("10", "1", "1", "F", None, "YR", "2020-03-01", "US", "US"),   # superseded version of case 1
        ("11", "1", "2", "F", None, "YR", "2020-03-02", "US", "US"),   # latest of case 1
        ("20", "2", "1", "M", None, "YR", "1850-01-01", "DE", "DE"),   # date outside the key range
        ("30", "3", "1", None, None, None, "2021", "FR", "FR"),
    ], DEMO)
    drug = spark.createDataFrame([
        ("10", "1", "1", "PS", "OLD DRUG", None, None),
        ("11", "1", "1", "PS", "aspirin", None, None), ("11", "1", "2", "SS", "Ibuprofen", None, None),
        ("11", "1", "3", "C", "concomitant", None, None),
        ("20", "2", "1", "PS", "aspirin", None, None),
        ("30", "3", "1", "I", "metformin", None, None),
    ], DRUG)
    reac = spark.createDataFrame([
        ("10", "1", "OLD REACTION"), ("11", "1", "Headache"), ("11", "1", "nausea"),
        ("20", "2", "rash"), ("30", "3", "rash"),
    ], REAC)
    outc = spark.createDataFrame([("11", "1", "DE"), ("11", "1", "HO"), ("20", "2", "CA")], OUTC)
    indi = spark.createDataFrame([
        ("11", "1", "1", "pain"), ("11", "1", "2", "fever"), ("11", "1", "3", "arthritis"),
        ("20", "2", "1", "acne"),
    ], INDI)
    return {
        "demo": silver.demo(demo), "drug": silver.drug(drug), "reac": silver.reac(reac),
        "outc": silver.outc(outc), "indi": silver.indi(indi),
    }


def test_report_fact(spark):
    s = _fact_inputs(spark)
    fact = facts.report_fact(s["demo"], s["drug"], s["reac"], s["indi"], s["outc"])
    rows = fact.collect()
    by = {(r.primaryid, r.drug_sk, r.reaction_sk): r for r in rows}
    assert len(rows) == 2 * 2 + 1 + 1  # report 11: 2 suspect drugs x 2 reactions; 20 and 30: one each
    assert all(r.primaryid in (11, 20, 30) for r in rows)  # superseded report 10 is gone
    r11 = by[(11, sk(spark, "ASPIRIN"), sk(spark, "HEADACHE"))]
    assert (r11.outc_death, r11.outc_hosp, r11.outc_any_serious) == (1, 1, 1)
    assert r11.condition_sk == min(sk(spark, k) for k in ["PAIN", "FEVER", "ARTHRITIS"])
    assert r11.date_key == 20200302 and r11.event_count == 1 and r11.caseid == 1
    r20 = by[(20, sk(spark, "ASPIRIN"), sk(spark, "RASH"))]
    assert r20.outc_any_serious == 0 and r20.date_key is None and r20.condition_sk == sk(spark, "ACNE")
    r30 = by[(30, sk(spark, "METFORMIN"), sk(spark, "RASH"))]
    assert r30.condition_sk is None and r30.outc_death == 0 and r30.patient_sk == sk(spark, "UNK|UNK|FR|FR")
    assert str(r30.event_dt) == "2021-01-01"


def test_report_fact_with_explicit_dims_drops_fk_misses(spark):
    s = _fact_inputs(spark)
    d_drug = dims.dim_drug(s["drug"], spark.createDataFrame([], "nct_id string, intervention_type string, name string"))
    d_drug = d_drug.filter(F.col("drug_key") != "IBUPROFEN")  # a drug missing from the dimension
    d_cond = dims.dim_condition(s["indi"], spark.createDataFrame([], "nct_id string, name string", )).filter(
        F.col("condition_key") != "ACNE")  # a condition missing from the dimension
    given = {
        "drug": d_drug, "reaction": dims.dim_reaction(s["reac"]),
        "patient": dims.dim_patient(s["demo"]), "condition": d_cond,
    }
    fact = facts.report_fact(s["demo"], s["drug"], s["reac"], s["indi"], s["outc"], dims=given)
    rows = fact.collect()
    assert sk(spark, "IBUPROFEN") not in {r.drug_sk for r in rows}
    r20 = [r for r in rows if r.primaryid == 20]
    assert len(r20) == 1 and r20[0].condition_sk is None  # condition miss keeps the row


def test_any_serious_code_set_is_a_parameter(spark):
    s = _fact_inputs(spark)
    codes = dict(facts.OUTCOME_CODES)
    flags = facts.outcome_flags(s["outc"], codes, serious=["outc_hosp"])
    got = {r.primaryid: r.outc_any_serious for r in flags.collect()}
    assert got == {11: 1, 20: 0}


def test_trial_fact(spark):
    studies = silver.studies(spark.createDataFrame(
        [("N1", "done", "P2", "x", "1,000", "20200101", "2021-01-01", "2021-02"), ("N2", None, None, None, None, None, None, None)],
        "nct_id string, overall_status string, phase string, study_type string, enrollment string, start_date string, completion_date string, last_update_posted_date string"))
    inter = silver.interventions(spark.createDataFrame(
        [("N1", "Drug", "aspirin"), ("N1", "DRUG", "Ibuprofen"), ("N3", "Drug", "orphan")],
        "nct_id string, intervention_type string, name string"))
    cond = silver.conditions(spark.createDataFrame(
        [("N1", "pain"), ("N1", "fever"), ("N1", "flu"), ("N2", "asthma"), ("N3", "x")], "nct_id string, name string"))
    fact = facts.trial_fact(studies, inter, cond)
    rows = fact.collect()
    assert len(rows) == 6  # N1: 2 drugs x 3 conditions; N2 has no drug; N3 is not a registered study
    assert {r.study_sk for r in rows} == {sk(spark, "N1")}
    assert all(r.trial_mapping_count == 1 for r in rows)


def test_measures(spark):
    s = _fact_inputs(spark)
    fact = facts.report_fact(s["demo"], s["drug"], s["reac"], s["indi"], s["outc"])
    tot = measures.event_totals(fact).first()
    assert (tot.n_events, tot.n_reports, tot.n_serious_reports, tot.n_death_reports) == (6, 3, 1, 1)
    trend = {(r.year, r.quarter): r.n_reports for r in measures.trend_quarter(fact).collect()}
    assert trend == {(2020, "2020Q1"): 1, (1850, "1850Q1"): 1, (2021, "2021Q1"): 1}
    studies = spark.createDataFrame(
        [("N1", "P1", 10, None, None), ("N2", "P1", None, None, None), ("N3", "P2", 5, None, None)],
        "study_id string, phase string, enrollment int, completion_date date, last_update_posted_date date",
    ).withColumn("study_sk", surrogate_key("study_id"))
    by_phase = {(r.phase, r.is_total): (r.n_trials, r.total_enrollment, r.avg_enrollment) for r in measures.enrollment_by_phase(studies).collect()}
    assert by_phase == {("P1", 0): (2, 10, 10.0), ("P2", 0): (1, 5, 5.0), (None, 1): (3, 15, 7.5)}


def test_canon_is_shared_by_dims_and_facts(spark):
    s = _fact_inputs(spark)
    d = dims.dim_reaction(s["reac"]).select("reaction_sk")
    f = facts.report_fact(s["demo"], s["drug"], s["reac"], s["indi"], s["outc"]).select("reaction_sk")
    assert f.join(d, "reaction_sk", "left_anti").count() == 0
    assert spark.range(1).select(canon(F.lit("  head\tache "))).first()[0] == "HEAD ACHE"


@pytest.mark.parametrize("large", [0, 2, 2_000])
def test_studied_pairs_without_the_product(spark, large):
    """Small and large studies, duplicates, blanks and an unregistered study: the
    reported pairs found are those of the trial fact."""
    studies = spark.createDataFrame([("N1",), (" N2 ",), ("N3",)], "nct_id string")
    drugs = [("N1", "a"), ("N1", "A "), ("N1", "b"), ("N1", "c"), ("N2", "a"), ("N2", " "), ("N9", "d"), (None, "e")]
    conditions = [("N1", "x"), ("N1", "y"), ("N2", "z"), ("N2", None), ("N3", "x"), ("N9", "x")]
    interventions = spark.createDataFrame(drugs, "nct_id string, name string")
    conditions = spark.createDataFrame(conditions, "nct_id string, name string")
    trial = facts.trial_fact(studies, interventions, conditions).select("drug_sk", "condition_sk")
    names = [(d, c, 1) for d in "ABDE" for c in "XYZW"]
    reported = spark.createDataFrame(names, "d string, c string, n_reports long")
    reported = reported.select(surrogate_key("d").alias("drug_sk"), surrogate_key("c").alias("condition_sk"), "n_reports")
    studied = facts.studied_pairs(studies, interventions, conditions, reported, large)
    wanted = {tuple(r) for r in reported.select("drug_sk", "condition_sk").collect()}
    expected = {tuple(r) for r in trial.collect()} & wanted
    assert len(expected) == 5
    rows = [tuple(r) for r in studied.collect()]
    assert len(rows) == len(set(rows)) and set(rows) & wanted == expected
    left = measures.unstudied(reported, studied)
    assert {(r.drug_sk, r.condition_sk) for r in left.collect()} == wanted - expected


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}


def test_unresolved_keys_are_written_a_source_at_a_time(spark):
    """The shuffles of all sources are not on disk together: each source is
    written by itself, and its shuffle files are gone when the next begins."""
    profile = "sex string, age_cod string, reporter_country string, occr_country string"
    demo = spark.createDataFrame([("F", "YR", "us", "us"), (None, "YR", "us", "us"), ("M", "YR", "us", "us")], profile)
    named = {c: spark.createDataFrame([(x,) for x in names], f"{c} string") for c, names in (("drugname", "aab"), ("pt", "xyy"), ("indi_pt", "pqq"))}
    drugs = spark.createDataFrame([("N1", "A"), ("N2", "c"), ("N2", None)], "nct_id string, name string")
    conditions = spark.createDataFrame([("N1", "P"), ("N2", " ")], "nct_id string, name string")
    studies = spark.createDataFrame([("N1", "F"), ("N2", "O")], "nct_id string, overall_status string")
    s = {"faers_demo": demo, "faers_drug": named["drugname"], "faers_reac": named["pt"], "faers_indi": named["indi_pt"],
         "aact_interventions": drugs, "aact_conditions": conditions, "aact_studies": studies}
    held = {
        "drug": drugs.filter("name = 'A'").distinct().select(canon("name").alias("drug_key")),
        "condition": conditions.select(canon("name").alias("condition_key")).distinct(),
        "reaction": named["pt"].filter("pt = 'x'").select(canon("pt").alias("reaction_key")).distinct(),
        "patient": demo.filter("sex = 'F'").select(F.lit("F|YR|US|US").alias("patient_key")).distinct(),
        "study": studies.filter("overall_status = 'F'").select(F.col("nct_id").alias("study_id")).distinct(),
    }
    before = shuffle_files(spark)
    lacking = model.unresolved_keys(s, held)
    assert "Exchange" not in lacking._jdf.queryExecution().executedPlan().toString()  # written already
    until = time.time() + 30
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) is None
    assert sorted(map(tuple, lacking.collect())) == [
        ("report", "condition", "Q", 2), ("report", "drug", "B", 1), ("report", "patient", "M|YR|US|US", 1), ("report", "patient", "UNK|YR|US|US", 1),
        ("report", "reaction", "Y", 2), ("trial", "drug", "C", 1), ("trial", "study", "N2", 1),
    ]
    assert sorted(map(tuple, model.unresolved_keys(s, {"study": held["study"]}).collect())) == [("trial", "study", "N2", 1)]
    assert model.unresolved_keys(s, {}).collect() == []
