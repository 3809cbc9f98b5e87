"""End to end: raw delimited files -> bronze -> silver -> gold tables."""

import pytest
from pyspark.sql import functions as F

from vigilo.plans.pipeline import Pipeline
from vigilo.sinks.tables import TableStore

from conftest import write_text

AACT = {
    "studies.txt": "nct_id|overall_status|phase|study_type|enrollment|start_date|completion_date|last_update_posted_date\n"
    "N1|Completed|Phase 2|Interventional|1,200|2019-01-05|2020-06-30|2020-07\n"
    "N2|Recruiting|Phase 3|Interventional|80|20210101||2021\n",
    "interventions.txt": "nct_id|intervention_type|name\nN1|Drug|Aspirin\nN1|Device|Stent\nN2|DRUG|Metformin\n",
    "conditions.txt": "nct_id|name\nN1|Headache\nN1|Pain\nN2|Type 2 Diabetes\n",
}
FAERS_Q1 = {
    "DEMO24Q1.txt": "primaryid$caseid$caseversion$sex$age$age_cod$event_dt$occr_country$reporter_country\n"
    "101$1$1$F$45$YR$20240105$US$US\n102$1$2$F$45$YR$20240106$US$US\n201$2$1$$70$YR$2024$DE$\n",
    "DRUG24Q1.txt": "primaryid$caseid$drug_seq$role_cod$drugname$prod_ai$route\n"
    "102$1$1$PS$aspirin$ASA$ORAL\n102$1$2$C$vitamin c$$ORAL\n201$2$1$SS$Metformin$MET$ORAL\n",
    "REAC24Q1.txt": "primaryid$caseid$pt\n102$1$Nausea\n102$1$headache\n201$2$Rash\n",
    "OUTC24Q1.txt": "primaryid$caseid$outc_cod\n102$1$HO\n201$2$CA\n",
    "INDI24Q1.txt": "primaryid$caseid$indi_drug_seq$indi_pt\n102$1$1$pain\n201$2$1$Type 2  diabetes\n",
}


@pytest.fixture
def landing(tmp_path):
    for name, text in AACT.items():
        write_text(tmp_path / "aact" / name, text)
    for name, text in FAERS_Q1.items():
        write_text(tmp_path / "faers" / name, text)
    return tmp_path


def _store(spark, tag):
    dbs = {layer: f"t_{tag}_{layer}" for layer in ("bronze", "silver", "gold", "audit")}
    return TableStore(spark, databases=dbs)


def test_pipeline_end_to_end_and_idempotent(spark, landing):
    store = _store(spark, "e2e")
    p = Pipeline(spark, {"AACT": str(landing / "aact"), "FAERS": str(landing / "faers")}, store=store)
    first = p.run()
    assert first["bronze"]["faers_drug"] == 3 and first["bronze"]["aact_studies"] == 2
    fact = store.read("gold", "fact_faers_event")
    assert fact.count() == 2 + 1  # report 102: aspirin x 2 reactions; 201: metformin x rash
    assert set(fact.columns) >= {"run_id", "source_system", "created_ts", "updated_ts", "event_count"}
    trial = store.read("gold", "fact_trial_drug_condition")
    assert trial.count() == 2 + 1  # N1: aspirin x (headache, pain); N2: metformin x diabetes
    assert store.read("gold", "dim_date").count() == 9862

    gap_before = sorted(r.drug_sk for r in fact.select("drug_sk").collect())
    # the same landing directory again: incremental sources add nothing
    second = Pipeline(spark, p.raw_dirs, store=store).run()
    assert all(second["bronze"][t] == 0 for t in ("faers_demo", "faers_drug", "faers_reac", "faers_outc", "faers_indi"))
    # unchanged snapshot files are not read again either
    assert all(second["bronze"][t] == 0 for t in ("aact_studies", "aact_interventions", "aact_conditions"))
    assert store.read("bronze", "faers_drug").count() == 3
    assert sorted(r.drug_sk for r in store.read("gold", "fact_faers_event").select("drug_sk").collect()) == gap_before

    # one new quarter: only its rows are appended
    write_text(landing / "faers" / "DRUG24Q2.txt", "primaryid$caseid$drug_seq$role_cod$drugname$prod_ai$route\n201$2$2$I$Insulin$INS$SC\n")
    third = Pipeline(spark, p.raw_dirs, store=store).run()
    assert third["bronze"]["faers_drug"] == 1 and store.read("bronze", "faers_drug").count() == 4
    assert store.read("gold", "fact_faers_event").count() == 4

    # a snapshot file rewritten with another row is loaded again, whole
    write_text(landing / "aact" / "studies.txt", AACT["studies.txt"] + "N3|Completed|Phase 1|Interventional|10|2022|2023|2023\n")
    fourth = Pipeline(spark, p.raw_dirs, store=store).run()
    assert fourth["bronze"]["aact_studies"] == 3 and fourth["bronze"]["aact_conditions"] == 0
    assert store.read("gold", "dim_study").count() == 3

    log = spark.table(store.name("audit", "etl_run_log"))
    loads = log.filter((F.col("layer") == "BRONZE") & (F.col("entity") == "faers_drug") & (F.col("status") == "SUCCESS"))
    assert sorted((r.message, r.rows_read, r.rows_written) for r in loads.collect()) == [("DRUG24Q1.txt", 3, 3), ("DRUG24Q2.txt", 1, 1)]
    drugs = log.filter((F.col("layer") == "SILVER") & (F.col("entity") == "faers_drug")).collect()
    assert sorted((r.rows_read, r.rows_written) for r in drugs) == [(3, 2), (3, 2), (4, 3), (4, 3)]
    assert store.read("bronze", "faers_drug_rejects").count() == 0
    statuses = {r.status for r in log.collect()}
    assert statuses == {"SUCCESS", "SKIPPED"}
    assert log.filter((F.col("layer") == "GOLD") & (F.col("entity") == "fact_faers_event")).count() == 4


def test_pipeline_logs_failure(spark, landing):
    store = _store(spark, "fail")
    p = Pipeline(spark, {"AACT": str(landing / "missing"), "FAERS": str(landing / "faers")}, store=store)
    p.setup()
    with pytest.raises(Exception):
        p.bronze()
    failed = spark.table(store.name("audit", "etl_run_log")).filter(F.col("status") == "FAILED").collect()
    assert len(failed) == 1 and failed[0].entity == "aact_studies" and failed[0].message


def test_command_line_runs_the_layers(spark, landing):
    from vigilo.__main__ import main

    written = main(["--aact", str(landing / "aact"), "--faers", str(landing / "faers"), "--db-prefix", "cli",
                    "--layers", "bronze", "silver"])
    assert set(written) == {"bronze", "silver"} and written["silver"]["faers_drug"] == 2
