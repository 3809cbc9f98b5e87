"""The physical plans the operators are designed for."""

import datetime as dt
import re

from pyspark.sql import functions as F

from vigilo.operators import code_flags, first_by
from vigilo.operators.joins import SkewSpec
from vigilo.plans import dims, facts, roles, silver
from vigilo.sources.files import list_files

from conftest import write_text
from test_skew import _raw


def plan_of(df, capsys) -> str:
    capsys.readouterr()
    df.explain("formatted")
    return capsys.readouterr().out


def test_rank_filter_is_limited_before_the_shuffle(spark, capsys):
    df = spark.range(1000).select((F.col("id") % 10).alias("k"), F.col("id").alias("v"))
    plan = plan_of(first_by(df, ["k"], [("v", "desc")]), capsys)
    assert plan.count("WindowGroupLimit") >= 2  # partial (map side) and final


def test_flags_aggregate_partially(spark, capsys):
    df = spark.range(1000).select((F.col("id") % 10).alias("k"), F.lit("DE").alias("c"))
    plan = plan_of(code_flags(df, ["k"], "c", {"death": "DE"}), capsys)
    assert len(re.findall(r"HashAggregate", plan)) >= 2


def test_file_listing_reads_no_content(spark, capsys, tmp_path):
    write_text(tmp_path / "a.txt", "x\n1\n")
    plan = plan_of(list_files(spark, str(tmp_path)), capsys)
    schema = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert schema and all("content" not in line for line in schema)


def test_salted_fact_shuffles_each_input_once_on_report_and_salt(spark, capsys):
    s = _raw(spark, n_drugs=300, n_reacs=300)
    fact = facts.report_fact(*s[:3], s[3], s[4], skew=SkewSpec(pairs_per_cell=2_500))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for inputs too large to broadcast
    try:
        plan = plan_of(fact, capsys)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    salted = re.findall(r"hashpartitioning\(caseid#\d+L, primaryid#\d+L, _salt_i#\d+, _salt_j#\d+", plan)
    assert len(salted) == 3  # drugs, report grain, reactions


def final_plan(spark, df) -> str:
    """The plan that ran, with the joins of inputs too large to broadcast."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df.collect()
        return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_facts_without_hot_keys_look_no_splits_up(spark):
    s = _raw(spark, n_drugs=30, n_reacs=20)
    plan = final_plan(spark, facts.report_fact(*s))
    assert plan.count("LeftOuter") == 2  # indications and flags of the report grain


STUDIES = "nct_id string, overall_status string, phase string, study_type string, enrollment string, start_date string, completion_date string, last_update_posted_date string"


def test_studies_and_their_dimension_share_a_shuffle(spark):
    rows = [(f" N{i} ", s, None, None, "1", None, None, f"2024-0{m}") for i in range(4) for m, s in ((1, "f"), (2, "fo"[i % 2]))]
    studies = silver.studies(spark.createDataFrame(rows, STUDIES).repartition(3))
    empty = {n: spark.createDataFrame([], t) for n, t in (("drug", "drugname string"), ("reac", "pt string"), ("indi", "indi_pt string"), ("name", "name string"))}
    demo = spark.createDataFrame([], "sex string, age_cod string, reporter_country string, occr_country string")
    dim = dims.dim_study(studies.filter(F.col("overall_status") == "F"))
    lacking = facts.unresolved_keys(demo, empty["drug"], empty["reac"], empty["indi"], empty["name"], empty["name"], studies, {"study": dim})
    assert sorted(r["key"] for r in lacking.collect()) == ["N1", "N3"]
    assert "ReusedExchange" in final_plan(spark, lacking.select("*"))


def test_both_versions_of_a_study_come_from_one_join(spark, tmp_path, capsys):
    spark.createDataFrame([(1, 7, "F", 1250.5, dt.datetime(1995, 3, 4), "1-URGENT"), (2, 7, "O", 40.0, dt.datetime(1996, 1, 2), "5-LOW")],
                          "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(1, dt.datetime(1995, 4, 1)), (1, dt.datetime(1995, 6, 2))], "l_orderkey bigint, l_shipdate timestamp").write.parquet(f"{tmp_path}/lineitem.parquet")
    rows = roles.bronze_studies(spark, str(tmp_path))
    assert len(re.findall(r"Scan parquet", plan_of(rows, capsys).split("\n\n")[0])) == 2  # orders, line items
    assert sorted(map(tuple, rows.collect()), key=lambda r: (r[0], r[1])) == [
        ("NCT00000001", "F", "1-URGENT", "Interventional", "125", "19950304", "1995-06-02", "1995-06"),
        ("NCT00000001", "f", "1-URGENT", "Interventional", "62", "19950304", "1995-04-01", "1995-04"),
        ("NCT00000002", "O", "5-LOW", "Observational", "4", "19960102", None, None),
        ("NCT00000002", "o", "5-LOW", "Observational", "2", "19960102", None, None),
    ]


def test_building_the_facts_runs_no_job(spark):
    s = _raw(spark, n_drugs=300, n_reacs=300)
    spark.sparkContext.setJobGroup("only-built", "facts")
    try:
        facts.report_fact(*s)
        facts.report_summary(*s)
        facts.report_drugs(*s)
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("only-built")) == []
    finally:
        spark.sparkContext.setJobGroup("tests", "tests")
