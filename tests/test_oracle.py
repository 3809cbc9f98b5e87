"""Every registered query against its DuckDB statement on the smallest tables."""

import os
import sys

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

SF = "/root/testdata/sf0.001"


def base_queries():
    """The queries of this library itself; those of other subpackages have their own tests."""
    import __spark_entry__ as e

    other = set(e.llm_queries.queries()) | {"pipeline"} if e.llm_queries else set()
    return [k for k in e.queries() if k not in other]


def test_every_query_has_an_oracle():
    import __spark_entry__ as e

    assert set(base_queries()) <= set(e.oracle_sql()) <= set(e.queries())


def test_queries_match_duckdb(spark):
    from oracle_check import compare

    results = compare(spark, SF, base_queries())
    failing = {k: v for k, v in results.items() if v != "OK"}
    assert not failing, failing


def test_entry_smoke(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.columns[:4] == ["caseid", "primaryid", "drug_sk", "reaction_sk"]
    assert df.count() >= 0


def test_survey_query_keys_are_registered():
    import __spark_entry__ as e

    # the query keys proposed by the survey's oracle mapping
    survey = {
        "canon_key", "digits_to_int", "date_key_guard", "surrogate_key", "nonblank_filter", "role_filter",
        "default_unk_profile", "latest_version", "priority_union_dim", "distinct_on_key", "outcome_flags",
        "calendar_dim", "report_fact", "trial_mapping_fact", "missing_conditions", "gap_by_drug",
        "trial_duration", "profile_cube", "trend_quarter", "column_contract", "incremental_files",
    }
    assert survey <= set(e.queries())
