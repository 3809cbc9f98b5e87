"""Silver and gold frames from bronze frames (lazy, no writes)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from vigilo.operators.joins import SkewSpec
from vigilo.plans import dims, facts, silver
from vigilo.session import REMOVE_SHUFFLES, settings, stored


def silver_table(name: str, bronze: DataFrame, roles: Sequence[str] = silver.SUSPECT_ROLES) -> DataFrame:
    clean = silver.CLEANERS[name]
    return clean(bronze, roles) if name == "faers_drug" else clean(bronze)


def silver_tables(bronze: Mapping[str, DataFrame], roles: Sequence[str] = silver.SUSPECT_ROLES) -> dict[str, DataFrame]:
    return {name: silver_table(name, bronze[name], roles) for name in silver.CLEANERS}


DIMENSIONS = {
    "dim_drug": lambda spark, s: dims.dim_drug(s["faers_drug"], s["aact_interventions"]),
    "dim_reaction": lambda spark, s: dims.dim_reaction(s["faers_reac"]),
    "dim_condition": lambda spark, s: dims.dim_condition(s["faers_indi"], s["aact_conditions"]),
    "dim_patient": lambda spark, s: dims.dim_patient(s["faers_demo"]),
    "dim_study": lambda spark, s: dims.dim_study(s["aact_studies"]),
    "dim_date": lambda spark, s: dims.dim_date(spark),
}


def dimension(spark: SparkSession, s: Mapping[str, DataFrame], name: str) -> DataFrame:
    return DIMENSIONS[name](spark, s)


def dimension_tables(spark: SparkSession, s: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: build(spark, s) for name, build in DIMENSIONS.items()}


def report_fact(
    s: Mapping[str, DataFrame],
    codes: Mapping[str, str] = facts.OUTCOME_CODES,
    skew: SkewSpec = SkewSpec(),
    dims: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    return facts.report_fact(
        s["faers_demo"], s["faers_drug"], s["faers_reac"], s["faers_indi"], s["faers_outc"], codes=codes, skew=skew, dims=dims
    )


def trial_fact(s: Mapping[str, DataFrame], skew: SkewSpec = SkewSpec(), dims: Mapping[str, DataFrame] | None = None) -> DataFrame:
    return facts.trial_fact(s["aact_studies"], s["aact_interventions"], s["aact_conditions"], skew=skew, dims=dims)


def unresolved_keys(s: Mapping[str, DataFrame], dims: Mapping[str, DataFrame]) -> DataFrame:
    """``facts.unresolved_keys``, written a fact and dimension at a time: the
    shuffles of one are gone before those of the next, so the disk holds one
    silver table's at once, not all seven.  The keys of dimensions that two
    facts look up are written first."""
    spark = s["faers_demo"].sparkSession
    with settings(spark, REMOVE_SHUFFLES):
        twice = {n: stored(dims[n].select(f"{n}_key"), f"{n}-keys") for n in ("drug", "condition") if n in dims}
        found = facts.unresolved_by_source(
            s["faers_demo"], s["faers_drug"], s["faers_reac"], s["faers_indi"], s["aact_interventions"], s["aact_conditions"], s["aact_studies"], {**dims, **twice}
        )
        return facts.union_unresolved(spark, [stored(f, "unresolved") for f in found])


def report_summary(s: Mapping[str, DataFrame], codes: Mapping[str, str] = facts.OUTCOME_CODES) -> DataFrame:
    return facts.report_summary(s["faers_demo"], s["faers_drug"], s["faers_reac"], s["faers_indi"], s["faers_outc"], codes=codes)


def report_drugs(s: Mapping[str, DataFrame], codes: Mapping[str, str] = facts.OUTCOME_CODES) -> DataFrame:
    return facts.report_drugs(s["faers_demo"], s["faers_drug"], s["faers_reac"], s["faers_indi"], s["faers_outc"], codes=codes)


def trial_drugs(s: Mapping[str, DataFrame]) -> DataFrame:
    return facts.trial_drugs(s["aact_studies"], s["aact_interventions"], s["aact_conditions"])


def report_conditions(s: Mapping[str, DataFrame]) -> DataFrame:
    return facts.report_conditions(s["faers_demo"], s["faers_drug"], s["faers_reac"], s["faers_indi"])


def studied_pairs(s: Mapping[str, DataFrame], reported: DataFrame) -> DataFrame:
    return facts.studied_pairs(s["aact_studies"], s["aact_interventions"], s["aact_conditions"], reported)
