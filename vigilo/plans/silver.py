"""Bronze -> silver: trim, type, filter, deduplicate.

Each cleaner takes the bronze frame (contract columns, all STRING) and returns
the typed silver frame.  Provenance columns are not carried.  Where every
selected column is part of the dedupe key the dedupe is a plain ``distinct``
(partial + final hash aggregate); the two keyed picks use a total order.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from vigilo.functions import canon, digits_to_int, nonblank, parse_date, to_bigint
from vigilo.functions.parse import date_precision
from vigilo.operators.dedupe import first_by, latest_by

# Suspect-drug role codes kept (primary suspect, secondary
# suspect, interacting); concomitant drugs are dropped.
SUSPECT_ROLES = ("PS", "SS", "I")
# The intervention type kept from the trial registry.
DRUG_INTERVENTION = "DRUG"


def _t(c: str):
    return F.trim(F.col(c))


def _ut(c: str):
    return F.upper(F.trim(F.col(c)))


def studies(bronze: DataFrame) -> DataFrame:
    """One row per nct_id: the most recently updated record."""
    df = bronze.select(
        _t("nct_id").alias("nct_id"),
        _ut("overall_status").alias("overall_status"),
        _ut("phase").alias("phase"),
        _ut("study_type").alias("study_type"),
        digits_to_int("enrollment").alias("enrollment"),
        parse_date("start_date").alias("start_date"),
        parse_date("completion_date").alias("completion_date"),
        parse_date("last_update_posted_date").alias("last_update_posted_date"),
    ).filter(nonblank("nct_id"))
    return first_by(df, ["nct_id"], [("last_update_posted_date", "desc")])


def interventions(bronze: DataFrame, kept_type: str = DRUG_INTERVENTION) -> DataFrame:
    return (
        bronze.select(
            _t("nct_id").alias("nct_id"),
            _ut("intervention_type").alias("intervention_type"),
            _t("name").alias("name"),
        )
        .filter(nonblank("nct_id") & nonblank("name") & (F.col("intervention_type") == F.lit(kept_type)))
        .distinct()
    )


def conditions(bronze: DataFrame) -> DataFrame:
    return (
        bronze.select(_t("nct_id").alias("nct_id"), _t("name").alias("name"))
        .filter(nonblank("nct_id") & nonblank("name"))
        .distinct()
        .withColumn("condition_key", canon("name"))
    )


def demo(bronze: DataFrame) -> DataFrame:
    """Latest version of each case: highest caseversion (numeric, NULL last),
    ties broken by the highest primaryid."""
    df = bronze.select(
        _t("primaryid").alias("primaryid"),
        _t("caseid").alias("caseid"),
        digits_to_int("caseversion").alias("caseversion"),
        _ut("sex").alias("sex"),
        digits_to_int("age").alias("age"),
        _ut("age_cod").alias("age_cod"),
        parse_date("event_dt").alias("event_dt"),
        date_precision("event_dt").alias("event_dt_precision"),
        _ut("occr_country").alias("occr_country"),
        _ut("reporter_country").alias("reporter_country"),
    ).filter(nonblank("caseid"))
    df = df.withColumn("_pid", to_bigint("primaryid"))
    return latest_by(df, ["caseid"], "caseversion", [("_pid", "desc"), ("primaryid", "desc")]).drop("_pid")


def drug(bronze: DataFrame, roles: Sequence[str] = SUSPECT_ROLES) -> DataFrame:
    return (
        bronze.select(
            _t("primaryid").alias("primaryid"),
            _t("caseid").alias("caseid"),
            _t("drug_seq").try_cast("int").alias("drug_seq"),
            _ut("role_cod").alias("role_cod"),
            _t("drugname").alias("drugname"),
            _t("prod_ai").alias("prod_ai"),
            _ut("route").alias("route"),
        )
        .filter(nonblank("primaryid") & F.col("role_cod").isin(*roles))
        .distinct()
    )


def reac(bronze: DataFrame) -> DataFrame:
    return (
        bronze.select(_t("primaryid").alias("primaryid"), _t("caseid").alias("caseid"), _t("pt").alias("pt"))
        .filter(nonblank("primaryid") & nonblank("pt"))
        .distinct()
        .withColumn("reaction_key", canon("pt"))
    )


def outc(bronze: DataFrame) -> DataFrame:
    return (
        bronze.select(_t("primaryid").alias("primaryid"), _t("caseid").alias("caseid"), _ut("outc_cod").alias("outc_cod"))
        .filter(nonblank("primaryid"))
        .distinct()
    )


def indi(bronze: DataFrame) -> DataFrame:
    return (
        bronze.select(
            _t("primaryid").alias("primaryid"),
            _t("caseid").alias("caseid"),
            digits_to_int("indi_drug_seq").alias("indi_drug_seq"),
            _t("indi_pt").alias("indi_pt"),
        )
        .filter(nonblank("primaryid") & nonblank("indi_pt"))
        .distinct()
        .withColumn("indication_key", canon("indi_pt"))
    )


CLEANERS = {
    "aact_studies": studies,
    "aact_interventions": interventions,
    "aact_conditions": conditions,
    "faers_demo": demo,
    "faers_drug": drug,
    "faers_reac": reac,
    "faers_outc": outc,
    "faers_indi": indi,
}
