"""The two facts.

``report_fact``: one row per (report, suspect drug, reaction) for the latest
version of each case, with the report's profile, event date, the smallest
resolved indication and its outcome flags.

Plan, in Spark terms:

1. report grain -- latest demographics ⋈ outcome flags ⋈ min indication,
   each one row per (caseid, primaryid); the flag and indication inputs are
   aggregated before the join (partial aggregation combines a hot report
   map-side), so the indication fan-out of a drug x reaction x indication
   join never happens;
2. drug and reaction rows, distinct per report;
3. drugs ⋈ report grain ⋈ reactions, all on the report key plus a salt
   (``SaltPlan``): ordinary reports take one cell, a report with more than
   ``pairs_per_cell`` drug x reaction pairs is spread over a grid of tasks.
   Both joins share the (report, salt) partitioning.

Measures that only sum events or count reports do not need the product:
``report_summary`` (a row per report) and ``report_drugs`` (a row per report
and drug) hold the same columns with the product's size in ``event_count``,
and ``trial_drugs`` is the trial fact without its conditions.
``report_conditions`` and ``studied_pairs`` tell which (drug, condition) pairs
are reported and which of them are studied, without either product.

Surrogate keys are computed from the natural keys (see ``functions.keys``);
a dimension built from the same silver tables holds every key, so the
"lookup, then drop unresolved" of a star load reduces to the latest-version
join.  ``dims`` switches to explicit lookups against given dimensions
(inner for drug, reaction and profile, left for condition), for facts loaded
against dimensions built elsewhere; ``unresolved_keys`` tells which keys such
dimensions lack and how many rows that costs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from vigilo.functions import canon, canon_nonblank, date_key, nonblank, surrogate_key, to_bigint
from vigilo.operators.dedupe import first_by
from vigilo.operators.flags import any_flag, code_flags
from vigilo.operators.joins import SaltPlan, SkewSpec
from vigilo.plans.dims import patient_key, profile_columns

REPORT_KEY = ["caseid", "primaryid"]
STUDY_KEY = ["study_id"]

# Outcome flag -> outcome code (death, hospitalisation,
# disability, life-threatening, other serious).  Other codes such as CA
# (congenital anomaly) and RI (required intervention) set no flag.
OUTCOME_CODES = {
    "outc_death": "DE",
    "outc_hosp": "HO",
    "outc_disability": "DS",
    "outc_life_threat": "LT",
    "outc_other_serious": "OT",
}
ANY_SERIOUS = "outc_any_serious"

FACT_BASE_COLUMNS = ["caseid", "primaryid", "drug_sk", "reaction_sk", "condition_sk", "patient_sk", "event_dt", "date_key"]


def _report_key_cols() -> list:
    return [to_bigint("caseid").alias("caseid"), to_bigint("primaryid").alias("primaryid")]


def _keyed(df: DataFrame) -> DataFrame:
    return df.filter(F.col("caseid").isNotNull() & F.col("primaryid").isNotNull())


def outcome_flags(
    silver_outc: DataFrame,
    codes: Mapping[str, str] = OUTCOME_CODES,
    serious: Sequence[str] | None = None,
) -> DataFrame:
    """Per report: one 0/1 flag per code plus ``outc_any_serious`` over
    ``serious`` (default: every flag)."""
    rows = _keyed(
        silver_outc.select(*_report_key_cols(), F.upper(F.trim("outc_cod")).alias("outc_cod")).filter(nonblank("outc_cod"))
    )
    flags = code_flags(rows, REPORT_KEY, "outc_cod", codes)
    return flags.withColumn(ANY_SERIOUS, any_flag(list(serious) if serious is not None else list(codes)))


def _lookup(df: DataFrame, dims: Mapping[str, DataFrame] | None, name: str, key: str, sk: str, how: str) -> DataFrame:
    if dims is None or name not in dims:
        return df.withColumn(sk, surrogate_key(key))
    # No broadcast hint: AQE broadcasts the dimension when its measured size
    # is under the threshold and keeps the shuffle join otherwise.
    return df.join(dims[name].select(key, sk), key, how)


def report_grain(
    silver_demo: DataFrame,
    silver_indi: DataFrame,
    silver_outc: DataFrame,
    codes: Mapping[str, str] = OUTCOME_CODES,
    serious: Sequence[str] | None = None,
    dims: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """One row per latest-version report: keys, patient_sk, event_dt,
    date_key, condition_sk (smallest resolved indication) and flags."""
    demo = _keyed(
        silver_demo.select(
            *_report_key_cols(),
            F.col("event_dt").cast("date").alias("event_dt"),
            *profile_columns(),
        ).withColumn("patient_key", patient_key())
    ).select(*REPORT_KEY, "event_dt", "patient_key")
    demo = first_by(demo, REPORT_KEY, [("event_dt", "desc")])
    demo = _lookup(demo, dims, "patient", "patient_key", "patient_sk", "inner")
    demo = demo.withColumn("date_key", date_key("event_dt")).drop("patient_key")

    indi = _keyed(
        silver_indi.filter(canon_nonblank("indi_pt")).select(*_report_key_cols(), canon("indi_pt").alias("condition_key"))
    )
    indi = _lookup(indi, dims, "condition", "condition_key", "condition_sk", "left")
    indi = indi.groupBy(*REPORT_KEY).agg(F.min("condition_sk").alias("condition_sk"))

    flags = outcome_flags(silver_outc, codes, serious)
    flag_cols = [*codes, ANY_SERIOUS]
    return (
        demo.join(indi, REPORT_KEY, "left")
        .join(flags, REPORT_KEY, "left")
        .withColumns({f: F.coalesce(F.col(f), F.lit(0)) for f in flag_cols})
    )


def _report_drugs(silver_drug: DataFrame, dims: Mapping[str, DataFrame] | None) -> DataFrame:
    drugs = _keyed(silver_drug.filter(canon_nonblank("drugname")).select(*_report_key_cols(), canon("drugname").alias("drug_key")))
    return _lookup(drugs.distinct(), dims, "drug", "drug_key", "drug_sk", "inner").select(*REPORT_KEY, "drug_sk")


def _reaction_rows(silver_reac: DataFrame) -> DataFrame:
    return _keyed(silver_reac.filter(canon_nonblank("pt")).select(*_report_key_cols(), canon("pt").alias("reaction_key")))


def _report_reactions(silver_reac: DataFrame, dims: Mapping[str, DataFrame] | None) -> DataFrame:
    return _lookup(_reaction_rows(silver_reac).distinct(), dims, "reaction", "reaction_key", "reaction_sk", "inner").select(*REPORT_KEY, "reaction_sk")


def _counted(rows: DataFrame, name: str) -> DataFrame:
    return rows.groupBy(*REPORT_KEY).agg(F.count(F.lit(1)).alias(name))


def report_summary(
    silver_demo: DataFrame,
    silver_drug: DataFrame,
    silver_reac: DataFrame,
    silver_indi: DataFrame,
    silver_outc: DataFrame,
    codes: Mapping[str, str] = OUTCOME_CODES,
    serious: Sequence[str] | None = None,
    dims: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """The event fact summed to one row per report, without its product: the
    events of a report are its drugs times its reactions."""
    drugs = _counted(_report_drugs(silver_drug, dims), "n_drugs")
    reactions = _counted(_report_reactions(silver_reac, dims), "n_reactions")
    report = report_grain(silver_demo, silver_indi, silver_outc, codes, serious, dims)
    both = report.join(drugs, REPORT_KEY).join(reactions, REPORT_KEY)
    return both.withColumn("event_count", F.col("n_drugs") * F.col("n_reactions")).drop("n_drugs", "n_reactions")


def report_drugs(
    silver_demo: DataFrame,
    silver_drug: DataFrame,
    silver_reac: DataFrame,
    silver_indi: DataFrame,
    silver_outc: DataFrame,
    codes: Mapping[str, str] = OUTCOME_CODES,
    serious: Sequence[str] | None = None,
    dims: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """The event fact summed to one row per report and drug: its events are
    the reactions of the report."""
    reactions = _counted(_report_reactions(silver_reac, dims), "event_count")
    report = report_grain(silver_demo, silver_indi, silver_outc, codes, serious, dims).join(reactions, REPORT_KEY)
    return _report_drugs(silver_drug, dims).join(report, REPORT_KEY)


def report_fact(
    silver_demo: DataFrame,
    silver_drug: DataFrame,
    silver_reac: DataFrame,
    silver_indi: DataFrame,
    silver_outc: DataFrame,
    codes: Mapping[str, str] = OUTCOME_CODES,
    serious: Sequence[str] | None = None,
    skew: SkewSpec = SkewSpec(),
    dims: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    report = report_grain(silver_demo, silver_indi, silver_outc, codes, serious, dims)

    drugs, reactions = _report_drugs(silver_drug, dims), _report_reactions(silver_reac, dims)
    salt = SaltPlan.detect(drugs, reactions, REPORT_KEY, skew)
    keys = salt.join_keys
    fact = salt.left(drugs).join(salt.both(report), keys).join(salt.right(reactions), keys)
    return salt.unsalt(fact).select(*FACT_BASE_COLUMNS, *codes, ANY_SERIOUS, F.lit(1).alias("event_count"))


def _trial_drug_rows(silver_interventions: DataFrame) -> DataFrame:
    rows = silver_interventions.filter(nonblank("nct_id") & canon_nonblank("name"))
    return rows.select(F.trim("nct_id").alias("study_id"), canon("name").alias("drug_key"))


def _trial_condition_rows(silver_conditions: DataFrame) -> DataFrame:
    rows = silver_conditions.filter(nonblank("nct_id") & canon_nonblank("name"))
    return rows.select(F.trim("nct_id").alias("study_id"), canon("name").alias("condition_key"))


def _study_rows(silver_studies: DataFrame) -> DataFrame:
    return silver_studies.filter(nonblank("nct_id")).select(F.trim("nct_id").alias("study_id"))


def _trial_inputs(
    silver_studies: DataFrame,
    silver_interventions: DataFrame,
    silver_conditions: DataFrame,
    dims: Mapping[str, DataFrame] | None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Drugs, conditions and surrogate key of the studies."""
    trial_drugs = _trial_drug_rows(silver_interventions).distinct()
    trial_drugs = _lookup(trial_drugs, dims, "drug", "drug_key", "drug_sk", "inner").select("study_id", "drug_sk")

    trial_conditions = _trial_condition_rows(silver_conditions).distinct()
    trial_conditions = _lookup(trial_conditions, dims, "condition", "condition_key", "condition_sk", "inner").select(
        "study_id", "condition_sk"
    )

    if dims is not None and "study" in dims:
        studies = dims["study"].select("study_id", "study_sk")
    else:
        studies = _study_rows(silver_studies).distinct().withColumn("study_sk", surrogate_key("study_id"))
    return trial_drugs, trial_conditions, studies


def trial_drugs(
    silver_studies: DataFrame,
    silver_interventions: DataFrame,
    silver_conditions: DataFrame,
    dims: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """(study, drug) of the trial fact: pairs of studies that have a condition."""
    drugs, conditions, studies = _trial_inputs(silver_studies, silver_interventions, silver_conditions, dims)
    return drugs.join(studies, STUDY_KEY).join(conditions.select(*STUDY_KEY).distinct(), STUDY_KEY, "left_semi").select("study_sk", "drug_sk")


def trial_fact(
    silver_studies: DataFrame,
    silver_interventions: DataFrame,
    silver_conditions: DataFrame,
    skew: SkewSpec = SkewSpec(),
    dims: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """One row per (study, drug, condition) of registered trials."""
    trial_drugs_, conditions, studies = _trial_inputs(silver_studies, silver_interventions, silver_conditions, dims)
    salt = SaltPlan.detect(trial_drugs_, conditions, STUDY_KEY, skew)
    keys = salt.join_keys
    fact = salt.left(trial_drugs_).join(salt.both(studies), keys).join(salt.right(conditions), keys)
    return salt.unsalt(fact).select("study_sk", "drug_sk", "condition_sk", F.lit(1).alias("trial_mapping_count"))


def report_conditions(silver_demo: DataFrame, silver_drug: DataFrame, silver_reac: DataFrame, silver_indi: DataFrame) -> DataFrame:
    """(report, drug, condition) of the event fact: one row per report with an
    indication, and drug.  Flags and profiles are not read."""
    indi = _keyed(
        silver_indi.filter(canon_nonblank("indi_pt")).select(*_report_key_cols(), canon("indi_pt").alias("condition_key"))
    )
    report = indi.groupBy(*REPORT_KEY).agg(F.min(surrogate_key("condition_key")).alias("condition_sk"))
    for rows in (silver_demo.select(*_report_key_cols()), _reaction_rows(silver_reac).select(*REPORT_KEY)):
        report = report.join(rows, REPORT_KEY, "left_semi")
    return _report_drugs(silver_drug, None).join(report, REPORT_KEY)


def studied_pairs(
    silver_studies: DataFrame,
    silver_interventions: DataFrame,
    silver_conditions: DataFrame,
    reported: DataFrame,
    large: int = 2_000,
) -> DataFrame:
    """The (drug, condition) pairs of the trial fact that ``reported`` can meet.

    A study with at most ``large`` drug rows and ``large`` condition rows gives
    its pairs, at most ``large`` squared, combined map-side.  A larger study is
    never multiplied out: a reported pair is in it if the study has the drug
    and has the condition, so the pairs are joined to its drugs and then
    semi-joined to its conditions.  Both ways are exact.
    """
    # Distinct rows are shuffled once; the counts and both ways read that
    # shuffle.  A key of a nonblank name is never null: said here, it is the
    # same filter in every branch, and none of them infers one of its own.
    drugs, conditions, studies = _trial_inputs(silver_studies, silver_interventions, silver_conditions, None)
    drugs, conditions = drugs.filter(F.col("drug_sk").isNotNull()), conditions.filter(F.col("condition_sk").isNotNull())
    drugs = drugs.join(studies.select(*STUDY_KEY), STUDY_KEY)
    many = [side.groupBy(*STUDY_KEY).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > large) for side in (drugs, conditions)]
    big = many[0].unionByName(many[1]).groupBy(*STUDY_KEY).agg(F.max("n").alias("big"))

    pair = ["drug_sk", "condition_sk"]
    drugs = drugs.join(big, STUDY_KEY, "left")
    small = drugs.filter(F.col("big").isNull()).join(conditions, STUDY_KEY).select(*pair)
    wanted = drugs.filter(F.col("big").isNotNull()).join(reported.select(*pair), "drug_sk")
    inside = wanted.join(conditions, [*STUDY_KEY, "condition_sk"], "left_semi").select(*pair)
    return small.unionByName(inside).distinct()


def unresolved_by_source(
    silver_demo: DataFrame,
    silver_drug: DataFrame,
    silver_reac: DataFrame,
    silver_indi: DataFrame,
    silver_interventions: DataFrame,
    silver_conditions: DataFrame,
    silver_studies: DataFrame,
    dims: Mapping[str, DataFrame],
) -> list[DataFrame]:
    """``unresolved_keys``, a frame for each fact and dimension."""
    # Blank names are dropped before their keys are built, by the filters that
    # the cleaners and the dimensions use: both sides can share one shuffle.
    demo = silver_demo.select(*profile_columns()).select(patient_key().alias("key")).filter(nonblank("key"))

    def named(rows: DataFrame, name: str) -> DataFrame:
        return rows.filter(canon_nonblank(name)).select(canon(name).alias("key"))

    sources = [
        ("report", "patient", "patient_key", demo),
        ("report", "drug", "drug_key", named(silver_drug, "drugname")),
        ("report", "reaction", "reaction_key", named(silver_reac, "pt")),
        ("report", "condition", "condition_key", named(silver_indi, "indi_pt")),
        ("trial", "drug", "drug_key", named(silver_interventions, "name")),
        ("trial", "condition", "condition_key", named(silver_conditions, "name")),
        # != '' is what the anti join infers for the dimension: said here too, so both read one shuffle
        ("trial", "study", "study_id", _study_rows(silver_studies.filter(F.col("nct_id") != "")).withColumnRenamed("study_id", "key")),
    ]
    found = []
    for fact, name, key, rows in sources:
        if name in dims:
            counted = rows.groupBy("key").agg(F.count(F.lit(1)).alias("rows"))
            lacking = counted.join(dims[name].select(F.col(key).alias("key")), "key", "left_anti")
            found.append(lacking.select(F.lit(fact).alias("fact"), F.lit(name).alias("dimension"), "key", "rows"))
    return found


def unresolved_keys(
    silver_demo: DataFrame,
    silver_drug: DataFrame,
    silver_reac: DataFrame,
    silver_indi: DataFrame,
    silver_interventions: DataFrame,
    silver_conditions: DataFrame,
    silver_studies: DataFrame,
    dims: Mapping[str, DataFrame],
) -> DataFrame:
    """(fact, dimension, key, rows) of the natural keys without a member in
    ``dims``: rows of the fact's input that a lookup drops (for a report's
    condition: leaves without a condition_sk).  Keys are counted before they
    are looked up, so a key with a third of all rows is combined map-side."""
    found = unresolved_by_source(
        silver_demo, silver_drug, silver_reac, silver_indi, silver_interventions, silver_conditions, silver_studies, dims
    )
    return union_unresolved(silver_demo.sparkSession, found)


def union_unresolved(spark: SparkSession, found: Sequence[DataFrame]) -> DataFrame:
    if not found:
        return spark.createDataFrame([], "fact string, dimension string, key string, rows bigint")
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out
