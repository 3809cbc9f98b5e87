"""The benchmark tables cast in the pipeline's source roles.

The driver's tables are TPC-H shaped; this module projects them onto the
eight raw source layouts (every column STRING, as a delimited extract would
arrive), so the real cleaners, dimensions, facts and measures run on data
whose volume grows with the scale factor:

* report = order (primaryid = o_orderkey), case = customer (caseid =
  o_custkey), case version = order date as yyyyMMdd text;
* suspect drug = part name per line item (role code = return flag), with the
  part brand as active ingredient and the part type as route;
* reaction = supplier nation per line item;
* indication / trial condition = part type and size;
* outcome code = line status followed by return flag;
* trial = order (nct id 'NCT' + zero-padded order key), listed twice with an
  older and a newer update month; trial drugs and conditions per line item
  (parts named 'blue ...' are never registered as a trial drug, so some
  reported drugs have no trial).

NULLs, blanks, mixed case, extra spaces, thousands separators and five date
layouts (one of them invalid) are introduced on purpose so the cleaning paths
run on every row class.  The DuckDB oracle holds the same projection in SQL.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vigilo.plans import dims

# Fixed values of this mapping: role codes kept, and outcome flag -> code.
ROLES = ("A", "R")
OUTCOME_CODES = {
    "outc_death": "FA",
    "outc_hosp": "FR",
    "outc_disability": "OA",
    "outc_life_threat": "OR",
    "outc_other_serious": "ON",
}

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents")


_READS: dict[tuple, DataFrame] = {}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The benchmark table (read-only files), resolved once per session."""
    key = (id(spark), spark.sparkContext.applicationId, sf_dir, name)
    if key not in _READS:
        _READS[key] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return _READS[key]


def _s(c: str) -> Column:
    return F.col(c).cast("string")


def _nct(c: str) -> Column:
    return F.concat(F.lit("NCT"), F.lpad(_s(c), 8, "0"))


def event_date_text(d: Column, priority: Column) -> Column:
    """The order date written in the layout chosen by the priority digit."""
    digit = F.substring(priority, 1, 1)
    return (
        F.when(digit == "1", F.date_format(d, "yyyy-MM-dd"))
        .when(digit == "2", F.date_format(d, "yyyyMMdd"))
        .when(digit == "3", F.date_format(d, "yyyyMM"))
        .when(digit == "4", F.date_format(d, "yyyy"))
        .otherwise(F.concat(F.date_format(d, "yyyy"), F.lit("-13-01")))
    )


def _hashed(side: DataFrame) -> DataFrame:
    """The smaller side of a join on its key: hashed a partition at a time, so
    that neither side, line items above all, is sorted."""
    return side.hint("shuffle_hash")


def _line_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = read(spark, sf_dir, "lineitem")
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return lineitem.join(_hashed(orders), lineitem.l_orderkey == orders.o_orderkey)


def bronze_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    c = read(spark, sf_dir, "customer")
    n = read(spark, sf_dir, "nation")
    rows = o.join(_hashed(c), o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    return rows.select(
        _s("o_orderkey").alias("primaryid"),
        _s("o_custkey").alias("caseid"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("caseversion"),
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("sex"),
        F.substring("o_orderpriority", 1, 1).alias("age"),
        F.lower(F.expr("substring(o_orderpriority, 3)")).alias("age_cod"),
        event_date_text(F.col("o_orderdate"), F.col("o_orderpriority")).alias("event_dt"),
        F.col("n_name").alias("occr_country"),
        F.concat(F.lit(" "), F.lower("c_mktsegment"), F.lit(" ")).alias("reporter_country"),
    )


def bronze_drug(spark: SparkSession, sf_dir: str) -> DataFrame:
    lo = _line_orders(spark, sf_dir)
    p = read(spark, sf_dir, "part")
    return lo.join(_hashed(p), lo.l_partkey == p.p_partkey).select(
        _s("l_orderkey").alias("primaryid"),
        _s("o_custkey").alias("caseid"),
        _s("l_linenumber").alias("drug_seq"),
        F.col("l_returnflag").alias("role_cod"),
        F.col("p_name").alias("drugname"),
        F.col("p_brand").alias("prod_ai"),
        F.lower("p_type").alias("route"),
    )


def bronze_reac(spark: SparkSession, sf_dir: str) -> DataFrame:
    lo = _line_orders(spark, sf_dir)
    s = read(spark, sf_dir, "supplier")
    n = read(spark, sf_dir, "nation")
    rows = lo.join(s, lo.l_suppkey == s.s_suppkey).join(n, s.s_nationkey == n.n_nationkey)
    return rows.select(
        _s("l_orderkey").alias("primaryid"),
        _s("o_custkey").alias("caseid"),
        F.when(F.col("l_linenumber") == 1, F.concat(F.lower("n_name"), F.lit("  "))).otherwise(F.col("n_name")).alias("pt"),
    )


def bronze_outc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _line_orders(spark, sf_dir).select(
        _s("l_orderkey").alias("primaryid"),
        _s("o_custkey").alias("caseid"),
        F.concat("l_linestatus", "l_returnflag").alias("outc_cod"),
    )


def bronze_indi(spark: SparkSession, sf_dir: str) -> DataFrame:
    lo = _line_orders(spark, sf_dir)
    p = read(spark, sf_dir, "part")
    return lo.join(_hashed(p), lo.l_partkey == p.p_partkey).select(
        _s("l_orderkey").alias("primaryid"),
        _s("o_custkey").alias("caseid"),
        _s("l_linenumber").alias("indi_drug_seq"),
        F.concat(F.lower("p_type"), F.lit(" "), _s("p_size")).alias("indi_pt"),
    )


def bronze_studies(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    ship = (
        read(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"))
    )
    rows = o.join(ship, o.o_orderkey == ship.l_orderkey, "left")
    study_type = F.when(F.col("o_orderstatus") == "F", F.lit("Interventional")).otherwise(F.lit("Observational"))

    # Both versions of a study come from its one joined row.
    older = F.col("older")

    def version(listed: Column, former: Column) -> Column:
        return F.when(older, former).otherwise(listed)

    ship_date = version(F.col("last_ship"), F.col("first_ship"))
    price = F.col("o_totalprice")
    return rows.withColumn("older", F.explode(F.array(F.lit(False), F.lit(True)))).select(
        _nct("o_orderkey").alias("nct_id"),
        version(F.col("o_orderstatus"), F.lower("o_orderstatus")).alias("overall_status"),
        F.col("o_orderpriority").alias("phase"),
        study_type.alias("study_type"),
        F.format_number(version(F.floor(price / 10), F.floor(price / 20)), 0).alias("enrollment"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("start_date"),
        F.date_format(ship_date, "yyyy-MM-dd").alias("completion_date"),
        F.date_format(ship_date, "yyyy-MM").alias("last_update_posted_date"),
    )


def bronze_interventions(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = read(spark, sf_dir, "lineitem")
    p = read(spark, sf_dir, "part")
    size = F.col("p_size")
    return lineitem.join(_hashed(p), lineitem.l_partkey == p.p_partkey).select(
        _nct("l_orderkey").alias("nct_id"),
        F.when(size < 10, F.lit("Device")).when(size < 30, F.lit("Drug")).otherwise(F.lit("DRUG")).alias("intervention_type"),
        F.when(size > 45, F.col("p_brand"))
        .when(F.col("p_name").startswith("blue"), F.lit(None).cast("string"))
        .otherwise(F.upper("p_name"))
        .alias("name"),
    )


def bronze_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = read(spark, sf_dir, "lineitem")
    p = read(spark, sf_dir, "part")
    return lineitem.join(_hashed(p), lineitem.l_partkey == p.p_partkey).select(
        _nct("l_orderkey").alias("nct_id"),
        F.when(F.col("p_size") > 40, F.concat("p_type", F.lit(" "), "p_brand"))
        .otherwise(F.concat(F.lit(" "), "p_type", F.lit("  "), _s("p_size")))
        .alias("name"),
    )


BRONZE = {
    "aact_studies": bronze_studies,
    "aact_interventions": bronze_interventions,
    "aact_conditions": bronze_conditions,
    "faers_demo": bronze_demo,
    "faers_drug": bronze_drug,
    "faers_reac": bronze_reac,
    "faers_outc": bronze_outc,
    "faers_indi": bronze_indi,
}


def bronze(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: build(spark, sf_dir) for name, build in BRONZE.items()}


def partial_dimensions(silver: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Dimensions that lack members, as built elsewhere would be: drugs and
    conditions known from trials alone, reactions up to 'M', profiles with a
    known sex, finished studies."""
    return {
        "drug": dims.dim_drug(silver["faers_drug"].filter(F.lit(False)), silver["aact_interventions"]),
        "condition": dims.dim_condition(silver["faers_indi"].filter(F.lit(False)), silver["aact_conditions"]),
        "reaction": dims.dim_reaction(silver["faers_reac"].filter(F.col("pt") < "M")),
        "patient": dims.dim_patient(silver["faers_demo"].filter(F.col("sex").isNotNull())),
        "study": dims.dim_study(silver["aact_studies"].filter(F.col("overall_status") == "F")),
    }
