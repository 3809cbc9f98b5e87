"""Independent ANSI-SQL (DuckDB) statements for every registered query.

Written from the semantics, not generated from the Spark plans: the role
projection of the benchmark tables, the silver cleaners, the dimensions,
facts and measures are restated as CTEs over the pre-registered views.
"""

from __future__ import annotations

# ---------------------------------------------------------------- scalars

# Java's \s class: space, tab, newline, vertical tab, form feed, return.
WS = r"[ \t\n\x0B\f\r]+"


def canon(x: str) -> str:
    # Spark upper-cases 'ß' to 'SS' (full case mapping); DuckDB would give 'ẞ'.
    return f"upper(replace(trim(regexp_replace({x}, '{WS}', ' ', 'g')), 'ß', 'SS'))"


def nonblank(x: str) -> str:
    return f"({x} IS NOT NULL AND trim({x}) <> '')"


def digits(x: str) -> str:
    return f"TRY_CAST(regexp_replace(CAST({x} AS VARCHAR), '[^0-9\\-]', '', 'g') AS INTEGER)"


def bigint(x: str) -> str:
    return f"TRY_CAST(trim(CAST({x} AS VARCHAR)) AS BIGINT)"


def sk(x: str) -> str:
    return f"CAST(('0x' || substr(md5(CAST({x} AS VARCHAR)), 1, 15)) AS BIGINT)"


_LAYOUTS = [
    ("[0-9]{4}-[0-9]{2}-[0-9]{2}", "{s}", "%Y-%m-%d", "day"),
    ("[0-9]{8}", "{s}", "%Y%m%d", "day"),
    ("[0-9]{4}-[0-9]{2}", "{s} || '-01'", "%Y-%m-%d", "month"),
    ("[0-9]{6}", "{s} || '01'", "%Y%m%d", "month"),
    ("[0-9]{4}", "{s} || '0101'", "%Y%m%d", "year"),
]


def parse_date(x: str) -> str:
    s = f"trim(CAST({x} AS VARCHAR))"
    arms = " ".join(
        f"WHEN regexp_full_match({s}, '{shape}') THEN CAST(try_strptime({text.format(s=s)}, '{fmt}') AS DATE)"
        for shape, text, fmt, _ in _LAYOUTS
    )
    return f"(CASE {arms} END)"


def date_precision(x: str) -> str:
    s = f"trim(CAST({x} AS VARCHAR))"
    arms = " ".join(
        f"WHEN regexp_full_match({s}, '{shape}') AND try_strptime({text.format(s=s)}, '{fmt}') IS NOT NULL THEN '{p}'"
        for shape, text, fmt, p in _LAYOUTS
    )
    return f"(CASE {arms} END)"


def date_key_raw(d: str) -> str:
    return f"CAST(year({d}) * 10000 + month({d}) * 100 + day({d}) AS INTEGER)"


def date_key(d: str) -> str:
    k = date_key_raw(d)
    return f"(CASE WHEN {k} BETWEEN 19000101 AND 20991231 THEN {k} END)"


def unk(x: str) -> str:
    return f"coalesce(nullif(trim({x}), ''), 'UNK')"


def ratio(num: str, den: str) -> str:
    return f"round(CAST({num} AS DOUBLE) / nullif({den}, 0), 4)"


# ------------------------------------------------------- role projection

ROLES = ("A", "R")
OUTCOME_CODES = {
    "outc_death": "FA",
    "outc_hosp": "FR",
    "outc_disability": "OA",
    "outc_life_threat": "OR",
    "outc_other_serious": "ON",
}


def _event_text(d: str, prio: str) -> str:
    return (
        f"(CASE substring({prio}, 1, 1) WHEN '1' THEN strftime({d}, '%Y-%m-%d') "
        f"WHEN '2' THEN strftime({d}, '%Y%m%d') WHEN '3' THEN strftime({d}, '%Y%m') "
        f"WHEN '4' THEN strftime({d}, '%Y') ELSE strftime({d}, '%Y') || '-13-01' END)"
    )


BRONZE = f"""
line_orders AS (
  SELECT l.*, o.o_custkey FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
bronze_demo AS (
  SELECT CAST(o.o_orderkey AS VARCHAR) AS primaryid, CAST(o.o_custkey AS VARCHAR) AS caseid,
         strftime(o.o_orderdate, '%Y%m%d') AS caseversion, nullif(o.o_orderstatus, 'P') AS sex,
         substring(o.o_orderpriority, 1, 1) AS age, lower(substring(o.o_orderpriority, 3)) AS age_cod,
         {_event_text('o.o_orderdate', 'o.o_orderpriority')} AS event_dt,
         n.n_name AS occr_country, ' ' || lower(c.c_mktsegment) || ' ' AS reporter_country
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
),
bronze_drug AS (
  SELECT CAST(lo.l_orderkey AS VARCHAR) AS primaryid, CAST(lo.o_custkey AS VARCHAR) AS caseid,
         CAST(lo.l_linenumber AS VARCHAR) AS drug_seq, lo.l_returnflag AS role_cod, p.p_name AS drugname,
         p.p_brand AS prod_ai, lower(p.p_type) AS route
  FROM line_orders lo JOIN part p ON lo.l_partkey = p.p_partkey
),
bronze_reac AS (
  SELECT CAST(lo.l_orderkey AS VARCHAR) AS primaryid, CAST(lo.o_custkey AS VARCHAR) AS caseid,
         CASE WHEN lo.l_linenumber = 1 THEN lower(n.n_name) || '  ' ELSE n.n_name END AS pt
  FROM line_orders lo JOIN supplier s ON lo.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey
),
bronze_outc AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS primaryid, CAST(o_custkey AS VARCHAR) AS caseid,
         l_linestatus || l_returnflag AS outc_cod
  FROM line_orders
),
bronze_indi AS (
  SELECT CAST(lo.l_orderkey AS VARCHAR) AS primaryid, CAST(lo.o_custkey AS VARCHAR) AS caseid,
         CAST(lo.l_linenumber AS VARCHAR) AS indi_drug_seq, lower(p.p_type) || ' ' || CAST(p.p_size AS VARCHAR) AS indi_pt
  FROM line_orders lo JOIN part p ON lo.l_partkey = p.p_partkey
),
ship AS (
  SELECT l_orderkey, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship FROM lineitem GROUP BY l_orderkey
),
bronze_studies AS (
  SELECT 'NCT' || lpad(CAST(o.o_orderkey AS VARCHAR), 8, '0') AS nct_id, o.o_orderstatus AS overall_status,
         o.o_orderpriority AS phase,
         CASE WHEN o.o_orderstatus = 'F' THEN 'Interventional' ELSE 'Observational' END AS study_type,
         format('{{:,}}', CAST(floor(o.o_totalprice / 10) AS BIGINT)) AS enrollment,
         strftime(o.o_orderdate, '%Y%m%d') AS start_date,
         strftime(s.last_ship, '%Y-%m-%d') AS completion_date, strftime(s.last_ship, '%Y-%m') AS last_update_posted_date
  FROM orders o LEFT JOIN ship s ON o.o_orderkey = s.l_orderkey
  UNION ALL
  SELECT 'NCT' || lpad(CAST(o.o_orderkey AS VARCHAR), 8, '0'), lower(o.o_orderstatus), o.o_orderpriority,
         CASE WHEN o.o_orderstatus = 'F' THEN 'Interventional' ELSE 'Observational' END,
         format('{{:,}}', CAST(floor(o.o_totalprice / 20) AS BIGINT)),
         strftime(o.o_orderdate, '%Y%m%d'),
         strftime(s.first_ship, '%Y-%m-%d'), strftime(s.first_ship, '%Y-%m')
  FROM orders o LEFT JOIN ship s ON o.o_orderkey = s.l_orderkey
),
bronze_interventions AS (
  SELECT 'NCT' || lpad(CAST(l.l_orderkey AS VARCHAR), 8, '0') AS nct_id,
         CASE WHEN p.p_size < 10 THEN 'Device' WHEN p.p_size < 30 THEN 'Drug' ELSE 'DRUG' END AS intervention_type,
         CASE WHEN p.p_size > 45 THEN p.p_brand WHEN starts_with(p.p_name, 'blue') THEN NULL ELSE upper(p.p_name) END AS name
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
),
bronze_conditions AS (
  SELECT 'NCT' || lpad(CAST(l.l_orderkey AS VARCHAR), 8, '0') AS nct_id,
         CASE WHEN p.p_size > 40 THEN p.p_type || ' ' || p.p_brand ELSE ' ' || p.p_type || '  ' || CAST(p.p_size AS VARCHAR) END AS name
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
)"""

# ------------------------------------------------------------------ silver

_ROLE_LIST = ", ".join(f"'{r}'" for r in ROLES)

SILVER = f"""
studies_typed AS (
  SELECT trim(nct_id) AS nct_id, upper(trim(overall_status)) AS overall_status, upper(trim(phase)) AS phase,
         upper(trim(study_type)) AS study_type, {digits('enrollment')} AS enrollment,
         {parse_date('start_date')} AS start_date, {parse_date('completion_date')} AS completion_date,
         {parse_date('last_update_posted_date')} AS last_update_posted_date
  FROM bronze_studies
),
silver_studies AS (
  SELECT nct_id, overall_status, phase, study_type, enrollment, start_date, completion_date, last_update_posted_date
  FROM (SELECT *, row_number() OVER (PARTITION BY nct_id ORDER BY last_update_posted_date DESC NULLS LAST,
          overall_status ASC NULLS LAST, phase ASC NULLS LAST, study_type ASC NULLS LAST, enrollment ASC NULLS LAST,
          start_date ASC NULLS LAST, completion_date ASC NULLS LAST) AS rn
        FROM studies_typed WHERE {nonblank('nct_id')})
  WHERE rn = 1
),
silver_interventions AS (
  SELECT DISTINCT * FROM (
    SELECT trim(nct_id) AS nct_id, upper(trim(intervention_type)) AS intervention_type, trim(name) AS name
    FROM bronze_interventions)
  WHERE {nonblank('nct_id')} AND {nonblank('name')} AND intervention_type = 'DRUG'
),
silver_conditions AS (
  SELECT DISTINCT nct_id, name, {canon('name')} AS condition_key FROM (
    SELECT trim(nct_id) AS nct_id, trim(name) AS name FROM bronze_conditions)
  WHERE {nonblank('nct_id')} AND {nonblank('name')}
),
demo_typed AS (
  SELECT trim(primaryid) AS primaryid, trim(caseid) AS caseid, {digits('caseversion')} AS caseversion,
         upper(trim(sex)) AS sex, {digits('age')} AS age, upper(trim(age_cod)) AS age_cod,
         {parse_date('event_dt')} AS event_dt, {date_precision('event_dt')} AS event_dt_precision,
         upper(trim(occr_country)) AS occr_country, upper(trim(reporter_country)) AS reporter_country
  FROM bronze_demo
),
silver_demo AS (
  SELECT primaryid, caseid, caseversion, sex, age, age_cod, event_dt, event_dt_precision, occr_country, reporter_country
  FROM (SELECT *, row_number() OVER (PARTITION BY caseid ORDER BY caseversion DESC NULLS LAST,
          {bigint('primaryid')} DESC NULLS LAST, primaryid DESC NULLS LAST, sex ASC NULLS LAST, age ASC NULLS LAST,
          age_cod ASC NULLS LAST, event_dt ASC NULLS LAST, event_dt_precision ASC NULLS LAST,
          occr_country ASC NULLS LAST, reporter_country ASC NULLS LAST) AS rn
        FROM demo_typed WHERE {nonblank('caseid')})
  WHERE rn = 1
),
silver_drug AS (
  SELECT DISTINCT * FROM (
    SELECT trim(primaryid) AS primaryid, trim(caseid) AS caseid, TRY_CAST(trim(drug_seq) AS INTEGER) AS drug_seq,
           upper(trim(role_cod)) AS role_cod, trim(drugname) AS drugname, trim(prod_ai) AS prod_ai,
           upper(trim(route)) AS route
    FROM bronze_drug)
  WHERE {nonblank('primaryid')} AND role_cod IN ({_ROLE_LIST})
),
silver_reac AS (
  SELECT DISTINCT primaryid, caseid, pt, {canon('pt')} AS reaction_key FROM (
    SELECT trim(primaryid) AS primaryid, trim(caseid) AS caseid, trim(pt) AS pt FROM bronze_reac)
  WHERE {nonblank('primaryid')} AND {nonblank('pt')}
),
silver_outc AS (
  SELECT DISTINCT * FROM (
    SELECT trim(primaryid) AS primaryid, trim(caseid) AS caseid, upper(trim(outc_cod)) AS outc_cod FROM bronze_outc)
  WHERE {nonblank('primaryid')}
),
silver_indi AS (
  SELECT DISTINCT primaryid, caseid, indi_drug_seq, indi_pt, {canon('indi_pt')} AS indication_key FROM (
    SELECT trim(primaryid) AS primaryid, trim(caseid) AS caseid, {digits('indi_drug_seq')} AS indi_drug_seq,
           trim(indi_pt) AS indi_pt FROM bronze_indi)
  WHERE {nonblank('primaryid')} AND {nonblank('indi_pt')}
)"""

# -------------------------------------------------------------------- gold

_FLAGS = ",\n         ".join(f"max(CASE WHEN outc_cod = '{code}' THEN 1 ELSE 0 END) AS {name}" for name, code in OUTCOME_CODES.items())
_ANY = "CAST(greatest(" + ", ".join(f"coalesce({n}, 0)" for n in OUTCOME_CODES) + ", 0) AS INTEGER)"
_FLAG_FILL = ", ".join(f"coalesce(f.{n}, 0) AS {n}" for n in OUTCOME_CODES)

GOLD = f"""
drug_candidates AS (
  SELECT DISTINCT * FROM (
    SELECT {canon('drugname')} AS drug_key, drugname AS drug_name, prod_ai AS active_ingredient, route,
           1 AS source_priority, 'FAERS' AS source
    FROM silver_drug WHERE {nonblank('drugname')}
    UNION ALL
    SELECT {canon('name')}, name, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), 2, 'AACT'
    FROM silver_interventions WHERE {nonblank('name')})
  WHERE {nonblank('drug_key')}
),
dim_drug AS (
  SELECT {sk('drug_key')} AS drug_sk, drug_key, drug_name, active_ingredient, route, source
  FROM (SELECT *, row_number() OVER (PARTITION BY drug_key ORDER BY source_priority ASC NULLS LAST,
          drug_name ASC NULLS LAST, active_ingredient ASC NULLS LAST, route ASC NULLS LAST, source ASC NULLS LAST) AS rn
        FROM drug_candidates)
  WHERE rn = 1
),
dim_reaction AS (
  SELECT {sk('reaction_key')} AS reaction_sk, reaction_key, reaction_name FROM (
    SELECT {canon('pt')} AS reaction_key, min(pt) AS reaction_name FROM silver_reac WHERE {nonblank('pt')} GROUP BY 1)
),
condition_candidates AS (
  SELECT DISTINCT * FROM (
    SELECT {canon('indi_pt')} AS condition_key, indi_pt AS condition_name, 1 AS source_priority, 'FAERS' AS source
    FROM silver_indi WHERE {nonblank('indi_pt')}
    UNION ALL
    SELECT {canon('name')}, name, 2, 'AACT' FROM silver_conditions WHERE {nonblank('name')})
  WHERE {nonblank('condition_key')}
),
dim_condition AS (
  SELECT {sk('condition_key')} AS condition_sk, condition_key, condition_name, source
  FROM (SELECT *, row_number() OVER (PARTITION BY condition_key ORDER BY source_priority ASC NULLS LAST,
          condition_name ASC NULLS LAST, source ASC NULLS LAST) AS rn
        FROM condition_candidates)
  WHERE rn = 1
),
profiles AS (
  SELECT DISTINCT {unk('sex')} AS sex, {unk('age_cod')} AS age_cod, {unk('reporter_country')} AS reporter_country,
         {unk('occr_country')} AS occr_country
  FROM silver_demo
),
dim_patient AS (
  SELECT {sk('patient_key')} AS patient_sk, patient_key, sex, age_cod, reporter_country, occr_country
  FROM (SELECT *, row_number() OVER (PARTITION BY patient_key ORDER BY sex ASC NULLS LAST, age_cod ASC NULLS LAST,
          reporter_country ASC NULLS LAST, occr_country ASC NULLS LAST) AS rn
        FROM (SELECT *, {canon("concat_ws('|', sex, age_cod, reporter_country, occr_country)")} AS patient_key FROM profiles))
  WHERE rn = 1
),
dim_study AS (
  SELECT {sk('nct_id')} AS study_sk, nct_id AS study_id, overall_status, phase, study_type, enrollment,
         completion_date, last_update_posted_date
  FROM silver_studies WHERE {nonblank('nct_id')}
),
demo_keyed AS (
  SELECT {bigint('caseid')} AS caseid, {bigint('primaryid')} AS primaryid, CAST(event_dt AS DATE) AS event_dt,
         {canon(f"concat_ws('|', {unk('sex')}, {unk('age_cod')}, {unk('reporter_country')}, {unk('occr_country')})")} AS patient_key
  FROM silver_demo
),
demo_report AS (
  SELECT caseid, primaryid, event_dt, {sk('patient_key')} AS patient_sk, {date_key('event_dt')} AS date_key
  FROM (SELECT *, row_number() OVER (PARTITION BY caseid, primaryid ORDER BY event_dt DESC NULLS LAST,
          patient_key ASC NULLS LAST) AS rn
        FROM demo_keyed WHERE caseid IS NOT NULL AND primaryid IS NOT NULL)
  WHERE rn = 1
),
indi_report AS (
  SELECT caseid, primaryid, min({sk('condition_key')}) AS condition_sk FROM (
    SELECT {bigint('caseid')} AS caseid, {bigint('primaryid')} AS primaryid, {canon('indi_pt')} AS condition_key
    FROM silver_indi)
  WHERE {nonblank('condition_key')} AND caseid IS NOT NULL AND primaryid IS NOT NULL
  GROUP BY caseid, primaryid
),
flags_raw AS (
  SELECT caseid, primaryid,
         {_FLAGS}
  FROM (SELECT {bigint('caseid')} AS caseid, {bigint('primaryid')} AS primaryid, upper(trim(outc_cod)) AS outc_cod
        FROM silver_outc)
  WHERE {nonblank('outc_cod')} AND caseid IS NOT NULL AND primaryid IS NOT NULL
  GROUP BY caseid, primaryid
),
flags AS (
  SELECT *, {_ANY} AS outc_any_serious FROM flags_raw
),
report AS (
  SELECT d.caseid, d.primaryid, d.event_dt, d.patient_sk, d.date_key, i.condition_sk, {_FLAG_FILL},
         coalesce(f.outc_any_serious, 0) AS outc_any_serious
  FROM demo_report d
  LEFT JOIN indi_report i ON d.caseid = i.caseid AND d.primaryid = i.primaryid
  LEFT JOIN flags f ON d.caseid = f.caseid AND d.primaryid = f.primaryid
),
report_drugs AS (
  SELECT DISTINCT caseid, primaryid, drug_key FROM (
    SELECT {bigint('caseid')} AS caseid, {bigint('primaryid')} AS primaryid, {canon('drugname')} AS drug_key FROM silver_drug)
  WHERE {nonblank('drug_key')} AND caseid IS NOT NULL AND primaryid IS NOT NULL
),
report_reactions AS (
  SELECT DISTINCT caseid, primaryid, reaction_key FROM (
    SELECT {bigint('caseid')} AS caseid, {bigint('primaryid')} AS primaryid, {canon('pt')} AS reaction_key FROM silver_reac)
  WHERE {nonblank('reaction_key')} AND caseid IS NOT NULL AND primaryid IS NOT NULL
),
fact_faers_event AS (
  SELECT r.caseid, r.primaryid, {sk('d.drug_key')} AS drug_sk, {sk('x.reaction_key')} AS reaction_sk, r.condition_sk,
         r.patient_sk, r.event_dt, r.date_key, r.outc_death, r.outc_hosp, r.outc_disability, r.outc_life_threat,
         r.outc_other_serious, r.outc_any_serious, 1 AS event_count
  FROM report_drugs d
  JOIN report r ON d.caseid = r.caseid AND d.primaryid = r.primaryid
  JOIN report_reactions x ON x.caseid = r.caseid AND x.primaryid = r.primaryid
),
trial_drugs AS (
  SELECT DISTINCT study_id, drug_key FROM (
    SELECT trim(nct_id) AS study_id, {canon('name')} AS drug_key FROM silver_interventions)
  WHERE {nonblank('study_id')} AND {nonblank('drug_key')}
),
trial_conditions AS (
  SELECT DISTINCT study_id, condition_key FROM (
    SELECT trim(nct_id) AS study_id, {canon('name')} AS condition_key FROM silver_conditions)
  WHERE {nonblank('study_id')} AND {nonblank('condition_key')}
),
trial_studies AS (
  SELECT DISTINCT trim(nct_id) AS study_id FROM silver_studies WHERE {nonblank('trim(nct_id)')}
),
fact_trial_drug_condition AS (
  SELECT {sk('s.study_id')} AS study_sk, {sk('d.drug_key')} AS drug_sk, {sk('c.condition_key')} AS condition_sk,
         1 AS trial_mapping_count
  FROM trial_drugs d JOIN trial_studies s ON d.study_id = s.study_id JOIN trial_conditions c ON c.study_id = s.study_id
),
report_level AS (
  SELECT caseid, primaryid, CAST(sum(event_count) AS BIGINT) AS n_events, max(patient_sk) AS patient_sk,
         max(event_dt) AS event_dt, max(outc_death) AS outc_death, max(outc_hosp) AS outc_hosp,
         max(outc_any_serious) AS outc_any_serious
  FROM fact_faers_event GROUP BY caseid, primaryid
)"""

WITH = "WITH " + BRONZE.strip() + ",\n" + SILVER.strip() + ",\n" + GOLD.strip() + "\n"


def _q(body: str) -> str:
    return WITH + body


# ------------------------------------------------------------------ queries

_EVENT_FLAGS = {"flag_error": "error", "flag_purchase": "purchase", "flag_signup": "signup", "flag_click": "click", "flag_view": "view"}


DASHED = "'-' || c_name || '-' || CAST(c_nationkey AS VARCHAR)"


_EVENTS = (
    "SELECT CAST(event_id AS VARCHAR) AS event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, CAST(user_id AS VARCHAR) AS user_id, event_type, "
    "CAST(CAST(value AS DECIMAL(18,4)) AS VARCHAR) AS value, props FROM events"
)
PROFILE_KEY = canon(f"concat_ws('|', {unk('sex')}, {unk('age_cod')}, {unk('reporter_country')}, {unk('occr_country')})")

#: Landing files of the eight bronze tables: (table, CTEs, source, file, contract columns).
BRONZE_FILES = [
    ("aact_studies", "studies", "AACT", "studies.txt", "nct_id overall_status phase study_type enrollment start_date completion_date last_update_posted_date"),
    ("aact_interventions", "interventions", "AACT", "interventions.txt", "nct_id intervention_type name"),
    ("aact_conditions", "conditions", "AACT", "conditions.txt", "nct_id name"),
    ("faers_demo", "demo", "FAERS", "DEMO24Q1.txt", "primaryid caseid caseversion sex age age_cod event_dt occr_country reporter_country"),
    ("faers_drug", "drug", "FAERS", "DRUG24Q1.txt", "primaryid caseid drug_seq role_cod drugname prod_ai route"),
    ("faers_reac", "reac", "FAERS", "REAC24Q1.txt", "primaryid caseid pt"),
    ("faers_outc", "outc", "FAERS", "OUTC24Q1.txt", "primaryid caseid outc_cod"),
    ("faers_indi", "indi", "FAERS", "INDI24Q1.txt", "primaryid caseid indi_drug_seq indi_pt"),
]


def _bronze_count(table: str, cte: str, source: str, file: str, columns: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, count(*) AS rows, count(DISTINCT row({', '.join(columns.split())})) AS distinct_rows, "
        f"'{source}' AS source_system, '{file}' AS file_name, count(*) AS with_provenance FROM bronze_{cte}"
    )


def _log_rows(table: str, cte: str, *_) -> str:
    """Loaded file, silver build, and the source skipped by the second run."""
    n, m = f"(SELECT count(*) FROM bronze_{cte})", f"(SELECT count(*) FROM silver_{cte})"
    return (
        f"SELECT 'BRONZE' AS layer, '{table}' AS entity, 'SUCCESS' AS status, {n} AS rows_read, {n} AS rows_written, CAST(0 AS BIGINT) AS rows_rejected "
        f"UNION ALL SELECT 'SILVER', '{table}', 'SUCCESS', {n}, {m}, 0 UNION ALL SELECT 'BRONZE', '{table}', 'SKIPPED', 0, 0, 0"
    )


def _dq_report() -> str:
    def check(table: str, cte: str, name: str, broken: str) -> str:
        return (
            f"SELECT '{table}' AS table_name, '{name}' AS check_name, count(*) AS rows_checked, count(*) FILTER ({broken}) AS rows_broken, "
            f"count(*) FILTER ({broken}) = 0 AS passed FROM silver_{cte}"
        )

    keys = "primaryid IS NULL OR caseid IS NULL"
    parts = [check(t, cte, "not_empty", "false") for t, cte, *_ in BRONZE_FILES]
    parts += [check(f"faers_{c}", c, "report_key", keys) for c in ("demo", "drug", "reac", "outc", "indi")]
    parts += [
        check("aact_studies", "studies", "enrollment_range", "enrollment < 0"),
        check("aact_studies", "studies", "dates_in_order", "start_date > completion_date"),
        check("faers_demo", "demo", "event_dated", "event_dt IS NULL"),
        check("aact_studies_strict", "studies", "completed", "completion_date IS NULL OR enrollment IS NULL OR enrollment % 2 <> 0"),
        check("aact_studies_strict", "studies", "old_rows_kept", "false"),
    ]
    return " UNION ALL ".join(parts)


def statements() -> dict[str, str]:
    ev_flags = ", ".join(f"max(CASE WHEN event_type = '{v}' THEN 1 ELSE 0 END) AS {k}" for k, v in _EVENT_FLAGS.items())
    lineitem_cols = (
        "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, "
        "l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS l_shipdate"
    )
    lineitem_rest = ", ".join(
        f"{c} ASC NULLS LAST"
        for c in ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
    )
    d = "CAST(d AS DATE)"
    return {
        # ---- scalar functions and filters
        "canon_key": f"SELECT p_partkey, {canon('p_name')} AS drug_key FROM part",
        "canon_text": f"SELECT doc_id, {canon('text')} AS text_key FROM documents",
        "digits_to_int": (
            f"SELECT c_custkey, {digits('c_name')} AS name_num, {digits('c_mktsegment')} AS segment_num, "
            f"{digits(DASHED)} AS dashed_num "
            "FROM customer"
        ),
        "parse_date": (
            f"SELECT o_orderkey, raw, {parse_date('raw')} AS parsed, {date_precision('raw')} AS precision FROM "
            f"(SELECT o_orderkey, {_event_text('o_orderdate', 'o_orderpriority')} AS raw FROM orders)"
        ),
        "date_key_guard": (
            f"SELECT o_orderkey, {date_key('CAST(o_orderdate AS DATE)')} AS date_key, "
            f"{date_key('CAST(CAST(o_orderdate AS DATE) + INTERVAL 100 YEAR AS DATE)')} AS shifted_key FROM orders"
        ),
        "surrogate_key": f"SELECT p_partkey, {sk(canon('p_name'))} AS drug_sk FROM part",
        "nonblank_filter": (
            "SELECT event_id, user_id, event_type FROM "
            "(SELECT event_id, user_id, nullif(replace(event_type, 'error', '  '), 'view') AS event_type FROM events) "
            f"WHERE {nonblank('event_type')}"
        ),
        "column_contract": (
            "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(NULL AS VARCHAR) AS c_phone, c_mktsegment "
            "FROM customer"
        ),
        # ---- dedupe, windows, flags
        "latest_version": (
            "SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id "
            "ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST, event_type ASC NULLS LAST, value ASC NULLS LAST) AS rn "
            "FROM events) WHERE rn = 1"
        ),
        "distinct_on_key": (
            f"SELECT {', '.join(c.split(' AS ')[-1] for c in lineitem_cols.split(', '))} FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY l_orderkey, l_linenumber ORDER BY {lineitem_rest}) AS rn FROM (SELECT {lineitem_cols} FROM lineitem)) "
            "WHERE rn = 1"
        ),
        "outcome_flags": (
            f"SELECT *, CAST(greatest(coalesce(flag_error, 0), coalesce(flag_purchase, 0), 0) AS INTEGER) AS any_serious "
            f"FROM (SELECT user_id, {ev_flags} FROM events GROUP BY user_id)"
        ),
        "calendar_dim": (
            f"SELECT {date_key_raw(d)} AS date_key, {d} AS full_date, CAST(year({d}) AS INTEGER) AS year, "
            f"CAST(year({d}) AS VARCHAR) || 'Q' || CAST(quarter({d}) AS VARCHAR) AS quarter, "
            f"CAST(month({d}) AS INTEGER) AS month, strftime({d}, '%B') AS month_name, CAST(day({d}) AS INTEGER) AS day, "
            f"strftime({d}, '%A') AS day_of_week, CAST(isodow({d}) IN (6, 7) AS INTEGER) AS is_weekend "
            "FROM (SELECT unnest(generate_series(CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE), "
            "INTERVAL 1 DAY)) AS d FROM orders)"
        ),
        # ---- silver tables
        "silver_studies": _q("SELECT * FROM silver_studies"),
        "intervention_filter": _q("SELECT * FROM silver_interventions"),
        "silver_conditions": _q("SELECT * FROM silver_conditions"),
        "silver_demo_latest": _q("SELECT * FROM silver_demo"),
        "role_filter": _q("SELECT * FROM silver_drug"),
        "silver_reactions": _q("SELECT * FROM silver_reac"),
        "silver_outcomes": _q("SELECT * FROM silver_outc"),
        "silver_indications": _q("SELECT * FROM silver_indi"),
        # ---- dimensions
        "priority_union_dim": _q("SELECT * FROM dim_drug"),
        "dim_condition": _q("SELECT * FROM dim_condition"),
        "dim_reaction": _q("SELECT * FROM dim_reaction"),
        "default_unk_profile": _q("SELECT * FROM dim_patient"),
        "dim_study": _q("SELECT * FROM dim_study"),
        # ---- facts
        "report_fact": _q("SELECT * FROM fact_faers_event"),
        "trial_mapping_fact": _q("SELECT * FROM fact_trial_drug_condition"),
        # ---- measures
        "event_totals": _q(
            "SELECT CAST(coalesce(sum(n_events), 0) AS BIGINT) AS n_events, count(*) AS n_reports, "
            "CAST(coalesce(sum(outc_any_serious), 0) AS BIGINT) AS n_serious_reports, "
            "CAST(coalesce(sum(outc_hosp), 0) AS BIGINT) AS n_hosp_reports, "
            "CAST(coalesce(sum(outc_death), 0) AS BIGINT) AS n_death_reports FROM report_level"
        ),
        "enrollment_by_phase": _q(
            "SELECT phase, is_total, n_trials, n_with_enrollment, total_enrollment, "
            f"{ratio('total_enrollment', 'n_with_enrollment')} AS avg_enrollment FROM ("
            "SELECT phase, CAST(GROUPING(phase) AS INTEGER) AS is_total, count(*) AS n_trials, "
            "count(enrollment) AS n_with_enrollment, CAST(coalesce(sum(enrollment), 0) AS BIGINT) AS total_enrollment "
            "FROM dim_study GROUP BY ROLLUP (phase))"
        ),
        "gap_by_drug": _q(
            "SELECT g.*, "
            f"{ratio('n_reports', 'n_trials')} AS reports_per_trial, {ratio('n_serious_reports', 'n_reports')} AS serious_share, "
            "round(n_serious_reports * 1000.0 / nullif(trial_enrollment, 0), 4) AS serious_per_1k_enrolled, dd.drug_name "
            "FROM (SELECT coalesce(t.drug_sk, r.drug_sk) AS drug_sk, "
            "CAST(coalesce(t.n_trials, 0) AS BIGINT) AS n_trials, CAST(coalesce(t.trial_enrollment, 0) AS BIGINT) AS trial_enrollment, "
            "CAST(coalesce(r.n_reports, 0) AS BIGINT) AS n_reports, CAST(coalesce(r.n_events, 0) AS BIGINT) AS n_events, "
            "CAST(coalesce(r.n_serious_reports, 0) AS BIGINT) AS n_serious_reports, "
            "CAST(coalesce(r.n_hosp_reports, 0) AS BIGINT) AS n_hosp_reports, "
            "CAST(coalesce(r.n_death_reports, 0) AS BIGINT) AS n_death_reports "
            "FROM (SELECT x.drug_sk, count(*) AS n_trials, CAST(coalesce(sum(s.enrollment), 0) AS BIGINT) AS trial_enrollment "
            "      FROM (SELECT DISTINCT drug_sk, study_sk FROM fact_trial_drug_condition) x "
            "      LEFT JOIN dim_study s ON x.study_sk = s.study_sk GROUP BY x.drug_sk) t "
            "FULL OUTER JOIN (SELECT drug_sk, count(*) AS n_reports, CAST(sum(n_events) AS BIGINT) AS n_events, "
            "      CAST(sum(serious) AS BIGINT) AS n_serious_reports, CAST(sum(hosp) AS BIGINT) AS n_hosp_reports, "
            "      CAST(sum(death) AS BIGINT) AS n_death_reports FROM (SELECT drug_sk, caseid, primaryid, "
            "      sum(event_count) AS n_events, max(outc_any_serious) AS serious, max(outc_hosp) AS hosp, "
            "      max(outc_death) AS death FROM fact_faers_event GROUP BY drug_sk, caseid, primaryid) GROUP BY drug_sk) r "
            "ON t.drug_sk = r.drug_sk) g LEFT JOIN dim_drug dd ON g.drug_sk = dd.drug_sk"
        ),
        "coverage_overall": _q(
            "SELECT drugs_reported, drugs_trialed, drugs_in_both, serious_reports_untrialed_drug, "
            f"{ratio('drugs_in_both', 'drugs_reported')} AS trial_coverage FROM ("
            "SELECT (SELECT count(DISTINCT drug_sk) FROM fact_faers_event) AS drugs_reported, "
            "(SELECT count(DISTINCT drug_sk) FROM fact_trial_drug_condition) AS drugs_trialed, "
            "(SELECT count(*) FROM (SELECT DISTINCT drug_sk FROM fact_faers_event) r "
            " JOIN (SELECT DISTINCT drug_sk FROM fact_trial_drug_condition) t ON r.drug_sk = t.drug_sk) AS drugs_in_both, "
            "(SELECT count(*) FROM (SELECT DISTINCT caseid, primaryid FROM fact_faers_event e WHERE outc_any_serious = 1 "
            " AND NOT EXISTS (SELECT 1 FROM fact_trial_drug_condition t WHERE t.drug_sk = e.drug_sk))) "
            "AS serious_reports_untrialed_drug)"
        ),
        "missing_conditions": _q(
            "SELECT drug_sk, condition_sk, count(*) AS n_reports FROM (SELECT DISTINCT drug_sk, condition_sk, caseid, primaryid "
            "FROM fact_faers_event WHERE condition_sk IS NOT NULL) e "
            "WHERE NOT EXISTS (SELECT 1 FROM fact_trial_drug_condition t WHERE t.drug_sk = e.drug_sk AND t.condition_sk = e.condition_sk) "
            "GROUP BY drug_sk, condition_sk"
        ),
        "trial_duration": _q(
            f"SELECT *, {ratio('total_days', 'n_trials')} AS avg_days FROM (SELECT phase, count(*) AS n_trials, "
            "min(dd) AS min_days, max(dd) AS max_days, CAST(sum(dd) AS BIGINT) AS total_days FROM ("
            "SELECT phase, CAST(date_diff('day', start_date, completion_date) AS INTEGER) AS dd FROM silver_studies "
            "WHERE start_date IS NOT NULL AND completion_date IS NOT NULL) GROUP BY phase)"
        ),
        "profile_cube": _q(
            "SELECT p.sex, p.age_cod, CAST(GROUPING(p.sex, p.age_cod) AS INTEGER) AS grouping_level, count(*) AS n_reports, "
            "CAST(sum(r.outc_any_serious) AS BIGINT) AS n_serious_reports "
            "FROM report_level r JOIN dim_patient p ON r.patient_sk = p.patient_sk GROUP BY CUBE (p.sex, p.age_cod)"
        ),
        "trend_quarter": _q(
            "SELECT CAST(year(event_dt) AS INTEGER) AS year, "
            "CAST(year(event_dt) AS VARCHAR) || 'Q' || CAST(quarter(event_dt) AS VARCHAR) AS quarter, count(*) AS n_reports, "
            "CAST(sum(n_events) AS BIGINT) AS n_events, CAST(sum(outc_any_serious) AS BIGINT) AS n_serious_reports "
            "FROM report_level WHERE event_dt IS NOT NULL GROUP BY 1, 2"
        ),
        # ---- ingestion (files written from the tables, read back)
        "snapshot_drift": (
            "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, "
            "CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN CAST(c_nationkey AS VARCHAR) END AS c_nationkey, "
            "c_mktsegment FROM customer"
        ),
        "multiline_snapshot": "SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, nullif(text, '') AS text, source FROM documents",
        "rejected_rows": (
            "SELECT event_id, event_type, user_id, rejected_record, count(*) AS in_batch, count(*) AS in_stream FROM ("
            "SELECT CASE WHEN good THEN id END AS event_id, CASE WHEN good THEN event_type END AS event_type, CASE WHEN good THEN usr END AS user_id, "
            "CASE event_type WHEN 'error' THEN concat_ws('$', id, event_type, usr, 'extra') WHEN 'signup' THEN concat_ws('$', id, event_type) END AS rejected_record "
            "FROM (SELECT CAST(event_id AS VARCHAR) AS id, event_type, CAST(user_id AS VARCHAR) AS usr, event_type NOT IN ('error', 'signup') AS good FROM events)"
            ") GROUP BY ALL"
        ),
        "incremental_files": _EVENTS,
        "incremental_stream": _EVENTS,
        "incremental_stream_csv": _EVENTS,
        # ---- the layered build from files
        "bronze_tables": _q(" UNION ALL ".join(_bronze_count(*t) for t in BRONZE_FILES)),
        "run_log_rows": _q(" UNION ALL ".join(_log_rows(*t) for t in BRONZE_FILES)),
        "dq_report": _q(_dq_report()),
        # ---- facts against dimensions that lack members
        "report_fact_lookup": _q(
            f"SELECT r.caseid, r.primaryid, {sk('d.drug_key')} AS drug_sk, {sk('x.reaction_key')} AS reaction_sk, i.condition_sk, r.patient_sk, "
            "r.event_dt, r.date_key, r.outc_death, r.outc_hosp, r.outc_disability, r.outc_life_threat, r.outc_other_serious, "
            "r.outc_any_serious, 1 AS event_count FROM report r "
            f"JOIN (SELECT DISTINCT {sk(PROFILE_KEY)} AS patient_sk FROM silver_demo WHERE sex IS NOT NULL) p ON p.patient_sk = r.patient_sk "
            "JOIN report_drugs d ON d.caseid = r.caseid AND d.primaryid = r.primaryid AND d.drug_key IN (SELECT drug_key FROM trial_drugs) "
            "JOIN report_reactions x ON x.caseid = r.caseid AND x.primaryid = r.primaryid "
            f"AND x.reaction_key IN (SELECT {canon('pt')} FROM silver_reac WHERE pt < 'M') "
            f"LEFT JOIN (SELECT caseid, primaryid, min({sk('condition_key')}) AS condition_sk FROM ("
            f"SELECT {bigint('caseid')} AS caseid, {bigint('primaryid')} AS primaryid, {canon('indi_pt')} AS condition_key FROM silver_indi) "
            "WHERE condition_key IN (SELECT condition_key FROM trial_conditions) GROUP BY 1, 2) i ON i.caseid = r.caseid AND i.primaryid = r.primaryid"
        ),
        "trial_fact_lookup": _q(
            "SELECT f.* FROM fact_trial_drug_condition f JOIN dim_study s ON s.study_sk = f.study_sk WHERE s.overall_status = 'F'"
        ),
        "unresolved_keys": _q(
            "SELECT fact, dimension, key, count(*) AS rows FROM ("
            f"SELECT 'report' AS fact, 'patient' AS dimension, {PROFILE_KEY} AS key FROM silver_demo "
            f"UNION ALL SELECT 'report', 'drug', {canon('drugname')} FROM silver_drug "
            f"UNION ALL SELECT 'report', 'reaction', {canon('pt')} FROM silver_reac "
            f"UNION ALL SELECT 'report', 'condition', {canon('indi_pt')} FROM silver_indi "
            "UNION ALL SELECT 'trial', 'study', trim(nct_id) FROM silver_studies) k "
            f"WHERE {nonblank('key')} AND NOT EXISTS (SELECT 1 FROM ("
            f"SELECT 'patient' AS dimension, {PROFILE_KEY} AS key FROM silver_demo WHERE sex IS NOT NULL "
            "UNION SELECT 'drug', drug_key FROM trial_drugs UNION SELECT 'condition', condition_key FROM trial_conditions "
            f"UNION SELECT 'reaction', {canon('pt')} FROM silver_reac WHERE pt < 'M' "
            "UNION SELECT 'study', nct_id FROM silver_studies WHERE overall_status = 'F') m WHERE m.dimension = k.dimension AND m.key = k.key) "
            "GROUP BY 1, 2, 3"
        ),
    }
