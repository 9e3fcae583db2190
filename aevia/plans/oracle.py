"""Independent DuckDB SQL for each query key.

The Spark side builds nested bronze reports and runs the silver rules on
them; the SQL here derives the same silver rows straight from the flat test
tables (pre-registered views ``orders``, ``lineitem``, ...), so the two
paths share no code. Gold and report SQL is then written over those silver
CTEs.

DuckDB hygiene: sums are cast to BIGINT (DuckDB returns HUGEINT), year and
month to INTEGER (DuckDB returns BIGINT), division goes through DOUBLE and
NULLIF, truncation uses ``trunc`` (DuckDB's int cast rounds).
"""

from __future__ import annotations

# Silver rows straight from the flat tables (planting rules as in the
# Spark-side test bronze: same moduli, written independently).
SILVER_CTES = """
rep AS (
  SELECT o.o_orderkey AS k, o.o_custkey AS ck, o.o_orderstatus AS st,
         o.o_orderdate AS od, o.o_orderpriority AS pr, n.n_name AS nname
  FROM orders o
  JOIN customer c ON c.c_custkey = o.o_custkey
  JOIN nation n ON n.n_nationkey = c.c_nationkey
),
rep_copies AS (
  SELECT * FROM rep
  UNION ALL
  SELECT * FROM rep WHERE k % 50 = 0
),
ev_raw AS (
  SELECT k,
    CASE WHEN ck % 29 = 0 THEN NULL ELSE nname END AS country,
    CASE WHEN k % 41 = 0 THEN NULL ELSE CAST(od AS DATE) END AS report_date,
    CASE st WHEN 'F' THEN 1 WHEN 'O' THEN 0
            WHEN 'P' THEN CASE WHEN k % 7 = 0 THEN NULL ELSE 0 END END AS is_serious,
    CASE pr WHEN '1-URGENT' THEN 1 WHEN '5-LOW' THEN 0 END AS death,
    CASE WHEN k % 211 = 0 THEN NULL WHEN pr = '2-HIGH' THEN 1 END AS hospitalization,
    CASE ck % 5 WHEN 0 THEN 'Unknown' WHEN 1 THEN 'Male' WHEN 2 THEN 'Female' END AS patient_sex,
    CASE WHEN k % 13 = 0 OR k % 101 = 0 THEN NULL ELSE CAST(k % 1500 AS DOUBLE) END AS age_v,
    k % 8 AS unit
  FROM rep
  WHERE k % 997 <> 0
),
silver_events AS (
  SELECT CAST(k AS VARCHAR) AS safety_report_id, country, report_date,
         CAST(is_serious AS INTEGER) AS is_serious, CAST(death AS INTEGER) AS death,
         CAST(hospitalization AS INTEGER) AS hospitalization, patient_sex,
         CASE WHEN yrs >= 0 AND yrs <= 120 THEN CAST(trunc(yrs) AS INTEGER) END AS patient_age
  FROM (
    SELECT *, CASE unit WHEN 0 THEN age_v * 10.0 WHEN 1 THEN age_v
                        WHEN 2 THEN age_v / 12.0 WHEN 3 THEN age_v / CAST(52.1429 AS DOUBLE)
                        WHEN 4 THEN age_v / 365.25 WHEN 5 THEN age_v / 8766.0
                        ELSE age_v END AS yrs
    FROM ev_raw)
),
lines AS (
  SELECT r.k, l.l_partkey AS pk, l.l_linenumber AS ln, l.l_returnflag AS rf,
         p.p_name, p.p_type, p.p_brand
  FROM rep_copies r
  JOIN lineitem l ON l.l_orderkey = r.k
  JOIN part p ON p.p_partkey = l.l_partkey
),
silver_drugs AS (
  SELECT CASE WHEN k % 997 = 0 THEN NULL ELSE CAST(k AS VARCHAR) END AS safety_report_id,
         upper(trim(p_name)) AS drug_name,
         CASE WHEN ln % 3 = 0 THEN NULL ELSE p_type END AS indication,
         CASE rf WHEN 'A' THEN 'Suspect' WHEN 'N' THEN 'Concomitant'
                 WHEN 'R' THEN CASE WHEN ln = 7 THEN NULL ELSE 'Interacting' END END AS drug_role
  FROM lines
  WHERE pk % 89 <> 0 AND pk % 97 <> 0 AND trim(p_name) <> ''
),
silver_reactions AS (
  SELECT CASE WHEN k % 997 = 0 THEN NULL ELSE CAST(k AS VARCHAR) END AS safety_report_id,
         array_to_string(list_transform(string_split(lower(p_type) || ' ' || p_brand, ' '),
                         lambda w: upper(w[1]) || lower(w[2:])), ' ') AS reaction_name
  FROM lines
  WHERE ln <= 3
)
"""


def with_silver(body: str) -> str:
    return "WITH " + SILVER_CTES + ",\n" + body


def _rate(num: str, den: str) -> str:
    return f"round(CAST({num} AS DOUBLE) / NULLIF({den}, 0) * 100, 2)"


GOLD_CTES = f"""
g_overview AS (
  SELECT CAST(count(safety_report_id) AS BIGINT) AS total_reports,
         CAST(sum(is_serious) AS BIGINT) AS serious_reports,
         CAST(sum(death) AS BIGINT) AS death_reports,
         CAST(sum(hospitalization) AS BIGINT) AS hospitalization_reports,
         {_rate('sum(is_serious)', 'count(safety_report_id)')} AS seriousness_rate_pct
  FROM silver_events
),
g_monthly AS (
  SELECT CAST(year(report_date) AS INTEGER) AS year, CAST(month(report_date) AS INTEGER) AS month,
         CAST(count(safety_report_id) AS BIGINT) AS total_reports,
         CAST(sum(is_serious) AS BIGINT) AS serious_reports,
         CAST(sum(death) AS BIGINT) AS death_reports,
         CAST(sum(hospitalization) AS BIGINT) AS hospitalization_reports,
         {_rate('sum(is_serious)', 'count(safety_report_id)')} AS seriousness_rate_pct
  FROM silver_events GROUP BY 1, 2
),
g_drugs AS (
  SELECT d.drug_name, CAST(count(d.safety_report_id) AS BIGINT) AS total_reports,
         CAST(sum(e.is_serious) AS BIGINT) AS serious_reports,
         {_rate('sum(e.is_serious)', 'count(d.safety_report_id)')} AS seriousness_rate_pct
  FROM silver_drugs d LEFT JOIN silver_events e ON e.safety_report_id = d.safety_report_id
  GROUP BY d.drug_name
),
g_reactions AS (
  SELECT r.reaction_name, CAST(count(r.safety_report_id) AS BIGINT) AS total_reports,
         CAST(sum(e.is_serious) AS BIGINT) AS serious_reports,
         {_rate('sum(e.is_serious)', 'count(r.safety_report_id)')} AS seriousness_rate_pct
  FROM silver_reactions r LEFT JOIN silver_events e ON e.safety_report_id = r.safety_report_id
  GROUP BY r.reaction_name
),
g_pairs AS (
  SELECT d.drug_name, r.reaction_name, CAST(count(*) AS BIGINT) AS pair_count,
         CAST(sum(e.is_serious) AS BIGINT) AS serious_count,
         {_rate('sum(e.is_serious)', 'count(*)')} AS seriousness_rate_pct
  FROM silver_drugs d
  LEFT JOIN silver_events e ON e.safety_report_id = d.safety_report_id
  JOIN silver_reactions r ON r.safety_report_id = d.safety_report_id
  GROUP BY d.drug_name, r.reaction_name
),
g_features AS (
  SELECT e.safety_report_id, e.report_date, e.country, e.patient_sex, e.patient_age, e.is_serious,
         CAST(coalesce(dc.num_drugs, 0) AS BIGINT) AS num_drugs,
         CAST(coalesce(dc.has_suspect_drug, 0) AS INTEGER) AS has_suspect_drug,
         CAST(coalesce(rc.num_reactions, 0) AS BIGINT) AS num_reactions
  FROM silver_events e
  LEFT JOIN (SELECT safety_report_id, count(drug_name) AS num_drugs,
                    max(CASE WHEN drug_role = 'Suspect' THEN 1 ELSE 0 END) AS has_suspect_drug
             FROM silver_drugs GROUP BY 1) dc ON dc.safety_report_id = e.safety_report_id
  LEFT JOIN (SELECT safety_report_id, count(reaction_name) AS num_reactions
             FROM silver_reactions GROUP BY 1) rc ON rc.safety_report_id = e.safety_report_id
)
"""


def with_gold(body: str) -> str:
    return "WITH " + SILVER_CTES + ",\n" + GOLD_CTES + "\n" + body


ORACLE: dict[str, str] = {
    "silver_events": with_silver("SELECT * FROM silver_events"),
    "silver_drugs": with_silver("SELECT * FROM silver_drugs"),
    "silver_reactions": with_silver("SELECT * FROM silver_reactions"),
    "safety_overview": with_gold("SELECT * FROM g_overview"),
    "monthly_trends": with_gold("SELECT * FROM g_monthly"),
    "drug_summary": with_gold("SELECT * FROM g_drugs"),
    "reaction_summary": with_gold("SELECT * FROM g_reactions"),
    "drug_reaction_pairs": with_gold("SELECT * FROM g_pairs"),
    "ml_features": with_gold("SELECT * FROM g_features"),
}

# ---------------------------------------------------------------------------
# Raw (bronze-grain) reports, flattened, straight from the flat tables.
# ---------------------------------------------------------------------------
RAW_CTE = """
raw_flat AS (
  SELECT r.k AS k, CASE WHEN k % 41 = 0 THEN NULL ELSE CAST(year(od) AS INTEGER) END AS r_year,
    CASE WHEN k % 41 = 0 THEN NULL ELSE CAST(month(od) AS INTEGER) END AS r_month,
    CASE WHEN k % 997 = 0 THEN NULL ELSE CAST(k AS VARCHAR) END AS safety_report_id,
    CASE WHEN k % 41 = 0 THEN 'unknown' ELSE strftime(od, '%Y%m%d') END AS receive_date_raw,
    CASE st WHEN 'F' THEN '1' WHEN 'O' THEN '2'
            WHEN 'P' THEN CASE WHEN k % 7 = 0 THEN NULL ELSE '2' END END AS serious,
    CASE pr WHEN '1-URGENT' THEN '1' WHEN '5-LOW' THEN '2' END AS serious_death,
    CASE WHEN k % 211 = 0 THEN 'x' WHEN pr = '2-HIGH' THEN '1' END AS serious_hospitalization,
    CASE WHEN ck % 29 = 0 THEN NULL ELSE nname END AS country,
    CASE WHEN k % 13 = 0 THEN NULL WHEN k % 101 = 0 THEN 'n/a' ELSE CAST(k % 1500 AS VARCHAR) END AS patient_age,
    CASE WHEN ck % 5 = 4 THEN NULL ELSE CAST(ck % 5 AS VARCHAR) END AS patient_sex,
    CAST(coalesce(nl.n, 0) AS INTEGER) AS num_drugs,
    CAST(coalesce(nl.nr, 0) AS INTEGER) AS num_reactions
  FROM rep_copies r
  LEFT JOIN (SELECT l_orderkey, count(*) AS n, count_if(l_linenumber <= 3) AS nr
             FROM lineitem GROUP BY 1) nl ON nl.l_orderkey = r.k
)
"""


def with_all(body: str) -> str:
    return "WITH " + SILVER_CTES + ",\n" + GOLD_CTES + ",\n" + RAW_CTE + "\n" + body


def _vc(source: str, name: str, expr: str, frm: str) -> str:
    return (
        f"SELECT '{source}' AS source, '{name}' AS column_name, CAST({expr} AS VARCHAR) AS value, "
        f"count(*) AS count FROM {frm} WHERE ({expr}) IS NOT NULL GROUP BY 3"
    )


_VALUE_COUNTS = "\nUNION ALL\n".join(
    [
        _vc("raw", "serious",
            "CASE serious WHEN '1' THEN 'Serious' WHEN '2' THEN 'Not Serious' ELSE serious END", "raw_flat"),
        _vc("raw", "patient_sex",
            "CASE patient_sex WHEN '0' THEN 'Unknown' WHEN '1' THEN 'Male' WHEN '2' THEN 'Female' END",
            "raw_flat"),
        _vc("raw", "country", "country", "raw_flat"),
        _vc("raw", "num_drugs", "num_drugs", "raw_flat"),
        _vc("silver", "country", "country", "silver_events"),
        _vc("silver", "patient_sex", "patient_sex", "silver_events"),
        _vc("silver", "is_serious", "is_serious", "silver_events"),
        _vc("silver", "report_day", "day(report_date)", "silver_events"),
        _vc("silver", "drug_role", "drug_role", "silver_drugs"),
        _vc("silver", "drug_name", "drug_name", "silver_drugs"),
        _vc("silver", "reaction_name", "reaction_name", "silver_reactions"),
        _vc("features", "is_serious", "coalesce(is_serious, 0)", "g_features"),
        _vc("features", "num_drugs", "num_drugs", "g_features"),
        _vc("features", "num_reactions", "num_reactions", "g_features"),
        _vc("features", "has_suspect_drug", "has_suspect_drug", "g_features"),
    ]
)

_NULL_COLS = [
    "safety_report_id", "receive_date_raw", "serious", "serious_death", "serious_hospitalization",
    "country", "patient_age", "patient_sex", "num_drugs", "num_reactions",
]
_NULL_RATES = "SELECT column_name, round(r * 100, 4) AS null_pct FROM (\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, avg(CASE WHEN {c} IS NULL THEN CAST(1 AS DOUBLE) "
    f"ELSE CAST(0 AS DOUBLE) END) AS r FROM raw_flat"
    for c in _NULL_COLS
) + "\n) WHERE r > 0"


def _dq(suite: str, table: str, check: str, observed: str, threshold: float, op: str, severity: str,
        frm: str | None) -> str:
    obs = f"CAST({observed} AS DOUBLE)"
    passed = f"coalesce({obs} {op} {float(threshold)}, false)"
    src = f" FROM {frm}" if frm else ""
    return (
        f"SELECT '{suite}' AS suite, '{table}' AS table_name, '{check}' AS check_name, {obs} AS observed, "
        f"CAST({float(threshold)} AS DOUBLE) AS threshold, {passed} AS passed, '{severity}' AS severity{src}"
    )


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


_NULL_RATE_SQL = ("coalesce(CAST(count_if(report_date IS NULL) AS DOUBLE) / NULLIF(count(*), 0), 0)")

DQ_EVENTS = _union([
    _dq("silver", "silver_adverse_events", "required_columns_exist", "0", 0, "<=", "error", None),
    _dq("silver", "silver_adverse_events", "no_null_safety_report_ids", "count_if(safety_report_id IS NULL)",
        0, "<=", "error", "silver_events"),
    _dq("silver", "silver_adverse_events", "is_serious_is_binary",
        "count_if(is_serious IS NOT NULL AND is_serious NOT IN (0, 1))", 0, "<=", "error", "silver_events"),
    _dq("silver", "silver_adverse_events", "report_date_null_rate", _NULL_RATE_SQL, 0.05, "<=", "error",
        "silver_events"),
    _dq("silver", "silver_adverse_events", "patient_age_realistic",
        "count_if(patient_age IS NOT NULL AND (patient_age < 0 OR patient_age > 120))", 0, "<=", "error",
        "silver_events"),
    _dq("silver", "silver_adverse_events", "row_count_minimum", "count(*)", 10, ">=", "error", "silver_events"),
    _dq("silver_shape", "silver_adverse_events", "patient_sex_labels",
        "count_if(patient_sex IS NOT NULL AND patient_sex NOT IN ('Unknown', 'Male', 'Female'))", 0, "<=",
        "error", "silver_events"),
])

DQ_DRUGS = _union([
    _dq("silver", "silver_drugs", "required_columns_exist", "0", 0, "<=", "error", None),
    _dq("silver", "silver_drugs", "drug_name_not_empty",
        "count_if(drug_name IS NULL OR trim(drug_name) = '')", 0, "<=", "error", "silver_drugs"),
    _dq("silver", "silver_drugs", "row_count_minimum", "count(*)", 10, ">=", "error", "silver_drugs"),
    _dq("silver", "silver_drugs", "null_safety_report_ids", "count_if(safety_report_id IS NULL)", 0, "<=",
        "warn", "silver_drugs"),
    _dq("silver_shape", "silver_drugs", "drug_names_upper_case", "count_if(drug_name <> upper(drug_name))",
        0, "<=", "error", "silver_drugs"),
    _dq("silver_shape", "silver_drugs", "drug_role_labels",
        "count_if(drug_role IS NOT NULL AND drug_role NOT IN ('Suspect', 'Concomitant', 'Interacting'))",
        0, "<=", "error", "silver_drugs"),
])

DQ_REACTIONS = _union([
    _dq("silver", "silver_reactions", "required_columns_exist", "0", 0, "<=", "error", None),
    _dq("silver", "silver_reactions", "reaction_name_not_empty",
        "count_if(reaction_name IS NULL OR trim(reaction_name) = '')", 0, "<=", "error", "silver_reactions"),
    _dq("silver", "silver_reactions", "row_count_minimum", "count(*)", 10, ">=", "error", "silver_reactions"),
])

_RATE_BAD_ALL = "count_if(NOT coalesce(seriousness_rate_pct BETWEEN 0 AND 100, false))"
_RATE_BAD_NN = "count_if(seriousness_rate_pct IS NOT NULL AND NOT (seriousness_rate_pct BETWEEN 0 AND 100))"


def _g(table: str, check: str, observed: str, threshold: float, op: str, frm: str | None) -> str:
    return _dq("gold", table, check, observed, threshold, op, "error", frm)


DQ_GOLD = _union([
    _g("safety_overview", "required_columns_exist", "0", 0, "<=", None),
    _g("safety_overview", "has_one_row", "abs(count(*) - 1)", 0, "<=", "g_overview"),
    _g("safety_overview", "total_reports_positive", "count_if(NOT coalesce(total_reports > 0, false))", 0, "<=",
       "g_overview"),
    _g("safety_overview", "seriousness_rate_in_range", _RATE_BAD_ALL, 0, "<=", "g_overview"),
    _g("monthly_trends", "required_columns_exist", "0", 0, "<=", None),
    _g("monthly_trends", "has_rows", "count(*)", 1, ">=", "g_monthly"),
    _g("monthly_trends", "seriousness_rate_in_range", _RATE_BAD_ALL, 0, "<=", "g_monthly"),
    _g("drug_summary", "required_columns_exist", "0", 0, "<=", None),
    _g("drug_summary", "has_rows", "count(*)", 1, ">=", "g_drugs"),
    _g("drug_summary", "seriousness_rate_in_range", _RATE_BAD_NN, 0, "<=", "g_drugs"),
    _g("drug_summary", "total_reports_positive", "count_if(NOT coalesce(total_reports > 0, false))", 0, "<=",
       "g_drugs"),
    _g("reaction_summary", "required_columns_exist", "0", 0, "<=", None),
    _g("reaction_summary", "has_rows", "count(*)", 1, ">=", "g_reactions"),
    _g("drug_reaction_pairs", "required_columns_exist", "0", 0, "<=", None),
    _g("drug_reaction_pairs", "has_rows", "count(*)", 1, ">=", "g_pairs"),
    _g("drug_reaction_pairs", "pair_count_positive", "count_if(NOT coalesce(pair_count > 0, false))", 0, "<=",
       "g_pairs"),
    _g("drug_reaction_pairs", "seriousness_rate_in_range", _RATE_BAD_NN, 0, "<=", "g_pairs"),
    _g("ml_features", "required_columns_exist", "0", 0, "<=", None),
    _g("ml_features", "has_rows", "count(*)", 1, ">=", "g_features"),
    _g("ml_features", "num_drugs_non_negative", "count_if(num_drugs < 0)", 0, "<=", "g_features"),
    _g("ml_features", "num_reactions_non_negative", "count_if(num_reactions < 0)", 0, "<=", "g_features"),
    _g("ml_features", "has_suspect_drug_is_binary",
       "count_if(has_suspect_drug IS NULL OR has_suspect_drug NOT IN (0, 1))", 0, "<=", "g_features"),
])

DQ_ORPHANS = _union([
    part
    for t in ("drugs", "reactions")
    for part in (
        _dq("referential", f"silver_{t}", "report_ids_exist_in_events",
            "count_if(c.safety_report_id IS NULL OR e.safety_report_id IS NULL)", 0, "<=", "warn",
            f"silver_{t} c LEFT JOIN (SELECT DISTINCT safety_report_id FROM silver_events) e "
            f"ON e.safety_report_id = c.safety_report_id"),
        _dq("referential", f"silver_{t}", "child_rows_at_least_events",
            f"(SELECT count(*) FROM silver_{t}) - (SELECT count(*) FROM silver_events)", 0, ">=", "warn", None),
    )
])

_PROF_SUMMARY = """
SELECT (SELECT count(*) FROM raw_flat) AS total_reports,
  (SELECT CAST(count_if(serious = '1') AS BIGINT) FROM raw_flat) AS serious_reports,
  (SELECT round(CAST(count_if(serious = '1') AS DOUBLE) / NULLIF(count(*), 0) * 100, 2) FROM raw_flat)
    AS seriousness_rate_pct,
  (SELECT count(DISTINCT country) FROM raw_flat) AS unique_countries,
  (SELECT count(*) FROM silver_drugs) AS drug_mentions,
  (SELECT count(DISTINCT drug_name) FROM silver_drugs) AS unique_drugs,
  (SELECT count(*) FROM silver_reactions) AS reaction_mentions,
  (SELECT count(DISTINCT reaction_name) FROM silver_reactions) AS unique_reactions,
  (SELECT CAST(count_if(TRY_CAST(patient_age AS DOUBLE) IS NULL) AS BIGINT) FROM raw_flat) AS null_age_reports,
  (SELECT round(CAST(count_if(TRY_CAST(patient_age AS DOUBLE) IS NULL) AS DOUBLE) / NULLIF(count(*), 0) * 100, 2)
     FROM raw_flat) AS null_age_pct,
  (SELECT round(avg(num_drugs), 4) FROM raw_flat) AS avg_drugs,
  (SELECT round(avg(num_reactions), 4) FROM raw_flat) AS avg_reactions
"""

_AGE_HIST = """
, rng AS (SELECT min(patient_age) AS lo, max(patient_age) AS hi FROM silver_events),
hist AS (
  SELECT CAST(CASE WHEN (hi - lo) = 0 THEN 0
                   ELSE least(floor((patient_age - lo) / ((hi - lo) / 30.0)), 29) END AS INTEGER) AS bin,
         lo, (hi - lo) / 30.0 AS width
  FROM silver_events, rng WHERE patient_age IS NOT NULL
)
SELECT bin, round(lo + bin * width, 6) AS lower, round(lo + (bin + 1) * width, 6) AS upper, count(*) AS count
FROM hist GROUP BY bin, lo, width
"""

ORACLE.update({
    "top_serious_drugs": with_gold(
        "SELECT drug_name, total_reports, serious_reports, seriousness_rate_pct FROM g_drugs "
        "ORDER BY serious_reports DESC NULLS LAST, drug_name LIMIT 20"),
    "signal_pairs": with_gold(
        "SELECT drug_name, reaction_name, pair_count, seriousness_rate_pct FROM g_pairs WHERE pair_count >= 10 "
        "ORDER BY seriousness_rate_pct DESC NULLS LAST, drug_name, reaction_name LIMIT 20"),
    "rep_kpi": with_gold("SELECT total_reports, serious_reports, death_reports, seriousness_rate_pct FROM g_overview"),
    "rep_trend": with_gold(
        "SELECT CASE WHEN year IS NOT NULL THEN printf('%d-%02d', year, month) END AS period, year, month, "
        "total_reports, serious_reports FROM g_monthly"),
    "rep_sex_share": with_gold(
        "SELECT patient_sex AS sex, count(*) AS count, "
        "round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER () * 100, 2) AS pct "
        "FROM g_features WHERE patient_sex IS NOT NULL GROUP BY 1"),
    "rep_top_countries": with_gold(
        "SELECT country, count(*) AS count FROM g_features WHERE country IS NOT NULL GROUP BY 1 "
        "ORDER BY count DESC, country LIMIT 15"),
    "rep_top_drugs": with_gold("SELECT * FROM g_drugs ORDER BY total_reports DESC, drug_name LIMIT 20"),
    "rep_top_rate_drugs": with_gold(
        "SELECT * FROM g_drugs ORDER BY seriousness_rate_pct DESC NULLS LAST, drug_name LIMIT 20"),
    "rep_drug_detail": with_gold(
        'SELECT drug_name AS "Drug", total_reports AS "Total Reports", serious_reports AS "Serious", '
        'seriousness_rate_pct AS "Seriousness Rate (%)" FROM g_drugs ORDER BY total_reports DESC, drug_name LIMIT 20'),
    "rep_top_reactions": with_gold("SELECT * FROM g_reactions ORDER BY total_reports DESC, reaction_name LIMIT 20"),
    "rep_signal_scatter": with_gold(
        "SELECT drug_name, reaction_name, pair_count, serious_count, seriousness_rate_pct FROM g_pairs "
        "WHERE pair_count >= 5"),
    "rep_top_pairs": with_gold(
        'SELECT drug_name AS "Drug", reaction_name AS "Reaction", pair_count AS "Pair Count", '
        'serious_count AS "Serious", seriousness_rate_pct AS "Seriousness Rate (%)" FROM g_pairs '
        "ORDER BY pair_count DESC, drug_name, reaction_name LIMIT 20"),
    "prof_value_counts": with_all(_VALUE_COUNTS),
    "prof_country_rate": with_all(
        ", top AS (SELECT country FROM raw_flat WHERE country IS NOT NULL GROUP BY 1 "
        "ORDER BY count(*) DESC, country LIMIT 10) "
        "SELECT country, round(avg(CASE WHEN serious = '1' THEN 1 ELSE 0 END) * 100, 2) AS seriousness_rate_pct, "
        "count(*) AS total_reports FROM raw_flat WHERE country IN (SELECT country FROM top) GROUP BY 1"),
    "prof_age_stats": with_all(
        "SELECT min(patient_age) AS min_age, max(patient_age) AS max_age, "
        "CAST(median(patient_age) AS DOUBLE) AS median_age, round(avg(patient_age), 4) AS mean_age, "
        "CAST(count_if(patient_age IS NULL) AS BIGINT) AS null_ages, "
        "round(CAST(count_if(patient_age IS NULL) AS DOUBLE) / NULLIF(count(*), 0) * 100, 2) AS null_age_pct "
        "FROM silver_events"),
    "prof_drug_buckets": with_all(
        "SELECT CAST(count_if(num_drugs = 1) AS BIGINT) AS reports_1_drug, "
        "CAST(count_if(num_drugs = 2) AS BIGINT) AS reports_2_drugs, "
        "CAST(count_if(num_drugs >= 3) AS BIGINT) AS reports_3plus_drugs, max(num_drugs) AS max_drugs, "
        "round(avg(num_drugs), 4) AS avg_drugs FROM raw_flat"),
    "prof_drugs_per_report": with_all(
        "SELECT CAST(count_if(n = 1) AS BIGINT) AS reports_1_drug, CAST(count_if(n = 2) AS BIGINT) AS reports_2_drugs, "
        "CAST(count_if(n >= 3) AS BIGINT) AS reports_3plus_drugs, round(avg(n), 4) AS avg_drugs "
        "FROM (SELECT safety_report_id, count(*) AS n FROM silver_drugs WHERE safety_report_id IS NOT NULL GROUP BY 1)"),
    "prof_age_hist": with_all(_AGE_HIST),
    "prof_null_rates": with_all(_NULL_RATES),
    "prof_class_balance": with_gold(
        "SELECT CAST(coalesce(is_serious, 0) AS INTEGER) AS is_serious, count(*) AS count, "
        "round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER () * 100, 2) AS pct FROM g_features GROUP BY 1"),
    "prof_summary": with_all(_PROF_SUMMARY),
    "prof_dates": with_all(
        "SELECT min(report_date) AS first_date, max(report_date) AS last_date, "
        "CAST(count_if(report_date IS NULL) AS BIGINT) AS null_dates FROM silver_events"),
    "prof_shapes": with_all(
        "SELECT 'silver_adverse_events' AS table_name, count(*) AS n_rows, 8 AS n_cols FROM silver_events "
        "UNION ALL SELECT 'silver_drugs', count(*), 4 FROM silver_drugs "
        "UNION ALL SELECT 'silver_reactions', count(*), 2 FROM silver_reactions"),
    "prof_key_presence": (
        "WITH k AS (SELECT unnest(json_keys(props)) AS key FROM events) "
        "SELECT key, count(*) AS records, "
        "round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM events) * 100, 2) AS pct FROM k GROUP BY 1"),
    "dq_events": with_all(DQ_EVENTS),
    "dq_drugs": with_all(DQ_DRUGS),
    "dq_reactions": with_all(DQ_REACTIONS),
    "dq_gold": with_all(DQ_GOLD),
    "dq_orphans": with_all(DQ_ORPHANS),
})

_RAW_COLS = ("safety_report_id AS safetyreportid, receive_date_raw AS receivedate, serious, "
             "country AS primarysourcecountry, num_drugs, num_reactions")

ORACLE.update({
    "page_unwrap": with_all(f"SELECT k // 100 AS page, {_RAW_COLS} FROM raw_flat"),
    "offset_page": with_all(f"SELECT {_RAW_COLS} FROM raw_flat ORDER BY k LIMIT 100 OFFSET 100"),
    "indexed_pages": with_all(
        f"SELECT page, {_RAW_COLS} FROM (SELECT *, row_number() OVER (ORDER BY k) - 1 AS place, count(*) OVER () AS total FROM raw_flat) "
        "JOIN (VALUES ('second'), ('middle'), ('late')) pages(page) ON place - "
        "CASE page WHEN 'second' THEN 100 WHEN 'middle' THEN total // 2 ELSE 9 * total // 10 END BETWEEN 0 AND 99"),
    "monthly_job": with_gold("SELECT * FROM g_drugs"),
    "copied_table": with_gold("SELECT * FROM g_reactions"),
    "loaded_features": with_gold("SELECT * FROM g_features"),
    "bronze_roundtrip": with_all(f"SELECT {_RAW_COLS}, r_year AS year, r_month AS month FROM raw_flat"),
    "month_window": with_gold(
        "SELECT * FROM silver_events WHERE report_date BETWEEN DATE '1996-02-01' AND DATE '1996-02-29'"),
    "publish_roundtrip": with_gold("SELECT * FROM g_pairs"),
    "read_or_empty": with_gold("SELECT * FROM g_reactions"),
    "snapshot_roundtrip": with_gold("SELECT drug_name, reaction_name, pair_count, serious_count FROM g_pairs"),
})

# Page files: which pages are cut short, and which hold nothing.
_PAGES = """
pg AS (SELECT *, k // 100 AS page FROM raw_flat),
page_list AS (
  SELECT page, count(*) AS n, page % 13 = 6 AS cut, page % 13 <> 6 AND (page % 7 = 3 OR page % 11 = 5) AS nothing
  FROM pg GROUP BY page)
"""

# Two run months: every fifth order is sent again, serious, and every tenth
# without reactions; the later month wins.
_JOB_SILVER = (
    SILVER_CTES.replace("silver_events AS (", "first_events AS (").replace("silver_reactions AS (", "first_reactions AS (")
    + """,
silver_events AS (
  SELECT * REPLACE (CAST(CASE WHEN CAST(safety_report_id AS BIGINT) % 5 = 0 THEN 1 ELSE is_serious END AS INTEGER) AS is_serious)
  FROM first_events),
silver_reactions AS (
  SELECT * FROM first_reactions WHERE safety_report_id IS NULL OR CAST(safety_report_id AS BIGINT) % 10 <> 0)
""")

# Three run months, the second of them run again: the last version that is
# still there wins.
_RESEND_SILVER = (
    SILVER_CTES.replace("silver_events AS (", "first_events AS (").replace("silver_reactions AS (", "first_reactions AS (")
    .replace("silver_drugs AS (", "first_drugs AS (")
    + """,
held AS (
  SELECT *, CAST(safety_report_id AS BIGINT) AS k,
         CASE WHEN CAST(safety_report_id AS BIGINT) % 3 = 0 THEN 3
              WHEN CAST(safety_report_id AS BIGINT) % 5 = 0 AND CAST(safety_report_id AS BIGINT) % 25 <> 0 THEN 2 ELSE 1 END AS v
  FROM first_events),
silver_events AS (
  SELECT * EXCLUDE (k, v) REPLACE (CAST(CASE v WHEN 3 THEN 0 WHEN 2 THEN 1 ELSE is_serious END AS INTEGER) AS is_serious) FROM held),
silver_reactions AS (
  SELECT r.* FROM first_reactions r LEFT JOIN held USING (safety_report_id) WHERE NOT coalesce(v = 2 AND k % 10 = 0, false)),
silver_drugs AS (
  SELECT d.* FROM first_drugs d LEFT JOIN held USING (safety_report_id) WHERE NOT coalesce(v = 3 AND k % 6 = 0, false))
""")

_JOB_GOLD = {
    "safety_overview": "g_overview", "monthly_trends": "g_monthly", "drug_summary": "g_drugs",
    "reaction_summary": "g_reactions", "drug_reaction_pairs": "g_pairs", "ml_features": "g_features",
}

ORACLE.update({
    **{f"job_gold_{n}": f"WITH {_JOB_SILVER},\n{GOLD_CTES}\nSELECT * FROM {g}" for n, g in _JOB_GOLD.items()},
    **{f"resend_gold_{n}": f"WITH {_RESEND_SILVER},\n{GOLD_CTES}\nSELECT * FROM {g}" for n, g in _JOB_GOLD.items()},
    **{f"bucketed_{n}": with_gold(f"SELECT * FROM {_JOB_GOLD[n]}") for n in ("drug_summary", "drug_reaction_pairs", "ml_features")},
    "page_files": with_all(f""", {_PAGES}
SELECT page * 100 AS skip, {_RAW_COLS} FROM pg JOIN page_list USING (page) WHERE NOT cut AND NOT nothing"""),
    "load_audit": with_all(f""", {_PAGES}
SELECT count(*) AS files, count_if(NOT cut)::BIGINT AS pages, count_if(nothing)::BIGINT AS empty_pages,
       max(page) + 1 - count(*) AS missing_pages, count_if(cut)::BIGINT AS corrupt,
       sum(CASE WHEN NOT cut AND NOT nothing THEN n ELSE 0 END)::BIGINT AS reports FROM page_list"""),
    "month_array_file": with_all(
        f"SELECT {_RAW_COLS}, r_year AS year, r_month AS month FROM raw_flat WHERE r_year = 1996 AND r_month = 2"),
    "catalog_roundtrip": with_gold("SELECT * FROM g_reactions"),
})

# ---------------------------------------------------------------------------
# Machine learning on the feature table
# ---------------------------------------------------------------------------
_PREPARED = """
SELECT safety_report_id,
  CAST(coalesce(patient_age, median(patient_age) OVER ()) AS DOUBLE) AS patient_age,
  CAST(dense_rank() OVER (ORDER BY coalesce(patient_sex, 'Unknown')) - 1 AS DOUBLE) AS patient_sex,
  CAST(dense_rank() OVER (ORDER BY coalesce(country, 'Unknown')) - 1 AS DOUBLE) AS country,
  CAST(num_drugs AS DOUBLE) AS num_drugs,
  CAST(num_reactions AS DOUBLE) AS num_reactions,
  CAST(has_suspect_drug AS DOUBLE) AS has_suspect_drug,
  CAST(coalesce(is_serious, 0) AS INTEGER) AS label
FROM g_features
"""

_RULE = """
, s AS (SELECT CAST(coalesce(is_serious, 0) AS INTEGER) AS label, CAST(has_suspect_drug AS INTEGER) AS prediction,
               CAST(num_drugs AS DOUBLE) + has_suspect_drug * CAST(0.5 AS DOUBLE) AS score FROM g_features),
c AS (SELECT CAST(count_if(label = 1 AND prediction = 1) AS BIGINT) AS tp,
             CAST(count_if(label = 0 AND prediction = 1) AS BIGINT) AS fp,
             CAST(count_if(label = 0 AND prediction = 0) AS BIGINT) AS tn,
             CAST(count_if(label = 1 AND prediction = 0) AS BIGINT) AS fn FROM s),
g AS (SELECT score, count_if(label = 1) AS p, count_if(label <> 1) AS n FROM s GROUP BY score),
cum AS (SELECT score, p, n,
          coalesce(sum(n) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS n_below,
          sum(n) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cn,
          sum(p) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cp
        FROM g),
tot AS (SELECT sum(p) AS pp, sum(n) AS nn FROM g)
"""


def _r(num: str, den: str) -> str:
    return f"round(coalesce(CAST({num} AS DOUBLE) / NULLIF({den}, 0), 0), 4)"


ORACLE.update({
    "ml_prepared": with_gold(_PREPARED),
    "ml_split": with_gold("""
, h AS (SELECT safety_report_id, CAST(coalesce(is_serious, 0) AS INTEGER) AS label,
               substr(md5(safety_report_id || ':42'), 1, 8) AS hash FROM g_features)
SELECT safety_report_id, label,
       CASE WHEN row_number() OVER (PARTITION BY label ORDER BY hash, safety_report_id)
                 <= round(count(*) OVER (PARTITION BY label) * 0.2::DOUBLE) THEN 'test' ELSE 'train' END AS split
FROM h"""),
    "ml_metrics_fixed": with_gold(_RULE + f"""
SELECT {_r('tp + tn', 'tp + fp + tn + fn')} AS accuracy, {_r('tp', 'tp + fp')} AS precision,
       {_r('tp', 'tp + fn')} AS recall, {_r('2 * tp', '2 * tp + fp + fn')} AS f1 FROM c"""),
    "ml_class_report": with_gold(_RULE + f"""
SELECT 0 AS class, {_r('tn', 'tn + fn')} AS precision, {_r('tn', 'tn + fp')} AS recall,
       {_r('2 * tn', '2 * tn + fn + fp')} AS f1, tn + fp AS support FROM c
UNION ALL
SELECT 1, {_r('tp', 'tp + fp')}, {_r('tp', 'tp + fn')}, {_r('2 * tp', '2 * tp + fp + fn')}, tp + fn FROM c"""),
    "ml_auc_fixed": with_gold(_RULE + """
SELECT round(CASE WHEN tot.pp * tot.nn > 0 THEN
  sum(CAST(cum.p AS DOUBLE) * (cum.n_below + cum.n * CAST(0.5 AS DOUBLE))) / (CAST(tot.pp AS DOUBLE) * tot.nn) END, 4)
  AS roc_auc
FROM cum, tot GROUP BY tot.pp, tot.nn"""),
    "ml_roc_fixed": with_gold(_RULE + """
SELECT CAST(NULL AS DOUBLE) AS threshold, CAST(0 AS DOUBLE) AS fpr, CAST(0 AS DOUBLE) AS tpr
UNION ALL
SELECT score, round(CAST(cn AS DOUBLE) / tot.nn, 6), round(CAST(cp AS DOUBLE) / tot.pp, 6) FROM cum, tot"""),
})


# Runs of the rules "serious if at least n drugs are named", n = 1 to 5.
_RUNS = f"""
, cuts AS (SELECT unnest([1, 2, 3, 4, 5]) AS cut),
m AS (SELECT cut, count_if(y AND p) AS tp, count_if(NOT y AND p) AS fp, count_if(NOT y AND NOT p) AS tn, count_if(y AND NOT p) AS fn
      FROM (SELECT cut, coalesce(is_serious, 0) = 1 AS y, num_drugs >= cut AS p FROM g_features, cuts) GROUP BY cut),
runs AS (
  SELECT 'rule-' || cut AS run_id, 'drugs_' || cut AS run_name, 'FINISHED' AS status, '00:0' || cut || ':00' AS start_time,
         'AtLeast' || cut AS model_type, CAST(cut AS VARCHAR) AS cut,
         {_r('tp + tn', 'tp + fp + tn + fn')} AS accuracy, {_r('tp', 'tp + fp')} AS precision,
         {_r('tp', 'tp + fn')} AS recall, {_r('2 * tp', '2 * tp + fp + fn')} AS f1,
         round((CAST(tp AS DOUBLE) / NULLIF(tp + fn, 0) + CAST(tn AS DOUBLE) / NULLIF(tn + fp, 0)) / 2, 4) AS roc_auc FROM m)
"""
_MEASURES = "accuracy, precision, recall, f1, roc_auc"

ORACLE.update({
    "runs_flat": with_gold(_RUNS + "SELECT * FROM runs"),
    "exported_runs": with_gold(_RUNS + "SELECT * FROM runs"),
    "best_run": with_gold(
        _RUNS + f"SELECT run_id, model_type, {_MEASURES} FROM runs ORDER BY roc_auc DESC NULLS LAST, run_id LIMIT 1"),
    "run_compare": with_gold(
        _RUNS + f"SELECT model_type, Metric, Score FROM (SELECT model_type, {_MEASURES} FROM runs) "
        f"UNPIVOT INCLUDE NULLS (Score FOR Metric IN ({_MEASURES}))"),
    "run_history": with_gold(_RUNS + f"SELECT run_name, model_type, start_time, {_MEASURES} FROM runs"),
})


def _top(name: str, expr: str, frm: str, k: int) -> str:
    return (f"SELECT * FROM (SELECT '{name}' AS list_name, CAST({expr} AS VARCHAR) AS value, count(*) AS count "
            f"FROM {frm} WHERE ({expr}) IS NOT NULL GROUP BY 2 ORDER BY count DESC, value LIMIT {k})")


ORACLE["prof_top_values"] = with_all("\nUNION ALL\n".join([
    _top("raw_countries", "country", "raw_flat", 20),
    _top("raw_drugs", "drug_name", "silver_drugs", 25),
    _top("raw_reactions", "reaction_name", "silver_reactions", 25),
    _top("silver_drugs", "drug_name", "silver_drugs", 15),
    _top("silver_reactions", "reaction_name", "silver_reactions", 15),
]))

# Sizes of the split that both trained models log; each is one run, however
# often it is trained, and its saved model gives the logged metrics again.
ORACLE.update({
    "ml_fixed_score": with_gold(f"""
, x AS ({_PREPARED}),
z AS (SELECT safety_report_id, label, 1 / (1 + exp(-(-1.0003::DOUBLE + 0.01::DOUBLE * patient_age - 0.25::DOUBLE * patient_sex
        + 0.03::DOUBLE * country + 0.4::DOUBLE * num_drugs - 0.3::DOUBLE * num_reactions + 0.75::DOUBLE * has_suspect_drug))) AS p FROM x)
SELECT safety_report_id, label, CAST(p > 0.5 AS INTEGER) AS prediction, round(p, 6) AS score FROM z"""),
    "ml_registry": with_gold("""
, y AS (SELECT coalesce(is_serious, 0) AS label, count(*) AS n FROM g_features GROUP BY 1),
t AS (SELECT CAST(sum(n) AS BIGINT) AS n, CAST(sum(round(n * 0.2::DOUBLE)) AS BIGINT) AS test FROM y)
SELECT model_type, n - test AS train_size, test AS test_size, CAST(1 AS BIGINT) AS runs, true AS same_metrics
FROM t, (VALUES ('LogisticRegression'), ('RandomForest')) m(model_type)"""),
})

ORACLE.update({
    "bound_top_pairs": ORACLE["rep_top_pairs"],
    "bound_signal_pairs": ORACLE["signal_pairs"],
    "wide_medians": " UNION ALL ".join(
        f"SELECT '{c}' AS name, round(CAST(median({c}) AS DOUBLE), 4) AS median FROM {t}"
        for t, c in (("lineitem", "l_extendedprice"), ("lineitem", "l_quantity"), ("orders", "o_totalprice"), ("customer", "c_acctbal"))),
})

ORACLE["distinct_sketches"] = with_silver(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, count({c}) AS n_values, count(DISTINCT {c}) AS n_distinct, "
    f"TRUE AS within_error FROM {view}"
    for t, c, view in (("adverse_events", "safety_report_id", "silver_events"), ("adverse_events", "country", "silver_events"),
                       ("drugs", "drug_name", "silver_drugs"), ("reactions", "reaction_name", "silver_reactions"))))
