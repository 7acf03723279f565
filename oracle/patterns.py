"""Oracle SQL of the documented patterns, from their definitions.

The charge gap walks each encounter line by line, persons are the closure of
shared identifiers, versions, sessions and decayed weights look at all earlier
rows, and every grain is a query of its own.
"""

from __future__ import annotations

from .tables import SD

_LINES = """
  SELECT encounter_id, completion_datetime AS ts, 0 AS kind, order_id AS id FROM orders_raw
  WHERE status = 'COMPLETED' AND completion_datetime IS NOT NULL
  UNION ALL
  SELECT encounter_id, charge_datetime, 1, charge_id FROM charges
  WHERE status = 'POSTED' AND encounter_id IS NOT NULL AND charge_datetime IS NOT NULL"""

# name -> (dependencies, body, (integral columns, non-integral columns))
PATTERNS: dict[str, tuple[tuple[str, ...], str, tuple[str, str]]] = {}

PATTERNS["charge_gap"] = (("orders_raw", "charges"), f"""
WITH RECURSIVE line AS (
  SELECT *, row_number() OVER (PARTITION BY encounter_id ORDER BY ts, kind, id) AS i FROM ({_LINES})),
walk AS (
  SELECT encounter_id, i, kind, id, ts, CAST(1 - kind AS BIGINT) AS waiting, CAST(1 - kind AS BIGINT) AS opened,
    CAST(0 AS BIGINT) AS paid, false AS pays
  FROM line WHERE i = 1
  UNION ALL
  SELECT l.encounter_id, l.i, l.kind, l.id, l.ts,
    CASE WHEN l.kind = 0 THEN w.waiting + 1 WHEN w.waiting > 0 THEN w.waiting - 1 ELSE 0 END, w.opened + 1 - l.kind,
    w.paid + CASE WHEN l.kind = 1 AND w.waiting > 0 THEN 1 ELSE 0 END, l.kind = 1 AND w.waiting > 0
  FROM walk w JOIN line l ON l.encounter_id IS NOT DISTINCT FROM w.encounter_id AND l.i = w.i + 1)
SELECT o.encounter_id, o.id AS order_id, o.ts AS completion_datetime, c.id AS charge_id, c.ts AS charge_datetime,
  date_diff('day', CAST(o.ts AS DATE), CAST(c.ts AS DATE)) AS delay_days, c.id IS NULL AS is_gap
FROM walk o LEFT JOIN walk c ON c.encounter_id = o.encounter_id AND c.pays AND c.paid = o.opened
WHERE o.kind = 0""", ("delay_days", ""))

PATTERNS["patient_fragments"] = (("patient_master_index",), """
WITH RECURSIVE known AS (
  SELECT master_patient_id AS id, 'EPIC' AS sys, epic_mrn AS v FROM patient_master_index
  UNION ALL SELECT master_patient_id, 'CERNER', cerner_pid FROM patient_master_index
  UNION ALL SELECT master_patient_id, 'MEDITECH', meditech_id FROM patient_master_index
  UNION ALL SELECT master_patient_id, 'LEGACY', unnest(string_split(legacy_mrn_list, ',')) FROM patient_master_index),
link AS (SELECT DISTINCT a.id AS a, b.id AS b FROM known a JOIN known b ON a.sys = b.sys AND a.v = b.v AND a.id <> b.id),
reach AS (
  SELECT DISTINCT master_patient_id AS a, master_patient_id AS b FROM patient_master_index
  UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b),
person AS (SELECT a AS id, min(b) AS person_id, count(*) AS n FROM reach GROUP BY a),
seen AS (SELECT p.person_id, count(DISTINCT k.sys) FILTER (WHERE k.v IS NOT NULL) AS systems
  FROM person p LEFT JOIN known k ON k.id = p.id GROUP BY p.person_id)
SELECT p.id AS master_patient_id, p.person_id, p.n AS person_records, s.systems, p.n > 1 AND s.systems > 1 AS is_fragmented
FROM person p JOIN seen s ON s.person_id = p.person_id""", ("person_records systems", ""))

PATTERNS["claim_contract_version"] = (("claims", "contract_amendments"), """
WITH c AS (SELECT row_number() OVER () AS r, claim_id, contract_id, service_date_start AS d FROM claims),
v AS (SELECT c.r, a.*, row_number() OVER (PARTITION BY c.r ORDER BY a.effective_date DESC, a.version_no DESC) AS place
  FROM c JOIN contract_amendments a ON a.contract_id = c.contract_id AND a.effective_date <= c.d),
f AS (SELECT contract_id, min(effective_date) AS first_date FROM contract_amendments GROUP BY contract_id)
SELECT c.claim_id, c.contract_id, c.d AS service_date, v.version_no, v.effective_date, v.expiration_date, v.baseline_multiplier,
  CASE WHEN c.contract_id IS NULL THEN 'NO_CONTRACT' WHEN c.d IS NULL THEN 'NO_DATE' WHEN f.first_date IS NULL THEN 'NO_VERSION'
       WHEN c.d < f.first_date THEN 'NOT_YET' WHEN c.d > v.expiration_date THEN 'EXPIRED' ELSE 'VALID' END AS state,
  CASE WHEN c.d < f.first_date THEN date_diff('day', c.d, f.first_date)
       WHEN c.d > v.expiration_date THEN date_diff('day', v.expiration_date, c.d)
       WHEN f.first_date IS NOT NULL AND c.d IS NOT NULL THEN 0 END AS days_outside
FROM c LEFT JOIN v ON v.r = c.r AND v.place = 1 LEFT JOIN f ON f.contract_id = c.contract_id""",
                                      ("version_no days_outside", "baseline_multiplier"))

PATTERNS["duplicate_line_sessions"] = (("orders_raw", "charges"), """
WITH line AS (
  SELECT 'ORDER' AS line_kind, encounter_id, order_type AS code, order_datetime AS line_time, order_id AS line_id FROM orders_raw
  WHERE encounter_id IS NOT NULL AND order_datetime IS NOT NULL
  UNION ALL
  SELECT 'CHARGE', encounter_id, cpt_code, charge_datetime, charge_id FROM charges
  WHERE status <> 'VOIDED' AND encounter_id IS NOT NULL AND charge_datetime IS NOT NULL),
near AS (SELECT *, CASE WHEN line_time <= lag(line_time) OVER w + INTERVAL 72 HOUR THEN 0 ELSE 1 END AS begins
  FROM line WINDOW w AS (PARTITION BY line_kind, encounter_id, code ORDER BY line_time, line_id)),
numbered AS (SELECT *, sum(begins) OVER (PARTITION BY line_kind, encounter_id, code ORDER BY line_time, line_id
  ROWS UNBOUNDED PRECEDING) AS session FROM near)
SELECT line_kind, line_id, encounter_id, code, line_time, session,
  count(*) OVER (PARTITION BY line_kind, encounter_id, code, session) AS session_size,
  row_number() OVER s AS place, row_number() OVER s > 1 AS is_repeat
FROM numbered WINDOW s AS (PARTITION BY line_kind, encounter_id, code, session ORDER BY line_time, line_id)""",
                                       ("session session_size place", ""))

PATTERNS["denial_benchmark"] = (("claims", "encounters", "payers"), f"""
WITH r AS (SELECT e.facility_id, c.payer_id, p.payer_type, count(*) AS claims,
    count(*) FILTER (WHERE c.claim_status = 'DENIED') AS denied,
    {SD("count(*) FILTER (WHERE c.claim_status = 'DENIED')", "count(*)")} AS denial_rate
  FROM claims c JOIN encounters e ON e.encounter_id = c.encounter_id LEFT JOIN payers p ON p.payer_id = c.payer_id
  GROUP BY e.facility_id, c.payer_id, p.payer_type)
SELECT *, count(*) OVER g AS peers, quantile_cont(denial_rate, 0.25) OVER g AS q1, quantile_cont(denial_rate, 0.5) OVER g AS median,
  quantile_cont(denial_rate, 0.75) OVER g AS q3, percent_rank() OVER (PARTITION BY payer_type ORDER BY denial_rate) AS percent_rank
FROM r WINDOW g AS (PARTITION BY payer_type)""", ("claims denied peers", "denial_rate q1 median q3 percent_rank"))

PATTERNS["denial_lift_by_flag"] = (("claims", "encounters", "providers"), f"""
WITH f AS (SELECT provider_npi, coalesce(max(documentation_quality_flag), 'NONE') AS flag FROM providers WHERE is_current
    GROUP BY provider_npi),
c AS (SELECT coalesce(f.flag, 'UNKNOWN') AS flag, c.payer_id, c.cpt_code, CASE WHEN c.claim_status = 'DENIED' THEN 1 ELSE 0 END AS denied
  FROM claims c JOIN encounters e ON e.encounter_id = c.encounter_id LEFT JOIN f ON f.provider_npi = e.attending_provider_npi),
s AS (SELECT payer_id, cpt_code, {SD('sum(denied)', 'count(*)')} AS rate FROM c GROUP BY payer_id, cpt_code),
g AS (SELECT c.flag, c.payer_id, c.cpt_code, count(*) AS claims, sum(c.denied) AS denied FROM c GROUP BY c.flag, c.payer_id, c.cpt_code),
t AS (SELECT g.flag, sum(g.claims) AS claims, sum(g.denied) AS denied, CAST(sum(CAST(g.claims * s.rate AS DECIMAL(18,9))) AS DOUBLE) AS expected_denials
  FROM g JOIN s ON s.payer_id IS NOT DISTINCT FROM g.payer_id AND s.cpt_code IS NOT DISTINCT FROM g.cpt_code GROUP BY g.flag)
SELECT *, {SD('denied', 'expected_denials')} AS lift FROM t""", ("claims denied", "expected_denials lift"))

PATTERNS["knowledge_weight_by_month"] = (("tribal_knowledge_notes", "denial_codex"), """
WITH ref AS (SELECT DISTINCT note_id, unnest(string_split(referenced_codes, ',')) AS denial_code,
    CAST(date_trunc('month', last_referenced_date) AS DATE) AS month,
    CASE confidence WHEN 'HIGH' THEN 1.0 WHEN 'MEDIUM' THEN 0.5 WHEN 'STALE' THEN 0.25 END AS worth FROM tribal_knowledge_notes),
r AS (SELECT * FROM ref WHERE worth IS NOT NULL AND month <= DATE '2001-06-01'),
m AS (SELECT denial_code, CAST(unnest(generate_series(min(month), DATE '2001-06-01', INTERVAL 1 MONTH)) AS DATE) AS month
  FROM r GROUP BY denial_code)
SELECT m.denial_code, m.month, count(*) FILTER (WHERE r.month = m.month) AS note_references,
  sum(r.worth * power(0.5, date_diff('month', r.month, m.month) / 6.0)) AS weight,
  (SELECT count(*) FROM denial_codex x WHERE x.denial_code = m.denial_code) AS entries
FROM m JOIN r ON r.denial_code = m.denial_code AND r.month <= m.month GROUP BY m.denial_code, m.month""",
                                         ("note_references entries", "weight"))

_USE = """
  SELECT period, facility_id, provider_npi AS active, NULL AS adopting FROM clinician_ehr_usage
  UNION ALL SELECT period, facility_id, NULL, provider_npi FROM ai_tool_usage"""
_DEX = {"facility_month": ("period", "facility_id"), "month": ("period",), "facility": ("facility_id",), "all": ()}


def _dex(name: str) -> str:
    keys = [k if k in _DEX[name] else f"NULL AS {k}" for k in ("period", "facility_id")]
    group = f" GROUP BY {', '.join(_DEX[name])}" if _DEX[name] else ""
    return (f"SELECT '{name}' AS grain, {', '.join(keys)}, count(DISTINCT active) AS active_providers, "
            f"count(DISTINCT adopting) AS adopting_providers FROM ({_USE}){group}")


PATTERNS["dex_distinct_providers"] = (("clinician_ehr_usage", "ai_tool_usage"), "\nUNION ALL ".join(map(_dex, _DEX)),
                                      ("active_providers adopting_providers", ""))

_LABOR = {"facility_month": ("region", "facility_id", "month"), "region_month": ("region", "month"),
          "facility": ("region", "facility_id"), "region": ("region",), "month": ("month",), "all": ()}


def _labor(name: str) -> str:
    keys = [k if k in _LABOR[name] else f"NULL AS {k}" for k in ("region", "facility_id", "month")]
    group = f" GROUP BY {', '.join(_LABOR[name])}" if _LABOR[name] else ""
    return f"""SELECT '{name}' AS grain, {', '.join(keys)}, sum(worked_hours) AS worked_hours, sum(agency_hours) AS agency_hours,
  sum(overtime_hours) AS overtime_hours, sum(total_labor_cost) AS total_labor_cost,
  {SD('sum(agency_hours)', 'sum(worked_hours)')} AS agency_pct,
  {SD('sum(total_labor_cost)', 'sum(worked_hours)')} AS cost_per_worked_hour,
  {SD('sum(overtime_hours)', 'sum(worked_hours)')} AS ot_pct FROM fact_workforce_month{group}"""


PATTERNS["labor_ratios_all_grains"] = (
    ("fact_workforce_month",), "\nUNION ALL ".join(map(_labor, _LABOR)),
    ("", "worked_hours agency_hours overtime_hours total_labor_cost agency_pct cost_per_worked_hour ot_pct"))
