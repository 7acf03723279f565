"""Binding of the metric layer's raw operational tables to the driver's test tables.

The driver ships TPC-H-like parquet tables (``region nation customer supplier
part orders lineitem``) and none of the hospital/IT tables the jobs read. Each
raw table is therefore a deterministic projection of the test tables. The text
is kept in the common subset of Spark SQL and DuckDB, so the very same string
is a Spark view body here and a CTE body in the DuckDB oracle; checked equal on
both engines by ``tests/test_bindings.py``.

Every binding reads every row of its test tables, without predicates: columns
decide an event's type, status and severity. Rows and distinct keys grow with
the scale factor, except for the fixed nation and region tables.

Clock of the binding: ``as_of = 2001-06-04``; IT month spine 1998-06..2001-05.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import re

from pyspark.sql import DataFrame, SparkSession

BINDING_AS_OF = _dt.date(2001, 6, 4)

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

BINDINGS: dict[str, str] = {
    "facilities": """
select concat('F', cast(n_nationkey as string)) facility_id, n_name facility_name, r_name region,
       case n_nationkey % 3 when 0 then 'EPIC' when 1 then 'CERNER' else 'MEDITECH' end primary_emr,
       100 + 10 * n_nationkey bed_capacity, n_nationkey % 3 <> 0 is_legacy
from nation join region on n_regionkey = r_regionkey""",
    "departments": """
select concat('D', cast(n_nationkey as string)) department_id,
       concat('F', cast(n_nationkey as string)) facility_id,
       case n_nationkey % 4 when 0 then 'CARDIOLOGY' when 1 then 'ORTHO' when 2 then 'MEDICINE'
            else 'SURGERY' end service_line
from nation""",
    # SCD-2: three versions per NPI (custkeys 3k, 3k+1, 3k+2), the 3k version is current.
    "providers": """
select concat('P', cast(c_custkey as string)) provider_sk,
       concat('N', cast(cast(floor(c_custkey / 3) as bigint) as string)) provider_npi,
       md5(c_name) provider_name_hash, c_mktsegment specialty,
       concat('D', cast(c_nationkey as string)) department_id,
       concat('F', cast(c_nationkey as string)) primary_facility_id,
       case when c_custkey % 9 = 0 then 'LAPSED' else 'ACTIVE' end credentialing_status,
       case when c_custkey % 5 = 0 then 'HIGH_QUERY_RATE' end documentation_quality_flag,
       c_custkey % 3 = 0 is_current
from customer""",
    "payers": """
select concat('Y', cast(s_suppkey as string)) payer_id, s_name payer_name,
       case s_suppkey % 4 when 0 then 'Commercial' when 1 then 'Medicare' when 2 then 'Medicaid'
            else 'MA' end payer_type
from supplier""",
    # One contract version per payer and plan subtype; plan subtypes are the
    # three lineitem return flags, so claims (keyed by return flag) find them.
    "payer_contracts": " union all ".join(
        f"""
select concat('Y', cast(s_suppkey as string), '-{f}') contract_id,
       concat('Y', cast(s_suppkey as string)) payer_id, '{f}' plan_subtype,
       case when s_suppkey % 2 = 0 then 'DRG' else 'FEE_SCHEDULE' end reimbursement_methodology,
       1.0e0 + cast(s_suppkey % 10 as double) / 16 baseline_multiplier,
       date '1995-01-01' effective_date,
       case when s_suppkey % 8 = 7 then null
            else date '2001-01-01' + cast((s_suppkey * 37) % 400 as int) end expiration_date,
       cast(30 + 15 * (s_suppkey % 4) as int) appeal_window_days,
       cast(60 + 30 * (s_suppkey % 3) as int) timely_filing_days
from supplier""" for f in ("A", "N", "R")),
    # The version chain of each contract: three amendments, some open-ended, with overlaps and gaps.
    "contract_amendments": " union all ".join(
        f"""
select concat('Y', cast(s_suppkey as string), '-{f}') contract_id, {k} version_no,
       date '1995-03-01' + cast({700 * k} + (s_suppkey * 13) % 90 as int) effective_date,
       case when (s_suppkey + {k}) % 11 = 0 then null
            else date '1995-03-01' + cast({700 * k + 500} + (s_suppkey * 13) % 90 + (s_suppkey * {k + 3}) % 400 as int)
            end expiration_date,
       1.0e0 + cast((s_suppkey + {k}) % 10 as double) / 16 baseline_multiplier
from supplier""" for f in ("A", "N", "R") for k in range(3)),
    # Lists are comma-joined here, arrays in the raw layer.
    "denial_codex": """
select concat('X', cast(p_partkey as string)) codex_id,
       case when p_partkey % 4 <> 0 then concat('Y', cast(p_partkey % 100 as string)) end payer_id,
       concat('CO-', cast(p_partkey % 41 as string)) denial_code,
       case p_partkey % 3 when 0 then 'HIGH' when 1 then 'MEDIUM' else 'STALE' end confidence
from part""",
    "tribal_knowledge_notes": """
select concat('T', cast(o_orderkey as string)) note_id,
       case o_orderkey % 4 when 0 then 'HIGH' when 1 then 'MEDIUM' when 2 then 'STALE' end confidence,
       case when o_orderkey % 53 = 0 then null else cast(o_orderdate as date) end last_referenced_date,
       case when o_orderkey % 59 = 0 then null
            else concat('CO-', cast(o_orderkey % 37 as string), ',CO-', cast(o_custkey % 23 as string)) end referenced_codes
from orders""",
    "patient_master_index": """
select concat('M', cast(c_custkey as string)) master_patient_id,
       md5(cast(cast(floor(c_custkey / 8) as bigint) as string)) name_hash,
       case when c_custkey % 23 = 0 then null
            else 0.5e0 + cast(c_custkey % 32 as double) / 64 end match_confidence_score,
       concat('F', cast(c_nationkey as string)) primary_facility_id,
       case when c_custkey % 4 <> 0 then concat('E', cast(cast(floor(c_custkey / 3) as bigint) as string)) end epic_mrn,
       case when c_custkey % 3 = 1 then concat('C', cast(cast(floor(c_custkey / 7) as bigint) as string)) end cerner_pid,
       case when c_custkey % 10 = 0 then concat('I', cast(cast(floor(c_custkey / 42) as bigint) as string)) end meditech_id,
       case when c_custkey % 5 = 2 then concat('L', cast(cast(floor(c_custkey / 14) as bigint) as string),
                                               ',X', cast(c_custkey as string)) end legacy_mrn_list
from customer""",
    "encounters": """
select concat('E', cast(o_orderkey as string)) encounter_id,
       concat('M', cast(o_custkey as string)) master_patient_id,
       case when o_orderkey % 97 = 0 then null else concat('F', cast(o_custkey % 25 as string)) end facility_id,
       case when o_orderkey % 20 = 0 then null
            else concat('N', cast(cast(floor(o_custkey / 3) as bigint) as string)) end attending_provider_npi,
       o_orderdate admission_datetime,
       case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'IP' else 'OP' end encounter_type,
       case o_orderstatus when 'F' then 'DISCHARGED' when 'O' then 'ACTIVE' else 'PENDING_DISCHARGE' end status,
       case when o_orderstatus = 'F' then cast(o_orderkey % 15 as double) + 0.5e0 end los_days,
       case when o_orderkey % 7 = 0 then null else cast(3 + o_orderkey % 5 as double) end drg_benchmark_los,
       concat('DRG', cast(o_orderkey % 40 as string)) drg_code,
       case when o_orderkey % 3 = 0 then 'SNF' else 'LAB' end discharge_planning_status
from orders""",
    "claims": """
select concat(cast(l_orderkey as string), '-', cast(l_linenumber as string), '-', cast(l_partkey as string)) claim_id,
       concat('E', cast(l_orderkey as string)) encounter_id,
       concat('Y', cast(l_suppkey as string)) payer_id,
       concat('Y', cast(l_suppkey as string), '-', l_returnflag) contract_id,
       case when l_orderkey % 1009 = 0 then null else l_shipdate end submission_datetime,
       cast(l_shipdate as date) service_date_start,
       case when l_returnflag = 'R' then 'DENIED' else 'PAID' end claim_status,
       case when l_returnflag = 'R' then case l_linenumber % 3 when 0 then 'CO-197' when 1 then 'CO-50'
            else 'CO-29' end end denial_code,
       case when l_linenumber % 2 = 0 then 'NOT_APPEALED' end appeal_status,
       case when l_returnflag = 'R' and l_linenumber % 4 <> 0
            then cast(cast(l_shipdate as date) + 20 as timestamp) end denial_datetime,
       cast(l_extendedprice as decimal(18,2)) total_billed_amount,
       cast(cast(l_extendedprice as decimal(12,2)) * (1 - cast(l_discount as decimal(4,2))) as decimal(18,2)) total_allowed_amount,
       cast(cast(l_extendedprice as decimal(12,2))
            * (1 - cast(l_discount as decimal(4,2)) - cast(l_tax as decimal(4,2))) as decimal(18,2)) total_paid_amount,
       concat('Payer ', cast(l_suppkey as string)) payer_name,
       concat('DRG', cast(l_partkey % 40 as string)) drg_code,
       concat('CPT', cast(l_linenumber as string)) cpt_code
from lineitem""",
    "appeals_history": """
select concat('A', cast(o_orderkey as string)) appeal_id,
       concat('Y', cast(cast(floor(o_custkey / 15) as bigint) as string)) payer_id,
       case when o_orderstatus <> 'P' then o_orderdate end decision_datetime,
       case o_orderkey % 5 when 0 then 'WON' when 1 then 'PARTIAL_WON' when 2 then 'LOST' else 'PENDING' end outcome,
       case when o_orderkey % 5 < 2 then cast(o_totalprice as decimal(18,2)) end recovered_amount
from orders""",
    "workforce_shifts": """
select concat('F', cast(l_suppkey % 25 as string)) facility_id,
       case l_linenumber % 4 when 0 then 'RN' when 1 then 'CNA' when 2 then 'RT' else 'MD' end associate_role,
       cast(l_shipdate as date) shift_date, l_returnflag = 'A' is_agency,
       12.0e0 scheduled_hours, l_quantity / 4 worked_hours,
       case when l_quantity > 40 then 2.5e0 else 0.0e0 end overtime_hours,
       cast(40 + 100 * l_discount as decimal(18,2)) hourly_cost,
       cast(l_partkey % 30 as int) patient_census
from lineitem""",
    "charges": """
select concat('E', cast(l_orderkey as string)) encounter_id,
       cast(cast(l_shipdate as date) as timestamp) charge_datetime,
       concat('CPT', cast(l_linenumber as string)) cpt_code,
       cast(l_quantity as decimal(18,2)) billed_amount,
       case when l_returnflag = 'N' then 'VOIDED' else 'POSTED' end status,
       concat('H', cast(l_orderkey as string), '-', cast(l_linenumber as string), '-', cast(l_partkey as string)) charge_id
from lineitem""",
    "supply_chain_transactions": """
select concat('F', cast(l_suppkey % 25 as string)) facility_id,
       case when l_partkey % 2 = 0 then 'IMPLANT' else 'SUPPLY' end item_category,
       l_shipdate transaction_datetime,
       case l_linenumber % 4 when 0 then 'PO_RECEIPT' when 1 then 'ISSUE_TO_CASE' when 2 then 'RETURN'
            else 'WASTE' end transaction_type,
       l_quantity quantity, cast(l_extendedprice as decimal(18,2)) extended_cost,
       l_tax > 0.05 is_off_contract
from lineitem""",
    "prior_authorizations": """
select concat('E', cast(o_orderkey as string)) encounter_id, o_orderdate requested_datetime,
       case o_orderkey % 3 when 0 then o_orderdate + interval '90' minute
            when 1 then o_orderdate + interval '1559' minute end decision_datetime,
       case o_orderkey % 4 when 0 then 'DENIED' when 1 then 'NOT_OBTAINED' else 'APPROVED' end auth_status
from orders""",
    "it_vendors": """
select concat('V', cast(n_nationkey as string)) vendor_id, n_name vendor_name,
       case when n_nationkey % 2 = 0 then 'CLOUD' else 'EHR' end category,
       n_nationkey % 3 = 0 is_strategic,
       date '2001-03-01' + cast(n_nationkey * 20 as int) msa_renewal_date,
       cast(100000 * (n_nationkey + 1) as decimal(18,2)) annual_spend
from nation""",
    "it_systems": """
select concat('S', cast(s_suppkey as string)) system_id, concat('V', cast(s_nationkey as string)) vendor_id,
       s_name system_name, 'EHR' category,
       case when s_suppkey % 11 = 3 then concat('CU', cast(s_suppkey as string))
            else concat('C', cast(s_suppkey % 7 as string)) end capability,
       case s_suppkey % 4 when 0 then 'TIER1_LIFE_SAFETY' when 1 then 'TIER2' when 2 then 'TIER1_OTHER'
            else 'TIER4' end criticality,
       'SAAS' hosting, 'EPIC' emr_affinity,
       case when s_suppkey % 5 = 0 then null else concat('F', cast(s_nationkey as string)) end owning_facility_id,
       date '1995-01-01' go_live_date,
       case when s_suppkey % 6 = 0 then null
            else date '2000-06-01' + cast((s_suppkey * 53) % 1200 as int) end end_of_life_date,
       cast(s_acctbal * 300 as decimal(18,2)) annual_cost
from supplier""",
    "it_assets": """
select concat('A', cast(p_partkey as string)) asset_id, p_type asset_type,
       concat('F', cast(p_partkey % 25 as string)) facility_id,
       concat('D', cast(p_partkey % 25 as string)) department_id,
       concat('S', cast(cast(floor(p_partkey / 20) as bigint) as string)) system_id,
       concat('V', cast(p_partkey % 25 as string)) vendor_id,
       'LINUX' os_family, p_brand os_version, p_size > 40 is_end_of_life,
       case when p_partkey % 13 = 0 then null
            else date '2001-06-04' - cast(p_partkey % 250 as int) end last_patched_date
from part""",
    "it_vulnerabilities": """
select concat(cast(l_orderkey as string), '-', cast(l_linenumber as string), '-', cast(l_partkey as string)) finding_id,
       concat('A', cast(l_partkey as string)) asset_id, concat('S', cast(l_suppkey as string)) system_id,
       case when l_orderkey % 101 = 0 then null else concat('F', cast(l_suppkey % 25 as string)) end facility_id,
       concat('CVE-', cast(l_partkey as string)) cve,
       case l_linenumber % 4 when 0 then 'CRITICAL' when 1 then 'HIGH' when 2 then 'MEDIUM' else 'LOW' end severity,
       cast(l_shipdate as date) detected_date,
       case when l_linestatus = 'F' then cast(l_shipdate as date) + cast(l_quantity as int) end patched_date,
       case when l_orderkey % 17 = 0 then null else cast(l_quantity as int) end days_open,
       case when l_returnflag = 'N' then null else l_quantity > 30 end sla_breached
from lineitem""",
    "it_incidents": """
select concat('I', cast(o_orderkey as string)) incident_id,
       case when o_orderkey % 31 = 0 then null else concat('S', cast(cast(floor(o_custkey / 15) as bigint) as string)) end system_id,
       case when o_orderkey % 6 = 0 then null else concat('F', cast(o_custkey % 25 as string)) end facility_id,
       case o_orderkey % 4 when 0 then 'SEV1' when 1 then 'SEV2' when 2 then 'SEV3' else 'SEV4' end severity,
       o_orderdate opened_at,
       case when o_orderstatus <> 'O' then o_orderdate + interval '6' hour end resolved_at,
       case when o_orderstatus = 'P' and o_orderkey % 9 = 0 then null
            else cast(floor(o_totalprice / 100) as int) end duration_minutes,
       o_orderkey % 3 = 0 is_clinical_downtime,
       case when o_orderkey % 5 = 0 then 'CHANGE' else 'HARDWARE' end root_cause
from orders""",
    "it_cost_ledger": """
select concat(cast(l_orderkey as string), '-', cast(l_linenumber as string), '-', cast(l_partkey as string)) cost_id,
       cast(date_trunc('month', l_shipdate) as date) period,
       concat('S', cast(l_suppkey as string)) system_id,
       case when l_partkey % 9 = 0 then null else concat('V', cast(l_suppkey % 25 as string)) end vendor_id,
       case when l_partkey % 4 = 0 then null else concat('F', cast(l_suppkey % 25 as string)) end facility_id,
       case l_linenumber % 6 when 0 then 'LICENSE' when 1 then 'CLOUD' when 2 then 'LABOR' when 3 then 'HARDWARE'
            when 4 then 'SUPPORT' else 'TELECOM' end cost_category,
       cast(l_extendedprice as decimal(18,2)) amount,
       case when l_linenumber % 6 = 1 and l_partkey % 8 <> 0 then l_discount * 4 end cloud_idle_pct
from lineitem""",
    "it_change_requests": """
select concat('G', cast(o_orderkey as string)) change_id,
       case when o_orderkey % 4 = 0 then null else concat('F', cast(o_custkey % 25 as string)) end facility_id,
       case o_orderkey % 5 when 0 then 'EMERGENCY' when 1 then 'STANDARD' else 'NORMAL' end change_type,
       o_orderdate scheduled_at,
       case when o_orderstatus <> 'P' then o_orderdate + interval '125' minute end implemented_at,
       case o_orderkey % 7 when 0 then 'FAILED' when 1 then 'ROLLED_BACK' else 'SUCCESS' end status,
       o_orderkey % 11 = 0 caused_incident
from orders""",
    "service_desk_tickets": """
select case when o_orderkey % 50 = 0 then null else concat('F', cast(o_custkey % 25 as string)) end facility_id,
       case o_orderkey % 4 when 0 then 'PHONE' when 1 then 'PORTAL' when 2 then 'SELF_SERVICE' else 'WALKUP' end channel,
       o_orderdate opened_at,
       case when o_orderstatus <> 'P' then o_orderdate + interval '3' hour end resolved_at,
       case when o_orderstatus <> 'P' then cast(floor(o_totalprice / 1000) as int) end resolution_minutes,
       o_orderkey % 4 = 2 is_self_service, o_orderkey % 8 = 0 reopened
from orders""",
    "clinician_ehr_usage": """
select concat('N', cast(cast(floor(o_custkey / 3) as bigint) as string)) provider_npi,
       concat('F', cast(o_custkey % 25 as string)) facility_id,
       concat('D', cast(o_custkey % 25 as string)) department_id,
       cast(date_trunc('month', o_orderdate) as date) period,
       cast(floor(o_totalprice / 100) as int) total_ehr_minutes,
       cast(floor(o_totalprice / 700) as int) after_hours_minutes,
       cast(o_orderkey % 90 as int) inbasket_messages,
       cast(o_orderkey % 40 as double) / 4 avg_login_seconds
from orders""",
    "ai_tool_usage": """
select concat('N', cast(cast(floor(o_custkey / 3) as bigint) as string)) provider_npi,
       concat('F', cast(o_custkey % 25 as string)) facility_id,
       concat('D', cast(o_custkey % 20 as string)) department_id,
       cast(date_trunc('month', o_orderdate) as date) period,
       cast(o_orderkey % 12 as int) sessions, cast(o_orderkey % 300 as int) minutes_saved,
       o_orderkey % 3 <> 0 is_governed
from orders""",
    "bed_management": """
select case when o_orderkey % 89 = 0 then null else concat('F', cast(o_custkey % 25 as string)) end facility_id,
       o_orderdate assigned_datetime,
       case when o_orderkey % 3 = 0 then cast(o_orderkey % 48 as double) / 4 end ed_boarding_hours,
       o_orderkey % 10 = 0 is_blocked
from orders""",
    "appointments_scheduling": """
select concat('F', cast(o_custkey % 25 as string)) facility_id, o_orderdate scheduled_datetime,
       case when o_orderkey % 9 = 0 then 'NO_SHOW' else 'COMPLETED' end status,
       o_orderkey % 4 = 0 is_new_patient
from orders""",
    "referrals": """
select concat('M', cast(o_custkey as string)) master_patient_id,
       case when o_orderkey % 211 = 0 then null else cast(o_orderdate as date) end created_date,
       case when o_orderkey % 19 = 0 then null else o_orderkey % 5 <> 0 end is_in_network
from orders""",
    # The hospital's clinical orders; named orders_raw to keep clear of the test table.
    "orders_raw": """
select concat('E', cast(l_orderkey as string)) encounter_id, l_shipdate order_datetime,
       case l_linenumber % 4 when 0 then 'IMAGING' when 1 then 'LAB' when 2 then 'IV_ADMIN'
            else 'PROCEDURE' end order_type,
       concat('O', cast(l_orderkey as string), '-', cast(l_linenumber as string), '-', cast(l_partkey as string)) order_id,
       case when l_linenumber % 6 = 5 then 'CANCELLED' else 'COMPLETED' end status,
       case when l_linenumber % 6 <> 5
            then cast(cast(l_shipdate as date) - cast(l_partkey % 9 as int) as timestamp) end completion_datetime
from lineitem""",
    "quality_safety_events": """
select concat('F', cast(l_suppkey % 25 as string)) facility_id, l_shipdate event_datetime,
       case l_linenumber % 5 when 0 then 'DEATH' when 1 then 'SEVERE' when 2 then 'MODERATE' else 'NO_HARM' end severity,
       case when l_partkey % 3 = 0 then 'READMISSION_30D' else 'FALL' end event_type,
       case when l_partkey % 7 = 0 then null else l_partkey % 2 = 0 end is_preventable
from lineitem""",
    "cdi_queries": """
select concat('E', cast(l_orderkey as string)) encounter_id, l_shipdate created_datetime,
       case l_linenumber % 4 when 0 then 'ANSWERED' when 1 then 'AGREED' when 2 then 'DISAGREED'
            else 'NO_RESPONSE' end query_status,
       case when l_linenumber % 4 = 3 then null else cast(l_quantity * 100 as decimal(18,2)) end financial_impact
from lineitem""",
    "care_management": """
select concat('E', cast(l_orderkey as string)) encounter_id, l_shipdate created_datetime,
       case when l_linenumber % 2 = 0 then 'SNF_PLACEMENT_REQUEST' else 'DISCHARGE_PLAN' end task_type,
       case when l_partkey % 6 = 0 then null when l_partkey % 3 = 0 then 'NOT_STARTED'
            else 'IN_PROGRESS' end task_status
from lineitem""",
}


def base_frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The driver's parquet tables by name."""
    return {name: spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet") for name in BASE_TABLES}


def binding_frame(spark: SparkSession, name: str, base: dict[str, DataFrame]) -> DataFrame:
    """One raw table; the test tables are bound as arguments, not as views of the session."""
    text = re.sub(r"\b(from|join) (\w+)", r"\1 {\2}", BINDINGS[name])
    used = set(re.findall(r"\{(\w+)\}", text))
    return spark.sql(text, **{n: base[n] for n in used})


def fingerprint(spark: SparkSession, sf_dir: str) -> str:
    """Digest of the names, sizes and times of the test tables' files."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(sf_dir)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    for name in BASE_TABLES:
        listed = files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(folder, f"{name}.parquet*"))
        for status in listed:
            inner = files.listStatus(status.getPath()) if status.isDirectory() else [status]
            found += [(str(x.getPath()), x.getLen(), x.getModificationTime()) for x in inner]
    return hashlib.sha256(repr(sorted(found)).encode()).hexdigest()[:16]
