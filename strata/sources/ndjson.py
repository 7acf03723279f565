"""Landing of the raw operational tables from gzip NDJSON exports.

Each raw table is read with an explicit schema (fields not in the schema are
dropped, missing ones become NULL: the ``ignore unknown values`` load
behaviour) and written as parquet with full overwrite (``replace``). Spark
reads gzip files whole (gzip is not splittable), so a table should arrive as
many moderately sized files; the landing job then rewrites it as splittable
parquet for every downstream job.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Raw schemas of the tables the jobs read (union of the documented curated
# columns and the columns the jobs use). Money is decimal(18,2), timestamps UTC.
RAW_SCHEMAS: dict[str, str] = {
    "facilities": "facility_id string, facility_name string, region string, acquired_date date, "
                  "primary_emr string, is_legacy boolean, bed_capacity bigint",
    "departments": "department_id string, facility_id string, department_type string, cost_center_code string, "
                   "service_line string",
    "providers": "provider_sk string, provider_npi string, primary_facility_id string, specialty string, "
                 "is_current boolean, documentation_quality_flag string, legacy_provider_id_list array<string>, "
                 "provider_name_hash string, department_id string, credentialing_status string",
    "payers": "payer_id string, payer_name string, payer_type string",
    "payer_contracts": "contract_id string, payer_id string, plan_subtype string, effective_date date, "
                       "expiration_date date, appeal_window_days bigint, timely_filing_days bigint, "
                       "baseline_multiplier double, amendment_history array<string>, "
                       "reimbursement_methodology string",
    "contract_amendments": "contract_id string, version_no bigint, effective_date date, expiration_date date, "
                           "baseline_multiplier double",
    "denial_codex": "codex_id string, payer_id string, denial_code string, typical_root_cause string, "
                    "confidence string, source string",
    "tribal_knowledge_notes": "note_id string, topic_tag string, author_name string, confidence string, "
                              "last_referenced_date date, referenced_codes array<string>",
    "patient_master_index": "master_patient_id string, epic_mrn string, cerner_pid string, meditech_id string, "
                            "legacy_mrn_list array<string>, name_hash string, match_confidence_score double, "
                            "primary_facility_id string",
    "encounters": "encounter_id string, source_system string, master_patient_id string, facility_id string, "
                  "attending_provider_npi string, admission_datetime timestamp, los_days double, "
                  "drg_benchmark_los double, discharge_planning_status string, status string, "
                  "encounter_type string, drg_code string",
    "orders": "order_id string, encounter_id string, ordering_provider_npi string, order_type string, "
              "cpt_code string, status string, completion_datetime timestamp, order_datetime timestamp",
    "charges": "charge_id string, encounter_id string, order_id string, cpt_code string, modifier string, "
               "billed_amount decimal(18,2), allowed_amount decimal(18,2), status string, charge_datetime timestamp",
    "claims": "claim_id string, encounter_id string, master_patient_id string, payer_id string, contract_id string, "
              "cpt_code string, submission_datetime timestamp, denial_datetime timestamp, claim_status string, "
              "denial_code string, appeal_status string, total_allowed_amount decimal(18,2), "
              "total_paid_amount decimal(18,2), total_billed_amount decimal(18,2), payer_name string, "
              "drg_code string, service_date_start date",
    "appeals_history": "appeal_id string, claim_id string, payer_id string, cpt_code string, denial_code string, "
                       "submitted_datetime timestamp, outcome string, recovered_amount decimal(18,2), "
                       "key_argument_text string, decision_datetime timestamp",
    "bed_management": "bed_event_id string, encounter_id string, facility_id string, bed_type string, "
                      "ed_boarding_hours double, is_blocked boolean, assigned_datetime timestamp",
    "care_management": "cm_task_id string, encounter_id string, task_type string, task_status string, "
                       "barrier_type string, created_datetime timestamp",
    "prior_authorizations": "auth_id string, encounter_id string, payer_id string, cpt_code string, "
                            "auth_status string, requested_datetime timestamp, decision_datetime timestamp",
    "referrals": "referral_id string, master_patient_id string, referred_to_facility_id string, "
                 "referred_to_specialty string, is_in_network boolean, status string, created_date date",
    "appointments_scheduling": "appointment_id string, facility_id string, referral_id string, "
                               "linked_encounter_id string, status string, scheduled_datetime timestamp, "
                               "is_new_patient boolean",
    "cdi_queries": "query_id string, encounter_id string, provider_npi string, query_status string, "
                   "drg_impact string, financial_impact decimal(18,2), created_datetime timestamp",
    "workforce_shifts": "shift_id string, facility_id string, department_id string, associate_role string, "
                        "is_agency boolean, overtime_hours double, patient_census bigint, shift_date date, "
                        "scheduled_hours double, worked_hours double, hourly_cost decimal(18,2)",
    "supply_chain_transactions": "supply_txn_id string, facility_id string, encounter_id string, "
                                 "item_category string, unit_cost decimal(18,2), is_off_contract boolean, "
                                 "transaction_datetime timestamp, transaction_type string, quantity double, "
                                 "extended_cost decimal(18,2)",
    "quality_safety_events": "event_id string, encounter_id string, facility_id string, event_type string, "
                             "severity string, is_preventable boolean, event_datetime timestamp",
    "it_vendors": "vendor_id string, vendor_name string, category string, is_strategic boolean, "
                  "msa_renewal_date date, annual_spend decimal(18,2)",
    "it_systems": "system_id string, vendor_id string, system_name string, category string, capability string, "
                  "criticality string, hosting string, emr_affinity string, owning_facility_id string, "
                  "go_live_date date, end_of_life_date date, annual_cost decimal(18,2)",
    "it_assets": "asset_id string, asset_type string, facility_id string, department_id string, system_id string, "
                 "vendor_id string, os_family string, os_version string, is_end_of_life boolean, "
                 "last_patched_date date",
    "it_change_requests": "change_id string, system_id string, facility_id string, change_type string, "
                          "scheduled_at timestamp, implemented_at timestamp, status string, caused_incident boolean",
    "it_incidents": "incident_id string, system_id string, facility_id string, department_id string, "
                    "change_id string, severity string, category string, opened_at timestamp, "
                    "resolved_at timestamp, duration_minutes bigint, is_clinical_downtime boolean, root_cause string",
    "it_vulnerabilities": "finding_id string, asset_id string, system_id string, facility_id string, cve string, "
                          "severity string, detected_date date, patched_date date, days_open bigint, "
                          "sla_breached boolean",
    "it_cost_ledger": "cost_id string, period date, system_id string, vendor_id string, facility_id string, "
                      "cost_category string, amount decimal(18,2), cloud_idle_pct double",
    "service_desk_tickets": "ticket_id string, system_id string, facility_id string, department_id string, "
                            "associate_id string, category string, channel string, opened_at timestamp, "
                            "resolved_at timestamp, resolution_minutes bigint, is_self_service boolean, "
                            "reopened boolean",
    "clinician_ehr_usage": "usage_id string, provider_npi string, facility_id string, department_id string, "
                           "system_id string, period date, total_ehr_minutes bigint, after_hours_minutes bigint, "
                           "inbasket_messages bigint, avg_login_seconds double",
    "ai_tool_usage": "usage_id string, tool_name string, vendor_id string, provider_npi string, facility_id string, "
                     "department_id string, period date, sessions bigint, minutes_saved bigint, "
                     "is_governed boolean",
}


def read_ndjson(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Read one raw table's NDJSON (plain or .gz) with its declared schema; a broken line stops the load."""
    return (spark.read.schema(RAW_SCHEMAS[table])
            .option("mode", "FAILFAST")
            .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]")
            .json(path))


def land_raw(spark: SparkSession, src_dir: str, dst_dir: str, tables=None) -> dict[str, int]:
    """Load ``<src_dir>/<table>*.ndjson[.gz]`` into ``<dst_dir>/<table>`` parquet, replacing it."""
    counts = {}
    for table in tables or RAW_SCHEMAS:
        pattern = os.path.join(src_dir, f"{table}*.ndjson*")
        loaded = Observation(f"load {table}")
        df = read_ndjson(spark, pattern, table).observe(loaded, F.count(F.lit(1)).alias("rows"))
        df.write.mode("overwrite").parquet(os.path.join(dst_dir, table))
        counts[table] = loaded.get["rows"]
    return counts
