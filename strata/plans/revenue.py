"""Revenue-cycle jobs: monthly fact, payer and contract dimensions, worklists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (as_of_lit, count_where, days_between, month_of, safe_ratio,
                         strict_least, sum_where, ttm_window, zero_money)
from ..sources import RawTables
from .params import DEFAULT_AS_OF

# Fixed values of the revenue-cycle rules.
UNDERPAYMENT_TOLERANCE = 0.95          # paid below 95% of allowed is underpaid
APPEAL_DEADLINE_HORIZON_DAYS = 15      # appeal deadline 0..15 days after as_of
DECIDED_OUTCOMES = ("WON", "PARTIAL_WON", "LOST")
WON_OUTCOMES = ("WON", "PARTIAL_WON")
EMPI_CONFIDENCE_THRESHOLD = 0.85
EXPIRY_HORIZON_DAYS = 90
# Records of one side that meet in one part of a duplicate-pair block (tuning, not semantics).
PART_ROWS = 4096


def _underpaid(c) -> "F.Column":
    return (c["claim_status"] == "PAID") & (
        c["total_paid_amount"] < c["total_allowed_amount"] * F.lit(UNDERPAYMENT_TOLERANCE).cast("decimal(3,2)"))


def fact_revenue_cycle_month(raw: RawTables, as_of=DEFAULT_AS_OF) -> DataFrame:
    """month x payer x contract claim measures, plus month x payer appeal rows (contract NULL)."""
    claims = raw.claims
    contracts = raw.payer_contracts.select(F.col("contract_id").alias("_contract"), "appeal_window_days")
    # claims without a contract are many: they match nothing, spread over keys of their own
    meets = F.coalesce("contract_id", F.concat(F.lit("\u0000"), "claim_id"))
    c = claims.withColumn("_contract", meets).join(contracts, "_contract", "left")
    deadline = F.date_add(F.to_date(c["denial_datetime"]), c["appeal_window_days"])
    at_risk = ((c["claim_status"] == "DENIED")
               & (c["appeal_status"].isNull() | (c["appeal_status"] == "NOT_APPEALED"))
               & c["denial_datetime"].isNotNull()
               & days_between(deadline, as_of_lit(as_of)).between(0, APPEAL_DEADLINE_HORIZON_DAYS))
    denied = c["claim_status"] == "DENIED"
    # The name is a key of the large pass, which so is a hash aggregate over
    # numbers; the few rows per (month, payer, contract) are joined after it.
    sums = {"total_claims": F.count(F.lit(1)),
            "total_billed": F.sum("total_billed_amount"),
            "total_allowed": F.sum("total_allowed_amount"),
            "total_paid": F.sum("total_paid_amount"),
            "denied_claims": count_where(denied),
            "denied_billed": sum_where(denied, "total_billed_amount", zero_money()),
            "underpayment_dollars": sum_where(_underpaid(c), c["total_allowed_amount"] - c["total_paid_amount"], zero_money()),
            "timely_filing_at_risk": count_where(at_risk)}
    claim_rows = (
        c.groupBy(month_of("submission_datetime").alias("month"), "payer_id", "contract_id", "payer_name")
        .agg(*[x.alias(n) for n, x in sums.items()])
        .groupBy("month", "payer_id", "contract_id")
        .agg(F.max("payer_name").alias("payer_name"), *[F.sum(n).alias(n) for n in sums])
        .select("month", "payer_id", "payer_name", "contract_id", "total_claims", "total_billed",
                "total_allowed", "total_paid", "denied_claims", "denied_billed",
                "underpayment_dollars", "timely_filing_at_risk",
                F.lit(0).cast("bigint").alias("appeals_decided"),
                F.lit(0).cast("bigint").alias("appeals_won"),
                zero_money().alias("recovered_amount")))

    # Appeals: aggregate first, then attach the payer name (payer_id is the
    # payers key, so the name is constant per group).
    appeals = raw.appeals_history.filter(F.col("decision_datetime").isNotNull())
    appeal_agg = (appeals.groupBy(month_of("decision_datetime").alias("month"), "payer_id")
                  .agg(count_where(F.col("outcome").isin(*DECIDED_OUTCOMES)).alias("appeals_decided"),
                       count_where(F.col("outcome").isin(*WON_OUTCOMES)).alias("appeals_won"),
                       F.sum("recovered_amount").alias("recovered_amount")))
    payers = raw.payers.select("payer_id", "payer_name")
    appeal_rows = (appeal_agg.join(payers, "payer_id", "left")
                   .select("month", "payer_id", "payer_name",
                           F.lit(None).cast("string").alias("contract_id"),
                           F.lit(0).cast("bigint").alias("total_claims"),
                           zero_money().alias("total_billed"),
                           zero_money().alias("total_allowed"),
                           zero_money().alias("total_paid"),
                           F.lit(0).cast("bigint").alias("denied_claims"),
                           zero_money().alias("denied_billed"),
                           zero_money().alias("underpayment_dollars"),
                           F.lit(0).cast("bigint").alias("timely_filing_at_risk"),
                           "appeals_decided", "appeals_won", "recovered_amount"))
    return claim_rows.unionByName(appeal_rows)


def dim_payer(raw: RawTables, as_of=DEFAULT_AS_OF) -> DataFrame:
    claims = raw.claims.filter(ttm_window("submission_datetime", as_of))
    ttm = claims.groupBy("payer_id").agg(
        F.count(F.lit(1)).alias("total_claims_ttm"),
        count_where(F.col("claim_status") == "DENIED").alias("denied_claims_ttm"),
        F.sum("total_billed_amount").alias("billed_ttm"),
        F.sum("total_allowed_amount").alias("allowed_ttm"),
        F.sum("total_paid_amount").alias("paid_ttm"))
    ct = raw.payer_contracts.groupBy("payer_id").agg(
        F.count(F.lit(1)).alias("contract_versions"),
        F.avg("baseline_multiplier").alias("avg_baseline_multiplier"),
        F.min("expiration_date").alias("earliest_expiration"))
    p = raw.payers.join(ct, "payer_id", "left").join(ttm, "payer_id", "left")
    return p.select(
        "payer_id", "payer_name", "payer_type",
        F.coalesce("contract_versions", F.lit(0)).alias("contract_versions"),
        "avg_baseline_multiplier", "earliest_expiration",
        F.coalesce("total_claims_ttm", F.lit(0)).alias("total_claims_ttm"),
        safe_ratio("denied_claims_ttm", "total_claims_ttm").alias("denial_rate_ttm"),
        safe_ratio("paid_ttm", "allowed_ttm").alias("contract_yield_ttm"),
        "billed_ttm", "paid_ttm")


def dim_contract(raw: RawTables, as_of=DEFAULT_AS_OF) -> DataFrame:
    clm = (raw.claims.filter(ttm_window("submission_datetime", as_of))
           .groupBy("contract_id")
           .agg(F.count(F.lit(1)).alias("claims_ttm"), F.sum("total_billed_amount").alias("billed_ttm")))
    pc = raw.payer_contracts
    out = (pc.join(raw.payers.select("payer_id", "payer_name"), "payer_id", "left")
           .join(clm, "contract_id", "left"))
    return out.select(
        "contract_id", "payer_id", "payer_name", "plan_subtype", "reimbursement_methodology",
        "baseline_multiplier", "effective_date", "expiration_date", "appeal_window_days",
        "timely_filing_days",
        days_between("expiration_date", as_of_lit(as_of)).alias("days_to_expiry"),
        F.coalesce("claims_ttm", F.lit(0)).alias("claims_ttm"), "billed_ttm")


def worklist_underpayments(raw: RawTables, as_of=DEFAULT_AS_OF) -> DataFrame:
    c = raw.claims
    under = c.filter(_underpaid(c))
    out = under.join(raw.payer_contracts.select("contract_id", "plan_subtype"), "contract_id", "left")
    variance = F.col("total_allowed_amount") - F.col("total_paid_amount")
    return out.select(
        "claim_id", "payer_id", "payer_name", "contract_id", "plan_subtype", "drg_code", "cpt_code",
        "service_date_start", "total_billed_amount", "total_allowed_amount", "total_paid_amount",
        variance.alias("underpayment_variance"),
        safe_ratio(variance, "total_allowed_amount").alias("underpayment_pct"))


def worklist_expiring_contracts(raw: RawTables, as_of=DEFAULT_AS_OF) -> DataFrame:
    """Contracts expiring within 90 days, or expired and still billed after expiry.

    Claims are reduced to one row per contract before meeting the contract
    attributes: the join that fans contracts out to claims only carries the
    contract key and expiry date, and the aggregate runs before the
    descriptive joins.
    """
    pc = raw.payer_contracts.filter(
        F.col("expiration_date").isNotNull()
        & (F.col("expiration_date") <= F.date_add(as_of_lit(as_of), EXPIRY_HORIZON_DAYS)))
    keys = pc.select("contract_id", F.col("expiration_date").alias("_exp"))
    c = raw.claims.select("contract_id", "claim_id", "service_date_start", "total_billed_amount")
    after = F.col("service_date_start") > F.col("_exp")
    per_contract = (c.join(keys, "contract_id", "inner")
                    .groupBy("contract_id")
                    .agg(F.count("claim_id").alias("claims_total"),
                         count_where(after).alias("claims_after_expiry"),
                         sum_where(after, "total_billed_amount", zero_money()).alias("dollars_billed_after_expiry")))
    out = (pc.join(raw.payers.select("payer_id", "payer_name"), "payer_id", "left")
           .join(per_contract, "contract_id", "left")
           .select("contract_id", "payer_id", "payer_name", "plan_subtype", "effective_date",
                   "expiration_date",
                   days_between("expiration_date", as_of_lit(as_of)).alias("days_to_expiry"),
                   F.coalesce("claims_total", F.lit(0)).alias("claims_total"),
                   F.coalesce("claims_after_expiry", F.lit(0)).alias("claims_after_expiry"),
                   F.coalesce("dollars_billed_after_expiry", zero_money()).alias("dollars_billed_after_expiry")))
    return out.filter((F.col("claims_after_expiry") > 0)
                      | F.col("days_to_expiry").between(0, EXPIRY_HORIZON_DAYS))


def worklist_empi_duplicate_pairs(raw: RawTables, as_of=DEFAULT_AS_OF, part_rows: int = PART_ROWS) -> DataFrame:
    """Patient pairs sharing a name hash where at least one side is low-confidence.

    Only pairs that can qualify are generated: every low-confidence record is
    joined to the records of its block, so high/high pairs (never output) are
    never built. A low/low pair is met from both sides and kept once (the side
    with the smaller id drives it).

    Every block is split the same way: its records are counted, its
    low-confidence side is spread over ``ceil(records / part_rows)`` parts and
    its other side is repeated for each part, so a block's pairs come from as
    many tasks as its size asks for. Every qualifying pair is emitted.
    """
    pmi = raw.patient_master_index.select(
        "master_patient_id", "name_hash", "match_confidence_score", "primary_facility_id").filter(
        F.col("name_hash").isNotNull())
    parts = pmi.groupBy("name_hash").agg(F.ceil(F.count(F.lit(1)) / part_rows).cast("int").alias("_parts"))
    tagged = pmi.join(parts, "name_hash")
    low = tagged.filter(F.col("match_confidence_score") < EMPI_CONFIDENCE_THRESHOLD).select(
        F.col("master_patient_id").alias("l_id"), F.col("name_hash").alias("l_hash"),
        F.col("match_confidence_score").alias("l_conf"), F.col("primary_facility_id").alias("l_fac"),
        F.pmod(F.xxhash64("master_patient_id"), F.col("_parts")).cast("int").alias("l_salt"))
    other = tagged.select(
        F.col("master_patient_id").alias("o_id"), F.col("name_hash").alias("o_hash"),
        F.col("match_confidence_score").alias("o_conf"), F.col("primary_facility_id").alias("o_fac"),
        F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("o_salt"))
    other_low = F.coalesce(F.col("o_conf") < EMPI_CONFIDENCE_THRESHOLD, F.lit(False))
    pairs = low.join(other, (F.col("l_hash") == F.col("o_hash")) & (F.col("l_salt") == F.col("o_salt"))
                     & (F.col("l_id") != F.col("o_id"))
                     & (~other_low | (F.col("l_id") < F.col("o_id"))), "inner")
    l_first = F.col("l_id") < F.col("o_id")

    def pick(a, b):
        return F.when(l_first, F.col(a)).otherwise(F.col(b))

    return pairs.select(
        pick("l_id", "o_id").alias("master_patient_id_a"),
        pick("o_id", "l_id").alias("master_patient_id_b"),
        F.col("l_hash").alias("name_hash"),
        pick("l_conf", "o_conf").alias("confidence_a"),
        pick("o_conf", "l_conf").alias("confidence_b"),
        pick("l_fac", "o_fac").alias("facility_a"),
        pick("o_fac", "l_fac").alias("facility_b"),
        strict_least("l_conf", "o_conf").alias("min_confidence"))
