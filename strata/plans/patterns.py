"""Reads for the documented patterns that have no job of their own.

Each takes the layer and returns one row a line of work. Hot keys (one
encounter, contract, identifier or provider with a large share of all rows) are
split by the scans of ``operators.scan`` and the joins of ``operators.components``.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import as_of_lit, count_where, days_between, exact_sum, month_boundaries, month_of, safe_ratio
from ..operators.components import components, spread_join
from ..operators.scan import ordered
from ..session import checkpoint_dir
from ..sources.sinks import materialise, write_bucketed

# Fixed values of the patterns.
SPAN_HOURS = 72                       # lines of one key closer than this belong to one session
HALF_LIFE_MONTHS = 6.0                # a reference to a code counts half after this time
NOTE_WEIGHTS = {"HIGH": 1.0, "MEDIUM": 0.5, "STALE": 0.25}
QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


IDENTIFIERS = {"EPIC": "epic_mrn", "CERNER": "cerner_pid", "MEDITECH": "meditech_id"}


def _listed(df: DataFrame, column: str):
    """A list column: an array in the raw layer, comma-joined in the test bindings."""
    return F.split(column, ",") if df.schema[column].dataType.typeName() == "string" else F.col(column)


# ----------------------------------------------------------------- charge gap
def charge_gap(layer) -> DataFrame:
    """Every completed order with the posted charge that pays for it, or none.

    Charges of an encounter are used once each, in time order: a charge goes to the
    earliest completed order still waiting at that time (order before charge at the same
    time, then by id), and to none if no order waits. With O orders and C charges so far,
    the lowest value of O - C below zero counts the charges that found none, so the k-th
    order meets the k-th charge that found one. Orders without an encounter or whose
    encounter has no charge left have none; charges without encounter or time pay for none.
    """
    raw = layer.raw
    orders = raw.orders_raw.where((F.col("status") == "COMPLETED") & F.col("completion_datetime").isNotNull()).select(
        "encounter_id", F.col("completion_datetime").alias("at"), F.lit(0).alias("kind"), F.col("order_id").alias("id"))
    charges = raw.charges.where((F.col("status") == "POSTED") & F.col("encounter_id").isNotNull()
                                & F.col("charge_datetime").isNotNull()).select(
        "encounter_id", F.col("charge_datetime").alias("at"), F.lit(1).alias("kind"), F.col("charge_id").alias("id"))
    events = orders.unionByName(charges).withColumns({"opened": 1 - F.col("kind"), "charged": F.col("kind")})
    run = ordered(events, ["encounter_id"], ["at", "kind", "id"], "charge-gap").running(
        orders=("sum", "opened"), charges=("sum", "charged"))
    run = run.with_columns({"open": F.col("orders") - F.col("charges")})
    rows = run.running(low=("min_before", "open")).frame
    low = F.least(F.lit(0), F.col("low"))
    order = F.col("kind") == 0
    number = F.when(order, F.col("orders")).when(F.col("open") >= low, F.col("charges") + low)
    met = rows.withColumn("n", number).where("n is not null").groupBy("encounter_id", "n").agg(
        F.max(F.when(order, F.col("id"))).alias("order_id"), F.max(F.when(order, F.col("at"))).alias("completion_datetime"),
        F.max(F.when(~order, F.col("id"))).alias("charge_id"), F.max(F.when(~order, F.col("at"))).alias("charge_datetime"))
    return met.select("encounter_id", "order_id", "completion_datetime", "charge_id", "charge_datetime",
                      days_between("charge_datetime", "completion_datetime").alias("delay_days"),
                      F.col("charge_id").isNull().alias("is_gap"))


# -------------------------------------------------------------- fragmentation
def patient_fragments(layer) -> DataFrame:
    """The person each patient record belongs to: records that share an identifier, or are linked
    by a chain of shared ones, are one person. ``person_id`` is the smallest record id.

    An identifier is a value within its system; null values link nothing, a record without
    identifiers is a person of its own. ``is_fragmented`` marks persons known to two systems
    or more under different records.
    """
    index = layer.raw.patient_master_index.where("master_patient_id is not null")
    records = index.select("master_patient_id").distinct()
    pair = lambda system, value: F.struct(F.lit(system).alias("id_system"), value.alias("id_value"))
    own = F.array(*[pair(system, F.col(c)) for system, c in IDENTIFIERS.items()])
    legacy = F.transform(F.coalesce(_listed(index, "legacy_mrn_list"), F.array().cast("array<string>")),
                         lambda v: pair("LEGACY", v))
    known = index.select("master_patient_id", F.explode(F.concat(own, legacy)).alias("i")).where(
        "i.id_value is not null").select(
        F.concat(F.lit("0:"), "master_patient_id").alias("a"),
        F.concat(F.lit("1:"), "i.id_system", F.lit(":"), "i.id_value").alias("b"), "i.id_system")
    linked = components(known.select("a", "b"))
    person = linked.where(F.col("node").startswith("0:")).select(
        F.substring("node", 3, 1 << 20).alias("master_patient_id"), F.substring("component", 3, 1 << 20).alias("person_id"))
    whole = records.join(person, "master_patient_id", "left").withColumn(
        "person_id", F.coalesce("person_id", "master_patient_id"))
    whole = materialise(whole, "fragments")
    sizes = whole.groupBy("person_id").agg(F.count(F.lit(1)).alias("records"))
    seen = known.join(linked.select(F.col("node").alias("a"), "component"), "a").select(
        F.substring("component", 3, 1 << 20).alias("person"), "id_system").distinct()
    systems = seen.groupBy("person").agg(F.count(F.lit(1)).alias("systems"))
    sizes = sizes.join(systems, F.col("person_id") == F.col("person"), "left").select(
        "person_id", F.coalesce("systems", F.lit(0)).alias("systems"), F.col("records").alias("person_records"),
        F.col("records").alias("_share"))
    out = spread_join(whole, sizes, "person_id", "_share", whole.count())
    return out.select("master_patient_id", "person_id", "person_records", "systems",
                      ((F.col("person_records") > 1) & (F.col("systems") > 1)).alias("is_fragmented"))


# ----------------------------------------------------------- contract version
def claim_contract_version(layer) -> DataFrame:
    """Every claim with the contract version in force on its service date.

    An amendment supersedes what came before from its effective date on: where versions
    overlap the one that began last (then the higher number) is in force, and after it
    has expired none is until the next begins, also if an older one would still run.
    ``state`` is VALID, EXPIRED (``days_outside`` days after the version's last day),
    NOT_YET (days before the first version), NO_VERSION, NO_DATE or NO_CONTRACT.
    """
    raw = layer.raw
    versions = raw.contract_amendments
    payload = F.struct("version_no", "effective_date", "expiration_date", "baseline_multiplier", "first_date")
    day = F.lit("0001-01-01").cast("date")
    none = versions.schema
    starts = versions.where("contract_id is not null and effective_date is not null").groupBy("contract_id").agg(
        F.min("effective_date").alias("first_date"))
    starts = starts.select("contract_id", day.alias("day"), F.lit(0).alias("kind"), F.lit(0).cast("long").alias("tie"),
                           F.lit("").alias("id"),
                           *[F.lit(None).cast(none[c].dataType).alias(c) for c in
                             ("version_no", "effective_date", "expiration_date", "baseline_multiplier")], "first_date")
    begun = versions.where("contract_id is not null and effective_date is not null").select(
        "contract_id", F.col("effective_date").alias("day"), F.lit(1).alias("kind"), F.col("version_no").cast("long").alias("tie"),
        F.lit("").alias("id"), "version_no", "effective_date", "expiration_date", "baseline_multiplier",
        F.lit(None).cast("date").alias("first_date"))
    known = starts.unionByName(begun).select("contract_id", "day", "kind", "tie", "id", payload.alias("version"))
    claims = raw.claims.select("contract_id", F.col("service_date_start").alias("day"), F.lit(2).alias("kind"),
                               F.lit(0).cast("long").alias("tie"), F.col("claim_id").alias("id"),
                               F.lit(None).cast(known.schema["version"].dataType).alias("version"))
    run = ordered(known.unionByName(claims), ["contract_id"], ["day", "kind", "tie", "id"], "contract-version").running(
        held=("last", "version"))
    rows = run.frame.where("kind = 2").select("id", "contract_id", "day", "held.*", F.col("held").isNull().alias("unknown"))
    after = days_between("day", "expiration_date")
    state = (F.when(F.col("contract_id").isNull(), "NO_CONTRACT").when(F.col("day").isNull(), "NO_DATE")
             .when(F.col("unknown"), "NO_VERSION").when(F.col("version_no").isNull(), "NOT_YET")
             .when(after > 0, "EXPIRED").otherwise("VALID"))
    outside = F.when(state == "EXPIRED", after).when(state == "NOT_YET", days_between("first_date", "day")).when(
        state == "VALID", F.lit(0))
    return rows.select(F.col("id").alias("claim_id"), "contract_id", F.col("day").alias("service_date"), "version_no",
                       "effective_date", "expiration_date", "baseline_multiplier", state.alias("state"),
                       outside.alias("days_outside"))


# ------------------------------------------------------------ duplicate lines
def duplicate_line_sessions(layer, span_hours: int = SPAN_HOURS) -> DataFrame:
    """Orders of one encounter and type, and charges of one encounter and code, in sessions:
    a line belongs to the session of the line before it if at most ``span_hours`` lie between.

    ``place`` counts the lines of a session in time order (ties by id), all but the first are
    repeats. Voided charges, lines without an encounter and lines without a time are left out.
    """
    raw = layer.raw
    orders = raw.orders_raw.select(F.lit("ORDER").alias("line_kind"), "encounter_id", F.col("order_type").alias("code"),
                                   F.col("order_datetime").alias("line_time"), F.col("order_id").alias("line_id"))
    charges = raw.charges.where("status <> 'VOIDED'").select(
        F.lit("CHARGE").alias("line_kind"), "encounter_id", F.col("cpt_code").alias("code"),
        F.col("charge_datetime").alias("line_time"), F.col("charge_id").alias("line_id"))
    lines = orders.unionByName(charges).where("encounter_id is not null and line_time is not null").withColumn("one", F.lit(1))
    run = ordered(lines, ["line_kind", "encounter_id", "code"], ["line_time", "line_id"], "sessions").running(
        last_at=("max_before", "line_time"))
    late = F.col("last_at").isNull() | (F.col("line_time") > F.col("last_at") + F.make_interval(hours=F.lit(span_hours)))
    run = run.with_columns({"begins": F.when(late, 1).otherwise(0)})
    run = run.running(session=("sum", "begins")).stored("sessions").within("session")
    rows = run.total(session_size=("sum", "one")).running(place=("sum", "one")).frame
    return rows.select("line_kind", "line_id", "encounter_id", "code", "line_time", "session", "session_size", "place",
                       (F.col("place") > 1).alias("is_repeat"))


# -------------------------------------------------------- denial benchmarking
def denial_benchmark(layer) -> DataFrame:
    """Denial rate of each facility and payer beside its peers, the facilities of all payers of one type.

    Quartiles are exact (linear between the two rows next to the place), ``percent_rank`` is
    the share of peers with a lower rate (0 for a single one). A peer group of any size is
    counted in blocks, its quartiles are the values at counted places. Claims without a known
    encounter are left out; a null facility is a facility, payers that are not listed are one group.
    """
    raw = layer.raw
    claims = raw.claims.groupBy("encounter_id", "payer_id").agg(
        F.count(F.lit(1)).alias("claims"), count_where(F.col("claim_status") == "DENIED").alias("denied"))
    rates = claims.join(raw.encounters.select("encounter_id", "facility_id"), "encounter_id").groupBy(
        "facility_id", "payer_id").agg(F.sum("claims").alias("claims"), F.sum("denied").alias("denied"))
    rates = rates.join(raw.payers.select("payer_id", "payer_type"), "payer_id", "left").withColumns(
        {"denial_rate": safe_ratio("denied", "claims"), "one": F.lit(1)})
    run = ordered(rates, ["payer_type"], ["denial_rate", "facility_id", "payer_id"], "benchmark").running(
        place=("sum", "one"), below=("max_before", "denial_rate"))
    new = F.when(F.col("below").isNull() | (F.col("denial_rate") > F.col("below")), F.col("place"))
    run = run.with_columns({"new_place": new})
    run = run.running(rank=("last", "new_place")).total(peers=("sum", "one")).stored("benchmark")
    at = {q: F.lit(share) * (F.col("peers") - 1) for q, share in QUARTILES.items()}
    picked = {}
    for q, place in at.items():
        picked[f"{q}_a"] = F.when(F.col("place") == F.floor(place) + 1, F.col("denial_rate"))
        picked[f"{q}_b"] = F.when(F.col("place") == F.ceil(place) + 1, F.col("denial_rate"))
    run = run.with_columns(picked).total(**{f"{n}_all": ("max", n) for n in picked})
    a, b = (lambda q: F.col(f"{q}_a_all")), (lambda q: F.col(f"{q}_b_all"))
    return run.frame.select(
        "facility_id", "payer_id", "payer_type", "claims", "denied", "denial_rate", "peers",
        *[(a(q) + (b(q) - a(q)) * (at[q] - F.floor(at[q]))).alias(q) for q in QUARTILES],
        F.coalesce(safe_ratio(F.col("rank") - 1, F.col("peers") - 1), F.lit(0.0)).alias("percent_rank"))


# ---------------------------------------------------------- denial prevention
def denial_lift_by_flag(layer) -> DataFrame:
    """Denials of each provider documentation flag against what its payers and codes lead to expect.

    Expected denials are the sum over payer and code of the flag's claims times the denial
    rate of all claims there, so a flag is not blamed for its mix; lift is observed over
    expected. Strata without a claim of the flag add nothing, a flag whose strata have no
    denials has lift null. NONE is a known provider without a flag, UNKNOWN no known provider.
    """
    raw = layer.raw
    denied = count_where(F.col("claim_status") == "DENIED")
    claims = raw.claims.groupBy("encounter_id", "payer_id", "cpt_code").agg(
        F.count(F.lit(1)).alias("claims"), denied.alias("denied"))
    by_npi = claims.join(raw.encounters.select("encounter_id", "attending_provider_npi"), "encounter_id").groupBy(
        "attending_provider_npi", "payer_id", "cpt_code").agg(F.sum("claims").alias("claims"), F.sum("denied").alias("denied"))
    flags = raw.providers.where("is_current").groupBy(F.col("provider_npi").alias("attending_provider_npi")).agg(
        F.coalesce(F.max("documentation_quality_flag"), F.lit("NONE")).alias("flag"))
    # providers without a number are many: they meet nothing, spread over keys of their own
    key = F.coalesce("attending_provider_npi", F.concat(F.lit("\u0000"), F.xxhash64("payer_id", "cpt_code").cast("string")))
    strata = by_npi.withColumn("attending_provider_npi", key).join(flags, "attending_provider_npi", "left").groupBy(
        F.coalesce("flag", F.lit("UNKNOWN")).alias("flag"), "payer_id", "cpt_code").agg(
        F.sum("claims").alias("claims"), F.sum("denied").alias("denied"))
    # a stratum has one row a flag here
    every = Window.partitionBy("payer_id", "cpt_code")
    rate = safe_ratio(F.sum("denied").over(every), F.sum("claims").over(every))
    out = strata.withColumn("expected", F.col("claims") * rate).groupBy("flag").agg(
        F.sum("claims").alias("claims"), F.sum("denied").alias("denied"), exact_sum("expected").alias("expected_denials"))
    return out.withColumn("lift", safe_ratio("denied", "expected_denials"))


# ------------------------------------------------------------ knowledge decay
def knowledge_weight_by_month(layer, half_life: float = HALF_LIFE_MONTHS) -> DataFrame:
    """Weight of what is still known about each denial code, month by month.

    A note adds its confidence's weight to the codes it refers to in the month it was last
    referenced; a month later the sum counts 2 ** (-1 / ``half_life``) of that. Months run
    from a code's first reference to the clock's month. Notes without a date or with an
    unknown confidence add nothing. ``entries`` counts the code's rows in the codex.
    """
    raw = layer.raw
    notes = raw.tribal_knowledge_notes
    codes = _listed(notes, "referenced_codes")
    worth = F.lit(None).cast("double")
    for name, w in NOTE_WEIGHTS.items():
        worth = F.when(F.col("confidence") == name, F.lit(w)).otherwise(worth)
    last = month_of(as_of_lit(layer.as_of))
    refs = notes.select(month_of("last_referenced_date").alias("month"), worth.alias("worth"),
                        F.explode(F.array_distinct(codes)).alias("denial_code")).where(
        (F.col("month") <= last) & F.col("worth").isNotNull() & F.col("denial_code").isNotNull())
    sums = refs.groupBy("denial_code", "month").agg(F.count(F.lit(1)).alias("note_references"), exact_sum("worth").alias("worth"))
    sums = materialise(sums, "knowledge")
    grid = sums.groupBy("denial_code").agg(F.min("month").alias("first")).select(
        "denial_code", F.explode(F.sequence("first", last, F.expr("interval 1 month"))).alias("month"))
    grid = grid.select("denial_code", "month", F.lit(0).cast("long").alias("note_references"), F.lit(0.0).alias("worth"))
    dense = sums.unionByName(grid).groupBy("denial_code", "month").agg(
        F.sum("note_references").alias("note_references"), F.sum("worth").alias("worth"))
    # sums of worth seen from the clock's month, where every factor is at most one
    age = month_boundaries(last, "month")
    fade = F.pow(F.lit(0.5), age / F.lit(half_life))
    dense = dense.withColumn("faded", F.col("worth") * fade)
    rows = ordered(dense, ["denial_code"], ["month"], "knowledge").running(held=("sum", "faded")).frame
    entries = raw.denial_codex.groupBy("denial_code").agg(F.count(F.lit(1)).alias("entries"))
    return rows.join(entries, "denial_code", "left").select(
        "denial_code", "month", "note_references", (F.col("held") / fade).alias("weight"),
        F.coalesce("entries", F.lit(0)).alias("entries"))


# ------------------------------------------------ distinct counts that add up
def dex_provider_bitmaps(layer) -> DataFrame:
    """Period x facility x bucket of provider numbers: exact bitmaps of the active and the adopting.

    Providers are numbered 0, 1, 2, ... without gaps (a scan over all of them), so a bucket of
    32,768 of them is one bitmap of 4 KB that can be or-ed to any coarser grain.
    """
    raw = layer.raw
    use = raw.clinician_ehr_usage.select("period", "facility_id", "provider_npi", F.lit(1).alias("active"), F.lit(0).alias("adopting"))
    tools = raw.ai_tool_usage.select("period", "facility_id", "provider_npi", F.lit(0).alias("active"), F.lit(1).alias("adopting"))
    seen = use.unionByName(tools).where("provider_npi is not null").groupBy("period", "facility_id", "provider_npi").agg(
        F.max("active").alias("active"), F.max("adopting").alias("adopting"))
    seen = materialise(seen, "provider-use")
    every = seen.select("provider_npi").distinct().withColumn("one", F.lit(1).cast("long"))
    number = ordered(every, [], ["provider_npi"], "provider-number").running(n=("sum", "one")).frame.select(
        "provider_npi", F.col("n").alias("number"))
    met = seen.join(number, "provider_npi")
    bit = F.bitmap_bit_position("number")
    return met.groupBy("period", "facility_id", F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.when(F.col("active") == 1, bit)).alias("active"),
        F.bitmap_construct_agg(F.when(F.col("adopting") == 1, bit)).alias("adopting"))


GRAINS = {"facility_month": ["period", "facility_id"], "month": ["period"], "facility": ["facility_id"], "all": []}


def dex_distinct_providers(layer) -> DataFrame:
    """Active and adopting providers at four grains, each an exact distinct count, from one table of bitmaps."""
    bits = dex_provider_bitmaps(layer)
    keys = ["period", "facility_id"]
    sets = [[*g, "bucket"] for g in GRAINS.values()]
    grain = F.lit(None).cast("string")
    for name, g in GRAINS.items():
        grain = F.when((F.grouping("period") == int("period" not in g))
                       & (F.grouping("facility_id") == int("facility_id" not in g)), name).otherwise(grain)
    merged = bits.groupingSets(sets, *keys, "bucket").agg(
        grain.alias("grain"), F.bitmap_count(F.bitmap_or_agg("active")).alias("active"),
        F.bitmap_count(F.bitmap_or_agg("adopting")).alias("adopting"))
    return merged.groupBy("grain", *keys).agg(F.sum("active").alias("active_providers"), F.sum("adopting").alias("adopting_providers"))


# -------------------------------------------------------- ratios at all grains
LABOR_GRAINS = {"facility_month": ["region", "facility_id", "month"], "region_month": ["region", "month"],
                "facility": ["region", "facility_id"], "region": ["region"], "month": ["month"], "all": []}


def labor_ratios_all_grains(layer) -> DataFrame:
    """Labor ratios at six grains in one expand and one aggregation. ``grain`` names the grain, so a
    key that is null in the data is told from one that is summed over."""
    fact = layer.input("fact_workforce_month")
    keys = ["region", "facility_id", "month"]
    grain = F.lit(None).cast("string")
    for name, g in LABOR_GRAINS.items():
        here = F.lit(True)
        for k in keys:
            here = here & (F.grouping(k) == int(k not in g))
        grain = F.when(here, name).otherwise(grain)
    sums = ("worked_hours", "agency_hours", "overtime_hours", "total_labor_cost")
    out = fact.groupingSets(list(LABOR_GRAINS.values()), *keys).agg(
        grain.alias("grain"), *[(F.sum(s) if s == "total_labor_cost" else exact_sum(s)).alias(s) for s in sums])
    return out.select("grain", *keys, *sums, safe_ratio("agency_hours", "worked_hours").alias("agency_pct"),
                      safe_ratio("total_labor_cost", "worked_hours").alias("cost_per_worked_hour"),
                      safe_ratio("overtime_hours", "worked_hours").alias("ot_pct"))


# ---------------------------------------------------- joins without a shuffle
BUCKETED = ("encounters", "cdi_queries", "charges", "claims", "care_management")


class Bucketed:
    """Raw tables of which those with an encounter are landed in buckets of it, once per namespace."""

    def __init__(self, raw, namespace: str, folder: str, buckets: int):
        self.raw, self.namespace, self.folder, self.buckets = raw, namespace, folder, buckets

    def __getattr__(self, name: str) -> DataFrame:
        raw = self.raw[name]
        if name not in BUCKETED:
            return raw
        spark, table = raw.sparkSession, f"{self.namespace}.{name}"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.namespace}")
        if not spark.catalog.tableExists(table):
            write_bucketed(raw, table, f"{self.folder}/{name}", ["encounter_id"], self.buckets)
        return spark.table(table)


def quality_month_bucketed(layer) -> DataFrame:
    """``fact_quality_month`` over landed buckets: its four joins and sums by encounter need no shuffle.

    The tables are landed once per application and state of the input files, beside the stored layer.
    """
    from .operations import fact_quality_month

    spark = layer.spark
    folder = f"{(layer.store or f'{checkpoint_dir(spark)}/landed-{uuid.uuid4().hex}').rstrip('/')}/landed"
    namespace = "strata_" + re.sub(r"\W", "_", "_".join(folder.split("/")[-3:]))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return fact_quality_month(Bucketed(layer.raw, namespace, folder, buckets), layer.as_of)


PATTERNS = {
    "charge_gap": charge_gap,
    "patient_fragments": patient_fragments,
    "claim_contract_version": claim_contract_version,
    "duplicate_line_sessions": duplicate_line_sessions,
    "denial_benchmark": denial_benchmark,
    "denial_lift_by_flag": denial_lift_by_flag,
    "knowledge_weight_by_month": knowledge_weight_by_month,
    "dex_distinct_providers": dex_distinct_providers,
    "labor_ratios_all_grains": labor_ratios_all_grains,
    "quality_month_bucketed": quality_month_bucketed,
}
