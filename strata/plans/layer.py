"""The metric layer: every table-building job, its inputs and the build order.

``MetricLayer`` resolves a table name to a DataFrame. Raw-reading jobs get the
raw accessor; the executive scorecards, the rationalisation worklist and the
read queries read other built tables, never the raw tables.

``layer[name]`` is the lazy plan of a table. ``layer.input(name)`` is the table
as others read it: with a ``store`` folder (a shared path) it is written there
once, in its warehouse layout, and read back, so scorecards and reads scan
small stored tables with filters and columns pushed down; a table that is there
already is not built again. Without a store the plans are composed.
``partitioned=False`` stores plain folders instead of the warehouse layout,
for layers of a few thousand rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..sources import RawTables
from ..sources.sinks import register_table, stored_table, write_ordered, write_table
from . import executive, it, operations, revenue
from .params import DEFAULT_AS_OF, it_spine

# name -> (builder over raw tables) for the raw-reading jobs
RAW_JOBS = {
    "fact_revenue_cycle_month": revenue.fact_revenue_cycle_month,
    "fact_workforce_month": operations.fact_workforce_month,
    "fact_throughput_month": operations.fact_throughput_month,
    "fact_quality_month": operations.fact_quality_month,
    "fact_supply_month": operations.fact_supply_month,
    "fact_charge_capture_day": operations.fact_charge_capture_day,
    "dim_payer": revenue.dim_payer,
    "dim_facility": operations.dim_facility,
    "dim_provider": operations.dim_provider,
    "dim_contract": revenue.dim_contract,
    "worklist_underpayments": revenue.worklist_underpayments,
    "worklist_expiring_contracts": revenue.worklist_expiring_contracts,
    "worklist_empi_duplicate_pairs": revenue.worklist_empi_duplicate_pairs,
    "worklist_agency_conversion": operations.worklist_agency_conversion,
    "worklist_los_outliers": operations.worklist_los_outliers,
    "dim_it_system": it.dim_it_system,
    "dim_it_asset": it.dim_it_asset,
    "fact_it_incident_month": it.fact_it_incident_month,
    "fact_it_security_month": it.fact_it_security_month,
    "fact_it_cost_month": it.fact_it_cost_month,
    "fact_it_servicedesk_month": it.fact_it_servicedesk_month,
    "fact_it_dex_month": it.fact_it_dex_month,
    "worklist_open_critical_vulns": it.worklist_open_critical_vulns,
    "worklist_eol_refresh": it.worklist_eol_refresh,
    "worklist_cloud_waste": it.worklist_cloud_waste,
    "worklist_vendor_renewals": it.worklist_vendor_renewals,
}

# Jobs over built tables, with their inputs.
DERIVED_JOBS = {
    "exec_kpi_month": ("fact_revenue_cycle_month", "fact_workforce_month", "fact_supply_month",
                       "fact_throughput_month", "fact_quality_month", "fact_charge_capture_day"),
    "worklist_app_rationalization": ("dim_it_system",),
    "exec_it_kpi_month": ("fact_it_incident_month", "fact_it_security_month", "fact_it_cost_month",
                          "fact_it_servicedesk_month", "fact_it_dex_month", "dim_it_system"),
}

# Storage layout of each table: (partition column, cluster columns).
LAYOUT = {
    "fact_revenue_cycle_month": ("month", ("payer_id", "contract_id")),
    "fact_workforce_month": ("month", ("facility_id", "associate_role")),
    "fact_throughput_month": ("month", ("facility_id",)),
    "fact_quality_month": ("month", ("facility_id",)),
    "fact_supply_month": ("month", ("facility_id", "item_category")),
    "fact_charge_capture_day": ("day", ("facility_id",)),
    "exec_kpi_month": ("month", ()),
    "dim_payer": (None, ("payer_id",)),
    "dim_facility": (None, ("facility_id",)),
    "dim_provider": (None, ("primary_facility_id", "credentialing_status")),
    "dim_contract": (None, ("payer_id",)),
    "worklist_underpayments": (None, ("payer_id", "contract_id")),
    "worklist_expiring_contracts": (None, ("payer_id",)),
    "worklist_empi_duplicate_pairs": (None, ()),
    "worklist_agency_conversion": (None, ("facility_id", "associate_role")),
    "worklist_los_outliers": (None, ("facility_id",)),
    "dim_it_system": (None, ("system_id",)),
    "dim_it_asset": (None, ("facility_id",)),
    "exec_it_kpi_month": ("month", ()),
    "fact_it_incident_month": ("month", ("facility_id",)),
    "fact_it_security_month": ("month", ("facility_id",)),
    "fact_it_cost_month": ("period", ("system_id",)),
    "fact_it_servicedesk_month": ("month", ("facility_id",)),
    "fact_it_dex_month": ("period", ("facility_id",)),
    "worklist_open_critical_vulns": (None, ("facility_id",)),
    "worklist_eol_refresh": (None, ("facility_id",)),
    "worklist_app_rationalization": (None, ("capability",)),
    "worklist_cloud_waste": (None, ("system_id",)),
    "worklist_vendor_renewals": (None, ("msa_renewal_date",)),
}

# Tables with ORDER BY: stored as files by ranges of these columns, in their order.
ORDERED = {"worklist_empi_duplicate_pairs": ("min_confidence", "master_patient_id_a", "master_patient_id_b")}

# Build order: core facts, exec, dims, worklists; IT dims, facts, worklists, exec.
BUILD_ORDER = (
    "fact_revenue_cycle_month", "fact_workforce_month", "fact_throughput_month", "fact_quality_month",
    "fact_supply_month", "fact_charge_capture_day", "exec_kpi_month", "dim_payer", "dim_facility",
    "dim_provider", "dim_contract", "worklist_underpayments", "worklist_expiring_contracts",
    "worklist_empi_duplicate_pairs", "worklist_agency_conversion", "worklist_los_outliers",
    "dim_it_system", "dim_it_asset", "fact_it_incident_month", "fact_it_security_month", "fact_it_cost_month",
    "fact_it_servicedesk_month", "fact_it_dex_month", "worklist_open_critical_vulns", "worklist_eol_refresh",
    "worklist_app_rationalization", "worklist_cloud_waste", "worklist_vendor_renewals", "exec_it_kpi_month",
)

IT_TABLES = (
    "dim_it_system", "dim_it_asset", "exec_it_kpi_month", "fact_it_incident_month", "fact_it_security_month",
    "fact_it_cost_month", "fact_it_servicedesk_month", "fact_it_dex_month", "worklist_open_critical_vulns",
    "worklist_eol_refresh", "worklist_app_rationalization", "worklist_cloud_waste", "worklist_vendor_renewals",
)


class MetricLayer:
    def __init__(self, raw: RawTables, as_of=DEFAULT_AS_OF, store: str | None = None, partitioned: bool = True):
        self.raw = raw
        self.spark = raw.spark
        self.as_of = as_of
        self.store = store
        self.partitioned = partitioned
        self._tables: dict[str, DataFrame] = {}
        self._inputs: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self._plan(name)
        return self._tables[name]

    def input(self, name: str) -> DataFrame:
        """A built table as read by another job or a read query."""
        if not self.store:
            return self[name]
        if name not in self._inputs:
            if not stored_table(self.spark, self.path(name)):
                self.build(name)
            self._inputs[name] = self.spark.read.parquet(self.path(name))
        return self._inputs[name]

    def path(self, name: str) -> str:
        return f"{self.store.rstrip('/')}/{name}"

    def build(self, name: str) -> None:
        """Write one table into the store, replacing it."""
        if name in ORDERED:
            write_ordered(self[name], self.path(name), list(ORDERED[name]))
            self._inputs.pop(name, None)
            return
        part, cluster = LAYOUT[name] if self.partitioned else (None, ())
        write_table(self[name], self.path(name), partition_by=part, cluster_by=cluster)
        self._inputs.pop(name, None)

    def register(self, namespace: str, names=None) -> None:
        """Make stored tables known to the catalog as ``namespace.table``."""
        for name in names or BUILD_ORDER:
            self.input(name)
            register_table(self.spark, namespace, name, self.path(name))

    def _plan(self, name: str) -> DataFrame:
        if name in RAW_JOBS:
            return RAW_JOBS[name](self.raw, self.as_of)
        inputs = {d: self.input(d) for d in DERIVED_JOBS[name]}
        if name == "exec_kpi_month":
            return executive.exec_kpi_month(inputs)
        if name == "worklist_app_rationalization":
            return it.worklist_app_rationalization(inputs["dim_it_system"])
        return executive.exec_it_kpi_month(self.spark, it_spine(self.as_of), inputs, inputs["dim_it_system"])
