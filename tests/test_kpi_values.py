"""The KPI definitions, literally: both the jobs and the oracle read them from one place."""

from strata.plans.kpi import KPIS

# key: direction, threshold operator, threshold, target, comparison, fraction
EXPECTED = {
    "Operating Margin": ("higher", ">=", 0, 0, "prior_period", True),
    "Net Patient Revenue": ("higher", ">", 0, None, "prior_year", False),
    "Net Revenue Realization": ("higher", ">=", 30, None, "prior_period", True),
    "Denial Rate": ("lower", "<", 5, 5, "prior_period", True),
    "Days in A/R": ("lower", "<", 45, 40, "prior_period", False),
    "Agency Labor %": ("lower", "<", 10, 10, "prior_period", True),
    "Labor Cost per Worked Hour": ("lower", "<", 100, None, "prior_period", False),
    "Average Length of Stay": ("lower", "<", 5, 4.5, "prior_period", False),
    "ED Boarding Hours": ("lower", "<", 4, 2, "prior_period", False),
    "Serious Safety Events": ("lower", "<", 5, 0, "prior_period", False),
    "Service Availability": ("higher", ">=", 99.9, 99.9, "prior_period", True),
    "Major Incidents": ("lower", "<", 3, 0, "prior_period", False),
    "MTTR": ("lower", "<", 120, 90, "prior_period", False),
    "Change Failure Rate": ("lower", "<", 15, 15, "prior_period", True),
    "Change Lead Time": ("lower", "<", 72, 48, "prior_period", False),
    "Open Critical Vulnerabilities": ("lower", "<", 25, 0, "prior_period", False),
    "Vulnerability SLA Breach %": ("lower", "<", 10, 5, "prior_period", True),
    "IT Spend": ("lower", "<", 20000000, None, "prior_year", False),
    "Cloud Idle %": ("lower", "<", 20, 15, "prior_period", True),
    "Self-Service Deflection": ("higher", ">=", 35, 40, "prior_period", True),
    "EHR After-Hours %": ("lower", "<", 10, 8, "prior_period", True),
    "AI Adoption": ("higher", ">=", 40, 60, "prior_period", True),
}


def test_definitions():
    assert {k.key: (k.direction, k.threshold_op, k.threshold, k.target, k.comparison, k.fraction) for k in KPIS} == EXPECTED
