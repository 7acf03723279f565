"""Duplicate-pair generation equals the all-pairs definition on a fixture
with NULL confidences, low/low, low/high and high/high pairs and a hot block."""

from itertools import combinations

from strata.plans.revenue import worklist_empi_duplicate_pairs

ROWS = [("M1", "h1", 0.5, "F1"), ("M2", "h1", 0.9, "F2"), ("M3", "h1", None, "F3"), ("M4", "h1", 0.6, "F1"),
        ("M5", "h2", 0.95, "F1"), ("M6", "h2", 0.99, "F2"), ("M7", "h3", None, "F1"), ("M8", "h3", None, "F2"),
        ("M9", None, 0.1, "F1"), ("M10", None, 0.2, "F2")]
ROWS += [(f"H{i:03d}", "hot", 0.5 + (i % 5) / 10, "F9") for i in range(40)]


def brute():
    out = set()
    for a, b in combinations(ROWS, 2):
        if a[0] > b[0]:
            a, b = b, a
        if a[1] is None or a[1] != b[1]:
            continue
        low = lambda r: r[2] is not None and r[2] < 0.85
        if not (low(a) or low(b)):
            continue
        mn = None if a[2] is None or b[2] is None else min(a[2], b[2])
        out.add((a[0], b[0], a[1], a[2], b[2], a[3], b[3], mn))
    return out


class _Raw:
    def __init__(self, df):
        self.patient_master_index = df


def test_pairs_match_definition(spark):
    df = spark.createDataFrame(ROWS, "master_patient_id string, name_hash string, match_confidence_score double, "
                                     "primary_facility_id string")
    for part_rows in (100_000, 7):  # one part per block, and the 40-record block in six
        got = worklist_empi_duplicate_pairs(_Raw(df), part_rows=part_rows).collect()
        assert len(got) == len(set(map(tuple, got)))
        assert set(map(tuple, got)) == brute()
