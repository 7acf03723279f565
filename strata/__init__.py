"""strata: a batch metric layer (facts, dimensions, worklists, scorecards, KPI reads) on Spark."""
