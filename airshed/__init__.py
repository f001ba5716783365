"""airshed: environmental-exposure analytics on Spark DataFrames.

Readings (weather / pollution / sensor) are partitioned and profiled by
date, enriched with a per-day visitor estimate, aggregated into
visitor-weighted exposure per city and country, ranked, correlated with
weather, and tracked in a streaming ledger of arriving files.  Every
operator is a function ``DataFrame -> DataFrame`` built from Spark SQL
built-ins so Catalyst can prune, push down and codegen the whole plan.
"""

__version__ = "0.1.0"
