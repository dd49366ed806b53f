"""faultline: fault-event analytics as Spark DataFrame operators.

Raw alarm feeds and a site inventory become a deduplicated, enriched Silver
table and a per-site Gold table; on top of them sit metric datasets,
data-quality checks, governance reports, forecasts and answer grading.
Every operator takes and returns DataFrames.
"""

__version__ = "0.1.0"
