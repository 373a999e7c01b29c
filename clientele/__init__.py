"""clientele: retail customer analytics as Spark DataFrame operators.

Star schema in, per-customer view, RFM scores and segments, lifetime value, cohorts,
market-basket rules and report tables out. Every operator is a lazy function from
DataFrames to DataFrames; see ``clientele.operators``.
"""

__version__ = "0.1.0"
