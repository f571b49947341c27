"""adpulse: marketing, customer and profit analytics as Spark jobs.

Every operator is a function ``(DataFrames, params) -> DataFrame``. Plans are
declared with the DataFrame API so Catalyst/AQE choose the physical strategy;
only bounded results (a handful of channels, months, quantile edges) ever
reach the driver.
"""

from adpulse.params import AnalysisParams, SegmentRule, DEFAULTS  # noqa: F401

__all__ = ["AnalysisParams", "SegmentRule", "DEFAULTS"]
