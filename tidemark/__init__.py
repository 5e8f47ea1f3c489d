"""tidemark: subscription analytics (revenue, churn, retention, conversion,
growth, margin, lifetime value, forecasts, anomaly flags) as Spark jobs."""

from tidemark.model import Tables
from tidemark.params import DEFAULT, Params
from tidemark.plans import ANALYSES

__all__ = ["ANALYSES", "DEFAULT", "Params", "Tables"]
