"""Parameters of the analyses.

Everything a user may want to tune is a field of :class:`Params`; the
defaults reproduce the reference definitions.  Texts that appear in
outputs are fixed values: dashboards and downstream filters match on them.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

# --- fixed values (must equal the reference definitions) -------------------
PAID_STATUS = "Success"
FAILED_STATUS = "Failed"

PLAN_PRICES = {"Basic": Decimal("29.99"), "Pro": Decimal("59.99"), "Enterprise": Decimal("129.99")}
SEGMENTS = ("SMB", "Mid-Market", "Enterprise")
CHANNELS = ("Paid Ads", "Referral", "Organic", "Partner")

REVENUE_HIGH_FLAG = "HIGH ANOMALY (>15% change)"
REVENUE_MEDIUM_FLAG = "MEDIUM ANOMALY (>10% change)"
NORMAL_FLAG = "Normal"
OUTLIER_BELOW_FLAG = "Statistical Outlier (2+ std devs below mean)"
OUTLIER_ABOVE_FLAG = "Statistical Outlier (2+ std devs above mean)"
CHURN_SPIKE_FLAG = "CHURN SPIKE DETECTED"
CHURN_ELEVATED_FLAG = "Elevated Churn"
CONVERSION_SIGNIFICANT_FLAG = "CONVERSION DROP: Significant decrease detected"
CONVERSION_MODERATE_FLAG = "CONVERSION DROP: Moderate decrease"
CONVERSION_MOM_FLAG = "CONVERSION DROP: >5% MoM decrease"
REPORT_REVENUE_HIGH_FLAG = "Revenue anomaly (>15% change)"
REPORT_REVENUE_MEDIUM_FLAG = "Revenue anomaly (>10% change)"
REPORT_CHURN_FLAG = "Churn spike detected"
REPORT_CONVERSION_FLAG = "Conversion drop detected"
HISTORICAL = "Historical"
FORECAST = "Forecast"
COMBINED_METHOD = "Combined (MA + Linear)"
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Params:
    """Tunable constants; defaults are the reference values."""

    paid_status: str = PAID_STATUS
    # revenue move bands (strict >)
    high_change: float = 0.15
    medium_change: float = 0.10
    # sigma multiples
    sigma_high: float = 2.0
    sigma_mid: float = 1.5
    # trailing window: rows before the current one (current excluded)
    trailing_rows: int = 5
    # conversion: percentage points below the previous month
    conversion_pp_drop: float = 5.0
    # comparisons against the mean of all earlier months
    report_churn_factor: str = "1.5"
    insight_churn_factor: str = "1.3"
    report_conversion_factor: float = 0.85
    # revenue move needed for an insight sentence / for listing a month
    insight_change: float = 0.12
    insight_list_change: float = 0.10
    # months back from the latest (inclusive) for reports and history
    report_span_months: int = 12
    # moving averages (rows, current included)
    short_window: int = 3
    long_window: int = 6
    # forecast horizons
    linear_horizon: int = 3
    horizon: int = 6
    # number of latest month-over-month changes the linear trend averages
    trend_sample: int = 6
    # billing interval in days
    billing_interval_days: int = 30


DEFAULT = Params()
