"""KPI formulas as Column expressions (JVM-side, whole-stage codegen).

An undefined ratio (zero or NULL denominator) is NULL, never NaN or an
ANSI divide-by-zero error: every division goes through ``safe_div``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Output conventions shared by every operator: counts leave as BIGINT, money
# and ratios as DOUBLE. A ratio of exact (DECIMAL / integer) sums is a single
# IEEE division and is left unrounded; values that went through floating
# accumulation (averages, chained products) are rounded to 6 places.
RATIO_SCALE = 6


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def dbl(x) -> Column:
    return _c(x).cast("double")


def r6(x) -> Column:
    """An exact-input value as DOUBLE (no rounding needed)."""
    return dbl(x)


def round6(x) -> Column:
    """A floating-accumulated value, rounded to 6 places."""
    return F.round(dbl(x), RATIO_SCALE)


def safe_div(num, den) -> Column:
    """B1: num / den, NULL when den is 0 or NULL."""
    return F.try_divide(dbl(num), dbl(den))


def ctr(clicks, impressions) -> Column:
    return safe_div(clicks, impressions)


def cvr(conversions, clicks) -> Column:
    return safe_div(conversions, clicks)


def cpc(spend, clicks) -> Column:
    return safe_div(spend, clicks)


def cpa(spend, conversions) -> Column:
    return safe_div(spend, conversions)


def roas(revenue, spend) -> Column:
    return safe_div(revenue, spend)


def roi(profit, spend) -> Column:
    return safe_div(dbl(profit) - dbl(spend), spend)


def cac(spend, new_customers) -> Column:
    return safe_div(spend, new_customers)


def contribution_margin(revenue, variable_cost) -> Column:
    return safe_div(dbl(revenue) - dbl(variable_cost), revenue)


# --- CASE tiers (B10, B11). Thresholds and labels of the
# analyst SQL corpus. A NULL metric falls through to the ELSE label.
def roas_tier(x) -> Column:
    x = _c(x)
    return (F.when(x >= 4, "Excellent").when(x >= 2, "Healthy")
            .when(x >= 1, "Break-even").otherwise("Underperforming"))


def roi_tier(x) -> Column:
    x = _c(x)
    return F.when(x >= 1, "High ROI").when(x >= 0.3, "Moderate ROI").otherwise("Low / Negative ROI")


def ltv_cac_tier(x) -> Column:
    x = _c(x)
    return F.when(x >= 3, "Efficient").when(x >= 1, "Marginal").otherwise("Unprofitable")


def device_status(cvr_pct) -> Column:
    return F.when(_c(cvr_pct) >= 4, "Strong Converter").otherwise("Needs Optimization")


def discount_band(discount) -> Column:
    d = _c(discount)
    return (F.when(d == 0, "0% (Full Price)").when(d <= 0.10, "5-10%")
            .when(d <= 0.20, "15-20%").otherwise("30%+"))


def month_ordinal(d) -> Column:
    """Calendar month as an integer (year*12 + month-1): differences of two
    ordinals are whole-month distances, like period arithmetic."""
    d = _c(d)
    return F.year(d) * 12 + F.month(d) - 1


def first_match(rules, default: str) -> Column:
    """Fold ``[(predicate, label), ...]`` into one CASE; first match wins."""
    expr = None
    for pred, label in rules:
        expr = F.when(pred, F.lit(label)) if expr is None else expr.when(pred, F.lit(label))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))
