from adpulse.functions.kpis import (  # noqa: F401
    safe_div, ctr, cvr, cpc, cpa, roas, roi, cac, contribution_margin,
    roas_tier, roi_tier, ltv_cac_tier, device_status, discount_band,
    month_ordinal, first_match, r6, round6, dbl,
)
