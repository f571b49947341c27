"""Oracle SQL (DuckDB), written independently of the Spark operators.

Each body may use the fixture CTEs: fx_* (raw engine tables), cc (clean
campaigns), cu (customers), tx (clean transactions), ab (A/B daily table).
Output conventions match the engine: integers BIGINT, ratios/money DOUBLE
rounded to 6 places.
"""

from adpulse.oracle.fixtures_sql import with_fixtures

_BODIES: dict = {}
#: Fixed value: the fingerprint of the default parameters.
PARAMS_HASH = "9513f227a46ffb15"


def _r6(x: str) -> str:
    """Exact-input value as DOUBLE (no rounding)."""
    return f"CAST({x} AS DOUBLE)"


def _div(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0))"


# ------------------------------------------------------------------ audit
# The rules as a report shows them.
_RULE_VALUES = """(VALUES
  (1, 'missing_customer_id', 'Missing customer_id', 'transactions', 'warning',
   'A transaction without a customer_id cannot be joined to acquisition channel or demographics.',
   'Quarantine the row; alert the checkout/event-tracking pipeline owner.',
   'drop_rows'),
  (2, 'missing_age_group', 'Missing age_group', 'customers', 'info',
   'Breaks demographic segmentation for the affected rows only.',
   'Keep the row; exclude from age-based cuts; backfill via profile-completion nudge.',
   'none'),
  (3, 'duplicate_rows', 'Duplicate rows', 'campaigns', 'error',
   'Double-loaded rows double-count spend and revenue, distorting every downstream KPI.',
   'De-duplicate on (campaign_id, date); alert ETL owner if it recurs.',
   'drop_duplicates'),
  (4, 'out_of_range_dates', 'Invalid/out-of-range dates', 'campaigns', 'warning',
   'Out-of-range dates corrupt time-series trends and seasonality analysis.',
   'Reject at ingestion; quarantine for source investigation.',
   'none'),
  (5, 'negative_spend', 'Negative spend', 'campaigns', 'error',
   'Silently deflates total spend and inflates ROAS/ROI if left in.',
   'Route to finance for classification; exclude from KPI calcs until resolved.',
   'drop_rows'),
  (6, 'negative_revenue', 'Negative revenue', 'campaigns', 'error',
   'Revenue should never be negative at the campaign-day grain.',
   'Quarantine and investigate at source; exclude from KPI calcs until resolved.',
   'drop_rows'),
  (7, 'profit_exceeds_amount', 'Profit > transaction amount', 'transactions', 'error',
   'Profit should never exceed gross order amount; signals a broken margin calculation.',
   'Halt the margin-calc job; re-run after fixing the formula before finance reporting.',
   'none'),
  (8, 'orphan_transactions', 'Orphan transactions', 'transactions', 'error',
   'A transaction not tied to a valid customer is invisible to all customer-level analysis.',
   'Quarantine; check for a late-arriving customer dimension load.',
   'drop_rows'),
  (9, 'conversions_exceed_clicks', 'Conversions > clicks', 'campaigns', 'error',
   'Logically impossible; signals a tracking/attribution double-count.',
   'Flag to tracking team; cap conversions at clicks for reporting until fixed at source.',
   'cap_column'),
  (10, 'impossible_ctr', 'Impossible CTR (outside 0-100%)', 'campaigns', 'error',
   'CTR is a bounded rate; an out-of-range value signals a logging/units bug.',
   'Quarantine; audit impression/click logging for scale mismatches.',
   'none'),
  (11, 'impossible_cvr', 'Impossible CVR (outside 0-100%)', 'campaigns', 'error',
   'Same rationale as CTR — CVR must be a valid rate.',
   'Quarantine; audit the conversion-tracking pipeline.',
   'none')
) AS m(rule_order, key, check_name, table_name, severity, why_it_matters, production_handling, remedy)"""

_AUDIT_COUNTS = """
WITH d AS (SELECT DISTINCT * FROM fx_campaigns),
n AS (
  SELECT 'duplicate_rows' AS key, (SELECT COUNT(*) FROM fx_campaigns) - (SELECT COUNT(*) FROM d) AS issue_count,
         (SELECT COUNT(*) FROM fx_campaigns) AS denom
  UNION ALL SELECT 'out_of_range_dates', COUNT(*) FILTER (WHERE date IS NULL OR date < DATE '1990-01-01' OR date > current_date), COUNT(*) FROM d
  UNION ALL SELECT 'negative_spend', COUNT(*) FILTER (WHERE spend < 0), COUNT(*) FROM d
  UNION ALL SELECT 'negative_revenue', COUNT(*) FILTER (WHERE revenue < 0), COUNT(*) FROM d
  UNION ALL SELECT 'conversions_exceed_clicks', COUNT(*) FILTER (WHERE conversions > clicks), COUNT(*) FROM d
  UNION ALL SELECT 'impossible_ctr', COUNT(*) FILTER (WHERE COALESCE(clicks::DOUBLE / NULLIF(impressions, 0) NOT BETWEEN 0 AND 1, FALSE)), COUNT(*) FROM d
  UNION ALL SELECT 'impossible_cvr', COUNT(*) FILTER (WHERE COALESCE(conversions::DOUBLE / NULLIF(clicks, 0) NOT BETWEEN 0 AND 1, FALSE)), COUNT(*) FROM d
  UNION ALL SELECT 'missing_age_group', COUNT(*) FILTER (WHERE age_group IS NULL), COUNT(*) FROM fx_customers
  UNION ALL SELECT 'missing_customer_id', COUNT(*) FILTER (WHERE customer_id IS NULL), COUNT(*) FROM fx_transactions
  UNION ALL SELECT 'profit_exceeds_amount', COUNT(*) FILTER (WHERE profit > amount), COUNT(*) FROM fx_transactions
  UNION ALL SELECT 'orphan_transactions',
         COUNT(*) FILTER (WHERE customer_id IS NOT NULL AND customer_id NOT IN (SELECT customer_id FROM fx_customers)),
         COUNT(*) FROM fx_transactions
)
"""

_BODIES["q_report"] = _AUDIT_COUNTS + f"""
SELECT CAST(m.rule_order AS BIGINT) AS rule_order, m.key, m.check_name, m.table_name, m.severity,
       CAST(n.issue_count AS BIGINT) AS issue_count,
       CASE WHEN n.denom > 0 THEN ROUND(n.issue_count * 100.0 / n.denom, 4) ELSE 0.0 END AS pct_of_rows,
       m.why_it_matters, m.production_handling, m.remedy
FROM n JOIN {_RULE_VALUES} ON n.key = m.key
"""

_BODIES["q_flagged"] = _AUDIT_COUNTS + """
SELECT CAST(COUNT(*) FILTER (WHERE issue_count > 0) AS BIGINT) AS total_flagged, CAST(COUNT(*) AS BIGINT) AS rules_run FROM n
"""

_BODIES["q_rows"] = """
SELECT 'campaigns' AS table_name, (SELECT COUNT(*) FROM fx_campaigns) AS rows_before, (SELECT COUNT(*) FROM cc) AS rows_after,
       (SELECT COUNT(*) FROM fx_campaigns) - (SELECT COUNT(*) FROM cc) AS rows_removed
UNION ALL SELECT 'customers', (SELECT COUNT(*) FROM fx_customers), (SELECT COUNT(*) FROM cu), 0
UNION ALL SELECT 'transactions', (SELECT COUNT(*) FROM fx_transactions), (SELECT COUNT(*) FROM tx),
       (SELECT COUNT(*) FROM fx_transactions) - (SELECT COUNT(*) FROM tx)
UNION ALL SELECT 'ab_test', (SELECT COUNT(*) FROM fx_ab_test), (SELECT COUNT(*) FROM fx_ab_test), 0
"""

_BODIES["q_clean_campaigns"] = "SELECT * FROM cc"
_BODIES["q_clean_transactions"] = "SELECT * FROM tx"

_BODIES["q_quarantine_counts"] = """
SELECT rule_key, table_name, COUNT(*) AS rows_quarantined FROM (
  SELECT CASE WHEN spend < 0 THEN 'negative_spend' ELSE 'negative_revenue' END AS rule_key, 'campaigns' AS table_name
  FROM (SELECT DISTINCT * FROM fx_campaigns) WHERE spend < 0 OR revenue < 0
  UNION ALL SELECT 'duplicate_rows', 'campaigns'
  FROM (SELECT unnest(range(1, n)) FROM (SELECT *, COUNT(*) AS n FROM fx_campaigns GROUP BY ALL) WHERE n > 1)
  UNION ALL SELECT 'missing_customer_id', 'transactions' FROM fx_transactions WHERE customer_id IS NULL
  UNION ALL SELECT 'orphan_transactions', 'transactions' FROM fx_transactions
  WHERE customer_id IS NOT NULL AND customer_id NOT IN (SELECT customer_id FROM fx_customers)
) GROUP BY rule_key, table_name
"""

# ------------------------------------------------------------------ marketing
def _kpis(prefix: str = "") -> str:
    return f"""
       {_r6(_div('SUM(clicks)', 'SUM(impressions)'))} AS ctr,
       {_r6(_div('SUM(conversions)', 'SUM(clicks)'))} AS cvr,
       {_r6(_div('SUM(spend)', 'SUM(clicks)'))} AS cpc,
       {_r6(_div('SUM(spend)', 'SUM(conversions)'))} AS cpa,
       {_r6(_div('SUM(revenue)', 'SUM(spend)'))} AS roas"""


_SUMS = f"""CAST(SUM(impressions) AS BIGINT) AS impressions, CAST(SUM(clicks) AS BIGINT) AS clicks,
       CAST(SUM(conversions) AS BIGINT) AS conversions, {_r6('SUM(spend)')} AS spend, {_r6('SUM(revenue)')} AS revenue"""

for _dim in ("channel", "device", "country", "objective", "audience"):
    _BODIES[f"m3_by_{_dim}"] = f"SELECT {_dim}, {_SUMS}, {_kpis()} FROM cc WHERE {_dim} IS NOT NULL GROUP BY {_dim}"

_BODIES["m3_all_dimensions"] = "\nUNION ALL\n".join(
    f"SELECT '{d}' AS dimension, {d} AS value, {_SUMS}, {_kpis()} FROM cc WHERE {d} IS NOT NULL GROUP BY {d}"
    for d in ("channel", "device", "country", "objective", "audience"))

_BODIES["m1_funnel"] = f"""
WITH f AS (SELECT SUM(impressions) AS impressions, SUM(clicks) AS clicks, SUM(conversions) AS conversions,
                  COALESCE(SUM(spend) FILTER (WHERE spend > 0), 0) AS spend, SUM(revenue) AS revenue FROM cc)
SELECT CAST(impressions AS BIGINT) AS impressions, CAST(clicks AS BIGINT) AS clicks, CAST(conversions AS BIGINT) AS conversions,
       {_r6('spend')} AS spend, {_r6('revenue')} AS revenue,
       {_r6(_div('clicks', 'impressions'))} AS ctr, {_r6(_div('conversions', 'clicks'))} AS cvr,
       {_r6(_div('spend', 'clicks'))} AS cpc, {_r6(_div('spend', 'conversions'))} AS cpa,
       {_r6(_div('revenue', 'spend'))} AS roas
FROM f"""

_BODIES["m2_funnel_stages"] = f"""
WITH f AS (SELECT SUM(impressions) AS i, SUM(clicks) AS c, SUM(conversions) AS v FROM cc)
SELECT CAST(1 AS BIGINT) AS stage_order, 'Impressions' AS stage, CAST(i AS BIGINT) AS value, 1.0::DOUBLE AS pct_of_initial FROM f
UNION ALL SELECT 2, 'Clicks', CAST(c AS BIGINT), {_r6(_div('c', 'i'))} FROM f
UNION ALL SELECT 3, 'Conversions', CAST(v AS BIGINT), {_r6(_div('v', 'i'))} FROM f"""

_BODIES["m4_leaderboard"] = f"""
WITH perf AS (
  SELECT campaign_id, campaign_name, channel, SUM(spend) AS s, SUM(revenue) AS r, SUM(conversions) AS v
  FROM cc WHERE spend > 100 GROUP BY campaign_id, campaign_name, channel),
p AS (SELECT *, {_div('r', 's')} AS raw_roas FROM perf),
ranked AS (
  SELECT *, ROW_NUMBER() OVER (ORDER BY raw_roas DESC NULLS LAST, campaign_id) AS top_pos,
            ROW_NUMBER() OVER (ORDER BY raw_roas ASC NULLS FIRST, campaign_id DESC) AS bottom_pos FROM p),
sides AS (
  SELECT 'top' AS side, top_pos AS position, * FROM ranked WHERE top_pos <= 5
  UNION ALL SELECT 'bottom', bottom_pos, * FROM ranked WHERE bottom_pos <= 5)
SELECT side, CAST(position AS BIGINT) AS position, campaign_id, campaign_name, channel,
       {_r6('s')} AS spend, {_r6('r')} AS revenue, CAST(v AS BIGINT) AS conversions,
       raw_roas AS roas, {_r6(_div('s', 'v'))} AS cpa,
       (SELECT COUNT(*) FROM perf) AS n_campaigns
FROM sides"""

_MONTHLY = """
WITH b AS (SELECT MIN(date) AS lo, MAX(date) AS hi FROM cc),
e AS (SELECT CAST(date_trunc('month', lo) AS DATE) AS s,
             CAST(CASE WHEN hi < last_day(hi) THEN date_trunc('month', hi) - INTERVAL 1 MONTH
                       ELSE date_trunc('month', hi) END AS DATE) AS e FROM b WHERE lo IS NOT NULL),
spine AS (SELECT CAST(unnest(generate_series(CAST(s AS TIMESTAMP), CAST(e AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS month FROM e),
bm AS (SELECT CAST(date_trunc('month', date) AS DATE) AS month, SUM(revenue) AS rev FROM cc GROUP BY 1),
monthly AS (SELECT spine.month, CAST(COALESCE(bm.rev, 0) AS DOUBLE) AS revenue
            FROM spine LEFT JOIN bm ON spine.month = bm.month)
"""

_BODIES["m5_monthly_revenue"] = _MONTHLY + "SELECT month, revenue FROM monthly"
_BODIES["m6_seasonality"] = _MONTHLY + """
SELECT (SELECT month FROM monthly ORDER BY revenue DESC, month LIMIT 1) AS peak_month,
       MAX(revenue) AS peak_revenue, ROUND(AVG(revenue), 6) AS mean_revenue, COUNT(*) AS months_used
FROM monthly HAVING COUNT(*) > 0"""

_BODIES["m7_daily_revenue"] = f"SELECT date, {_r6('SUM(revenue)')} AS revenue FROM cc GROUP BY date"
_BODIES["m8_channel_mix"] = f"SELECT channel, {_r6('SUM(spend)')} AS spend, {_r6('SUM(revenue)')} AS revenue FROM cc GROUP BY channel"
_BODIES["b_row_kpis"] = f"""
SELECT campaign_id, date, channel, {_r6(_div('clicks', 'impressions'))} AS ctr, {_r6(_div('conversions', 'clicks'))} AS cvr,
       {_r6(_div('spend', 'clicks'))} AS cpc, {_r6(_div('spend', 'conversions'))} AS cpa, {_r6(_div('revenue', 'spend'))} AS roas
FROM cc"""

# ------------------------------------------------------------------ customers
_RFM_BASE = """
WITH ref AS (SELECT MAX(transaction_date) AS d FROM tx),
base AS (
  SELECT customer_id, MAX(transaction_date) AS last_purchase, COUNT(transaction_id) AS frequency, SUM(amount) AS monetary
  FROM tx WHERE NOT refund_flag GROUP BY customer_id),
b2 AS (SELECT *, CAST(date_diff('day', last_purchase, (SELECT d FROM ref)) AS BIGINT) AS recency_days FROM base)
"""

_BODIES["c1_reference_date"] = "SELECT MAX(transaction_date) AS reference_date FROM tx"
_BODIES["c2_rfm_base"] = _RFM_BASE + f"""
SELECT customer_id, last_purchase, CAST(frequency AS BIGINT) AS frequency, {_r6('monetary')} AS monetary, recency_days FROM b2"""

_RFM_SCORED = _RFM_BASE + """,
edges AS (SELECT list_sort(list_distinct(quantile_cont(recency_days, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]))) AS e,
                 COUNT(*) AS n FROM b2),
ranked AS (
  SELECT b2.*, ROW_NUMBER() OVER (ORDER BY frequency, customer_id) AS rf,
         ROW_NUMBER() OVER (ORDER BY monetary, customer_id) AS rm FROM b2),
scored AS (
  SELECT r.*,
    GREATEST(len(x.e) - 1, 1) + 1
      - (1 + len(list_filter(x.e[2:len(x.e) - 1], lambda v: r.recency_days > v))) AS R_score,
    CASE WHEN rf = 1 OR x.n <= 1 THEN 1 ELSE ((rf - 1) * 5 + x.n - 2) // (x.n - 1) END AS F_score,
    CASE WHEN rm = 1 OR x.n <= 1 THEN 1 ELSE ((rm - 1) * 5 + x.n - 2) // (x.n - 1) END AS M_score
  FROM ranked r, edges x),
seg AS (
  SELECT *, CASE
    WHEN R_score BETWEEN 4 AND 5 AND F_score BETWEEN 4 AND 5 THEN 'Champions'
    WHEN R_score BETWEEN 3 AND 5 AND F_score BETWEEN 3 AND 5 THEN 'Loyal Customers'
    WHEN R_score BETWEEN 4 AND 5 AND F_score BETWEEN 1 AND 2 THEN 'Potential Loyalists'
    WHEN R_score BETWEEN 1 AND 2 AND F_score BETWEEN 3 AND 5 THEN 'At Risk'
    WHEN R_score BETWEEN 1 AND 2 AND F_score BETWEEN 1 AND 2 THEN 'Lost Customers'
    ELSE 'Needs Attention' END AS segment
  FROM scored)
"""

_BODIES["c6_rfm_segments"] = _RFM_SCORED + f"""
SELECT s.customer_id, s.last_purchase, CAST(s.frequency AS BIGINT) AS frequency, {_r6('s.monetary')} AS monetary,
       s.recency_days, CAST(R_score AS BIGINT) AS R_score, CAST(F_score AS BIGINT) AS F_score, CAST(M_score AS BIGINT) AS M_score,
       CAST(R_score + F_score + M_score AS BIGINT) AS rfm_score, segment, c.acquisition_channel, c.subscription_plan
FROM seg s LEFT JOIN cu c ON s.customer_id = c.customer_id"""

_BODIES["c8_segment_summary"] = _RFM_SCORED + f"""
SELECT segment, COUNT(*) AS customers, ROUND(AVG(recency_days), 6) AS avg_recency_days,
       ROUND(AVG(frequency), 6) AS avg_frequency, ROUND(AVG(CAST(monetary AS DOUBLE)), 6) AS avg_monetary,
       COUNT(*)::DOUBLE / (SELECT COUNT(*) FROM seg) AS pct_of_base
FROM seg GROUP BY segment"""

_BODIES["c5_bins_used"] = _RFM_BASE + """
SELECT CAST(len(list_distinct(quantile_cont(recency_days, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]))) - 1 AS BIGINT) AS r_bins,
       CAST(LEAST(COUNT(*), 5) AS BIGINT) AS f_bins, CAST(LEAST(COUNT(*), 5) AS BIGINT) AS m_bins,
       LEAST(len(list_distinct(quantile_cont(recency_days, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]))) - 1, LEAST(COUNT(*), 5)) < 5 AS degraded
FROM b2"""

_COHORT = """
WITH act AS (
  SELECT DISTINCT t.customer_id, year(t.transaction_date) * 12 + month(t.transaction_date) - 1 AS am
  FROM tx t WHERE NOT t.refund_flag AND t.customer_id IS NOT NULL),
tagged AS (
  SELECT a.customer_id, c.acquisition_channel, year(c.acquisition_date) * 12 + month(c.acquisition_date) - 1 AS cm,
         a.am - (year(c.acquisition_date) * 12 + month(c.acquisition_date) - 1) AS k
  FROM act a JOIN cu c ON a.customer_id = c.customer_id WHERE c.acquisition_date IS NOT NULL),
sizes AS (SELECT year(acquisition_date) * 12 + month(acquisition_date) - 1 AS cm, COUNT(*) AS cohort_size
          FROM cu WHERE acquisition_date IS NOT NULL GROUP BY 1),
counts AS (
  SELECT t.cm, t.k, COUNT(DISTINCT t.customer_id) AS active, s.cohort_size
  FROM tagged t JOIN sizes s ON t.cm = s.cm
  WHERE t.k BETWEEN 0 AND 11 AND s.cohort_size >= 20 GROUP BY t.cm, t.k, s.cohort_size),
cohorts AS (
  SELECT make_date(CAST(cm // 12 AS BIGINT), CAST(cm % 12 + 1 AS BIGINT), 1) AS cohort, cm,
         CAST(k AS BIGINT) AS months_since_acquisition, CAST(active AS BIGINT) AS active_customers,
         CAST(cohort_size AS BIGINT) AS cohort_size, active::DOUBLE / cohort_size AS ret
  FROM counts)
"""

_BODIES["c10_cohort_retention"] = _COHORT + """
SELECT cohort, months_since_acquisition, active_customers, cohort_size, ret AS retention_pct FROM cohorts"""

_BODIES["c11_retention_matrix"] = _COHORT + """,
ref AS (SELECT year(MAX(transaction_date)) * 12 + month(MAX(transaction_date)) - 1 AS rm FROM tx),
months AS (SELECT DISTINCT months_since_acquisition FROM cohorts),
grid AS (SELECT DISTINCT c.cohort, c.cm, c.cohort_size, m.months_since_acquisition FROM cohorts c, months m)
SELECT g.cohort, g.cohort_size, g.months_since_acquisition, c.ret AS retention_pct,
       g.months_since_acquisition <= (SELECT rm FROM ref) - g.cm AS observed
FROM grid g LEFT JOIN cohorts c ON g.cohort = c.cohort AND g.months_since_acquisition = c.months_since_acquisition"""

_BODIES["c12_cohort_means"] = _COHORT + """
SELECT ROUND(AVG(ret) FILTER (WHERE months_since_acquisition = 0), 6) AS mean_month_0,
       ROUND(AVG(ret) FILTER (WHERE months_since_acquisition = 1), 6) AS mean_month_1,
       ROUND(AVG(ret) FILTER (WHERE months_since_acquisition = 0) - AVG(ret) FILTER (WHERE months_since_acquisition = 1), 6) AS month_0_to_1_drop,
       CAST(COUNT(DISTINCT cohort) AS BIGINT) AS n_cohorts
FROM cohorts"""

_BODIES["c16_steepest_drop"] = _COHORT + """,
means AS (SELECT months_since_acquisition, AVG(ret) AS m FROM cohorts GROUP BY 1),
d AS (SELECT months_since_acquisition, ROUND(m, 6) AS mean_retention,
             ROUND(LAG(m) OVER (ORDER BY months_since_acquisition) - m, 6) AS drop_from_previous FROM means)
SELECT *, (ROW_NUMBER() OVER (ORDER BY drop_from_previous DESC NULLS LAST, months_since_acquisition) = 1)
          AND drop_from_previous IS NOT NULL AS is_steepest
FROM d"""

_CHANNEL_RET = _COHORT + """,
chsize AS (SELECT acquisition_channel, COUNT(*) AS n FROM cu GROUP BY 1),
byc AS (
  SELECT t.acquisition_channel, CAST(t.k AS BIGINT) AS months_since_acquisition,
         CAST(COUNT(DISTINCT t.customer_id) AS BIGINT) AS active_customers, CAST(s.n AS BIGINT) AS cohort_size,
         COUNT(DISTINCT t.customer_id)::DOUBLE / s.n AS retention_pct
  FROM tagged t LEFT JOIN chsize s ON t.acquisition_channel = s.acquisition_channel
  WHERE t.k BETWEEN 0 AND 6 GROUP BY t.acquisition_channel, t.k, s.n)
"""
_BODIES["c13_retention_by_channel"] = _CHANNEL_RET + "SELECT * FROM byc"
_BODIES["c14_month3_channel_ranking"] = _CHANNEL_RET + """
SELECT acquisition_channel, retention_pct,
       ROW_NUMBER() OVER (ORDER BY retention_pct DESC NULLS LAST, acquisition_channel) AS rank
FROM byc WHERE months_since_acquisition = 3"""

_BODIES["c15_value_by_plan"] = """
WITH per AS (SELECT customer_id, SUM(profit) AS lp, COUNT(transaction_id) AS np FROM tx WHERE NOT refund_flag GROUP BY customer_id)
SELECT c.subscription_plan, COUNT(*) AS customers, ROUND(AVG(np), 6) AS avg_purchases,
       ROUND(CAST(AVG(lp) AS DOUBLE), 6) AS avg_lifetime_profit
FROM per p JOIN cu c ON p.customer_id = c.customer_id WHERE c.subscription_plan IS NOT NULL
GROUP BY c.subscription_plan"""

# ------------------------------------------------------------------ finance
_FIN = """
WITH lp AS (SELECT customer_id, SUM(profit) AS lifetime_profit FROM tx WHERE NOT refund_flag GROUP BY customer_id),
cp AS (SELECT c.customer_id, c.acquisition_channel, c.subscription_plan, COALESCE(lp.lifetime_profit, 0) AS lifetime_profit
       FROM cu c LEFT JOIN lp ON c.customer_id = lp.customer_id),
sr AS (SELECT channel, SUM(spend) AS spend, SUM(revenue) AS revenue FROM cc GROUP BY channel),
nc AS (SELECT acquisition_channel AS channel, COUNT(*) AS new_customers FROM cu GROUP BY 1),
gp AS (SELECT acquisition_channel AS channel, SUM(lifetime_profit) AS gross FROM cp GROUP BY 1),
pt AS (
  SELECT COALESCE(sr.channel, gp.channel) AS channel,
         COALESCE(CAST(sr.revenue AS DOUBLE), 0.0) AS campaign_revenue,
         COALESCE(CAST(sr.spend AS DOUBLE), 0.0) AS marketing_spend,
         COALESCE(CAST(gp.gross AS DOUBLE), 0.0) AS customer_gross_profit,
         COALESCE(CAST(gp.gross AS DOUBLE) - CAST(sr.spend AS DOUBLE), 0.0) AS net_profit
  FROM sr FULL OUTER JOIN gp ON sr.channel = gp.channel),
pt2 AS (
  SELECT pt.*, nc.new_customers,
         CAST(FLOOR(AVG(rn1) OVER (PARTITION BY campaign_revenue)) AS BIGINT) AS revenue_rank,
         CAST(FLOOR(AVG(rn2) OVER (PARTITION BY net_profit)) AS BIGINT) AS profit_rank
  FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY campaign_revenue DESC) AS rn1,
                  ROW_NUMBER() OVER (ORDER BY net_profit DESC) AS rn2 FROM pt) pt
  LEFT JOIN nc ON pt.channel = nc.channel)
"""

_BODIES["f1_lifetime_profit"] = _FIN + f"SELECT customer_id, {_r6('lifetime_profit')} AS lifetime_profit FROM lp"
_BODIES["f2_customers_profit"] = _FIN + f"""
SELECT customer_id, acquisition_channel, subscription_plan, {_r6('lifetime_profit')} AS lifetime_profit FROM cp"""


def _cac_ltv(transacting: bool) -> str:
    flt = "WHERE lifetime_profit <> 0" if transacting else ""
    return _FIN + f""",
cac AS (SELECT sr.channel, {_div('sr.spend', 'nc.new_customers')} AS cac FROM sr JOIN nc ON sr.channel = nc.channel),
ltv AS (SELECT acquisition_channel AS channel, CAST(AVG(lifetime_profit) AS DOUBLE) AS ltv FROM cp {flt} GROUP BY 1)
SELECT cac.channel, cac AS cac, ROUND(ltv, 6) AS ltv, cac = 0 AS ratio_undefined,
       ROUND(ltv / NULLIF(cac, 0), 6) AS ltv_cac_ratio,
       CASE WHEN cac = 0 THEN NULL ELSE ltv / NULLIF(cac, 0) >= 3.0 END AS clears_benchmark
FROM cac JOIN ltv ON cac.channel = ltv.channel WHERE cac IS NOT NULL AND ltv IS NOT NULL"""


_BODIES["f3_cac_ltv"] = _cac_ltv(False)
_BODIES["f3_cac_ltv_transacting"] = _cac_ltv(True)

_BODIES["f4_profitability"] = _FIN + f"""
SELECT channel, campaign_revenue, marketing_spend, customer_gross_profit, net_profit,
       revenue_rank, profit_rank, revenue_rank - profit_rank AS rank_shift,
       (campaign_revenue - marketing_spend) / NULLIF(campaign_revenue, 0) AS contribution_margin,
       customer_gross_profit / NULLIF(CAST(new_customers AS DOUBLE), 0) AS profit_per_customer,
       (customer_gross_profit - marketing_spend) / NULLIF(marketing_spend, 0) AS roi
FROM pt2"""

_BODIES["f10_net_profit_inner"] = _FIN + f"""
SELECT sr.channel, {_r6('sr.spend')} AS marketing_spend, {_r6('gp.gross')} AS customer_gross_profit,
       CAST(gp.gross AS DOUBLE) - CAST(sr.spend AS DOUBLE) AS net_profit
FROM sr JOIN gp ON sr.channel = gp.channel"""

_BODIES["f9_top_channels"] = _FIN + """
SELECT (SELECT channel FROM pt ORDER BY campaign_revenue DESC, channel DESC LIMIT 1) AS top_by_revenue,
       (SELECT channel FROM pt ORDER BY net_profit DESC, channel DESC LIMIT 1) AS top_by_profit,
       (SELECT channel FROM pt ORDER BY campaign_revenue DESC, channel DESC LIMIT 1)
         <> (SELECT channel FROM pt ORDER BY net_profit DESC, channel DESC LIMIT 1) AS rankings_disagree"""

_BODIES["f9_report_reallocation"] = _FIN + """,
el AS (
  SELECT *, net_profit / NULLIF(marketing_spend, 0) AS roi, campaign_revenue / NULLIF(marketing_spend, 0) AS roas FROM pt
  WHERE channel IN ('Google Ads', 'Facebook', 'Instagram', 'Affiliate', 'TikTok')),
pos AS (SELECT *, ROW_NUMBER() OVER (ORDER BY roi DESC NULLS LAST, channel) AS p, COUNT(*) OVER () AS n FROM el),
tot AS (SELECT SUM(marketing_spend * 0.15) FILTER (WHERE p > n - 2) AS shift, SUM(roi) FILTER (WHERE p <= 2) AS roi FROM pos)
SELECT ROUND((SELECT shift FROM tot), 6) AS shift_amount,
       string_agg(channel, ', ' ORDER BY p) FILTER (WHERE p > n - 2) AS from_channels,
       string_agg(channel, ', ' ORDER BY p) FILTER (WHERE p <= 2) AS to_channels,
       ROUND(SUM(roi / (SELECT roi FROM tot) * (SELECT shift FROM tot) * roi) FILTER (WHERE p <= 2)
             - SUM(marketing_spend * 0.15 * roi) FILTER (WHERE p > n - 2), 6) AS net_profit_change,
       ROUND(SUM(roi / (SELECT roi FROM tot) * (SELECT shift FROM tot) * roas) FILTER (WHERE p <= 2)
             - SUM(marketing_spend * 0.15 * roas) FILTER (WHERE p > n - 2), 6) AS net_revenue_change
FROM pos HAVING COUNT(*) > 0"""

_REALLOC = _FIN + """,
conf AS (SELECT COUNT(*) AS n FROM pt WHERE channel IN ('Google Ads', 'Facebook', 'Instagram', 'Affiliate', 'TikTok')),
el AS (
  SELECT pt.*, CASE WHEN (SELECT n FROM conf) >= 4 THEN 'configured' ELSE 'inferred' END AS basis,
         (customer_gross_profit - marketing_spend) / NULLIF(marketing_spend, 0) AS roi
  FROM pt
  WHERE CASE WHEN (SELECT n FROM conf) >= 4
             THEN channel IN ('Google Ads', 'Facebook', 'Instagram', 'Affiliate', 'TikTok')
             ELSE marketing_spend > 0 END),
pos AS (SELECT *, ROW_NUMBER() OVER (ORDER BY roi DESC NULLS LAST, channel) AS p, COUNT(*) OVER () AS n FROM el),
roles AS (
  SELECT *, CASE WHEN n < 4 THEN NULL WHEN p <= 2 THEN 'recipient' WHEN p > n - 2 THEN 'donor' ELSE 'hold' END AS role FROM pos),
w AS (SELECT *, CASE WHEN role = 'recipient' THEN roi / NULLIF(SUM(roi) FILTER (WHERE role = 'recipient') OVER (), 0) END AS wt
      FROM roles WHERE role IS NOT NULL),
tot AS (SELECT SUM(marketing_spend * 0.15) FILTER (WHERE role = 'donor') AS shift FROM w)
"""

_BODIES["f5_reallocation"] = _REALLOC + """,
agg AS (
  SELECT (SELECT shift FROM tot) AS shift_amount,
         SUM(marketing_spend * 0.15 * roi) FILTER (WHERE role = 'donor') AS profit_lost,
         SUM(wt * (SELECT shift FROM tot) * roi) FILTER (WHERE role = 'recipient') AS profit_gained,
         SUM(marketing_spend * 0.15 * (campaign_revenue / NULLIF(marketing_spend, 0))) FILTER (WHERE role = 'donor') AS revenue_lost,
         SUM(wt * (SELECT shift FROM tot) * (campaign_revenue / NULLIF(marketing_spend, 0))) FILTER (WHERE role = 'recipient') AS revenue_gained,
         string_agg(channel, ', ' ORDER BY p) FILTER (WHERE role = 'donor') AS from_channels,
         string_agg(channel, ', ' ORDER BY p) FILTER (WHERE role = 'recipient') AS to_channels,
         string_agg(channel, ', ' ORDER BY channel) AS channels_considered,
         MIN(basis) AS basis
  FROM w)
SELECT 0.15::DOUBLE AS shift_pct, ROUND(shift_amount, 6) AS shift_amount, from_channels, to_channels,
       ROUND(profit_lost, 6) AS profit_lost, ROUND(profit_gained, 6) AS profit_gained,
       ROUND(profit_gained - profit_lost, 6) AS net_profit_change,
       ROUND(revenue_lost, 6) AS revenue_lost, ROUND(revenue_gained, 6) AS revenue_gained,
       ROUND(revenue_gained - revenue_lost, 6) AS net_revenue_change,
       ROUND((profit_gained - profit_lost) / NULLIF(shift_amount, 0), 6) AS net_profit_per_dollar,
       basis, channels_considered
FROM agg WHERE shift_amount IS NOT NULL"""

_BODIES["f6_reallocation_plan"] = _REALLOC + """,
plan AS (
  SELECT channel, role, marketing_spend AS cur,
         CASE WHEN role = 'donor' THEN -(marketing_spend * 0.15)
              WHEN role = 'recipient' THEN wt * (SELECT shift FROM tot) ELSE 0.0 END AS chg
  FROM w)
SELECT channel, role, ROUND(cur, 6) AS current_spend, ROUND(cur + chg, 6) AS recommended_spend,
       ROUND(chg, 6) AS change, ROUND(chg / NULLIF(cur, 0), 6) AS change_pct
FROM plan"""


def _kpi_sql(transacting: bool) -> str:
    avg = "TRUE" if transacting else "FALSE"
    if transacting:
        ltv = "mean_pp"
        ltv_basis = "format('{:,} customers who transacted', n_tx)"
    else:
        ltv = "gross / NULLIF(CAST(n_cust AS DOUBLE), 0)"
        ltv_basis = "format('all {:,} customers, zero-filled', n_cust)"
    return f"""
WITH per AS (SELECT customer_id, SUM(profit) AS pp, COUNT(*) AS np FROM tx WHERE NOT refund_flag GROUP BY customer_id),
v AS (
  SELECT CAST((SELECT SUM(revenue) FROM cc) AS DOUBLE) AS rev, CAST((SELECT SUM(spend) FROM cc) AS DOUBLE) AS spend,
         CAST((SELECT SUM(conversions) FROM cc) AS DOUBLE) AS conv, CAST((SELECT SUM(clicks) FROM cc) AS DOUBLE) AS clicks,
         COALESCE(CAST((SELECT SUM(pp) FROM per) AS DOUBLE), 0.0) AS gross,
         (SELECT COUNT(*) FROM per) AS n_tx, CAST((SELECT AVG(pp) FROM per) AS DOUBLE) AS mean_pp,
         (SELECT COUNT(*) FROM per WHERE np > 1) AS repeaters, (SELECT COUNT(*) FROM cu) AS n_cust),
k AS (SELECT *, {ltv} AS ltv, spend / NULLIF(CAST(n_cust AS DOUBLE), 0) AS cac FROM v)
SELECT CAST(kpi_order AS BIGINT) AS kpi_order, kpi,
       CASE WHEN {avg} AND kpi IN ('blended_ltv', 'ltv_cac_ratio') THEN ROUND(value, 6) ELSE value END AS value, basis FROM (
  SELECT 1 AS kpi_order, 'total_revenue' AS kpi, rev AS value, 'campaign-attributed' AS basis FROM k
  UNION ALL SELECT 2, 'total_spend', spend, 'campaign media spend' FROM k
  UNION ALL SELECT 3, 'total_gross_profit', gross, 'non-refunded transaction profit' FROM k
  UNION ALL SELECT 4, 'total_net_profit', gross - spend, 'transaction profit less marketing spend' FROM k
  UNION ALL SELECT 5, 'blended_cac', cac, format('spend / all {{:,}} customers', n_cust) FROM k
  UNION ALL SELECT 6, 'blended_ltv', ltv, {ltv_basis} FROM k
  UNION ALL SELECT 7, 'ltv_cac_ratio', ltv / NULLIF(cac, 0), 'same denominator on both sides' FROM k
  UNION ALL SELECT 8, 'blended_roas', rev / NULLIF(spend, 0), 'campaign revenue / spend' FROM k
  UNION ALL SELECT 9, 'blended_roi', (gross - spend) / NULLIF(spend, 0), 'transaction profit / spend' FROM k
  UNION ALL SELECT 10, 'blended_cvr', conv / NULLIF(clicks, 0), 'conversions / clicks' FROM k
  UNION ALL SELECT 11, 'repeat_rate', COALESCE(CAST(repeaters AS DOUBLE) / NULLIF(CAST(n_tx AS DOUBLE), 0), 0.0),
                   'share of transacting customers with >1 purchase' FROM k)"""


_BODIES["f7_headline_kpis"] = _kpi_sql(False)
_BODIES["f7_headline_kpis_transacting"] = _kpi_sql(True)


def oracle_sql() -> dict:
    return {k: with_fixtures(v) for k, v in _BODIES.items()}


# ------------------------------------------------------------------ SQL corpus (raw tables)
_S = {}
_S["s01_monthly_revenue_spend"] = """
SELECT strftime(date, '%Y-%m') AS month, CAST(ROUND(SUM(revenue), 2) AS DOUBLE) AS total_revenue,
       CAST(ROUND(SUM(spend), 2) AS DOUBLE) AS total_spend
FROM fx_campaigns GROUP BY 1"""
_S["s02_monthly_profit"] = """
SELECT strftime(transaction_date, '%Y-%m') AS month, CAST(ROUND(SUM(profit), 2) AS DOUBLE) AS total_profit,
       COUNT(*) AS transaction_count
FROM fx_transactions WHERE NOT refund_flag GROUP BY 1"""
_S["s03_campaign_roas"] = """
SELECT campaign_id, campaign_name, channel, CAST(ROUND(SUM(spend), 2) AS DOUBLE) AS total_spend,
       CAST(ROUND(SUM(revenue), 2) AS DOUBLE) AS total_revenue,
       ROUND(CAST(SUM(revenue) AS DOUBLE) / NULLIF(CAST(SUM(spend) AS DOUBLE), 0), 2) AS roas,
       CASE WHEN CAST(SUM(revenue) AS DOUBLE) / NULLIF(CAST(SUM(spend) AS DOUBLE), 0) >= 4 THEN 'Excellent'
            WHEN CAST(SUM(revenue) AS DOUBLE) / NULLIF(CAST(SUM(spend) AS DOUBLE), 0) >= 2 THEN 'Healthy'
            WHEN CAST(SUM(revenue) AS DOUBLE) / NULLIF(CAST(SUM(spend) AS DOUBLE), 0) >= 1 THEN 'Break-even'
            ELSE 'Underperforming' END AS performance_tier
FROM fx_campaigns WHERE spend > 0
GROUP BY campaign_id, campaign_name, channel HAVING SUM(spend) > 500
ORDER BY roas DESC NULLS LAST, campaign_id LIMIT 15"""
_S["s04_channel_roi"] = """
WITH g AS (SELECT channel, SUM(spend) AS s, SUM(revenue) AS r FROM fx_campaigns WHERE spend > 0 GROUP BY channel HAVING SUM(spend) > 1000),
x AS (SELECT *, (CAST(r AS DOUBLE) - CAST(s AS DOUBLE)) / NULLIF(CAST(s AS DOUBLE), 0) AS roi FROM g)
SELECT channel, CAST(ROUND(s, 2) AS DOUBLE) AS total_spend, CAST(ROUND(r, 2) AS DOUBLE) AS total_revenue,
       ROUND(roi, 3) AS roi,
       CASE WHEN roi >= 1 THEN 'High ROI' WHEN roi >= 0.3 THEN 'Moderate ROI' ELSE 'Low / Negative ROI' END AS roi_tier
FROM x"""
_S["s05_cac_by_channel"] = """
WITH s AS (SELECT channel, SUM(spend) AS total_spend FROM fx_campaigns GROUP BY channel),
c AS (SELECT acquisition_channel AS channel, COUNT(*) AS new_customers FROM fx_customers GROUP BY acquisition_channel)
SELECT s.channel, CAST(ROUND(s.total_spend, 2) AS DOUBLE) AS total_spend, c.new_customers,
       ROUND(CAST(s.total_spend AS DOUBLE) / NULLIF(CAST(c.new_customers AS DOUBLE), 0), 2) AS cac
FROM s JOIN c ON s.channel = c.channel"""
_S["s06_ltv_by_channel"] = """
WITH cp AS (SELECT customer_id, SUM(profit) AS lifetime_profit FROM fx_transactions GROUP BY customer_id)
SELECT cu.acquisition_channel, COUNT(DISTINCT cu.customer_id) AS customers,
       CAST(ROUND(AVG(cp.lifetime_profit), 2) AS DOUBLE) AS avg_ltv
FROM fx_customers cu JOIN cp ON cu.customer_id = cp.customer_id GROUP BY cu.acquisition_channel"""
_S["s07_ltv_cac"] = """
WITH s AS (SELECT channel, SUM(spend) AS total_spend FROM fx_campaigns GROUP BY channel),
c AS (SELECT acquisition_channel AS channel, COUNT(*) AS new_customers FROM fx_customers GROUP BY acquisition_channel),
cac_tbl AS (SELECT s.channel, CAST(s.total_spend AS DOUBLE) / NULLIF(CAST(c.new_customers AS DOUBLE), 0) AS cac
            FROM s JOIN c ON s.channel = c.channel),
ltv_tbl AS (SELECT cu.acquisition_channel AS channel, AVG(cp.lifetime_profit) AS ltv
            FROM fx_customers cu JOIN (SELECT customer_id, SUM(profit) AS lifetime_profit FROM fx_transactions GROUP BY customer_id) cp
            ON cu.customer_id = cp.customer_id GROUP BY cu.acquisition_channel)
SELECT l.channel, ROUND(c.cac, 2) AS cac, CAST(ROUND(l.ltv, 2) AS DOUBLE) AS ltv,
       ROUND(CAST(l.ltv AS DOUBLE) / NULLIF(c.cac, 0), 2) AS ltv_to_cac_ratio,
       CASE WHEN CAST(l.ltv AS DOUBLE) / NULLIF(c.cac, 0) >= 3 THEN 'Efficient'
            WHEN CAST(l.ltv AS DOUBLE) / NULLIF(c.cac, 0) >= 1 THEN 'Marginal' ELSE 'Unprofitable' END AS efficiency
FROM ltv_tbl l JOIN cac_tbl c ON l.channel = c.channel"""
_S["s08_cohort_activity"] = """
WITH cohort AS (SELECT customer_id, strftime(acquisition_date, '%Y-%m') AS cohort_month FROM fx_customers),
activity AS (SELECT t.customer_id, c.cohort_month, strftime(t.transaction_date, '%Y-%m') AS activity_month
             FROM fx_transactions t JOIN cohort c ON t.customer_id = c.customer_id),
md AS (SELECT customer_id, cohort_month,
              (CAST(substr(activity_month, 1, 4) AS INT) - CAST(substr(cohort_month, 1, 4) AS INT)) * 12
              + (CAST(substr(activity_month, 6, 2) AS INT) - CAST(substr(cohort_month, 6, 2) AS INT)) AS months_since_acquisition
       FROM activity)
SELECT cohort_month, CAST(months_since_acquisition AS BIGINT) AS months_since_acquisition,
       COUNT(DISTINCT customer_id) AS active_customers
FROM md WHERE months_since_acquisition BETWEEN 0 AND 6 GROUP BY cohort_month, months_since_acquisition"""
_S["s09_top_customers"] = """
SELECT cu.customer_id, cu.acquisition_channel, cu.subscription_plan,
       CAST(ROUND(SUM(t.profit), 2) AS DOUBLE) AS lifetime_profit, COUNT(t.transaction_id) AS total_purchases
FROM fx_customers cu JOIN fx_transactions t ON cu.customer_id = t.customer_id
GROUP BY cu.customer_id, cu.acquisition_channel, cu.subscription_plan
ORDER BY lifetime_profit DESC, cu.customer_id LIMIT 10"""
_S["s10_campaign_ranks"] = """
SELECT channel, campaign_name, CAST(total_revenue AS DOUBLE) AS total_revenue,
       ROW_NUMBER() OVER (PARTITION BY channel ORDER BY total_revenue DESC, campaign_name) AS row_num,
       RANK() OVER (PARTITION BY channel ORDER BY total_revenue DESC) AS rank_num,
       DENSE_RANK() OVER (PARTITION BY channel ORDER BY total_revenue DESC) AS dense_rank_num
FROM (SELECT channel, campaign_name, SUM(revenue) AS total_revenue FROM fx_campaigns GROUP BY channel, campaign_name) t"""
_S["s11_moving_average"] = """
WITH d AS (SELECT date, SUM(revenue) AS revenue FROM fx_campaigns GROUP BY date)
SELECT date, CAST(revenue AS DOUBLE) AS revenue,
       CAST(ROUND(AVG(revenue) OVER (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 2) AS DOUBLE) AS revenue_7day_moving_avg
FROM d"""
_S["s12_running_total"] = """
WITH d AS (SELECT date, SUM(revenue) AS revenue FROM fx_campaigns GROUP BY date)
SELECT date, CAST(revenue AS DOUBLE) AS revenue,
       CAST(ROUND(SUM(revenue) OVER (ORDER BY date ROWS UNBOUNDED PRECEDING), 2) AS DOUBLE) AS cumulative_revenue
FROM d"""
_S["s13_mom_growth"] = """
WITH m AS (SELECT strftime(date, '%Y-%m') AS month, CAST(SUM(revenue) AS DOUBLE) AS revenue FROM fx_campaigns GROUP BY 1)
SELECT month, revenue, LAG(revenue) OVER (ORDER BY month) AS prior_month_revenue,
       ROUND((revenue - LAG(revenue) OVER (ORDER BY month)) * 100.0 / NULLIF(LAG(revenue) OVER (ORDER BY month), 0), 1) AS mom_growth_pct
FROM m"""
_S["s14_device_rates"] = """
SELECT device, CAST(SUM(impressions) AS BIGINT) AS impressions, CAST(SUM(clicks) AS BIGINT) AS clicks,
       CAST(SUM(conversions) AS BIGINT) AS conversions,
       ROUND(SUM(clicks) * 100.0 / NULLIF(SUM(impressions), 0), 2) AS ctr_pct,
       ROUND(SUM(conversions) * 100.0 / NULLIF(SUM(clicks), 0), 2) AS cvr_pct,
       CASE WHEN SUM(conversions) * 100.0 / NULLIF(SUM(clicks), 0) >= 4 THEN 'Strong Converter'
            ELSE 'Needs Optimization' END AS device_status
FROM fx_campaigns GROUP BY device"""
_S["s15_country_roas"] = """
SELECT country, CAST(ROUND(SUM(spend), 2) AS DOUBLE) AS total_spend, CAST(ROUND(SUM(revenue), 2) AS DOUBLE) AS total_revenue,
       ROUND(CAST(SUM(revenue) AS DOUBLE) / NULLIF(CAST(SUM(spend) AS DOUBLE), 0), 2) AS roas
FROM fx_campaigns WHERE spend > 0 GROUP BY country HAVING SUM(spend) > 500"""
_S["s16_power_users"] = """
SELECT cu.customer_id, cu.acquisition_channel, cu.subscription_plan,
       COUNT(t.transaction_id) AS purchase_count, CAST(ROUND(SUM(t.amount), 2) AS DOUBLE) AS total_spent
FROM fx_customers cu JOIN fx_transactions t ON cu.customer_id = t.customer_id
GROUP BY cu.customer_id, cu.acquisition_channel, cu.subscription_plan HAVING COUNT(t.transaction_id) > 5"""
_S["s17_refunds_by_category"] = """
SELECT product_category, COUNT(*) AS total_transactions,
       CAST(SUM(CASE WHEN refund_flag THEN 1 ELSE 0 END) AS BIGINT) AS refunded_transactions,
       ROUND(SUM(CASE WHEN refund_flag THEN 1 ELSE 0 END) * 100.0 / COUNT(*), 2) AS refund_rate_pct,
       CAST(ROUND(SUM(CASE WHEN refund_flag THEN profit ELSE 0 END), 2) AS DOUBLE) AS profit_lost_to_refunds
FROM fx_transactions GROUP BY product_category"""
_S["s18_discount_bands"] = """
SELECT CASE WHEN discount = 0 THEN '0% (Full Price)' WHEN discount <= 0.10 THEN '5-10%'
            WHEN discount <= 0.20 THEN '15-20%' ELSE '30%+' END AS discount_band,
       COUNT(*) AS transactions, CAST(ROUND(AVG(amount), 2) AS DOUBLE) AS avg_order_value,
       ROUND(CAST(SUM(profit) AS DOUBLE) / NULLIF(CAST(SUM(amount) AS DOUBLE), 0), 3) AS realized_margin
FROM fx_transactions WHERE NOT refund_flag GROUP BY 1"""
_S["s19_variant_comparison"] = """
SELECT variant, CAST(SUM(impressions) AS BIGINT) AS impressions, CAST(SUM(clicks) AS BIGINT) AS clicks,
       CAST(SUM(conversions) AS BIGINT) AS conversions,
       ROUND(SUM(conversions) * 100.0 / NULLIF(SUM(clicks), 0), 2) AS cvr_pct,
       CAST(ROUND(SUM(revenue), 2) AS DOUBLE) AS revenue,
       ROUND(CAST(SUM(revenue) AS DOUBLE) / NULLIF(CAST(SUM(spend) AS DOUBLE), 0), 2) AS roas
FROM fx_ab_test GROUP BY variant"""
_S["s20_rfm_ntile"] = """
WITH rfm_base AS (
  SELECT customer_id, CAST(date_diff('day', MAX(transaction_date), DATE '2025-12-31') AS BIGINT) AS recency_days,
         COUNT(*) AS frequency, ROUND(SUM(amount), 2) AS monetary
  FROM fx_transactions WHERE NOT refund_flag GROUP BY customer_id),
scored AS (
  SELECT customer_id, recency_days, frequency, CAST(monetary AS DOUBLE) AS monetary, monetary AS m_raw,
         CAST(NTILE(5) OVER (ORDER BY recency_days DESC, customer_id) AS BIGINT) AS recency_score,
         CAST(NTILE(5) OVER (ORDER BY frequency ASC, customer_id) AS BIGINT) AS frequency_score,
         CAST(NTILE(5) OVER (ORDER BY monetary ASC, customer_id) AS BIGINT) AS monetary_score
  FROM rfm_base)
SELECT customer_id, recency_days, frequency, monetary, recency_score, frequency_score, monetary_score
FROM scored ORDER BY m_raw DESC, customer_id LIMIT 25"""
_S["s21_orphans"] = """
SELECT t.transaction_id, t.customer_id, t.transaction_date, CAST(t.amount AS DOUBLE) AS amount
FROM fx_transactions t LEFT JOIN fx_customers cu ON t.customer_id = cu.customer_id
WHERE cu.customer_id IS NULL"""
_BODIES.update(_S)


# ------------------------------------------------------------------ experiments
_AB_SUMS = """
WITH s AS (
  SELECT 'ab_test' AS experiment,
         SUM(clicks) FILTER (WHERE variant = 'A') AS na, SUM(clicks) FILTER (WHERE variant = 'B') AS nb,
         SUM(conversions) FILTER (WHERE variant = 'A') AS ca, SUM(conversions) FILTER (WHERE variant = 'B') AS cb,
         SUM(revenue) FILTER (WHERE variant = 'B') AS rb, SUM(spend) FILTER (WHERE variant = 'A') AS sa
  FROM ab),
d AS (
  SELECT variant, conversions::DOUBLE / clicks AS r FROM ab WHERE clicks <> 0),
m AS (
  SELECT COUNT(*) FILTER (WHERE variant = 'A') AS n_a, COUNT(*) FILTER (WHERE variant = 'B') AS n_b,
         AVG(r) FILTER (WHERE variant = 'A') AS mean_a, AVG(r) FILTER (WHERE variant = 'B') AS mean_b,
         VAR_SAMP(r) FILTER (WHERE variant = 'A') AS var_a, VAR_SAMP(r) FILTER (WHERE variant = 'B') AS var_b
  FROM d),
x AS (
  SELECT s.*, m.*, ca::DOUBLE / na AS pa, cb::DOUBLE / nb AS pb, (ca + cb)::DOUBLE / (na + nb) AS pool,
         var_a / n_a AS va, var_b / n_b AS vb, sa::DOUBLE / NULLIF(na::DOUBLE, 0) AS cpc_a
  FROM s, m)
"""

_BODIES["e1_variant_summary"] = """
SELECT 'ab_test' AS experiment, variant, CAST(SUM(impressions) AS BIGINT) AS impressions, CAST(SUM(clicks) AS BIGINT) AS clicks,
       CAST(SUM(conversions) AS BIGINT) AS conversions, CAST(SUM(revenue) AS DOUBLE) AS revenue, CAST(SUM(spend) AS DOUBLE) AS spend,
       CAST(SUM(conversions) AS DOUBLE) / NULLIF(CAST(SUM(clicks) AS DOUBLE), 0) AS cvr,
       CAST(SUM(revenue) AS DOUBLE) / NULLIF(CAST(SUM(spend) AS DOUBLE), 0) AS roas
FROM ab GROUP BY variant"""

_BODIES["e2_ab_statistics"] = _AB_SUMS + """
SELECT experiment, CASE WHEN na > 0 AND nb > 0 THEN 'ok' ELSE 'insufficient_data' END AS status,
       ROUND(pa, 6) AS cvr_a, ROUND(pb, 6) AS cvr_b, ROUND((pb - pa) / pa, 6) AS lift_pct,
       ROUND((pb - pa) / sqrt(pool * (1.0 - pool) * (1.0 / nb + 1.0 / na)), 6) AS z_stat,
       ROUND((pb - pa) - 1.959963984540054 * sqrt(pb * (1.0 - pb) / nb + pa * (1.0 - pa) / na), 6) AS ci_low,
       ROUND((pb - pa) + 1.959963984540054 * sqrt(pb * (1.0 - pb) / nb + pa * (1.0 - pa) / na), 6) AS ci_high,
       (pb - pa) - 1.959963984540054 * sqrt(pb * (1.0 - pb) / nb + pa * (1.0 - pa) / na) > 0 AS ci_excludes_zero,
       ROUND(CASE WHEN n_a >= 2 AND n_b >= 2 THEN (mean_b - mean_a) / sqrt(va + vb) END, 6) AS t_stat,
       ROUND(CASE WHEN n_a >= 2 AND n_b >= 2 THEN (va + vb) * (va + vb) / (va * va / (n_a - 1) + vb * vb / (n_b - 1)) END, 6) AS welch_df,
       CAST(LEAST(COALESCE(n_a, 0), COALESCE(n_b, 0)) AS BIGINT) AS n_days,
       cpc_a IS NOT NULL AND cpc_a <> 0 AS projection_available,
       CAST(ca AS DOUBLE) AS current_conversions,
       ROUND(sa::DOUBLE / cpc_a * pb, 6) AS projected_conversions,
       ROUND(sa::DOUBLE / cpc_a * pb - ca, 6) AS incremental_conversions,
       ROUND((sa::DOUBLE / cpc_a * pb - ca) * (rb::DOUBLE / NULLIF(cb::DOUBLE, 0)), 6) AS incremental_revenue
FROM x"""

# Tails by numeric integration: Simpson's rule over 20,000 intervals from 0 to the statistic.
def _area(density: str, upper: str) -> str:
    return f"""(SELECT {upper} / 60000.0 * SUM(CASE WHEN i IN (0, 20000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END * {density})
                FROM (SELECT i, {upper} * i / 20000.0 AS u FROM range(0, 20001) r(i)))"""


def _normal_tail(z: str) -> str:
    return f"0.5 - {_area('exp(-u * u / 2) / sqrt(2 * pi())', z)}"


def _t_tail(t: str, df: str) -> str:
    scale = f"exp(lgamma(({df} + 1) / 2) - lgamma({df} / 2)) / sqrt({df} * pi())"
    return f"0.5 - {scale} * {_area(f'power(1 + u * u / {df}, -({df} + 1) / 2)', t)}"


_BODIES["e3_ab_test"] = f"""
WITH stats AS (SELECT * FROM ({_BODIES["e2_ab_statistics"]})),
raw AS ({_AB_SUMS}
  SELECT (pb - pa) / sqrt(pool * (1.0 - pool) * (1.0 / nb + 1.0 / na)) AS z,
         CASE WHEN n_a >= 2 AND n_b >= 2 THEN (mean_b - mean_a) / sqrt(va + vb) END AS t,
         CASE WHEN n_a >= 2 AND n_b >= 2 THEN (va + vb) * (va + vb) / (va * va / (n_a - 1) + vb * vb / (n_b - 1)) END AS df
  FROM x),
p AS (SELECT {_normal_tail('raw.z')} AS pz, {_t_tail('raw.t', 'raw.df')} AS pt FROM raw)
SELECT stats.*, ROUND(pz, 6) AS p_value_z, ROUND(pt, 6) AS p_value_t, CAST(0.05 AS DOUBLE) AS alpha,
       COALESCE(pt < 0.05, FALSE) AS significant
FROM stats, p"""

# ------------------------------------------------------------------ forecast (closed-form methods)
_SERIES = """
WITH b AS (SELECT MIN(date) AS lo, MAX(date) AS hi FROM cc),
e AS (SELECT CAST(date_trunc('month', lo) AS DATE) AS s,
             CAST(CASE WHEN hi < last_day(hi) THEN date_trunc('month', hi) - INTERVAL 1 MONTH
                       ELSE date_trunc('month', hi) END AS DATE) AS e FROM b WHERE lo IS NOT NULL),
spine AS (SELECT CAST(unnest(generate_series(CAST(s AS TIMESTAMP), CAST(e AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS month FROM e),
bm AS (SELECT CAST(date_trunc('month', date) AS DATE) AS month, SUM(revenue) AS rev FROM cc GROUP BY 1),
ser AS (SELECT spine.month, CAST(COALESCE(bm.rev, 0) AS DECIMAL(28,4)) AS y,
               CAST(ROW_NUMBER() OVER (ORDER BY spine.month) - 1 AS BIGINT) AS idx, COUNT(*) OVER () AS n
        FROM spine LEFT JOIN bm ON spine.month = bm.month)
"""


def _fit(src: str, name: str) -> str:
    return f"""
{name}_s AS (SELECT COUNT(*) AS k, SUM(idx) AS sx, SUM(idx * idx) AS sxx, SUM(y) AS sy, SUM(idx * y) AS sxy,
                    SUM(CAST(y AS DOUBLE) * CAST(y AS DOUBLE)) AS syy FROM {src}),
{name} AS (SELECT *, CAST(k * sxy - sx * sy AS DOUBLE) / NULLIF(CAST(k * sxx - sx * sx AS DOUBLE), 0) AS slope FROM {name}_s),
{name}_f AS (SELECT *, (CAST(sy AS DOUBLE) - slope * CAST(sx AS DOUBLE)) / CAST(k AS DOUBLE) AS intercept FROM {name})"""


_BACKTEST = _SERIES + f""",
train AS (SELECT * FROM ser WHERE n >= 6 AND idx < n - 3),
test AS (SELECT idx, CAST(y AS DOUBLE) AS actual FROM ser WHERE n >= 6 AND idx >= n - 3),
ma AS (SELECT CAST(SUM(y) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS level FROM train
       WHERE idx > (SELECT MAX(idx) FROM train) - 3),
{_fit('train', 'lt')},
preds AS (
  SELECT 'moving_average' AS method, 0 AS method_order, t.idx, t.actual, (SELECT level FROM ma) AS pred FROM test t
  UNION ALL
  SELECT 'linear_trend', 1, t.idx, t.actual, f.slope * CAST(t.idx AS DOUBLE) + f.intercept FROM test t, lt_f f WHERE f.k >= 3),
err AS (SELECT method, method_order, sqrt(AVG(power(actual - pred, 2))) AS rmse, AVG(abs(actual - pred)) AS mae
        FROM preds GROUP BY method, method_order),
ranked AS (SELECT *, ROW_NUMBER() OVER (ORDER BY rmse, method_order) AS rank FROM err)
"""

_BODIES["t5_backtest_closed_form"] = _BACKTEST + """
SELECT 'campaign_revenue' AS series, method,
       CASE method WHEN 'moving_average' THEN 'Moving Average' ELSE 'Linear Trend' END AS label,
       CAST(method_order AS BIGINT) AS method_order, 'ok' AS status, ROUND(rmse, 6) AS rmse, ROUND(mae, 6) AS mae,
       CAST(rank AS BIGINT) AS rank, CAST(3 AS BIGINT) AS test_months
FROM ranked"""

_BODIES["t6_trend"] = _SERIES + f""",
{_fit('ser', 'whole')}
SELECT 'campaign_revenue' AS series, CAST(k AS BIGINT) AS n_months, ROUND(slope, 6) AS slope_per_month,
       ROUND(intercept, 6) AS intercept,
       ROUND(CAST(k * sxy - sx * sy AS DOUBLE) * CAST(k * sxy - sx * sy AS DOUBLE)
             / (CAST(k * sxx - sx * sx AS DOUBLE) * (CAST(k AS DOUBLE) * syy - CAST(sy AS DOUBLE) * CAST(sy AS DOUBLE))), 6) AS r_squared,
       ROUND(CASE WHEN slope < 0 AND intercept > 0 THEN -intercept / slope - CAST(k AS DOUBLE) END, 6) AS months_until_zero
FROM whole_f WHERE k >= 3"""

_BODIES["t6_trend_p_value"] = f"""
WITH plain AS (SELECT * FROM ({_BODIES["t6_trend"]})),
r AS ({_SERIES},
{_fit('ser', 'whole')}
  SELECT k, CAST(k * sxy - sx * sy AS DOUBLE) * CAST(k * sxy - sx * sy AS DOUBLE)
            / (CAST(k * sxx - sx * sx AS DOUBLE) * (CAST(k AS DOUBLE) * syy - CAST(sy AS DOUBLE) * CAST(sy AS DOUBLE))) AS r2
  FROM whole_f WHERE k >= 3),
raw AS (SELECT sqrt(r2) * sqrt(k - 2.0) / sqrt(1.0 - r2) AS t, k - 2.0 AS df FROM r),
p AS (SELECT 2 * ({_t_tail('raw.t', 'raw.df')}) AS p FROM raw)
SELECT plain.*, ROUND(p, 6) AS p_value, p < 0.05 AS significant,
       CASE WHEN p >= 0.05 THEN 'The fitted trend is not statistically distinguishable from zero; treat the projection as a level estimate, not a direction.' END AS caveat
FROM plain, p"""

_BODIES["t7_forecast_closed_form"] = _BACKTEST + f""",
{_fit('ser', 'whole')},
win AS (SELECT method FROM ranked WHERE rank = 1),
last AS (SELECT MAX(month) AS lm, MAX(n) AS n FROM ser),
steps AS (SELECT unnest(range(1, 4)) AS step),
ma_full AS (SELECT CAST(SUM(y) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS level FROM ser WHERE idx > (SELECT MAX(idx) FROM ser) - 3),
fc AS (
  SELECT st.step, CAST(l.lm + st.step * INTERVAL 1 MONTH AS DATE) AS month,
         CASE WHEN (SELECT method FROM win) = 'moving_average' THEN (SELECT level FROM ma_full)
              ELSE f.slope * CAST(l.n + st.step - 1 AS DOUBLE) + f.intercept END AS pred
  FROM steps st, last l, whole_f f)
SELECT 'campaign_revenue' AS series, (SELECT method FROM win) AS method, CAST(step AS BIGINT) AS step, month,
       ROUND(pred, 6) AS forecast_revenue, ROUND(SUM(pred) OVER (), 6) AS total
FROM fc"""


# ------------------------------------------------------------------ many series, rolling origins
_MANY = """
WITH b AS (SELECT MIN(date) AS lo, MAX(date) AS hi FROM cc),
spine AS (
  SELECT CAST(unnest(generate_series(CAST(date_trunc('month', lo) AS TIMESTAMP), CAST(CASE WHEN hi < last_day(hi)
    THEN date_trunc('month', hi) - INTERVAL 1 MONTH ELSE date_trunc('month', hi) END AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS month
  FROM b WHERE lo IS NOT NULL),
pts AS (
  SELECT 'total' AS kind, 'all' AS series, date, revenue FROM cc
  UNION ALL SELECT 'channel', channel, date, revenue FROM cc WHERE channel IS NOT NULL
  UNION ALL SELECT 'country', country, date, revenue FROM cc WHERE country IS NOT NULL
  UNION ALL SELECT 'campaign', campaign_id, date, revenue FROM cc WHERE campaign_id IS NOT NULL),
bm AS (SELECT kind, series, CAST(date_trunc('month', date) AS DATE) AS month, SUM(revenue) AS rev FROM pts GROUP BY ALL),
ser AS (
  SELECT k.kind, k.series, spine.month, CAST(COALESCE(bm.rev, 0) AS DECIMAL(28,4)) AS y,
         CAST(ROW_NUMBER() OVER (PARTITION BY k.kind, k.series ORDER BY spine.month) - 1 AS BIGINT) AS idx,
         COUNT(*) OVER (PARTITION BY k.kind, k.series) AS n
  FROM (SELECT DISTINCT kind, series FROM bm) k CROSS JOIN spine
  LEFT JOIN bm ON bm.kind = k.kind AND bm.series = k.series AND bm.month = spine.month),
fit AS (
  SELECT o.kind, o.series, o.idx::HUGEINT AS k, o.n, SUM(t.idx)::HUGEINT AS sx, SUM(t.idx * t.idx)::HUGEINT AS sxx,
         SUM(t.u)::HUGEINT AS sy, SUM(t.idx * t.u)::HUGEINT AS sxy,
         SUM(t.u) FILTER (t.idx >= o.idx - 3)::HUGEINT AS level, COUNT(*) FILTER (t.idx >= o.idx - 3)::HUGEINT AS months
  FROM (SELECT kind, series, idx, n FROM ser UNION ALL SELECT DISTINCT kind, series, n, n FROM ser) o
  JOIN (SELECT *, CAST(y * 10000 AS HUGEINT) AS u FROM ser) t ON t.kind = o.kind AND t.series = o.series AND t.idx < o.idx
  WHERE o.idx >= 3 GROUP BY o.kind, o.series, o.idx, o.n),
lines AS (SELECT *, k * sxx - sx * sx AS spread, k * sxy - sx * sy AS rise,
                 sign(level) * ((200 * abs(level) + months) // (2 * months)) AS ma FROM fit),
at_x AS (
  SELECT l.*, s.step, l.k + s.step - 1 AS x, l.rise * ((l.k + s.step - 1) * l.k - l.sx) + l.sy * l.spread AS num
  FROM lines l CROSS JOIN (SELECT unnest(range(1, 4)) AS step) s),
preds AS (
  SELECT kind, series, k, n, step, x, ma::BIGINT AS ma, (sign(num) * ((200 * abs(num) + spread * k) // (2 * spread * k)))::BIGINT AS lt FROM at_x),
bt AS (
  SELECT p.kind, p.series, p.k::BIGINT AS train_months, p.step, t.month, CAST(t.y * 1000000 AS BIGINT) AS actual, p.ma, p.lt
  FROM preds p JOIN ser t ON t.kind = p.kind AND t.series = p.series AND t.idx = p.x WHERE p.k <= p.n - 3),
err AS (
  SELECT kind, series, 'moving_average' AS method, 0 AS mo, train_months, (actual - ma)::HUGEINT AS e FROM bt
  UNION ALL SELECT kind, series, 'linear_trend', 1, train_months, (actual - lt)::HUGEINT FROM bt),
score AS (
  SELECT kind, series, method, mo, COUNT(DISTINCT train_months) AS origins, COUNT(*) AS points,
         SUM(e * e) AS squares, SUM(abs(e)) AS absolute FROM err GROUP BY kind, series, method, mo),
ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY kind, series ORDER BY squares, mo) AS rank FROM score)
"""
_BODIES["t5_rolling_backtest"] = _MANY + """
SELECT kind, series, train_months, step, month, actual / 1e6 AS actual, ma / 1e6 AS moving_average, lt / 1e6 AS linear_trend FROM bt"""
_BODIES["t5_rolling_ranking"] = _MANY + """
SELECT kind, series, method, origins, ROUND(sqrt(squares::DOUBLE / points) / 1e6, 6) AS rmse,
       ROUND(absolute::DOUBLE / points / 1e6, 6) AS mae, rank FROM ranked"""
_BODIES["t7_rolling_forecast"] = _MANY + """,
f AS (
  SELECT p.kind, p.series, r.method, p.step, p.n, (SELECT MAX(month) FROM spine) AS last,
         CASE WHEN r.method = 'moving_average' THEN p.ma ELSE p.lt END AS pred
  FROM preds p JOIN ranked r ON r.kind = p.kind AND r.series = p.series AND r.rank = 1 WHERE p.k = p.n)
SELECT kind, series, method, CASE method WHEN 'moving_average' THEN 'Moving Average' ELSE 'Linear Trend' END AS label,
       CAST(step AS BIGINT) AS step, CAST(last + step * INTERVAL 1 MONTH AS DATE) AS month, pred / 1e6 AS forecast_revenue,
       SUM(pred) OVER (PARTITION BY kind, series)::DOUBLE / 1e6 AS total,
       SUM(sign(pred) * ((abs(pred) + 5000) // 10000)) OVER (PARTITION BY kind, series)::DOUBLE / 100 AS total_of_rounded_months,
       n AS history_months, last AS last_actual_month
FROM f"""

# ------------------------------------------------------------------ coverage
_BODIES["a5_as_of_channel_kpis"] = (
    f"SELECT channel, {_SUMS}, {_kpis()} FROM cc WHERE date <= DATE '1998-12-31' AND channel IS NOT NULL GROUP BY channel")

_SPANS = """
WITH spans AS (
  SELECT 'campaigns' AS t, COUNT(*) AS n, MIN(date) AS lo, MAX(date) AS hi FROM cc
  UNION ALL SELECT 'customers', COUNT(*), MIN(acquisition_date), MAX(acquisition_date) FROM cu
  UNION ALL SELECT 'transactions', COUNT(*), MIN(transaction_date), MAX(transaction_date) FROM tx
  UNION ALL SELECT 'ab_test', COUNT(*), MIN(date), MAX(date) FROM ab),
m AS (SELECT COALESCE(MAX(CASE WHEN n > 0 THEN (year(hi) - year(lo)) * 12 + month(hi) - month(lo) + 1 END), 0) AS months FROM spans)
"""
_BODIES["a6_max_date"] = _SPANS + "SELECT MAX(hi) AS max_date FROM spans"
_BODIES["a7_months_of_history"] = _SPANS + "SELECT CAST(months AS BIGINT) AS months_of_history FROM m"
_BODIES["a8_capabilities"] = _SPANS + """,
c AS (SELECT SUM(n) FILTER (WHERE t = 'campaigns') AS nc, SUM(n) FILTER (WHERE t = 'customers') AS ncu,
             SUM(n) FILTER (WHERE t = 'transactions') AS nt, SUM(n) FILTER (WHERE t = 'ab_test') AS nab,
             (SELECT months FROM m) AS months,
             (SELECT COUNT(DISTINCT channel) FROM cc WHERE spend > 0) AS paid FROM spans)
SELECT nc > 0 AS overview, nc > 0 AS marketing, nc > 0 AND months >= 6 AS forecast,
       nc > 0 AND ncu > 0 AS acquisition_cost, ncu > 0 AND nt > 0 AS customer_value, nt > 0 AS rfm,
       ncu > 0 AND nt > 0 AS cohorts, nc > 0 AND ncu > 0 AND nt > 0 AS profitability,
       nc > 0 AND ncu > 0 AND nt > 0 AND paid >= 4 AS reallocation, nab > 0 AS experiments,
       ncu > 0 AND nt > 0 AND ncu >= 500 AND months >= 6 AS churn_ml
FROM c"""
_BODIES["a9_table_profile"] = """
SELECT 'campaigns' AS table_name, COUNT(*) AS rows, CAST(13 AS BIGINT) AS columns, MIN(date) AS min_date, MAX(date) AS max_date FROM fx_campaigns
UNION ALL SELECT 'customers', COUNT(*), 8, MIN(acquisition_date), MAX(acquisition_date) FROM fx_customers
UNION ALL SELECT 'transactions', COUNT(*), 8, MIN(transaction_date), MAX(transaction_date) FROM fx_transactions
UNION ALL SELECT 'ab_test', COUNT(*), 7, MIN(date), MAX(date) FROM fx_ab_test"""


def _null_profile() -> str:
    cols = {
        "campaigns": "campaign_id campaign_name channel objective device country audience date spend impressions clicks conversions revenue",
        "customers": "customer_id acquisition_channel acquisition_date age_group city country subscription_plan first_purchase_value",
        "transactions": "transaction_id customer_id transaction_date product_category amount discount profit refund_flag",
        "ab_test": "variant date impressions clicks conversions revenue spend",
    }
    parts = []
    for t, cs in cols.items():
        for c in cs.split():
            parts.append(f"SELECT '{t}' AS table_name, '{c}' AS column_name, "
                         f"CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS null_count FROM fx_{t}")
    return "\nUNION ALL ".join(parts)


_BODIES["a10_null_profile"] = _null_profile()

# ------------------------------------------------------------------ snapshot / replay
_BODIES["r1_snapshot_status"] = """
WITH mon AS (SELECT COUNT(*) AS months FROM (
        SELECT DISTINCT CAST(date_trunc('month', date) AS DATE) FROM cc) x),
b AS (SELECT MIN(date) lo, MAX(date) hi FROM cc),
mm AS (SELECT (year(CASE WHEN hi < last_day(hi) THEN hi - INTERVAL 1 MONTH ELSE hi END) * 12
             + month(CASE WHEN hi < last_day(hi) THEN hi - INTERVAL 1 MONTH ELSE hi END))
             - (year(lo) * 12 + month(lo)) + 1 AS months FROM b),
g AS (SELECT (SELECT COUNT(*) FROM cc) AS nc, (SELECT COUNT(*) FROM cu) AS ncu, (SELECT COUNT(*) FROM tx) AS nt,
             (SELECT COUNT(*) FROM ab) AS nab, GREATEST((SELECT months FROM mm), 0) AS months,
             (SELECT COUNT(DISTINCT customer_id) FROM tx WHERE NOT refund_flag) AS rfm_n,
             (SELECT COALESCE(SUM(clicks) FILTER (WHERE variant = 'A'), 0) FROM ab) AS ca,
             (SELECT COALESCE(SUM(clicks) FILTER (WHERE variant = 'B'), 0) FROM ab) AS cb,
             (SELECT COUNT(*) FROM (SELECT year(acquisition_date) * 12 + month(acquisition_date) AS m, COUNT(*) AS k
                                    FROM cu GROUP BY 1) z WHERE k >= 20) AS big_cohorts)
SELECT CAST(1 AS BIGINT) AS module_order, 'marketing' AS module,
       CASE WHEN nc = 0 THEN 'unavailable' WHEN months < 1 THEN 'insufficient_data' ELSE 'ok' END AS status,
       CASE WHEN nc = 0 THEN 'marketing requires campaigns' WHEN months < 1 THEN 'seasonality needs at least 1 complete month' END AS reason FROM g
UNION ALL SELECT 2, 'customers',
       CASE WHEN ncu = 0 OR nt = 0 THEN 'unavailable' WHEN rfm_n < 20 OR big_cohorts < 1 THEN 'insufficient_data' ELSE 'ok' END,
       CASE WHEN ncu = 0 OR nt = 0 THEN 'customers requires customers, transactions'
            WHEN rfm_n < 20 THEN format('rfm needs 20 purchasing customers; has {}', rfm_n)
            WHEN big_cohorts < 1 THEN 'cohorts need a cohort of at least 20 customers' END FROM g
UNION ALL SELECT 3, 'finance',
       CASE WHEN nc = 0 OR ncu = 0 OR nt = 0 THEN 'unavailable' ELSE 'ok' END,
       CASE WHEN nc = 0 OR ncu = 0 OR nt = 0 THEN 'finance requires campaigns, customers, transactions' END FROM g
UNION ALL SELECT 4, 'experiments',
       CASE WHEN nab = 0 THEN 'unavailable' WHEN ca <= 0 OR cb <= 0 THEN 'insufficient_data' ELSE 'ok' END,
       CASE WHEN nab = 0 THEN 'experiments requires ab_test' WHEN ca <= 0 OR cb <= 0 THEN 'ab_test needs clicks in both variants A and B' END FROM g
UNION ALL SELECT 5, 'forecast',
       CASE WHEN nc = 0 THEN 'unavailable' WHEN months < 6 THEN 'insufficient_data' ELSE 'ok' END,
       CASE WHEN nc = 0 THEN 'forecast requires campaigns' WHEN months < 6 THEN format('forecast needs 6 months; has {}', months) END FROM g"""

_CURSORS = """
WITH bnd AS (
  SELECT LEAST((SELECT MIN(date) FROM cc), (SELECT MIN(acquisition_date) FROM cu), (SELECT MIN(transaction_date) FROM tx)) AS s,
         GREATEST((SELECT MAX(date) FROM cc), (SELECT MAX(acquisition_date) FROM cu), (SELECT MAX(transaction_date) FROM tx),
                  (SELECT MAX(date) FROM ab)) AS e),
ticks AS (SELECT GREATEST(1, CAST(ceil(date_diff('day', s, e) / 7.0) AS BIGINT)) AS total FROM bnd),
cur AS (SELECT CAST(k AS BIGINT) AS tick, LEAST(CAST(s + CAST(k * 7 AS INTEGER) AS DATE), e) AS cursor
        FROM bnd, ticks, range(0, total + 1) r(k))
"""

_BODIES["r2_replay_series"] = _CURSORS + """,
c AS (SELECT cur.tick, SUM(revenue) AS revenue, SUM(spend) AS spend, SUM(impressions) AS impressions,
             SUM(clicks) AS clicks, SUM(conversions) AS conversions
      FROM cur JOIN cc ON cc.date <= cur.cursor GROUP BY cur.tick),
t AS (SELECT cur.tick, COUNT(*) AS purchases, SUM(profit) AS gross_profit
      FROM cur JOIN tx ON tx.transaction_date <= cur.cursor AND NOT tx.refund_flag GROUP BY cur.tick),
k AS (SELECT cur.tick, COUNT(*) AS customers FROM cur JOIN cu ON cu.acquisition_date <= cur.cursor GROUP BY cur.tick)
SELECT cur.tick, cur.cursor, CAST(COALESCE(c.revenue, 0) AS DOUBLE) AS revenue, CAST(COALESCE(c.spend, 0) AS DOUBLE) AS spend,
       CAST(COALESCE(c.impressions, 0) AS BIGINT) AS impressions, CAST(COALESCE(c.clicks, 0) AS BIGINT) AS clicks,
       CAST(COALESCE(c.conversions, 0) AS BIGINT) AS conversions, CAST(COALESCE(t.purchases, 0) AS BIGINT) AS purchases,
       CAST(COALESCE(t.gross_profit, 0) AS DOUBLE) AS gross_profit, CAST(COALESCE(k.customers, 0) AS BIGINT) AS customers,
       CAST(COALESCE(c.revenue, 0) AS DOUBLE) / NULLIF(CAST(COALESCE(c.spend, 0) AS DOUBLE), 0) AS roas
FROM cur LEFT JOIN c ON cur.tick = c.tick LEFT JOIN t ON cur.tick = t.tick LEFT JOIN k ON cur.tick = k.tick"""

_BODIES["r3_replay_repeat_customers"] = _CURSORS + """,
p AS (SELECT customer_id, transaction_date AS d FROM tx WHERE NOT refund_flag AND customer_id IS NOT NULL),
x AS (SELECT cur.tick, customer_id, COUNT(*) AS n FROM cur JOIN p ON p.d <= cur.cursor GROUP BY cur.tick, customer_id),
y AS (SELECT tick, COUNT(*) AS transacting, COUNT(*) FILTER (WHERE n > 1) AS repeaters FROM x GROUP BY tick)
SELECT cur.tick, cur.cursor, CAST(COALESCE(y.transacting, 0) AS BIGINT) AS transacting_customers,
       CAST(COALESCE(y.repeaters, 0) AS BIGINT) AS repeat_customers,
       COALESCE(CAST(y.repeaters AS DOUBLE) / NULLIF(CAST(y.transacting AS DOUBLE), 0), 0.0) AS repeat_rate
FROM cur LEFT JOIN y ON cur.tick = y.tick"""

_BODIES["r3_replay_segments"] = _CURSORS + """,
per AS (
  SELECT cur.tick, cur.cursor, tx.customer_id, COUNT(tx.transaction_id) AS frequency, SUM(tx.amount) AS monetary,
         MAX(tx.transaction_date) AS last_purchase
  FROM cur JOIN tx ON tx.transaction_date <= cur.cursor AND NOT tx.refund_flag
  GROUP BY cur.tick, cur.cursor, tx.customer_id),
st AS (SELECT *, CAST(date_diff('day', last_purchase, cursor) AS BIGINT) AS recency FROM per),
enough AS (SELECT tick, COUNT(*) AS n,
             list_sort(list_distinct(quantile_cont(recency, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]))) AS e
           FROM st GROUP BY tick HAVING COUNT(*) >= 20),
rk AS (
  SELECT st.*, x.n, x.e, ROW_NUMBER() OVER (PARTITION BY st.tick ORDER BY frequency, customer_id) AS rf
  FROM st JOIN enough x ON st.tick = x.tick),
sc AS (
  SELECT *, GREATEST(len(e) - 1, 1) - len(list_filter(e[2:len(e) - 1], lambda v: recency > v)) AS r,
         CASE WHEN rf = 1 THEN 1 ELSE ((rf - 1) * 5 + n - 2) // (n - 1) END AS f
  FROM rk),
seg AS (
  SELECT *, CASE
    WHEN r BETWEEN 4 AND 5 AND f BETWEEN 4 AND 5 THEN 'Champions'
    WHEN r BETWEEN 3 AND 5 AND f BETWEEN 3 AND 5 THEN 'Loyal Customers'
    WHEN r BETWEEN 4 AND 5 AND f BETWEEN 1 AND 2 THEN 'Potential Loyalists'
    WHEN r BETWEEN 1 AND 2 AND f BETWEEN 3 AND 5 THEN 'At Risk'
    WHEN r BETWEEN 1 AND 2 AND f BETWEEN 1 AND 2 THEN 'Lost Customers'
    ELSE 'Needs Attention' END AS segment FROM sc)
SELECT tick, cursor, segment, COUNT(*) AS customers, ROUND(AVG(recency), 6) AS avg_recency_days,
       ROUND(AVG(frequency), 6) AS avg_frequency, ROUND(CAST(SUM(monetary) AS DOUBLE) / COUNT(*), 6) AS avg_monetary,
       COUNT(*)::DOUBLE / ANY_VALUE(n) AS pct_of_base
FROM seg GROUP BY tick, cursor, segment"""

_BODIES["r3_replay_cohorts"] = _CURSORS + """,
known AS (
  SELECT customer_id, acquisition_date AS a, year(acquisition_date) * 12 + month(acquisition_date) - 1 AS cm
  FROM cu WHERE acquisition_date IS NOT NULL),
act AS (
  SELECT k.customer_id, k.cm, k.a, t.transaction_date AS d,
         year(t.transaction_date) * 12 + month(t.transaction_date) - 1 - k.cm AS k
  FROM tx t JOIN known k ON t.customer_id = k.customer_id WHERE NOT t.refund_flag),
n AS (
  SELECT cur.tick, cur.cursor, act.cm, act.k, COUNT(DISTINCT customer_id) AS active
  FROM cur JOIN act ON act.d <= cur.cursor AND act.a <= cur.cursor WHERE act.k BETWEEN 0 AND 11 GROUP BY ALL),
sz AS (SELECT cur.tick, known.cm, COUNT(*) AS size FROM cur JOIN known ON known.a <= cur.cursor GROUP BY ALL)
SELECT n.tick, n.cursor, make_date(CAST(n.cm // 12 AS BIGINT), CAST(n.cm % 12 + 1 AS BIGINT), 1) AS cohort,
       CAST(n.k AS BIGINT) AS months_since_acquisition, n.active AS active_customers, sz.size AS cohort_size,
       n.active::DOUBLE / sz.size AS retention_pct
FROM n JOIN sz ON n.tick = sz.tick AND n.cm = sz.cm WHERE sz.size >= 20"""

# ------------------------------------------------------------------ streaming (batch equivalents)
_BODIES["r4_stream_channel_kpis"] = _BODIES["m3_by_channel"]
_BODIES["r5_stream_weekly_revenue"] = """
WITH w AS (
  SELECT CAST(DATE '1970-01-01' + INTERVAL (CAST(floor(date_diff('day', DATE '1970-01-01', date) / 7) AS BIGINT) * 7) DAY AS DATE) AS window_start,
         revenue FROM cc),
g AS (SELECT window_start, CAST(window_start + INTERVAL 7 DAY AS DATE) AS window_end, CAST(SUM(revenue) AS DOUBLE) AS revenue,
             COUNT(*) AS rows FROM w GROUP BY window_start)
SELECT * FROM g"""
_BODIES["r6_stream_dedup"] = "SELECT DISTINCT * FROM fx_campaigns"
_BODIES["r7_stream_enrich"] = """
SELECT t.transaction_id, t.customer_id, t.transaction_date, CAST(t.amount AS DOUBLE) AS amount,
       c.acquisition_channel, c.subscription_plan,
       CASE WHEN t.customer_id IS NULL THEN 'missing_customer_id' WHEN c.customer_id IS NULL THEN 'orphan' ELSE 'ok' END AS status
FROM fx_transactions t LEFT JOIN fx_customers c ON t.customer_id = c.customer_id"""


# ------------------------------------------------------------------ audit example keys (Q-13)
_CAMP_COLS = "campaign_id, date, campaign_name, channel, objective, device, country, audience, spend, impressions, clicks, conversions, revenue"
_TX_COLS = "transaction_id, customer_id, transaction_date, product_category, amount, discount, profit, refund_flag"


def _top20(rule: str, table: str, src: str, order: str, key: str) -> str:
    return f"""SELECT '{rule}' AS rule_key, '{table}' AS table_name,
       ROW_NUMBER() OVER (ORDER BY {order}) AS example_rank, {key} AS example_key, x.*
FROM (SELECT * FROM {src} ORDER BY {order} LIMIT 20) x"""


def _nf(cols: str) -> str:
    return ", ".join(f"{c} ASC NULLS FIRST" for c in cols.split(", "))


_D = "(SELECT DISTINCT * FROM fx_campaigns)"
_CK = "concat_ws('|', campaign_id, CAST(date AS VARCHAR))"
_TK = "concat_ws('|', CAST(transaction_id AS VARCHAR), CAST(customer_id AS VARCHAR))"
_ex = [
    _top20("duplicate_rows", "campaigns",
           "(SELECT * EXCLUDE (n) FROM (SELECT *, COUNT(*) AS n FROM fx_campaigns GROUP BY ALL) WHERE n > 1)",
           _nf(_CAMP_COLS), _CK),
    _top20("out_of_range_dates", "campaigns",
           f"(SELECT * FROM {_D} WHERE date IS NULL OR date < DATE '1990-01-01' OR date > current_date)", _nf(_CAMP_COLS), _CK),
    _top20("negative_spend", "campaigns", f"(SELECT * FROM {_D} WHERE spend < 0)", _nf(_CAMP_COLS), _CK),
    _top20("negative_revenue", "campaigns", f"(SELECT * FROM {_D} WHERE revenue < 0)", _nf(_CAMP_COLS), _CK),
    _top20("conversions_exceed_clicks", "campaigns", f"(SELECT * FROM {_D} WHERE conversions > clicks)", _nf(_CAMP_COLS), _CK),
    _top20("impossible_ctr", "campaigns",
           f"(SELECT * FROM {_D} WHERE COALESCE(clicks::DOUBLE / NULLIF(impressions, 0) NOT BETWEEN 0 AND 1, FALSE))",
           _nf(_CAMP_COLS), _CK),
    _top20("impossible_cvr", "campaigns",
           f"(SELECT * FROM {_D} WHERE COALESCE(conversions::DOUBLE / NULLIF(clicks, 0) NOT BETWEEN 0 AND 1, FALSE))",
           _nf(_CAMP_COLS), _CK),
    _top20("missing_age_group", "customers", "(SELECT * FROM fx_customers WHERE age_group IS NULL)",
           _nf("customer_id, acquisition_channel, acquisition_date, age_group, city, country, subscription_plan, first_purchase_value"),
           "CAST(customer_id AS VARCHAR)"),
    _top20("missing_customer_id", "transactions", "(SELECT * FROM fx_transactions WHERE customer_id IS NULL)",
           _nf(_TX_COLS), _TK),
    _top20("profit_exceeds_amount", "transactions", "(SELECT * FROM fx_transactions WHERE profit > amount)",
           _nf(_TX_COLS), _TK),
    _top20("orphan_transactions", "transactions",
           "(SELECT * FROM fx_transactions WHERE customer_id IS NOT NULL AND customer_id NOT IN (SELECT customer_id FROM fx_customers))",
           _nf(_TX_COLS), _TK),
]
_BODIES["q_example_keys"] = "\nUNION ALL\n".join(
    f"SELECT rule_key, table_name, example_rank, example_key FROM ({q})" for q in _ex)
_MONEY = "spend, revenue, first_purchase_value, amount, discount, profit".split(", ")
_BODIES["q_examples"] = ("SELECT * REPLACE (" + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _MONEY) + ") FROM (\n"
                         + "\nUNION ALL BY NAME\n".join(f"SELECT * FROM ({q})" for q in _ex) + ")")


# ------------------------------------------------------------------ snapshot header and modules
def _header() -> str:
    rows = ", ".join(f"(SELECT MAX({c}) FROM r WHERE table_name = '{t}') AS {t}_{c}"
                     for t in ("campaigns", "customers", "transactions", "ab_test") for c in ("rows_before", "rows_after"))
    can = ("overview marketing forecast acquisition_cost customer_value rfm cohorts profitability reallocation "
           "experiments churn_ml").split()
    return (f"WITH r AS (SELECT * FROM ({_BODIES['q_rows']})), can AS (SELECT * FROM ({_BODIES['a8_capabilities']}))\n"
            f"SELECT (SELECT max_date FROM ({_BODIES['a6_max_date']})) AS as_of, '{PARAMS_HASH}' AS params_hash, "
            f"(SELECT months_of_history FROM ({_BODIES['a7_months_of_history']})) AS months_of_history, {rows}, "
            + ", ".join(f"{c} AS can_{c}" for c in can) + " FROM can")


def _melt(module: str, output: str, query: str, keys: str, metrics: str) -> str:
    pairs = ", ".join(f"{{'metric': '{m}', 'value': CAST({m} AS DOUBLE)}}" for m in metrics.split())
    key = f"concat_ws('|', {keys})" if keys else "''"
    return (f"SELECT '{module}' AS module, '{output}' AS output, key, p.metric AS metric, p.value AS value FROM "
            f"(SELECT {key} AS key, unnest([{pairs}]) AS p FROM ({_BODIES[query]}))")


_KPI = "impressions clicks conversions spend revenue ctr cvr cpc cpa roas"
_BODIES["r1_snapshot_header"] = _header()
_BODIES["r1_snapshot_modules"] = "SELECT m.*, s.status FROM (\n" + "\nUNION ALL\n".join([
    _melt("marketing", "by_channel", "m3_by_channel", "channel", _KPI),
    _melt("marketing", "seasonality", "m6_seasonality", "", "peak_revenue mean_revenue months_used"),
    _melt("forecast", "months", "t7_forecast_closed_form", "method, step", "forecast_revenue total"),
    _melt("forecast", "trend", "t6_trend", "", "n_months slope_per_month intercept r_squared months_until_zero"),
    _melt("customers", "segments", "c8_segment_summary", "segment",
          "customers avg_recency_days avg_frequency avg_monetary pct_of_base"),
    _melt("customers", "cohort_means", "c12_cohort_means", "", "mean_month_0 mean_month_1 month_0_to_1_drop n_cohorts"),
    _melt("customers", "value_by_plan", "c15_value_by_plan", "subscription_plan", "customers avg_purchases avg_lifetime_profit"),
    _melt("finance", "kpis", "f7_headline_kpis", "kpi", "value"),
    _melt("finance", "profitability", "f4_profitability", "channel", "campaign_revenue marketing_spend customer_gross_profit net_profit revenue_rank profit_rank "
          "rank_shift contribution_margin profit_per_customer roi"),
    _melt("experiments", "ab_test", "e2_ab_statistics", "experiment",
          "cvr_a cvr_b lift_pct z_stat ci_low ci_high t_stat welch_df n_days current_conversions projected_conversions "
          "incremental_conversions incremental_revenue"),
]) + f"\n) m JOIN (SELECT * FROM ({_BODIES['r1_snapshot_status']})) s ON s.module = m.module AND s.status = 'ok'"
