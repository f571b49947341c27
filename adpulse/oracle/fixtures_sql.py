"""DuckDB-side fixture views as CTE text, for the independent SQL oracle.

The oracle only sees the base parquet tables, so every oracle query starts
with these CTEs (the fixture definitions, then the audit's clean tables
written independently in SQL).
"""

FIXTURE_CTES = r"""
fx_customers AS (
  SELECT c.c_custkey AS customer_id,
         CASE c.c_custkey % 7 WHEN 0 THEN 'Google Ads' WHEN 1 THEN 'Facebook' WHEN 2 THEN 'Instagram' WHEN 3 THEN 'Email'
              WHEN 4 THEN 'Affiliate' WHEN 5 THEN 'TikTok' ELSE 'Organic' END AS acquisition_channel,
         CAST(COALESCE(f.first_order, TIMESTAMP '1995-01-01 00:00:00') AS DATE) AS acquisition_date,
         CASE WHEN c.c_custkey % 100 = 3 THEN NULL WHEN c.c_acctbal < 2500 THEN '18-24' WHEN c.c_acctbal < 5000 THEN '25-34'
              WHEN c.c_acctbal < 7500 THEN '35-44' ELSE '45-54' END AS age_group,
         n.n_name AS city, r.r_name AS country,
         CASE c.c_custkey % 4 WHEN 0 THEN 'Free' WHEN 1 THEN 'Basic' WHEN 2 THEN 'Premium' ELSE 'Enterprise' END AS subscription_plan,
         CAST(ABS(c.c_acctbal) AS DECIMAL(18,2)) AS first_purchase_value
  FROM customer c
  LEFT JOIN (SELECT o_custkey, MIN(o_orderdate) AS first_order FROM orders GROUP BY o_custkey) f ON c.c_custkey = f.o_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
),
fx_transactions AS (
  SELECT l.l_orderkey * 10 + l.l_linenumber AS transaction_id,
         CASE WHEN l.l_orderkey % 997 = 0 THEN NULL WHEN o.o_custkey % 50 = 7 THEN o.o_custkey + 1000000000000
              WHEN o.o_custkey % 10 = 0 THEN o.o_custkey - 1 ELSE o.o_custkey END AS customer_id,
         CAST(o.o_orderdate AS DATE) AS transaction_date, p.p_type AS product_category,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) AS amount, l.l_discount AS discount,
         CAST(CASE WHEN l.l_returnflag = 'R' THEN CAST(-0.12 AS DECIMAL(4,2)) ELSE CAST(18 + p.p_size AS DECIMAL(4,0)) * CAST(0.01 AS DECIMAL(4,2)) END
              * CAST(l.l_extendedprice AS DECIMAL(10,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2))) AS DECIMAL(18,6)) AS profit,
         l.l_returnflag = 'R' AS refund_flag
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey
),
fx_campaigns_base AS (
  SELECT l_suppkey AS cid, CAST(l_shipdate AS DATE) AS date,
         CAST(SUM(l_quantity) * 100 AS BIGINT) AS impressions, CAST(SUM(l_quantity) AS BIGINT) AS clicks, COUNT(*) AS conversions,
         SUM(CAST(l_extendedprice AS DECIMAL(10,2)) * CAST(l_tax AS DECIMAL(4,2)) * 10) AS spend,
         SUM(CAST(l_extendedprice AS DECIMAL(10,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS revenue
  FROM lineitem GROUP BY l_suppkey, CAST(l_shipdate AS DATE)
),
fx_campaigns AS (
  WITH b AS (
    SELECT CONCAT('CMP-', CAST(1000 + cid AS STRING)) AS campaign_id, CONCAT('Campaign_', CAST(cid AS STRING)) AS campaign_name,
         CASE cid % 7 WHEN 0 THEN 'Google Ads' WHEN 1 THEN 'Facebook' WHEN 2 THEN 'Instagram' WHEN 3 THEN 'Email'
              WHEN 4 THEN 'Affiliate' WHEN 5 THEN 'TikTok' ELSE 'Organic' END AS channel,
         CASE cid % 3 WHEN 0 THEN 'Awareness' WHEN 1 THEN 'Consideration' ELSE 'Conversion' END AS objective,
         CASE (cid + 1) % 3 WHEN 0 THEN 'Mobile' WHEN 1 THEN 'Desktop' ELSE 'Tablet' END AS device,
         CASE cid % 5 WHEN 0 THEN 'United States' WHEN 1 THEN 'United Kingdom' WHEN 2 THEN 'India' WHEN 3 THEN 'Canada' ELSE 'Australia' END AS country,
         CASE cid % 4 WHEN 0 THEN 'New' WHEN 1 THEN 'Returning' WHEN 2 THEN 'Retargeting' ELSE 'Lookalike' END AS audience,
         date,
         CASE WHEN cid % 7 = 6 THEN CAST(0 AS DECIMAL(28,4)) WHEN (cid * 31 + YEAR(date) * 372 + MONTH(date) * 31 + DAY(date)) % 701 = 0 THEN CAST(-spend AS DECIMAL(28,4)) ELSE CAST(spend AS DECIMAL(28,4)) END AS spend,
         impressions, clicks,
         CASE WHEN (cid * 17 + YEAR(date) * 372 + MONTH(date) * 31 + DAY(date)) % 499 = 0 THEN clicks + 7 ELSE conversions END AS conversions,
         CAST(revenue AS DECIMAL(28,4)) AS revenue
    FROM fx_campaigns_base)
  SELECT * FROM b UNION ALL SELECT * FROM b WHERE campaign_id = 'CMP-1005' AND MONTH(date) = 1
),
fx_ab_test AS (
  SELECT CASE WHEN user_id % 2 = 0 THEN 'A' ELSE 'B' END AS variant, CAST(ts AS DATE) AS date,
         CAST(COUNT(*) * 30 AS BIGINT) AS impressions,
         SUM(CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END) AS clicks,
         SUM(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS conversions,
         SUM(CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(18,2)) ELSE 0 END) AS revenue,
         SUM(CASE WHEN event_type = 'click' THEN CAST(value AS DECIMAL(18,2)) ELSE 0 END) AS spend
  FROM events GROUP BY CASE WHEN user_id % 2 = 0 THEN 'A' ELSE 'B' END, CAST(ts AS DATE)
),
cc AS (
  SELECT campaign_id, campaign_name, channel, objective, device, country, audience, date, spend,
         impressions, clicks,
         CASE WHEN conversions > clicks THEN clicks ELSE conversions END AS conversions, revenue
  FROM (SELECT DISTINCT * FROM fx_campaigns) d
  WHERE NOT (COALESCE(spend < 0, FALSE) OR COALESCE(revenue < 0, FALSE))
),
cu AS (SELECT * FROM fx_customers),
tx AS (
  SELECT * FROM fx_transactions
  WHERE customer_id IS NOT NULL AND customer_id IN (SELECT customer_id FROM fx_customers)
),
ab AS (SELECT * FROM fx_ab_test)
"""


def with_fixtures(body: str) -> str:
    """Prefix an oracle query with the fixture CTEs. The body may start with
    its own ``WITH``; its CTEs are appended after the fixtures."""
    b = body.strip()
    if b[:4].upper() == "WITH":
        return "WITH " + FIXTURE_CTES.strip() + ",\n" + b[4:].lstrip()
    return "WITH " + FIXTURE_CTES.strip() + "\n" + b
