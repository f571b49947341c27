"""The analyst query corpus (S1 .. S21) over the raw (uncleaned) tables.

Written with the DataFrame API; every ORDER BY ... LIMIT carries a unique
tie-break so results are deterministic. Windows without PARTITION BY only
run on small aggregated results (days, months, channels).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from adpulse.functions.kpis import (dbl, device_status, discount_band, ltv_cac_tier,
                                    roas_tier, roi_tier, safe_div)
from adpulse.operators.ranking import ntile_of_rank


def _money2(x) -> F.Column:
    """ROUND(x, 2) of an exact (DECIMAL) amount, as DOUBLE."""
    return F.round(x, 2).cast("double")


def _ratio(a, b, places) -> F.Column:
    return F.round(safe_div(a, b), places)


def s01_monthly_revenue_spend(c: DataFrame) -> DataFrame:
    return (c.groupBy(F.date_format("date", "yyyy-MM").alias("month"))
            .agg(_money2(F.sum("revenue")).alias("total_revenue"), _money2(F.sum("spend")).alias("total_spend"))
            .orderBy("month"))


def s02_monthly_profit(t: DataFrame) -> DataFrame:
    return (t.filter(~F.col("refund_flag"))
            .groupBy(F.date_format("transaction_date", "yyyy-MM").alias("month"))
            .agg(_money2(F.sum("profit")).alias("total_profit"), F.count(F.lit(1)).alias("transaction_count"))
            .orderBy("month"))


def s03_campaign_roas(c: DataFrame, n: int = 15) -> DataFrame:
    g = (c.filter(F.col("spend") > 0)
         .groupBy("campaign_id", "campaign_name", "channel")
         .agg(F.sum("spend").alias("s"), F.sum("revenue").alias("r"))
         .filter(F.col("s") > 500))
    out = g.select("campaign_id", "campaign_name", "channel",
                   _money2(F.col("s")).alias("total_spend"), _money2(F.col("r")).alias("total_revenue"),
                   _ratio("r", "s", 2).alias("roas"), roas_tier(safe_div("r", "s")).alias("performance_tier"))
    return out.orderBy(F.col("roas").desc_nulls_last(), "campaign_id").limit(n)


def s04_channel_roi(c: DataFrame) -> DataFrame:
    g = (c.filter(F.col("spend") > 0).groupBy("channel")
         .agg(F.sum("spend").alias("s"), F.sum("revenue").alias("r")).filter(F.col("s") > 1000))
    roi = safe_div(dbl("r") - dbl("s"), "s")
    return g.select("channel", _money2(F.col("s")).alias("total_spend"), _money2(F.col("r")).alias("total_revenue"),
                    F.round(roi, 3).alias("roi"), roi_tier(roi).alias("roi_tier")).orderBy(F.col("roi").desc())


def _spend_by_channel(c):
    return c.groupBy("channel").agg(F.sum("spend").alias("total_spend"))


def _customers_by_channel(cu):
    return cu.groupBy(F.col("acquisition_channel").alias("channel")).agg(F.count(F.lit(1)).alias("new_customers"))


def s05_cac_by_channel(c: DataFrame, cu: DataFrame) -> DataFrame:
    j = _spend_by_channel(c).join(_customers_by_channel(cu), "channel")
    return j.select("channel", _money2(F.col("total_spend")).alias("total_spend"), "new_customers",
                    _ratio("total_spend", "new_customers", 2).alias("cac")).orderBy("cac")


def _customer_profit(t):
    # pre-aggregated per customer: a hot customer is one row per map task
    return t.groupBy("customer_id").agg(F.sum("profit").alias("lifetime_profit"))


def s06_ltv_by_channel(cu: DataFrame, t: DataFrame) -> DataFrame:
    j = cu.select("customer_id", "acquisition_channel").join(_customer_profit(t), "customer_id")
    return (j.groupBy("acquisition_channel")
            .agg(F.countDistinct("customer_id").alias("customers"),
                 _money2(F.avg("lifetime_profit")).alias("avg_ltv"))
            .orderBy(F.col("avg_ltv").desc()))


def s07_ltv_cac(c: DataFrame, cu: DataFrame, t: DataFrame) -> DataFrame:
    cac = (_spend_by_channel(c).join(_customers_by_channel(cu), "channel")
           .select("channel", safe_div("total_spend", "new_customers").alias("cac")))
    ltv = (cu.select("customer_id", "acquisition_channel").join(_customer_profit(t), "customer_id")
           .groupBy(F.col("acquisition_channel").alias("channel"))
           .agg(F.avg("lifetime_profit").alias("ltv")))
    j = ltv.join(cac, "channel")
    ratio = safe_div("ltv", "cac")
    return j.select("channel", F.round("cac", 2).alias("cac"), _money2(F.col("ltv")).alias("ltv"),
                    F.round(ratio, 2).alias("ltv_to_cac_ratio"), ltv_cac_tier(ratio).alias("efficiency")
                    ).orderBy(F.col("ltv_to_cac_ratio").desc_nulls_last())


def s08_cohort_activity(cu: DataFrame, t: DataFrame, max_months: int = 6) -> DataFrame:
    # distinct (customer, activity month) before the join (refunds included)
    act = (t.filter(F.col("customer_id").isNotNull())
           .select("customer_id", F.date_format("transaction_date", "yyyy-MM").alias("activity_month"))
           .distinct())
    coh = cu.select("customer_id", F.date_format("acquisition_date", "yyyy-MM").alias("cohort_month"))
    j = act.join(coh, "customer_id")
    ym = lambda s: F.substring(s, 1, 4).cast("int") * 12 + F.substring(s, 6, 2).cast("int")
    k = ym(F.col("activity_month")) - ym(F.col("cohort_month"))
    return (j.withColumn("months_since_acquisition", k)
            .filter(F.col("months_since_acquisition").between(0, max_months))
            .groupBy("cohort_month", "months_since_acquisition")
            .agg(F.countDistinct("customer_id").alias("active_customers"))
            .orderBy("cohort_month", "months_since_acquisition"))


def _per_customer(t):
    return t.groupBy("customer_id").agg(F.sum("profit").alias("p"), F.count("transaction_id").alias("n"),
                                        F.sum("amount").alias("a"))


def s09_top_customers(cu: DataFrame, t: DataFrame, n: int = 10) -> DataFrame:
    j = cu.select("customer_id", "acquisition_channel", "subscription_plan").join(_per_customer(t), "customer_id")
    out = j.select("customer_id", "acquisition_channel", "subscription_plan",
                   _money2(F.col("p")).alias("lifetime_profit"), F.col("n").alias("total_purchases"))
    return out.orderBy(F.col("lifetime_profit").desc(), "customer_id").limit(n)


def s10_campaign_ranks(c: DataFrame) -> DataFrame:
    g = c.groupBy("channel", "campaign_name").agg(F.sum("revenue").alias("total_revenue"))
    w = Window.partitionBy("channel").orderBy(F.col("total_revenue").desc())
    wr = Window.partitionBy("channel").orderBy(F.col("total_revenue").desc(), "campaign_name")
    return g.select("channel", "campaign_name", dbl("total_revenue").alias("total_revenue"),
                    F.row_number().over(wr).alias("row_num"), F.rank().over(w).alias("rank_num"),
                    F.dense_rank().over(w).alias("dense_rank_num")).orderBy("channel", "row_num")


def _daily(c):
    return c.groupBy("date").agg(F.sum("revenue").alias("revenue"))


def s11_moving_average(c: DataFrame) -> DataFrame:
    w = Window.orderBy("date").rowsBetween(-6, 0)  # over the daily table only
    return _daily(c).select("date", dbl("revenue").alias("revenue"),
                            _money2(F.avg("revenue").over(w)).alias("revenue_7day_moving_avg")).orderBy("date")


def s12_running_total(c: DataFrame) -> DataFrame:
    w = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    return _daily(c).select("date", dbl("revenue").alias("revenue"),
                            _money2(F.sum("revenue").over(w)).alias("cumulative_revenue")).orderBy("date")


def s13_mom_growth(c: DataFrame) -> DataFrame:
    m = c.groupBy(F.date_format("date", "yyyy-MM").alias("month")).agg(F.sum("revenue").alias("revenue"))
    w = Window.orderBy("month")
    prev = F.lag("revenue").over(w)
    return m.select("month", dbl("revenue").alias("revenue"), dbl(prev).alias("prior_month_revenue"),
                    F.round(safe_div((dbl("revenue") - dbl(prev)) * 100.0, prev), 1).alias("mom_growth_pct")
                    ).orderBy("month")


def s14_device_rates(c: DataFrame) -> DataFrame:
    g = c.groupBy("device").agg(F.sum("impressions").alias("impressions"), F.sum("clicks").alias("clicks"),
                                F.sum("conversions").alias("conversions"))
    cvr_pct = safe_div(dbl("conversions") * 100.0, "clicks")
    return g.select("device", "impressions", "clicks", "conversions",
                    F.round(safe_div(dbl("clicks") * 100.0, "impressions"), 2).alias("ctr_pct"),
                    F.round(cvr_pct, 2).alias("cvr_pct"), device_status(cvr_pct).alias("device_status")
                    ).orderBy(F.col("cvr_pct").desc())


def s15_country_roas(c: DataFrame) -> DataFrame:
    g = (c.filter(F.col("spend") > 0).groupBy("country")
         .agg(F.sum("spend").alias("s"), F.sum("revenue").alias("r")).filter(F.col("s") > 500))
    return g.select("country", _money2(F.col("s")).alias("total_spend"), _money2(F.col("r")).alias("total_revenue"),
                    _ratio("r", "s", 2).alias("roas")).orderBy(F.col("roas").desc())


def s16_power_users(cu: DataFrame, t: DataFrame, min_purchases: int = 5) -> DataFrame:
    per = _per_customer(t).filter(F.col("n") > min_purchases)
    j = cu.select("customer_id", "acquisition_channel", "subscription_plan").join(per, "customer_id")
    return j.select("customer_id", "acquisition_channel", "subscription_plan",
                    F.col("n").alias("purchase_count"), _money2(F.col("a")).alias("total_spent")
                    ).orderBy(F.col("purchase_count").desc(), "customer_id")


def s17_refunds_by_category(t: DataFrame) -> DataFrame:
    r = F.col("refund_flag")
    g = t.groupBy("product_category").agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.sum(F.when(r, 1).otherwise(0)).alias("refunded_transactions"),
        F.sum(F.when(r, F.col("profit")).otherwise(F.lit(0))).alias("lost"))
    return g.select("product_category", "total_transactions",
                    F.col("refunded_transactions").cast("bigint").alias("refunded_transactions"),
                    F.round(safe_div(dbl("refunded_transactions") * 100.0, "total_transactions"), 2)
                    .alias("refund_rate_pct"),
                    _money2(F.col("lost")).alias("profit_lost_to_refunds")).orderBy(F.col("refund_rate_pct").desc())


def s18_discount_bands(t: DataFrame) -> DataFrame:
    g = (t.filter(~F.col("refund_flag"))
         .groupBy(discount_band("discount").alias("discount_band"))
         .agg(F.count(F.lit(1)).alias("transactions"), F.avg("amount").alias("aov"),
              F.sum("profit").alias("p"), F.sum("amount").alias("a")))
    return g.select("discount_band", "transactions", _money2(F.col("aov")).alias("avg_order_value"),
                    F.round(safe_div("p", "a"), 3).alias("realized_margin")).orderBy("discount_band")


def s19_variant_comparison(ab: DataFrame) -> DataFrame:
    g = ab.groupBy("variant").agg(F.sum("impressions").alias("impressions"), F.sum("clicks").alias("clicks"),
                                  F.sum("conversions").alias("conversions"), F.sum("revenue").alias("r"),
                                  F.sum("spend").alias("s"))
    return g.select("variant", "impressions", "clicks", "conversions",
                    F.round(safe_div(dbl("conversions") * 100.0, "clicks"), 2).alias("cvr_pct"),
                    _money2(F.col("r")).alias("revenue"), _ratio("r", "s", 2).alias("roas")).orderBy("variant")


def s20_rfm_ntile(t: DataFrame, reference_date: str = "2025-12-31", n: int = 25, buckets: int = 5) -> DataFrame:
    """RFM with NTILE(5) scores, top ``n`` by monetary.

    NTILE needs each row's global position. Only the ``n`` reported rows need
    one, so their positions are counted in ONE aggregation pass over all
    customers (a conditional count per reported row and ordering): linear
    work, partial aggregation, no single-partition window and no pair join.
    Orderings carry customer_id as the tie-break."""
    base = (t.filter(~F.col("refund_flag")).groupBy("customer_id")
            .agg(F.datediff(F.lit(reference_date).cast("date"), F.max("transaction_date")).alias("recency_days"),
                 F.count(F.lit(1)).alias("frequency"),
                 F.round(F.sum("amount"), 2).alias("monetary"))).persist()
    top = base.orderBy(F.col("monetary").desc(), "customer_id").limit(n).collect()  # bounded: n rows
    if not top:
        return base.limit(0).select("customer_id", "recency_days", "frequency", dbl("monetary").alias("monetary"),
                                    F.lit(1).alias("recency_score"), F.lit(1).alias("frequency_score"),
                                    F.lit(1).alias("monetary_score"))
    cid, rec, frq, mon = (F.col("customer_id"), F.col("recency_days"), F.col("frequency"), F.col("monetary"))
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, row in enumerate(top):
        c0 = F.lit(row["customer_id"])
        r0, f0, m0 = F.lit(row["recency_days"]), F.lit(row["frequency"]), F.lit(row["monetary"])
        # strictly-before counts in each ordering
        aggs += [F.count_if((rec > r0) | ((rec == r0) & (cid < c0))).alias(f"r{i}"),   # recency DESC, id
                 F.count_if((frq < f0) | ((frq == f0) & (cid < c0))).alias(f"f{i}"),   # frequency ASC, id
                 F.count_if((mon < m0) | ((mon == m0) & (cid < c0))).alias(f"m{i}")]   # monetary ASC, id
    counts = base.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(row["customer_id"]).alias("customer_id"),
                              F.lit(row["recency_days"]).alias("recency_days"),
                              F.lit(row["frequency"]).alias("frequency"),
                              F.lit(row["monetary"]).alias("monetary"),
                              (F.col(f"r{i}") + 1).alias("rr"), (F.col(f"f{i}") + 1).alias("rf"),
                              (F.col(f"m{i}") + 1).alias("rm")) for i, row in enumerate(top)])
    x = counts.select("_n", F.inline(rows))
    nn = F.col("_n")
    return x.select("customer_id", "recency_days", "frequency", dbl("monetary").alias("monetary"),
                    ntile_of_rank(F.col("rr"), nn, buckets).alias("recency_score"),
                    ntile_of_rank(F.col("rf"), nn, buckets).alias("frequency_score"),
                    ntile_of_rank(F.col("rm"), nn, buckets).alias("monetary_score"))


def s21_orphans(t: DataFrame, cu: DataFrame) -> DataFrame:
    """Transactions whose customer_id has no customer, NULL ids included.
    One anti join; whole left rows, so adaptive execution may split a hot id."""
    cols = ["transaction_id", "customer_id", "transaction_date", dbl("amount").alias("amount")]
    nulls = t.filter(F.col("customer_id").isNull()).select(*cols)
    known = t.filter(F.col("customer_id").isNotNull()).join(
        cu.select("customer_id").distinct(), "customer_id", "left_anti")
    return nulls.unionByName(known.select(*cols))
