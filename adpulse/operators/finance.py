"""Unit economics and channel profitability (F1 .. F10).

Every table is aggregated to the channel (or customer) grain before any join,
so joins run on a handful of rows per channel; windows below run over the
channel table only (bounded by the number of channels).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from adpulse.functions.kpis import contribution_margin, dbl, r6, roas, roi, round6, safe_div
from adpulse.operators.customers import purchases
from adpulse.params import DEFAULTS, AnalysisParams


def lifetime_profit(transactions: DataFrame, params: AnalysisParams = DEFAULTS) -> DataFrame:
    """lifetime profit per customer over purchases."""
    return (purchases(transactions, params.include_refunds_in_rfm)
            .groupBy("customer_id").agg(F.sum("profit").alias("lifetime_profit")))


def customers_with_profit(customers: DataFrame, transactions: DataFrame,
                          params: AnalysisParams = DEFAULTS) -> DataFrame:
    """every customer with lifetime profit, zero for non-purchasers.
    Both sides are one row per customer, so the join has no hot key."""
    return (customers.select("customer_id", "acquisition_channel", "subscription_plan")
            .join(lifetime_profit(transactions, params), "customer_id", "left")
            .withColumn("lifetime_profit", F.coalesce(F.col("lifetime_profit"), F.lit(0))))


def _spend_revenue(campaigns: DataFrame) -> DataFrame:
    return (campaigns.filter(F.col("channel").isNotNull()).groupBy("channel")
            .agg(F.sum("spend").alias("spend"), F.sum("revenue").alias("revenue")))


def _new_customers(customers: DataFrame) -> DataFrame:
    return (customers.filter(F.col("acquisition_channel").isNotNull())
            .groupBy(F.col("acquisition_channel").alias("channel"))
            .agg(F.count(F.lit(1)).alias("new_customers")))


def cac_ltv_by_channel(campaigns: DataFrame, customers: DataFrame, cust_profit: DataFrame,
                       params: AnalysisParams = DEFAULTS) -> DataFrame:
    """CAC, LTV and LTV:CAC per channel present on both sides. A zero
    CAC makes the ratio undefined; undefined ratios sort first."""
    spend = _spend_revenue(campaigns).select("channel", "spend")
    cac = spend.join(_new_customers(customers), "channel").select(
        "channel", safe_div("spend", "new_customers").alias("cac"))
    cp = cust_profit
    if params.ltv_denominator != "all_customers":
        cp = cp.filter(F.col("lifetime_profit") != 0)
    ltv = cp.groupBy(F.col("acquisition_channel").alias("channel")).agg(
        F.avg("lifetime_profit").alias("ltv"))
    j = cac.join(ltv, "channel").filter(F.col("cac").isNotNull() & F.col("ltv").isNotNull())
    undefined = F.col("cac") == 0
    ratio = safe_div("ltv", "cac")
    out = j.select("channel", r6("cac").alias("cac"), round6("ltv").alias("ltv"),
                   undefined.alias("ratio_undefined"), round6(ratio).alias("ltv_cac_ratio"),
                   F.when(undefined, F.lit(None).cast("boolean"))
                    .otherwise(ratio >= F.lit(params.ltv_cac_benchmark)).alias("clears_benchmark"))
    return out.orderBy(F.col("ratio_undefined").desc(), F.col("ltv_cac_ratio").desc_nulls_last(), "channel")


def _avg_rank_desc(col: str):
    """Average-method rank, descending, truncated to an integer: a tie group
    at positions r..r+t-1 gets floor(r + (t-1)/2). Over the channel table."""
    w = Window.orderBy(F.col(col).desc())
    ties = Window.partitionBy(col)
    return (F.rank().over(w) + F.floor((F.count(F.lit(1)).over(ties) - 1) / 2)).cast("int")


def profit_table(campaigns: DataFrame, customers: DataFrame, cust_profit: DataFrame) -> DataFrame:
    """F4 before output rounding: channel profitability over the FULL OUTER
    join of campaign channels and acquisition channels. Net profit is computed
    before zero-filling, so a channel missing on either side gets 0."""
    sr = _spend_revenue(campaigns)
    gp = (cust_profit.filter(F.col("acquisition_channel").isNotNull())
          .groupBy(F.col("acquisition_channel").alias("channel")).agg(F.sum("lifetime_profit").alias("gross")))
    nc = _new_customers(customers)
    j = sr.join(gp, "channel", "full_outer").join(nc, "channel", "left")
    net = F.coalesce(dbl("gross") - dbl("spend"), F.lit(0.0))
    t = j.select("channel",
                 F.coalesce(dbl("revenue"), F.lit(0.0)).alias("campaign_revenue"),
                 F.coalesce(dbl("spend"), F.lit(0.0)).alias("marketing_spend"),
                 F.coalesce(dbl("gross"), F.lit(0.0)).alias("customer_gross_profit"),
                 net.alias("net_profit"), "new_customers")
    return (t.withColumn("revenue_rank", _avg_rank_desc("campaign_revenue"))
             .withColumn("profit_rank", _avg_rank_desc("net_profit")))


def profitability(campaigns: DataFrame, customers: DataFrame, cust_profit: DataFrame) -> DataFrame:
    """rounded channel profitability, best net profit first."""
    t = profit_table(campaigns, customers, cust_profit)
    return t.select(
        "channel", r6("campaign_revenue").alias("campaign_revenue"),
        r6("marketing_spend").alias("marketing_spend"),
        r6("customer_gross_profit").alias("customer_gross_profit"),
        r6("net_profit").alias("net_profit"),
        "revenue_rank", "profit_rank",
        (F.col("revenue_rank") - F.col("profit_rank")).alias("rank_shift"),
        r6(contribution_margin("campaign_revenue", "marketing_spend")).alias("contribution_margin"),
        r6(safe_div("customer_gross_profit", "new_customers")).alias("profit_per_customer"),
        r6(roi("customer_gross_profit", "marketing_spend")).alias("roi"),
    ).orderBy(F.col("net_profit").desc(), "channel")


def channel_net_profit_inner(campaigns: DataFrame, cust_profit: DataFrame) -> DataFrame:
    """net profit for channels present on both sides only."""
    sr = _spend_revenue(campaigns)
    gp = cust_profit.groupBy(F.col("acquisition_channel").alias("channel")).agg(
        F.sum("lifetime_profit").alias("gross"))
    return sr.join(gp, "channel").select(
        "channel", r6("spend").alias("marketing_spend"), r6("gross").alias("customer_gross_profit"),
        r6(dbl("gross") - dbl("spend")).alias("net_profit"))


def reallocation_roles(profit_table: DataFrame, params: AnalysisParams = DEFAULTS) -> DataFrame:
    """Elastic channels with their role (recipient / donor / hold), weight and
    ROI. Configured channels are used when enough are present, else every
    channel with spend ('inferred')."""
    need = params.n_donors + params.n_recipients
    conf = list(params.elastic_paid_channels)
    all_rows = Window.partitionBy(F.lit(1))
    t = profit_table.withColumn("_conf", F.col("channel").isin(conf))
    t = t.withColumn("_n_conf", F.count_if("_conf").over(all_rows))
    use_conf = F.col("_n_conf") >= need
    t = t.withColumn("basis", F.when(use_conf, "configured").otherwise("inferred"))
    el = t.filter(F.when(use_conf, F.col("_conf")).otherwise(F.col("marketing_spend") > 0))
    el = el.withColumn("_roi", roi("customer_gross_profit", "marketing_spend"))
    w = Window.orderBy(F.col("_roi").desc_nulls_last(), "channel")
    el = (el.withColumn("_pos", F.row_number().over(w))
            .withColumn("_n", F.count(F.lit(1)).over(all_rows)))
    role = (F.when(F.col("_pos") <= params.n_recipients, "recipient")
            .when(F.col("_pos") > F.col("_n") - params.n_donors, "donor").otherwise("hold"))
    el = el.withColumn("role", F.when(F.col("_n") >= need, role))
    rec = F.col("role") == "recipient"
    el = el.withColumn("_w", F.when(rec, F.try_divide(F.col("_roi"), F.sum(F.when(rec, F.col("_roi"))).over(all_rows))))
    return el.select("channel", "basis", "role", "_pos", "_n", "_roi", "_w",
                     "marketing_spend", "campaign_revenue")


def reallocation_summary(profit_table: DataFrame, params: AnalysisParams = DEFAULTS) -> DataFrame:
    """shift ``shift_pct`` of spend from the lowest-ROI to the highest-ROI
    elastic channels at constant ROI. One row; empty when too few channels."""
    r = reallocation_roles(profit_table, params).filter(F.col("role").isNotNull())
    pct = F.lit(params.shift_pct)
    don, rec = F.col("role") == "donor", F.col("role") == "recipient"
    moved = dbl("marketing_spend") * pct
    rroas = roas("campaign_revenue", "marketing_spend")
    shift = F.sum(F.when(don, moved))
    s = r.agg(
        F.first("basis").alias("basis"),
        shift.alias("shift_amount"),
        F.sum(F.when(don, moved * F.col("_roi"))).alias("profit_lost"),
        F.sum(F.when(rec, F.col("_w") * F.col("_roi"))).alias("_gain_rate"),
        F.sum(F.when(don, moved * rroas)).alias("revenue_lost"),
        F.sum(F.when(rec, F.col("_w") * rroas)).alias("_rev_rate"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.when(don, F.struct("_pos", "channel")))),
                                 lambda x: x["channel"]), ", ").alias("from_channels"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.when(rec, F.struct("_pos", "channel")))),
                                 lambda x: x["channel"]), ", ").alias("to_channels"),
        F.array_join(F.sort_array(F.collect_list("channel")), ", ").alias("channels_considered"),
    )
    s = (s.withColumn("profit_gained", F.col("_gain_rate") * F.col("shift_amount"))
          .withColumn("revenue_gained", F.col("_rev_rate") * F.col("shift_amount")))
    return s.select(
        F.lit(params.shift_pct).alias("shift_pct"), round6("shift_amount").alias("shift_amount"),
        "from_channels", "to_channels",
        round6("profit_lost").alias("profit_lost"), round6("profit_gained").alias("profit_gained"),
        round6(F.col("profit_gained") - F.col("profit_lost")).alias("net_profit_change"),
        round6("revenue_lost").alias("revenue_lost"), round6("revenue_gained").alias("revenue_gained"),
        round6(F.col("revenue_gained") - F.col("revenue_lost")).alias("net_revenue_change"),
        round6(safe_div(F.col("profit_gained") - F.col("profit_lost"), "shift_amount")).alias("net_profit_per_dollar"),
        "basis", "channels_considered",
    ).filter(F.col("shift_amount").isNotNull())


def reallocation_plan(profit_table: DataFrame, params: AnalysisParams = DEFAULTS) -> DataFrame:
    """current and recommended spend per elastic channel."""
    r = reallocation_roles(profit_table, params).filter(F.col("role").isNotNull())
    all_rows = Window.partitionBy(F.lit(1))
    moved = dbl("marketing_spend") * F.lit(params.shift_pct)
    shift = F.sum(F.when(F.col("role") == "donor", moved)).over(all_rows)
    change = (F.when(F.col("role") == "donor", -moved)
              .when(F.col("role") == "recipient", F.col("_w") * shift).otherwise(F.lit(0.0)))
    p = r.select("channel", "role", dbl("marketing_spend").alias("current_spend"), change.alias("change"))
    return p.select("channel", "role", round6("current_spend").alias("current_spend"),
                    round6(F.col("current_spend") + F.col("change")).alias("recommended_spend"),
                    round6("change").alias("change"),
                    round6(safe_div("change", "current_spend")).alias("change_pct"))


def headline_kpis(campaigns: DataFrame, customers: DataFrame, transactions: DataFrame,
                  params: AnalysisParams = DEFAULTS) -> DataFrame:
    """the scorecard in long format (kpi, value, basis). Three one-row
    aggregates (campaigns, customers, per-customer purchases) combined by
    scalar subqueries."""
    p = purchases(transactions, params.include_refunds_in_rfm)
    camp = campaigns.agg(F.sum("revenue").alias("rev"), F.sum("spend").alias("spend"),
                         F.sum("conversions").alias("conv"), F.sum("clicks").alias("clicks"))
    per = p.groupBy("customer_id").agg(F.sum("profit").alias("pp"), F.count(F.lit(1)).alias("np"))
    # one-row aggregates, cached so the scalar subqueries below read each of
    # them once instead of re-running the per-customer aggregation
    pc = per.agg(F.sum("pp").alias("gross"), F.count(F.lit(1)).alias("n_tx_customers"),
                 F.avg("pp").alias("mean_pp"), F.count_if(F.col("np") > 1).alias("repeaters")).cache()
    n_cust = customers.agg(F.count(F.lit(1)).alias("n")).cache().select("n").scalar()
    row = camp.select(
        dbl("rev").alias("rev"), dbl("spend").alias("spend"),
        dbl("conv").alias("conv"), dbl("clicks").alias("clicks"),
        pc.select(F.coalesce(dbl("gross"), F.lit(0.0))).scalar().alias("gross"),
        pc.select("n_tx_customers").scalar().alias("n_tx"),
        pc.select(dbl("mean_pp")).scalar().alias("mean_pp"),
        pc.select("repeaters").scalar().alias("repeaters"),
        n_cust.alias("n_cust"))
    if params.ltv_denominator == "all_customers":
        ltv = safe_div("gross", "n_cust")
        ltv_basis = F.format_string("all %s customers, zero-filled", F.format_number(F.col("n_cust"), 0))
    else:
        ltv = F.col("mean_pp")
        ltv_basis = F.format_string("%s customers who transacted", F.format_number(F.col("n_tx"), 0))
    cac = safe_div("spend", "n_cust")
    # KPI names, order and basis texts of the scorecard.
    items = [
        ("total_revenue", F.col("rev"), F.lit("campaign-attributed")),
        ("total_spend", F.col("spend"), F.lit("campaign media spend")),
        ("total_gross_profit", F.col("gross"), F.lit("non-refunded transaction profit")),
        ("total_net_profit", F.col("gross") - F.col("spend"), F.lit("transaction profit less marketing spend")),
        ("blended_cac", cac, F.format_string("spend / all %s customers", F.format_number(F.col("n_cust"), 0))),
        ("blended_ltv", ltv, ltv_basis),
        ("ltv_cac_ratio", F.try_divide(ltv, cac), F.lit("same denominator on both sides")),
        ("blended_roas", safe_div("rev", "spend"), F.lit("campaign revenue / spend")),
        ("blended_roi", safe_div(F.col("gross") - F.col("spend"), "spend"), F.lit("transaction profit / spend")),
        ("blended_cvr", safe_div("conv", "clicks"), F.lit("conversions / clicks")),
        ("repeat_rate", F.coalesce(safe_div("repeaters", "n_tx"), F.lit(0.0)),
         F.lit("share of transacting customers with >1 purchase")),
    ]
    # only values derived from a floating average are rounded
    averaged = {"blended_ltv", "ltv_cac_ratio"} if params.ltv_denominator != "all_customers" else set()
    arr = F.array(*[F.struct(F.lit(i + 1).alias("kpi_order"), F.lit(k).alias("kpi"),
                             (round6(v) if k in averaged else dbl(v)).alias("value"), b.alias("basis"))
                    for i, (k, v, b) in enumerate(items)])
    return row.select(F.inline(arr))


def top_channels(profit_table: DataFrame) -> DataFrame:
    """the top channel by campaign revenue vs by net profit."""
    return profit_table.agg(
        F.max_by("channel", F.struct("campaign_revenue", F.col("channel"))).alias("top_by_revenue"),
        F.max_by("channel", F.struct("net_profit", F.col("channel"))).alias("top_by_profit"),
    ).withColumn("rankings_disagree", F.col("top_by_revenue") != F.col("top_by_profit"))


def report_reallocation(profit_table: DataFrame, params: AnalysisParams = DEFAULTS) -> DataFrame:
    """the printed report's reallocation. Unlike F5 it always takes the configured
    channels, however few, and its ROI is the zero-filled net profit over spend, so a
    channel missing on one side has ROI 0. One row; empty without such channels."""
    el = profit_table.filter(F.col("channel").isin(list(params.elastic_paid_channels))).withColumn(
        "roi", safe_div("net_profit", "marketing_spend"))
    everyone = Window.partitionBy(F.lit(1))  # the configured channels
    order = Window.orderBy(F.col("roi").desc_nulls_last(), "channel")
    el = el.withColumn("pos", F.row_number().over(order)).withColumn("n", F.count(F.lit(1)).over(everyone))
    top, bottom = F.col("pos") <= params.n_recipients, F.col("pos") > F.col("n") - params.n_donors
    moved = F.when(bottom, F.col("marketing_spend") * F.lit(params.shift_pct))
    el = (el.withColumn("shift", F.sum(moved).over(everyone))
          .withColumn("share", F.try_divide(F.col("roi"), F.sum(F.when(top, F.col("roi"))).over(everyone)) * F.col("shift")))
    roas_ = safe_div("campaign_revenue", "marketing_spend")
    names = lambda c: F.array_join(F.transform(F.sort_array(F.collect_list(F.when(c, F.struct("pos", "channel")))),
                                               lambda s: s["channel"]), ", ")
    gain = lambda rate: F.sum(F.when(top, F.col("share") * rate)) - F.sum(moved * rate)
    return el.agg(round6(F.max("shift")).alias("shift_amount"), names(bottom).alias("from_channels"),
                  names(top).alias("to_channels"), round6(gain(F.col("roi"))).alias("net_profit_change"),
                  round6(gain(roas_)).alias("net_revenue_change")).filter(F.col("shift_amount").isNotNull())


def build(bundle) -> dict:
    """F8: the finance view, sharing one persisted customer-profit join."""
    p = bundle.params
    c, cu, t = bundle.campaigns, bundle.customers, bundle.transactions
    cust = customers_with_profit(cu, t, p).persist()
    table = profit_table(c, cu, cust)
    return {
        "kpis": headline_kpis(c, cu, t, p),
        "profitability": profitability(c, cu, cust),
        "cac_ltv": cac_ltv_by_channel(c, cu, cust, p),
        "reallocation": reallocation_summary(table, p),
        "plan": reallocation_plan(table, p),
    }
