"""Funnel and dimensional performance (M1 .. M9).

Every aggregate is a ratio of sums computed after a partially-aggregated
groupBy, so the shuffle carries one row per group per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from adpulse.functions.kpis import cpa, cpc, ctr, cvr, r6, roas, round6, safe_div
from adpulse.params import DEFAULTS, AnalysisParams

# Dimensions that may be grouped by; anything else is rejected.
GROUPABLE = ("channel", "device", "country", "objective", "audience")

_SUMS = ("impressions", "clicks", "conversions", "spend", "revenue")


def check_dimension(by: str) -> str:
    if by not in GROUPABLE:
        raise ValueError(f"{by!r} is no dimension to group by; there are {', '.join(GROUPABLE)}")
    return by


def _kpi_cols(prefix=""):
    return [
        r6(ctr("clicks", "impressions")).alias("ctr"),
        r6(cvr("conversions", "clicks")).alias("cvr"),
        r6(cpc("spend", "clicks")).alias("cpc"),
        r6(cpa("spend", "conversions")).alias("cpa"),
        r6(roas("revenue", "spend")).alias("roas"),
    ]


def _sum_aggs():
    return [F.sum("impressions").alias("impressions"), F.sum("clicks").alias("clicks"),
            F.sum("conversions").alias("conversions"), F.sum("spend").alias("spend"),
            F.sum("revenue").alias("revenue")]


def _finish(df: DataFrame, keys) -> DataFrame:
    return df.select(*keys,
                     F.col("impressions").cast("bigint").alias("impressions"),
                     F.col("clicks").cast("bigint").alias("clicks"),
                     F.col("conversions").cast("bigint").alias("conversions"),
                     r6("spend").alias("spend"), r6("revenue").alias("revenue"),
                     *_kpi_cols())


def funnel(campaigns: DataFrame) -> DataFrame:
    """M1: portfolio totals; spend summed over paid (spend > 0) rows only."""
    agg = campaigns.agg(
        F.sum("impressions").alias("impressions"), F.sum("clicks").alias("clicks"),
        F.sum("conversions").alias("conversions"),
        F.coalesce(F.sum(F.when(F.col("spend") > 0, F.col("spend"))), F.lit(0)).alias("spend"),
        F.sum("revenue").alias("revenue"))
    return _finish(agg, [])


def funnel_stages(campaigns: DataFrame) -> DataFrame:
    """M2: Impressions -> Clicks -> Conversions with share of impressions."""
    f = campaigns.agg(F.sum("impressions").alias("i"), F.sum("clicks").alias("c"),
                      F.sum("conversions").alias("v"))
    stages = F.array(
        F.struct(F.lit(1).alias("stage_order"), F.lit("Impressions").alias("stage"),
                 F.col("i").cast("bigint").alias("value"), F.lit(1.0).cast("double").alias("pct_of_initial")),
        F.struct(F.lit(2).alias("stage_order"), F.lit("Clicks").alias("stage"),
                 F.col("c").cast("bigint").alias("value"), r6(safe_div("c", "i")).alias("pct_of_initial")),
        F.struct(F.lit(3).alias("stage_order"), F.lit("Conversions").alias("stage"),
                 F.col("v").cast("bigint").alias("value"), r6(safe_div("v", "i")).alias("pct_of_initial")),
    )
    return f.select(F.inline(stages))


def groupby_kpis(campaigns: DataFrame, by: str = "channel") -> DataFrame:
    """M3: KPIs per value of one dimension, best ROAS first (NULL last)."""
    check_dimension(by)
    g = campaigns.filter(F.col(by).isNotNull()).groupBy(by).agg(*_sum_aggs())
    return _finish(g, [by]).orderBy(F.col("roas").desc_nulls_last(), F.col(by))


def all_dimension_kpis(campaigns: DataFrame) -> DataFrame:
    """M3 for all five dimensions in one pass over the table (GROUPING SETS):
    long format (dimension, value, sums, KPIs)."""
    g = campaigns.groupingSets([[d] for d in GROUPABLE], *GROUPABLE).agg(
        *_sum_aggs(), F.grouping_id().alias("_gid"))
    n = len(GROUPABLE)
    # grouping_id bit i (from the left) is 0 for the dimension that is grouped
    dim = F.lit(None).cast("string")
    val = F.lit(None).cast("string")
    for i, d in enumerate(GROUPABLE):
        bit = 1 << (n - 1 - i)
        is_d = (F.col("_gid").bitwiseAND(F.lit(bit)) == 0)
        dim = F.when(is_d, F.lit(d)).otherwise(dim)
        val = F.when(is_d, F.col(d)).otherwise(val)
    g = g.select(dim.alias("dimension"), val.alias("value"), *_SUMS).filter(F.col("value").isNotNull())
    return _finish(g, ["dimension", "value"])


def campaign_performance(campaigns: DataFrame, min_spend: float = 100) -> DataFrame:
    """Per-campaign totals over campaign-days with spend > min_spend. Rows that
    lack a group key are left out, as in every engine operator."""
    df = campaigns.filter(F.col("spend") > F.lit(min_spend)).dropna(
        subset=["campaign_id", "campaign_name", "channel"])
    return (df.groupBy("campaign_id", "campaign_name", "channel")
            .agg(F.sum("spend").alias("spend"), F.sum("revenue").alias("revenue"),
                 F.sum("conversions").alias("conversions"))
            .select("campaign_id", "campaign_name", "channel",
                    r6("spend").alias("spend"), r6("revenue").alias("revenue"),
                    F.col("conversions").cast("bigint").alias("conversions"),
                    roas("revenue", "spend").alias("_roas"),
                    r6(roas("revenue", "spend")).alias("roas"), r6(cpa("spend", "conversions")).alias("cpa")))


def campaign_leaderboard(campaigns: DataFrame, min_spend: float = 100, n: int = 5) -> DataFrame:
    """M4: top n and bottom n (worst first) campaigns by ROAS, plus the
    number of qualifying campaigns. Each side is a distributed top-k with a
    campaign_id tie-break."""
    perf = campaign_performance(campaigns, min_spend).persist()
    n_campaigns = perf.select(F.count(F.lit(1)).cast("bigint")).scalar()
    top = perf.orderBy(F.col("_roas").desc_nulls_last(), F.col("campaign_id")).limit(n)
    bottom = perf.orderBy(F.col("_roas").asc_nulls_first(), F.col("campaign_id").desc()).limit(n)
    wt = Window.orderBy(F.col("_roas").desc_nulls_last(), F.col("campaign_id"))
    wb = Window.orderBy(F.col("_roas").asc_nulls_first(), F.col("campaign_id").desc())
    cols = ["campaign_id", "campaign_name", "channel", "spend", "revenue", "conversions", "roas", "cpa"]
    # windows below run over at most n rows each
    t = top.select(F.lit("top").alias("side"), F.row_number().over(wt).alias("position"), *cols)
    b = bottom.select(F.lit("bottom").alias("side"), F.row_number().over(wb).alias("position"), *cols)
    return t.unionByName(b).withColumn("n_campaigns", n_campaigns)


def monthly_revenue_exact(campaigns: DataFrame, params: AnalysisParams = DEFAULTS) -> DataFrame:
    """M5 with revenue kept as an exact DECIMAL: revenue per calendar month,
    zero-filled between the first and last month; a trailing month whose last
    day is after the data's last date is dropped when
    ``drop_partial_trailing_month``."""
    # one scan: all that follows runs over one row per calendar month. Each
    # month is spread up to the next one that has rows.
    by_month = (campaigns.filter(F.col("date").isNotNull()).groupBy(F.trunc("date", "MM").alias("month"))
                .agg(F.sum("revenue").alias("revenue"), F.max("date").alias("_hi")))
    all_months = Window.partitionBy(F.lit(0))
    rows = by_month.select(
        "month", "revenue", F.max("_hi").over(all_months).alias("hi"),
        F.coalesce(F.add_months(F.lead("month").over(all_months.orderBy("month")), -1), "month").alias("_until"))
    out = rows.withColumn("_m", F.explode(F.sequence("month", "_until", F.expr("interval 1 month"))))
    if params.drop_partial_trailing_month:
        out = out.filter((F.col("hi") == F.last_day("hi")) | (F.col("_m") < F.trunc("hi", "MM")))
    return out.select(F.col("_m").alias("month"),
                      F.when(F.col("_m") == F.col("month"), F.coalesce(F.col("revenue"), F.lit(0)))
                      .otherwise(F.lit(0)).cast("decimal(28,4)").alias("revenue"))


def monthly_revenue(campaigns: DataFrame, params: AnalysisParams = DEFAULTS) -> DataFrame:
    """M5: monthly revenue series as DOUBLE."""
    return monthly_revenue_exact(campaigns, params).select("month", r6("revenue").alias("revenue"))


def seasonality(campaigns: DataFrame, params: AnalysisParams = DEFAULTS) -> DataFrame:
    """M6: peak month (earliest on ties), its revenue, mean revenue, months."""
    m = monthly_revenue(campaigns, params)
    return m.agg(
        F.min_by("month", F.struct(-F.col("revenue"), F.col("month"))).alias("peak_month"),
        F.max("revenue").alias("peak_revenue"),
        round6(F.avg("revenue")).alias("mean_revenue"),
        F.count(F.lit(1)).cast("bigint").alias("months_used"),
    ).filter(F.col("months_used") > 0)


def daily_revenue(campaigns: DataFrame) -> DataFrame:
    """M7: revenue per day (no zero fill)."""
    return campaigns.filter(F.col("date").isNotNull()).groupBy("date").agg(r6(F.sum("revenue")).alias("revenue"))


def channel_mix(campaigns: DataFrame) -> DataFrame:
    """M8: spend and revenue by channel."""
    return (campaigns.filter(F.col("channel").isNotNull()).groupBy("channel")
            .agg(r6(F.sum("spend")).alias("spend"), r6(F.sum("revenue")).alias("revenue"))
            .orderBy(F.col("spend").desc(), "channel"))


def row_kpis(campaigns: DataFrame) -> DataFrame:
    """B2/B3 at row grain: the KPI projection of every campaign-day."""
    return campaigns.select("campaign_id", "date", "channel",
                            r6(ctr("clicks", "impressions")).alias("ctr"),
                            r6(cvr("conversions", "clicks")).alias("cvr"),
                            r6(cpc("spend", "clicks")).alias("cpc"),
                            r6(cpa("spend", "conversions")).alias("cpa"),
                            r6(roas("revenue", "spend")).alias("roas"))


def build(bundle) -> dict:
    """M9: everything the marketing view needs, as separate DataFrames that
    share one cached scan of the clean campaigns."""
    c = bundle.campaigns.persist()
    return {
        "funnel": funnel(c),
        "stages": funnel_stages(c),
        "by_dimension": all_dimension_kpis(c),
        "campaigns": campaign_leaderboard(c),
        "seasonality": seasonality(c, bundle.params),
    }
