"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each query derives the engine tables from the parquet inputs, runs the audit
(clean tables) and then one operator over the whole tables. Parametrised
operators get one key per variant.
"""

from __future__ import annotations

from adpulse.operators import customers as cu
from adpulse.operators import finance as fi
from adpulse.operators import marketing as mk
from adpulse.sources.bundle import load_bundle

QUERIES: dict = {}


def register(name):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _b(spark, sf_dir, tables=None, params=None):
    kw = {}
    if tables is not None:
        kw["tables"] = tables
    if params is not None:
        kw["params"] = params
    return load_bundle(spark, sf_dir, **kw)


_C = ("campaigns",)
_CT = ("customers", "transactions")
_CCT = ("campaigns", "customers", "transactions")


# ------------------------------------------------------------ audit (Q)
@register("q_report")
def _q_report(spark, sf):
    return _b(spark, sf).audit.report


@register("q_rows")
def _q_rows(spark, sf):
    return _b(spark, sf).audit.rows


@register("q_flagged")
def _q_flagged(spark, sf):
    from adpulse.operators.quality import flagged_summary
    return flagged_summary(_b(spark, sf).audit.report)


@register("q_clean_campaigns")
def _q_clean_campaigns(spark, sf):
    return _b(spark, sf, _C).campaigns


@register("q_clean_transactions")
def _q_clean_transactions(spark, sf):
    return _b(spark, sf, _CT).transactions


@register("q_quarantine_counts")
def _q_quarantine(spark, sf):
    from pyspark.sql import functions as F
    q = _b(spark, sf).audit.quarantine
    return q.groupBy("rule_key", "table_name").agg(F.count(F.lit(1)).alias("rows_quarantined"))


@register("q_examples")
def _q_examples(spark, sf):
    """Q-13 with the rows' own columns (money as DOUBLE)."""
    from adpulse.functions.kpis import dbl
    out = _b(spark, sf).audit.examples.drop("row_json")
    return out.select(*[dbl(c).alias(c) if t.startswith("decimal") else c for c, t in out.dtypes])


@register("q_example_keys")
def _q_example_keys(spark, sf):
    """Q-13 at key level (rule, rank, identifying key): checkable by SQL."""
    return _b(spark, sf).audit.examples.select("rule_key", "table_name", "example_rank", "example_key")


# ------------------------------------------------------------ marketing (M)
for _dim in mk.GROUPABLE:
    QUERIES[f"m3_by_{_dim}"] = (lambda d: lambda spark, sf: mk.groupby_kpis(
        _b(spark, sf, _C).campaigns, d))(_dim)

QUERIES["m1_funnel"] = lambda spark, sf: mk.funnel(_b(spark, sf, _C).campaigns)
QUERIES["m2_funnel_stages"] = lambda spark, sf: mk.funnel_stages(_b(spark, sf, _C).campaigns)
QUERIES["m3_all_dimensions"] = lambda spark, sf: mk.all_dimension_kpis(_b(spark, sf, _C).campaigns)
QUERIES["m4_leaderboard"] = lambda spark, sf: mk.campaign_leaderboard(_b(spark, sf, _C).campaigns)
QUERIES["m5_monthly_revenue"] = lambda spark, sf: mk.monthly_revenue(_b(spark, sf, _C).campaigns)
QUERIES["m6_seasonality"] = lambda spark, sf: mk.seasonality(_b(spark, sf, _C).campaigns)
QUERIES["m7_daily_revenue"] = lambda spark, sf: mk.daily_revenue(_b(spark, sf, _C).campaigns)
QUERIES["m8_channel_mix"] = lambda spark, sf: mk.channel_mix(_b(spark, sf, _C).campaigns)
QUERIES["b_row_kpis"] = lambda spark, sf: mk.row_kpis(_b(spark, sf, _C).campaigns)


# ------------------------------------------------------------ customers (C)
@register("c1_reference_date")
def _c1(spark, sf):
    from pyspark.sql import functions as F
    t = _b(spark, sf, _CT).transactions
    return t.agg(F.max("transaction_date").alias("reference_date"))


@register("c2_rfm_base")
def _c2(spark, sf):
    from pyspark.sql import functions as F
    from adpulse.functions.kpis import r6
    b = cu.rfm_base(_b(spark, sf, _CT).transactions)
    return b.select("customer_id", "last_purchase", F.col("frequency").cast("bigint").alias("frequency"),
                    r6("monetary").alias("monetary"), F.col("recency_days").cast("int").alias("recency_days"))


@register("c6_rfm_segments")
def _c6(spark, sf):
    b = _b(spark, sf, _CT)
    return cu.rfm_table(b.transactions, b.customers, b.params)


@register("c5_bins_used")
def _c5(spark, sf):
    return cu.rfm_bins_used(_b(spark, sf, _CT).transactions)


@register("c8_segment_summary")
def _c8(spark, sf):
    b = _b(spark, sf, _CT)
    return cu.segment_summary(cu.rfm_table(b.transactions, None, b.params))


def _activity(spark, sf):
    b = _b(spark, sf, _CT)
    return b, cu.cohort_activity(b.transactions, b.customers, b.params)


@register("c10_cohort_retention")
def _c10(spark, sf):
    b, a = _activity(spark, sf)
    return cu.cohort_counts(a, b.customers, b.params)


@register("c11_retention_matrix")
def _c11(spark, sf):
    b, a = _activity(spark, sf)
    return cu.retention_matrix(cu.cohort_counts(a, b.customers, b.params),
                               cu.reference_date(b.transactions, b.params))


@register("c12_cohort_means")
def _c12(spark, sf):
    b, a = _activity(spark, sf)
    return cu.cohort_means(cu.cohort_counts(a, b.customers, b.params, rounded=False))


@register("c13_retention_by_channel")
def _c13(spark, sf):
    b, a = _activity(spark, sf)
    return cu.retention_by_channel(a, b.customers, b.params)


@register("c14_month3_channel_ranking")
def _c14(spark, sf):
    b, a = _activity(spark, sf)
    return cu.month_n_channel_ranking(cu.retention_by_channel(a, b.customers, b.params), 3)


@register("c15_value_by_plan")
def _c15(spark, sf):
    b = _b(spark, sf, _CT)
    return cu.value_by_plan(b.transactions, b.customers, b.params)


@register("c16_steepest_drop")
def _c16(spark, sf):
    b, a = _activity(spark, sf)
    return cu.steepest_drop(cu.cohort_counts(a, b.customers, b.params, rounded=False))


# ------------------------------------------------------------ finance (F)
@register("f1_lifetime_profit")
def _f1(spark, sf):
    from adpulse.functions.kpis import r6
    t = _b(spark, sf, _CT).transactions
    return fi.lifetime_profit(t).select("customer_id", r6("lifetime_profit").alias("lifetime_profit"))


@register("f2_customers_profit")
def _f2(spark, sf):
    from adpulse.functions.kpis import r6
    b = _b(spark, sf, _CT)
    return fi.customers_with_profit(b.customers, b.transactions).select(
        "customer_id", "acquisition_channel", "subscription_plan", r6("lifetime_profit").alias("lifetime_profit"))


def _finance(spark, sf, params=None):
    b = _b(spark, sf, _CCT, params)
    return b, fi.customers_with_profit(b.customers, b.transactions, b.params)


@register("f3_cac_ltv")
def _f3(spark, sf):
    b, cp = _finance(spark, sf)
    return fi.cac_ltv_by_channel(b.campaigns, b.customers, cp, b.params)


@register("f3_cac_ltv_transacting")
def _f3t(spark, sf):
    from adpulse.params import DEFAULTS
    b, cp = _finance(spark, sf, DEFAULTS.replace(ltv_denominator="transacting_customers"))
    return fi.cac_ltv_by_channel(b.campaigns, b.customers, cp, b.params)


@register("f4_profitability")
def _f4(spark, sf):
    b, cp = _finance(spark, sf)
    return fi.profitability(b.campaigns, b.customers, cp)


@register("f5_reallocation")
def _f5(spark, sf):
    b, cp = _finance(spark, sf)
    return fi.reallocation_summary(fi.profit_table(b.campaigns, b.customers, cp), b.params)


@register("f6_reallocation_plan")
def _f6(spark, sf):
    b, cp = _finance(spark, sf)
    return fi.reallocation_plan(fi.profit_table(b.campaigns, b.customers, cp), b.params)


@register("f7_headline_kpis")
def _f7(spark, sf):
    b = _b(spark, sf, _CCT)
    return fi.headline_kpis(b.campaigns, b.customers, b.transactions, b.params)


@register("f7_headline_kpis_transacting")
def _f7t(spark, sf):
    from adpulse.params import DEFAULTS
    b = _b(spark, sf, _CCT, DEFAULTS.replace(ltv_denominator="transacting_customers"))
    return fi.headline_kpis(b.campaigns, b.customers, b.transactions, b.params)


@register("f9_top_channels")
def _f9(spark, sf):
    b, cp = _finance(spark, sf)
    return fi.top_channels(fi.profit_table(b.campaigns, b.customers, cp))


@register("f9_report_reallocation")
def _f9r(spark, sf):
    b, cp = _finance(spark, sf)
    return fi.report_reallocation(fi.profit_table(b.campaigns, b.customers, cp), b.params)


@register("f10_net_profit_inner")
def _f10(spark, sf):
    b, cp = _finance(spark, sf)
    return fi.channel_net_profit_inner(b.campaigns, cp)


# ------------------------------------------------------------ SQL corpus (S)
def _raw(spark, sf, tables):
    from adpulse.sources.fixtures import BUILDERS
    return [BUILDERS[t](spark, sf) for t in tables]


def _register_corpus():
    from adpulse.plans import sqlcorpus as S
    one_c = {"s01_monthly_revenue_spend": S.s01_monthly_revenue_spend, "s03_campaign_roas": S.s03_campaign_roas,
             "s04_channel_roi": S.s04_channel_roi, "s10_campaign_ranks": S.s10_campaign_ranks,
             "s11_moving_average": S.s11_moving_average, "s12_running_total": S.s12_running_total,
             "s13_mom_growth": S.s13_mom_growth, "s14_device_rates": S.s14_device_rates,
             "s15_country_roas": S.s15_country_roas}
    for k, fn in one_c.items():
        QUERIES[k] = (lambda f: lambda spark, sf: f(*_raw(spark, sf, ("campaigns",))))(fn)
    one_t = {"s02_monthly_profit": S.s02_monthly_profit, "s17_refunds_by_category": S.s17_refunds_by_category,
             "s18_discount_bands": S.s18_discount_bands, "s20_rfm_ntile": S.s20_rfm_ntile}
    for k, fn in one_t.items():
        QUERIES[k] = (lambda f: lambda spark, sf: f(*_raw(spark, sf, ("transactions",))))(fn)
    cu_t = {"s06_ltv_by_channel": S.s06_ltv_by_channel, "s08_cohort_activity": S.s08_cohort_activity,
            "s09_top_customers": S.s09_top_customers, "s16_power_users": S.s16_power_users}
    for k, fn in cu_t.items():
        QUERIES[k] = (lambda f: lambda spark, sf: f(*_raw(spark, sf, ("customers", "transactions"))))(fn)
    QUERIES["s05_cac_by_channel"] = lambda spark, sf: S.s05_cac_by_channel(*_raw(spark, sf, ("campaigns", "customers")))
    QUERIES["s07_ltv_cac"] = lambda spark, sf: S.s07_ltv_cac(*_raw(spark, sf, ("campaigns", "customers", "transactions")))
    QUERIES["s19_variant_comparison"] = lambda spark, sf: S.s19_variant_comparison(*_raw(spark, sf, ("ab_test",)))
    QUERIES["s21_orphans"] = lambda spark, sf: S.s21_orphans(*_raw(spark, sf, ("transactions", "customers")))


_register_corpus()


# ------------------------------------------------------------ experiments (E)
@register("e1_variant_summary")
def _e1(spark, sf):
    from adpulse.operators.experiments import variant_summary
    return variant_summary(_b(spark, sf, ("ab_test",)).ab_test)


@register("e2_ab_statistics")
def _e2(spark, sf):
    from adpulse.operators.experiments import ab_test
    b = _b(spark, sf, ("ab_test",))
    return ab_test(b.ab_test, b.params, with_p_values=False)


@register("e3_ab_test")
def _e3(spark, sf):
    from adpulse.operators.experiments import ab_test
    b = _b(spark, sf, ("ab_test",))
    return ab_test(b.ab_test, b.params)


# ------------------------------------------------------------ forecast (T)
def _series(spark, sf):
    from adpulse.operators.forecast import monthly_series
    b = _b(spark, sf, _C)
    return b, monthly_series(b.campaigns, b.params)


@register("t5_backtest_closed_form")
def _t5c(spark, sf):
    from adpulse.operators.forecast import backtest
    b, s = _series(spark, sf)
    return backtest(s, b.params.replace(forecast_methods=("moving_average", "linear_trend")))


@register("t5_backtest")
def _t5(spark, sf):
    from adpulse.operators.forecast import backtest
    b, s = _series(spark, sf)
    return backtest(s, b.params)


@register("t6_trend")
def _t6(spark, sf):
    from adpulse.operators.forecast import trend_diagnostics
    b, s = _series(spark, sf)
    return trend_diagnostics(s, with_p_value=False)


@register("t6_trend_p_value")
def _t6p(spark, sf):
    from adpulse.operators.forecast import trend_diagnostics
    b, s = _series(spark, sf)
    return trend_diagnostics(s)


@register("t7_forecast_closed_form")
def _t7c(spark, sf):
    from adpulse.operators.forecast import select_and_forecast
    b, s = _series(spark, sf)
    return select_and_forecast(s, b.params.replace(forecast_methods=("moving_average", "linear_trend")))


@register("t7_forecast")
def _t7(spark, sf):
    from adpulse.operators.forecast import select_and_forecast
    b, s = _series(spark, sf)
    return select_and_forecast(s, b.params)


def _many_series(spark, sf):
    from adpulse.operators.rolling import revenue_series
    return revenue_series(_b(spark, sf, _C).campaigns)


@register("t5_rolling_backtest")
def _t5r(spark, sf):
    from pyspark.sql import functions as F
    from adpulse.operators.rolling import UNIT, rolling_backtest
    out = rolling_backtest(_many_series(spark, sf))
    return out.withColumns({c: F.col(c) / UNIT for c in ("actual", "moving_average", "linear_trend")})


@register("t5_rolling_ranking")
def _t5k(spark, sf):
    from adpulse.operators.rolling import rolling_backtest, rolling_ranking
    return rolling_ranking(rolling_backtest(_many_series(spark, sf)))


@register("t7_rolling_forecast")
def _t7r(spark, sf):
    from adpulse.operators.rolling import rolling_backtest, rolling_forecast, rolling_ranking
    series = _many_series(spark, sf)
    return rolling_forecast(series, rolling_ranking(rolling_backtest(series)))


# ------------------------------------------------------------ coverage (A)
def _tables(spark, sf, raw=False):
    b = _b(spark, sf)
    if raw:
        return b, dict(b.raw)
    return b, b.tables


@register("a5_as_of_channel_kpis")
def _a5(spark, sf):
    """Channel KPIs on the slice visible at a cursor (filter pushed into the
    derivation of every table)."""
    return mk.groupby_kpis(_b(spark, sf, _C).as_of("1998-12-31").campaigns, "channel")


@register("a6_max_date")
def _a6(spark, sf):
    from adpulse.operators.coverage import max_date
    return max_date(_tables(spark, sf)[1])


@register("a7_months_of_history")
def _a7(spark, sf):
    from adpulse.operators.coverage import months_of_history
    return months_of_history(_tables(spark, sf)[1])


@register("a8_capabilities")
def _a8(spark, sf):
    from adpulse.operators.coverage import capabilities
    b, t = _tables(spark, sf)
    return capabilities(t, b.params)


@register("a9_table_profile")
def _a9(spark, sf):
    from adpulse.operators.coverage import table_profile
    return table_profile(_tables(spark, sf, raw=True)[1])


@register("a10_null_profile")
def _a10(spark, sf):
    from adpulse.operators.coverage import null_profile
    return null_profile(_tables(spark, sf, raw=True)[1])


# ------------------------------------------------------------ snapshot / replay / streaming (R)
@register("r1_snapshot_status")
def _r1(spark, sf):
    from adpulse.plans.snapshot import snapshot_status
    b = _b(spark, sf)
    return snapshot_status(b, b.params)


@register("r1_snapshot_header")
def _r1h(spark, sf):
    from adpulse.plans.snapshot import snapshot_header
    return snapshot_header(_b(spark, sf))


@register("r1_snapshot_modules")
def _r1m(spark, sf):
    from adpulse.plans.snapshot import snapshot_modules
    return snapshot_modules(_b(spark, sf))


@register("r2_replay_series")
def _r2(spark, sf):
    from adpulse.plans.snapshot import replay_series
    return replay_series(_b(spark, sf))


@register("r3_replay_repeat_customers")
def _r3(spark, sf):
    from adpulse.plans.snapshot import replay_repeat_customers
    return replay_repeat_customers(_b(spark, sf))


@register("r3_replay_segments")
def _r3s(spark, sf):
    from adpulse.plans.replay import replay_segments
    return replay_segments(_b(spark, sf))


@register("r3_replay_cohorts")
def _r3c(spark, sf):
    from adpulse.plans.replay import replay_cohorts
    return replay_cohorts(_b(spark, sf))


@register("r4_stream_channel_kpis")
def _r4(spark, sf):
    from adpulse.streaming.jobs import stream_channel_kpis
    return stream_channel_kpis(spark, sf)


@register("r5_stream_weekly_revenue")
def _r5(spark, sf):
    from adpulse.streaming.jobs import stream_weekly_revenue
    return stream_weekly_revenue(spark, sf)


@register("r6_stream_dedup")
def _r6(spark, sf):
    from adpulse.streaming.jobs import stream_dedup
    return stream_dedup(spark, sf)


@register("r7_stream_enrich")
def _r7(spark, sf):
    from adpulse.streaming.jobs import stream_enrich
    from adpulse.sources.fixtures import customers, stream_table, transactions
    return stream_enrich(transactions(spark, sf, stream_table(spark, sf, "lineitem")),
                         customers(spark, sf, stream_table(spark, sf, "customer")), one_batch=True)


def normalize_types(df):
    """Output convention: every integral column leaves as BIGINT, every
    floating column as DOUBLE (so result schemas do not depend on which
    integer width an expression happened to produce)."""
    from pyspark.sql import functions as F
    from pyspark.sql import types as T
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            cols.append(F.col(f.name).cast("bigint").alias(f.name))
        elif isinstance(f.dataType, T.FloatType):
            cols.append(F.col(f.name).cast("double").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def _run(fn, spark, sf):
    from adpulse.session import ensure_checkpoint_dir, ship_package
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return normalize_types(fn(spark, sf))


def exported() -> dict:
    return {name: (lambda fn: lambda spark, sf: _run(fn, spark, sf))(fn) for name, fn in QUERIES.items()}

