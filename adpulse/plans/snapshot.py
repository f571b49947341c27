"""Point-in-time snapshot status and replay (R1 .. R3, R8).

The replay re-aim: instead of recomputing a snapshot per wall-clock tick,
every table is first reduced to one row per day (one scan each), each day is
assigned to the first tick whose cursor covers it
(tick = ceil((date - start) / 7), clamped to the last tick), and the ticks get
running sums. The spine has ceil(span / 7) + 1 rows (bounded by the
calendar), so its window is tiny; no row is ever paired with more than one
cursor.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from adpulse.functions.kpis import dbl, month_ordinal, safe_div
from adpulse.params import DEFAULTS, AnalysisParams
from adpulse.session import ensure_checkpoint_dir
from adpulse.sources.io import SavedBundle

DAYS_PER_TICK = 7


def _daily(bundle) -> dict:
    """Every table aggregated to its date once (one scan each). The results
    have at most one row per calendar day, so they are cached and all replay
    arithmetic runs on them."""
    c = (bundle.campaigns.groupBy("date")
         .agg(F.sum("revenue").alias("revenue"), F.sum("spend").alias("spend"),
              F.sum("impressions").alias("impressions"), F.sum("clicks").alias("clicks"),
              F.sum("conversions").alias("conversions")))
    p = ~F.col("refund_flag")
    t = (bundle.transactions.groupBy(F.col("transaction_date").alias("date"))
         .agg(F.count_if(p).alias("purchases"), F.sum(F.when(p, F.col("profit"))).alias("gross_profit")))
    cu = bundle.customers.groupBy(F.col("acquisition_date").alias("date")).agg(F.count(F.lit(1)).alias("customers"))
    out = {"campaigns": c.cache(), "transactions": t.cache(), "customers": cu.cache()}
    if bundle.raw.get("ab_test") is not None:
        out["ab_test"] = bundle.ab_test.select("date").distinct().cache()
    return out


def replay_bounds(daily: dict):
    """(start, end, total_ticks) as Python values from the daily tables:
    start = earliest campaign/customer/transaction date, end = latest date of
    any table. One small job over calendar-sized inputs; a bounded result."""
    parts = [df.select(F.lit(n).alias("t"), "date") for n, df in daily.items()]
    u = parts[0]
    for x in parts[1:]:
        u = u.unionByName(x)
    row = u.agg(F.min(F.when(F.col("t") != "ab_test", F.col("date"))).alias("s"), F.max("date").alias("e")).first()
    start, end = row["s"], row["e"]
    total = max(1, -(-(end - start).days // DAYS_PER_TICK))
    return start, end, total


def _tick_of(d: Column, start, total: int) -> Column:
    k = F.ceil(F.datediff(d, F.lit(start)) / DAYS_PER_TICK)
    return F.least(F.greatest(k, F.lit(0)), F.lit(total))


def _spine(spark, start, end, total: int) -> DataFrame:
    """Ticks 0..total_ticks; the last one is the clamped end (holding)."""
    return spark.range(0, total + 1).select(
        F.col("id").alias("tick"),
        F.least(F.date_add(F.lit(start), (F.col("id") * DAYS_PER_TICK).cast("int")), F.lit(end)).alias("cursor"))


def replay_series(bundle) -> DataFrame:
    """R2: additive KPIs as of every replay cursor. Rows are reduced to days,
    each day is assigned to the first tick whose cursor covers it, and the
    ticks get running sums."""
    daily = _daily(bundle)
    start, end, total = replay_bounds(daily)
    spark = bundle.campaigns.sparkSession

    def per_tick(df, cols):
        return df.groupBy(_tick_of(F.col("date"), start, total).alias("tick")).agg(
            *[F.sum(c).alias(c) for c in cols])

    c = per_tick(daily["campaigns"], ["revenue", "spend", "impressions", "clicks", "conversions"])
    t = per_tick(daily["transactions"], ["purchases", "gross_profit"])
    cu = per_tick(daily["customers"], ["customers"])
    s = _spine(spark, start, end, total).join(c, "tick", "left").join(t, "tick", "left").join(cu, "tick", "left")
    w = Window.orderBy("tick").rowsBetween(Window.unboundedPreceding, 0)  # over the tick spine only
    run = lambda col: F.sum(F.coalesce(F.col(col), F.lit(0))).over(w)
    out = s.select("tick", "cursor",
                   dbl(run("revenue")).alias("revenue"), dbl(run("spend")).alias("spend"),
                   run("impressions").cast("bigint").alias("impressions"),
                   run("clicks").cast("bigint").alias("clicks"),
                   run("conversions").cast("bigint").alias("conversions"),
                   run("purchases").cast("bigint").alias("purchases"),
                   dbl(run("gross_profit")).alias("gross_profit"),
                   run("customers").cast("bigint").alias("customers"))
    return out.withColumn("roas", safe_div("revenue", "spend"))


def replay_repeat_customers(bundle) -> DataFrame:
    """A non-additive metric per cursor: transacting customers, repeat
    customers (>1 purchase) and the repeat rate as of each cursor. Each
    customer contributes its first and second purchase dates, found over its
    distinct purchase days (bounded by the calendar), then counted per tick."""
    start, end, total = replay_bounds(_daily(bundle))
    spark = bundle.transactions.sparkSession
    days = (bundle.transactions.filter(~F.col("refund_flag") & F.col("customer_id").isNotNull())
            .groupBy("customer_id", "transaction_date").agg(F.count(F.lit(1)).alias("n")))
    w = Window.partitionBy("customer_id").orderBy("transaction_date")
    cum = days.withColumn("cum", F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    per = cum.groupBy("customer_id").agg(F.min("transaction_date").alias("first"),
                                         F.min(F.when(F.col("cum") >= 2, F.col("transaction_date"))).alias("second"))
    firsts = per.groupBy(_tick_of(F.col("first"), start, total).alias("tick")).agg(F.count(F.lit(1)).alias("f"))
    seconds = (per.filter(F.col("second").isNotNull())
               .groupBy(_tick_of(F.col("second"), start, total).alias("tick")).agg(F.count(F.lit(1)).alias("s")))
    s = _spine(spark, start, end, total).join(firsts, "tick", "left").join(seconds, "tick", "left")
    wr = Window.orderBy("tick").rowsBetween(Window.unboundedPreceding, 0)
    out = s.select("tick", "cursor",
                   F.sum(F.coalesce("f", F.lit(0))).over(wr).cast("bigint").alias("transacting_customers"),
                   F.sum(F.coalesce("s", F.lit(0))).over(wr).cast("bigint").alias("repeat_customers"))
    return out.withColumn("repeat_rate", F.coalesce(safe_div("repeat_customers", "transacting_customers"),
                                                    F.lit(0.0)))


def _gates(bundle, params: AnalysisParams) -> dict[str, Column]:
    """What decides whether a module can run, as scalar subqueries: rows per table, complete months,
    purchasing customers, cohorts of sufficient size, clicks per variant; 0 for an absent table."""
    from adpulse.operators.customers import cohort_activity, cohort_counts
    names = ("campaigns", "months", "customers", "transactions", "rfm_n", "cohorts", "ab_test", "clicks_a", "clicks_b")
    g = dict.fromkeys(names, F.lit(0).cast("bigint"))
    present = {n for n, df in bundle.raw.items() if df is not None}

    def fill(df: DataFrame, **aggregates: Column) -> None:
        row = df.agg(F.struct(*[c.cast("bigint").alias(n) for n, c in aggregates.items()]).alias("r")).scalar()
        g.update((n, F.coalesce(row[n], F.lit(0))) for n in aggregates)

    if "campaigns" in present:
        last = F.max("date")
        end = F.trunc(last, "MM")
        if params.drop_partial_trailing_month:
            end = F.when(last < F.last_day(last), F.add_months(end, -1)).otherwise(end)
        fill(bundle.campaigns, campaigns=F.count(F.lit(1)),
             months=F.greatest(month_ordinal(end) - month_ordinal(F.min("date")) + 1, F.lit(0)))
    if "customers" in present:
        fill(bundle.customers, customers=F.count(F.lit(1)))
    if "transactions" in present:
        fill(bundle.transactions, transactions=F.count(F.lit(1)),
             rfm_n=F.countDistinct(F.when(~F.col("refund_flag"), F.col("customer_id"))))
    if {"customers", "transactions"} <= present:
        fill(cohort_counts(cohort_activity(bundle.transactions, bundle.customers, params), bundle.customers, params),
             cohorts=F.countDistinct("cohort"))
    if "ab_test" in present:
        clicks = lambda v: F.sum(F.when(F.col("variant") == v, F.col("clicks")))
        fill(bundle.ab_test, ab_test=F.count(F.lit(1)), clicks_a=clicks("A"), clicks_b=clicks("B"))
    return g


def snapshot_status(bundle, params: AnalysisParams = DEFAULTS) -> DataFrame:
    """One row per module with status ok / unavailable /
    insufficient_data and the reason, decided from counts rather than from
    failures inside plans. One lazy plan: the counts are scalar subqueries."""
    spark = next(df for df in bundle.raw.values() if df is not None).sparkSession
    names = _gates(bundle, params)
    gates = spark.range(1).select(*[c.alias(n) for n, c in names.items()])
    g = {n: F.col(n) for n in names}
    need = params.holdout_months + 3
    few_buyers = g["rfm_n"] < params.min_rfm_customers
    mods = [
        ("marketing", ("campaigns",), g["months"] < 1, F.lit("seasonality needs at least 1 complete month")),
        ("customers", ("customers", "transactions"), few_buyers | (g["cohorts"] < 1),
         F.when(few_buyers, F.concat(F.lit(f"rfm needs {params.min_rfm_customers} purchasing customers; has "), g["rfm_n"].cast("string")))
         .otherwise(F.lit(f"cohorts need a cohort of at least {params.cohort_min_size} customers"))),
        ("finance", ("campaigns", "customers", "transactions"), g["customers"] < 1, F.lit("kpis needs at least 1 customer")),
        ("experiments", ("ab_test",), (g["clicks_a"] <= 0) | (g["clicks_b"] <= 0),
         F.lit("ab_test needs clicks in both variants A and B")),
        ("forecast", ("campaigns",), g["months"] < need,
         F.concat(F.lit(f"forecast needs {need} months; has "), g["months"].cast("string"))),
    ]
    rows = []
    for i, (m, tables, insufficient, why) in enumerate(mods, 1):
        missing = F.lit(False)
        for t in tables:
            missing = missing | (g[t] <= 0)
        rows.append(F.struct(
            F.lit(i).cast("bigint").alias("module_order"), F.lit(m).alias("module"),
            F.when(missing, "unavailable").when(insufficient, "insufficient_data").otherwise("ok").alias("status"),
            F.when(missing, F.lit(f"{m} requires {', '.join(tables)}")).when(insufficient, why).alias("reason")))
    return gates.select(F.explode(F.array(*rows)).alias("m")).select("m.*")


def snapshot_header(bundle, params: AnalysisParams = DEFAULTS) -> DataFrame:
    """The snapshot's own row: cursor, parameters' fingerprint, history, raw and clean rows per
    table, and what the data allow."""
    from adpulse.operators.coverage import coverage
    counts = bundle.audit.rows
    wide = counts.agg(*[F.max(F.when(F.col("table_name") == t, F.col(c))).alias(f"{t}_{c}")
                        for t in bundle.tables for c in ("rows_before", "rows_after")])
    what = coverage(bundle.tables, params)
    known = what.select(F.struct(*what.columns)).scalar()  # one row, one subquery
    return wide.withColumn("known", known).select(
        (F.lit(bundle.cursor) if bundle.cursor else F.col("known.max_date")).alias("as_of"),
        F.lit(params.fingerprint()).alias("params_hash"), "known.months_of_history", *wide.columns,
        *[f"known.{c}" for c in what.columns if c.startswith("can_")])


def _melted(df: DataFrame, module: str, output: str, keys: tuple[str, ...]) -> DataFrame:
    """A module's table as one row per key and number."""
    numeric = [f.name for f in df.schema.fields if f.name not in keys and f.dataType.typeName() in (
        "integer", "long", "double", "float", "decimal")]
    pairs = F.array(*[F.struct(F.lit(c).alias("metric"), dbl(c).alias("value")) for c in numeric])
    return df.select(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]).alias("key"), F.explode(pairs).alias("p")).select(
        F.lit(module).alias("module"), F.lit(output).alias("output"), "key", "p.metric", "p.value")


#: The columns that the modules of ``snapshot_modules`` read.
MODULE_COLUMNS = {
    "campaigns": ("channel", "date", "spend", "impressions", "clicks", "conversions", "revenue"),
    "customers": ("customer_id", "acquisition_channel", "acquisition_date", "subscription_plan"),
    "transactions": ("transaction_id", "customer_id", "transaction_date", "amount", "profit", "refund_flag"),
    "ab_test": ("variant", "date", "impressions", "clicks", "conversions", "revenue", "spend"),
}


def stored(bundle, columns: dict) -> SavedBundle:
    """The bundle over columns of its clean tables, written once to the shared folder, so that modules
    don't derive and clean the tables again and again."""
    folder = f"{ensure_checkpoint_dir(bundle.spark).rstrip('/')}/clean-{uuid.uuid4().hex}"
    tables = {n: df.select(*columns[n]) for n, df in bundle.tables.items()}
    for name, df in tables.items():
        df.write.parquet(f"{folder}/{name}")
    return SavedBundle(raw={n: bundle.spark.read.schema(df.schema).parquet(f"{folder}/{n}") for n, df in tables.items()},
                       params=bundle.params)


def snapshot_modules(bundle, params: AnalysisParams = DEFAULTS) -> DataFrame:
    """The numbers of every module that can run, one row per (module, output, key, metric), with
    the closed-form forecast methods."""
    from adpulse.operators import customers as cu
    from adpulse.operators import finance as fi
    from adpulse.operators import marketing as mk
    from adpulse.operators.experiments import ab_test
    from adpulse.operators.forecast import monthly_series, select_and_forecast, trend_diagnostics
    bundle = stored(bundle, MODULE_COLUMNS)
    c, cs, t = bundle.campaigns, bundle.customers, bundle.transactions
    parts = []
    if c is not None:
        series = monthly_series(c, params)
        closed = params.replace(forecast_methods=("moving_average", "linear_trend"))
        parts += [_melted(mk.groupby_kpis(c, "channel"), "marketing", "by_channel", ("channel",)),
                  _melted(mk.seasonality(c, params), "marketing", "seasonality", ()),
                  _melted(select_and_forecast(series, closed), "forecast", "months", ("method", "step")),
                  _melted(trend_diagnostics(series, with_p_value=False), "forecast", "trend", ())]
    if cs is not None and t is not None:
        counts = cu.cohort_counts(cu.cohort_activity(t, cs, params), cs, params, rounded=False)
        parts += [_melted(cu.segment_summary(cu.rfm_table(t, None, params, check=False)), "customers", "segments", ("segment",)),
                  _melted(cu.cohort_means(counts), "customers", "cohort_means", ()),
                  _melted(cu.value_by_plan(t, cs, params), "customers", "value_by_plan", ("subscription_plan",))]
    if c is not None and cs is not None and t is not None:
        profit = fi.customers_with_profit(cs, t, params)
        parts += [_melted(fi.headline_kpis(c, cs, t, params).drop("kpi_order"), "finance", "kpis", ("kpi",)),
                  _melted(fi.profitability(c, cs, profit), "finance", "profitability", ("channel",))]
    if bundle.ab_test is not None:
        parts.append(_melted(ab_test(bundle.ab_test, params, with_p_values=False), "experiments", "ab_test", ("experiment",)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    # five rows
    return out.join(F.broadcast(snapshot_status(bundle, params).where("status = 'ok'").select("module", "status")), "module")


def materialize(bundle, level=None):
    """Persist the bundle's clean tables once (MEMORY_AND_DISK) and count
    them, like the reference's load-and-clean at process start. Later module
    plans scan the persisted blocks; a lost executor's blocks are recomputed
    from lineage. Returns the row counts (one small job per table)."""
    from pyspark import StorageLevel
    level = level or StorageLevel.MEMORY_AND_DISK
    counts = {}
    for name in ("campaigns", "customers", "transactions", "ab_test"):
        if bundle.raw.get(name) is None:
            continue
        df = bundle.audit.clean[name].persist(level)
        bundle.audit.clean[name] = df
        counts[name] = df.count()
    return counts


def build_snapshot(bundle, params: AnalysisParams = DEFAULTS, parallel: int = 1) -> dict:
    """Every module of the dashboard at the bundle's cursor, as named
    DataFrames. All outputs are bounded (channels, segments, cohorts x
    months, horizon months, one row per KPI); per-customer tables stay
    inside the plans. The modules are independent, so with ``parallel > 1``
    they are planned from several driver threads (their eager steps, such as
    the rank checkpoints, then run as concurrent Spark jobs)."""
    from adpulse.operators import customers as cu
    from adpulse.operators import finance as fi
    from adpulse.operators import marketing as mk
    from adpulse.operators.experiments import ab_test
    from adpulse.operators.forecast import monthly_series, select_and_forecast, trend_diagnostics
    c, cs, t = bundle.campaigns, bundle.customers, bundle.transactions

    def status():
        return {"status": snapshot_status(bundle, params), "quality_report": bundle.audit.report,
                "quality_rows": bundle.audit.rows}

    def marketing():
        return {"funnel": mk.funnel(c), "stages": mk.funnel_stages(c),
                "by_dimension": mk.all_dimension_kpis(c), "leaderboard": mk.campaign_leaderboard(c),
                "seasonality": mk.seasonality(c, params)}

    def forecast():
        series = monthly_series(c, params)  # months only, checkpointed once
        return {"forecast": select_and_forecast(series, params), "trend": trend_diagnostics(series)}

    def customers():
        rfm = cu.rfm_table(t, None, params, check=False)
        act = cu.cohort_activity(t, cs, params).persist()
        return {"segments": cu.segment_summary(rfm), "cohorts": cu.cohort_counts(act, cs, params),
                "cohort_means": cu.cohort_means(cu.cohort_counts(act, cs, params, rounded=False)),
                "retention_by_channel": cu.retention_by_channel(act, cs, params),
                "value_by_plan": cu.value_by_plan(t, cs, params)}

    def finance():
        cp = fi.customers_with_profit(cs, t, params).persist()
        table = fi.profit_table(c, cs, cp)
        return {"kpis": fi.headline_kpis(c, cs, t, params), "profitability": fi.profitability(c, cs, cp),
                "cac_ltv": fi.cac_ltv_by_channel(c, cs, cp, params),
                "reallocation": fi.reallocation_summary(table, params),
                "reallocation_plan": fi.reallocation_plan(table, params)}

    def experiments():
        return {"experiments": ab_test(bundle.ab_test, params)}

    builders = [status]
    if c is not None:
        builders += [marketing, forecast]
    if cs is not None and t is not None:
        builders.append(customers)
    if c is not None and cs is not None and t is not None:
        builders.append(finance)
    if bundle.ab_test is not None:
        builders.append(experiments)
    out: dict = {}
    if parallel > 1:
        from concurrent.futures import ThreadPoolExecutor
        with ThreadPoolExecutor(max_workers=parallel) as pool:
            for part in pool.map(lambda f: f(), builders):
                out.update(part)
    else:
        for f in builders:
            out.update(f())
    return out


def collect_snapshot(snapshot: dict, parallel: int = 8) -> dict:
    """Materialise the (bounded) snapshot tables. The modules are independent
    jobs, so they are submitted from several driver threads and Spark runs
    them concurrently instead of one after another."""
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        futures = {name: pool.submit(df.collect) for name, df in snapshot.items()}
        return {name: f.result() for name, f in futures.items()}
