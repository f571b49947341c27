"""Revenue forecasting per series (T1 .. T7).

Input is a long table (series, month, y). Moving average and linear trend
are closed-form aggregates per series (exact DECIMAL sums, one division at
the end); ARIMA(1,1,1) is fitted per series in ``applyInPandas`` by
conditional sum of squares. The reference's single revenue series is one
group; many series (e.g. per channel) are just more groups.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from adpulse.functions.kpis import dbl, round6
from adpulse.functions.tails import student_two_sided
from adpulse.params import DEFAULTS, AnalysisParams

# Method labels and minimum history per method.
METHOD_LABELS = {"moving_average": "Moving Average", "linear_trend": "Linear Trend",
                 "arima": "ARIMA(1,1,1)"}
MIN_TREND_POINTS = 3
# Fixed value: what a report says beside a trend that may be noise.
TREND_CAVEAT = ("The fitted trend is not statistically distinguishable from zero; "
                "treat the projection as a level estimate, not a direction.")
MIN_ARIMA_POINTS = 8


def monthly_series(campaigns: DataFrame, params: AnalysisParams = DEFAULTS,
                   series: str = "campaign_revenue", cut_lineage: bool = True) -> DataFrame:
    """Monthly revenue (zero-filled, partial trailing month dropped) as
    (series, month, y DECIMAL, idx 0..n-1, n). The index window runs per
    series over at most a calendar's worth of months.

    The backtest and the refit read this series in many branches; with
    ``cut_lineage`` it is computed once and checkpointed (reliably, to
    ``spark.checkpoint.dir``; it is one row per month) so no branch
    re-derives the campaigns."""
    from adpulse.operators.marketing import monthly_revenue_exact
    from adpulse.session import ensure_checkpoint_dir
    m = monthly_revenue_exact(campaigns, params).withColumn("series", F.lit(series))
    w = Window.partitionBy("series").orderBy("month")
    out = (m.select("series", "month", F.col("revenue").alias("y"),
                    (F.row_number().over(w) - 1).alias("idx"))
           .withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("series"))))
    if cut_lineage:
        ensure_checkpoint_dir(out.sparkSession)
        out = out.checkpoint(eager=True)
    return out


def _linear_fit(points: DataFrame) -> DataFrame:
    """OLS of y on idx per series from exact sums: slope, intercept, n."""
    g = points.groupBy("series").agg(
        F.count(F.lit(1)).alias("k"), F.sum("idx").alias("sx"), F.sum(F.col("idx") * F.col("idx")).alias("sxx"),
        F.sum("y").alias("sy"), F.sum(F.col("idx") * F.col("y")).alias("sxy"),
        F.sum(dbl("y") * dbl("y")).alias("syy"))
    num = dbl(F.col("k") * F.col("sxy") - F.col("sx") * F.col("sy"))
    den = dbl(F.col("k") * F.col("sxx") - F.col("sx") * F.col("sx"))
    slope = F.try_divide(num, den)
    return g.select("series", "k", "sx", "sy", "sxx", "sxy", "syy", slope.alias("slope"),
                    F.try_divide(dbl("sy") - slope * dbl("sx"), dbl("k")).alias("intercept"))


def _ma_level(points: DataFrame, window: int) -> DataFrame:
    last = points.withColumn("_top", F.max("idx").over(Window.partitionBy("series")))
    return (last.filter(F.col("idx") > F.col("_top") - window).groupBy("series")
            .agg(F.try_divide(dbl(F.sum("y")), dbl(F.count(F.lit(1)))).alias("level")))


def _arima_css(y: np.ndarray, steps: int):
    """ARIMA(1,1,1) without constant by conditional sum of squares on the
    differenced series: grid search, then a finer grid around the best."""
    w = np.diff(np.asarray(y, dtype="float64"))
    if len(y) < MIN_ARIMA_POINTS or not np.all(np.isfinite(w)):
        return None

    def sse(phi, theta):
        e = np.zeros((len(w), phi.size))
        for t in range(1, len(w)):
            e[t] = w[t] - phi * w[t - 1] - theta * e[t - 1]
        return (e[1:] ** 2).sum(axis=0), e

    best = None
    for step, span in ((0.05, 0.95), (0.005, 0.05)):
        if best is None:
            grid = np.arange(-span, span + 1e-12, step)
        else:
            grid_p = np.arange(best[0] - span, best[0] + span + 1e-12, step)
            grid_t = np.arange(best[1] - span, best[1] + span + 1e-12, step)
        gp, gt = (np.meshgrid(grid, grid) if best is None else np.meshgrid(grid_p, grid_t))
        gp, gt = np.clip(gp.ravel(), -0.99, 0.99), np.clip(gt.ravel(), -0.99, 0.99)
        s, _ = sse(gp, gt)
        i = int(np.nanargmin(s))
        best = (gp[i], gt[i])
    phi, theta = np.array([best[0]]), np.array([best[1]])
    _, e = sse(phi, theta)
    last_w, last_e = w[-1], e[-1, 0]
    preds, level, nxt = [], float(y[-1]), phi[0] * w[-1] + theta[0] * last_e
    for _ in range(steps):
        level += nxt
        preds.append(level)
        nxt = phi[0] * nxt
    return np.array(preds)


def _arima_group(horizon_col: str):
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("idx")
        steps = int(pdf[horizon_col].iloc[0])
        pred = _arima_css(pdf["y"].astype("float64").to_numpy(), steps)
        series = pdf["series"].iloc[0]
        last = int(pdf["idx"].max())
        if pred is None:
            return pd.DataFrame({"series": [], "idx": [], "pred": []}).astype(
                {"series": "object", "idx": "int64", "pred": "float64"})
        return pd.DataFrame({"series": series, "idx": np.arange(last + 1, last + 1 + steps, dtype="int64"),
                             "pred": pred})
    return fn


def _predictions(train: DataFrame, method: str, steps_col: DataFrame, params: AnalysisParams) -> DataFrame:
    """(series, idx, pred) for the ``steps`` months after each training set.
    ``steps_col`` holds (series, steps, start) with start = first future idx."""
    if method == "moving_average":
        lv = _ma_level(train, params.ma_window)
        base = steps_col.join(lv, "series")
        return base.select("series", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("steps") - 1))
                           .alias("idx"), F.col("level").alias("pred"))
    if method == "linear_trend":
        fit = _linear_fit(train).filter(F.col("k") >= MIN_TREND_POINTS)
        base = steps_col.join(fit, "series")
        x = base.select("series", "slope", "intercept",
                        F.explode(F.sequence(F.col("start"), F.col("start") + F.col("steps") - 1)).alias("idx"))
        return x.select("series", "idx", (F.col("slope") * dbl("idx") + F.col("intercept")).alias("pred"))
    if method == "arima":
        from adpulse.session import ship_package
        ship_package(train.sparkSession)
        t = train.join(steps_col.select("series", "steps"), "series")
        return (t.select("series", "idx", dbl("y").alias("y"), "steps").groupBy("series")
                .applyInPandas(_arima_group("steps"), "series string, idx bigint, pred double"))
    raise ValueError(f"there is no forecast method named {method!r}")


def backtest(series: DataFrame, params: AnalysisParams = DEFAULTS) -> DataFrame:
    """Hold out the last ``holdout_months`` per series and rank each
    method by RMSE (ties: configured order). Methods that cannot run are
    reported with status 'skipped'."""
    h = params.holdout_months
    eligible = series.filter(F.col("n") >= h + MIN_TREND_POINTS)
    train = eligible.filter(F.col("idx") < F.col("n") - h)
    test = eligible.filter(F.col("idx") >= F.col("n") - h).select("series", "idx", dbl("y").alias("actual"))
    steps = eligible.groupBy("series").agg((F.max("n") - h).alias("start")).withColumn("steps", F.lit(h))
    parts = []
    for order, m in enumerate(params.forecast_methods):
        p = _predictions(train, m, steps, params)
        err = (test.join(p, ["series", "idx"])
               .groupBy("series").agg(F.sqrt(F.avg(F.pow(F.col("actual") - F.col("pred"), 2))).alias("rmse"),
                                      F.avg(F.abs(F.col("actual") - F.col("pred"))).alias("mae")))
        parts.append(steps.select("series").join(err, "series", "left")
                     .select("series", F.lit(m).alias("method"), F.lit(METHOD_LABELS[m]).alias("label"),
                             F.lit(order).alias("method_order"), "rmse", "mae"))
    res = parts[0]
    for p in parts[1:]:
        res = res.unionByName(p)
    w = Window.partitionBy("series").orderBy(F.col("rmse").asc_nulls_last(), "method_order")
    res = res.withColumn("rank", F.when(F.col("rmse").isNotNull(), F.row_number().over(w)))
    return res.select("series", "method", "label", "method_order",
                      F.when(F.col("rmse").isNotNull(), "ok").otherwise("skipped").alias("status"),
                      round6("rmse").alias("rmse"), round6("mae").alias("mae"), "rank",
                      F.lit(h).cast("bigint").alias("test_months"))


def trend_diagnostics(series: DataFrame, with_p_value: bool = True) -> DataFrame:
    """Slope, r^2, months until the fitted line reaches zero (when
    falling from a positive intercept) and the slope's two-sided p-value."""
    fit = _linear_fit(series).filter(F.col("k") >= MIN_TREND_POINTS)
    k = dbl("k")
    cov = dbl(F.col("k") * F.col("sxy") - F.col("sx") * F.col("sy"))
    vx = dbl(F.col("k") * F.col("sxx") - F.col("sx") * F.col("sx"))
    vy = dbl("k") * F.col("syy") - dbl("sy") * dbl("sy")
    r2 = F.try_divide(cov * cov, vx * vy)
    mz = F.when((F.col("slope") < 0) & (F.col("intercept") > 0),
                -F.col("intercept") / F.col("slope") - k)
    out = fit.select("series", F.col("k").cast("bigint").alias("n_months"),
                     round6("slope").alias("slope_per_month"), round6("intercept").alias("intercept"),
                     round6(r2).alias("r_squared"), round6(mz).alias("months_until_zero"),
                     r2.alias("_r2"), k.alias("_k"))
    if not with_p_value:
        return out.drop("_r2", "_k")
    tstat = F.try_divide(F.sqrt(F.col("_r2")) * F.sqrt(F.col("_k") - 2), F.sqrt(F.lit(1.0) - F.col("_r2")))
    p = student_two_sided(tstat, F.col("_k") - 2)
    return (out.withColumn("p_value", p)
            .withColumn("significant", F.coalesce(F.col("p_value") < 0.05, F.lit(False)))
            .withColumn("caveat", F.when(F.col("p_value") >= 0.05, F.lit(TREND_CAVEAT)))
            .withColumn("p_value", round6("p_value")).drop("_r2", "_k"))


def select_and_forecast(series: DataFrame, params: AnalysisParams = DEFAULTS) -> DataFrame:
    """The backtest winner per series, refitted on the full series and
    projected ``forecast_horizon`` months ahead (with the horizon total)."""
    bt = backtest(series, params).filter(F.col("rank") == 1).select("series", "method")
    hz = params.forecast_horizon
    steps = series.groupBy("series").agg(F.max("n").alias("start"), F.max("month").alias("last_month")) \
        .withColumn("steps", F.lit(hz))
    parts = []
    for m in params.forecast_methods:
        p = _predictions(series, m, steps.select("series", "start", "steps"), params)
        parts.append(p.withColumn("method", F.lit(m)))
    allp = parts[0]
    for p in parts[1:]:
        allp = allp.unionByName(p)
    chosen = allp.join(bt, ["series", "method"]).join(steps, "series")
    out = chosen.select("series", "method", F.lit(None).cast("string").alias("_"),
                        (F.col("idx") - F.col("start") + 1).alias("step"),
                        F.add_months(F.col("last_month"), (F.col("idx") - F.col("start") + 1).cast("int")).alias("month"),
                        F.col("pred").alias("_pred"))
    tot = Window.partitionBy("series")  # at most forecast_horizon rows per series
    return out.select("series", "method", F.col("step").cast("bigint").alias("step"), "month",
                      round6("_pred").alias("forecast_revenue"),
                      round6(F.sum("_pred").over(tot)).alias("total"))
