"""Forecasts of many revenue series with rolling origins (T5, T7 at scale).

The series are grouping sets of one aggregation: all campaigns together, each
channel, each country, each campaign, as monthly revenue over the same months
(zero where a series has none). The linear trend up to any month follows from
running sums of whole numbers, so one window per series gives every origin's
predictions and errors, exactly: nothing is fitted again per origin, and no task holds more than the months
of its series.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from adpulse.functions.kpis import dbl, round6
from adpulse.operators.forecast import METHOD_LABELS, MIN_TREND_POINTS
from adpulse.params import DEFAULTS, AnalysisParams

#: Closed-form methods, in the order that breaks ties.
METHODS = ("moving_average", "linear_trend")
KEYS = ["kind", "series"]
#: Predictions and errors are whole numbers of 10^-6.
UNIT = 1e6


def revenue_series(campaigns: DataFrame, params: AnalysisParams = DEFAULTS) -> DataFrame:
    """(kind, series, month, y, idx, n): monthly revenue per series over all complete months."""
    rows = campaigns.filter(F.col("date").isNotNull()).select(
        F.trunc("date", "MM").alias("month"), "date", "channel", "country", "campaign_id", "revenue")
    bounds = rows.agg(F.min("month").alias("lo"), F.max("date").alias("hi"))
    last = F.trunc("hi", "MM")
    if params.drop_partial_trailing_month:
        last = F.when(F.col("hi") == F.last_day("hi"), last).otherwise(F.add_months(last, -1))
    months = bounds.filter(F.col("lo") <= last).select(F.sequence("lo", last, F.expr("interval 1 month")))
    dims = ["channel", "country", "campaign_id"]
    by = rows.groupingSets([["month"], *[["month", d] for d in dims]], "month", *dims).agg(
        F.sum("revenue").alias("y"), F.grouping_id().alias("g"))
    # grouping ids name the columns left out: month, channel, country, campaign
    kind = F.when(F.col("g") == 7, "total").when(F.col("g") == 3, "channel").when(F.col("g") == 5, "country").otherwise("campaign")
    name = (F.when(F.col("g") == 7, "all").when(F.col("g") == 3, F.col("channel"))
            .when(F.col("g") == 5, F.col("country")).otherwise(F.col("campaign_id")))
    by = by.select(kind.alias("kind"), name.alias("series"), "month", F.col("y").cast("decimal(28,4)").alias("y")).filter(
        F.col("series").isNotNull())
    w = Window.partitionBy(*KEYS).orderBy("month")
    calendar = F.col("months")
    spread = (by.groupBy(*KEYS).agg(F.map_from_entries(F.collect_list(F.struct("month", "y"))).alias("by_month"))
              .withColumn("months", months.scalar()).select(*KEYS, "by_month", F.explode(calendar).alias("month")))
    return spread.select(*KEYS, "month", F.coalesce(F.col("by_month")[F.col("month")], F.lit(0)).cast("decimal(28,4)").alias("y"),
                         (F.row_number().over(w) - 1).alias("idx"),
                         F.count(F.lit(1)).over(Window.partitionBy(*KEYS)).alias("n"))


def _whole(c: Column) -> Column:
    return c.cast("decimal(38,0)")


def _micro(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` (revenue in units of 10^-4) in units of 10^-6, rounded half away
    from zero: whole numbers throughout, so that no order of floating operations decides a digit."""
    size = F.call_function("div", _whole(F.abs(numerator) * 200 + denominator), _whole(denominator * 2))
    return F.when(denominator > 0, F.when(numerator < 0, -size).otherwise(size))


def _trend(k: Column, sy: Column, sxy: Column, x: Column) -> Column:
    """The least-squares line through the points 0 .. k-1, at ``x``."""
    sx = _whole(F.floor(k * (k - 1) / 2))
    spread = _whole(k) * _whole(F.floor(k * (k - 1) * (k * 2 - 1) / 6)) - sx * sx
    rise = _whole(_whole(k) * sxy - sx * sy)
    return _micro(_whole(rise * (_whole(x) * k - sx) + sy * spread), _whole(spread * k))


def rolling_backtest(series: DataFrame, params: AnalysisParams = DEFAULTS) -> DataFrame:
    """T5 at every origin: for each number of training months the actuals of the months held out and
    each method's predictions (whole units of 10^-6), one row per (series, origin, step)."""
    h, w = params.holdout_months, Window.partitionBy(*KEYS).orderBy("idx")
    before, recent = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(-params.ma_window, -1)
    k, y = F.col("idx"), _whole(F.col("y") * 10000)
    held = F.array(*[F.struct(F.lit(s).alias("step"), F.lead("month", s - 1).over(w).alias("month"),
                              F.lead(y, s - 1).over(w).alias("actual")) for s in range(1, h + 1)])
    fits = series.select(*KEYS, "idx", "n", F.sum(y).over(before).alias("sy"), F.sum(_whole(k) * y).over(before).alias("sxy"),
                         F.sum(y).over(recent).alias("level"), F.count("y").over(recent).alias("months"), held.alias("held"))
    out = (fits.filter((k >= MIN_TREND_POINTS) & (k <= F.col("n") - h))
           .select(*KEYS, k.alias("k"), "sy", "sxy", "level", "months", F.explode("held").alias("e")))
    x = F.col("k") + F.col("e.step") - 1
    return out.select(*KEYS, F.col("k").cast("bigint").alias("train_months"), F.col("e.step").cast("bigint").alias("step"),
                      F.col("e.month").alias("month"), (F.col("e.actual") * 100).cast("bigint").alias("actual"),
                      _micro(F.col("level"), _whole(F.col("months"))).alias("moving_average"),
                      _trend(F.col("k"), F.col("sy"), F.col("sxy"), x).alias("linear_trend"))


def rolling_ranking(backtest: DataFrame) -> DataFrame:
    """Per series and method the errors over all origins and steps, and the rank by RMSE."""
    stacked = backtest.select(*KEYS, "train_months", F.explode(F.array(*[
        F.struct(F.lit(m).alias("method"), F.lit(i).alias("method_order"), _whole(F.col("actual") - F.col(m)).alias("error"))
        for i, m in enumerate(METHODS)])).alias("e")).select(*KEYS, "train_months", "e.*")
    errors = stacked.groupBy(*KEYS, "method", "method_order").agg(
        F.countDistinct("train_months").alias("origins"), F.count("error").alias("points"),
        F.sum(_whole(F.col("error") * F.col("error"))).alias("squares"), F.sum(F.abs("error")).alias("absolute"))
    w = Window.partitionBy(*KEYS).orderBy("squares", "method_order")  # as many points for every method
    return errors.select(*KEYS, "method", "origins", round6(F.sqrt(dbl("squares") / F.col("points")) / UNIT).alias("rmse"),
                         round6(dbl("absolute") / F.col("points") / UNIT).alias("mae"), F.row_number().over(w).alias("rank"))


def rolling_forecast(series: DataFrame, ranking: DataFrame, params: AnalysisParams = DEFAULTS) -> DataFrame:
    """T7 per series: the best method over all origins, refitted on the whole series, ``forecast_horizon``
    months ahead, with the history behind it and the total of exact and of cent-rounded months."""
    k, y, ma = F.col("n"), _whole(F.col("y") * 10000), params.ma_window
    sums = series.groupBy(*KEYS).agg(
        F.max("n").alias("n"), F.sum(y).alias("sy"), F.sum(_whole(F.col("idx")) * y).alias("sxy"), F.max("month").alias("last"),
        F.sum(F.when(F.col("idx") >= F.col("n") - ma, y)).alias("level"))
    labels = F.create_map(*[F.lit(x) for m in METHODS for x in (m, METHOD_LABELS[m])])
    x = (sums.join(ranking.filter(F.col("rank") == 1).select(*KEYS, "method"), KEYS)
         .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(params.forecast_horizon)))))
    pred = F.when(F.col("method") == "moving_average", _micro(F.col("level"), _whole(F.least(k, F.lit(ma))))).otherwise(
        _trend(k, F.col("sy"), F.col("sxy"), k + F.col("step") - 1))
    whole = Window.partitionBy(*KEYS)  # forecast_horizon rows
    x = x.withColumn("pred", pred)
    cents = F.round(F.col("pred").cast("decimal(20,0)") / F.lit(10000).cast("decimal(5,0)"), 0)
    return x.select(*KEYS, "method", labels[F.col("method")].alias("label"), F.col("step").cast("bigint").alias("step"),
                    F.add_months("last", F.col("step")).alias("month"), (F.col("pred") / UNIT).alias("forecast_revenue"),
                    (F.sum("pred").over(whole) / UNIT).alias("total"),
                    dbl(F.sum(cents).over(whole) / 100).alias("total_of_rounded_months"),
                    k.cast("bigint").alias("history_months"), F.col("last").alias("last_actual_month"))
