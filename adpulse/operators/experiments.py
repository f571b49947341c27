"""A/B test analysis (E1 .. E7), generalised to many experiments.

Everything is grouped by an experiment key, so a table holding thousands of
experiments is one Spark job: per-(experiment, variant) sums and per-day
conversion-rate moments in two aggregations, pivoted by conditional
aggregation to one row per experiment. Tail probabilities are Column
expressions over that row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adpulse.functions.kpis import dbl, r6, round6, safe_div
from adpulse.functions.tails import normal_sf, student_sf
from adpulse.params import DEFAULTS, AnalysisParams

CONTROL, TREATMENT = "A", "B"
# Fixed value: two-sided 95% normal quantile used by the Wald interval.
Z_975 = 1.959963984540054


def _with_experiment(ab: DataFrame, experiment_col: str | None) -> DataFrame:
    if experiment_col is None:
        return ab.withColumn("experiment", F.lit("ab_test"))
    return ab.withColumnRenamed(experiment_col, "experiment")


def variant_summary(ab: DataFrame, experiment_col: str | None = None) -> DataFrame:
    """Sums, cvr and roas per (experiment, variant)."""
    a = _with_experiment(ab, experiment_col)
    g = a.groupBy("experiment", "variant").agg(
        F.sum("impressions").alias("impressions"), F.sum("clicks").alias("clicks"),
        F.sum("conversions").alias("conversions"), F.sum("revenue").alias("revenue"),
        F.sum("spend").alias("spend"))
    return g.select("experiment", "variant", F.col("impressions").cast("bigint").alias("impressions"),
                    F.col("clicks").cast("bigint").alias("clicks"),
                    F.col("conversions").cast("bigint").alias("conversions"),
                    r6("revenue").alias("revenue"), r6("spend").alias("spend"),
                    r6(safe_div("conversions", "clicks")).alias("cvr"),
                    r6(safe_div("revenue", "spend")).alias("roas"))


def _stats(ab: DataFrame, experiment_col: str | None) -> DataFrame:
    """Per experiment, in ONE aggregation: variant sums and the moments of
    the daily conversion rate (days without clicks have no rate; count, avg
    and var_samp skip those NULLs)."""
    a = _with_experiment(ab, experiment_col).withColumn("r", safe_div("conversions", "clicks"))
    is_a, is_b = F.col("variant") == CONTROL, F.col("variant") == TREATMENT
    return a.groupBy("experiment").agg(
        *[F.sum(F.when(v, F.col(c))).alias(f"{c}_{s}")
          for s, v in (("a", is_a), ("b", is_b))
          for c in ("clicks", "conversions", "revenue", "spend")],
        *[e for s, v in (("a", is_a), ("b", is_b)) for e in (
            F.count(F.when(v, F.col("r"))).alias(f"n_{s}"),
            F.avg(F.when(v, F.col("r"))).alias(f"mean_{s}"),
            F.var_samp(F.when(v, F.col("r"))).alias(f"var_{s}"))])


def ab_test(ab: DataFrame, params: AnalysisParams = DEFAULTS, experiment_col: str | None = None,
            with_p_values: bool = True) -> DataFrame:
    """Lift, pooled one-sided z-test (B larger), 95% Wald interval of
    the difference, Welch t-test on daily cvr, significance and the rollout
    projection. ``status`` is 'insufficient_data' unless both variants have
    clicks."""
    s = _stats(ab, experiment_col)
    ca, cb = dbl("conversions_a"), dbl("conversions_b")
    na, nb = dbl("clicks_a"), dbl("clicks_b")
    ok = (na > 0) & (nb > 0)
    pa, pb = F.try_divide(ca, na), F.try_divide(cb, nb)
    pool = F.try_divide(ca + cb, na + nb)
    z = F.try_divide(pb - pa, F.sqrt(pool * (F.lit(1.0) - pool) * (F.lit(1.0) / nb + F.lit(1.0) / na)))
    se = F.sqrt(pb * (F.lit(1.0) - pb) / nb + pa * (F.lit(1.0) - pa) / na)
    diff = pb - pa
    va, vb = F.col("var_a") / F.col("n_a"), F.col("var_b") / F.col("n_b")
    enough = (F.col("n_a") >= 2) & (F.col("n_b") >= 2)
    t = F.when(enough, F.try_divide(F.col("mean_b") - F.col("mean_a"), F.sqrt(va + vb)))
    df = F.when(enough, F.try_divide((va + vb) * (va + vb),
                                     va * va / (F.col("n_a") - 1) + vb * vb / (F.col("n_b") - 1)))
    cpc_a = F.try_divide(dbl("spend_a"), na)
    avail = cpc_a.isNotNull() & (cpc_a != 0)
    projected = F.when(avail, F.try_divide(dbl("spend_a"), cpc_a) * pb)
    incremental = projected - ca
    rev_per_conv = F.try_divide(dbl("revenue_b"), cb)
    out = s.select(
        "experiment",
        F.when(ok, "ok").otherwise("insufficient_data").alias("status"),
        F.when(ok, round6(pa)).alias("cvr_a"), F.when(ok, round6(pb)).alias("cvr_b"),
        F.when(ok, round6(F.try_divide(pb - pa, pa))).alias("lift_pct"),
        F.when(ok, z).alias("_z"),
        F.when(ok, round6(z)).alias("z_stat"),
        F.when(ok, round6(diff - F.lit(Z_975) * se)).alias("ci_low"),
        F.when(ok, round6(diff + F.lit(Z_975) * se)).alias("ci_high"),
        F.when(ok, (diff - F.lit(Z_975) * se) > 0).alias("ci_excludes_zero"),
        F.when(ok, t).alias("_t"), F.when(ok, df).alias("_df"),
        F.when(ok, round6(t)).alias("t_stat"), F.when(ok, round6(df)).alias("welch_df"),
        F.when(ok, F.least(F.coalesce(F.col("n_a"), F.lit(0)), F.coalesce(F.col("n_b"), F.lit(0))))
         .cast("bigint").alias("n_days"),
        F.when(ok, avail).alias("projection_available"),
        F.when(ok, ca).alias("current_conversions"),
        F.when(ok, round6(projected)).alias("projected_conversions"),
        F.when(ok, round6(incremental)).alias("incremental_conversions"),
        F.when(ok, round6(incremental * rev_per_conv)).alias("incremental_revenue"),
    )
    if not with_p_values:
        return out.drop("_z", "_t", "_df")
    p_t = student_sf(F.col("_t"), F.col("_df"))
    return (out.withColumn("p_value_z", round6(normal_sf(F.col("_z"))))
            .withColumn("p_value_t", p_t)
            .withColumn("alpha", F.lit(params.alpha))
            .withColumn("significant", F.coalesce(F.col("p_value_t") < F.lit(params.alpha), F.lit(False)))
            .withColumn("p_value_t", round6(F.col("p_value_t")))
            .drop("_z", "_t", "_df"))
