"""Tail probabilities as Column expressions; channels and customers with NULLs."""

import math
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from adpulse.functions import tails as T
from adpulse.operators import finance as fi


def simpson(f, a, b, n=20000):
    x = np.linspace(a, b, n + 1)
    y = f(x)
    return (b - a) / (3 * n) * (y[0] + y[-1] + 4 * y[1:-1:2].sum() + 2 * y[2:-1:2].sum())


def density(df):
    scale = math.exp(math.lgamma((df + 1) / 2) - math.lgamma(df / 2)) / math.sqrt(df * math.pi)
    return lambda u: scale * (1 + u * u / df) ** (-(df + 1) / 2)


def test_tails_match_numeric_integration(spark):
    cases = [(t, df) for t in (-6.5, -1.3, 0.0, 1e-8, 0.4, 1.96, 4.5, 9.0) for df in (1.0, 2.5, 7.0, 57.3, 3000.0)]
    got = spark.createDataFrame(cases, "t double, df double").select(
        "t", "df", T.normal_sf(F.col("t")).alias("z"), T.student_sf(F.col("t"), F.col("df")).alias("s"),
        T.student_two_sided(F.col("t"), F.col("df")).alias("two"), T.log_gamma(F.col("df")).alias("g")).collect()
    for r in got:
        assert abs(r.z - 0.5 * math.erfc(r.t / math.sqrt(2))) < 1e-14
        assert abs(r.s - (0.5 - simpson(density(r.df), 0, r.t))) < 1e-9
        assert abs(r.two - min(1.0, 2 * (r.s if r.t > 0 else 1 - r.s))) < 1e-12
        assert math.isclose(r.g, math.lgamma(r.df), rel_tol=1e-13, abs_tol=1e-13)


def test_far_and_undefined_tails(spark):
    got = spark.createDataFrame([(60.0, 5.0), (-60.0, 1e5), (None, 3.0), (1.0, None), (1.0, 0.0), (1e200, 4.0)], "t double, df double").select(
        T.normal_sf(F.col("t")).alias("z"), T.student_sf(F.col("t"), F.col("df")).alias("s")).collect()
    assert got[0].z < 1e-15 and 0 < got[0].s < 1e-6 and got[1].z > 1 - 1e-15 and got[1].s > 1 - 1e-12
    assert got[2].z is None and [r.s for r in got[2:5]] == [None] * 3


def test_no_python_in_the_plans(spark):
    import __spark_entry__ as E
    for name in ("e3_ab_test", "t6_trend_p_value"):
        plan = E.queries()[name](spark, E.SMOKE_DIR)._jdf.queryExecution().optimizedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan


@pytest.fixture()
def sides(spark):
    day = date(2021, 1, 1)
    camp = spark.createDataFrame([(day, "Email", 10.0, 40.0), (day, None, 5.0, 9.0), (day, "SMS", 3.0, 2.0)],
                                 "date date, channel string, spend double, revenue double")
    cust = spark.createDataFrame([(1, "Email"), (2, None), (3, "Organic")], "customer_id bigint, acquisition_channel string")
    profit = cust.withColumn("lifetime_profit", F.col("customer_id") * 1000.0)
    return camp, cust, profit


def test_profitability_has_no_channel_without_a_name(sides):
    got = {r.channel: (r.profit_rank, r.net_profit) for r in fi.profitability(*sides).collect()}
    assert set(got) == {"Email", "SMS", "Organic"} and got["Email"] == (1, 990.0)
    assert {r.channel for r in fi.channel_net_profit_inner(sides[0], sides[2]).collect()} == {"Email"}


def test_examples_are_limited_in_the_tasks(spark):
    import __spark_entry__ as E
    df = E.queries()["q_examples"](spark, E.SMOKE_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 3 and "TakeOrdered" not in plan
    types = dict(df.dtypes)
    assert types["spend"] == "double" and types["transaction_date"] == "date" and types["refund_flag"] == "boolean"
