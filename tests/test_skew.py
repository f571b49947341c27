"""One customer holds a third of all transactions (and one orphan id holds a
large share of the orphans): results must equal brute force, with no row
dropped or capped to escape the skew."""
import datetime as dt
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest

from adpulse.operators import customers as cu
from adpulse.operators.quality import audit
from adpulse.plans import sqlcorpus as S
from tests.test_edges import CUST_SCHEMA, TX_SCHEMA


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(11)
    n_cust, n_tx = 60, 3000
    cust = [(i, ["Email", "TikTok", "Organic"][i % 3], dt.date(2024, 1 + i % 3, 1 + i % 20), None, "a", "b",
             ["Free", "Basic"][i % 2], Decimal("1.00")) for i in range(1, n_cust + 1)]
    ids = rng.integers(1, n_cust + 1, n_tx)
    ids[: n_tx // 3] = 1                      # the hot customer: a third of all rows
    ids[n_tx // 3: n_tx // 3 + 200] = 999     # a hot orphan id
    days = rng.integers(0, 300, n_tx)
    tx = [(k, int(c), dt.date(2024, 1, 1) + dt.timedelta(days=int(d)), "x",
           Decimal(f"{rng.integers(100, 10000) / 100:.2f}"), 0.0, Decimal("1.000000"), bool(k % 7 == 0))
          for k, (c, d) in enumerate(zip(ids, days))]
    c = spark.createDataFrame(cust, CUST_SCHEMA)
    t = spark.createDataFrame(tx, TX_SCHEMA)
    return c, t, pd.DataFrame(cust, columns=[f.split()[0] for f in CUST_SCHEMA.split(", ")]), \
        pd.DataFrame(tx, columns=[f.split()[0] for f in TX_SCHEMA.split(", ")])


def test_audit_keeps_every_row_under_skew(spark, skewed):
    c, t, pc, pt = skewed
    res = audit({"customers": c, "transactions": t})
    rep = {r.key: r.issue_count for r in res.report.collect()}
    exp_orphans = int((~pt["customer_id"].isin(pc["customer_id"])).sum())
    assert rep["orphan_transactions"] == exp_orphans == 200
    assert res.clean["transactions"].count() == len(pt) - exp_orphans


def test_cohorts_equal_brute_force_under_skew(spark, skewed):
    c, t, pc, pt = skewed
    clean = t.filter("customer_id <> 999")
    counts = cu.cohort_counts(cu.cohort_activity(clean, c), c).toPandas()
    p = pt[(pt.customer_id != 999) & (~pt.refund_flag)].merge(pc, on="customer_id")
    p["k"] = (pd.to_datetime(p.transaction_date).dt.to_period("M").astype("int64")
              - pd.to_datetime(p.acquisition_date).dt.to_period("M").astype("int64"))
    p = p[p.k.between(0, 11)]
    p["cohort"] = pd.to_datetime(p.acquisition_date).dt.to_period("M").dt.to_timestamp().dt.date
    exp = p.groupby(["cohort", "k"])["customer_id"].nunique()
    sizes = pc.assign(cohort=pd.to_datetime(pc.acquisition_date).dt.to_period("M").dt.to_timestamp().dt.date) \
        .groupby("cohort").size()
    exp = {key: v for key, v in exp.items() if sizes[key[0]] >= 20}
    got = {(r.cohort, r.months_since_acquisition): r.active_customers for r in counts.itertuples()}
    assert got == exp


def test_rfm_frequency_scores_equal_qcut_of_rank_under_skew(spark, skewed):
    c, t, pc, pt = skewed
    clean = t.filter("customer_id <> 999")
    rfm = cu.rfm_table(clean, None).toPandas().sort_values("customer_id")
    p = pt[(pt.customer_id != 999) & (~pt.refund_flag)].groupby("customer_id").agg(
        frequency=("transaction_id", "count"), monetary=("amount", "sum")).reset_index()
    f = pd.qcut(p["frequency"].rank(method="first"), 5, labels=[1, 2, 3, 4, 5]).astype(int)
    m = pd.qcut(p["monetary"].astype(float).rank(method="first"), 5, labels=[1, 2, 3, 4, 5]).astype(int)
    assert rfm["F_score"].tolist() == f.tolist()
    assert rfm["M_score"].tolist() == m.tolist()
    assert int(rfm.loc[rfm.customer_id == 1, "frequency"].iloc[0]) == int(p.loc[p.customer_id == 1, "frequency"].iloc[0])


def test_power_users_and_orphans_under_skew(spark, skewed):
    c, t, pc, pt = skewed
    pu = {r.customer_id: r.purchase_count for r in S.s16_power_users(c, t).collect()}
    exp = pt[pt.customer_id.isin(pc.customer_id)].groupby("customer_id").size()
    assert pu == {k: v for k, v in exp.items() if v > 5}
    assert S.s21_orphans(t, c).count() == 200
