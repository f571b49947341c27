"""Segments and cohorts per cursor and bounded selection against brute force."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from adpulse.operators import customers as cu
from adpulse.operators.selection import kth_keys, order_digits
from adpulse.plans import replay as R
from adpulse.sources.bundle import Bundle


@pytest.mark.parametrize("width", [4, 1 << 12])
def test_kth_keys_per_tick(spark, width):
    r = random.Random(width)
    rows = []
    for _ in range(600):
        a = r.randint(0, 6)
        rows.append((r.choice([1, 1, 1, 2, 3, 50, -7]), r.choice([None, "", "a", "ab", "b" * 9, "b" * 9 + "c", "é", "z\x00"]),
                     a, a + r.randint(1, 4)))
    df = spark.createDataFrame(rows, "v bigint, id string, a int, b int")
    digits = order_digits(df, "id")
    df = df.select("v", "a", "b", "id", *[d.alias(f"id{i}") for i, d in enumerate(digits)])
    order = [f"id{i}" for i in range(len(digits))]
    code = {x.id: tuple(x)[4:] for x in df.collect()}
    queries, want = [], {}
    for t in range(9):
        alive = sorted((v, code[i]) for v, i, a, b in rows if a <= t < b)
        for j, m in enumerate(sorted({1, len(alive) // 3, len(alive)} - {0})):
            if m <= len(alive):
                queries.append((t, j, m))
                want[t, j] = (alive[m - 1][0], *alive[m - 1][1])
    assert kth_keys(df, ["v", *order], queries, 9, "a", "b", width=width) == want
    texts = sorted((i for i in code if i is not None), key=lambda s: s.encode())
    assert sorted(texts, key=lambda s: code[s]) == texts and all(code[None] < code[s] for s in texts)


def test_kth_keys_of_decimals_and_no_queries(spark):
    df = spark.createDataFrame([(Decimal(i),) for i in (3, -2, 10**20, -10**20, 0)], "i decimal(30,0)").select(
        (F.col("i") / 100).cast("decimal(30,2)").alias("m"))
    names = [f"d{i}" for i, _ in enumerate(order_digits(df, "m"))]
    keyed = df.select("m", *[d.alias(n) for d, n in zip(order_digits(df, "m"), names)])
    by = {tuple(x)[1:]: x.m for x in keyed.collect()}
    found = kth_keys(keyed, names, [(0, m, m) for m in range(1, 6)], width=8)
    assert [by[found[0, m]] for m in range(1, 6)] == sorted(by.values())
    assert kth_keys(keyed, names, []) == {}


def make_bundle(spark, r, customers=90, days=260, heavy=0.3):
    day0 = dt.date(2021, 1, 4)
    cust = [(i, "Email", day0 + dt.timedelta(r.randint(0, days)) if i % 9 else None) for i in range(customers)]
    tx = []
    for k in range(900):
        c = 0 if r.random() < heavy else r.randint(1, customers - 1)
        tx.append((k, c, day0 + dt.timedelta(int(days * r.random() ** 0.7)), round(r.uniform(1, 90), 2), r.random() < 0.1))
    t = spark.createDataFrame(tx, "transaction_id bigint, customer_id bigint, transaction_date date, amount double, refund_flag boolean")
    t = t.select("transaction_id", "customer_id", "transaction_date", F.col("amount").cast("decimal(12,2)").alias("amount"),
                 F.lit("x").alias("product_category"), F.lit(0.0).cast("decimal(12,2)").alias("discount"),
                 F.lit(1.0).cast("decimal(12,2)").alias("profit"), "refund_flag")
    c = spark.createDataFrame(cust, "customer_id bigint, acquisition_channel string, acquisition_date date").select(
        "*", F.lit("Basic").alias("subscription_plan"), F.lit("a").alias("age_group"))
    camp = spark.createDataFrame([(day0, 1.0, 1.0, 1, 1, 1)], "date date, revenue double, spend double, impressions int, clicks int, conversions int")

    class Plain(Bundle):
        campaigns, customers, transactions = camp, c, t
    return Plain(raw={"campaigns": camp, "customers": c, "transactions": t}), cust, tx, day0


def cursors(cust, tx, day0):
    dates = [day0, *[a for *_, a in cust if a], *[x[2] for x in tx]]
    lo, hi = min(dates), max(dates)
    total = max(1, -(-(hi - lo).days // 7))
    return [(k, min(lo + dt.timedelta(7 * k), hi)) for k in range(total + 1)]


def test_segments_at_every_cursor_equal_a_table_computed_for_it(spark):
    bundle, cust, tx, day0 = make_bundle(spark, random.Random(4))
    got = {(x.tick, x.segment): x for x in R.replay_segments(bundle).collect()}
    some, seen = random.Random(1).sample(cursors(cust, tx, day0), 7), set()
    for tick, cursor in some + cursors(cust, tx, day0)[-1:]:
        cut = bundle.transactions.where(F.col("transaction_date") <= F.lit(cursor))
        if len({x[1] for x in tx if x[2] <= cursor and not x[4]}) < 20:
            assert not any(t == tick for t, _ in got)
            continue
        want = cu.segment_summary(cu.rfm_table(cut, None, bundle.params, as_of=cursor)).collect()
        assert {s for t, s in got if t == tick} == {w.segment for w in want}
        for w in want:
            x = got[tick, w.segment]
            seen.add(w.segment)
            assert (x.cursor, x.customers) == (cursor, w.customers)
            for c in ("avg_recency_days", "avg_frequency", "avg_monetary", "pct_of_base"):
                assert abs(x[c] - w[c]) < 2e-6
    assert len(seen) >= 4


def test_cohorts_at_every_cursor(spark):
    bundle, cust, tx, day0 = make_bundle(spark, random.Random(6), customers=320)
    got = {(x.tick, x.cohort, x.months_since_acquisition): (x.active_customers, x.cohort_size) for x in R.replay_cohorts(bundle).collect()}
    want = {}
    acquired = {c: a for c, _, a in cust if a}
    month = lambda d: d.year * 12 + d.month - 1
    for tick, cursor in cursors(cust, tx, day0):
        size, active = {}, {}
        for c, a in acquired.items():
            if a <= cursor:
                size[month(a)] = size.get(month(a), 0) + 1
        for _, c, d, _, refund in tx:
            if not refund and d <= cursor and c in acquired and acquired[c] <= cursor and 0 <= month(d) - month(acquired[c]) <= 11:
                active.setdefault((month(acquired[c]), month(d) - month(acquired[c])), set()).add(c)
        for (m, k), who in active.items():
            if size[m] >= 20:
                want[tick, dt.date(m // 12, m % 12 + 1, 1), k] = (len(who), size[m])
    assert got == want and want


def test_rfm_scores_leave_nothing_stored(spark):
    bundle, *_ = make_bundle(spark, random.Random(2))
    out = cu.rfm_table(bundle.transactions, None, bundle.params)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "InMemoryRelation" not in plan and "LogicalRDD" not in plan.split("Aggregate")[0] and "Sort" not in plan
