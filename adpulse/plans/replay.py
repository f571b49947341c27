"""Replay of the non-additive views (R3): segments and cohorts as of every cursor.

Nothing is recomputed per cursor. A customer's frequency, spend and last purchase
change only in ticks with a purchase, so the customers become intervals of ticks
with one state each, and every count per tick is a running sum of +1 / -1 events.
A row is never paired with more ticks than it changes in; whatever is held in one
task (ticks x days, ticks x ticks) is bounded by the calendar, not by the customers.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from adpulse.functions.kpis import month_ordinal, round6, safe_div
from adpulse.operators.customers import _ordinal_to_date, bin_ends, purchases, segment_expr
from adpulse.operators.selection import kth_keys, order_digits
from adpulse.plans.snapshot import DAYS_PER_TICK, _daily, _spine, _tick_of, replay_bounds
from adpulse.session import ensure_checkpoint_dir

#: Sums of a class besides the number of customers: last-purchase days, purchases, and cents.
WEIGHTS = ("n", "days", "orders", "cents")


def customer_states(transactions: DataFrame, start, total: int, include_refunds: bool) -> DataFrame:
    """One row per customer and tick with purchases: the ticks ``[begin, until)`` in which the state
    holds, the last purchase as a day number, the purchases and the cents so far."""
    ticks = (purchases(transactions, include_refunds).filter(F.col("customer_id").isNotNull())
             .groupBy("customer_id", _tick_of(F.col("transaction_date"), start, total).cast("int").alias("begin"))
             .agg(F.max(F.unix_date("transaction_date")).alias("day"), F.count("transaction_id").alias("n"),
                  F.sum("amount").alias("spent")))
    w = Window.partitionBy("customer_id").orderBy("begin")
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    return ticks.select("customer_id", "begin", F.coalesce(F.lead("begin").over(w), F.lit(total + 1)).alias("until"),
                        F.max("day").over(so_far).alias("day"), F.sum("n").over(so_far).alias("orders"),
                        F.round(F.sum("spent").over(so_far) * 100).cast("bigint").alias("cents"))


def _recency_ends(cursors: np.ndarray, bins: int):
    """Per tick: customers, and the last days that lie above each inner quantile edge of recency
    (the edges of all customers' recencies at that cursor, equal ones dropped)."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        day, at = np.unique(rows["day"].to_numpy(np.int64), return_inverse=True)
        alive = np.zeros((len(day), len(cursors)), np.int64)
        np.add.at(alive, (at, rows["tick"].to_numpy(np.int64)), rows["n"].to_numpy(np.int64))
        newest = alive.cumsum(axis=1)[::-1].cumsum(axis=0)  # from the smallest recency on
        out = []
        for t, cursor in enumerate(cursors.tolist()):
            n = int(newest[-1, t])
            if n:
                recency = lambda i, t=t, cursor=cursor: cursor - int(day[::-1][np.searchsorted(newest[:, t], i, "right")])
                edges = []
                for k in range(bins + 1):
                    i, part = divmod(k * (n - 1), bins)
                    low = recency(i)
                    edge = low if not part else low + (recency(i + 1) - low) * part / bins
                    if not edges or edge > edges[-1]:
                        edges.append(edge)
                out.append((t, n, [cursor - int(np.floor(e)) - 1 for e in edges[1:-1]], max(len(edges) - 1, 1)))
        return pd.DataFrame(out, columns=["tick", "n", "ends", "r_bins"])
    return run


def _day_spans(ends: dict[int, list[int]], first: int, last: int, total: int) -> list[tuple[int, int, int, int]]:
    """``(hits, day, begin, until)``: the ticks in which a last purchase on ``day`` lies beyond at least
    ``hits`` inner edges; hits 0 is every tick."""
    out = [(0, d, 0, total + 1) for d in range(first, last + 1)]
    for h in range(1, max(map(len, ends.values()), default=0) + 1):
        reach = np.array([ends[t][h - 1] if t in ends and len(ends[t]) >= h else first - 1 for t in range(total + 1)])
        for d in range(first, last + 1):
            inside = np.flatnonzero(np.diff(np.concatenate(([0], (reach >= d).astype(np.int8), [0]))))
            out += [(h, d, int(a), int(b)) for a, b in zip(inside[::2], inside[1::2], strict=True)]
    return out


def _id_classes(bounds: dict[int, list[tuple]]):
    """Class of a state among the ids that end a bin at its number of purchases: how many lie below."""
    def run(batches):
        for rows in batches:
            ids = list(zip(*[rows[c] for c in rows.columns if c.startswith("id")], strict=True))
            rows["cls"] = [bisect_left(bounds.get(q, []), i) for q, i in zip(rows["orders"], ids, strict=True)]
            yield rows[["begin", "until", "day", "orders", "cls", "cents"]].astype(np.int64)
    return run


def _classes_per_tick(ends: dict[int, list[tuple[int, int]]], total: int):
    """For one number of purchases: sums per (tick, hits, F score)."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        orders = int(rows["key"].iloc[0])
        classes = int(rows["cls"].max()) + 1
        out = []
        score = {}
        for t, at in ends.items():
            score[t] = np.ones(classes, np.int64) + sum(q < orders for q, _ in at)
            for cls in (c for q, c in at if q == orders):
                score[t][cls + 1:] += 1
        top = 1 + max(map(len, ends.values()), default=0)
        for hits, part in rows.groupby("hits"):
            sums = []
            for name in WEIGHTS:  # one grid of classes x ticks at a time
                grid = np.zeros((classes, total + 1), np.int64)
                np.add.at(grid, (part["cls"].to_numpy(np.int64), part["tick"].to_numpy(np.int64)), part[name].to_numpy(np.int64))
                np.cumsum(grid, axis=1, out=grid)
                by_score = np.zeros((len(ends), top + 1), np.int64)
                for i, t in enumerate(ends):
                    np.add.at(by_score[i], score[t], grid[:, t])
                sums.append(by_score)
            i, f = np.nonzero(sums[0])
            ticks = np.fromiter(ends, np.int64, len(ends))
            out += zip(ticks[i].tolist(), [int(hits)] * len(i), f.tolist(), *[x[i, f].tolist() for x in sums], strict=True)
        return pd.DataFrame(out, columns=["tick", "hits", "f", *WEIGHTS])
    return run


def replay_segments(bundle) -> DataFrame:
    """Customers, share of the base and mean recency, frequency and spend per (tick, segment),
    scored against the customers of that cursor alone, for every cursor with enough of them."""
    p = bundle.params
    spark = bundle.transactions.sparkSession
    ensure_checkpoint_dir(spark)
    start, end, total = replay_bounds(_daily(bundle))
    spine = _spine(spark, start, end, total)
    states = customer_states(bundle.transactions, start, total, p.include_refunds_in_rfm)
    ids = order_digits(states, "customer_id")
    names = [f"id{i}" for i in range(len(ids))]
    states = states.select("begin", "until", "day", "orders", "cents",
                           *[d.alias(n) for d, n in zip(ids, names, strict=True)]).checkpoint()

    # recency: where the inner edges lie at each cursor (one row per tick)
    cursors = np.array([r[0] for r in spine.orderBy("tick").select(F.unix_date("cursor")).collect()], np.int64)
    spans = F.array(F.struct(F.col("begin").alias("tick"), F.lit(1).alias("n")),
                    F.struct(F.col("until").alias("tick"), F.lit(-1).alias("n")))
    by_day = (states.select("day", F.explode(spans).alias("e")).where(F.col("e.tick") <= total)
              .groupBy("day", F.col("e.tick").alias("tick")).agg(F.sum("e.n").alias("n")))
    schema = "tick int, n bigint, ends array<bigint>, r_bins int"
    # ticks x days: bounded by the calendar
    per_tick = by_day.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(_recency_ends(cursors, p.rfm_bins), schema).collect()
    per_tick = [r for r in per_tick if r.n >= p.min_rfm_customers]
    r_ends = {r.tick: list(r.ends) for r in per_tick}

    # frequency: the (purchases, id) that end the bins at each cursor (bins - 1 per tick)
    queries = [(r.tick, k, m) for r in per_tick for k, m in enumerate(bin_ends(r.n, p.rfm_bins))]
    keys = kth_keys(states, ["orders", *names], queries, total + 1, "begin", "until", width=1 << 10)
    at_orders: dict[int, list[tuple]] = {}
    for q, *key in sorted(set(keys.values())):
        at_orders.setdefault(q, []).append(tuple(key))
    f_ends = {r.tick: [(keys[r.tick, k][0], at_orders[keys[r.tick, k][0]].index(keys[r.tick, k][1:]))
                       for k in range(p.rfm_bins - 1)] for r in per_tick}

    cells = (states.mapInPandas(_id_classes(at_orders), "begin int, until int, day int, orders bigint, cls int, cents bigint")
             .groupBy("begin", "until", "day", "orders", "cls")
             .agg(F.count("*").alias("n"), F.sum("cents").alias("cents")))
    days = states.agg(F.min("day"), F.max("day")).first()
    table = _day_spans(r_ends, days[0], days[1], total) if days[0] is not None else []
    inside = spark.createDataFrame(table, "hits int, day int, a int, b int")
    event = F.array(F.struct(F.col("from_tick").alias("tick"), F.lit(1).alias("s")),
                    F.struct(F.col("to_tick").alias("tick"), F.lit(-1).alias("s")))
    events = (cells.join(F.broadcast(inside), "day")  # days x edges rows
              .select("hits", "orders", "cls", "day", "n", "cents", F.greatest("begin", "a").alias("from_tick"),
                      F.least("until", "b").alias("to_tick"))
              .where("from_tick < to_tick").withColumn("e", F.explode(event)).where(F.col("e.tick") <= total)
              .groupBy(F.col("orders").alias("key"), "hits", "cls", F.col("e.tick").alias("tick"))
              .agg(F.sum(F.col("e.s") * F.col("n")).alias("n"), F.sum(F.col("e.s") * F.col("n") * F.col("day")).alias("days"),
                   F.sum(F.col("e.s") * F.col("n") * F.col("orders")).alias("orders"),
                   F.sum(F.col("e.s") * F.col("cents")).alias("cents")))
    sums = ", ".join(f"{w} bigint" for w in WEIGHTS)
    scored = (events.groupBy("key").applyInPandas(_classes_per_tick(f_ends, total), f"tick int, hits int, f int, {sums}")
              .groupBy("tick", "hits", "f").agg(*[F.sum(w).alias(w) for w in WEIGHTS]))
    # beyond exactly h edges = beyond at least h, less beyond at least h + 1
    exact = Window.partitionBy("tick", "f").orderBy("hits")
    nxt = F.lead("hits").over(exact) == F.col("hits") + 1
    scored = scored.select("tick", "hits", "f", *[(F.col(w) - F.coalesce(F.when(nxt, F.lead(w).over(exact)), F.lit(0))).alias(w)
                                                  for w in WEIGHTS]).where("n > 0")
    ticks = spark.createDataFrame([(r.tick, r.n, r.r_bins) for r in per_tick], "tick int, base bigint, r_bins int")
    out = (scored.join(F.broadcast(ticks), "tick")
           .withColumn("segment", segment_expr(F.col("r_bins") - F.col("hits"), F.col("f"), p))
           .groupBy("tick", "segment", "base").agg(*[F.sum(w).alias(w) for w in WEIGHTS])
           .join(F.broadcast(spine), "tick"))
    mean = lambda total: round6(total.cast("double") / F.col("n"))
    return out.select(F.col("tick").cast("bigint").alias("tick"), "cursor", "segment", F.col("n").alias("customers"),
                      mean(F.unix_date("cursor") * F.col("n") - F.col("days")).alias("avg_recency_days"),
                      mean(F.col("orders")).alias("avg_frequency"), mean(F.col("cents") / F.lit(100.0)).alias("avg_monetary"),
                      safe_div("n", "base").alias("pct_of_base"))


def replay_cohorts(bundle) -> DataFrame:
    """Active customers and retention per (tick, cohort, month), as of every cursor. A customer
    counts in a month from the first tick that sees both a purchase of that month and the customer."""
    p = bundle.params
    spark = bundle.transactions.sparkSession
    ensure_checkpoint_dir(spark)
    # one pass over the transactions, kept as a row per customer and month: for the cursors their first and
    # last day, and the first purchase
    day = F.col("transaction_date")
    bought = F.lit(True) if p.include_refunds_in_cohorts else ~F.col("refund_flag")
    active = (bundle.transactions.groupBy("customer_id", month_ordinal(day).alias("activity_month"))
              .agg(F.min(day).alias("lo"), F.max(day).alias("hi"), F.min(F.when(bought, day)).alias("first")).checkpoint())
    joined = bundle.customers.select("customer_id", "acquisition_date").checkpoint()
    dates = {"campaigns": bundle.campaigns.select("date"), "customers": joined.select(F.col("acquisition_date").alias("date")),
             "transactions": active.select(F.explode(F.array("lo", "hi")).alias("date"))}
    if bundle.raw.get("ab_test") is not None:
        dates["ab_test"] = bundle.ab_test.select("date")
    start, end, total = replay_bounds(dates)
    customers = joined.filter(F.col("acquisition_date").isNotNull()).select(
        "customer_id", month_ordinal("acquisition_date").alias("cohort_month"),
        _tick_of(F.col("acquisition_date"), start, total).alias("known"))
    first = active.filter(F.col("customer_id").isNotNull() & F.col("first").isNotNull()).select("customer_id", "activity_month", "first")
    months = F.col("activity_month") - F.col("cohort_month")
    seen = (first.join(customers, "customer_id").where(months.between(0, p.cohort_max_months))
            .groupBy("cohort_month", months.alias("k"),
                     F.greatest("known", _tick_of(F.col("first"), start, total)).alias("tick"))
            .agg(F.count("*").alias("d")))
    acquired = customers.groupBy("cohort_month", F.col("known").alias("tick")).agg(F.count("*").alias("d"))

    def running(changes: DataFrame, keys: list[str], name: str) -> DataFrame:
        """The running sum at every tick, from the few ticks in which it changes."""
        w = Window.partitionBy(*keys).orderBy("tick")
        return (changes.select(*keys, "tick", F.sum("d").over(w).alias(name),
                               F.coalesce(F.lead("tick").over(w) - 1, F.lit(total)).alias("last"))
                .select(*keys, name, F.explode(F.sequence("tick", "last")).alias("tick")))

    active = running(seen, ["cohort_month", "k"], "active_customers")
    size = running(acquired, ["cohort_month"], "cohort_size").where(F.col("cohort_size") >= p.cohort_min_size)
    return (active.join(size, ["cohort_month", "tick"]).join(_spine(spark, start, end, total), "tick")
            .select("tick", "cursor", _ordinal_to_date(F.col("cohort_month")).alias("cohort"),
                    F.col("k").alias("months_since_acquisition"), "active_customers", "cohort_size",
                    safe_div("active_customers", "cohort_size").alias("retention_pct")))
