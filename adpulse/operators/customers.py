"""RFM segmentation, cohort retention and value by plan (C1 .. C17)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from adpulse.errors import InsufficientData
from adpulse.functions.kpis import first_match, month_ordinal, r6, round6, safe_div
from adpulse.operators.selection import kth_keys, order_digits, past
from adpulse.params import DEFAULTS, FALLTHROUGH_SEGMENT, AnalysisParams


def purchases(transactions: DataFrame, include_refunds: bool) -> DataFrame:
    """Purchases are non-refunded transactions unless refunds are included."""
    return transactions if include_refunds else transactions.filter(~F.col("refund_flag"))


def reference_date(transactions: DataFrame, params: AnalysisParams = DEFAULTS, as_of=None) -> Column:
    """Explicit parameter, else the cursor, else the last transaction date
    (refunds included) as a scalar subquery."""
    if params.reference_date is not None:
        return F.lit(params.reference_date)
    if as_of is not None:
        return F.lit(as_of)
    return transactions.select(F.max("transaction_date")).scalar()


def rfm_base(transactions: DataFrame, params: AnalysisParams = DEFAULTS, as_of=None) -> DataFrame:
    """Last purchase, frequency, monetary and recency per customer."""
    ref = reference_date(transactions, params, as_of)
    p = purchases(transactions, params.include_refunds_in_rfm)
    return (p.groupBy("customer_id")
            .agg(F.max("transaction_date").alias("last_purchase"),
                 F.count("transaction_id").alias("frequency"),
                 F.sum("amount").alias("monetary"))
            .withColumn("recency_days", F.datediff(ref, F.col("last_purchase"))))


def quantile_edges(df: DataFrame, col: str, bins: int) -> Column:
    """Exact, linearly interpolated quantile edges of ``col`` at 0, 1/bins,
    ..., 1, with duplicates dropped, as a scalar subquery (an array of at
    most bins+1 doubles). ``percentile`` keeps one counter per distinct value,
    bounded here because recency is a whole number of days."""
    qs = [i / bins for i in range(bins + 1)]
    return df.select(F.array_distinct(F.percentile(F.col(col), F.lit(qs)))).scalar()


def bin_by_edges(value: Column, edges: Column, max_bins: int) -> Column:
    """1-based bin of ``value`` for intervals (e0,e1], (e1,e2], ... with the
    first one closed: 1 + number of interior edges strictly below value.
    Unrolled over the at most ``max_bins - 1`` interior edges."""
    m = F.size(edges) - 1
    hits = [F.when((F.lit(k) <= m - 1) & (value > F.get(edges, F.lit(k))), 1).otherwise(0)
            for k in range(1, max_bins)]
    total = hits[0]
    for h in hits[1:]:
        total = total + h
    return (total + 1).cast("int")


def segment_expr(r: Column, f: Column, params: AnalysisParams = DEFAULTS) -> Column:
    """The first matching segment rule, else the fall-through label."""
    rules = [(r.between(s.r_min, s.r_max) & f.between(s.f_min, s.f_max), s.name)
             for s in params.segment_rules]
    return first_match(rules, FALLTHROUGH_SEGMENT)


def bin_ends(n: int, bins: int) -> list[int]:
    """The last rank of each bin but the topmost when ``n`` ranks are cut into
    ``bins`` of equal frequency: rank r is in bin max(1, ceil((r - 1) bins / (n - 1)))."""
    return [1 + k * (n - 1) // bins for k in range(1, bins)]


def score_bounds(base: DataFrame, bins: int, needed: int = 0) -> tuple[dict[str, list[tuple]], list[Column]]:
    """C4: per scored column the keys that end its bins, and the digits of the ids
    that break ties. The passes share one stored copy of the customers, released here."""
    ids = order_digits(base, "customer_id")
    keys = base.select(*[d.alias(f"{c}{i}") for c in ("frequency", "monetary") for i, d in enumerate(order_digits(base, c))],
                       *[d.alias(f"id{i}") for i, d in enumerate(ids)]).persist()
    try:
        n = keys.count()
        if n < needed:
            raise InsufficientData("rfm", f"{needed} purchasing customers", str(n))
        found = {}
        for c in ("frequency", "monetary"):
            digits = [x for x in keys.columns if x.startswith(c)] + [x for x in keys.columns if x.startswith("id")]
            ends = kth_keys(keys, digits, [(0, k, r) for k, r in enumerate(bin_ends(n, bins))] if n else [], width=1 << 16)
            found[c] = [ends[q] for q in sorted(ends)]
        return found, ids
    finally:
        keys.unpersist()


def score_by_bounds(digits: list[Column], bounds: list[tuple]) -> Column:
    """1 + the number of bin ends below the key."""
    score = F.lit(1)
    for b in bounds:
        score = score + past(digits, b).cast("int")
    return score.cast("int")


def rfm_table(transactions: DataFrame, customers: DataFrame | None = None,
              params: AnalysisParams = DEFAULTS, as_of=None, check: bool = True) -> DataFrame:
    """Scores, segment and (left-joined) channel and plan per customer.

    R: quantile bins of recency (most recent = highest score), fewer bins when
    edges coincide. F and M: bins of the rank of frequency / monetary with ties
    broken by customer_id. A bin ends at the k-th (value, id), found by narrowing
    histograms; a score counts the ends below the customer, so nothing is sorted.
    """
    B = params.rfm_bins
    base = rfm_base(transactions, params, as_of)
    bounds, ids = score_bounds(base, B, params.min_rfm_customers if check else 0)
    edges = quantile_edges(base, "recency_days", B)
    r_bins = F.greatest(F.size(edges) - 1, F.lit(1))
    scored = (base.withColumn("R_score", (r_bins + 1 - bin_by_edges(F.col("recency_days"), edges, B)).cast("int"))
              .withColumn("F_score", score_by_bounds([*order_digits(base, "frequency"), *ids], bounds["frequency"]))
              .withColumn("M_score", score_by_bounds([*order_digits(base, "monetary"), *ids], bounds["monetary"])))
    out = scored.select(
        "customer_id", "last_purchase", F.col("frequency").cast("bigint").alias("frequency"),
        r6("monetary").alias("monetary"), F.col("recency_days").cast("int").alias("recency_days"),
        "R_score", "F_score", "M_score",
        (F.col("R_score") + F.col("F_score") + F.col("M_score")).alias("rfm_score"),
        segment_expr(F.col("R_score"), F.col("F_score"), params).alias("segment"))
    if customers is not None:
        out = out.join(customers.select("customer_id", "acquisition_channel", "subscription_plan"),
                       "customer_id", "left")
    return out


def rfm_bins_used(transactions: DataFrame, params: AnalysisParams = DEFAULTS, as_of=None) -> DataFrame:
    """Bins actually available per score and whether the scale degraded.
    F and M rank distinct positions, so they degrade only with fewer customers
    than bins."""
    B = params.rfm_bins
    base = rfm_base(transactions, params, as_of)
    qs = [i / B for i in range(B + 1)]
    return base.agg(
        (F.size(F.array_distinct(F.percentile("recency_days", F.lit(qs)))) - 1).alias("r_bins"),
        F.least(F.count(F.lit(1)), F.lit(B)).alias("f_bins"),
        F.least(F.count(F.lit(1)), F.lit(B)).alias("m_bins"),
    ).select(F.col("r_bins").cast("int"), F.col("f_bins").cast("int"), F.col("m_bins").cast("int"),
             (F.least("r_bins", "f_bins", "m_bins") < B).alias("degraded"))


def segment_summary(rfm: DataFrame) -> DataFrame:
    """Customers and mean R/F/M per segment with share of the base."""
    total = rfm.select(F.count(F.lit(1))).scalar()
    return (rfm.groupBy("segment")
            .agg(F.count(F.lit(1)).alias("customers"),
                 round6(F.avg("recency_days")).alias("avg_recency_days"),
                 round6(F.avg("frequency")).alias("avg_frequency"),
                 round6(F.avg("monetary")).alias("avg_monetary"))
            .withColumn("pct_of_base", r6(safe_div("customers", total)))
            .orderBy(F.col("customers").desc(), "segment"))


# ---------------------------------------------------------------- cohorts
def cohort_activity(transactions: DataFrame, customers: DataFrame,
                    params: AnalysisParams = DEFAULTS, max_months: int | None = None) -> DataFrame:
    """Distinct (customer, activity month) tagged with cohort month,
    channel and months since acquisition, kept for 0..max_months.

    Distinct customer-months are formed **before** the join, so a customer
    with a huge share of transactions reaches the join as at most one row per
    month (partial aggregation does the collapsing map-side)."""
    if max_months is None:
        max_months = max(params.cohort_max_months, params.channel_retention_max_months)
    act = (purchases(transactions, params.include_refunds_in_cohorts)
           .filter(F.col("customer_id").isNotNull())
           .select("customer_id", month_ordinal("transaction_date").alias("activity_month"))
           .distinct())
    cust = customers.filter(F.col("acquisition_date").isNotNull()).select(
        "customer_id", "acquisition_channel", month_ordinal("acquisition_date").alias("cohort_month"))
    return (act.join(cust, "customer_id")
            .withColumn("months_since_acquisition", F.col("activity_month") - F.col("cohort_month"))
            .filter(F.col("months_since_acquisition").between(0, max_months)))


def _ordinal_to_date(o: Column) -> Column:
    return F.make_date((o / 12).cast("int"), (o % 12 + 1).cast("int"), F.lit(1))


def cohort_counts(activity: DataFrame, customers: DataFrame,
                  params: AnalysisParams = DEFAULTS, rounded: bool = True) -> DataFrame:
    """Active customers / cohort size per (cohort, month) for cohorts of
    at least ``cohort_min_size`` customers (``rounded=False`` keeps the exact
    ratio for downstream means)."""
    sizes = (customers.filter(F.col("acquisition_date").isNotNull())
             .groupBy(month_ordinal("acquisition_date").alias("cohort_month"))
             .agg(F.count(F.lit(1)).alias("cohort_size")))
    counts = (activity.filter(F.col("months_since_acquisition") <= params.cohort_max_months)
              .groupBy("cohort_month", "months_since_acquisition")
              .agg(F.count(F.lit(1)).alias("active_customers")))
    return (counts.join(sizes, "cohort_month")
            .filter(F.col("cohort_size") >= params.cohort_min_size)
            .select(_ordinal_to_date(F.col("cohort_month")).alias("cohort"),
                    F.col("months_since_acquisition").cast("int").alias("months_since_acquisition"),
                    F.col("active_customers").cast("bigint").alias("active_customers"),
                    F.col("cohort_size").cast("bigint").alias("cohort_size"),
                    (r6 if rounded else (lambda c: c))(safe_div("active_customers", "cohort_size"))
                    .alias("retention_pct")))


def retention_matrix(counts: DataFrame, ref_date: Column) -> DataFrame:
    """C11: full cohort x month grid; a cell is NULL when nobody was active
    and ``observed`` says whether that month has happened yet. The grid is an
    explode of the (at most max_months+1) present months per cohort."""
    months = counts.select(F.sort_array(F.collect_set("months_since_acquisition"))).scalar()
    ref_ord = month_ordinal(ref_date)
    grid = (counts.groupBy("cohort").agg(F.first("cohort_size").alias("cohort_size"))
            .select("cohort", "cohort_size", F.explode(months).alias("months_since_acquisition")))
    cells = counts.select("cohort", "months_since_acquisition", "retention_pct")
    return (grid.join(cells, ["cohort", "months_since_acquisition"], "left")
            .withColumn("observed", F.col("months_since_acquisition")
                        <= ref_ord - month_ordinal(F.col("cohort"))))


def cohort_means(counts: DataFrame) -> DataFrame:
    """Mean month-0 and month-1 retention across cohorts, the drop, and
    the number of cohorts."""
    m0 = F.avg(F.when(F.col("months_since_acquisition") == 0, F.col("retention_pct")))
    m1 = F.avg(F.when(F.col("months_since_acquisition") == 1, F.col("retention_pct")))
    return counts.agg(round6(m0).alias("mean_month_0"), round6(m1).alias("mean_month_1"),
                      round6(m0 - m1).alias("month_0_to_1_drop"),
                      F.countDistinct("cohort").cast("bigint").alias("n_cohorts"))


def retention_by_channel(activity: DataFrame, customers: DataFrame,
                         params: AnalysisParams = DEFAULTS) -> DataFrame:
    """Active customers per (channel, month) over all customers the
    channel acquired."""
    sizes = customers.groupBy("acquisition_channel").agg(F.count(F.lit(1)).alias("cohort_size"))
    out = (activity.filter((F.col("months_since_acquisition") <= params.channel_retention_max_months)
                           & F.col("acquisition_channel").isNotNull())
           .groupBy("acquisition_channel", "months_since_acquisition")
           .agg(F.count(F.lit(1)).alias("active_customers")))
    return (out.join(sizes, "acquisition_channel", "left")
            .select("acquisition_channel",
                    F.col("months_since_acquisition").cast("int").alias("months_since_acquisition"),
                    F.col("active_customers").cast("bigint").alias("active_customers"),
                    F.col("cohort_size").cast("bigint").alias("cohort_size"),
                    r6(safe_div("active_customers", "cohort_size")).alias("retention_pct")))


def month_n_channel_ranking(by_channel: DataFrame, month: int = 3) -> DataFrame:
    """C14: channels ranked by retention at month ``month`` (few rows)."""
    w = Window.orderBy(F.col("retention_pct").desc_nulls_last(), "acquisition_channel")
    return (by_channel.filter(F.col("months_since_acquisition") == month)
            .select("acquisition_channel", "retention_pct", F.row_number().over(w).alias("rank")))


def steepest_drop(counts: DataFrame) -> DataFrame:
    """Mean retention per month across cohorts and the fall from the
    previous month; ``is_steepest`` marks the largest fall (earliest on ties).
    Runs on at most max_months+1 rows."""
    means = counts.groupBy("months_since_acquisition").agg(F.avg("retention_pct").alias("m"))
    w = Window.orderBy("months_since_acquisition")
    d = means.select("months_since_acquisition", round6("m").alias("mean_retention"),
                     round6(F.lag("m").over(w) - F.col("m")).alias("drop_from_previous"))
    top = Window.orderBy(F.col("drop_from_previous").desc_nulls_last(), "months_since_acquisition")
    return d.withColumn("is_steepest", (F.row_number().over(top) == 1) & F.col("drop_from_previous").isNotNull())


def value_by_plan(transactions: DataFrame, customers: DataFrame,
                  params: AnalysisParams = DEFAULTS) -> DataFrame:
    """Per plan, purchasers, mean purchases and mean lifetime profit."""
    per = (purchases(transactions, params.include_refunds_in_rfm)
           .groupBy("customer_id")
           .agg(F.sum("profit").alias("lifetime_profit"), F.count("transaction_id").alias("purchases")))
    j = per.join(customers.select("customer_id", "subscription_plan"), "customer_id")
    return (j.filter(F.col("subscription_plan").isNotNull()).groupBy("subscription_plan")
            .agg(F.count(F.lit(1)).cast("bigint").alias("customers"),
                 round6(F.avg("purchases")).alias("avg_purchases"),
                 round6(F.avg("lifetime_profit")).alias("avg_lifetime_profit")))


def build(bundle, as_of=None) -> dict:
    """C17: the customers view; one tagged activity table shared (persisted)
    by the cohort and channel retention tables."""
    p = bundle.params
    t, cu = bundle.transactions, bundle.customers
    rfm = rfm_table(t, cu, p, as_of)
    activity = cohort_activity(t, cu, p).persist()
    counts = cohort_counts(activity, cu, p)
    return {
        "rfm": rfm,
        "segments": segment_summary(rfm),
        "cohorts": counts,
        "matrix": retention_matrix(counts, reference_date(t, p, as_of)),
        "cohort_means": cohort_means(cohort_counts(activity, cu, p, rounded=False)),
        "retention_by_channel": retention_by_channel(activity, cu, p),
        "value_by_plan": value_by_plan(t, cu, p),
    }
