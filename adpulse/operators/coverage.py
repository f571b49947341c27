"""Coverage, capability gates and table profiles (A6 .. A10, R8).

Each table is scanned once with one aggregation; results are one row per
table, so only a handful of numbers ever reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adpulse.params import DEFAULTS, AnalysisParams
from adpulse.sources.bundle import DATE_COLUMN


def _union(parts):
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def date_spans(tables: dict) -> DataFrame:
    """Per table: rows, min and max of its date column; of the campaigns also the channels with any
    spend (NULL for the others)."""
    def paid(name):
        return F.countDistinct(F.when(F.col("spend") > 0, F.col("channel"))) if name == "campaigns" else F.lit(None).cast("bigint")
    return _union([df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows"),
                          F.min(DATE_COLUMN[name]).alias("lo"), F.max(DATE_COLUMN[name]).alias("hi"), paid(name).alias("paid"))
                   for name, df in tables.items()])


# What a table's spans tell, as aggregates over them: a caller that needs several takes them from one pass.
def _latest():
    return F.max("hi")


def _months():
    span = (F.year("hi") - F.year("lo")) * 12 + F.month("hi") - F.month("lo") + 1
    return F.coalesce(F.max(F.when(F.col("rows") > 0, span)), F.lit(0)).cast("bigint")


def _capabilities(tables: dict, params: AnalysisParams) -> dict:
    months = _months()

    def rows(n):
        return F.coalesce(F.max(F.when(F.col("table_name") == n, F.col("rows"))), F.lit(0))

    def has(*names):
        e = F.lit(True)
        for n in names:
            e = e & (rows(n) > 0) if n in tables else F.lit(False)
        return e

    paid = F.coalesce(F.max("paid"), F.lit(0))
    need = params.n_donors + params.n_recipients
    return {
        "overview": has("campaigns"),
        "marketing": has("campaigns"),
        "forecast": has("campaigns") & (months >= params.holdout_months + 3),
        "acquisition_cost": has("campaigns", "customers"),
        "customer_value": has("customers", "transactions"),
        "rfm": has("transactions"),
        "cohorts": has("customers", "transactions"),
        "profitability": has("campaigns", "customers", "transactions"),
        "reallocation": has("campaigns", "customers", "transactions") & (paid >= need),
        "experiments": has("ab_test"),
        "churn_ml": (has("customers", "transactions") & (rows("customers") >= params.churn_min_customers)
                     & (months >= params.churn_min_months)),
    }


def max_date(tables: dict) -> DataFrame:
    """Latest date over all tables' own date columns."""
    return date_spans(tables).agg(_latest().alias("max_date"))


def months_of_history(tables: dict) -> DataFrame:
    """Max over tables of whole calendar months spanned; 0 when empty."""
    return date_spans(tables).agg(_months().alias("months_of_history"))


def capabilities(tables: dict, params: AnalysisParams = DEFAULTS) -> DataFrame:
    """Which modules the present tables can support (one row, one
    aggregation over the per-table spans)."""
    return date_spans(tables).agg(*[c.alias(n) for n, c in _capabilities(tables, params).items()])


def coverage(tables: dict, params: AnalysisParams = DEFAULTS) -> DataFrame:
    """A6, A7 and A8 (as ``can_<module>``) as one row, from one pass over the tables."""
    return date_spans(tables).agg(_latest().alias("max_date"), _months().alias("months_of_history"),
                                  *[c.alias(f"can_{n}") for n, c in _capabilities(tables, params).items()])


def table_profile(tables: dict) -> DataFrame:
    """Rows, columns and date range per table."""
    return _union([df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows"),
                          F.lit(len(df.columns)).cast("bigint").alias("columns"),
                          F.min(DATE_COLUMN[name]).alias("min_date"), F.max(DATE_COLUMN[name]).alias("max_date"))
                   for name, df in tables.items()])


def null_profile(tables: dict) -> DataFrame:
    """A10: NULL count of every column of every table, long format. One
    aggregation per table, unpivoted."""
    parts = []
    for name, df in tables.items():
        agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
        parts.append(agg.select(F.inline(F.array(*[
            F.struct(F.lit(name).alias("table_name"), F.lit(c).alias("column_name"),
                     F.col(f"`{c}`").cast("bigint").alias("null_count")) for c in df.columns]))))
    return _union(parts)
