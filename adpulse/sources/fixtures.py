"""The four engine tables (campaigns, customers, transactions, ab_test),
derived with the DataFrame API from the driver's TPC-H-style parquet tables.

The derivation is part of every query's work, so it scales with the input:
lineitem/orders/part/customer are joined with shuffle joins chosen by AQE;
only ``nation`` (25 rows) and ``region`` (5 rows), fixed-size dimensions at
every scale factor, are broadcast explicitly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values that define the fixture views (channel, objective, device,
# country, audience and plan names, indexed by the modulus shown).
CHANNELS = ("Google Ads", "Facebook", "Instagram", "Email", "Affiliate", "TikTok", "Organic")  # % 7
OBJECTIVES = ("Awareness", "Consideration", "Conversion")  # cid % 3
DEVICES = ("Mobile", "Desktop", "Tablet")  # (cid + 1) % 3
COUNTRIES = ("United States", "United Kingdom", "India", "Canada", "Australia")  # cid % 5
AUDIENCES = ("New", "Returning", "Retargeting", "Lookalike")  # cid % 4
PLANS = ("Free", "Basic", "Premium", "Enterprise")  # custkey % 4
ORPHAN_OFFSET = 1_000_000_000_000


def _pick(key_sql: str, labels) -> F.Column:
    """CASE key WHEN 0 THEN labels[0] ... ELSE labels[-1], as one SQL
    expression (one driver round trip instead of one per branch)."""
    whens = " ".join(f"WHEN {i} THEN '{lab}'" for i, lab in enumerate(labels[:-1]))
    return F.expr(f"CASE {key_sql} {whens} ELSE '{labels[-1]}' END")


_READERS: dict = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet reader, memoised per session and path (DataFrames are
    immutable; this only saves repeated file listing and footer reads)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, id(spark), path)
    hit = _READERS.get(key)
    if hit is None or hit[0] is not spark:   # the entry holds its session, so ids cannot be recycled
        hit = (spark, spark.read.parquet(path))
        _READERS[key] = hit
    return hit[1]


#: Rows of the largest table in one partition of the campaigns.
ROWS_PER_PARTITION = 100_000
_PARTITIONS: dict = {}


def _partitions(lineitem: DataFrame) -> int:
    """Partitions for what is derived from ``lineitem``, from its number of rows, which its footers tell;
    memoised like the readers."""
    hit = _PARTITIONS.get(id(lineitem))
    if hit is None or hit[0] is not lineitem:
        hit = (lineitem, max(1, -(-lineitem.count() // ROWS_PER_PARTITION)))
        _PARTITIONS[id(lineitem)] = hit
    return hit[1]


def _dec(c, p, s):
    return F.col(c).cast(f"decimal({p},{s})") if isinstance(c, str) else c.cast(f"decimal({p},{s})")


def stream_table(spark: SparkSession, sf_dir: str, name: str, files_per_batch: int | None = None) -> DataFrame:
    """The same parquet as a file stream (a single file or a folder of files)."""
    reader = spark.readStream.schema(read_table(spark, sf_dir, name).schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # a pattern, since a stream's path may not be one file
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parque[t]")


def customers(spark: SparkSession, sf_dir: str, customer: DataFrame | None = None) -> DataFrame:
    """``customer`` stands in for the parquet table, e.g. as a stream."""
    customer = customer if customer is not None else read_table(spark, sf_dir, "customer")
    c = customer.select("c_custkey", "c_nationkey", "c_acctbal")
    o = read_table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate")
    n = F.broadcast(read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey"))
    r = F.broadcast(read_table(spark, sf_dir, "region").select("r_regionkey", "r_name"))
    first = o.groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_order"))
    key = F.col("c_custkey")
    j = (c.join(first, key == F.col("o_custkey"), "left")
         .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
         .join(r, F.col("n_regionkey") == F.col("r_regionkey")))
    bal = F.col("c_acctbal")
    age = (F.when(key % 100 == 3, F.lit(None).cast("string"))
           .when(bal < 2500, "18-24").when(bal < 5000, "25-34")
           .when(bal < 7500, "35-44").otherwise("45-54"))
    return j.select(
        key.alias("customer_id"),
        _pick("c_custkey % 7", CHANNELS).alias("acquisition_channel"),
        F.coalesce(F.col("first_order"), F.lit("1995-01-01 00:00:00").cast("timestamp_ntz"))
         .cast("date").alias("acquisition_date"),
        age.alias("age_group"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("country"),
        _pick("c_custkey % 4", PLANS).alias("subscription_plan"),
        F.abs(bal).cast("decimal(18,2)").alias("first_purchase_value"),
    )


def transactions(spark: SparkSession, sf_dir: str, lineitem: DataFrame | None = None) -> DataFrame:
    """``lineitem`` stands in for the parquet table, e.g. as a stream."""
    lineitem = lineitem if lineitem is not None else read_table(spark, sf_dir, "lineitem")
    li = lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_discount", "l_returnflag")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size")
    j = (li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
         .join(p, F.col("l_partkey") == F.col("p_partkey")))
    refund = F.col("l_returnflag") == "R"
    margin = F.when(refund, F.lit(-0.12).cast("decimal(4,2)")).otherwise(
        (F.lit(18) + F.col("p_size")).cast("decimal(4,0)") * F.lit(0.01).cast("decimal(4,2)"))
    profit = (margin * _dec("l_extendedprice", 10, 2)
              * (F.lit(1) - _dec("l_discount", 4, 2))).cast("decimal(18,6)")
    return j.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("transaction_id"),
        # seeded faults, no row lost: no id; an id that no customer has; a
        # neighbour buys instead, which leaves customers who never bought
        F.when(F.col("l_orderkey") % 997 == 0, F.lit(None).cast("bigint"))
         .when(F.col("o_custkey") % 50 == 7, F.col("o_custkey") + ORPHAN_OFFSET)
         .when(F.col("o_custkey") % 10 == 0, F.col("o_custkey") - 1)
         .otherwise(F.col("o_custkey")).cast("bigint").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("transaction_date"),
        F.col("p_type").alias("product_category"),
        _dec("l_extendedprice", 18, 2).alias("amount"),
        F.col("l_discount").alias("discount"),
        profit.alias("profit"),
        refund.alias("refund_flag"),
    )


def campaigns(spark: SparkSession, sf_dir: str, lineitem: DataFrame | None = None,
              keyed: bool = False) -> DataFrame:
    """``lineitem`` stands in for the parquet table. ``keyed``: the rows stay as the sums per campaign-day
    deal them, and the campaign's number ``cid`` comes along, so that whatever groups by it, the date and
    more needs no shuffle."""
    lineitem = lineitem if lineitem is not None else read_table(spark, sf_dir, "lineitem")
    li = lineitem.select(
        "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice", "l_tax", "l_discount")
    price = _dec("l_extendedprice", 10, 2)
    # campaign x day grain, a campaign for every supplier, so the table grows
    # with the input; partial aggregation collapses each task's rows first.
    # (Literal widths keep the products within 18 digits: exact, and on the
    # fast long-backed decimal path.)
    base = (li.groupBy(F.col("l_suppkey").alias("cid"),
                       F.col("l_shipdate").cast("date").alias("date"))
            .agg((F.sum("l_quantity") * 100).cast("bigint").alias("impressions"),
                 F.sum("l_quantity").cast("bigint").alias("clicks"),
                 F.count(F.lit(1)).alias("conversions"),
                 F.sum(price * _dec("l_tax", 4, 2) * F.lit(10).cast("decimal(2,0)")).alias("spend"),
                 F.sum(price * (F.lit(1).cast("decimal(1,0)") - _dec("l_discount", 4, 2))).alias("revenue")))
    base = base.withColumn("campaign_id", F.expr("concat('CMP-', CAST(1000 + cid AS STRING))"))
    if not keyed:
        # the rows of a campaign-day meet while they are narrow, in partitions that don't grow with the
        # table; whatever groups by campaign, day and more needs no other shuffle
        base = base.repartition(_partitions(lineitem), "campaign_id", "date")
    day_hash = "(year(date) * 372 + month(date) * 31 + day(date))"
    b = base.select(
        "campaign_id",
        F.expr("concat('Campaign_', CAST(cid AS STRING))").alias("campaign_name"),
        _pick("cid % 7", CHANNELS).alias("channel"),
        _pick("cid % 3", OBJECTIVES).alias("objective"),
        _pick("(cid + 1) % 3", DEVICES).alias("device"),
        _pick("cid % 5", COUNTRIES).alias("country"),
        _pick("cid % 4", AUDIENCES).alias("audience"),
        F.col("date"),
        F.expr(f"CASE WHEN cid % 7 = 6 THEN CAST(0 AS DECIMAL(28,4)) "
               f"WHEN (cid * 31 + {day_hash}) % 701 = 0 THEN CAST(-spend AS DECIMAL(28,4)) "
               f"ELSE CAST(spend AS DECIMAL(28,4)) END").alias("spend"),
        F.col("impressions"), F.col("clicks"),
        F.expr(f"CASE WHEN (cid * 17 + {day_hash}) % 499 = 0 THEN clicks + 7 ELSE conversions END")
        .alias("conversions"),
        F.col("revenue").cast("decimal(28,4)").alias("revenue"),
        # seeded fault: campaign CMP-1005 (cid 5) is double-loaded for every January
        F.expr("CASE WHEN cid = 5 AND month(date) = 1 THEN 2 ELSE 1 END").alias("_copies"),
        *(["cid"] if keyed else []),
    )
    # the extra copies come from one pass (explode), not a second aggregation
    return b.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).drop("_copies", "_copy")


def ab_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events").select("user_id", "ts", "event_type", "value")
    et = F.col("event_type")
    val = F.col("value").cast("decimal(18,2)")
    return (ev.groupBy(F.when(F.col("user_id") % 2 == 0, "A").otherwise("B").alias("variant"),
                       F.col("ts").cast("date").alias("date"))
            .agg((F.count(F.lit(1)) * 30).cast("bigint").alias("impressions"),
                 F.sum(F.when(et != "error", 1).otherwise(0)).cast("bigint").alias("clicks"),
                 F.sum(F.when(et == "purchase", 1).otherwise(0)).cast("bigint").alias("conversions"),
                 F.sum(F.when(et == "purchase", val).otherwise(F.lit(0))).alias("revenue"),
                 F.sum(F.when(et == "click", val).otherwise(F.lit(0))).alias("spend")))


BUILDERS = {
    "campaigns": campaigns,
    "customers": customers,
    "transactions": transactions,
    "ab_test": ab_test,
}
