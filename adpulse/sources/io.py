"""Sources and sinks.

CSV is read with explicit schemas (no inference pass over the data); stores
are written as Parquet partitioned by month so ``as_of`` cursors and month
filters prune whole directories.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from adpulse.params import DEFAULTS, AnalysisParams
from adpulse.sources.bundle import DATE_COLUMN, Bundle

_S, _D, _M, _L, _F, _B = (T.StringType(), T.DateType(), T.DecimalType(18, 4), T.LongType(),
                          T.DoubleType(), T.BooleanType())

# File names and column layouts of the four source tables.
SCHEMAS = {
    "campaigns": ("campaigns.csv", T.StructType([
        T.StructField(n, t) for n, t in (
            ("campaign_id", _S), ("campaign_name", _S), ("channel", _S), ("objective", _S), ("device", _S),
            ("country", _S), ("audience", _S), ("date", _D), ("spend", _M), ("impressions", _L),
            ("clicks", _L), ("conversions", _L), ("revenue", _M))])),
    "customers": ("customers.csv", T.StructType([
        T.StructField(n, t) for n, t in (
            ("customer_id", _S), ("acquisition_channel", _S), ("acquisition_date", _D), ("age_group", _S),
            ("gender", _S), ("city", _S), ("country", _S), ("subscription_plan", _S),
            ("first_purchase_value", _M))])),
    "transactions": ("transactions.csv", T.StructType([
        T.StructField(n, t) for n, t in (
            ("transaction_id", _S), ("customer_id", _S), ("transaction_date", _D), ("product_category", _S),
            ("amount", _M), ("discount", _F), ("profit", _M), ("refund_flag", _B))])),
    "ab_test": ("ab_test_campaigns.csv", T.StructType([
        T.StructField(n, t) for n, t in (
            ("variant", _S), ("date", _D), ("impressions", _L), ("clicks", _L), ("conversions", _L),
            ("revenue", _M), ("spend", _M))])),
}


def read_csv_table(spark: SparkSession, path: str, name: str) -> DataFrame | None:
    """One source CSV with its declared schema; None when the file is absent."""
    schema = SCHEMAS[name][1]
    try:
        return (spark.read.schema(schema).option("header", True).option("mode", "FAILFAST")
                .option("dateFormat", "yyyy-MM-dd").csv(path))
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            return None
        raise


def load_from_paths(spark: SparkSession, data_dir: str, params: AnalysisParams = DEFAULTS) -> Bundle:
    """A1: the four raw CSVs of a folder; missing files are skipped, all
    missing is an error. Cleaning happens lazily in the bundle's audit."""
    raw = {}
    for name, (fname, _schema) in SCHEMAS.items():
        df = read_csv_table(spark, f"{data_dir.rstrip('/')}/{fname}", name)
        if df is not None:
            raw[name] = df
    if not raw:
        raise FileNotFoundError(f"no source CSVs found in {data_dir}")
    return Bundle(raw=raw, params=params)


#: Tasks that may write one month of a table.
WRITERS_PER_MONTH = 32


def write_store(tables: dict, out_dir: str, register_views: bool = True) -> dict:
    """A3: write each table as Parquet partitioned by the month of its date
    column and expose it as a temp view. Returns name -> path."""
    paths = {}
    for name, df in tables.items():
        if df is None:
            continue
        path = f"{out_dir.rstrip('/')}/{name}"
        (df.withColumn("month", F.date_format(DATE_COLUMN[name], "yyyy-MM"))
         # a month is split over tasks by a hash of the row, so that a large one isn't one task
         .repartition("month", F.pmod(F.xxhash64(*df.columns), F.lit(WRITERS_PER_MONTH))).write.mode("overwrite").partitionBy("month").parquet(path))
        paths[name] = path
        if register_views:
            df.sparkSession.read.parquet(path).drop("month").createOrReplaceTempView(name)
    return paths


#: Buckets of a saved table by customer, and rows of a file at most.
BUCKETS = 64
ROWS_PER_FILE = 5_000_000
WRITERS_PER_BUCKET = 4


def save_tables(tables: dict, folder: str, database: str, buckets: int = BUCKETS,
                rows_per_file: int = ROWS_PER_FILE) -> dict:
    """A3 for tables that are joined again and again: Parquet by month under ``folder``, each month in
    buckets by customer, sorted, in files of a bounded number of rows, and registered in the catalog.
    Joins and aggregations by customer then shuffle nothing. (A customer with a large share of all rows
    makes one bucket as large: read such a table with ``spark.sql.sources.bucketing.enabled`` off, and
    the rows are shuffled and split as any others.) Returns name -> table."""
    names = {}
    for name, df in tables.items():
        if df is None:
            continue
        df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        by_customer = "customer_id" in df.columns
        # a bucket is written by a few tasks, so that a hot customer isn't one
        some = F.pmod(F.xxhash64(*df.columns), F.lit(WRITERS_PER_BUCKET))
        keyed = (df.repartition("customer_id", some) if by_customer else df).withColumn(
            "month", F.date_format(DATE_COLUMN[name], "yyyy-MM"))
        writer = (keyed.write.mode("overwrite").partitionBy("month").option("maxRecordsPerFile", rows_per_file)
                  .option("path", f"{folder.rstrip('/')}/{name}"))
        if by_customer:
            writer = writer.bucketBy(buckets, "customer_id").sortBy("customer_id")
        names[name] = f"{database}.{name}"
        writer.saveAsTable(names[name])
    return names


class SavedBundle(Bundle):
    """The clean tables as ``save_tables`` left them; a cursor prunes whole months."""

    def _clean(self, name: str) -> DataFrame | None:
        df = self.raw.get(name)
        if df is None:
            return None
        if self.cursor is not None:
            df = df.filter((F.col(DATE_COLUMN[name]) <= F.lit(self.cursor))
                           & (F.col("month") <= F.lit(self.cursor.strftime("%Y-%m"))))
        return df.drop("month")

    def as_of(self, cursor) -> "SavedBundle":
        return SavedBundle(raw=self.raw, params=self.params, cursor=date.fromisoformat(cursor) if isinstance(cursor, str) else cursor)


def open_tables(spark: SparkSession, names: dict, params: AnalysisParams = DEFAULTS) -> SavedBundle:
    """A bundle over saved tables."""
    return SavedBundle(raw={n: spark.table(t) for n, t in names.items()}, params=params)


def write_clean(bundle: Bundle, out_dir: str) -> dict:
    """A4: the audit's clean tables plus the quarantined rows per rule."""
    paths = write_store(bundle.audit.clean, f"{out_dir.rstrip('/')}/clean", register_views=False)
    q = f"{out_dir.rstrip('/')}/quarantine"
    bundle.audit.quarantine.write.mode("overwrite").partitionBy("rule_key").parquet(q)
    paths["quarantine"] = q
    return paths


def to_json_lines(df: DataFrame) -> DataFrame:
    """One JSON document per row. Undefined ratios are NULL inside the
    engine (never NaN), so they serialise as null; non-finite doubles that
    arrive from outside are nulled here; dates become ISO strings."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(F.isnan(c) | (F.abs(c) == float("inf")), F.lit(None)).otherwise(c)
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        cols.append(c.alias(f.name))
    return df.select(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias("json"))
