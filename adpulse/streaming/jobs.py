"""Structured Streaming jobs (R4 .. R7).

Sources are file streams over the given parquet tables themselves; the engine's
columns are derived inside the stream. Sinks are parquet folders; each job keeps
its offsets and state in the session's shared checkpoint folder
(``spark.checkpoint.dir``), so a restarted job resumes instead of recomputing.
The state of R4 .. R6 is files of lines whose days are open (``campaign_days``),
that of R7 a join's. A job drains what its sources hold (``availableNow``), then
closes them with one row whose time lies beyond all others: the watermark passes
every open day, window and wait, their state leaves, and the sink is complete.
Callers get the sink read back as a DataFrame.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adpulse.functions.kpis import cpa, cpc, ctr, cvr, dbl, roas
from adpulse.session import ensure_checkpoint_dir
from adpulse.sources import fixtures
from adpulse.sources.fixtures import campaigns, stream_table


def _workdir(spark: SparkSession, name: str) -> str:
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/streams/{name}-{uuid.uuid4().hex[:8]}"


#: The time of the row that ends a drained stream.
CLOSING = "5000-01-01 00:00:00"
#: How far rows may be behind the newest one: by default no row of the tables is late.
DELAY = "36500 days"


def _closing(spark: SparkSession, like: DataFrame, time_col: str, path: str, rows: int) -> None:
    """Add to ``path`` no row, or one whose time lies beyond all others and whose other columns are NULL."""
    cols = [F.lit(CLOSING).cast("timestamp").cast(f.dataType).alias(f.name) if f.name == time_col else F.lit(None).cast(f.dataType).alias(f.name)
            for f in like.schema.fields]
    spark.range(rows).select(*cols).write.mode("append").parquet(path)


def _midnight(day: str) -> Column:
    """UTC-midnight instant of a day, independent of the session time zone."""
    return F.timestamp_seconds(F.unix_date(F.col(day).cast("date")).cast("bigint") * 86400)


class ClosedStream:
    """A stream with a closing row to come: ``df`` has ``time_col`` under a watermark, if a ``delay`` is given."""

    def __init__(self, stream: DataFrame, time_col: str, delay: str | None, folder: str):
        spark = stream.sparkSession
        self.shape, self.time_col, self.folder = stream, time_col, folder
        _closing(spark, stream, time_col, folder, 0)
        df = stream.union(spark.readStream.schema(stream.schema).parquet(folder))
        self.df = df.withWatermark(time_col, delay) if delay else df

    def close(self) -> None:
        _closing(self.shape.sparkSession, self.shape, self.time_col, self.folder, 1)


def _drain(start, streams: list[ClosedStream], one_batch: bool) -> None:
    """Run ``start()`` over what the sources hold and close them. Sources that come in ``one_batch`` are
    closed before it: the watermark moves between batches, so none of their rows is late, and the state is
    gone through once less. Others are closed by a second run from the first one's checkpoint."""
    for closed in (True,) if one_batch else (False, True):
        if closed:
            for s in streams:
                s.close()
        query = start()
        query.awaitTermination()
        if query.exception() is not None:
            raise RuntimeError(str(query.exception()))


def _to_parquet(df: DataFrame, wd: str):
    return lambda: (df.writeStream.outputMode("append").format("parquet").option("path", f"{wd}/out")
                    .option("checkpointLocation", f"{wd}/ckpt").trigger(availableNow=True).start())


#: Before all days; after all days, where rows without a day stand.
NO_DAY, EVERY_DAY = -(2**31), 2**31 - 1
#: Of the session that sums up days: the partitions of the narrow sums hold some 100,000 rows, which are
#: five times as wide behind them, and their shuffle files go as soon as a range of days is written.
_SUMMING = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "4m", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
            "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def _session(spark: SparkSession, conf: dict) -> SparkSession:
    """A session beside ``spark`` with its settings and ``conf``."""
    own = spark.newSession()
    for k, v in {**spark.conf.getAll, **conf}.items():
        if own.conf.isModifiable(k):
            own.conf.set(k, v)
    return own


def _sink(spark: SparkSession, schema: str, folder: str) -> None:
    """A file without rows, so that readers find ``folder``."""
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(folder)


def _week(day: Column) -> Column:
    """The number of the 7-day window (counted as ``F.window`` does) that ``day``, a number too, lies in."""
    return F.floor(day / 7).cast("int")


def _ranges(weeks: list, most: int) -> list[tuple[int, int, int]]:
    """Runs of (week, rows) as (first day, last day, rows) with ``most`` rows each, unless one week has more."""
    out: list[tuple[int, int, int]] = []
    for week, rows in weeks:
        if out and out[-1][2] + rows <= most:
            out[-1] = (out[-1][0], week * 7 + 6, out[-1][2] + rows)
        else:
            out.append((week * 7, week * 7 + 6, rows))
    return out


def campaign_days(spark: SparkSession, sf_dir: str, wd: str, emit, delay: str = DELAY,
                  files_per_batch: int | None = None) -> None:
    """Raw campaign-days (with double-loaded copies and ``cid``) from a drained stream over ``lineitem``,
    in append mode: a day leaves once and whole, when the watermark (``delay`` behind the newest line)
    passes it, and lines of days that have left are dropped.

    The state is files: a micro-batch appends its lines to ``open`` under its number (written over when
    the batch is repeated) and their number by day to ``seen``. The days that it makes the watermark pass
    are summed from ``open`` and go to ``emit(days, epoch, mode)``, in ranges of as many lines as the
    shuffle partitions take at once; ``mode`` is how to write under the batch's number. So no task holds
    open days in memory, and a line is shuffled once. Lines without a day leave with the closing row. A
    batch whose days have all left is removed from ``open`` by the next batch, when they are committed."""
    lines = stream_table(spark, sf_dir, "lineitem", files_per_batch).select(
        "l_suppkey", F.col("l_shipdate").cast("date").alias("l_shipdate"), "l_quantity", "l_extendedprice", "l_tax", "l_discount",
        F.lit(True).alias("line"))
    closed = ClosedStream(lines, "l_shipdate", None, f"{wd}/close")
    own = _session(spark, _SUMMING)
    day, date = F.coalesce(F.unix_date("l_shipdate"), F.lit(EVERY_DAY)), lambda n: F.date_from_unix_date(F.lit(n))
    most = int(spark.conf.get("spark.sql.shuffle.partitions")) * fixtures.ROWS_PER_PARTITION

    def seen(until: int) -> DataFrame:
        """The lines by batch and day, of the batches before ``until``; the closing row's ``line`` is false."""
        return own.read.schema("line boolean, day int, rows bigint, epoch bigint").parquet(f"{wd}/seen").filter(F.col("epoch") < until)

    def passed(until: int) -> int:
        """The last day that the watermark has passed as moved by the batches before ``until``."""
        if until <= 0:
            return NO_DAY
        newest = F.max(F.when(F.col("line") & (F.col("day") < EVERY_DAY), F.col("day")))
        mark = F.timestamp_seconds(newest.cast("bigint") * 86400) - F.expr(f"INTERVAL {delay}")
        last, open_ = seen(until).agg(F.floor(F.unix_seconds(mark) / 86400), F.min("line")).first()
        return EVERY_DAY if open_ is False else NO_DAY if last is None else last

    def write(batch: DataFrame, epoch: int) -> None:
        before = passed(epoch)
        gone = seen(epoch).groupBy("epoch").agg(F.max("day").alias("last")).filter(
            F.col("last").between(passed(epoch - 1) + 1, before)).collect() if epoch and before > NO_DAY else []
        for x in gone:
            path = spark._jvm.org.apache.hadoop.fs.Path(f"{wd}/open/epoch={x.epoch}")
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        folder = f"{wd}/open/epoch={epoch}"
        batch.filter(day > before).write.mode("overwrite").option("compression", "zstd").parquet(folder)
        (own.read.schema(batch.schema).parquet(folder).groupBy(F.col("line").isNotNull().alias("line"), day.alias("day"))
         .agg(F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(f"{wd}/seen/epoch={epoch}"))
        after = passed(epoch + 1)
        if after <= before:
            return
        weeks = seen(epoch + 1).filter(F.col("line") & F.col("day").between(before + 1, after)).groupBy(
            F.when(F.col("day") < EVERY_DAY, _week(F.col("day"))).alias("week")).agg(F.sum("rows")).orderBy("week").collect()
        undated = [(None, None, rows) for week, rows in weeks if week is None]
        held = own.read.schema(batch.schema).parquet(f"{wd}/open").filter("line").drop("epoch", "line")
        for i, (first, last, rows) in enumerate(_ranges([x for x in weeks if x[0] is not None], most) + undated):
            own.conf.set("spark.sql.shuffle.partitions", max(1, -(-rows // fixtures.ROWS_PER_PARTITION)))
            these = F.col("l_shipdate").isNull() if first is None else F.col("l_shipdate").between(
                date(max(first, before + 1)), date(min(last, after)))
            emit(campaigns(own, sf_dir, held.filter(these), keyed=True), epoch, "append" if i else "overwrite")

    _drain(lambda: (closed.df.writeStream.outputMode("append").foreachBatch(write)
                    .option("checkpointLocation", f"{wd}/ckpt").trigger(availableNow=True).start()), [closed], one_batch=False)


def clean_stream(raw: DataFrame) -> DataFrame:
    """The audit's clean campaigns (one of equal rows, nothing negative, conversions capped) as a stream."""
    bad = F.coalesce((F.col("spend") < 0) | (F.col("revenue") < 0), F.lit(False))
    return raw.dropDuplicates(raw.columns).filter(~bad).withColumn(
        "conversions", F.when(F.col("conversions") > F.col("clicks"), F.col("clicks")).otherwise(F.col("conversions")))


def stream_channel_kpis(spark: SparkSession, sf_dir: str, **source) -> DataFrame:
    """Channel totals per week, appended as their days close; their sums are the channel KPIs, equal
    to the batch once the stream is drained."""
    wd = _workdir(spark, "channel_kpis")
    schema = ("week int, channel string, impressions bigint, clicks bigint, conversions bigint, spend decimal(38,4), "
              "revenue decimal(38,4), epoch bigint")
    _sink(spark, schema.removesuffix(", epoch bigint"), f"{wd}/out/epoch=-1")

    def emit(days: DataFrame, epoch: int, mode: str) -> None:
        (clean_stream(days).filter(F.col("channel").isNotNull()).groupBy(_week(F.unix_date("date")).alias("week"), "channel")
         .agg(*[F.sum(c).alias(c) for c in ("impressions", "clicks", "conversions")],
              *[F.sum(c).cast("decimal(38,4)").alias(c) for c in ("spend", "revenue")])
         .write.mode(mode).parquet(f"{wd}/out/epoch={epoch}"))

    campaign_days(spark, sf_dir, wd, emit, **source)
    r = spark.read.schema(schema).parquet(f"{wd}/out").groupBy("channel").agg(
        *[F.sum(c).cast("bigint").alias(c) for c in ("impressions", "clicks", "conversions")],
        *[F.sum(c).alias(c) for c in ("spend", "revenue")])
    return r.select("channel", "impressions", "clicks", "conversions",
                    dbl("spend").alias("spend"), dbl("revenue").alias("revenue"),
                    ctr("clicks", "impressions").alias("ctr"), cvr("conversions", "clicks").alias("cvr"),
                    cpc("spend", "clicks").alias("cpc"), cpa("spend", "conversions").alias("cpa"),
                    roas("revenue", "spend").alias("roas"))


_CHANGES = "window_start date, window_end date, revenue decimal(38,4), rows bigint, newest timestamp, late boolean, epoch bigint"


def _change_writer(spark: SparkSession, wd: str, lateness: str):
    """Appends, per call, one row per 7-day window with what a batch's rows add to it, under the batch's
    number (written over when a batch is repeated). A window that ended more than ``lateness`` before the
    newest row of earlier batches is closed: what is added to it then goes to the late side, ``late=true``.
    No window is held in any state and none is rewritten; readers add both sides up. Rows without a time
    are in a window without bounds."""
    week = 7 * 86400
    day = lambda w: F.date_from_unix_date((w * 7).cast("int"))
    # the folder has a batch from the beginning, so that readers find a schema
    _sink(spark, "window_start date, window_end date, revenue decimal(38,4), rows bigint, newest timestamp", f"{wd}/out/epoch=-1/late=false")

    def write(batch: DataFrame, epoch: int, mode: str = "overwrite") -> None:
        newest = None
        if epoch:
            seen = spark.read.schema(_CHANGES).parquet(f"{wd}/out").filter(F.col("epoch") < epoch)
            newest = seen.agg(F.max("newest")).first()[0]  # a row per window and batch
        ended = F.lit(newest).cast("timestamp") - F.expr(f"INTERVAL {lateness}") if newest is not None else F.lit(None)
        change = (batch.groupBy(F.floor(F.unix_seconds("at") / week).alias("w"))
                  .agg(F.sum("revenue").cast("decimal(38,4)").alias("revenue"), F.count(F.lit(1)).alias("rows"), F.max("at").alias("newest")))
        (change.select(day(F.col("w")).alias("window_start"), day(F.col("w") + 1).alias("window_end"), "revenue", "rows",
                       "newest", F.coalesce(F.timestamp_seconds((F.col("w") + 1) * week) <= ended, F.lit(False)).alias("late"))
         .write.mode(mode).partitionBy("late").parquet(f"{wd}/out/epoch={epoch}"))

    return write


def weekly_changes(rows: DataFrame, wd: str, lateness: str):
    """The changes of every micro-batch of a stream with ``at`` and ``revenue``: their schema, and how to start it."""
    write = _change_writer(rows.sparkSession, wd, lateness)
    return _CHANGES, lambda: (rows.writeStream.outputMode("append").foreachBatch(write)
                              .option("checkpointLocation", f"{wd}/ckpt").trigger(availableNow=True).start())


def stream_weekly_revenue(spark: SparkSession, sf_dir: str, lateness: str = "28 days", **source) -> DataFrame:
    """7-day tumbling revenue windows of the clean campaigns, from the changes of each batch;
    late rows are added on reading."""
    wd = _workdir(spark, "weekly_revenue")
    write = _change_writer(spark, wd, lateness)
    campaign_days(spark, sf_dir, wd, lambda days, epoch, mode: write(
        clean_stream(days).select(_midnight("date").alias("at"), "revenue"), epoch, mode), **source)
    return weekly_totals(spark, wd, _CHANGES)


def weekly_totals(spark: SparkSession, wd: str, schema: str) -> DataFrame:
    return (spark.read.schema(schema).parquet(f"{wd}/out").groupBy("window_start", "window_end")
            .agg(dbl(F.sum("revenue")).alias("revenue"), F.sum("rows").alias("rows")))


def stream_dedup(spark: SparkSession, sf_dir: str, **source) -> DataFrame:
    """Drop double-loaded campaign rows. A day's rows wait until the watermark passes it, so
    copies may come in any batch until then; they meet when the day leaves."""
    wd = _workdir(spark, "dedup")
    schema = ", ".join(f"{c} {kind}" for c, kind in campaigns(spark, sf_dir, keyed=True).drop("cid").dtypes)
    _sink(spark, schema, f"{wd}/out/epoch=-1")

    def emit(days: DataFrame, epoch: int, mode: str) -> None:
        (days.dropDuplicates(days.columns).drop("cid")
         .write.mode(mode).option("compression", "zstd").parquet(f"{wd}/out/epoch={epoch}"))

    campaign_days(spark, sf_dir, wd, emit, **source)
    return spark.read.schema(f"{schema}, epoch bigint").parquet(f"{wd}/out").drop("epoch")


def stream_enrich(transactions: DataFrame, customers: DataFrame, wait: str = DELAY, delay: str = DELAY,
                  one_batch: bool = False) -> DataFrame:
    """Two streams, transactions and the customers they name, joined in whatever order they come.

    A transaction whose customer is known, or comes within ``wait`` of it, leaves
    with the customer's channel and plan; until then it is in quarantine, in the
    state of a stream-stream left outer join. When the watermark (``delay`` behind
    the earlier stream) passes its time and ``wait``, it leaves as an orphan, and so
    do customers that no transaction can name any more leave the state. Transactions
    without an id are marked at once. Of customers with the same id the first counts;
    a known customer without a channel is known. Both streams are drained and closed
    by a row that moves the watermark beyond every wait; ``one_batch`` tells that all
    they hold comes in one batch (files without a limit per trigger)."""
    spark = transactions.sparkSession
    wd = _workdir(spark, "enrich")
    t = ClosedStream(transactions.select("transaction_id", "customer_id", "transaction_date", dbl("amount").alias("amount"),
                                         _midnight("transaction_date").alias("t_time")), "t_time", delay, f"{wd}/close/tx")
    c = ClosedStream(customers.select(F.col("customer_id").alias("c_id"), "acquisition_channel", "subscription_plan",
                                      _midnight("acquisition_date").alias("c_time")), "c_time", delay, f"{wd}/close/cu")
    tx, cu = t.df, c.df
    end = F.lit(CLOSING).cast("timestamp")
    # every filter keeps the closing row, which the watermarks behind it must see; its NULL id joins nothing
    known = cu.filter(F.col("c_id").isNotNull() | (F.col("c_time") >= end)).dropDuplicates(["c_id"])
    joined = tx.filter(F.col("customer_id").isNotNull() | (F.col("t_time") >= end)).join(
        known, F.expr(f"customer_id = c_id AND c_time <= t_time + INTERVAL {wait} AND c_time >= t_time - INTERVAL {wait}"),
        "left_outer").withColumn("status", F.when(F.col("c_id").isNull(), "orphan").otherwise("ok"))
    nameless = tx.filter(F.col("customer_id").isNull() & (F.col("t_time") < end)).select(
        "*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in known.schema.fields], F.lit("missing_customer_id").alias("status"))
    out = joined.unionByName(nameless).select("transaction_id", "customer_id", "transaction_date", "amount",
                                              "acquisition_channel", "subscription_plan", "status")

    _drain(_to_parquet(out, wd), [t, c], one_batch)
    return spark.read.schema(out.schema).parquet(f"{wd}/out")
