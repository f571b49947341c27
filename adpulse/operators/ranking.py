"""Global ranks without pulling every row into one partition (4.3).

``row_number() OVER (ORDER BY x)`` with no PARTITION BY runs in a single
task. Instead: range-partition on the full (unique) sort key, sort inside
each partition, number the rows, and add the row count of all earlier
partitions. The numbered data is checkpointed reliably (to
``spark.checkpoint.dir``) so a lost executor cannot renumber rows after the
per-partition counts were taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from adpulse.session import ensure_checkpoint_dir

_IDX_BITS = 33  # monotonically_increasing_id = partition index << 33 | row index


def global_rank(df: DataFrame, order: list[Column], rank_col: str = "rank",
                partitions: int | None = None) -> DataFrame:
    """Add ``rank_col`` = 1-based position of each row in ``order``.

    ``order`` must be a total order (end it with a unique key); then the rank
    is the global ``row_number`` and ties of the leading column are split by
    the range partitioner, so a hot value cannot overload one task.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    if partitions is None:
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    numbered = (df.repartitionByRange(partitions, *order)
                .sortWithinPartitions(*order)
                .withColumn("_mid", F.monotonically_increasing_id())
                .checkpoint(eager=True))
    numbered = numbered.select("*", F.shiftright("_mid", _IDX_BITS).alias("_pid"),
                               F.col("_mid").bitwiseAND(F.lit((1 << _IDX_BITS) - 1)).alias("_idx"))
    # one row per partition: bounded by the partition count, safe to broadcast
    counts = numbered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    return (numbered.join(F.broadcast(offsets), "_pid")
            .withColumn(rank_col, F.col("_off") + F.col("_idx") + 1)
            .drop("_mid", "_pid", "_idx", "_off"))


def quantile_bin_of_rank(rank: Column, n: Column, bins: int) -> Column:
    """Bin (1..bins) that equal-frequency quantile binning of the distinct
    values 1..n gives to ``rank``: max(1, ceil((rank-1)*bins/(n-1))), in exact
    integer arithmetic."""
    num = (rank - 1) * bins
    den = n - 1
    ceil_div = F.when(den <= 0, F.lit(1)).otherwise(F.floor((num + den - 1) / den))
    return F.greatest(F.lit(1), ceil_div).cast("int")


def ntile_of_rank(rank: Column, n: Column, buckets: int) -> Column:
    """NTILE(buckets) for a row at 1-based position ``rank`` among ``n``:
    the first n mod buckets tiles hold one extra row."""
    q = F.floor(n / buckets)
    r = n - q * buckets
    big = r * (q + 1)
    return F.when(rank <= big, F.ceil(rank / (q + 1))).otherwise(
        r + F.ceil((rank - big) / q)).cast("int")
