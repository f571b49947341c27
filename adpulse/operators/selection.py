"""k-th smallest elements without a sort, by narrowing histograms.

Rows carry an order key of one or more whole numbers (digits, most significant
first) and the ticks ``[from, to)`` during which they count. For queries "at tick
``t``, which key has the ``m`` smallest rows up to it?" each pass counts the rows
of the ranges still in question into at most ``width`` narrower ranges per query,
as changes per tick, and keeps the range that holds the ``m``-th row. The last
pass ends in an exact key. A pass is one aggregation with a bounded result: one row
per query reaches the driver, whatever the number of rows; a value shared by many
rows is one partially aggregated count, and its ties go on to the next digit.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Ranges per query and pass.
WIDTH = 1 << 12
#: Bytes of a string in one digit, and the unit that parts a wide decimal into two.
_CHUNK = 7
_HALF = 10 ** 15


def order_digits(df: DataFrame, column: str) -> list[Column]:
    """Whole numbers whose order is the column's own (a null comes first)."""
    kind, c = df.schema[column].dataType, F.col(column)
    if isinstance(kind, T.StringType):
        longest = df.agg(F.max(F.octet_length(c))).first()[0] or 0
        data = F.hex(F.encode(F.coalesce(c, F.lit("")), "UTF-8"))
        chunks = [F.conv(F.rpad(F.substring(data, F.lit(2 * i + 1), F.lit(2 * _CHUNK)), 2 * _CHUNK, "0"), 16, 10).cast("bigint")
                  for i in range(0, longest, _CHUNK)]
        return [*chunks, F.coalesce(F.octet_length(c), F.lit(-1)).cast("bigint")]
    if isinstance(kind, T.DecimalType):
        whole = (c * F.lit(10 ** kind.scale)).cast("decimal(38,0)")
        if kind.precision <= 18:
            return [whole.cast("bigint")]
        high = F.floor(whole / F.lit(_HALF)).cast("bigint")
        return [high, (whole - high.cast("decimal(38,0)") * F.lit(_HALF)).cast("bigint")]
    if isinstance(kind, T.DateType):
        return [F.unix_date(c).cast("bigint")]
    return [c.cast("bigint")]


def past(digits: list[Column], bound: tuple[int, ...]) -> Column:
    """Whether a row's key lies above ``bound``."""
    out = F.lit(False)
    for d, b in zip(reversed(digits), reversed(bound), strict=True):
        out = (d > b) | ((d == b) & out)
    return out


def _start(digit: str, least: int, size: int) -> Column:
    """The beginning of the range of ``size`` numbers, counted from ``least``, that holds the digit."""
    if size >= 1 << 62:
        return F.lit(least).cast("bigint")
    return F.expr(f"{least}L + ((`{digit}` - {least}L) div {size}L) * {size}L")


def _pick(queries: dict[int, list[tuple[int, int, int]]], ticks: int):
    """Of one range in question: for each query the narrower range that holds its row."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        sub, at = np.unique(rows["sub"].to_numpy(np.int64), return_inverse=True)
        count = np.zeros((len(sub), ticks), np.int64)
        np.add.at(count, (at, rows["tick"].to_numpy(np.int64)), rows["n"].to_numpy(np.int64))
        up_to = count.cumsum(axis=1).cumsum(axis=0)
        out = []
        for t, j, m in queries[int(rows["grp"].iloc[0])]:
            i = int(np.searchsorted(up_to[:, t], m))
            out.append((t, j, int(sub[i]), m - int(up_to[i - 1, t] if i else 0)))
        return pd.DataFrame(out, columns=["t", "j", "sub", "m"])
    return run


def kth_keys(rows: DataFrame, digits: list[str], queries: list[tuple[int, int, int]], ticks: int = 1,
             begin: str | None = None, end: str | None = None, width: int = WIDTH) -> dict[tuple[int, int], tuple[int, ...]]:
    """For queries ``(t, j, m)`` the key (its digits) of the ``m``-th smallest row that counts at tick
    ``t``, under ``(t, j)``. ``digits`` name bigint columns; ``begin`` and ``end`` the tick columns."""
    if not queries:
        return {}
    spark = rows.sparkSession
    bounds = rows.agg(*[f(F.col(d)) for d in digits for f in (F.min, F.max)]).first()
    keys = rows.select(*[F.coalesce(F.col(d), F.lit(bounds[2 * i] - 1)).alias(f"d{i}") for i, d in enumerate(digits)],
                       (F.col(begin) if begin else F.lit(0)).cast("int").alias("begin"),
                       (F.col(end) if end else F.lit(ticks)).cast("int").alias("end"))
    found = {(t, j): () for t, j, _ in queries}
    rank = {(t, j): m for t, j, m in queries}
    for i in range(len(digits)):
        least, size = bounds[2 * i] - 1, 1
        while size < bounds[2 * i + 1] - least + 1:
            size *= width
        low = dict.fromkeys(found, least)
        while size > 1:
            step = size // width  # ranges nest: each is cut into ``width`` equal ones
            groups = defaultdict(list)
            for q, prefix in found.items():
                groups[(*prefix, low[q])].append((*q, rank[q]))
            asked = [(g, *k) for g, k in enumerate(groups)]
            names = [*[f"d{k}" for k in range(i)], "low"]
            schema = "grp int, " + ", ".join(f"{n} bigint" for n in names)
            start = _start(f"d{i}", least, size)
            in_question = (keys.withColumn("low", start)
                           .join(F.broadcast(spark.createDataFrame(asked, schema)), names)  # a row per query at most
                           .withColumn("sub", F.expr(f"(d{i} - low) div {step}L")))
            change = F.explode(F.array(F.struct(F.col("begin").alias("tick"), F.lit(1).alias("n")),
                                       F.struct(F.col("end").alias("tick"), F.lit(-1).alias("n"))))
            counts = (in_question.select("grp", "sub", change.alias("c")).where(F.col("c.tick") < ticks)
                      .groupBy("grp", "sub", F.col("c.tick").alias("tick")).agg(F.sum("c.n").alias("n")))
            picked = counts.groupBy("grp").applyInPandas(_pick(dict(enumerate(groups.values())), ticks),
                                                         "t int, j int, sub bigint, m bigint")
            for t, j, sub, m in picked.collect():
                low[t, j] += sub * step
                rank[t, j] = m
            size = step
        found = {q: (*prefix, low[q]) for q, prefix in found.items()}
    return found
