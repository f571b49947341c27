"""Sharding by a Feistel permutation of global row numbers.

Rows get consecutive global numbers in the order of the given columns. A
Feistel network, a keyed bijection on ``[0, 4**h)``, permutes the numbers;
values outside ``[0, n)`` are walked along their cycle until they fall inside,
which leaves a bijection on ``[0, n)``. The permuted number ``p`` is the row's
place in a reproducible shuffle: shard ``p % shards``, slot ``p // shards``.
Shard sizes differ by at most one row and anybody who knows a row's number, the
total and the seed can compute its place, or invert it.

Numbering sorts only the columns it is given (never the text), by range
partitions; the driver sees one count per partition.

Defined results: null keys sort first and are numbered like any other; equal
rows get consecutive numbers in either order, which gives the same set of rows;
an empty table gives an empty result. Names starting with ``_fs_`` are reserved.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adpulse.llm.common import checkpointed

#: Field of the round function: all products stay below 2**62.
PRIME = 2_147_483_647
ROUNDS = 6


def round_keys(seed: int, rounds: int = ROUNDS) -> list[tuple[int, int, int]]:
    """(addend, multiplier, addend) of every round, drawn from the seed."""
    state, keys = seed % PRIME, []
    for _ in range(rounds):
        three = []
        for _ in range(3):
            state = (state * 48_271 + 11) % PRIME
            three.append(1 + state % (PRIME - 1))
        keys.append(tuple(three))
    return keys


def half_bits(n: int) -> int:
    """Bits of each half of the smallest even-width domain that holds 0..n-1."""
    return max(1, (max(n - 1, 1).bit_length() + 1) // 2)


def feistel(x: np.ndarray, bits: int, keys: list[tuple[int, int, int]], inverse: bool = False) -> np.ndarray:
    """The keyed bijection on ``[0, 4**bits)``; ``inverse`` undoes it."""
    mask = (1 << bits) - 1
    left, right = x >> bits, x & mask
    if inverse:
        left, right = right, left
    for a, m, b in (reversed(keys) if inverse else keys):
        t = (right + a) % PRIME
        t = ((t * t) % PRIME * m + b) % PRIME
        left, right = right, left ^ ((t ^ (t >> 11)) & mask)
    if inverse:
        left, right = right, left
    return (left << bits) | right


def permute(x: np.ndarray, n: int, seed: int, inverse: bool = False) -> np.ndarray:
    """The permutation of ``[0, n)``: Feistel steps until every value is below n."""
    keys, bits = round_keys(seed), half_bits(n)
    out = feistel(np.asarray(x, dtype=np.int64), bits, keys, inverse)
    while (over := out >= n).any():
        out[over] = feistel(out[over], bits, keys, inverse)
    return out


def permute_col(number: Column, n: int, seed: int) -> Column:
    @F.pandas_udf(T.LongType())
    def walk(batch: pd.Series) -> pd.Series:
        return pd.Series(permute(batch.to_numpy(), n, seed))
    return walk(number)


def number_rows(df: DataFrame, order: list[str], name: str) -> tuple[DataFrame, int]:
    """``df`` with consecutive numbers from 0 in ``order``, and how many there are.

    The range-partitioned rows are checkpointed before they are counted, so
    that counts and numbers speak of the same partitions whatever is recomputed.
    """
    spark = df.sparkSession
    ranged = checkpointed(df.repartitionByRange(*order).sortWithinPartitions(*order))
    at = F.monotonically_increasing_id()
    counts = {r[0]: r[1] for r in ranged.groupBy(F.spark_partition_id()).count().collect()}
    offsets, total = [], 0
    for part in sorted(counts):
        offsets.append((part, total))
        total += counts[part]
    if not total:
        return ranged.withColumn(name, at), 0
    # one row per partition of the numbered table
    starts = F.broadcast(spark.createDataFrame(offsets, "_fs_part int, _fs_start long"))
    out = (ranged.withColumn("_fs_part", F.spark_partition_id())
           .withColumn("_fs_row", at.bitwiseAND(F.lit((1 << 33) - 1)))
           .join(starts, "_fs_part")
           .withColumn(name, F.col("_fs_start") + F.col("_fs_row")))
    return out.drop("_fs_part", "_fs_row", "_fs_start"), total


def feistel_shards(df: DataFrame, order: list[str], shards: int, seed: int = 42) -> DataFrame:
    """``df`` with ``row_number``, ``position``, ``shard`` and ``slot`` appended."""
    numbered, n = number_rows(df, order, "row_number")
    out = numbered.withColumn("position", permute_col(F.col("row_number"), n, seed))
    return (out.withColumn("shard", (F.col("position") % shards).cast("int"))
            .withColumn("slot", F.expr(f"position div {shards}L")))
