"""Helpers shared by the operators: table access, shared folder, word rules."""

from __future__ import annotations

import ctypes
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adpulse.session import ship_package

#: Words are runs of anything but space and the control characters tab to CR.
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Only a ``local[...]`` session may go without the setting: there one machine
    is the whole cluster and a scratch folder is made. Anywhere else a missing
    setting is an error, since executors would write to their own disks.
    """
    sc = spark.sparkContext
    found = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        found = tempfile.mkdtemp(prefix="adpulse-shared-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(found)
    return found


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder, its lineage cut."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def words(text: Column) -> Column:
    """Array of the words of a text; a null text has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({WORD})"), F.lit(0))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and leave every other letter alone."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())


def release_memory() -> None:
    """Gives the memory that a Python worker holds but no longer uses back to the machine:
    a worker stays for later tasks, beside those of other stages."""
    import pyarrow

    pyarrow.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def released_pair(function):
    """``function`` of two groups, after which the worker's free memory is given back."""
    def run(left, right):
        try:
            return function(left, right)
        finally:
            release_memory()
    return run


def released_after(function):
    """The same for a generator over a partition's batches."""
    def run(batches):
        try:
            yield from function(batches)
        finally:
            release_memory()
    return run


def free_names(columns: list[str], taken: list[str]) -> dict[str, str]:
    """New names for ``columns``: one that an operator gives to a result (whatever its
    case) gets ``_in`` appended until it is free, the others keep theirs."""
    used = {c.lower() for c in taken}
    names = {}
    for c in columns:
        name = c
        while name.lower() in used:
            name += "_in"
        used.add(name.lower())
        names[c] = name
    return names
