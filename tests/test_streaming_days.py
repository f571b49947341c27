"""R4 .. R6 keep their open days in files, not in the executors' state."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from adpulse.sources import fixtures as X
from adpulse.sources.bundle import load_bundle
from adpulse.streaming import jobs as J

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def job_folder(monkeypatch, tmp_path):
    monkeypatch.setattr(J, "_workdir", lambda spark, name: f"{tmp_path}/{name}")
    return tmp_path


@pytest.fixture(scope="module")
def undated(spark, tmp_path_factory):
    """The tables with some lines that have no day, in four files."""
    d = str(tmp_path_factory.mktemp("undated"))
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    lines.withColumn("l_shipdate", F.when(F.col("l_orderkey") % 5 > 0, F.col("l_shipdate"))).repartition(4, F.rand(1)).write.parquet(f"{d}/lineitem.parquet")
    return d


def lines_by_batch(spark, sf, batches):
    """``batches`` of (supplier, day, quantity) as files in this order."""
    for b in batches:
        spark.createDataFrame([(1, s, 1, float(q), 10.0, 0.0, 0.1, d) for s, d, q in b],
                              "l_orderkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                              "l_discount double, l_tax double, l_shipdate date").coalesce(1).write.mode("append").parquet(f"{sf}/lineitem.parquet")


def drained(spark, sf, wd, **kw):
    """What has left, as (batch, supplier, day, clicks)."""

    def emit(days, epoch, mode):
        days.write.mode(mode).parquet(f"{wd}/left/epoch={epoch}")

    J.campaign_days(spark, sf, wd, emit, files_per_batch=1, **kw)
    left = spark.read.parquet(f"{wd}/left").select("epoch", "cid", "date", "clicks").collect()
    return sorted(map(tuple, left), key=str)


def weeks(spark, sf):
    """Revenue and rows of the clean campaigns by 7-day window, from the batch."""
    day = lambda n: F.date_from_unix_date((F.floor(F.unix_date("date") / 7) * 7 + n).cast("int"))
    return load_bundle(spark, sf, tables=("campaigns",)).campaigns.groupBy(day(0).alias("window_start"), day(7).alias("window_end")).agg(
        F.sum("revenue").cast("double").alias("revenue"), F.count("*").alias("rows"))


def test_channel_kpis_hold_no_state(spark, monkeypatch, tmp_path):
    wd = job_folder(monkeypatch, tmp_path) / "channel_kpis"
    want = E.queries()["m3_by_channel"](spark, SF).select("channel", "clicks", "spend", "revenue")
    monkeypatch.setattr(X, "ROWS_PER_PARTITION", 200)  # several ranges of days
    assert rows(J.stream_channel_kpis(spark, SF).select(*want.columns)) == rows(want)
    assert not (wd / "ckpt" / "state").exists()
    assert len(spark.read.parquet(f"{wd}/out").select("week", "channel").collect()) == spark.read.parquet(f"{wd}/out").select("week", "channel").distinct().count()


def test_channel_kpis_have_the_lines_without_a_day(spark, undated):
    want = E.queries()["m3_by_channel"](spark, undated).select("channel", "clicks", "conversions", "spend", "revenue")
    assert rows(J.stream_channel_kpis(spark, undated).select(*want.columns)) == rows(want)
    assert rows(J.stream_channel_kpis(spark, undated, files_per_batch=1).select(*want.columns)) == rows(want)


def test_a_day_leaves_once_and_whole_when_the_watermark_passes_it(spark, tmp_path):
    d = lambda k: date(2020, 1, 1) + timedelta(days=k)
    sf, wd = f"{tmp_path}/sf", f"{tmp_path}/job"
    lines_by_batch(spark, sf, [
        [(1, d(0), 1), (1, d(20), 2), (2, None, 3)],
        [(1, d(0), 10), (1, d(20), 20), (2, d(40), 1)],  # the mark comes to day 10: day 0 leaves
        [(1, d(0), 100), (1, d(11), 7), (1, d(45), 1)],  # day 0 is gone, day 11 is open and leaves now
        [(2, d(90), 1), (2, None, 30)],
    ])
    got = drained(spark, sf, wd, delay="30 days")
    assert got == sorted([(1, 1, d(0), 11), (2, 1, d(11), 7), (3, 1, d(20), 22), (3, 1, d(45), 1), (3, 2, d(40), 1),
                          (4, 2, d(90), 1), (4, 2, None, 33)], key=str)
    # batches 1 and 2 had left with batch 3 and were removed by batch 4
    assert sorted(p.name for p in (tmp_path / "job" / "open").iterdir()) == ["epoch=0", "epoch=3", "epoch=4"]


def test_a_repeated_batch_changes_nothing(spark, undated, tmp_path):
    wd = f"{tmp_path}/job"
    first = drained(spark, undated, wd)
    commits = tmp_path / "job" / "ckpt" / "commits"
    last = max(int(p.name) for p in commits.iterdir() if p.name.isdigit())
    (commits / str(last)).unlink()
    (commits / f".{last}.crc").unlink(missing_ok=True)
    assert drained(spark, undated, wd) == first and len(first) > 1000


def test_weekly_revenue_holds_no_state(spark, monkeypatch, tmp_path):
    wd = job_folder(monkeypatch, tmp_path) / "weekly_revenue"
    want = weeks(spark, SF)
    monkeypatch.setattr(X, "ROWS_PER_PARTITION", 200)
    got = J.stream_weekly_revenue(spark, SF)
    assert rows(got) == rows(want)
    assert not (wd / "ckpt" / "state").exists()
    changes = spark.read.schema(J._CHANGES).parquet(f"{wd}/out")
    assert changes.count() == changes.select("epoch", "window_start").distinct().count() > 50  # a row per window and batch


def test_weekly_revenue_has_the_lines_without_a_day(spark, undated):
    want = weeks(spark, undated)
    assert any(x.window_start is None for x in want.collect())
    assert rows(J.stream_weekly_revenue(spark, undated)) == rows(want)
    assert rows(J.stream_weekly_revenue(spark, undated, files_per_batch=1)) == rows(want)


def test_dedup_holds_no_state(spark, monkeypatch, tmp_path):
    wd = job_folder(monkeypatch, tmp_path) / "dedup"
    want = X.campaigns(spark, SF).distinct()
    want, columns = rows(want), want.columns
    monkeypatch.setattr(X, "ROWS_PER_PARTITION", 200)
    got = J.stream_dedup(spark, SF)
    assert got.columns == columns and rows(got) == want
    assert not (wd / "ckpt" / "state").exists()


def test_dedup_has_the_lines_without_a_day(spark, undated):
    want = rows(X.campaigns(spark, undated).distinct())
    assert any("date=None" in x for x in want)
    assert rows(J.stream_dedup(spark, undated)) == want
    assert rows(J.stream_dedup(spark, undated, files_per_batch=1)) == want


def test_dedup_shuffles_a_day_once(spark):
    days = X.campaigns(spark, SF, keyed=True)
    plan = days.dropDuplicates(days.columns)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
