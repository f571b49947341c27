"""R4 .. R7 keep every row over many micro-batches, whatever the order."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from adpulse.streaming import jobs as J

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def shuffled(spark, tmp_path_factory):
    """The tables with lineitem and customer as six files each, rows in no order."""
    d = tmp_path_factory.mktemp("sf")
    for t in ("lineitem", "customer"):
        spark.read.parquet(f"{SF}/{t}.parquet").repartition(6, F.rand(3)).write.parquet(f"{d}/{t}.parquet")
    for t in ("orders", "part", "nation", "region"):
        spark.read.parquet(f"{SF}/{t}.parquet").write.parquet(f"{d}/{t}.parquet")
    return str(d)


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_dedup_and_kpis_over_six_batches(spark, shuffled):
    from adpulse.sources.fixtures import campaigns
    want = campaigns(spark, SF).distinct()
    out = J.stream_dedup(spark, shuffled, files_per_batch=1)
    assert rows(out) == rows(want.select(*out.columns)) and want.count() < campaigns(spark, SF).count()
    kpis = J.stream_channel_kpis(spark, shuffled, files_per_batch=1)
    batch = E.queries()["m3_by_channel"](spark, SF)
    assert rows(kpis.select("channel", F.round("spend", 6), F.round("roas", 6))) == rows(
        batch.select("channel", F.round("spend", 6), F.round("roas", 6)))


def test_weekly_revenue_over_six_batches(spark, shuffled):
    want = E.queries()["r5_stream_weekly_revenue"](spark, SF)
    assert rows(J.stream_weekly_revenue(spark, shuffled, files_per_batch=1)) == rows(want)


def feed(spark, tmp_path, batches):
    """A file stream whose files are ``batches``, in order."""
    schema = batches[0].schema
    for i, b in enumerate(batches):
        b.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")


def test_late_rows_go_to_their_side_and_count(spark, tmp_path):
    r = random.Random(5)
    data = [(date(2020, 1, 1) + timedelta(days=r.randint(0, 400)), r.randint(1, 99)) for _ in range(600)]
    parts = [spark.createDataFrame(data[i::6], "d date, revenue int").select(
        J._midnight("d").alias("at"), F.col("revenue").cast("decimal(12,2)").alias("revenue")) for i in range(6)]
    wd = f"{tmp_path}/job"
    schema, start = J.weekly_changes(feed(spark, tmp_path, parts), wd, "28 days")
    q = start()
    q.awaitTermination()
    changes = spark.read.schema(schema).parquet(f"{wd}/out").collect()
    assert len({c.epoch for c in changes}) == 6 and any(c.late for c in changes) and not any(c.late for c in changes if c.epoch == 0)
    newest = {}
    for c in changes:
        newest[c.epoch] = max(newest.get(c.epoch, c.newest), c.newest)
    for c in changes:  # late exactly when its window had been closed by earlier batches
        before = [n for e, n in newest.items() if e < c.epoch]
        assert c.late == bool(before and c.window_end <= (max(before) - timedelta(days=28)).date())
    want = {}
    for d, v in data:
        w = date.fromordinal(date(1970, 1, 1).toordinal() + (d - date(1970, 1, 1)).days // 7 * 7)
        want[w] = (want.get(w, (0, 0))[0] + v, want.get(w, (0, 0))[1] + 1)
    got = {x.window_start: (x.revenue, x.rows) for x in J.weekly_totals(spark, wd, schema).collect()}
    assert got == want
    assert max(sum(c.epoch == e for c in changes) for e in newest) <= len(want)  # a row per window and batch


TX = "transaction_id bigint, customer_id bigint, transaction_date date, amount decimal(12,2)"
CU = "customer_id bigint, acquisition_channel string, subscription_plan string, acquisition_date date"


def enriched(spark, tmp_path, tx_batches, cu_batches, **kw):
    tx = feed(spark, tmp_path / "tx", [spark.createDataFrame(b, TX) for b in tx_batches])
    cu = feed(spark, tmp_path / "cu", [spark.createDataFrame(b, CU) for b in cu_batches])
    return sorted(((x.transaction_id, x.status, x.acquisition_channel) for x in J.stream_enrich(tx, cu, **kw).collect()))


@pytest.mark.parametrize("early", [True, False])
def test_customers_may_come_before_or_after_their_transactions(spark, tmp_path, early):
    d = lambda k: date(2021, 1, 1) + timedelta(days=k)
    from decimal import Decimal
    tx = [(i, [1, 2, 3, None, 77][i % 5], d(i), Decimal(i)) for i in range(30)]
    cu = [(1, "Email", "Free", d(3)), (2, None, "Basic", d(1)), (3, "TikTok", "Free", d(40)), (3, "again", "Free", d(40)),
          (None, "x", "y", d(2)), (5, "Email", "Free", d(9))]
    first = [cu[:4], cu[4:]] if early else [[c] for c in reversed(cu[:3])] + [cu[4:]]
    want = [(i, {1: "ok", 2: "ok", 3: "ok", None: "missing_customer_id", 77: "orphan"}[c], {1: "Email", 3: "TikTok"}.get(c))
            for i, c, *_ in tx]
    if early:
        got = enriched(spark, tmp_path, [tx[:10], tx[10:]], first)
    else:
        got = enriched(spark, tmp_path, [tx[20:], tx[10:20], tx[:10]], first)
    assert got == sorted(want)


def test_waiting_ends_with_the_watermark(spark, tmp_path):
    """A customer more than ``wait`` after the transaction is too late for it."""
    from decimal import Decimal
    d = lambda k: date(2021, 1, 1) + timedelta(days=k)
    tx = [(1, 1, d(0), Decimal(1)), (2, 1, d(50), Decimal(1)), (3, 2, d(60), Decimal(1))]
    cu = [(1, "Email", "Free", d(45)), (2, "SMS", "Free", d(61))]
    assert enriched(spark, tmp_path, [tx], [cu], wait="30 days", delay="100 days") == [(1, "orphan", None), (2, "ok", "Email"), (3, "ok", "SMS")]


def test_clean_transactions_is_one_lazy_plan(spark):
    """No job runs while the plan is built, and lineitem is scanned once."""
    query = E.queries()["q_clean_transactions"]
    query(spark, E.SMOKE_DIR)  # the reader's own footer job is out of the way
    sc = spark.sparkContext
    sc.setJobGroup("building", "plan only")
    out = query(spark, E.SMOKE_DIR)
    assert len(sc.statusTracker().getJobIdsForGroup("building")) == 0
    sc.setLocalProperty("spark.jobGroup.id", None)
    scans = [f for f in out._jdf.queryExecution().optimizedPlan().toString().split("\n") if "l_partkey" in f and "Relation" in f]
    assert len(scans) == 1
