"""The steps that grow with the tables: partitions follow the rows, passes are shared."""

import random
import re

from adpulse.plans import replay as R
from adpulse.sources import fixtures as X
from adpulse.sources.bundle import load_bundle
from tests.test_replay import make_bundle

SF = "/root/testdata/sf0.001"


def test_campaigns_lie_in_partitions_of_a_bounded_number_of_rows(spark, monkeypatch):
    want = sorted(map(str, X.campaigns(spark, SF).collect()))
    monkeypatch.setattr(X, "ROWS_PER_PARTITION", 500)
    monkeypatch.setattr(X, "_PARTITIONS", {})
    rows = X.read_table(spark, SF, "lineitem").count()
    raw = X.campaigns(spark, SF)
    assert raw.rdd.getNumPartitions() == -(-rows // 500)
    assert sorted(map(str, raw.collect())) == want
    # the audit's de-duplication takes them as they lie
    clean = load_bundle(spark, SF, tables=("campaigns",)).campaigns
    assert clean.rdd.getNumPartitions() == -(-rows // 500)


def test_quarantine_holds_every_removed_copy_and_bad_rows_beside_them(spark):
    from adpulse.operators.quality import audit
    raw = X.campaigns(spark, SF).limit(3).withColumn("spend", (-X.F.abs("spend") - 1).cast("decimal(28,4)")).localCheckpoint()
    got = audit({"campaigns": raw.union(raw).union(raw)}).quarantine.groupBy("rule_key").count().collect()
    assert {x[0]: x[1] for x in got} == {"duplicate_rows": 6, "negative_spend": 3}


def test_cohorts_read_the_transactions_once(spark):
    bundle, *_ = make_bundle(spark, random.Random(6), customers=320)
    plan = R.replay_cohorts(bundle)._jdf.queryExecution().optimizedPlan().toString()
    assert "transaction_date" not in plan and "refund_flag" not in plan


def test_header_takes_every_span_from_one_pass(spark):
    from adpulse.plans.snapshot import snapshot_header
    plan = snapshot_header(load_bundle(spark, SF))._jdf.queryExecution().analyzed().toString()
    assert len(set(re.findall(r"scalar-subquery#\d+", plan))) == 1


def test_modules_read_stored_columns_of_the_clean_tables(spark):
    from adpulse.plans.snapshot import snapshot_modules
    plan = snapshot_modules(load_bundle(spark, SF))._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" not in plan and "l_suppkey" not in plan and "c_custkey" not in plan


def test_streams_of_one_batch_go_through_their_state_twice(spark, monkeypatch, tmp_path):
    from adpulse.streaming import jobs as J
    monkeypatch.setattr(J, "_workdir", lambda spark, name: f"{tmp_path}/{name}")
    for job, query in (("dedup", J.stream_dedup), ("channel_kpis", J.stream_channel_kpis), ("weekly_revenue", J.stream_weekly_revenue)):
        query(spark, SF)
        assert len([f for f in (tmp_path / job / "ckpt" / "commits").iterdir() if f.name.isdigit()]) == 2
