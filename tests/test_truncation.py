"""Replay cursors: every module either returns tables or a status row (never
an exception), no KPI is NaN, and the slice at the last date equals the
unsliced result (convergence)."""
import math

import pytest

from adpulse.operators import finance as fi
from adpulse.operators import marketing as mk
from adpulse.plans.snapshot import build_snapshot, snapshot_status
from adpulse.sources.bundle import load_bundle

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def bundle(spark):
    return load_bundle(spark, SF)


@pytest.mark.parametrize("cursor", ["1994-12-31", "1995-02-15", "1997-06-30", "2030-01-01"])
def test_cursor_sweep_statuses_and_no_nan(spark, bundle, cursor):
    b = bundle.as_of(cursor)
    st = {r.module: r.status for r in snapshot_status(b, b.params).collect()}
    assert set(st.values()) <= {"ok", "unavailable", "insufficient_data"}
    if cursor == "1994-12-31":   # before any data
        assert st["marketing"] == "unavailable" and st["forecast"] == "unavailable"
    if st["marketing"] == "ok" and st["customers"] == "ok" and st["finance"] == "ok":
        snap = build_snapshot(b, b.params)
        for name, df in snap.items():
            for row in df.collect():
                for v in row:
                    assert not (isinstance(v, float) and math.isnan(v)), (cursor, name, row)


def test_slice_at_end_converges_to_static(spark, bundle):
    end = bundle.tables["transactions"].agg({"transaction_date": "max"}).first()[0]
    ends = [bundle.tables[t].agg({c: "max"}).first()[0] for t, c in
            (("campaigns", "date"), ("customers", "acquisition_date"), ("ab_test", "date"))]
    last = max([end] + ends)
    sliced = bundle.as_of(last)
    a = {r.channel: tuple(r) for r in mk.groupby_kpis(bundle.campaigns, "channel").collect()}
    b = {r.channel: tuple(r) for r in mk.groupby_kpis(sliced.campaigns, "channel").collect()}
    assert a == b
    k1 = [tuple(r) for r in fi.headline_kpis(bundle.campaigns, bundle.customers, bundle.transactions).collect()]
    k2 = [tuple(r) for r in fi.headline_kpis(sliced.campaigns, sliced.customers, sliced.transactions).collect()]
    assert k1 == k2


def test_parallel_snapshot_equals_sequential(spark, bundle):
    from adpulse.plans.snapshot import build_snapshot, collect_snapshot
    seq = {k: sorted(map(str, df.collect())) for k, df in build_snapshot(bundle, bundle.params).items()}
    par = collect_snapshot(build_snapshot(bundle, bundle.params, parallel=4), parallel=4)
    assert {k: sorted(map(str, v)) for k, v in par.items()} == seq
