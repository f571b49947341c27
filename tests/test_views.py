"""The shared views (M9, C17, F8) hold what their operators return alone."""

import __spark_entry__ as E
from adpulse.operators import customers as cu
from adpulse.operators import finance as fi
from adpulse.operators import marketing as mk
from adpulse.plans.registry import QUERIES, _b, normalize_types


def same(a, b):
    a, b = normalize_types(a), normalize_types(b)
    assert a.columns == b.columns and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_views_equal_their_parts(spark):
    from adpulse.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    sf = E.SMOKE_DIR
    bundle = _b(spark, sf)
    view = cu.build(bundle)
    same(view["segments"], QUERIES["c8_segment_summary"](spark, sf))
    same(view["cohorts"], QUERIES["c10_cohort_retention"](spark, sf))
    same(view["value_by_plan"], QUERIES["c15_value_by_plan"](spark, sf))
    money = fi.build(bundle)
    names = {k.lower(): k for k in money}
    found = next(money[names[k]] for k in ("profitability", "channel_profitability") if k in names)
    same(found, QUERIES["f4_profitability"](spark, sf))
    ads = mk.build(bundle)
    assert all(df.count() >= 0 for df in ads.values() if df is not None)
    spark.catalog.clearCache()
