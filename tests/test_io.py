"""Sources and sinks: typed CSV, partial inputs, partitioned store, JSON."""
import json
import os

import pytest

from adpulse.sources.io import load_from_paths, to_json_lines, write_clean, write_store


def _write_csvs(d, with_customers=True):
    with open(os.path.join(d, "campaigns.csv"), "w") as f:
        f.write("campaign_id,campaign_name,channel,objective,device,country,audience,date,spend,impressions,"
                "clicks,conversions,revenue\n")
        f.write("C1,n1,Email,Awareness,Mobile,India,New,2024-01-01,10.5,100,10,2,50\n")
        f.write("C1,n1,Email,Awareness,Mobile,India,New,2024-01-01,10.5,100,10,2,50\n")
        f.write("C2,n2,Organic,Awareness,Mobile,India,New,2024-02-01,0,100,0,0,5\n")
    if with_customers:
        with open(os.path.join(d, "customers.csv"), "w") as f:
            f.write("customer_id,acquisition_channel,acquisition_date,age_group,gender,city,country,"
                    "subscription_plan,first_purchase_value\n")
            f.write("U1,Email,2024-01-01,,F,X,Y,Free,3\n")
    with open(os.path.join(d, "transactions.csv"), "w") as f:
        f.write("transaction_id,customer_id,transaction_date,product_category,amount,discount,profit,refund_flag\n")
        f.write("T1,U1,2024-01-02,Books,10,0.1,2,false\n")
        f.write("T2,U9,2024-01-03,Books,10,0,2,false\n")


def test_csv_loader_partial_input_and_audit(spark, tmpdir_path):
    _write_csvs(tmpdir_path, with_customers=False)
    b = load_from_paths(spark, tmpdir_path)
    assert set(b.raw) == {"campaigns", "transactions"}
    assert b.campaigns.count() == 2          # duplicate dropped
    assert b.transactions.count() == 0       # no customers: all identified rows are orphans


def test_csv_loader_all_missing_is_error(spark, tmpdir_path):
    with pytest.raises(FileNotFoundError):
        load_from_paths(spark, tmpdir_path)


def test_store_and_clean_sinks_round_trip(spark, tmpdir_path):
    _write_csvs(tmpdir_path)
    b = load_from_paths(spark, tmpdir_path)
    paths = write_store(b.raw, os.path.join(tmpdir_path, "store"))
    assert spark.sql("SELECT COUNT(*) AS n FROM campaigns").first().n == 3
    assert os.path.isdir(os.path.join(paths["campaigns"], "month=2024-01"))
    out = write_clean(b, os.path.join(tmpdir_path, "out"))
    assert spark.read.parquet(out["transactions"]).count() == 1
    # the quarantine is all that was removed: the orphan and the second copy of a campaign row
    removed = {r.rule_key for r in spark.read.parquet(out["quarantine"]).collect()}
    assert removed == {"orphan_transactions", "duplicate_rows"} and spark.read.parquet(out["quarantine"]).count() == 2


def test_json_lines_null_for_undefined(spark):
    from adpulse.operators.marketing import groupby_kpis
    from tests.test_edges import CAMP_SCHEMA, camp
    import datetime as dt
    c = spark.createDataFrame([camp("C1", "Organic", dt.date(2024, 1, 1), 0, 100, 0, 0, 5)], CAMP_SCHEMA)
    doc = json.loads(to_json_lines(groupby_kpis(c, "channel")).first().json)
    assert doc["roas"] is None and doc["cvr"] is None and doc["channel"] == "Organic"


def test_saved_tables_prune_months_and_join_in_place(spark, tmpdir_path):
    import datetime as dt

    import __spark_entry__ as E
    from adpulse.operators.finance import customers_with_profit
    from adpulse.plans.registry import _b
    from adpulse.sources.io import open_tables, save_tables
    clean = _b(spark, E.SMOKE_DIR).tables
    names = save_tables(clean, os.path.join(tmpdir_path, "saved"), "saved_here", buckets=4, rows_per_file=200)
    cursor = dt.date(1995, 6, 15)
    saved = open_tables(spark, names).as_of(cursor)
    want = _b(spark, E.SMOKE_DIR).as_of(cursor)
    for t in ("transactions", "customers", "campaigns"):
        a, b = getattr(saved, t), getattr(want, t)
        assert sorted(a.columns) == sorted(b.columns) and a.exceptAll(b.select(*a.columns)).count() == 0 and a.count() == b.count()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = customers_with_profit(saved.customers, saved.transactions)
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan and "Join" in plan
    scans = [line for line in plan.split("\n") if "PartitionFilters" in line]
    assert scans and all("month" in s.split("PartitionFilters")[1].split("]")[0] for s in scans)
    same = customers_with_profit(want.customers, want.transactions)
    assert out.exceptAll(same.select(*out.columns)).count() == 0
