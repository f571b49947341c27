"""CLI: compare registered Spark queries with their DuckDB oracles.

usage: python tests/run_oracle.py [sf_dir] [name-substring ...]
"""
import sys
import time

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

from adpulse.session import get_session  # noqa: E402
from tests.harness import compare, duck  # noqa: E402
import __spark_entry__ as E  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    pats = sys.argv[2:]
    spark = get_session("local[8]", **{"spark.sql.shuffle.partitions": "8"})
    con = duck(sf)
    qs, orc = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if pats and not any(p in name for p in pats):
            continue
        t0 = time.time()
        try:
            sp = fn(spark, sf).toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in orc:
            print(f"ROWS {name}: {len(sp)} rows ({ts:.1f}s, no oracle)")
            continue
        try:
            od = con.execute(orc[name]).fetchdf()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: oracle error {str(e)[:400]}")
            bad += 1
            continue
        ok, msg = compare(sp, od)
        print(f"{'OK  ' if ok else 'FAIL'} {name}: {len(sp)} rows {msg} ({ts:.1f}s)")
        bad += 0 if ok else 1
    print(f"{bad} failures")


if __name__ == "__main__":
    main()
