"""Queries over keys that narrow integers don't hold."""

import datetime as dt

import __spark_entry__ as entry

LARGE = (7, 45_000, 3_000_000_000)


def test_unions_of_drifting_types_hold_large_keys(spark, tmp_path):
    ts = dt.datetime(2024, 1, 2, 3)
    tables = {
        "events": ([(k, ts, k + 1, "view") for k in LARGE], "event_id long, ts timestamp_ntz, user_id long, event_type string"),
        "orders": ([(k, k + 2, 1.5, ts) for k in LARGE], "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp_ntz"),
        "customer": ([(k, f"c{k}", 3) for k in LARGE], "c_custkey long, c_name string, c_nationkey int"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    df = entry.queries()["union_drift"](spark, f"file://{tmp_path}")
    assert dict(df.dtypes)["owner"] == "bigint"
    found = {(r.id, r.owner) for r in df.collect()}
    assert found == {(str(k), k + 1) for k in LARGE} | {(f"o{k}", k + 2) for k in LARGE} | {(str(k), k) for k in LARGE}
