import os

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(n for n in entry.core.QUERIES))
def test_core_queries_match_their_oracles(spark, name):
    import duckdb
    import pandas as pd

    df = entry.queries()[name](spark, SF)
    got = df.toPandas()
    oracle = entry.oracle_sql().get(name)
    if oracle is None:
        return
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{SF}/{f}'")
    want = con.execute(oracle).df()
    assert sorted(got.columns) == sorted(want.columns)

    def rows(d):
        text = lambda v: "~" if pd.isna(v) else str(int(v)) if isinstance(v, float) and v == int(v) else str(v).removesuffix(" 00:00:00")
        return sorted(tuple(map(text, r)) for r in d[sorted(d.columns)].itertuples(index=False))

    assert rows(got) == rows(want)


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "profile_key" in df.columns
