import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.operators.dedup import diagonal_union, unfit_values
from stratum.operators.supertypes import common_type
from stratum.schemas import SILVER

PAIRS = [
    ("tinyint", "bigint", "bigint"), ("boolean", "int", "int"), ("int", "float", "double"), ("smallint", "float", "float"), ("bigint", "double", "double"), ("float", "double", "double"),
    ("int", "decimal(5,2)", "decimal(12,2)"), ("decimal(10,4)", "decimal(8,1)", "decimal(11,4)"), ("bigint", "decimal(38,20)", "double"), ("decimal(5,2)", "double", "double"),
    ("date", "timestamp_ntz", "timestamp_ntz"), ("date", "timestamp", "timestamp"), ("bigint", "string", "string"), ("date", "int", "string"), ("boolean", "string", "string"), ("boolean", "date", "string"),
    ("array<int>", "array<double>", "array<double>"), ("array<int>", "string", "string"), ("array<int>", "int", "string"), ("map<string,int>", "map<string,bigint>", "map<string,bigint>"),
    ("struct<a:int,b:string>", "struct<c:date,a:bigint>", "struct<a:bigint,b:string,c:date>"), ("array<struct<a:int>>", "array<struct<a:string>>", "array<struct<a:string>>"), ("binary", "string", "string"),
]


@pytest.mark.parametrize("a, b, want", PAIRS)
def test_common_types(spark, a, b, want):
    kind = lambda x: spark.createDataFrame([], f"x {x}").schema["x"].dataType
    for x, y in ((a, b), (b, a)):
        found = common_type(kind(x), kind(y))
        if "struct<a:int,b" in a and x == b:
            assert {f.name: f.dataType for f in found.fields} == {f.name: f.dataType for f in kind(want).fields}
        else:
            assert found.simpleString() == want
    assert common_type(kind(a), T.NullType()) == kind(a) == common_type(T.NullType(), kind(a))


def test_the_order_of_frames_does_not_matter_for_flat_types(spark):
    kinds = [spark.createDataFrame([], f"x {k}").schema["x"].dataType for k in ("int", "double", "decimal(7,2)", "bigint", "boolean", "string", "date")]
    for a in kinds:
        for b in kinds:
            for c in kinds:
                if not any(isinstance(k, T.DateType | T.StringType) for k in (a, b, c)) or all(k == a for k in (b, c)):
                    assert common_type(common_type(a, b), c) == common_type(a, common_type(b, c)) == common_type(common_type(c, a), b)


def test_values_survive(spark):
    a = spark.createDataFrame([(1, [1, None], {"k": 1}, dt.date(2024, 1, 2), (5, "b"), True)], "n bigint, l array<int>, m map<string,int>, d date, s struct<a:int,b:string>, only_a boolean")
    b = spark.createDataFrame([("two", ["x"], {"k": 2.5}, dt.datetime(2024, 3, 4, 5), ("z",), Decimal("1.50")), (None, None, None, None, None, None)], "n string, l array<string>, m map<string,double>, d timestamp_ntz, s struct<a:string>, only_b decimal(5,2)")
    c = a.select(F.lit(None).alias("n"), F.to_json("s").alias("s"), F.col("only_a").cast("int").alias("only_a"))
    rows = diagonal_union([a, b, c])
    assert rows.columns == ["n", "l", "m", "d", "s", "only_a", "only_b"]
    got = rows.collect()
    assert [r.n for r in got] == ["1", "two", None, None] and got[0].l == ["1", None] and got[1].l == ["x"]
    assert got[0].m == {"k": 1.0} and got[1].m == {"k": 2.5} and got[0].d == dt.datetime(2024, 1, 2)
    assert [r.s for r in got] == ['{"a":5,"b":"b"}', '{"a":"z"}', None, '{"a":5,"b":"b"}']
    assert [r.only_a for r in got] == [1, None, None, 1] and got[1].only_b == Decimal("1.50")


def test_odd_names_and_empty_frames(spark):
    a, b = spark.createDataFrame([(1,)], "`a.b` int"), spark.createDataFrame([], "`a.b` string, `c d` int")
    assert [tuple(r) for r in diagonal_union([a, b]).collect()] == [("1", None)]


def test_values_that_do_not_fit_are_counted(spark):
    df = spark.createDataFrame([("1", "many", "2024-01-01T00:00:00Z"), ("2", "7", "never"), ("3", None, None)], "post_id string, likes_count string, timestamp string")
    n = unfit_values(df, SILVER).first()
    assert (n.likes_count, n.timestamp, n.post_id, n.caption) == (1, 1, 0, 0)
