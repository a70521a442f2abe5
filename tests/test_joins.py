"""Lookups whose keys may be frequent or null."""

from collections import defaultdict

from pyspark.sql import functions as F

from shiftledger.operators.joins import lookup


def test_frequent_and_null_keys_are_looked_up_apart(spark):
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 != 1, (F.col("id") % 50).cast("string"))
    rows = spark.range(4000).select(key.alias("k"), "id")
    table = spark.createDataFrame([("hot", 1), ("4", 2), (None, 3)], "k STRING, v INT")
    want = defaultdict(lambda: None, {"hot": 1, "4": 2})
    for hot_keys in (1, 2, 1000):
        got = {r["id"]: r["v"] for r in lookup(rows, table, "k", hot_keys).collect()}
        assert got == {r["id"]: want[r["k"]] for r in rows.collect()} and len(got) == 4000
    assert lookup(rows.limit(0), table, "k").count() == 0
    assert lookup(rows, table.limit(0), "k").where("v is not null").count() == 0
