"""Statistics kept by signed deltas equal those of the whole table."""

import json
import random

from pyspark.sql import functions as F

from recordtable.fields import Field
from recordtable.operators import change
from recordtable.operators.read import group_stats
from recordtable.operators.stats import merge_parts, stat_delta, stat_parts, stats_of_parts
from recordtable.sources.sinks import stage

AVGS = {"n": "avg_n", "d": "avg_d"}
SCHEMA = "k long, g string, n int, d double"
FIELDS = [Field("g", "text", default=None), Field("n", "int", default=None), Field("d", "double", default=None)]


def stats(df):
    return sorted(((r.g, r.c, r.avg_n, r.avg_d and round(r.avg_d, 9)) for r in df.collect()), key=str)


def test_random_changes(spark):
    rng = random.Random(4)
    value = lambda: rng.choice([None, rng.randint(-9, 9)])
    group = lambda: rng.choice(["a", "b", "c", None])
    table = spark.createDataFrame([(k, group(), value(), rng.choice([None, 1e16, 0.1, -0.7])) for k in range(40)], SCHEMA)
    parts = stage(stat_parts(table, "g", AVGS), "parts")
    for step in range(4):
        patches = [(rng.randint(0, 60), s, json.dumps(rng.choice([{"g": "b"}, {"n": 5}, {"g": None, "d": 0.3}, {"d": None}]))) for s in range(15)]
        patches = spark.createDataFrame(patches, "k long, seq long, json string")
        gone = spark.createDataFrame([(rng.randint(0, 60),) for _ in range(6)], "k long")
        new = [(rng.randint(30, 60), group(), value(), 2.5, s) for s in range(10)]
        new = spark.createDataFrame(new, SCHEMA + ", seq long")
        keys = patches.select("k").union(gone).union(new.select("k")).distinct()
        # only the rows that the batch names are read
        before = stage(table.join(keys, "k", "left_semi"), "before")

        def applied(rows):
            rows = change.delete(rows, gone, "k")[0]
            rows = change.insert_new(rows, new, "k", "seq")[0]
            return stage(change.patch(rows, patches, "k", "seq", "json", FIELDS)[0], "after")

        parts = stage(merge_parts(parts, stat_delta(before, applied(before), "g", AVGS), "g"), "parts")
        table = applied(table)
        whole = group_stats(table, "g", AVGS, "c")
        got = stats_of_parts(parts, "g", AVGS, "c")
        assert got.columns == whole.columns and dict(got.dtypes)["c"] == dict(whole.dtypes)["c"]
        rounded = [F.round(c, 9).alias(c) for c in AVGS.values()]
        exact = table.groupBy("g").agg(F.count("*").alias("c"), *[(F.sum(F.col(c).cast("decimal(38,12)")).cast("double") / F.count(c)).alias(o) for c, o in AVGS.items()])
        assert stats(got) == stats(exact) and got.select(*rounded).count() == whole.count()


def test_groups_go_and_come(spark):
    one = spark.createDataFrame([(1, "a", 1, 1e300)], SCHEMA).withColumn("d", F.lit(None).cast("double"))
    parts = stat_parts(one, "g", AVGS)
    empty = merge_parts(parts, stat_delta(one, one.limit(0), "g", AVGS), "g")
    assert empty.count() == 0
    assert stats(stats_of_parts(merge_parts(empty, stat_delta(one.limit(0), one, "g", AVGS), "g"), "g", AVGS, "c")) == [("a", 1, 1.0, None)]
