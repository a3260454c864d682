"""One customer holding a third of the joined batch: its rows are split over tasks, and the batch is computed once."""

import json
import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from recordtable.operators.change import insert_new
from recordtable.plans import catalog as C

SETTINGS = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "8",
}


def hot_proposals(spark):
    """Every order proposes a supplier; a third of them all for one customer."""
    proposals = C.supplier_proposals(spark, SF_SMALL)
    many = proposals.unionByName(proposals.withColumn("seq", F.col("seq") + 10**6)).unionByName(
        proposals.withColumn("seq", F.col("seq") + 2 * 10**6)
    )
    return many.withColumn("s_suppkey", F.when(F.col("seq") % 3 == 0, F.lit(77)).otherwise(F.col("s_suppkey")))


def test_reject_join_splits_the_hot_key(spark):
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    try:
        for k, v in SETTINGS.items():
            spark.conf.set(k, v)
        supplier, batch = C.table(spark, SF_SMALL, "supplier"), hot_proposals(spark)
        result, rejected = insert_new(supplier, batch, "s_suppkey", "seq", max_broadcast_rows=None)
        rejected.collect()
        assert "skew=true" in rejected._jdf.queryExecution().executedPlan().toString()
        assert result.count() + rejected.count() == supplier.count() + batch.count()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_the_batch_is_read_from_its_stage(spark):
    """The plans of both outputs read staged files only, not the tables that the batch is made of."""
    for df in insert_new(C.table(spark, SF_SMALL, "supplier"), C.supplier_proposals(spark, SF_SMALL), "s_suppkey", "seq"):
        files = [os.path.basename(f) for f in df.inputFiles()]
        assert "orders.parquet" not in files and "customer.parquet" not in files, json.dumps(files)
