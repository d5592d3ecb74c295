"""Streaming twins give the same result as the batch queries."""

import os
import uuid

import pytest

from tillroll.streaming import incremental
from tillroll.plans.registry import QUERIES, load_all

SMALL = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.exists(SMALL), reason="test tables absent")
@pytest.mark.parametrize("key", sorted(incremental.STREAMABLE))
def test_stream_equals_batch(spark, key):
    load_all()
    name = f"s_{key}_{uuid.uuid4().hex[:8]}"
    q = incremental.start(spark, key, SMALL, query_name=name)
    q.awaitTermination(300)
    assert q.exception() is None
    streamed = sorted(map(tuple, spark.table(name).collect()))
    batch = sorted(map(tuple, QUERIES[key](spark, SMALL).collect()))
    assert streamed == batch


@pytest.mark.skipif(not os.path.exists(SMALL), reason="test tables absent")
def test_stream_resumes_from_its_checkpoint(spark, tmp_path):
    """Process the first file, stop, let a second file arrive, restart on the
    same checkpoint: the totals cover both files, each counted once."""
    import shutil

    from pyspark.sql import functions as F

    root = tmp_path / "tables"
    (root / "orders.parquet").mkdir(parents=True)
    orders = spark.read.parquet(f"{SMALL}/orders.parquet")
    half_a = orders.filter(F.col("o_orderkey") % 2 == 0)
    half_b = orders.filter(F.col("o_orderkey") % 2 == 1)
    staging = tmp_path / "staging"
    half_a.coalesce(1).write.parquet(str(staging / "a"))
    half_b.coalesce(1).write.parquet(str(staging / "b"))
    def arrive(src, name):
        part = next(p for p in src.iterdir() if p.suffix == ".parquet")
        shutil.copy(part, root / "orders.parquet" / name)
    arrive(staging / "a", "part-a.parquet")
    ckpt = str(tmp_path / "ckpt")
    name = f"resume_{uuid.uuid4().hex[:8]}"
    q = incremental.start(spark, "txn_totals_by_type", str(root), query_name=name, checkpoint_location=ckpt)
    q.awaitTermination(300)
    first = {r.txn_type: r.txn_count for r in spark.table(name).collect()}
    arrive(staging / "b", "part-b.parquet")
    q = incremental.start(spark, "txn_totals_by_type", str(root), query_name=name + "_2", checkpoint_location=ckpt)
    q.awaitTermination(300)
    assert q.exception() is None
    load_all()
    batch = {r.txn_type: r.txn_count for r in QUERIES["txn_totals_by_type"](spark, SMALL).collect()}
    second = {r.txn_type: r.txn_count for r in spark.table(name + "_2").collect()}
    assert sum(first.values()) == half_a.count()
    assert second == batch
