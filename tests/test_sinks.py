"""Sinks: create-table-as-select, insert-select, and the shared materialisation."""

import os
import uuid

from pyspark.sql import functions as F

from tillroll.session import checkpoint_dir
from tillroll.sources import sinks
from tillroll.operators import facts


def test_ctas_then_insert_select(spark):
    path = os.path.join(checkpoint_dir(spark), f"ratings-{uuid.uuid4().hex}")
    orders = spark.createDataFrame([(1, "n/a"), (2, "customer"), (3, "n/a")], "order_id long, cancellation string")
    sinks.write_table(facts.seeded_ratings(orders), path, mode="overwrite")         # CREATE TABLE AS
    sinks.write_table(facts.seeded_ratings(orders), path, mode="overwrite")         # DROP + CREATE again
    assert spark.read.parquet(path).count() == 2
    sinks.write_table(facts.seeded_ratings(orders).limit(1), path, mode="append")   # INSERT ... SELECT
    got = spark.read.parquet(path)
    assert got.count() == 3
    assert got.filter((F.col("rating") < 1) | (F.col("rating") > 5)).count() == 0


def test_queries_read_a_prepared_copy_of_the_same_sources(spark, tmp_path):
    src = tmp_path / "src.parquet"
    spark.range(10).write.parquet(str(src))
    calls = []

    def build():
        calls.append(1)
        return spark.read.parquet(str(src)).withColumn("twice", F.col("id") * 2)
    name = f"t{uuid.uuid4().hex[:6]}"
    folder = os.path.join(checkpoint_dir(spark), "tillroll-tables", "shared")
    assert sinks.materialised(spark, name, [str(src)], build).count() == 10 and len(calls) == 1
    assert not [x for x in (os.listdir(folder) if os.path.exists(folder) else []) if x.startswith(name)]   # only read
    assert sinks.prepare(spark, name, [str(src)], build) and not sinks.prepare(spark, name, [str(src)], build)
    n = len(calls)
    assert sinks.materialised(spark, name, [str(src)], build).count() == 10 and len(calls) == n
    spark.range(20).write.mode("overwrite").parquet(str(src))        # new version of the source
    assert sinks.materialised(spark, name, [str(src)], build).count() == 20 and len(calls) == n + 1
    assert sinks.prepare(spark, name, [str(src)], build)
    assert sinks.materialised(spark, name, [str(src)], build).count() == 20
