"""Dense keys over many ranges."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from quillgrid.operators import load, relational

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
FIRST = """
from pyspark.sql import SparkSession, functions as F
from quillgrid.operators.load import assign_keys
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate()
df = spark.range(0, 300000, 1, 8).select(F.when(F.col("id") % 10 < 9, F.lit(1)).otherwise(F.col("id")).alias("k"), "id")
assign_keys(df, "p", ["k", "id"], rows_per_range=100000).write.format("noop").mode("overwrite").save()
assert assign_keys(df, "p", ["k", "id"], rows_per_range=100000).selectExpr("min(p)", "max(p)", "count(distinct p)").first()[:] == (1, 300000, 300000)
print("fine")
"""


def test_first_action_of_a_session():
    done = subprocess.run([sys.executable, "-c", FIRST], cwd=ROOT, env={**os.environ, "PYTHONPATH": ROOT}, capture_output=True, text=True, timeout=300)
    assert done.stdout.strip().endswith("fine"), done.stderr[-2000:]


@pytest.mark.parametrize("key", ["CASE WHEN id % 3 = 0 THEN id END", "1", "id % 4", "-id"])
def test_keys_follow_the_order_and_ranges_are_even(spark, key, monkeypatch):
    df = spark.range(0, 20000, 1, 5).select(F.expr(key).cast("bigint").alias("k"), "id")
    kept = []
    monkeypatch.setattr(load, "settle", lambda d: kept.append(relational.settle(d)) or kept[-1])
    got = load.assign_keys(df, "p", ["k"], start=7, rows_per_range=2000).collect()
    assert sorted(r.p for r in got) == list(range(8, 20008))
    order = sorted(got, key=lambda r: r.p)
    keys = [(r.k is not None, r.k or 0) for r in order]
    assert keys == sorted(keys)
    assert max(r["count"] for r in kept[0].groupBy("_range").count().collect()) < 6000  # equal and null keys are dealt to several ranges


def test_gap_counts_from_its_own_start(spark):
    df = spark.createDataFrame([(1, 5.0, 30.0), (1, 100.0, 20.0), (1, 200.0, 20.0), (2, 0.0, 4.0), (2, 40.0, 5.0), (2, 90.0, 5.0)], "k int, x double, w double")
    assert sorted(tuple(r) for r in relational.first_gap(df, ["k"], "x", "w", 20, 10).collect()) == [(1, 35.0, 65.0), (2, 45.0, 45.0)]
