"""Physical plans: pruning, pushdown, and no global sort or nested loop in the feature plan."""

from pyspark.sql import functions as F

from tickflow.fixtures import feed
from tickflow.plans.features import taker_imbalance
from tickflow.session import work_path
from tickflow.sources import parquet as pq

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_prunes_partitions_columns_and_rows(spark):
    path = work_path(spark, "plan")
    pq.write_feed(feed(spark, SF, "trades"), path)
    text = plan(pq.scan_day(spark, path, (2024, 1, 5), ["click"], ["ts", "price"]))
    assert "PartitionFilters: [isnotnull(year" in text
    assert "symbol" in text.split("PushedFilters:")[1].split("ReadSchema")[0]
    schema = text.split("ReadSchema:")[1].split("\n")[0]
    assert "tickDirection" not in schema and "price" in schema


def test_taker_imbalance_shuffles_only_on_its_keys(spark):
    text = plan(taker_imbalance(feed(spark, SF, "trades")))
    assert "SinglePartition" not in text
    assert "NestedLoop" not in text and "CartesianProduct" not in text
    assert "BatchEvalPython" not in text


def test_rolling_windows_reuse_the_layout(spark):
    from tickflow.operators.ordered import ema, rolling_std

    df = spark.range(0, 100, 1, 4).select((F.col("id") % 3).cast("string").alias("symbol"), F.col("id").alias("bin"), F.col("id").cast("double").alias("v"))
    out = rolling_std(ema(df, "v", ["symbol"], ["bin"], 10), "v", ["symbol"], ["bin"], 5)
    assert "SinglePartition" not in plan(out)
