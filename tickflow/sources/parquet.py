"""Date-partitioned Parquet feeds and daily feature files: write, merge, compact, scan."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickflow.operators.dedup import dedup_last
from tickflow.session import cut

DATE_PARTS = ["year", "month", "day"]


def with_date_parts(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Partition columns from each row's own time."""
    return df.withColumns({"year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts)})


def _laid_out(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """One symbol-day per task where it fits; a hot one is split into several files."""
    by = [c for c in [*DATE_PARTS, "symbol"] if c in df.columns]
    return df.hint("rebalance", *[F.col(c) for c in by]).sortWithinPartitions(*by, *order)


def write_feed(
    df: DataFrame, path: str, ts: str = "ts", order: Sequence[str] = ("ts", "seq"),
    mode: str = "append", max_rows: int = 5_000_000,
) -> None:
    """Write rows to ``path/year=/month=/day=``, sorted by symbol and time within files."""
    (
        _laid_out(with_date_parts(df, ts), order)
        .write.mode(mode).option("maxRecordsPerFile", max_rows).option("compression", "snappy")
        .partitionBy(*DATE_PARTS).parquet(path)
    )


def write_batch(
    df: DataFrame, path: str, batch: int, ts: str = "ts", order: Sequence[str] = ("ts", "seq"),
) -> None:
    """Write one streaming batch; a repeated batch replaces its own files and nothing else."""
    rows = with_date_parts(df, ts).withColumn("batch", F.lit(batch))
    (
        _laid_out(rows, order).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*DATE_PARTS, "batch").parquet(path)
    )


def _replace_days(df: DataFrame, path: str, order: Sequence[str]) -> None:
    """Replace exactly the day partitions present in ``df``; the rows are durable before."""
    safe = cut(df)
    (
        _laid_out(safe, order).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*DATE_PARTS).parquet(path)
    )


def merge_feed(
    new: DataFrame, path: str, keys: Sequence[str], ts: str = "ts", order: Sequence[str] = ("ts", "seq"),
) -> None:
    """Add rows to a feed, last copy per key wins over stored ones of the same days."""
    spark = new.sparkSession
    fresh = with_date_parts(new, ts)
    stored = spark.read.parquet(path)
    # The day list drives dynamic partition pruning: untouched days are not read.
    days = fresh.select(*DATE_PARTS).distinct()
    old = stored.join(days, DATE_PARTS, "left_semi").withColumn("_new", F.lit(0))
    both = old.unionByName(fresh.withColumn("_new", F.lit(1)))
    merged = dedup_last(both, [*DATE_PARTS, "symbol", *[k for k in keys if k != "symbol"]], ["_new", *order])
    _replace_days(merged.drop("_new").select(*stored.columns), path, order)


def file_table(spark: SparkSession, path: str) -> DataFrame:
    """(year, month, day, file, bytes, records) of a stored feed."""
    return (
        spark.read.parquet(path)
        .select(*DATE_PARTS, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"))
        .groupBy(*DATE_PARTS, "file", "bytes").agg(F.count(F.lit(1)).alias("records"))
    )


def sink_stats(spark: SparkSession, path: str) -> DataFrame:
    """Records, files and bytes per day."""
    return file_table(spark, path).groupBy(*DATE_PARTS).agg(
        F.sum("records").alias("records"), F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes")
    )


def compact_feed(
    spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str] = ("ts", "seq"),
    small: int = 10 * 1024 * 1024, more_than: int = 3,
) -> None:
    """Rewrite the days that consist of more than ``more_than`` small files, without copies."""
    files = file_table(spark, path).where(F.col("bytes") < small)
    days = files.groupBy(*DATE_PARTS).agg(F.count(F.lit(1)).alias("_f")).where(F.col("_f") > more_than)
    stored = spark.read.parquet(path)
    rows = stored.join(days.select(*DATE_PARTS), DATE_PARTS, "left_semi")
    kept = dedup_last(rows, [*DATE_PARTS, "symbol", *[k for k in keys if k != "symbol"]], order)
    _replace_days(kept.select(*stored.columns), path, order)


def scan_day(
    spark: SparkSession, path: str, date: tuple[int, int, int] | None = None,
    symbols: Sequence[str] | None = None, columns: Sequence[str] | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Rows of one day and some symbols: partition pruning, pushed filter, pruned columns."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(path)
    if date is not None:
        for part, value in zip(DATE_PARTS, date):
            df = df.where(F.col(part) == value)
    if symbols is not None:
        df = df.where(F.col("symbol").isin(list(symbols)))
    return df.select(*columns) if columns else df


def discover_days(spark: SparkSession, path: str) -> DataFrame:
    """Days present; only partition values are needed, so no column is read."""
    return spark.read.parquet(path).select(*DATE_PARTS).distinct().orderBy(*DATE_PARTS)


def export_daily(df: DataFrame, path: str, fmt: str = "parquet", ts: str = "ts", first: Sequence[str] = ("regime",)) -> None:
    """One folder per day, label columns first; days that are not in ``df`` stay as they are."""
    lead = [c for c in first if c in df.columns]
    rest = [c for c in df.columns if c not in lead]
    out = df.select(*lead, *rest).withColumn("date", F.to_date(ts))
    writer = out.hint("rebalance", F.col("date")).sortWithinPartitions("date", ts).write.mode("overwrite").partitionBy("date")
    writer = writer.option("partitionOverwriteMode", "dynamic")
    if fmt == "csv":
        writer.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").csv(path)
    else:
        writer.format(fmt).save(path)


def load_features(spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str = "csv") -> DataFrame:
    """All daily feature files of a run, any old label dropped."""
    if fmt == "csv":
        reader = spark.read.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        df = (reader.schema(schema) if schema is not None else reader.option("inferSchema", True)).csv(path)
    else:
        df = spark.read.format(fmt).load(path)
    return df.drop("regime", "date")


def insert_after(df: DataFrame, column: str, anchor: str) -> DataFrame:
    """Move a column right behind another one."""
    rest = [c for c in df.columns if c != column]
    at = rest.index(anchor) + 1
    return df.select(*rest[:at], column, *rest[at:])


def write_with_metrics(
    df: DataFrame, path: str, metrics_path: str, name: str, error: Column | None = None, **options
) -> None:
    """Write a feed and append one metrics record, measured during the write itself."""
    seen = Observation(f"write_{name}")
    bad = F.lit(False) if error is None else error
    began = time.time()
    observed = df.observe(
        seen, F.count(F.lit(1)).alias("records"), F.count(F.when(bad, 1)).alias("errors"),
        F.min("ts").cast("string").alias("first_ts"), F.max("ts").cast("string").alias("last_ts"),
    )
    write_feed(observed, path, **options)
    got = seen.get
    spark = df.sparkSession
    row = [(name, got["records"], got["errors"], got["first_ts"], got["last_ts"], time.time() - began)]
    spark.createDataFrame(
        row, "feed string, records long, errors long, first_ts string, last_ts string, seconds double"
    ).coalesce(1).write.mode("append").parquet(metrics_path)
