"""Source and sink queries: written under the shared folder, read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickflow.catalog.common import feed, over_feeds, query, r6, rounded
from tickflow.catalog.gridded import _SEG, segment_labels
from tickflow.operators.grid import asof_labels
from tickflow.session import work_path
from tickflow.sources import parquet as pq

_COLS = ["seq", "ts", "symbol", "trdMatchID", "price", "size"]
_SEL = 'seq, ts, symbol, trdMatchID AS "trdMatchID", price, size'


def _trades(spark, sf):
    return feed(spark, sf, "trades").select(*_COLS)


def _stored(spark, sf):
    path = work_path(spark, "trades")
    pq.write_feed(_trades(spark, sf), path)
    return path


@query("sink_roundtrip", over_feeds(f"SELECT {_SEL}, CAST(year(ts) AS INT) AS year, CAST(month(ts) AS INT) AS month, CAST(day(ts) AS INT) AS day FROM trades"))
def sink_roundtrip(spark, sf):
    return spark.read.parquet(_stored(spark, sf))


@query("scan_day_symbol", over_feeds("SELECT ts, price, size FROM trades WHERE CAST(ts AS DATE)=DATE '2024-01-05' AND symbol IN ('click','view')"))
def scan_day_symbol(spark, sf):
    return pq.scan_day(spark, _stored(spark, sf), (2024, 1, 5), ["click", "view"], ["ts", "price", "size"])


@query("discover_days", over_feeds("SELECT DISTINCT CAST(year(ts) AS INT) AS year, CAST(month(ts) AS INT) AS month, CAST(day(ts) AS INT) AS day FROM trades"))
def discover_days(spark, sf):
    return pq.discover_days(spark, _stored(spark, sf))


_SPLIT = "TIMESTAMP '2024-01-20 06:00:00'"


@query("merge_upsert", over_feeds(
    f"SELECT {_SEL} FROM n QUALIFY row_number() OVER (PARTITION BY CAST(ts AS DATE), symbol, trdMatchID ORDER BY is_new DESC, ts DESC, seq DESC)=1",
    f"""n AS (SELECT *, 0 AS is_new FROM trades WHERE ts<{_SPLIT} UNION ALL SELECT * REPLACE (size+1000 AS size), 1 FROM trades WHERE ts>={_SPLIT} - INTERVAL 2 DAY)"""
).replace("FROM n QUALIFY", f"FROM (SELECT * FROM n WHERE CAST(ts AS DATE)>=CAST({_SPLIT} - INTERVAL 2 DAY AS DATE)) QUALIFY")
    + f" UNION ALL SELECT {_SEL} FROM trades WHERE CAST(ts AS DATE)<CAST({_SPLIT} - INTERVAL 2 DAY AS DATE)")
def merge_upsert(spark, sf):
    """Stored trades up to a time; a later batch overlaps them by two days and corrects sizes."""
    split = F.expr(_SPLIT).cast("timestamp_ntz")
    rows = _trades(spark, sf)
    path = work_path(spark, "merge")
    pq.write_feed(rows.where(F.col("ts") < split), path)
    late = rows.where(F.col("ts") >= split - F.expr("INTERVAL 2 DAYS")).withColumn("size", F.col("size") + 1000)
    pq.merge_feed(late, path, ["trdMatchID"])
    return spark.read.parquet(path).select(*_COLS)


@query("compact_day", over_feeds(f"SELECT {_SEL} FROM trades QUALIFY row_number() OVER (PARTITION BY CAST(ts AS DATE), symbol, trdMatchID ORDER BY ts DESC, seq DESC)=1"))
def compact_day(spark, sf):
    """Five small appends per day, then compaction."""
    path = work_path(spark, "compact")
    rows = _trades(spark, sf)
    for i in range(5):
        pq.write_feed(rows.where(F.col("seq") % 5 == i), path)
    pq.compact_feed(spark, path, ["trdMatchID"])
    return spark.read.parquet(path).select(*_COLS)


@query("export_daily", over_feeds(
    f"""SELECT coalesce(s.regime, (SELECT arg_min(regime, segment_start) FROM seg)) AS regime, CAST(t.ts AS DATE) AS date, count(*) AS rows, {r6('sum(price)')} AS price
        FROM trades t ASOF LEFT JOIN seg s ON t.ts>=s.segment_start GROUP BY 1,2""", _SEG))
def export_daily(spark, sf):
    path = work_path(spark, "export")
    pq.export_daily(asof_labels(_trades(spark, sf), segment_labels(spark, sf)), path)
    out = spark.read.parquet(path).groupBy("regime", "date").agg(F.count(F.lit(1)).alias("rows"), F.sum("price").alias("price"))
    return rounded(out, "price")


@query("load_features", over_feeds(f"SELECT {_SEL} FROM trades"))
def load_features(spark, sf):
    """Labelled rows exported as daily CSV files, loaded without the label."""
    path = work_path(spark, "csv")
    rows = asof_labels(_trades(spark, sf), segment_labels(spark, sf))
    pq.export_daily(rows, path, fmt="csv")
    return pq.load_features(spark, path, rows.schema).select(*_COLS)


@query("run_metrics", over_feeds(
    """SELECT 'trades' AS feed, count(*) AS records, 0::BIGINT AS errors, CAST(min(ts) AS STRING) AS first_ts, CAST(max(ts) AS STRING) AS last_ts FROM trades
       UNION ALL SELECT 'instruments', count(*), count(*) FILTER (markPrice IS NULL), CAST(min(ts) AS STRING), CAST(max(ts) AS STRING) FROM instruments"""))
def run_metrics(spark, sf):
    path, metrics = work_path(spark, "run"), work_path(spark, "metrics")
    pq.write_with_metrics(_trades(spark, sf), path + "/trades", metrics, "trades")
    instr = feed(spark, sf, "instruments")
    pq.write_with_metrics(instr, path + "/instruments", metrics, "instruments", F.col("markPrice").isNull())
    return spark.read.parquet(metrics).drop("seconds")


@query("sink_stats", over_feeds("""SELECT CAST(year(ts) AS INT) AS year, CAST(month(ts) AS INT) AS month, CAST(day(ts) AS INT) AS day,
    count(*) AS records, true AS has_files, true AS has_bytes FROM trades GROUP BY 1,2,3"""))
def sink_stats(spark, sf):
    """How many files and bytes a day has is the writer's choice; that it has some is not."""
    stats = pq.sink_stats(spark, _stored(spark, sf))
    return stats.select("year", "month", "day", "records", (F.col("files") > 0).alias("has_files"), (F.col("bytes") >= F.col("records")).alias("has_bytes"))
