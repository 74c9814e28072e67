"""The four feeds as views over the shared ``events`` table, one SQL text for both engines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_RAW = (
    "SELECT event_id, ts, user_id AS u, event_type AS symbol, value AS v, "
    "CAST({js} AS INT) AS k FROM {events}"
)
VIEWS = {
    "orderbook": """
SELECT event_id AS seq, ts, symbol, u AS id,
       CASE WHEN u%2=0 THEN 'Buy' ELSE 'Sell' END AS side,
       CASE WHEN event_id%500=0 THEN 'partial' WHEN k<16 THEN 'insert' WHEN k<30 THEN 'update' ELSE 'delete' END AS action,
       CASE WHEN event_id%500=0 OR k<16
            THEN CASE WHEN u%2=0 THEN CAST(1000 AS DOUBLE)-u*CAST(0.5 AS DOUBLE) ELSE CAST(1000 AS DOUBLE)+u*CAST(0.5 AS DOUBLE) END
            ELSE CAST(0 AS DOUBLE) END AS price,
       CASE WHEN event_id%500<>0 AND k>=30 THEN 0 ELSE CAST(floor(v) AS INT) END AS size
FROM {raw} WHERE k<40""",
    "trades": """
SELECT event_id AS seq, ts, concat('T',CAST(event_id-event_id%2 AS STRING)) AS trdMatchID, symbol,
       CAST(1000 AS DOUBLE)+(k-55)*CAST(0.5 AS DOUBLE) AS price, CAST(floor(v) AS INT)+1 AS size, v*10 AS foreignNotional,
       CASE WHEN u%2=0 THEN 'Buy' ELSE 'Sell' END AS side,
       CASE event_id%5 WHEN 0 THEN 'PlusTick' WHEN 1 THEN 'ZeroPlusTick' WHEN 2 THEN 'MinusTick' WHEN 3 THEN 'ZeroMinusTick' ELSE 'Unknown' END AS tickDirection
FROM {raw} WHERE k>=40 AND k<70""",
    "instruments": """
SELECT event_id AS seq, ts, symbol,
       CASE WHEN event_id%7=0 THEN NULL ELSE CAST(1000 AS DOUBLE)+(v-20)/100 END AS markPrice,
       CASE WHEN event_id%11=0 THEN CAST(0 AS DOUBLE) ELSE CAST(1000 AS DOUBLE)+(u-75)/CAST(100 AS DOUBLE) END AS indexPrice,
       CAST(floor(v*100) AS BIGINT) AS volume24h, CAST(1000+u AS BIGINT) AS openInterest,
       (k-80)/CAST(10000 AS DOUBLE) AS fundingRate, (u-75)/CAST(100000 AS DOUBLE) AS indicativeFundingRate
FROM {raw} WHERE k>=70 AND k<90""",
    "liquidations": """
SELECT event_id AS seq, ts, concat('L',CAST(event_id-event_id%3 AS STRING)) AS orderID, symbol,
       CASE WHEN u%2=0 THEN 'Buy' ELSE 'Sell' END AS side, CAST(floor(v) AS INT) AS leavesQty,
       CAST(1000 AS DOUBLE)+u*CAST(0.5 AS DOUBLE) AS price
FROM {raw} WHERE k>=90""",
}


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return spark.sql(_RAW.format(js="get_json_object(props,'$.k')", events="{events}"), events=events)


def feed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.sql(VIEWS[name], raw=raw(spark, sf_dir))


def feeds_sql() -> str:
    """The same views as a list of CTEs for the SQL checks (no leading WITH)."""
    parts = ["raw AS (" + _RAW.format(js="json_extract_string(props,'$.k')", events="events") + ")"]
    parts += [f"{name} AS ({text.format(raw='raw')})" for name, text in VIEWS.items()]
    return ",\n".join(parts)
