"""Shared pieces of the catalog: fixture parameters and SQL building blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.catalog.registry import over_feeds, query, r6
from tickflow.fixtures import feed, raw

__all__ = [
    "BIN", "DEPTH", "HOUR", "RANK_MIN", "RANK_W", "SPAN", "SYMBOLS", "VOL", "book_ctes",
    "feed", "over_feeds", "query", "r6", "raw", "rounded",
]

# The test history spans 30 days of sparse events, so bins are coarser than 100 ms.
HOUR = 3_600_000_000
BIN = HOUR
SPAN, VOL, DEPTH, RANK_W, RANK_MIN = 24, 6, 5, 48, 5
SYMBOLS = ["click", "error", "purchase", "signup", "view"]


def rounded(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})


def book_ctes(daily: bool = False) -> str:
    """CTEs ob, ev, alive, ticks: the book after every row by self-join, straight from the rule."""
    day = "CAST(ts AS DATE)" if daily else "DATE '1970-01-01'"
    return f"""
ob AS (SELECT *, {day} AS d FROM orderbook),
ev AS (SELECT *, max(CASE WHEN action='partial' THEN seq END) OVER (PARTITION BY symbol, d ORDER BY ts, seq) AS ep FROM ob),
lv AS (
  SELECT t.symbol, t.d, t.seq AS tseq, e.side, e.id,
    max(CASE WHEN e.action IN ('insert','partial') AND e.price>0 AND e.size>0 THEN e.seq END) AS i,
    max(CASE WHEN e.action='delete' OR (e.action='update' AND e.size<=0) THEN e.seq END) AS k,
    max(CASE WHEN (e.action IN ('insert','partial') AND e.price>0 AND e.size>0)
              OR (e.action='update' AND e.size>0) THEN e.seq END) AS s
  FROM ev t JOIN ev e ON e.symbol=t.symbol AND e.d=t.d AND e.seq<=t.seq AND e.seq>=coalesce(t.ep,-1)
  GROUP BY ALL),
alive AS (
  SELECT lv.symbol, lv.d, lv.tseq, lv.side, lv.id, pi.price, ps.size
  FROM lv JOIN ob pi ON pi.seq=lv.i JOIN ob ps ON ps.seq=lv.s
  WHERE lv.i IS NOT NULL AND (lv.k IS NULL OR lv.k<lv.i)),
top AS (
  SELECT *, row_number() OVER (PARTITION BY tseq, side ORDER BY CASE WHEN side='Buy' THEN -price ELSE price END) AS rn
  FROM (SELECT symbol, d, tseq, side, price, sum(size) AS sz FROM alive GROUP BY ALL)),
depth AS (
  SELECT tseq, max(CASE WHEN side='Buy' AND rn=1 THEN price END) AS bid1,
    max(CASE WHEN side='Sell' AND rn=1 THEN price END) AS ask1,
    coalesce(sum(CASE WHEN side='Buy' THEN sz END),0) AS bsz, coalesce(sum(CASE WHEN side='Sell' THEN sz END),0) AS asz,
    sum(price*sz) AS pv
  FROM top WHERE rn<={DEPTH} GROUP BY tseq),
ticks AS (
  SELECT t.symbol, t.d, t.seq, t.ts, q.bid1, q.ask1, (q.bid1+q.ask1)/2 AS mid,
    coalesce(q.bsz,0) AS bsz, coalesce(q.asz,0) AS asz, q.pv
  FROM ev t LEFT JOIN depth q ON q.tseq=t.seq),
rets AS (
  SELECT *, coalesce(CASE WHEN mid/pm>0 THEN greatest(-0.1, least(0.1, ln(mid/pm))) END, 0) AS ret
  FROM (SELECT *, last_value(mid IGNORE NULLS) OVER (PARTITION BY symbol, d ORDER BY seq
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pm FROM ticks))"""
