"""Day jobs: stored feeds to daily feature files, and a mid price filled into files written before."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow.functions.clock import from_us
from tickflow.operators import book as bk
from tickflow.operators.grid import bin_last
from tickflow.plans.features import features_long, widen
from tickflow.sources.parquet import export_daily, insert_after, scan_day

FEEDS = ("orderbook", "trades", "instruments")


def day_job(
    spark: SparkSession, root: str, out: str, symbols: Sequence[str], step: int, depth: int, span: int,
    vol_window: int, date: tuple[int, int, int] | None = None, fmt: str = "csv",
) -> None:
    """The feeds stored under ``root`` to one folder of wide features a day under ``out``.

    ``date`` takes one day, else all of them run in one job; book, average and windows restart each day, so
    both give the same files.  Values that are not finite are 0.  Other days under ``out`` stay.
    """
    feeds = [scan_day(spark, f"{root}/{name}", date, symbols) for name in FEEDS]
    wide = widen(features_long(*feeds, step=step, depth=depth, span=span, vol_window=vol_window), symbols)
    export_daily(wide, out, fmt)


def backfill_mid(rows: DataFrame, orderbook: DataFrame, step: int, anchor: str = "volume24h") -> DataFrame:
    """Add ``mid_price`` right behind ``anchor``: the last mid of the row's bin, or of the last bin that has
    one; null before the first.  ``rows`` has a symbol and the start of its bin as ``ts``."""
    ticks = bk.book_ticks(bk.chunk_book(orderbook), depth=0)
    mids = bin_last(ticks, "mid", step, order=("us",), name="mid_price", fill=True)
    mids = mids.select("symbol", from_us("bin").alias("ts"), "mid_price")
    # Bins after the book's last one take its last mid.
    ends = mids.groupBy("symbol").agg(F.max("ts").alias("_end"), F.max_by("mid_price", "ts").alias("_last"))
    met = rows.drop("mid_price").join(mids, ["symbol", "ts"], "left").join(ends, ["symbol"], "left")
    late = F.when(F.col("ts") > F.col("_end"), F.col("_last"))
    filled = met.withColumn("mid_price", F.coalesce("mid_price", late)).select(*rows.drop("mid_price").columns, "mid_price")
    return insert_after(filled, "mid_price", anchor)
