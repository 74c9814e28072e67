"""Input of the stream queries: whole parts as batches, in many files."""

from __future__ import annotations

import glob

from tickflow.catalog import streams
from tickflow.session import work_path


def test_each_part_is_one_batch_of_many_files(spark):
    df = spark.range(100).selectExpr("id AS seq", "id * 2 AS v").repartition(4)
    path, ck = work_path(spark, "in"), work_path(spark, "ck")
    seen = []

    def keep(batch, number):
        seen.append((number, sorted(r.seq for r in batch.collect())))

    def run(rows):
        return rows.writeStream.foreachBatch(keep).option("checkpointLocation", ck).trigger(availableNow=True).start()

    streams._replayed(df, path, run)
    assert seen == [(0, list(range(33))), (1, list(range(33, 66))), (2, list(range(66, 100)))]
    assert len(glob.glob(f"{path.removeprefix('file:')}/*.parquet")) == 12
