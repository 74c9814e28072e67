"""Principal components against numpy; sink statistics against the rows written."""

import numpy as np
from pyspark.sql import functions as F

from tickflow.fixtures import feed
from tickflow.operators import density as dn
from tickflow.session import work_path
from tickflow.sources import parquet as pq


def test_pca_matches_numpy(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(80, 4)) * [5.0, 2.0, 0.5, 0.1]
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, x array<double>")
    got = np.array([r["y"] for r in dn.embed_2d(df).orderBy("id").collect()])
    vals, vecs = np.linalg.eigh(np.cov(x.T))
    top = vecs[:, np.argsort(-vals)[:2]]
    top = top * np.sign(top[np.abs(top).argmax(axis=0), [0, 1]])
    assert np.allclose(got, x @ top, atol=1e-6)


def test_sink_stats_count_what_was_written(spark):
    path = work_path(spark, "stats")
    rows = feed(spark, "/root/testdata/sf0.001", "trades")
    pq.write_feed(rows, path)
    stats = pq.sink_stats(spark, path)
    total = stats.agg(F.sum("records"), F.min("files"), F.min("bytes")).first()
    assert total[0] == rows.count() and total[1] >= 1 and total[2] > 0
