"""A fitted scorer gives the same rows on a stream as on the batch table."""

import os
import tempfile

from pyspark.sql import functions as F

from tessera.operators import linear as lin
from tessera.operators.prepare import zscore_fit, zscore_transform
from tessera.streaming.scoring import read_parquet_stream, score_stream

SF = "/root/testdata/sf0.001"
X = ["l_quantity", "l_discount", "l_tax"]


def test_stream_scores_equal_batch(spark):
    batch = spark.read.parquet(f"{SF}/lineitem.parquet")
    stats = zscore_fit(batch, X)
    w, b, _ = lin.fit_least_squares(zscore_transform(batch, stats), X, "l_extendedprice")

    def scorer(df):
        return lin.predict_linear(zscore_transform(df, stats), X, w, b).select(
            "l_orderkey", "l_linenumber", F.round("prediction", 6).alias("p"))

    out = os.path.join(tempfile.mkdtemp(prefix="tessera-stream-", dir="/tmp"), "out")
    q = score_stream(read_parquet_stream(spark, SF, batch.schema, "lineitem.parquet"), scorer, out)
    q.awaitTermination(300)
    got = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    want = sorted(tuple(r) for r in scorer(batch).collect())
    assert got == want and len(got) == batch.count()
