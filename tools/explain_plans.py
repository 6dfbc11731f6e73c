"""Print the physical plans of the core operators (formatted, first lines).

usage: python tools/explain_plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import numpy as np  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tessera.functions.core import array_cols  # noqa: E402
from tessera.operators import anomaly, cluster, linear, moments, ordering, recommend, tree  # noqa: E402
from tessera.session import get_spark  # noqa: E402


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    return text.split("\n\n")[0]


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("local[8]", 8)
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    ev = spark.read.parquet(f"{sf}/events.parquet")
    x = ["l_quantity", "l_discount", "l_tax"]
    shows = {
        "A7 moment aggregate (filter pushed, 4 columns read)": li.where(F.col("l_returnflag") == "R").select(
            *x, "l_extendedprice").agg(*moments.moment_exprs(x + ["l_extendedprice"])),
        "M1 scoring with literal weights (projection only)": linear.predict_linear(li, x, [1.0, 2.0, 3.0], 0.5)
        .select("prediction"),
        "W1 skew-safe rolling mean": ordering.rolling_mean(ev.select("event_id", "user_id", "ts", "value"),
                                                           "user_id", ["ts", "event_id"], "value", 5),
        "W7 top-k per group (limited before the shuffle)": recommend.top_k(
            spark.read.parquet(f"{sf}/customer.parquet"), "c_nationkey", [F.col("c_acctbal").desc()], 3),
        "N3 threshold histogram": li.select((F.col("l_quantity") / 50).alias("p"),
                                            (F.col("l_returnflag") == "R").cast("int").alias("y"))
        .groupBy(F.floor(F.col("p") * 1000).alias("k")).agg(F.sum("y"), F.count(F.lit(1))),
        "D3 one aggregate per tree level": li.select((F.col("l_quantity") > 25).cast("int").alias("f0"),
                                                     (F.col("l_returnflag") == "R").cast("int").alias("y"),
                                                     F.lit(1).alias("node_id"))
        .groupBy("node_id").agg(F.count(F.lit(1)), F.sum("y"), F.sum("f0"), F.sum(F.col("f0") * F.col("y"))),
        "K1 nearest centroid (literals, no join)": cluster.assign(
            spark.read.parquet(f"{sf}/embeddings.parquet").select(*array_cols("embedding", 3, "c")),
            ["c0", "c1", "c2"], np.eye(3)),
    }
    for title, df in shows.items():
        print(f"== {title}\n{plan_of(df)}\n")
    _ = (anomaly, tree)
    spark.stop()


if __name__ == "__main__":
    main()
