"""Session helpers: lineage cuts into the shared folder, working sets, proven broadcast sizes."""

from pyspark.sql import functions as F

from tessera.operators import anomaly as an
from tessera.session import cut_lineage, ensure_checkpoint_dir, fits_broadcast, working_set


def test_cut_lineage_writes_into_the_checkpoint_folder(spark):
    df = spark.range(100).withColumn("sq", F.col("id") * F.col("id"))
    cut = cut_lineage(df)
    assert sorted(r.sq for r in cut.collect()) == [i * i for i in range(100)]
    folder = ensure_checkpoint_dir(spark).replace("file:", "")
    assert all(folder in f.replace("file:", "") for f in cut.inputFiles())


def test_working_set_spreads_single_partition_input(spark):
    one = spark.range(0, 1000, numPartitions=1)
    ws = working_set(one)
    assert ws.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert ws.count() == 1000
    ws.unpersist()
    many = spark.range(0, 1000, numPartitions=spark.sparkContext.defaultParallelism * 2)
    ws2 = working_set(many)
    assert ws2.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism * 2
    ws2.unpersist()


def test_fits_broadcast_is_a_size_bound():
    assert fits_broadcast(1000, 10)
    assert not fits_broadcast(10 ** 9, 10)
    assert fits_broadcast(1_000_000, 4, limit=32_000_000) and not fits_broadcast(1_000_001, 4, limit=32_000_000)


def test_threshold_without_spread_has_no_sweep(spark):
    df = spark.createDataFrame([(0.5, 1), (0.5, 0)], "p double, y int")
    r = an.select_threshold(df, "p", "y").first()
    assert r.epsilon is None and r.f1 is None


def test_threshold_without_positive_f1_returns_zero(spark):
    df = spark.createDataFrame([(0.1, 0), (0.2, 0), (0.9, 1)], "p double, y int")
    r = an.select_threshold(df, "p", "y").first()
    assert (r.epsilon, r.f1) == (0.0, 0.0)
