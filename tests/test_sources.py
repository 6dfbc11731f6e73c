"""Readers, sinks and deterministic generators."""

import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SUP, ref_file
from tessera.sources import readers as rd
from tessera.sources import synthetic as syn


def _tmp():
    return tempfile.mkdtemp(prefix="tessera-src-", dir="/tmp")


def test_headerless_file_keeps_first_row(spark):
    # a headerless file read with header=False keeps all 100 rows (the reference's skiprows lost one)
    path = ref_file(SUP, "FilesC1W2-geral", "data", "houses.txt")
    df = rd.read_numeric_csv(spark, path, ["size", "bedrooms", "floors", "age", "price"])
    assert df.count() == 100


def test_whitespace_and_header_skip(spark):
    d = _tmp()
    with open(os.path.join(d, "w.txt"), "w") as f:
        f.write("a b\n1.0   2.0\n3.5 4.5\n\n")
    df = rd.read_numeric_csv(spark, os.path.join(d, "w.txt"), ["a", "b"], sep=None, header=True)
    assert sorted((r.a, r.b, r.id) for r in df.collect()) == [(1.0, 2.0, 0), (3.5, 4.5, 1)]


def test_header_file_and_quoted_csv(spark):
    d = _tmp()
    with open(os.path.join(d, "names.txt"), "w") as f:
        f.write("x,y\n")
    with open(os.path.join(d, "t.csv"), "w") as f:
        f.write('id,title,genres\n1,"A, The",Action|Drama\n2,B,Comedy\n')
    base = spark.createDataFrame([(1.0, 2.0)], "c0 double, c1 double")
    assert rd.apply_header_file(spark, base, os.path.join(d, "names.txt")).columns == ["x", "y"]
    t = rd.read_csv_with_header(spark, os.path.join(d, "t.csv"))
    assert {r.title for r in t.collect()} == {"A, The", "B"}
    with pytest.raises(ValueError):
        rd.apply_header_file(spark, base.withColumn("c2", F.lit(1)), os.path.join(d, "names.txt"))


def test_wide_to_long_and_sink_roundtrip(spark):
    wide = spark.createDataFrame([(1, 0.5, 1.5), (2, 2.5, 3.5)], "id int, a double, b double")
    long = rd.wide_to_long(wide, ["id"], ["a", "b"])
    assert long.count() == 4 and long.agg(F.sum("value")).first()[0] == 8.0
    arr = spark.createDataFrame([(7, [1.0, 2.0, 3.0])], "id int, v array<double>")
    assert [(r.position, r.value) for r in rd.array_to_long(arr, ["id"], "v").collect()] == [(0, 1.0), (1, 2.0), (2, 3.0)]
    out = os.path.join(_tmp(), "p")
    rd.write_table(long, out)
    assert spark.read.parquet(out).count() == 4
    p = rd.params_table(spark, [1.0, 2.0], 0.5).first()
    assert p.w == [1.0, 2.0] and p.b == 0.5


def test_row_position_is_stable_across_partitionings(spark):
    df = spark.range(1000).repartition(7).withColumn("v", F.col("id") * 2)
    pos = rd.with_row_position(df, "pos")
    got = sorted(r.pos for r in pos.collect())
    assert got == list(range(1000))


def test_generators_are_deterministic(spark):
    a = syn.noisy_quadratic(spark, 50, seed=3).orderBy("id").collect()
    b = syn.noisy_quadratic(spark, 50, seed=3).repartition(4).orderBy("id").collect()
    assert a == b and a[0].x == 0.0 and a[-1].x == pytest.approx(49.0)
    assert all(abs(r.y - r.x ** 2) <= 0.35 * r.x ** 2 + 1e-9 for r in a)
    blobs = syn.blobs(spark, 600, [[0.0, 0.0], [5.0, 5.0]], std=0.4, seed=1)
    cent = {r.label: (r.m0, r.m1) for r in blobs.groupBy("label").agg(F.avg("x0").alias("m0"), F.avg("x1").alias("m1")).collect()}
    assert np.allclose(cent[0], [0, 0], atol=0.1) and np.allclose(cent[1], [5, 5], atol=0.1)
    roast = syn.roast_data(spark, 200, seed=2)
    rows = roast.collect()
    assert all((r.good == 1) == (175 < r.temp < 260 and 12 < r.minutes < 15 and r.minutes <= -3 / 85 * r.temp + 21)
               for r in rows)
    rep = syn.replicate(spark.range(5), 3)
    assert rep.count() == 15 and rep.select("copy").distinct().count() == 3


def test_header_of_white_space_files_drops_only_the_first_line(spark, tmp_path):
    from tessera.sources.readers import read_numeric_csv
    (tmp_path / "a.txt").write_text("1 2\n1 2\n3  4\n\n1 2\n")
    out = read_numeric_csv(spark, str(tmp_path / "a.txt"), ["x", "y"], header=True, sep=None, with_id=False)
    assert sorted((r.x, r.y) for r in out.collect()) == [(1.0, 2.0), (1.0, 2.0), (3.0, 4.0)]
