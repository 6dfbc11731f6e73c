"""Readers and sinks.

All readers take an explicit schema (no inference) so the scan can prune
columns and push filters into the file reader.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def numeric_schema(names: Sequence[str], int_cols: Sequence[str] = ()) -> T.StructType:
    return T.StructType([T.StructField(n, T.IntegerType() if n in int_cols else T.DoubleType(), True)
                         for n in names])


def read_numeric_csv(spark: SparkSession, path: str, names: Sequence[str], *, int_cols: Sequence[str] = (),
                     header: bool = False, sep: str = ",", with_id: bool = True) -> DataFrame:
    """Delimited numeric file with a given column list.

    ``header=True`` skips a header line; a headerless file never loses its
    first row.  ``sep=None`` splits on runs of whitespace (np.loadtxt's
    default).  ``with_id`` adds the row position as ``id`` (the reference
    aligns X and y by position), derived from file order.
    """
    schema = numeric_schema(names, int_cols)
    if sep is None:
        # one column that no separator cuts; the reader skips the first line of each file as its header
        lines = (spark.read.schema("value string").option("header", header).option("sep", "\u0001").option("quote", "")
                 .csv(path).where(F.trim("value") != ""))
        parts = F.split(F.trim("value"), r"\s+")
        df = lines.select(*[parts.getItem(i).cast(f.dataType).alias(f.name) for i, f in enumerate(schema.fields)])
    else:
        df = (spark.read.schema(schema).option("header", header).option("sep", sep)
              .option("mode", "FAILFAST").csv(path))
    if with_id:
        df = with_row_position(df)
    return df


def with_row_position(df: DataFrame, name: str = "id") -> DataFrame:
    """Row position in input order without funnelling rows through one task.

    ``monotonically_increasing_id`` is increasing in scan order; a rank over
    it would need one task, so positions are computed as per-partition
    offsets (a tiny table of partition counts) plus the local index.
    """
    tagged = df.withColumn("_mid", F.monotonically_increasing_id())
    tagged = tagged.withColumn("_part", F.shiftright("_mid", 33))
    counts = tagged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    offs = counts.select("_part", "_first",
                         (F.sum("_n").over(_running("_part")) - F.col("_n")).alias("_off"))
    out = tagged.join(F.broadcast(offs), "_part").withColumn(
        name, (F.col("_off") + F.col("_mid") - F.col("_first")).cast("long"))
    return out.drop("_mid", "_part", "_first", "_off")


def _running(order_col: str):
    from pyspark.sql import Window
    return Window.orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)


def read_csv_with_header(spark: SparkSession, path: str, schema: T.StructType | None = None,
                         quote: str = '"', index_col: str | None = None) -> DataFrame:
    """S3: CSV with a header line and quoted fields; optional index column dropped."""
    r = spark.read.option("header", True).option("quote", quote).option("escape", quote)
    df = r.schema(schema).csv(path) if schema is not None else r.csv(path)
    if index_col and index_col in df.columns:
        df = df.drop(index_col)
    return df


def apply_header_file(spark: SparkSession, df: DataFrame, header_path: str, sep: str = ",") -> DataFrame:
    """A one-line file holds the column names of a headerless table."""
    line = spark.read.text(header_path).first().value
    names = [n.strip() for n in line.split(sep)]
    if len(names) != len(df.columns):
        raise ValueError(f"header has {len(names)} names, table has {len(df.columns)} columns")
    return df.toDF(*names)


def wide_to_long(df: DataFrame, id_cols: Sequence[str], value_cols: Sequence[str],
                 var_name: str = "position", value_name: str = "value") -> DataFrame:
    """One row per (id, column) cell."""
    return df.unpivot(list(id_cols), list(value_cols), var_name, value_name)


def array_to_long(df: DataFrame, id_cols: Sequence[str], array_col: str,
                  pos_name: str = "position", value_name: str = "value") -> DataFrame:
    """Explode an array column with its 0-based position."""
    return df.select(*id_cols, F.posexplode(array_col).alias(pos_name, value_name))


def literal_table(spark: SparkSession, rows, schema) -> DataFrame:
    """An inline table."""
    return spark.createDataFrame(rows, schema)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    """Persist any result or parameter table as parquet."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def params_table(spark: SparkSession, w: Sequence[float], b: float, **extra) -> DataFrame:
    """Model parameters as a one-row table (w ARRAY<DOUBLE>, b DOUBLE, ...)."""
    row = {"w": [float(v) for v in w], "b": float(b), **extra}
    return spark.createDataFrame([row])
