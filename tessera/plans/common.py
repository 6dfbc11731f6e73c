"""Small helpers shared by the query modules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.readers import table

# Regression mapping of the driver tables.
LI_X = ["l_quantity", "l_discount", "l_tax"]
LI_Y = "l_extendedprice"
# (l_orderkey, l_linenumber) repeats in the driver data: order by the whole row.
LI_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity",
            "l_extendedprice", "l_discount", "l_tax"]


def tbl(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return table(spark, sf, name)


def long_table(one_row: DataFrame, pairs: Sequence[tuple[str, Column]], digits: int,
               key: str = "term", val: str = "value") -> DataFrame:
    """Turn named expressions over a one-row frame into rows (key, value)."""
    arr = F.array(*[F.struct(F.lit(t).alias(key), F.round(c.cast("double"), digits).alias(val)) for t, c in pairs])
    return one_row.select(F.inline(arr))


def lit_row(spark: SparkSession) -> DataFrame:
    return spark.range(1).drop("id")


def rnd(c, digits: int) -> Column:
    return F.round((F.col(c) if isinstance(c, str) else c).cast("double"), digits)
