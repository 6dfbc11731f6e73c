"""Helpers shared by the corpus operators."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ASCII white space as the contracts define it: [\x20\x09-\x0D].
WS_CONTROLS = "\t\n\x0b\x0c\r"
HAS_WORD = r"[^\x20\x09-\x0D]"
DOC_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def pick(df: DataFrame, *names: str, **renamed: str) -> DataFrame:
    """The named columns of ``df``, found by exact spelling and position, so that
    extra columns (also ones that differ only in case, or repeat a name) do no harm.
    ``renamed`` maps an output name to an input name."""
    wanted = [(n, n) for n in names] + list(renamed.items())
    have = df.columns
    plain = df.toDF(*[f"c{i}" for i in range(len(have))])
    return plain.select(*[F.col(f"c{have.index(src)}").alias(out) for out, src in wanted])


def present(col: str) -> Column:
    """A text column with null read as empty."""
    return F.coalesce(F.col(col), F.lit(""))


def squash_ws(df: DataFrame, src: str, out: str) -> DataFrame:
    """Add ``out``: ``src`` with every run of ASCII white space replaced by one space.
    Plain substring replacement first; the regular expression runs only on texts that
    have a run (most have none)."""
    c = F.col(src)
    for ch in WS_CONTROLS:
        c = F.replace(c, F.lit(ch), F.lit(" "))
    single = df.withColumn(out, c)
    x = F.col(out)
    return single.withColumn(out, F.when(x.contains("  "), F.regexp_replace(x, " +", " ")).otherwise(x))


def filter_above(df: DataFrame, condition: Column) -> DataFrame:
    """Filter on computed columns without letting the optimizer push the filter below them
    (it would repeat their expressions, once per use, inside the condition)."""
    return df.withColumn("above", F.monotonically_increasing_id()).filter(condition & (F.col("above") >= 0)).drop("above")


def ship(module: str) -> None:
    """Send this module's functions to the workers by value: an executor needs no copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])
