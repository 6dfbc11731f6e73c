"""Exact dedup by skew-safe combining (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import DOC_COLUMNS, pick, present, squash_ws

SALTS = 16


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, norm (white-space runs as one space), sha (SHA-256), fp (a second, independent hash)."""
    rows = pick(docs, doc_id=id_col, text=text_col).select("doc_id", present("text").alias("text"))
    return (squash_ws(rows, "text", "norm").select("doc_id", "norm")
            .withColumn("sha", F.unhex(F.sha2("norm", 256))).withColumn("fp", F.xxhash64("norm")))


def winners(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """One row per distinct normalised text: sha, fp, keep_id (smallest doc_id), group_size.

    Three stages, each grouping by the digest *and* the full text, so equal digests
    alone never merge two rows: (1) every task combines its own copies before the
    shuffle (the partial side of the first aggregate); (2) salted groups are merged,
    the salt being the reading task's, so a text that holds a third of all rows
    arrives as at most one row per task spread over ``salts`` reducers; (3) the salt
    winners, at most ``salts`` rows a text, are merged globally.  Nulls count as the
    empty text; a null doc_id loses to any other."""
    keyed = _keyed(docs, id_col, text_col).withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    merged = (keyed.groupBy("sha", "salt", "norm", "fp")
              .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n")))
    by_text = (merged.groupBy("sha", "norm", "fp")
               .agg(F.min("keep_id").alias("keep_id"), F.sum("n").alias("group_size")))
    # Rows find their group by (sha, fp); two texts equal in both hashes would be an error, not a merge.
    return (by_text.groupBy("sha", "fp")
            .agg(F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"),
                 F.count(F.lit(1)).alias("texts"))
            .withColumn("group_size", F.when(F.col("texts") == 1, F.col("group_size"))
                        .otherwise(F.raise_error(F.lit("two texts share SHA-256 and XXH64")).cast("long")))
            .drop("texts"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts (white-space runs as one space, null as empty) the row with the
    smallest doc_id stays.  Rows that repeat both doc_id and text are counted, and
    exactly one of them can stay.  Null doc_ids sort last; a group of null ids only
    keeps one row, with a null keep_id.  An empty table gives an empty result."""
    # written first: the join then deals out both sides itself and can split a hot digest
    best = cut_lineage(winners(docs, id_col, text_col, salts).filter("group_size > 1"))
    rows = (_keyed(docs, id_col, text_col).groupBy("doc_id", "sha", "fp")
            .agg(F.count(F.lit(1)).alias("copies")))
    joined = rows.join(best, ["sha", "fp"], "left")
    single = F.col("group_size").isNull()
    return (joined.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
            .select("doc_id",
                    F.when(single, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
                    F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
                    ((F.col("copy") == 1) & F.when(single, F.lit(True))
                     .otherwise(F.col("doc_id").eqNullSafe(F.col("keep_id")))).alias("kept"),
                    F.lower(F.hex("sha")).alias("text_sha256")))


def keep_first(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """The rows of a documents table that exact dedup keeps, with the columns of documents.

    The same three stages as ``winners``, each grouping by digest and full normalised text, carry the
    winning row along: the smallest doc_id (null last), of equal ones the smallest by (n_chars, lang,
    source), then a null text, the normalised form, the least text.  A row's text travels only where it
    differs from the normalised one, so each stage moves a text once and no join is needed."""
    keyed = (squash_ws(pick(docs, *DOC_COLUMNS).withColumn("t", present("text")), "t", "norm")
             .withColumn("sha", F.unhex(F.sha2("norm", 256))).withColumn("fp", F.xxhash64("norm"))
             .withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
             .withColumn("row", F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "n_chars", "lang", "source",
                                         F.col("text").isNotNull().alias("has_text"),
                                         F.when(F.col("text") != F.col("norm"), F.col("text")).alias("other"))))
    merged = keyed.groupBy("sha", "salt", "norm", "fp").agg(F.min("row").alias("row"))
    kept = merged.groupBy("sha", "norm", "fp").agg(F.min("row").alias("row"))
    text = F.when(F.col("row.has_text"), F.coalesce(F.col("row.other"), F.col("norm")))
    return kept.select(*[(text if c == "text" else F.col(f"row.{c}")).alias(c) for c in DOC_COLUMNS])
