"""Line dedup by winnowing over line hashes (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import HAS_WORD, pick, present

#: The smallest repeats that are removed: three consecutive lines of any length, or one or two lines
#: with this many words together.
RUN = 3
MIN_WORDS = 10


def _lined(rows: DataFrame) -> DataFrame:
    """Add lines (all) and pos (places of the lines with a word) to rows with ``t``."""
    lined = rows.withColumn("lines", F.split("t", "\n"))
    return lined.withColumn("pos", F.filter(F.sequence(F.lit(0), F.size("lines") - 1),
                                            lambda i: F.col("lines")[i].rlike(HAS_WORD)))


def _windows(rows: DataFrame, run: int, min_words: int) -> DataFrame:
    """Add ``wins`` to rows with ``t``: every window of lines that counts as a run if it repeats, as (s, key), key the hashes of
    its lines: ``run`` lines, or fewer with ``min_words`` words together.  A fixed number per line, so a text of
    any length takes work in proportion."""
    lined = _lined(rows).withColumn("lh", F.transform("pos", lambda i: F.xxhash64(F.col("lines")[i])))
    counted = lined.withColumn("nw", F.transform("pos", lambda i: F.regexp_count(F.col("lines")[i], F.lit(r"[^\x20\x09-\x0D]+"))))
    counted = counted.drop("t", "lines", "pos")
    none = F.array().cast("array<struct<s:int,key:array<bigint>>>")

    def of(size: int) -> Column:
        starts = F.sequence(F.lit(0), F.size("lh") - size)
        if size < run:
            words = lambda s: sum((F.col("nw")[s + i] for i in range(1, size)), F.col("nw")[s])
            starts = F.filter(starts, lambda s: words(s) >= min_words)
        made = F.transform(starts, lambda s: F.struct(s.alias("s"), F.array(*[F.col("lh")[s + i] for i in range(size)]).alias("key")))
        return F.when(F.size("lh") >= size, made).otherwise(none)

    return counted.withColumn("wins", F.concat(*[of(size) for size in range(1, run + 1)])).drop("nw")


def _anchors() -> Column:
    """The fingerprints of a text: the hashes of the distinct lines that are the smallest of some window (the leftmost
    among equals)."""
    at = F.transform("wins", lambda w: w["s"] + F.array_position(w["key"], F.array_min(w["key"])).cast("int") - 1)
    return F.transform(F.array_distinct(at), lambda i: F.col("lh")[i])


def repeated_lines(docs: DataFrame, run: int = RUN, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, h, gone: per text with repeated runs, the numbers of its lines (among those with a word) to delete.

    (1) Winnowing: each window selects its smallest line hash; these fingerprints are counted by hash, combined
    before the shuffle, and those met once are dropped: whatever repeats shares one.  (2) Windows around the
    others are joined, which extends each shared line to both sides.  (3) Equal windows find their first
    place in (doc_id, text hash, line) order by an aggregate, and every later place joins it and is deleted.
    All joins are merge joins at every size, whose hot keys adaptive execution splits; no pairs of
    places are formed."""
    rows = pick(docs, "doc_id", "text").select("doc_id", present("text").alias("t"))
    wins = _windows(rows.withColumn("h", F.xxhash64("t")), run, min_words)
    # outer generators: of others the optimizer infers a filter on the array, and pushing it down repeats the array's making
    shared = cut_lineage(wins.select(F.explode_outer(_anchors()).alias("v")).filter("v IS NOT NULL").groupBy("v").agg(F.count(F.lit(1)).alias("n"))
                         .filter("n > 1").select("v"))
    each = wins.select("doc_id", "h", F.inline_outer("wins")).filter("key IS NOT NULL").withColumn("v", F.array_min("key"))
    places = cut_lineage(each.join(shared.hint("merge"), "v", "left_semi").drop("v").distinct())
    place = F.struct("doc_id", "h", "s")
    first = cut_lineage(places.groupBy("key").agg(F.min(place).alias("first"), F.max(place).alias("last"))
                        .filter("first <> last").select("key", "first"))
    later = places.join(first.hint("merge"), "key").filter(place > F.col("first"))
    lines = later.select("doc_id", "h", F.explode(F.sequence(F.col("s"), F.col("s") + F.size("key") - 1)).alias("k")).distinct()
    return lines.groupBy("doc_id", "h").agg(F.sort_array(F.collect_list("k")).alias("gone"))


def line_dedup(docs: DataFrame, run: int = RUN, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per document: doc_id, n_lines (with a word), n_removed, n_runs, kept_text.

    A run of ``run`` or more consecutive lines (blank lines skipped), or of fewer lines with ``min_words`` or more words
    together, that occurs at an earlier place, in order of (doc_id, text hash, line), is deleted; the earliest
    copy stays whole.  Shorter repeats stay.  A null text is empty.  Rows equal in doc_id and text share their
    places and so never delete each other.  Null doc_ids come first in the order.  Blank lines are kept.
    Extra columns are not read; an empty table gives no rows."""
    rows = pick(docs, "doc_id", "text").select("doc_id", present("text").alias("t"))
    gone = cut_lineage(repeated_lines(docs, run, min_words)).withColumnsRenamed({"doc_id": "gone_id", "h": "gone_h"})
    keyed = rows.withColumn("h", F.xxhash64("t"))
    # a merge join at every size: texts travel once
    joined = keyed.join(gone.hint("merge"), keyed.doc_id.eqNullSafe(gone.gone_id) & (keyed.h == gone.gone_h), "left")
    lined = _lined(joined).withColumn("out", F.coalesce("gone", F.array().cast("array<int>")))
    pos, out = F.col("pos"), F.col("out")
    drop = F.transform(out, lambda r: pos[r])
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), drop), lambda i: F.col("lines")[i])
    runs = F.size(F.filter(F.transform(out, lambda r, i: r - F.get(out, i - 1)), lambda d: d.isNull() | (d > 1)))
    return lined.select("doc_id", F.size("pos").cast("long").alias("n_lines"),
                        F.size("out").cast("long").alias("n_removed"), runs.cast("long").alias("n_runs"),
                        F.when(F.size("out") == 0, F.col("t")).otherwise(F.array_join(kept, "\n")).alias("kept_text"))
