"""Quality rules with host-level verdicts (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import DOC_COLUMNS, HAS_WORD, filter_above, pick, squash_ws

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_HOST_RATE = 0.5
MAX_PRIOR_STRENGTH = 1e6


def _with_words(rows: DataFrame) -> DataFrame:
    """Add words (array), n_words and sorted window keys to a frame with a non-null ``t``.

    Every 3-word window becomes one long: its hash above, its position in the low
    ``bits`` bits.  Sorting that array (primitive longs) puts equal windows side by side."""
    flat = squash_ws(rows, "t", "flat").withColumn("flat", F.trim("flat"))
    worded = (flat.withColumn("words", F.when(F.col("flat") == "", F.array().cast("array<string>"))
                              .otherwise(F.split("flat", " ")))
              .withColumn("n_words", F.coalesce(F.size("words"), F.lit(0)).cast("long")))
    # as many low bits as positions need
    worded = worded.withColumn("bits", F.coalesce(F.length(F.bin("n_words")), F.lit(1)).cast("int"))
    w = F.col("words")
    win = F.transform(
        F.sequence(F.lit(0), (F.col("n_words") - 3).cast("int")),
        lambda i: F.call_function("shiftleft", F.xxhash64(w[i], w[i + 1], w[i + 2]), F.col("bits"))
        .bitwiseOR(i.cast("long")))
    return worded.withColumn("wins", F.when(F.col("n_words") >= 4, F.sort_array(win))
                             .otherwise(F.array().cast("array<bigint>")))


def _n_repeat_words() -> Column:
    """Words that lie in a 3-word window found at least twice in the text.

    Neighbours in the sorted windows with equal hash bits are compared word by word,
    so a hash collision cannot count as a repeat."""
    s, w = F.col("wins"), F.col("words")
    pos = lambda x: x.bitwiseAND(F.expr("shiftleft(1L, bits) - 1")).cast("int")
    top = lambda x: F.call_function("shiftright", x, F.col("bits"))

    def repeated(j):
        a, b = pos(s[j]), pos(s[j + 1])
        return ((top(s[j]) == top(s[j + 1])) & (w[a] == w[b]) & (w[a + 1] == w[b + 1]) & (w[a + 2] == w[b + 2]))

    near = F.filter(F.sequence(F.lit(0), F.size(s) - 2), repeated)
    at = F.flatten(F.transform(near, lambda j: F.array(pos(s[j]), pos(s[j + 1]))))
    covered = F.flatten(F.transform(at, lambda i: F.array(i, i + 1, i + 2)))
    return F.when(F.size(s) >= 2, F.size(F.array_distinct(covered))).otherwise(F.lit(0)).cast("long")


def _base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def base_metrics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 host_col: str = "source") -> DataFrame:
    """doc_id, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed per row.

    One pass over the texts, no shuffle.  A null text has no words.  Words are runs of
    characters other than ASCII white space; a line counts as repeated if it has a word
    and equals an earlier line."""
    rows = pick(docs, doc_id=id_col, text=text_col, host=host_col)
    rows = rows.select("doc_id", "host", F.coalesce("text", F.lit("")).alias("t"))
    lined = rows.withColumn("lines", F.filter(F.split("t", "\n"), lambda x: x.rlike(HAS_WORD)))
    counted = lined.select("doc_id", "host", "t",
                           F.regexp_count("t", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
                           (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"))
    worded = _with_words(counted)
    return (worded.select("doc_id", "host", "n_words",
                          F.length(F.replace("flat", F.lit(" "), F.lit(""))).cast("long").alias("word_chars"),
                          "n_symbols", "n_dup_lines", _n_repeat_words().alias("n_repeat_words"))
            .withColumn("base_failed", _base_failed()))


def host_verdicts(scored: DataFrame, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """host, n_docs, n_failed, rate (shrunk), host_ok from rows with host and base_failed.

    Failures are summed per host before the shuffle, so a host with a third of all rows
    is one row per task.  The beta prior is fitted over all hosts by moments: mean = the
    pooled failure rate mu, strength = mu(1-mu)/between - 1, where ``between`` is the
    row-weighted variance of host rates less its binomial noise (none left: the largest
    strength).  The posterior mean (failed + mu*strength)/(n + strength) is compared with
    ``max_rate``.  A null host is a host of its own.  One row (five sums) reaches the driver."""
    hosts = cut_lineage(scored.groupBy("host").agg(F.count(F.lit(1)).alias("n_docs"),
                                                  F.sum(F.col("base_failed").cast("long")).alias("n_failed")))
    n, f = F.col("n_docs"), F.col("n_failed")
    s = hosts.agg(F.sum(n).alias("n"), F.sum(f).alias("f"), F.count(F.lit(1)).alias("h"),
                  F.sum(f * f / n).alias("q")).first()
    mu, strength = 0.0, MAX_PRIOR_STRENGTH
    if s.n:
        mu = s.f / s.n
        spread = mu * (1 - mu)
        between = s.q / s.n - mu * mu - spread * (s.h - 1) / s.n
        if between > 0 and spread > 0:
            strength = min(MAX_PRIOR_STRENGTH, max(0.0, spread / between - 1))
    rate = (f + F.lit(mu * strength)) / (n + F.lit(strength))
    return hosts.withColumn("rate", rate).withColumn("host_ok", F.col("rate") <= F.lit(max_rate))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                  max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """One row per document: the base metrics, base_failed and kept.

    kept is false if the base rules fail, else the verdict of the row's host, joined
    back.  The numbers (not the texts) are written once and read by both the host
    aggregate and the join; repeated rows stay repeated; an empty table gives no rows."""
    scored = cut_lineage(base_metrics(docs, id_col, text_col, host_col))
    bad = cut_lineage(host_verdicts(scored, max_host_rate).filter("NOT host_ok")
                      .select(F.col("host").alias("bad_host"), F.lit(True).alias("bad")))
    joined = scored.join(bad, scored.host.eqNullSafe(bad.bad_host), "left")
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", (~F.col("base_failed") & F.col("bad").isNull()).alias("kept"))


def keep_passing(docs: DataFrame, max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """The rows of a documents table that the rules keep, with the columns of documents.

    The few rejected hosts are written first, so the second pass over the texts filters
    them in place and no text is shuffled unless that table is large."""
    def failing(rows: DataFrame) -> DataFrame:
        worded = _with_words(rows.withColumn("t", F.coalesce("text", F.lit(""))))
        return worded.withColumn("n_repeat_words", _n_repeat_words()).withColumn("base_failed", _base_failed())

    rows = pick(docs, *DOC_COLUMNS)
    marks = failing(rows).select(F.col("source").alias("host"), "base_failed")
    bad = cut_lineage(host_verdicts(marks, max_host_rate).filter("NOT host_ok")
                      .select(F.col("host").alias("bad_host")))
    good = filter_above(failing(rows), ~F.col("base_failed")).select(*DOC_COLUMNS)
    return good.join(bad, good.source.eqNullSafe(bad.bad_host), "left_anti")
