"""Dedup of repeated byte strings by hashes at anchors sampled by content (no doubling, no sorted suffixes)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import pick, present, ship

ship(__name__)

LENGTH = 400
#: Starts per window that one sampled suffix stands for; a power of two.
WINDOW = 128
GRAM = 8
CHUNK = 1 << 20
ROWS_OUT = 200_000
#: Classes of more distinct contents rank their strings one by one.
CLASS = 64


def sample_suffixes(raw: bytes, length: int = LENGTH, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """a, first, last: each start p of a ``length``-byte string belongs to the suffix a >= p whose gram hash is
    the least (leftmost among equals) of the ``window`` grams from p on; a serves the starts first .. last.
    a - p depends on the string alone, so equal strings are served at equal distances."""
    starts = len(raw) - length + 1
    if starts <= 0:
        none = np.empty(0, np.int64)
        return none, none, none
    buf = np.frombuffer(raw, np.uint8)
    found = []
    for base in range(0, starts, CHUNK):
        n = min(CHUNK, starts - base)
        part = buf[base:base + n + window - 1 + GRAM - 1].astype(np.uint64)
        gram = part[:n + window - 1].copy()
        for j in range(1, GRAM):
            gram |= part[j:j + n + window - 1] << np.uint64(8 * j)
        gram = (gram ^ (gram >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
        gram ^= gram >> np.uint64(32)
        key = (gram * np.uint64(0xD6E8FEB86659FD93)) & ~np.uint64((1 << 22) - 1) | np.arange(len(gram), dtype=np.uint64)
        step = 1
        while step < window:
            key = np.minimum(key[:-step], key[step:])
            step *= 2
        found.append((key & np.uint64((1 << 22) - 1)).astype(np.int64) + base)
    at = np.concatenate(found)
    cut = np.flatnonzero(np.diff(at)) + 1
    first = np.concatenate(([0], cut))
    return at[first], first, np.concatenate((cut, [starts])) - 1


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.asarray(x, np.uint64).view(np.int64))


def _pair(data: bytes) -> tuple[int, int]:
    x = xxhash.xxh3_128_intdigest(data)
    return x >> 64, x & 0xFFFFFFFFFFFFFFFF


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, t, k1, k2: rows equal in doc_id and text share the 128-bit key and count as one document."""
    rows = pick(docs, doc_id=id_col, text=text_col).select("doc_id", present("text").alias("t"))
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    return rows.withColumn("k1", F.xxhash64(name, "t")).withColumn("k2", F.xxhash64("t", name, F.lit(1)))


def _ranks(keyed: DataFrame, length: int, window: int) -> DataFrame:
    """f of every sampled suffix, as in ``_marks``, and nothing else."""
    half = length - window + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t in b.column(0):
                raw = t.as_py().encode()
                a = sample_suffixes(raw, length, window)[0].tolist()
                for at in range(0, len(a), ROWS_OUT):
                    f = [xxhash.xxh3_64_intdigest(raw[x:x + half]) for x in a[at:at + ROWS_OUT]]
                    yield pa.RecordBatch.from_arrays([_signed(np.array(f, np.uint64))], names=["f"])

    return keyed.select("t").mapInArrow(run, "f long")


def _several_places(*place: str) -> Column:
    """Whether the rows of a group name more than one place: then some part of it has two values."""
    out = F.lit(False)
    for c in place:
        out = out | (F.min(c) != F.max(c))
    return out


def _marks(keyed: DataFrame, length: int, window: int) -> DataFrame:
    """k1, k2, a, lo, hi, f, u1, u2 per sampled suffix: it serves the starts a - hi .. a - lo; f ranks its
    first length - window + 1 bytes, which lie in every string it serves; u1, u2 rank all of their bytes."""
    half = length - window + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols: list[list] = [[] for _ in range(8)]

            def flush(cols=cols):
                names = ["k1", "k2", "a", "lo", "hi", "f", "u1", "u2"]
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
                out = [pa.array(c, k) for c, k in zip(cols[:5], kinds, strict=True)]
                out += [_signed(np.array(c, np.uint64)) for c in cols[5:]]
                for c in cols:
                    c.clear()
                return pa.RecordBatch.from_arrays(out, names=names)

            for t, k1, k2 in zip(b.column(0), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                raw = t.as_py().encode()
                a, first, last = sample_suffixes(raw, length, window)
                for x, p, q in zip(a.tolist(), first.tolist(), last.tolist(), strict=True):
                    hull = _pair(raw[p:q + length])
                    for c, v in zip(cols, (k1, k2, x, x - q, x - p, xxhash.xxh3_64_intdigest(raw[x:x + half]), *hull),
                                    strict=True):
                        c.append(v)
                if len(cols[0]) > ROWS_OUT:
                    yield flush()
            if cols[0]:
                yield flush()

    return keyed.select("t", "k1", "k2").mapInArrow(
        run, "k1 long, k2 long, a long, lo int, hi int, f long, u1 long, u2 long")


def _contexts(served: DataFrame, length: int, window: int) -> DataFrame:
    """The listed suffixes (t, k1, k2, spans) with their bytes.  In a small class: x1, x2 rank the bytes that lie in
    every string the suffix serves, p is its place, l and r are the other bytes of these strings, before and after.
    In a big one: x1, x2 rank the whole string at every start p it serves, and l, r are null."""
    half = length - window + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["x1", "x2", "k1", "k2", "p", "lo", "hi", "open", "l", "r"]
        kinds = [pa.uint64()] * 2 + [pa.int64()] * 3 + [pa.int32()] * 2 + [pa.bool_(), pa.binary(), pa.binary()]
        rows: list[tuple] = []

        def flush(rows=rows):
            cols = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            rows.clear()
            return pa.RecordBatch.from_arrays([*(c.view(pa.int64()) for c in cols[:2]), *cols[2:]], names=names)

        for b in batches:
            for t, k1, k2, spans in zip(b.column(0), b.column(1).to_pylist(), b.column(2).to_pylist(),
                                        b.column(3).to_pylist(), strict=True):
                raw = t.as_py().encode()
                for x in spans:
                    if not x["big"]:
                        a, lo, hi = x["a"], x["lo"], x["hi"]
                        rows.append((*_pair(raw[a:a + half]), k1, k2, a, lo, hi, x["open"], raw[a - hi:a], raw[a + half:a - lo + length]))
                if len(rows) >= ROWS_OUT:
                    yield flush()
                for p in sorted({p for x in spans if x["big"] for p in range(x["a"] - x["hi"], x["a"] - x["lo"] + 1)}):
                    rows.append((*_pair(raw[p:p + length]), k1, k2, p, None, None, None, None, None))
                    if len(rows) >= ROWS_OUT:
                        yield flush()
        if rows:
            yield flush()

    return served.select("t", "k1", "k2", "spans").mapInArrow(
        run, "x1 long, x2 long, k1 long, k2 long, p long, lo int, hi int, open boolean, l binary, r binary")


def _shared(classes: DataFrame, window: int) -> DataFrame:
    """k1, k2, s, e: the starts at which an open suffix of a class (rows: place, lo, hi, open, l, r) has a string in common
    with another.  Two suffixes share the string that starts d before them if they agree on d bytes before and on
    window - 1 - d bytes after what the class has in common: an interval of d per pair."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def agree(x: int, y: int) -> int:
            z = x ^ y
            return ((z & -z).bit_length() - 1) // 8 if z else window

        for b in batches:
            out = set()
            for rows in b.column(0).to_pylist():
                have = [(x["lo"], x["hi"], int.from_bytes(x["l"], "big"), int.from_bytes(x["r"], "little")) for x in rows]
                for i, (lo, hi, left, right) in enumerate(have):
                    for j in range(i):
                        if not (rows[i]["open"] or rows[j]["open"]):
                            continue
                        lo2, hi2, left2, right2 = have[j]
                        most = min(hi, hi2, agree(left, left2))
                        if most < max(lo, lo2):
                            continue
                        least = max(lo, lo2, window - 1 - agree(right, right2))
                        if least <= most:
                            out.update((x["k1"], x["k2"], x["p"] - most, x["p"] - least) for x in (rows[i], rows[j]) if x["open"])
            cols = zip(*out, strict=True) if out else ((),) * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["k1", "k2", "s", "e"])

    return classes.select("rows").mapInArrow(run, "k1 long, k2 long, s long, e long")


def repeated_starts(docs: DataFrame, length: int = LENGTH, window: int = WINDOW, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """k1, k2, spans: per document the ranges s .. e of starts of strings that also start elsewhere.

    Anchor sampling and direct hash grouping in place of prefix doubling: no position is sorted and no
    pair of ranks is formed.  Round 1 hashes the bytes at each sampled anchor (over half of the length);
    Spark groups the hashes and suffixes that are alone drop out.  Round 2 hashes the full length
    directly: suffixes that agree on all bytes of all strings they serve are settled
    together; in the classes with others left, one suffix per distinct content goes on.  Classes of up to
    CLASS contents compare the bytes around the anchor, which gives ranges of starts, not single ones; in
    larger classes each suffix ranks every string it serves at full length and equal ranks meet again.
    Ranks at full length are 128-bit hashes of the bytes.  Other groups are only ever reduced to a count,
    one place and the bounds of its parts."""
    keyed = _keyed(docs, id_col, text_col)
    marks = _marks(keyed, length, window)
    twice = cut_lineage(_ranks(keyed, length, window).groupBy("f").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("f"))
    alive = cut_lineage(marks.join(twice, "f", "left_semi"))
    content = ["f", "lo", "hi", "u1", "u2"]
    # the three firsts of a group come from one row; any row will do, as the contents are equal
    hulls = cut_lineage(alive.groupBy(*content).agg(*[F.first(c).alias(c) for c in ("k1", "k2", "a")],
                                                    _several_places("k1", "k2", "a").alias("settled")))
    spans = alive.join(hulls.filter("settled").select(*content), content, "left_semi").select(
        "k1", "k2", (F.col("a") - F.col("hi")).alias("s"), (F.col("a") - F.col("lo")).alias("e"))
    left = cut_lineage(hulls.groupBy("f").agg(F.count(F.lit(1)).alias("n"), F.min("settled").alias("done"))
                       .filter("n > 1 AND NOT done").select("f", (F.col("n") > CLASS).alias("big")))
    asked = cut_lineage(hulls.join(left, "f")
                        .select("k1", "k2", F.struct("a", "lo", "hi", (~F.col("settled")).alias("open"), "big").alias("span"))
                        .groupBy("k1", "k2").agg(F.collect_set("span").alias("spans")))
    texts = keyed.join(asked, ["k1", "k2"]).select("t", "k1", "k2", "spans")
    found = cut_lineage(_contexts(texts, length, window))
    # a set, as repeated rows of a document bring its suffixes again
    classes = found.filter("l IS NOT NULL").groupBy("x1", "x2").agg(
        F.collect_set(F.struct("k1", "k2", "p", "lo", "hi", "open", "l", "r")).alias("rows"))
    ranked = found.filter("l IS NULL").select("x1", "x2", "k1", "k2", "p")
    equal = cut_lineage(ranked.groupBy("x1", "x2").agg(_several_places("k1", "k2", "p").alias("several"))
                        .filter("several").select("x1", "x2"))
    single = ranked.join(equal, ["x1", "x2"], "left_semi").select("k1", "k2", F.col("p").alias("s"), F.col("p").alias("e"))
    return (spans.unionByName(_shared(classes, window)).unionByName(single)
            .groupBy("k1", "k2").agg(F.collect_set(F.struct("s", "e")).alias("spans")))


def covered(spans: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """Merged byte ranges of strings of ``length`` starting in the given ranges of starts."""
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e + length)
        else:
            out.append([s, e + length])
    return [(s, e) for s, e in out]


def suffix_dedup(docs: DataFrame, length: int = LENGTH, window: int = WINDOW, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept (remaining bytes), removed (array of ranges).

    Removes every byte covered by a string of ``length`` bytes that also starts anywhere else in the
    corpus, the same text included.  Null texts are empty; texts shorter than ``length`` stay whole;
    repeated rows (same doc_id and text) are one document and come out repeated."""
    keyed = _keyed(docs, id_col, text_col)
    gone = cut_lineage(repeated_starts(docs, length, window, id_col, text_col))
    joined = keyed.join(gone, ["k1", "k2"], "left").select("doc_id", "t", "spans")
    kind = keyed.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for t, spans in zip(b.column(1), b.column(2).to_pylist(), strict=True):
                raw = t.as_py().encode()
                cut = covered([(x["s"], x["e"]) for x in spans or []], length)
                edges = [0, *(y for c in cut for y in c), len(raw)]
                kept = b"".join(raw[s:e] for s, e in zip(edges[::2], edges[1::2], strict=True))
                rows.append((len(raw), len(raw) - len(kept), len(cut), kept, [{"s": s, "e": e} for s, e in cut]))
            n, gone_n, runs, kept, cuts = zip(*rows, strict=True) if rows else ((),) * 5
            ranges = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(gone_n, pa.int64()), pa.array(runs, pa.int64()),
                 pa.array(kept, pa.binary()), pa.array(cuts, ranges)],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "removed"])

    return joined.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary, "
                                  "removed array<struct<s: long, e: long>>")
