"""Best-fit packing of documents into sequences of several permitted lengths."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, ship
from .tokenizing import ByteBpeEncoder, shared

ship(__name__)

TOKENIZER = "byte_bpe_50k.json"
LENGTHS = (512, 1024, 2048, 4096, 8192)
#: A sequence of length c costs c + OVERHEAD (its share of a step's fixed cost, in tokens).
OVERHEAD = 64
SHARD_ITEMS = 4096
#: Texts tokenized at once.
ROWS = 500


def expected_fill(sizes: list[int], at: int, length: int) -> int:
    """Tokens that a bin of ``length`` gets if it is opened for sizes[at] (decreasing sizes) and filled with the
    largest of the sizes that follow, as long as one fits."""
    keys = _Falling(sizes)
    used, at = sizes[at], at + 1
    while used < length:
        at = bisect_left(keys, used - length, at)  # the first that is not larger than the room
        if at >= len(sizes):
            break
        used += sizes[at]
        at += 1
    return used


class _Falling:
    """A decreasing list as bisect wants it: negated."""

    def __init__(self, sizes: list[int]) -> None:
        self.sizes = sizes

    def __len__(self) -> int:
        return len(self.sizes)

    def __getitem__(self, i: int) -> int:
        return -self.sizes[i]


def best_fit(sizes: list[int], lengths: tuple[int, ...] = LENGTHS, overhead: int = OVERHEAD) -> list[tuple[int, int, int]]:
    """(bin, offset, bin length) for each size (1 .. max length), sizes in decreasing order.

    Each item goes to the open bin that it leaves least room in, else a new bin is opened.  All permitted lengths that
    hold the item compete for it: each is filled in thought with what still follows, downsized to that, and
    the least cost per token opens (the smaller on ties).  As what follows is shared by all bins, the
    whole is also packed with the largest lengths left out, one after the other, and the cheapest
    packing is taken.  At last every bin is downsized to the least length that holds its contents."""
    lengths = tuple(sorted(lengths))
    best = None
    for ceiling in lengths:
        room: list[tuple[int, int]] = []  # (free tokens, bin), sorted
        used: list[int] = []
        placed = []
        for i, s in enumerate(sizes):
            at = bisect_left(room, (s, -1))
            if at < len(room):
                free, b = room.pop(at)
            else:
                fitting = [c for c in lengths if s <= c <= ceiling] or [next(c for c in lengths if c >= s)]
                fills = [(expected_fill(sizes, i, c), c) for c in fitting]
                _, free = min(((lengths[bisect_left(lengths, u)] + overhead) / u, c) for u, c in fills)
                b = len(used)
                used.append(0)
            placed.append((b, used[b]))
            used[b] += s
            if free > s:
                insort(room, (free - s, b))
        final = [lengths[bisect_left(lengths, u)] for u in used]
        cost = sum(final) + overhead * len(final)
        if best is None or cost < best[0]:
            best = (cost, [(b, o, final[b]) for b, o in placed])
    return best[1]


def pack(items: DataFrame, id_col: str = "doc_id", size_col: str = "n_tokens", lengths: tuple[int, ...] = LENGTHS,
         overhead: int = OVERHEAD, shard_items: int = SHARD_ITEMS) -> DataFrame:
    """doc_id, copy, piece, n_tokens, bin_id, bin_length, offset: where every token range goes.

    A document longer than the largest length is cut into full pieces and a rest (piece counts
    them).  Items are dealt by a hash to shards of about ``shard_items`` items, a number that
    grows with the table, and each shard is packed on its own; equal rows are counted first and
    their copies dealt apart, so a repeated doc_id is no hot shard.  A bin id holds its shard above
    32 bits.  Rows without tokens (null or < 1) need no room: bin_id, bin_length and offset are null."""
    lengths = tuple(sorted(lengths))
    top = lengths[-1]
    rows = pick(items, doc_id=id_col, n_tokens=size_col)
    rows = rows.select("doc_id", F.greatest(F.coalesce(F.col("n_tokens").cast("long"), F.lit(0)), F.lit(0)).alias("n"))
    each = (rows.groupBy("doc_id", "n").agg(F.count(F.lit(1)).alias("copies"))
            .select("doc_id", "n", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")))
    pieces = (each.select("doc_id", "copy", "n", F.explode(F.sequence(
        F.lit(0), F.greatest(F.ceil(F.col("n") / top) - 1, F.lit(0)).cast("int"))).alias("piece"))
        .withColumn("n_tokens", F.least(F.lit(top), F.col("n") - F.col("piece").cast("long") * top).cast("int")).drop("n"))
    count = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.floor(F.col("n") / top)).alias("more")).first()
    shards = max(1, -(-(count.n + (count.more or 0)) // shard_items))
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "copy", "piece", "n_tokens"), F.lit(shards)).cast("long"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n_tokens", "doc_id", "copy", "piece"], ascending=[False, True, True, True],
                              kind="stable").reset_index(drop=True)
        full = pdf.n_tokens.to_numpy() > 0
        placed = np.array(best_fit(pdf.n_tokens[full].tolist(), lengths, overhead) or np.empty((0, 3)), np.int64)
        for i, name in enumerate(("bin_id", "offset", "bin_length")):
            col = pd.array(np.zeros(len(pdf), np.int64), "Int64")
            col[full] = placed[:, i] + (pdf.shard.to_numpy()[full] << 32 if i == 0 else 0)
            col[~full] = pd.NA
            pdf[name] = col
        return pdf[["doc_id", "copy", "piece", "n_tokens", "bin_id", "bin_length", "offset"]]

    kind = dealt.schema["doc_id"].dataType.simpleString()
    return dealt.groupBy("shard").applyInPandas(
        run, f"doc_id {kind}, copy int, piece int, n_tokens int, bin_id long, bin_length long, offset long")


def token_sizes(docs: DataFrame, tokenizer: str = TOKENIZER, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens: ids of the whole text (null: empty) plus one end token."""
    rows = pick(docs, doc_id=id_col, text=text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = shared(("lengths", tokenizer), lambda: ByteBpeEncoder(tokenizer, lengths=True))
        for b in batches:
            n = [size + 1 for lo in range(0, b.num_rows, ROWS)
                 for size in enc.encode_all([t or "" for t in b.column(1).slice(lo, ROWS).to_pylist()])]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64())], names=["doc_id", "n_tokens"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_tokens long")


def pack_documents(docs: DataFrame) -> DataFrame:
    """Tokenize whole documents and pack them."""
    from ..session import cut_lineage
    return pack(cut_lineage(token_sizes(docs)))
