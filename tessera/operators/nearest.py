"""Exact nearest other item by pivot distances.

Every vector's distances to a few pivots are known.  Vectors are dealt to their closest pivot and, within it,
into rings of bounded size by that distance; a block keeps the smallest and largest distance of its
vectors to every pivot.  By the triangle inequality no vector of a block can be closer to x than the largest gap
between x's pivot distances and the block's ranges, so x, which knows its best neighbour within its own block,
visits only the blocks whose gap does not exceed that.  The result is exact for any pivots; they only decide
how much is skipped.

Equal vectors are solved before the search, by grouping, so copies do not swell a block.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .ordering import BLOCK, deal

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of the package

PIVOTS = 32
BLOCK_ROWS = 4096  # in many dimensions few blocks can be skipped: a visitor then travels once per so many rows
VISITORS = 8192  # visitors that meet a block's vectors in one task
ROUNDING = 4e-15  # a product's relative rounding, per coordinate, with room
SLACK = 1e-9     # bounds are loosened by this part, so that rounding cannot skip a block


def _to_matrix(col) -> np.ndarray:
    flat = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    return np.asarray(flat.flatten(), dtype=float).reshape(len(flat), -1)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All squared distances, summed in order of the coordinates."""
    d = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        diff = a[:, j:j + 1] - b[None, :, j]
        d += diff * diff
    return d


def _best(ids, vecs, other_ids, others, step: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """(id, squared distance) of the closest other for every row; lowest id on ties.

    A matrix product gives every distance up to rounding; those that rounding could make the smallest are
    summed again in order of the coordinates, so the result is that of ``squared`` over all pairs."""
    order = np.argsort(other_ids, kind="stable")
    other_ids, others = other_ids[order], others[order]
    nn, dist = np.full(len(ids), -1, np.int64), np.full(len(ids), np.inf)
    if not len(others):
        return nn, dist
    with np.errstate(over="ignore", invalid="ignore"):
        norms, own = (others * others).sum(axis=1), (vecs * vecs).sum(axis=1)
        slack = (own + norms.max()) * (ROUNDING * (vecs.shape[1] + 4))
    for at in range(0, len(ids), step):
        part, mine = vecs[at:at + step], ids[at:at + step]
        same = mine[:, None] == other_ids[None, :] if np.isin(mine, other_ids).any() else np.zeros((1, 1), bool)
        if np.isfinite(slack[at:at + step]).all():
            d = norms[None, :] - 2.0 * (part @ others.T)
            d = np.where(same, np.inf, d) if same.any() else d
            least = d.min(axis=1) + slack[at:at + step]
            row, col = np.nonzero((d <= least[:, None]) & (d < np.inf))
            exact = np.zeros(len(row))
            for j in range(vecs.shape[1]):
                diff = part[row, j] - others[col, j]
                exact += diff * diff
            by = np.lexsort((col, exact, row))  # per row the smallest distance, then the lowest id
            first = by[np.unique(row[by], return_index=True)[1]]
            dist[at + row[first]], nn[at + row[first]] = exact[first], other_ids[col[first]]
        else:  # numbers whose squares are out of range
            d = np.where(same, np.inf, squared(part, others))
            k = np.argmin(d, axis=1)
            dist[at:at + step] = d[np.arange(len(k)), k]
            nn[at:at + step] = other_ids[k]
    return nn, dist


def nearest_items(df: DataFrame, id_col: str, vec_cols: Sequence[str], block_rows: int = BLOCK_ROWS,
                  pivots: int = PIVOTS, visits: list | None = None) -> DataFrame:
    """Id, nearest_id and sq_dist: for every item the other item at the smallest squared distance (lowest id on
    ties), exactly.  Items with a missing coordinate, and a single item, have no nearest and no row.

    Pivots are up to ``pivots`` distinct vectors, the first by hash.  ``visits``, if given, receives (rows sent to
    other blocks, rows times other blocks)."""
    cols = list(vec_cols)
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.array(*[F.col(c).cast("double") for c in cols]).alias("v"))
    rows = rows.where(~F.exists("v", lambda x: x.isNull()))
    same = cut_lineage(rows.groupBy("v").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n")))
    copied = rows.join(same.where("n > 1").withColumnRenamed("id", "low"), "v")
    # of equal vectors each has the lowest other id: one small row per group for its second lowest
    second = copied.where("id != low").groupBy("low").agg(F.min("id").alias("second"))
    twins = (copied.join(second, "low").select(
        F.col("id").alias(id_col), F.when(F.col("id") == F.col("low"), F.col("second")).otherwise(F.col("low")).alias("nearest_id"),
        F.lit(0.0).alias("sq_dist")))

    chosen = np.array([r.v for r in same.orderBy(F.xxhash64("v"), "id").limit(pivots).collect()], dtype=float)
    if not len(chosen):
        return twins

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            d = np.sqrt(squared(_to_matrix(b.column(1)), chosen))
            own = np.argmin(d, axis=1)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(own, pa.int32()), pa.array(d[np.arange(len(d)), own]), pa.array(list(d), pa.list_(pa.float64()))],
                names=["id", "v", "single", "pivot", "dist", "far"])

    placed = cut_lineage(same.select("id", "v", (F.col("n") == 1).alias("single")).mapInArrow(
        assign, "id long, v array<double>, single boolean, pivot int, dist double, far array<double>"))
    d = deal(placed, "pivot", ["dist", "id"], block_rows)
    dealt = cut_lineage(d.frame)
    ranges = dealt.groupBy("pivot", BLOCK).agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.min(F.col("far")[i]) for i in range(len(chosen))]).alias("lo"),
        F.array(*[F.max(F.col("far")[i]) for i in range(len(chosen))]).alias("hi")).collect()  # blocks are bounded in number
    keys = {(r["pivot"], r[BLOCK]): i for i, r in enumerate(ranges)}
    lo, hi = np.array([r["lo"] for r in ranges]), np.array([r["hi"] for r in ranges])

    def inside(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, vecs = pdf["id"].to_numpy(), np.stack(pdf["v"].to_numpy())
        ask = pdf["single"].to_numpy()
        nn, dist = _best(ids[ask], vecs[ask], ids, vecs)
        return pd.DataFrame({"id": ids[ask], "nn": nn, "d": dist, "v": pdf["v"][ask], "far": pdf["far"][ask],
                             "home": keys[pdf["pivot"].iloc[0], pdf[BLOCK].iloc[0]]})

    own = cut_lineage(dealt.groupBy("pivot", BLOCK).applyInPandas(
        inside, "id long, nn long, d double, v array<double>, far array<double>, home int"))

    def to_visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            far = _to_matrix(b.column(2))
            bound = np.sqrt(b.column(1).to_numpy()) * (1 + SLACK) + SLACK
            gap = np.zeros((len(far), len(lo)))
            for i in range(far.shape[1]):
                np.maximum(gap, lo[None, :, i] - far[:, i:i + 1], out=gap)
                np.maximum(gap, far[:, i:i + 1] - hi[None, :, i], out=gap)
            goes = gap <= bound[:, None]
            goes[np.arange(len(far)), b.column(3).to_numpy()] = False
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([np.flatnonzero(g) for g in goes], pa.list_(pa.int32()))],
                                             names=["id", "blocks"])

    asked = own.select("id", "d", "far", "home").mapInArrow(to_visit, "id long, blocks array<int>")
    moves = cut_lineage(asked.select("id", F.explode("blocks").alias("block")))
    load = moves.groupBy("block").agg(F.count(F.lit(1)).alias("n")).collect()
    if visits is not None:
        visits.append((sum(r.n for r in load), own.count() * (len(ranges) - 1)))
    if not load:
        found = own.select("id", F.struct("d", "nn").alias("m"))
    else:
        parts = [(r.block, -(-r.n // VISITORS)) for r in load]
        salts = F.broadcast(df.sparkSession.createDataFrame(parts, "block int, parts int"))
        number = F.broadcast(df.sparkSession.createDataFrame([(*k, i) for k, i in keys.items()], "pivot int, _b int, block int"))
        guests = (moves.join(salts, "block").join(own.select("id", "v"), "id")
                  .select("block", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part"), "id", "v"))
        hosts = (dealt.join(number, [dealt["pivot"] == number["pivot"], dealt[BLOCK] == number["_b"]]).select("block", "id", "v")
                 .join(salts, "block").select("block", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
                                              F.col("id").alias("hid"), F.col("v").alias("hv")))

        def visit(g: pd.DataFrame, h: pd.DataFrame) -> pd.DataFrame:
            if g.empty or h.empty:
                return pd.DataFrame({"id": pd.Series([], dtype="int64"), "nn": pd.Series([], dtype="int64"), "d": pd.Series([], dtype="float64")})
            ids = g["id"].to_numpy()
            nn, dist = _best(ids, np.stack(g["v"].to_numpy()), h["hid"].to_numpy(), np.stack(h["hv"].to_numpy()))
            return pd.DataFrame({"id": ids, "nn": nn, "d": dist})

        abroad = guests.groupBy("block", "part").cogroup(hosts.groupBy("block", "part")).applyInPandas(visit, "id long, nn long, d double")
        found = (own.select("id", "nn", "d").unionByName(abroad).groupBy("id").agg(F.min(F.struct("d", "nn")).alias("m")))
    found = found.where(F.col("m.d") < F.lit(float("inf"))).select(
        F.col("id").alias(id_col), F.col("m.nn").alias("nearest_id"), F.col("m.d").alias("sq_dist"))
    return found.unionByName(twins)
