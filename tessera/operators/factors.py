"""Factor training and scoring in blocks.

Users and items are hashed into blocks; ratings are written once by (user block, item block), in pieces of
bounded size, and stay where they are.  In a training step one task moves one block: it reads the blocks of the other
side one by one beside the cells between them and adds up the block's whole gradient, so neither ratings nor gradients
travel, and nothing is kept from step to step but the factors.  A hot user's ratings are streamed in one task a step.

Scoring for all users uses the same cells: a block of users times a block of items is a matrix product in one
task, of which only each user's best unrated items leave it.
"""

from __future__ import annotations

import math
import sys
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle, inheritable_thread_target
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..session import SWEPT, cut_lineage, drop_table, ensure_checkpoint_dir, session_conf

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of the package

# Adam's default decay rates and epsilon of the optimiser the
# reference trains with.
ADAM_B1, ADAM_B2, ADAM_EPS = 0.9, 0.999, 1e-7
BLOCK_ROWS = 16_384     # users or items in a block
PIECE_ROWS = 100_000    # ratings in a piece of a cell, scoring
FEWEST = 4              # blocks a side, however few rows
HEAD = 2048             # items of the largest bound that every user meets first
PIECE = 1 << 16         # ratings in a stored piece of a cell, training
MERGED = 1 << 17        # ratings of a cell worked on at once
CHUNK = 1 << 13         # the same while they meet their factors
CHUNK_BYTES = 1 << 20   # of factors in a stored row
GROUP_BYTES = 64 << 20  # of the other side's blocks that a task holds at once
#: Rows of about a megabyte: a few of them, not the usual thousands, make a batch or a row group.
FEW_ROWS = {"spark.sql.parquet.columnarReaderBatchSize": "4", "spark.sql.execution.arrow.maxRecordsPerBatch": "8"}
STORED = {"parquet.block.size": 8 << 20, "parquet.block.size.row.check.min": 1, "parquet.page.size.row.check.min": 1,
          "parquet.enable.dictionary": "false"}
BLOCKS = 8              # blocks a side in training are as many as cores, four times this at most, while a block stays below
BLOCK_BYTES = 32 << 20  # this: every block is read once for each block of the other side


def _block_count(count: int, wide: int, rows: int, most: int | None) -> int:
    n = math.ceil(count / rows)
    if most:
        n = min(n, max(most, math.ceil(count * wide * 8 / BLOCK_BYTES)))
    return max(FEWEST, n)


def _packed(fac: DataFrame, key: str, names: list[str], n: int) -> DataFrame:
    one = fac.select(F.pmod(F.xxhash64(key), F.lit(n)).cast("int").alias("block"),
                     F.struct(F.col(key).alias("id"), F.array(*names).alias("f")).alias("r"))
    packed = one.groupBy("block").agg(F.sort_array(F.collect_list("r")).alias("r"))  # a block's rows: bounded
    return packed.select("block", F.col("r.id").alias("ids"), F.flatten("r.f").alias("f"))


def _blocks(fac: DataFrame, key: str, names: list[str], rows: int, most: int | None = None) -> tuple[DataFrame, int]:
    """(block, ids, f): the factor table as one row per block, ids sorted; and the number of blocks, ``most`` if given
    while they stay below BLOCK_BYTES."""
    n = _block_count(fac.count(), len(names), rows, most)
    return cut_lineage(_packed(fac, key, names, n)), n


def _cells(ratings: DataFrame, user: str, item: str, rating: str, ublocks: DataFrame, iblocks: DataFrame, nu: int, ni: int,
           piece: int = PIECE_ROWS) -> DataFrame:
    """(cell, ub, ib, u, i, y): positions within the blocks and values of the ratings of a cell, in pieces."""
    def places(blocks: DataFrame, key: str, b: str, at: str) -> DataFrame:
        return blocks.select(F.col("block").alias(b), F.posexplode("ids").alias(at, key))
    placed = (ratings.select(F.col(user).alias("_u"), F.col(item).alias("_i"), F.col(rating).cast("double").alias("y"))
              .join(places(ublocks, "_u", "ub", "u"), "_u").join(places(iblocks, "_i", "ib", "i"), "_i"))
    placed = cut_lineage(placed.select("ub", "ib", "u", "i", "y", F.xxhash64("_u", "_i").alias("h")))
    sizes = placed.groupBy("ub", "ib").agg(F.count(F.lit(1)).alias("n"))  # at most a row per cell
    pieces = placed.join(F.broadcast(sizes.select("ub", "ib", F.ceil(F.col("n") / piece).alias("parts"))), ["ub", "ib"])
    pieces = pieces.withColumn("piece", F.pmod("h", "parts"))
    grouped = pieces.groupBy("ub", "ib", "piece").agg(F.sort_array(F.collect_list(F.struct("u", "i", "y"))).alias("r"))
    return cut_lineage(grouped.select((F.col("ub").cast("long") * ni + F.col("ib")).alias("cell"), "ub", "ib",
                                      F.col("r.u").alias("u"), F.col("r.i").alias("i"), F.col("r.y").alias("y")))


def _doubles(col, row: int) -> np.ndarray:
    return np.asarray(col[row].values, dtype=float)


class Grid:
    """Ratings and factors of one run, as tables in a folder of the shared checkpoint directory that ``close`` removes.

    ``cells``/ub/ib holds the positions within the blocks and the values of a cell's ratings in pieces, sorted by
    user; a factor table holds a block, in numbered chunks, in a folder of its own.  A task works on one block: it reads
    that block, then the other side's by groups of a few and the cells between them, so nothing is shuffled and a task
    holds a block, a group and a few pieces, however many there are.  Factors are bytes of doubles, ids Arrow streams."""

    def __init__(self, ratings: DataFrame, items: DataFrame, users: DataFrame, user: str, item: str, rating: str, k: int,
                 block_rows: int = BLOCK_ROWS, piece_rows: int | None = None):
        self.spark, self.k = ratings.sparkSession, k
        self.root = f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/factors/{uuid.uuid4().hex}"
        cores = self.spark.sparkContext.defaultParallelism
        self.pool = ThreadPoolExecutor(max(1, min(cores, 32)))
        self.names = ([*(f"f_{j}" for j in range(k)), "b"], [f"f_{j}" for j in range(k)])
        self.keys, self.frames = (user, item), (users, items)
        self.kinds = [fac.schema[key].dataType for fac, key in zip(self.frames, self.keys, strict=True)]
        self.blocks, self.groups, self.state, n = [], [], [f"{self.root}/0_users", f"{self.root}/0_items"], []
        try:
            with session_conf(self.spark, SWEPT):
                for side in (0, 1):
                    fac, key, names = self.frames[side], self.keys[side], self.names[side]
                    count = fac.count()
                    n.append(_block_count(count, len(names), block_rows, max(FEWEST, min(cores, 4 * BLOCKS))))
                    dealt = fac.select(F.pmod(F.xxhash64(key), F.lit(n[side])).cast("int").alias("block"), F.col(key).alias("id"), *names)
                    size = max(1, CHUNK_BYTES // (8 * len(names)))
                    self.write(dealt.repartition(n[side], "block").sortWithinPartitions("block", "id").mapInArrow(
                        lambda batches, size=size: _chunks(batches, size), "block int, at int, ids binary, f binary"), self.state[side], "block")
                    now = self.read(self.state[side], "at int, ids binary, block int")
                    self.blocks.append(sorted(r["block"] for r in now.select("block").distinct().collect()))  # a number per block
                    few = max(1, GROUP_BYTES * n[side] // max(1, count * len(names) * 8))
                    self.groups.append([self.blocks[side][at:at + few] for at in range(0, len(self.blocks[side]), few)])
                    self.write(now, f"{self.root}/ids_{side}", "block")
                self.ids = [self.read(f"{self.root}/ids_{side}", "at int, ids binary, block int") for side in (0, 1)]
                self._deal(ratings, rating, n, piece_rows or PIECE)
        except BaseException:
            self.close()
            raise

    def read(self, path: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(path)

    def write(self, df: DataFrame, path: str, *by: str, compression: str = "snappy") -> None:
        df.write.options(**STORED, compression=compression).partitionBy(*by).parquet(path)

    def factors(self, side: int) -> DataFrame:
        return self.read(self.state[side], "at int, f binary, m binary, v binary, old_sq double, sse double, block int")

    def each(self, side: int, job) -> None:
        """``job`` for every block of a side, so many at once as there are cores."""
        with session_conf(self.spark, FEW_ROWS):
            list(self.pool.map(inheritable_thread_target(self.spark)(job), self.blocks[side]))

    def close(self) -> None:
        self.pool.shutdown()
        drop_table(self.spark, self.root)

    def _deal(self, ratings: DataFrame, rating: str, n: list[int], piece: int) -> None:
        typed = [c if ratings.schema[key].dataType == kind else c.try_cast(kind)
                 for key, kind, c in zip(self.keys, self.kinds, map(F.col, self.keys), strict=True)]
        one = ratings.select(typed[0].alias("_u"), typed[1].alias("_i"), F.col(rating).cast("double").alias("y")).dropna()
        place = lambda key, m: F.pmod(F.xxhash64(*key), F.lit(m)).cast("int")
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        spread = math.ceil(2 * parts / (n[0] * n[1]))
        dealt = (one.select(place(["_u"], n[0]).alias("ub"), place(["_i"], n[1]).alias("ib"), place(["_u", "_i"], spread).alias("s"), "_u", "_i", "y")
                 .repartition(parts, "ub", "ib", "s").sortWithinPartitions("ub", "ib").drop("s"))
        raw, done = f"{self.root}/raw", f"{self.root}/cells"
        self.write(dealt.mapInArrow(lambda batches: _pieces(batches, piece), "ub int, ib int, r binary"), raw, "ub", "ib")
        pieces = self.read(raw, "r binary, ub int, ib int")
        self.cells_of = self._met(pieces)

        def job(b: int) -> None:
            found = self.beside(0, b, self.ids[0], self.ids[1], pieces)
            self.write(found.mapInArrow(_positions, "ib int, u binary, i binary, y binary"), f"{done}/ub={b}", "ib")

        self.each(0, job)
        if not self.blocks[0]:
            self.spark.createDataFrame([], "u binary, i binary, y binary, ub int, ib int").write.parquet(done)
        self.cells = self.read(done, "u binary, i binary, y binary, ub int, ib int")
        self.cells_of = self._met(self.cells)
        drop_table(self.spark, raw)

    def _met(self, cells: DataFrame) -> set[tuple[int, int]]:
        return {(r["ub"], r["ib"]) for r in cells.select("ub", "ib").distinct().collect()}  # at most a row per cell

    def beside(self, side: int, b: int, mine: DataFrame, other: DataFrame, cells: DataFrame) -> DataFrame:
        """(kind, block, at, bytes..) in one partition, in this order: block ``b`` of ``mine`` (kind 0); then group by group
        the blocks of the other side that have ratings here (1) and the pieces of these cells (2)."""
        own, away = (("ub", "ib"), ("ib", "ub"))[side]
        known = ("ub", "ib", "block", "at")
        wide = max(sum(c not in known for c in x.columns) for x in (mine, cells))

        def rows(df: DataFrame, kind: int, key: str) -> DataFrame:
            had = [c for c in df.columns if c not in known]
            return df.select(F.lit(kind).alias("kind"), F.col(key).alias("block"), F.col("at") if "at" in df.columns else F.lit(0).alias("at"),
                             *[F.col(c).alias(f"c{i}") for i, c in enumerate(had)],
                             *[F.lit(None).cast("binary").alias(f"c{i}") for i in range(len(had), wide)])

        found, far, met = rows(mine, 0, "block").where(F.col("block") == b), rows(other, 1, "block"), rows(cells.where(F.col(own) == b), 2, away)
        for group in self.groups[1 - side]:
            if some := [o for o in group if ((b, o) if side == 0 else (o, b)) in self.cells_of]:
                found = found.union(far.where(F.col("block").isin(some))).union(met.where(F.col("block").isin(some)))
        return found.coalesce(1)

    def step(self, t: int, lam: float, lr: float, adam: bool) -> float:
        """All factors moved by their gradients; the cost before."""
        alpha = lr * math.sqrt(1 - ADAM_B2 ** t) / (1 - ADAM_B1 ** t) if adam else lr
        new = [f"{self.root}/{t}_users", f"{self.root}/{t}_items"]
        now = [self.factors(side) for side in (0, 1)]
        schema = "at int, f binary, m binary, v binary, old_sq double, sse double"
        for side in (0, 1):  # the items' gradients, too, are of the users before
            mine, other, k = now[side].drop("old_sq", "sse"), now[1 - side].select("block", "at", "f"), self.k

            def job(b: int, side=side, mine=mine, other=other, k=k) -> None:
                found = self.beside(side, b, mine, other, self.cells)
                self.write(found.mapInArrow(lambda batches: _moved(batches, side, k, lam, alpha, adam), schema), f"{new[side]}/block={b}",
                           compression="none")

            self.each(side, job)
            if not self.blocks[side]:
                self.spark.createDataFrame([], schema).write.parquet(new[side])
        old, self.state = self.state, new
        row = self.factors(0).union(self.factors(1)).agg(F.sum("old_sq").alias("sq"), F.sum("sse").alias("sse")).first()
        for path in old:
            drop_table(self.spark, path)
        if t % 2 == 0:  # each scan's copy of Hadoop's settings stays in the driver until its garbage is collected
            self.spark._jvm.System.gc()
        return 0.5 * (row["sse"] or 0.0) + lam / 2.0 * (row["sq"] or 0.0)

    def sse(self) -> float:
        """Sum of the squared errors of the factors as they are."""
        (mine, other), k = [self.factors(side).select("block", "at", "f") for side in (0, 1)], self.k

        def job(b: int) -> None:
            self.beside(0, b, mine, other, self.cells).mapInArrow(
                lambda batches: _squares(batches, k), "sse double").write.parquet(f"{self.root}/sse/block={b}")

        self.each(0, job)
        if not self.blocks[0]:
            return 0.0
        return self.read(f"{self.root}/sse", "sse double, block int").agg(F.sum("sse")).first()[0] or 0.0

    def rows(self, side: int) -> DataFrame:
        """The factor table of a side, a row per id, written to a folder that stays."""
        path = f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/tables/{uuid.uuid4().hex}"
        key, names, now = self.keys[side], self.names[side], self.factors(side)
        schema = T.StructType([T.StructField(key, self.kinds[side]), *[T.StructField(c, T.DoubleType()) for c in names]])

        def job(b: int) -> None:
            ids, f = self.ids[side].where(F.col("block") == b), now.where(F.col("block") == b)
            ids.select(F.lit(0).alias("kind"), "at", "ids").union(f.select(F.lit(1), "at", "f")).coalesce(1).mapInArrow(
                lambda batches: _unpacked(batches, key, names), schema).write.parquet(f"{path}/block={b}")

        self.each(side, job)
        if not self.blocks[side]:
            self.spark.createDataFrame([], schema).write.parquet(path)
        return self.spark.read.schema(schema).parquet(path).select(key, *names)


def _stream(**columns: pa.Array) -> bytes:
    batch, sink = pa.record_batch(list(columns.values()), names=list(columns)), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _columns(cell) -> list[pa.Array]:
    table = pa.ipc.open_stream(cell.as_buffer()).read_all()
    return [pa.concat_arrays(c.chunks) if c.num_chunks != 1 else c.chunk(0) for c in table.columns]


def _numbers(cell, kind=np.float64) -> np.ndarray:
    return np.frombuffer(cell.as_buffer(), kind)


def _runs(batches: Iterator[pa.RecordBatch], keys: int, most: int):
    """(key, columns) of rows in order of their first ``keys`` columns, ``most`` rows at a time."""
    key, held, n = None, [], 0

    def out():
        return key, [pa.concat_arrays([h[c] for h in held]) for c in range(len(held[0]))]

    for b in batches:
        first = [b.column(c).to_numpy() for c in range(keys)]
        ends = [*(np.flatnonzero(np.any([np.diff(x) != 0 for x in first], axis=0)) + 1).tolist(), b.num_rows]
        at = 0
        for end in ends:
            while at < end:
                now = tuple(int(x[at]) for x in first)
                if held and (key != now or n >= most):
                    yield out()
                    held, n = [], 0
                key, size = now, min(end - at, most - n)
                held.append([c.slice(at, size) for c in b.columns[keys:]])
                at, n = at + size, n + size
    if held:
        yield out()


def _row(**columns) -> pa.RecordBatch:
    kinds = {int: pa.int32(), float: pa.float64(), bytes: pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array([v], kinds[type(v)]) for v in columns.values()], names=list(columns))


def _chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    last, at = None, 0
    for (block,), (ids, *f) in _runs(batches, 1, size):
        last, at = block, at + 1 if block == last else 0
        yield _row(block=block, at=at, ids=_stream(id=ids), f=np.column_stack([x.to_numpy(zero_copy_only=False) for x in f]).tobytes())


def _pieces(batches: Iterator[pa.RecordBatch], piece: int) -> Iterator[pa.RecordBatch]:
    for (ub, ib), (u, i, y) in _runs(batches, 2, piece):
        yield _row(ub=ub, ib=ib, r=_stream(u=u, i=i, y=y))


def _whole(chunks: dict) -> list:
    """The columns of a block from its numbered chunks: lists of their cells, None for an absent column."""
    if sorted(chunks) != list(range(len(chunks))):
        raise RuntimeError("a block lacks a chunk")
    return [list(c) if c[0].is_valid else None for c in zip(*(chunks[at] for at in range(len(chunks))), strict=True)]


def _doubled(cells: list, wide: int) -> np.ndarray:
    return np.concatenate([_numbers(c) for c in cells]).reshape(-1, wide)


def _ordered(batches: Iterator[pa.RecordBatch], mine, theirs):
    """(block of the other side, own, other, pieces) of a few pieces of a cell at a time, and at the end once (None, own, None,
    None); see Grid.beside.  ``mine`` and ``theirs`` make own and other from the columns of their blocks."""
    chunks, groups, others, own, at, n = {}, {}, {}, None, None, 0
    held: list = []
    for b in batches:
        kinds, blocks, places = (b.column(c).to_pylist() for c in range(3))
        for row, (kind, block, place) in enumerate(zip(kinds, blocks, places, strict=True)):
            cells = [b.column(c)[row] for c in range(3, b.num_columns)]
            if held and (kind != 2 or block != at or n >= MERGED):
                yield at, own, others[at], held
                held, n = [], 0
            if kind == 2:
                if own is None and chunks:
                    own, chunks = mine(_whole(chunks)), {}
                if block not in others and block in groups:
                    others[block] = theirs(_whole(groups.pop(block)))
                if own is None or block not in others:
                    raise RuntimeError("a piece of ratings came before its blocks")
                at = block
                held.append(cells)
                n += len(cells[-1].as_buffer()) // 8
            elif kind == 1:
                if others:  # the next group
                    groups, others = {}, {}
                groups.setdefault(block, {})[place] = cells
            elif own is not None:
                raise RuntimeError("a block came in two parts")
            else:
                chunks[place] = cells
    if held:
        yield at, own, others[at], held
    if own is None and chunks:
        own, chunks = mine(_whole(chunks)), {}
    if own is not None:
        del held, groups, others
        yield None, own, None, None


def _merged(pieces: list) -> tuple[np.ndarray, ...]:
    u, i, y = (np.concatenate([_numbers(p[c], kind) for p in pieces]) for c, kind in enumerate((np.int32, np.int32, np.float64)))
    return u.astype(np.intp), i.astype(np.intp), y


def _spots(ids: pa.Array, wanted: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """First position and number of places of every wanted id in sorted ids, nulls first."""
    have, want = ids.slice(ids.null_count).to_numpy(zero_copy_only=False), wanted.to_numpy(zero_copy_only=False)
    lo = np.searchsorted(have, want, "left")
    return lo + ids.null_count, np.searchsorted(have, want, "right") - lo


def _ids(cells: list) -> pa.Array:
    return pa.concat_arrays([_columns(c)[0] for c in cells])


def _positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Positions within the blocks instead of ids; an id that a block has twice counts twice, one it lacks not at all."""
    for ib, uids, iids, pieces in _ordered(batches, lambda own: _ids(own[0]), lambda other: _ids(other[0])):
        for cell in pieces or []:
            u, i, y = _columns(cell[0])
            (u, nu), (i, ni) = _spots(uids, u), _spots(iids, i)
            n = nu * ni
            at = np.repeat(np.arange(len(n)), n)
            nth = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
            u, i, y = u[at] + nth // np.maximum(ni[at], 1), i[at] + nth % np.maximum(ni[at], 1), y.to_numpy()[at]
            if len(u):
                order = np.lexsort((i, u))
                yield _row(ib=ib, u=u[order].astype(np.int32).tobytes(), i=i[order].astype(np.int32).tobytes(), y=y[order].tobytes())


def _errors(w: np.ndarray, x: np.ndarray, k: int, y: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", w[:, :k], x) + w[:, k] - y


def _squares(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    sse = 0.0
    for _, w, x, pieces in _ordered(batches, lambda own: _doubled(own[0], k + 1), lambda other: _doubled(other[0], k)):
        if pieces:
            u, i, y = _merged(pieces)
            for at in range(0, len(u), CHUNK):
                err = _errors(w[u[at:at + CHUNK]], x[i[at:at + CHUNK]], k, y[at:at + CHUNK])
                sse += float(err @ err)
    yield _row(sse=sse)


def _moved(batches: Iterator[pa.RecordBatch], side: int, k: int, lam: float, alpha: float, adam: bool) -> Iterator[pa.RecordBatch]:
    """A block after the step; ``old_sq`` and ``sse`` (the latter on the users' side) are of the factors before."""
    wide, far = (k + 1, k) if side == 0 else (k, k + 1)
    total, sse, now = None, 0.0, None

    def mine(own: list) -> list:
        f = _doubled(own[0], wide)
        return [f, *[_doubled(c, wide) if c is not None else np.zeros_like(f) for c in own[1:3]]]

    for _, now, x, pieces in _ordered(batches, mine, lambda other: _doubled(other[0], far)):  # noqa: B007
        f = now[0]
        if total is None:
            total = np.zeros((wide, len(f)))
        if not pieces:
            continue
        u, i, y = _merged(pieces)
        here, grow = (u, i)[side], np.empty((wide, len(u)))
        for at in range(0, len(u), CHUNK):  # what is worked on stays in the caches
            w, z = ((f, x) if side == 0 else (x, f))
            w, z = w.take(u[at:at + CHUNK], axis=0), z.take(i[at:at + CHUNK], axis=0)
            err = _errors(w, z, k, y[at:at + CHUNK])
            np.multiply((z if side == 0 else w[:, :k]).T, err, out=grow[:k, at:at + CHUNK])
            if side == 0:
                grow[k, at:at + CHUNK] = err
                sse += float(err @ err)
        for j in range(wide):
            total[j] += np.bincount(here, grow[j], len(f))
    if now is None:
        return
    x = pieces = None
    keep = np.ones(wide)
    if side == 0:
        keep[k] = 0.0  # the bias is not penalised
    size = max(1, CHUNK_BYTES // (8 * wide))
    for n, at in enumerate(range(0, len(now[0]), size)):
        f, m, v = (a[at:at + size] for a in now)
        old_sq = float((f[:, :k] ** 2).sum())
        g = total[:, at:at + size].T + lam * keep * f
        if adam:
            m = m + (g - m) * (1 - ADAM_B1)
            v = v + (g * g - v) * (1 - ADAM_B2)
            f = f - alpha * m / (np.sqrt(v) + ADAM_EPS)
        else:
            f = f - alpha * g
        yield _row(at=n, f=f.tobytes(), m=m.tobytes(), v=v.tobytes(), old_sq=old_sq, sse=0.0 if n else sse)


def _unpacked(batches: Iterator[pa.RecordBatch], key: str, names: list[str]) -> Iterator[pa.RecordBatch]:
    chunks: tuple[dict, dict] = ({}, {})
    for b in batches:
        for kind, place, cell in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
            chunks[kind][place] = [cell]
    if chunks[0]:
        ids, f = _ids(_whole(chunks[0])[0]), _doubled(_whole(chunks[1])[0], len(names))
        for at in range(0, len(f), BLOCK_ROWS):
            yield pa.RecordBatch.from_arrays([ids.slice(at, BLOCK_ROWS), *[pa.array(np.ascontiguousarray(c)) for c in f[at:at + BLOCK_ROWS].T]],
                                             names=[key, *names])


def train_factors(ratings: DataFrame, items: DataFrame, users: DataFrame, user: str, item: str, rating: str,
                  k: int, lam: float, lr: float, iters: int, optimizer: str = "adam", block_rows: int = BLOCK_ROWS,
                  piece_rows: int | None = None):
    """Gradient steps on C1.  Returns (items, users, history), history = [(step, cost before the step)].

    ``items`` has columns ``item``, f_0 .. f_{k-1}, ``users`` also the unpenalised bias ``b``; ratings of other
    users or items, and NULL ratings, are left out.  A step writes the new factors once and then removes the old."""
    grid = Grid(ratings, items, users, user, item, rating, k, block_rows, piece_rows)
    try:
        history = [(t - 1, grid.step(t, lam, lr, optimizer == "adam")) for t in range(1, iters + 1)]
        return grid.rows(1), grid.rows(0), history
    finally:
        grid.close()


def squared_errors(ratings: DataFrame, items: DataFrame, users: DataFrame, user: str, item: str, rating: str, k: int) -> float:
    """Sum of the squared errors over the ratings whose user, item and value are known, block by block."""
    grid = Grid(ratings, items.dropna(subset=[f"f_{j}" for j in range(k)]), users.dropna(subset=[*[f"f_{j}" for j in range(k)], "b"]),
                user, item, rating, k)
    try:
        return grid.sse()
    finally:
        grid.close()


def recommend_all(ratings: DataFrame, items: DataFrame, users: DataFrame, user: str, item: str, k: int, top: int,
                  item_offset: str | None = None, block_rows: int = BLOCK_ROWS, step: int = 512, head: int = HEAD) -> DataFrame:
    """C3/C4 for every user: the ``top`` unrated items by w.x + b (+ the item's offset, missing: 0), ties by item id:
    (user, item, score, rank).

    Every user first meets the ``head`` items of the largest bound off + |x| max|w|.  Whose worst chosen score there
    exceeds the bound of all other items is done; the others meet every item, in blocks.  There each cell of user block
    and item block emits at most ``top`` rows a user, and each task works on ``step`` users at a time, so the dense
    score matrix never exists; the final rank per user is over ``top`` rows per item block."""
    fnames = [f"f_{j}" for j in range(k)]
    offset = F.coalesce(F.col(item_offset).cast("double"), F.lit(0.0)) if item_offset else F.lit(0.0)
    items = items.withColumn("_off", offset)
    met = cut_lineage(_meet_head(ratings, items, users, user, item, k, top, head))
    rank = Window.partitionBy(user).orderBy(F.col("score").desc(), F.col(item))
    later = met.where("NOT done").select(user).distinct()
    done = met.join(later, met[user].eqNullSafe(later[user]), "left_anti")
    best = done.select(user, F.explode(F.arrays_zip(F.col("items").alias(item), F.col("scores").alias("score"))).alias("r")).select(user, "r.*")
    if not later.isEmpty():
        rest = met.join(later, met[user].eqNullSafe(later[user]), "left_semi").select(
            user, *[F.col("f")[j].alias(c) for j, c in enumerate([*fnames, "b"])])
        best = best.unionByName(_meet_all(ratings, items, rest, user, item, k, top, block_rows, step))
    return best.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= top)


def _scores(w: np.ndarray, x: np.ndarray, k: int) -> np.ndarray:
    """w.x + b + offset of every user (row) and item, in order of the factors."""
    s = np.zeros((len(w), len(x)))
    for j in range(k):
        s = s + x[None, :, j] * w[:, j:j + 1] if j else x[None, :, 0] * w[:, :1]
    return s + w[:, k:] + x[None, :, k]


def _meet_head(ratings: DataFrame, items: DataFrame, users: DataFrame, user: str, item: str, k: int, top: int, head: int) -> DataFrame:
    """(user, f, items, scores, done): every user's best unrated items of the head, and whether no other item can be among
    the ``top``."""
    fnames = [f"f_{j}" for j in range(k)]
    norm = F.sqrt(sum((F.col(c) * F.col(c) for c in fnames[1:]), F.col(fnames[0]) * F.col(fnames[0])))
    widest = users.agg(F.max(norm)).first()[0] or 0.0
    first = items.select(F.col(item).alias("id"), F.array(*fnames, "_off").alias("f"), (F.col("_off") + norm * widest).alias("g"))
    rows = first.orderBy(F.col("g").desc(), "id").limit(head + 1).collect()  # the head: bounded
    limit = -np.inf if len(rows) <= head else np.nan if rows[head]["g"] is None else rows[head]["g"]
    rows = sorted(rows[:head], key=lambda r: (r["id"] is not None, r["id"]))  # lowest id first on ties
    x = np.array([r["f"] for r in rows], dtype=float).reshape(-1, k + 1)
    kind = to_arrow_type(items.schema[item].dataType)
    ids = pa.array([r["id"] for r in rows], kind)
    places = ratings.sparkSession.createDataFrame([(r["id"], i) for i, r in enumerate(rows)], T.StructType(
        [T.StructField("_i", items.schema[item].dataType), T.StructField("at", T.IntegerType())]))
    seen = (ratings.select(F.col(user).alias("_u"), F.col(item).alias("_i")).join(F.broadcast(places), "_i")
            .groupBy("_u").agg(F.collect_set("at").alias("seen")))
    asked = users.select(F.col(user).alias("_u"), F.array(*fnames, "b").alias("f")).join(seen, "_u", "left").select("_u", "f", "seen")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                b = whole.slice(at, 256)
                w = np.asarray(b.column(1).flatten(), dtype=float).reshape(-1, k + 1)
                s = _scores(w, x, k)
                for row, places in enumerate(b.column(2).to_pylist()):
                    if places:
                        s[row, places] = -np.inf
                n = min(top, s.shape[1])
                best = np.argsort(-s, axis=1, kind="stable")[:, :n]
                score = np.take_along_axis(s, best, axis=1)
                ok = score > -np.inf
                bound = limit + w[:, k]
                bound = bound + 1e-9 * (abs(limit) + np.abs(w[:, k]) + 1.0)  # room for rounding
                done = (ok.all(axis=1) & (score[:, -1] > bound)) if n == top else np.zeros(len(w), bool)
                if limit == -np.inf:
                    done[:] = True
                ends = pa.array(np.concatenate([[0], np.cumsum(ok.sum(axis=1))]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.ListArray.from_arrays(ends, ids.take(pa.array(best[ok]))),
                     pa.ListArray.from_arrays(ends, pa.array(score[ok])), pa.array(done)], names=[user, "f", "items", "scores", "done"])

    uid, iid = users.schema[user].dataType.simpleString(), items.schema[item].dataType.simpleString()
    return asked.mapInArrow(run, f"{user} {uid}, f array<double>, items array<{iid}>, scores array<double>, done boolean")


def _meet_all(ratings: DataFrame, items: DataFrame, users: DataFrame, user: str, item: str, k: int, top: int, block_rows: int,
              step: int) -> DataFrame:
    """(user, item, score): the best unrated items of every user and item block."""
    fnames = [f"f_{j}" for j in range(k)]
    ub, nu = _blocks(users, user, [*fnames, "b"], block_rows)
    ib, ni = _blocks(items, item, [*fnames, "_off"], block_rows)
    rated = _cells(ratings.withColumn("_one", F.lit(1.0)), user, item, "_one", ub, ib, nu, ni)
    ids = items.schema[item].dataType.simpleString(), users.schema[user].dataType.simpleString()

    spread = ub.select(F.col("block").alias("ub"), F.explode(F.sequence(F.lit(0), F.lit(ni - 1))).alias("ib"), F.col("ids").alias("uids"), F.col("f").alias("w"))
    pairs = spread.join(ib.select(F.col("block").alias("ib"), F.col("ids").alias("iids"), F.col("f").alias("x")), "ib")
    blocked = rated.groupBy("ub", "ib").agg(F.collect_list(F.struct("u", "i")).alias("r")).select(
        "ub", "ib", F.flatten("r.u").alias("u"), F.flatten("r.i").alias("i"))  # pairs of a cell: at most its size
    work = pairs.join(blocked, ["ub", "ib"], "left").select("uids", "w", "iids", "x", "u", "i")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in range(b.num_rows):
                uids, iids = b.column(0)[row].values, b.column(2)[row].values
                w, x = _doubles(b.column(1), row).reshape(-1, k + 1), _doubles(b.column(3), row).reshape(-1, k + 1)
                seen = [np.asarray(c[row].values, dtype=np.int64) if c[row].is_valid else np.zeros(0, np.int64) for c in (b.column(4), b.column(5))]
                order = np.argsort(seen[0], kind="stable")
                su, si = seen[0][order], seen[1][order]
                for at in range(0, len(w), step):
                    part = w[at:at + step]
                    s = _scores(part, x, k)
                    lo, hi = np.searchsorted(su, [at, at + len(part)])
                    s[su[lo:hi] - at, si[lo:hi]] = -np.inf
                    n = min(top, s.shape[1])
                    # ids of a block are sorted: a stable sort keeps the lowest first on ties
                    best = np.argsort(-s, axis=1, kind="stable")[:, :n]
                    score = np.take_along_axis(s, best, axis=1)
                    ok = (score > -np.inf).ravel()
                    yield pa.RecordBatch.from_arrays(
                        [uids.take(pa.array(np.repeat(np.arange(at, at + len(part)), n)[ok])), iids.take(pa.array(best.ravel()[ok])),
                         pa.array(score.ravel()[ok])], names=[user, item, "score"])

    return work.mapInArrow(run, f"{user} {ids[1]}, {item} {ids[0]}, score double")
