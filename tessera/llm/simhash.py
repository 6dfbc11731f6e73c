"""SimHash near-dedup with the generalised pigeonhole principle."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from .common import DOC_COLUMNS, pick, ship
from .components import components

ship(__name__)

BITS = 64
SHINGLE = 3
MAX_DISTANCE = 3
SEED = 42
#: Buckets up to this size are compared inside one row; larger ones go the exact way of _ball_links.
PAIR_BUCKET = 64
#: One verified candidate pair costs about as much as this many probe rows.
PAIR_COST = 8.0
SKETCH = 256
BLOCK = 100_000


# ---------------------------------------------------------------- fingerprints

def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of a text: A-Z lower-cased, words split at ASCII white space,
    XXH64 of every shingle; a bit is 1 if set in over half of the hashes; no word: 0."""
    words = text.lower().split()
    if not words:
        return 0
    grams = [b" ".join(words)] if len(words) < shingle else list(
        map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False)))
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(grams), BLOCK):
        part = grams[at:at + BLOCK]
        raw = b"".join(map(xxhash.xxh64_digest, part, repeat(SEED)))
        ones += np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(grams)).tobytes(), "big", signed=True)


def add_fingerprint(docs: DataFrame, text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` (distinct column names) with a last column ``fp``; null text counts as empty."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(at).cast(pa.binary()) if not pa.types.is_large_string(b.column(at).type) \
                else b.column(at).cast(pa.large_binary())
            fps = [fingerprint(t.as_py() or b"", shingle) for t in texts]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(fps, pa.int64())],
                                             names=[*b.schema.names, "fp"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("fp", T.LongType())]))


# ------------------------------------------------- partitions and their thresholds

def _as_int64(x: int) -> int:
    return x - (1 << BITS) if x >= 1 << (BITS - 1) else x


def _bit_correlation(nodes: DataFrame) -> np.ndarray:
    """|correlation| of the fingerprint bits over all distinct fingerprints (one pass, 64 x 64 sums)."""
    def run(batches):
        both, n = np.zeros((BITS, BITS)), 0
        for b in batches:
            fps = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            for at in range(0, len(fps), BLOCK):
                x = ((fps[at:at + BLOCK, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(np.float32)
                both += (x.T @ x).astype(np.float64)
            n += len(fps)
        if n:
            cell = np.append(both.ravel(), n)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cell)), pa.int32()), pa.array(cell)],
                                             names=["cell", "v"])

    rows = nodes.select("fp").mapInArrow(run, "cell int, v double").groupBy("cell").agg(F.sum("v").alias("v")).collect()
    cell = np.zeros(BITS * BITS + 1)
    for r in rows:
        cell[r.cell] = r.v
    n = max(cell[-1], 1.0)
    p = cell[:-1].reshape(BITS, BITS) / n
    mean = np.diag(p)
    sd = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    corr = np.abs((p - np.outer(mean, mean)) / np.outer(sd, sd))
    np.fill_diagonal(corr, 0.0)
    return corr


def group_bits(corr: np.ndarray, parts: int) -> list[list[int]]:
    """Split the bits into ``parts`` groups of near-equal width, correlated bits together
    (each group grows from its most correlated free bit by the largest mean correlation)."""
    free, groups = set(range(BITS)), []
    for k in range(parts):
        width = (BITS - sum(map(len, groups))) // (parts - k)
        order = sorted(free)
        group = [max(order, key=lambda b: (corr[b, order].sum(), -b))]
        free.discard(group[0])
        while len(group) < width:
            group.append(max(sorted(free), key=lambda b: (corr[b, group].sum(), -b)))
            free.discard(group[-1])
        groups.append(sorted(group))
    return groups


def _mask(bits: list[int]) -> int:
    return sum(1 << b for b in bits)


def _masks(bits: list[int], threshold: int) -> list[int]:
    """Two values within ``threshold`` (0 or 1) on these bits agree under at least one of the masks."""
    return [_mask(bits)] if threshold == 0 else [_mask(bits) & ~(1 << b) for b in bits]


def _collisions(nodes: DataFrame, masks: list[int]) -> tuple[int, dict[int, float]]:
    """Number of fingerprints, and for each mask the estimated pairs that agree under it.

    A signed count sketch of all fingerprints per mask estimates the sum of squared bucket
    sizes; tasks emit their sketches, Spark adds them."""
    wanted = np.array(masks, np.uint64)

    def run(batches):
        total, n = np.zeros((len(wanted), SKETCH)), 0
        for b in batches:
            fps = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            n += len(fps)
            for i, m in enumerate(wanted):
                h = (fps & m) * np.uint64(0x9E3779B97F4A7C15)
                h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
                slot = (h >> np.uint64(40)).astype(np.int64) % SKETCH
                total[i] += np.bincount(slot, 1.0 - 2.0 * ((h >> np.uint64(32)) & np.uint64(1)).astype(float), SKETCH)
        if n:
            cell = np.append(total.ravel(), n)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cell)), pa.int32()), pa.array(cell)],
                                             names=["cell", "v"])

    rows = (nodes.select("fp").mapInArrow(run, "cell int, v double").groupBy("cell").agg(F.sum("v").alias("v"))
            .groupBy((F.col("cell") / SKETCH).cast("int").alias("m"))
            .agg(F.sum(F.col("v") * F.col("v")).alias("f2"), F.max("v").alias("n")).collect())
    n = int(next((r.n for r in rows if r.m == len(masks)), 0))
    return n, {masks[r.m]: max(0.0, (r.f2 - n) / 2) for r in rows if r.m < len(masks)}


def allocate(costs: list[dict[int, float]], total: int) -> tuple[float, list[int]]:
    """Thresholds (-1: no probe) with the given sum and the least total cost, by dynamic programming."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for c in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for s, (paid, picked) in best.items():
            for t, extra in c.items():
                if s + t not in step or paid + extra < step[s + t][0]:
                    step[s + t] = (paid + extra, [*picked, t])
        best = step
    return best.get(total, (float("inf"), []))


def choose_masks(nodes: DataFrame, max_distance: int = MAX_DISTANCE) -> list[int]:
    """The probe masks: fingerprints within ``max_distance`` agree under at least one.

    General pigeonhole: with m parts and thresholds summing to max_distance - m + 1, two
    close fingerprints are within the threshold on some part.  Parts hold correlated bits;
    a part's cost is its probe rows plus its estimated candidate pairs over all
    fingerprints; thresholds come from ``allocate`` for each m, the cheapest m is taken."""
    corr = _bit_correlation(nodes)
    plans = {m: group_bits(corr, m) for m in range((max_distance + 2) // 2, max_distance + 2)}
    every = sorted({x for groups in plans.values() for g in groups for t in (0, 1) for x in _masks(g, t)})
    n, pairs = _collisions(nodes, every)
    best = (float("inf"), [])
    for m, groups in plans.items():
        costs = [{-1: 0.0} | {t: sum(n + PAIR_COST * pairs.get(x, 0.0) for x in _masks(g, t)) for t in (0, 1)}
                 for g in groups]
        paid, picked = allocate(costs, max_distance - m + 1)
        if paid < best[0] or not best[1]:
            best = (paid, [x for g, t in zip(groups, picked, strict=True) if t >= 0 for x in _masks(g, t)])
    return best[1]


# ------------------------------------------------------------------------ links

def _ball_links(members: DataFrame) -> DataFrame:
    """Links that connect exactly what distances of 3 or fewer connect, without pairs.

    Every member writes the points around it: itself, its 64 neighbours, and the points two
    flips away with both flips in one half of the word.  At a point, all members one flip away
    or less are within 2 of each other, and within 3 of those two flips away: each links to the
    smallest of the former.  Of three differing bits two lie in one half, so every link of
    distance 3 has such a point.  Rows grow with the members, not with their pairs.  Spark guesses
    the size of exploded rows from their source's, so they are merged and never broadcast."""
    flips = [0, *(1 << b for b in range(BITS)),
             *((1 << a) | (1 << b) for half in (range(32), range(32, 64)) for a, b in combinations(half, 2))]
    points = members.select("fp", F.explode(F.array(*[F.lit(_as_int64(x)) for x in flips])).alias("flip"))
    points = points.select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("at"),
                           (F.bit_count("flip") <= 1).alias("near"))
    hubs = cut_lineage(points.groupBy("at").agg(F.count(F.lit(1)).alias("n"),
                                                F.min(F.when(F.col("near"), F.col("fp"))).alias("hub"))
                       .filter("n > 1 AND hub IS NOT NULL").select("at", "hub"))
    return points.hint("merge").join(hubs, "at").filter("fp <> hub").select(F.col("fp").alias("u"), F.col("hub").alias("v"))


def links(nodes: DataFrame, max_distance: int = MAX_DISTANCE, pair_bucket: int = PAIR_BUCKET) -> DataFrame:
    """u, v: links among distinct fingerprints (column fp) whose components are those of
    "at most ``max_distance`` differing bits".

    Probe rows (mask, masked value) are counted per bucket with map-side combining.  Buckets
    of two hold their pair already; buckets up to ``pair_bucket`` are compared in a bounded
    array and only verified pairs leave it; members of larger buckets go through _ball_links.
    Probe rows are merged, not broadcast, as the points of _ball_links are."""
    if max_distance != 3:
        raise ValueError("the exact way for large buckets is written for a distance of 3")
    masks = choose_masks(nodes, max_distance)
    fp = F.col("fp")
    probes = nodes.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("m"), fp.bitwiseAND(F.lit(_as_int64(x))).alias("key"))
        for i, x in enumerate(masks)])).alias("p")).select("fp", "p.m", "p.key")
    buckets = cut_lineage(probes.groupBy("m", "key").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("u"),
                                                        F.max("fp").alias("v")).filter("n > 1"))
    near = lambda a, b: F.bit_count(a.bitwiseXOR(b)) <= max_distance
    found = buckets.filter("n = 2").filter(near(F.col("u"), F.col("v"))).select("u", "v")
    mid = buckets.filter((F.col("n") > 2) & (F.col("n") <= pair_bucket)).select("m", "key")
    arrays = probes.hint("merge").join(mid, ["m", "key"]).groupBy("m", "key").agg(F.collect_list("fp").alias("a"))
    a = F.col("a")
    pairs = F.flatten(F.transform(a, lambda x, i: F.filter(
        F.transform(F.slice(a, i + 2, F.size(a)), lambda y: F.struct(x.alias("u"), y.alias("v"))),
        lambda p: near(p["u"], p["v"]))))
    found = found.unionByName(arrays.select(F.explode(pairs).alias("p")).select("p.u", "p.v"))
    large = cut_lineage(buckets.filter(F.col("n") > pair_bucket).select("m", "key"))
    if not large.isEmpty():
        members = cut_lineage(probes.join(large, ["m", "key"], "left_semi").select("fp").distinct())
        found = found.unionByName(_ball_links(members))
    return found


def _groups(marked: DataFrame) -> DataFrame:
    """fp, component_id for fingerprints that stand for several rows or are linked (from doc_id, fp rows)."""
    nodes = cut_lineage(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n")))
    roots = components(links(nodes.select("fp")))
    rooted = (nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
              .withColumn("at", F.coalesce("root", "fp")))
    heads = cut_lineage(rooted.groupBy("at").agg(F.min("first_id").alias("component_id"), F.sum("n").alias("size"))
                        .filter("size > 1").select("at", "component_id"))
    return cut_lineage(rooted.join(heads, "at").select("fp", "component_id"))


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest reachable doc_id) for every row.

    Equal fingerprints become one node first, so copies add no probe rows; a null text is
    empty (fingerprint zero, linked like any other); null doc_ids never name a component
    unless it has no other id; repeated rows come out repeated."""
    marked = cut_lineage(add_fingerprint(pick(docs, doc_id=id_col, text=text_col)).select("doc_id", "fp"))
    grouped = marked.join(_groups(marked), "fp", "left")
    return grouped.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                          F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one_per_group(docs: DataFrame) -> DataFrame:
    """The rows of a documents table that near-dedup keeps (the smallest doc_id of each group),
    with the columns of documents.  Rows that share doc_id and fingerprint count as one document;
    of a group without any id all rows stay.  The dropped keys are written first and removed
    by an anti-join, which moves the texts only if that table is large."""
    rows = add_fingerprint(pick(docs, *DOC_COLUMNS))
    marked = cut_lineage(rows.select("doc_id", "fp"))
    gone = cut_lineage(marked.join(_groups(marked), "fp").filter("NOT doc_id <=> component_id")
                       .select(F.col("doc_id").alias("gone_id"), F.col("fp").alias("gone_fp")).distinct())
    kept = rows.join(gone, rows.doc_id.eqNullSafe(gone.gone_id) & (rows.fp == gone.gone_fp), "left_anti")
    return kept.select(*DOC_COLUMNS)
