"""Periodic runs of words by maximal-pair enumeration over an LCP-interval tree.

Two equal stretches of L words, q words apart, that neither neighbour extends are a maximal pair;
together they are a stretch of q + L words with period q.  So the pairs with q + L >= max(24, 3q)
are exactly the runs, already maximal: nothing is extended afterwards."""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, ship

ship(__name__)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
MIN_LENGTH = 24
MIN_EXPONENT = 3
#: Words of the documents whose suffixes are sorted together.
BATCH_WORDS = 400_000


# ---------------------------------------------------------------- suffixes

class SuffixOrder:
    """Order of the suffixes of ``ids`` that share ``depth`` or more words with another one.

    Prefix doubling: ranks of 1, 2, 4 ... words; from ``depth`` on only suffixes that still tie are
    sorted.  ``sa`` lists the tied suffixes of that depth in order, ``lcp[i]`` what sa[i - 1] and sa[i]
    have in common (below ``depth``: 0, another group)."""

    def __init__(self, ids: np.ndarray, depth: int) -> None:
        n, h = len(ids), 1
        rank = ids.astype(np.int64)
        live = kept = None  # the suffixes that still tie; all of them below ``depth``
        #: (h, ranks by the first h words, their places; None: every place)
        self.levels: list[tuple[int, np.ndarray, np.ndarray | None]] = []
        while live is None or len(live):
            places = None if live is None else np.sort(live)
            self.levels.append((h, rank.copy() if live is None else rank[places], places))
            where = np.arange(n) if live is None else live
            after = np.zeros(len(where), np.int64)
            inside = where + h < n
            after[inside] = rank[where[inside] + h] + 1
            order = np.argsort(rank[where] * (n + 1) + after)
            where, after = where[order], after[order]
            first = rank[where]
            group = np.ones(len(where), bool)
            group[1:] = first[1:] != first[:-1]
            new = group.copy()
            new[1:] |= after[1:] != after[:-1]
            at = np.arange(len(where))
            rank[where] = np.maximum.accumulate(np.where(new, at, 0))
            if live is not None:  # a group's ranks start at its place among all suffixes
                rank[where] += first - np.maximum.accumulate(np.where(group, at, 0))
            tied = ~new
            tied[:-1] |= ~new[1:]
            h *= 2
            if h >= depth:
                live = where[tied]
                kept = live if kept is None else kept
        self.sa = kept[np.argsort(rank[kept])]
        self.lcp = np.zeros(len(self.sa), np.int64)
        if len(self.sa) > 1:
            common = self._common(self.sa[:-1], self.sa[1:], n)
            self.lcp[1:] = np.where(common >= depth, common, 0)

    def _common(self, a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
        a, b, out = a.copy(), b.copy(), np.zeros(len(a), np.int64)
        for h, ranks, where in reversed(self.levels):
            fits = np.flatnonzero((a < n) & (b < n))
            x, y = a[fits], b[fits]
            if where is None:
                same = ranks[x] == ranks[y]
            else:
                i, j = (np.minimum(np.searchsorted(where, z), len(where) - 1) for z in (x, y))
                same = (where[i] == x) & (where[j] == y) & (ranks[i] == ranks[j])
            hit = fits[same]
            a[hit] += h
            b[hit] += h
            out[hit] += h
        return out


# ---------------------------------------------------------------- maximal pairs

def _meet(small: list[int], large: list[int], length: int, left: list[int], found: list[tuple[int, int, int]]) -> None:
    """Pairs of one position of ``small`` and one of ``large`` whose left words differ and whose distance
    q makes a run: 3q <= q + length and q + length >= MIN_LENGTH.

    Both lists are sorted; a position's class is its left word.  Occurrences of one string at most
    length // 2 apart lie a multiple of its period apart, so all but the first of such a chain have the
    same left word: to the right of x either all within reach differ from x or none does, to the left only
    the first within reach can."""
    reach = length // (MIN_EXPONENT - 1)
    for x in small:
        k = i = bisect_left(large, x)
        while k < len(large) and (q := large[k] - x) <= reach and left[large[k]] != left[x]:
            if q + length >= MIN_LENGTH:
                found.append((x, q, q + length))
            k += 1
        k = bisect_left(large, x - reach)
        if k < i and left[y := large[k]] != left[x] and x - y + length >= MIN_LENGTH:
            found.append((y, x - y, x - y + length))


def _pairs(sa: list[int], lcp: list[int], left: list[int]) -> list[tuple[int, int, int]]:
    """(start, period, length) of every maximal pair of one group of suffixes that makes a run.

    The LCP-interval tree is walked bottom up with a stack; an interval's children hand over their
    left-word class lists (kept as one list in order of position, the class read from ``left``), the
    smaller always into the larger, and pairs are read off between the two."""
    found: list[tuple[int, int, int]] = []
    stack: list[tuple[int, list[int]]] = []

    def join(length: int, a: list[int], b: list[int]) -> list[int]:
        if len(a) < len(b):
            a, b = b, a
        _meet(b, a, length, left, found)
        if len(b) == 1:
            insort(a, b[0])
        else:
            a += b
            a.sort()
        return a

    for i, suffix in enumerate(sa):
        here = [suffix]
        nxt = lcp[i + 1] if i + 1 < len(sa) else 0
        while stack and stack[-1][0] >= max(nxt, 1):
            length, held = stack.pop()
            here = join(length, held, here)
        if nxt:
            stack.append((nxt, here))
    return found


def runs_of(ids: np.ndarray, doc_of: np.ndarray) -> dict[int, list[tuple[int, int, int]]]:
    """document -> sorted (start, length, period) in positions of ``ids``, the words of several documents
    one after the other; no id occurs in two documents.  Of equal stretches the smallest period counts."""
    depth = MIN_LENGTH * (MIN_EXPONENT - 1) // MIN_EXPONENT  # a pair shorter than this is never a run
    out: dict[int, list[tuple[int, int, int]]] = {}
    if len(ids) < MIN_LENGTH:
        return out
    order = SuffixOrder(ids, depth)
    if not len(order.sa):
        return out
    left = np.empty(len(ids), np.int64)
    left[0], left[1:] = -1, ids[:-1]
    left[1:][doc_of[1:] != doc_of[:-1]] = -1
    # groups whose closest places are further apart than half of their longest match hold no run
    group = np.cumsum(order.lcp == 0) - 1
    starts = np.flatnonzero(order.lcp == 0)
    longest = np.maximum.reduceat(order.lcp, starts)
    by_place = np.lexsort((order.sa, group))
    gap = np.diff(order.sa[by_place], prepend=0)
    gap[starts] = np.iinfo(np.int64).max
    hopeful = np.flatnonzero(np.minimum.reduceat(gap, starts) <= longest // (MIN_EXPONENT - 1))
    if not len(hopeful):
        return out
    left_word = left.tolist()
    ends = np.append(starts[1:], len(order.sa))
    best: dict[tuple[int, int], int] = {}
    for g in hopeful.tolist():
        a, b = starts[g], ends[g]
        for start, period, length in _pairs(order.sa[a:b].tolist(), order.lcp[a:b].tolist(), left_word):
            if best.get((start, length), period + 1) > period:
                best[start, length] = period
    for (start, length), period in sorted(best.items()):
        out.setdefault(int(doc_of[start]), []).append((start, length, period))
    for found in out.values():
        found.sort(key=lambda r: (r[0], r[2]))
    return out


# ---------------------------------------------------------------- documents

def periodic_tail(doc_id: int | None, words: list[str]) -> list[str]:
    """The planted edit: for one document in ten the words from a place on repeat with a period."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a:a + p]
    return words[:a] + (unit * ((n - a) // len(unit) + 1))[:n - a]


def _row(words: list[str], found: list[tuple[int, int, int]]) -> tuple:
    """n_runs, the greatest run, its exponent in thousandths, all runs as lines, the words kept as text."""
    if not found:
        return 0, None, None, None, None, "", " ".join(words)
    keep = np.ones(len(words), bool)
    start, length, period = found[0]
    for s, n, p in found:
        keep[s + p:s + n] = False
        if n * period > length * p:
            start, length, period = s, n, p
    return (len(found), start, length, period, 1000 * length // period, "".join(f"{s},{n},{p}\n" for s, n, p in found),
            " ".join(w for w, k in zip(words, keep.tolist(), strict=True) if k))


FIELDS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs", "collapsed"]


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  edit: Callable[[int | None, list[str]], list[str]] | None = None) -> DataFrame:
    """One row per input row: doc_id, n_runs, start, length, period, exponent_milli, runs, collapsed.

    ``runs`` has a line ``start,length,period`` for every run of words (smallest period q, length of at
    least max(24, 3q), maximal), by start and period; the four numbers are those of the run with the
    greatest exact exponent (ties: smallest start, then period; null without a run); ``collapsed`` joins
    by one space the words that no run covers after its first period.  ``edit`` may change the words first.

    Whole texts, each task on its own rows, nothing is shuffled.  A null or empty text has no words and no
    run; a null doc_id stays null; repeated rows each give a row; other columns are not read; an empty table
    gives no rows.  Memory follows BATCH_WORDS or the longest single text."""
    rows = pick(docs, doc_id=id_col, text=text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def solved(batch: list[tuple[int | None, list[str]]], id_type: pa.DataType) -> pa.RecordBatch:
        ids, n_ids = [], 0
        for _, words in batch:
            seen: dict[str, int] = {}
            ids.append(np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words)) + n_ids)
            n_ids += len(seen)
        sizes = [len(words) for _, words in batch]
        found = runs_of(np.concatenate(ids), np.repeat(np.arange(len(batch)), sizes))
        rows_ = []
        for k, ((doc, words), base) in enumerate(zip(batch, np.cumsum([0, *sizes[:-1]]).tolist(), strict=True)):
            rows_.append((doc, *_row(words, [(s - base, n, p) for s, n, p in found.get(k, ())])))
        types = [id_type, *[pa.int64()] * 5, pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows_, strict=True), types, strict=True)],
                                          names=FIELDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int | None, list[str]]] = []
        size, id_type = 0, None
        for b in batches:
            id_type = b.column(0).type
            for doc, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                words = WORD.findall(text.as_py() or "")
                held.append((doc, edit(doc, words) if edit else words))
                size += len(words)
                if size >= BATCH_WORDS:
                    yield solved(held, id_type)
                    held, size = [], 0
        if held:
            yield solved(held, id_type)

    return rows.mapInArrow(run, f"doc_id {kind}, n_runs long, start long, length long, period long, exponent_milli long, "
                           "runs string, collapsed string")


def run_digests(docs: DataFrame) -> DataFrame:
    """The runs of every document after the planted edit, lists and collapsed text as SHA-256."""
    found = periodic_runs(docs, edit=periodic_tail)
    return found.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli",
                        F.sha2("runs", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
