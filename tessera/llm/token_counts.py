"""Token counts at every prefix of a text, by dynamic programming over BPE."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pick, ship
from .tokenizing import MAX_CACHED, load, public_path, shared

ship(__name__)

TOKENIZER = "word_bpe_49k.json"
LIMIT = 2048
#: Longer pre-tokens are counted by the library (the table would hold one entry per character anyway).
MAX_MEMO = 4096
#: Pre-tokens up to this length fill only the entries asked for; longer ones fill the table left to right.
LAZY = 200
#: Characters of text cut into chunks at once.
BATCH_CHARS = 500_000
#: Chunks pre-tokenized in one call of the library.
LEARN_BATCH = 2048
WHITE = re.compile(r"\s")


class PrefixBpe:
    """Exact BPE token counts for every prefix of a pre-token.

    A BPE encoding of a prefix is its last token plus the encoding of what comes before, and a
    token t may follow the last token s exactly if BPE encodes s + t as [s, t].  So one table,
    last and count of each prefix (not yet ended), holds every answer; the count of the prefix
    as a word of its own closes it with the token that carries the end mark."""

    def __init__(self, vocab: dict[str, int], merges: list, end: str):
        self.vocab, self.end = vocab, end
        self.rank = {tuple(m.split(" ")) if isinstance(m, str) else tuple(m): i for i, m in enumerate(merges)}
        self.longest = max((len(v) for v in vocab), default=1)
        self.open_tokens = {v: v for v in vocab}
        self.end_tokens = {v[:len(v) - len(end)]: v for v in vocab if v.endswith(end) and len(v) > len(end)}
        self.open: dict[str, tuple[str, int]] = {"": ("", 0)}
        self.ok: dict[tuple[str, str], bool] = {}
        self.parts: dict[str, tuple[str, str] | None] = {}
        self.spines: dict[tuple[str, int], list[tuple[str, int]]] = {}

    def symbols(self, token: str) -> list[str]:
        if self.end and token.endswith(self.end) and len(token) > len(self.end):
            body = token[:-len(self.end)]
            return [*body[:-1], body[-1] + self.end]
        return list(token)

    def split(self, token: str) -> tuple[str, str] | None:
        """The last merge that makes ``token`` (None for a single symbol or a token BPE never makes)."""
        if token not in self.parts:
            syms = self.symbols(token)
            done = None
            while len(syms) > 1:
                pair = min(zip(syms, syms[1:], strict=False), key=lambda p: self.rank.get(p, 1 << 60))
                if pair not in self.rank:
                    break
                done = pair if len(syms) == 2 else None
                i = next(i for i, p in enumerate(zip(syms, syms[1:], strict=False)) if p == pair)
                syms = [*syms[:i], pair[0] + pair[1], *syms[i + 2:]]
            self.parts[token] = done
        return self.parts[token]

    def spine(self, token: str, side: int) -> list[tuple[str, int]]:
        """The parts of a token at its left (0) or right (1) edge, each with the rank that ends it."""
        got = self.spines.get((token, side))
        if got is None:
            got = [(token, 1 << 60)]
            while pair := self.split(got[-1][0]):
                got.append((pair[side], self.rank[pair]))
            self.spines[token, side] = got
        return got

    def follows(self, s: str, t: str) -> bool:
        """Whether BPE leaves s and t apart (s empty: whether it makes t one token).

        It joins them if some part at the right edge of s and some part at the left edge of t have a
        merge that ranks before whatever ends either part; of equal ranks the leftmost goes first."""
        known = self.ok.get((s, t))
        if known is None:
            rank = self.rank.get
            if len(self.symbols(t)) > 1 and self.split(t) is None:
                known = False
            else:
                known = not s or not any((r := rank((x, y))) is not None and r < ends_x and r <= ends_y
                                         for x, ends_x in self.spine(s, 1) for y, ends_y in self.spine(t, 0))
            if len(self.ok) > MAX_CACHED:
                self.ok.clear()
            self.ok[s, t] = known
        return known

    def _before(self, piece: str, j: int, last: list[str], mark: str) -> int:
        """Where the last token of the first j symbols begins (``mark``: the end mark, if the prefix ends there)."""
        for k in range(max(0, j - self.longest), j):
            t = piece[k:j] + mark
            if t in self.vocab and self.follows(last[k], t):
                return k
        raise ValueError(f"no token ends at symbol {j}")

    def open_table(self, piece: str, n: int) -> tuple[list[str], list[int]]:
        """last[j], count[j] for j = 0 .. n: last token and token count of the first j symbols, not yet ended."""
        last, count = [""], [0]
        for j in range(1, n + 1):
            k = self._before(piece, j, last, "")
            last.append(piece[k:j])
            count.append(count[k] + 1)
        return last, count

    def entry(self, prefix: str) -> tuple[str, int]:
        """Last token and token count of a prefix not yet ended; the entry depends on the prefix alone,
        so all pieces that begin with it share it."""
        got = self.open.get(prefix)
        if got is None:
            got = self.open[prefix] = self.closed(prefix, self.open_tokens)
        return got

    def closed(self, prefix: str, tokens: dict[str, str]) -> tuple[str, int]:
        """Last token (one of ``tokens``) and token count of a prefix, from the entries of the prefixes before it."""
        n, known = len(prefix), self.ok.get
        for k in range(max(0, n - self.longest), n):
            t = tokens.get(prefix[k:])
            if t is not None:
                last, count = self.entry(prefix[:k])
                fits = known((last, t))
                if fits or fits is None and self.follows(last, t):
                    return t, count + 1
        raise ValueError("no token ends here")

    def total(self, piece: str) -> int:
        """Tokens of the whole piece: the table of its proper prefixes, closed by the ending token."""
        if len(piece) <= LAZY:
            return self.closed(piece, self.end_tokens)[1]
        last, count = self.open_table(piece, len(piece) - 1)
        return count[self._before(piece, len(piece), last, self.end)] + 1

    def prefix_counts(self, piece: str) -> list[int]:
        """count[j - 1]: tokens of the first j symbols of ``piece`` taken as a whole pre-token."""
        last, count = self.open_table(piece, len(piece) - 1)
        return [count[self._before(piece, j, last, self.end)] + 1 for j in range(1, len(piece) + 1)]


class PrefixCounter:
    """Token counts of texts and of all their prefixes, equal to the library's.

    Pre-tokens never cross a space or newline, so a text is a row of chunks: the counts at chunk
    ends are running sums, and a prefix that ends inside a chunk adds the entry of that chunk's own
    table.  Tables are kept per distinct chunk."""

    def __init__(self, name: str):
        self.tk = load(name)
        with open(public_path(name), encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.bpe = PrefixBpe(model["vocab"], model["merges"], model.get("end_of_word_suffix") or "")
        self.tables: dict[str, tuple[int, ...]] = {"": ()}
        self.pieces: dict[str, int] = {}
        self.totals: dict[str, int] = {"": 0}

    def _library(self, text: str) -> int:
        return len(self.tk.encode(text, add_special_tokens=False).ids)

    def _pieces(self, chunk: str) -> list[str]:
        norm = self.tk.normalizer.normalize_str(chunk) if self.tk.normalizer else chunk
        return [p for p, _ in self.tk.pre_tokenizer.pre_tokenize_str(norm)]

    def _piece(self, piece: str) -> int:
        got = self.pieces.get(piece)
        if got is None:
            got = self.bpe.total(piece)
            if len(piece) <= MAX_MEMO:
                self.pieces[piece] = got
        return got

    def _total(self, chunk: str) -> int:
        """Tokens of a whole chunk: the closed tables of its pre-tokens."""
        if any(s in chunk for s in self.special):
            return self._library(chunk)
        return sum(map(self._piece, self._pieces(chunk)))

    def _learn(self, new: list[str]) -> None:
        """Totals of chunks not met before.  Pre-tokens never cross a space, so a batch of chunks is
        joined by spaces and pre-tokenized in one call; each pre-token goes to the chunk it starts in."""
        totals, plain = self.totals, []
        for c in new:
            if WHITE.search(c) or len(c) > MAX_MEMO or any(s in c for s in self.special):
                totals[c] = self._total(c)
            else:
                plain.append(c)
        for at in range(0, len(plain), LEARN_BATCH):
            some = plain[at:at + LEARN_BATCH]
            norm = " ".join(some)
            if self.tk.normalizer:
                norm = self.tk.normalizer.normalize_str(norm)
            ends = [e + i for i, e in enumerate(accumulate(map(len, norm.split(" "))))]
            if len(ends) != len(some):
                totals.update((c, self._total(c)) for c in some)
                continue
            counts, i = [0] * len(some), 0
            for piece, (start, _) in self.tk.pre_tokenizer.pre_tokenize_str(norm):
                while start >= ends[i]:
                    i += 1
                counts[i] += self._piece(piece)
            totals.update(zip(some, counts, strict=True))

    def table(self, chunk: str) -> tuple[int, ...]:
        """Token count after each character of a chunk.  One pre-token that keeps its characters
        (plain letters) is read off its table; other chunks count each prefix by its own pre-tokens."""
        got = self.tables.get(chunk)
        if got is None:
            if chunk.isascii() and chunk.isalpha():
                got = tuple(self.bpe.prefix_counts(self._pieces(chunk)[0]))
            else:
                got = tuple(self._total(chunk[:j]) for j in range(1, len(chunk) + 1))
            if len(chunk) <= MAX_MEMO:
                self.tables[chunk] = got
        return got

    def chunk_counts(self, texts: list[str]) -> Iterator[tuple[list[str], list[int]]]:
        """Chunks of each text, cut at single spaces and newlines, and their tokens."""
        totals = self.totals
        if len(totals) > MAX_CACHED:
            self.pieces.clear()
            for held, empty in ((totals, 0), (self.tables, ()), (self.bpe.open, ("", 0))):
                held.clear()
                held[""] = empty
        cut = [t.replace("\n", " ").split(" ") for t in texts]
        if new := set().union(*cut).difference(totals):
            self._learn(list(new))
        for chunks in cut:
            yield chunks, list(map(totals.__getitem__, chunks))

    def prefix_counts(self, text: str) -> np.ndarray:
        """n[j]: tokens of text[:j], for j = 0 .. len(text)."""
        out = np.zeros(len(text) + 1, np.int64)
        at = before = 0
        for c in text.replace("\n", " ").split(" "):
            t = self.table(c)
            out[at + 1:at + 1 + len(c)] = np.array(t, np.int64) + before
            before += t[-1] if t else 0
            at += len(c)
            if at < len(text):
                at += 1
                out[at] = before
        return out


def prefix_tables(docs: DataFrame, tokenizer: str = TOKENIZER, id_col: str = "doc_id", text_col: str = "text",
                  limit: int | None = None) -> DataFrame:
    """doc_id, n_bytes, n_tokens, ends, counts (and chars_in_limit if ``limit`` is given).

    counts[i] is the token count of the prefix that ends at character ends[i], for every chunk of the
    text (null: empty); chars_in_limit is the longest prefix, to the character, of at most ``limit``
    tokens.  Whole texts, each task on its own rows, no shuffle."""
    rows = pick(docs, doc_id=id_col, text=text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def counted(pc: PrefixCounter, col: pa.Array) -> Iterator[tuple[str, list[str], list[int]]]:
        at = 0
        texts = [t or "" for t in col.to_pylist()]
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end]) <= BATCH_CHARS):
                size += len(texts[end])
                end += 1
            for text, found in zip(texts[at:end], pc.chunk_counts(texts[at:end]), strict=True):
                yield text, *found
            at = end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pc = shared(("counts", tokenizer), lambda: PrefixCounter(tokenizer))
        for b in batches:
            n_bytes, n_tokens, ends, counts, fit = [], [], [], [], []
            for text, chunks, tokens in counted(pc, b.column(1)):
                n = np.cumsum(tokens, dtype=np.int64)
                size = np.fromiter(map(len, chunks), np.int64, len(n))
                end = np.cumsum(size + 1) - 1
                n_bytes.append(len(text.encode()))
                n_tokens.append(int(n[-1]))
                ends.append(end)
                counts.append(n)
                if limit is not None:
                    k = int(np.searchsorted(n, limit, "right"))
                    if k == len(n):
                        fit.append(len(text))
                        continue
                    start = int(end[k - 1]) + 1 if k else 0
                    base = int(n[k - 1]) if k else 0
                    chunk = text[start:int(end[k])]
                    inside = [j for j, c in enumerate(pc.table(chunk), 1) if base + c <= limit]
                    fit.append(start + inside[-1] if inside else start)
            cols = [b.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()),
                    pa.array(ends, pa.list_(pa.int64())), pa.array(counts, pa.list_(pa.int64()))]
            names = ["doc_id", "n_bytes", "n_tokens", "ends", "counts"]
            if limit is not None:
                cols.append(pa.array(fit, pa.int64()))
                names.append("chars_in_limit")
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return rows.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long, ends array<long>, counts array<long>"
                           + (", chars_in_limit long" if limit is not None else ""))


def tokens_before(char: Column, ends: str = "ends", counts: str = "counts") -> Column:
    """Tokens of the whole chunks that end at or before a character offset, from a prefix table."""
    k = F.size(F.filter(F.col(ends), lambda e: e <= char))
    return F.when(k > 0, F.get(F.col(counts), k - 1)).otherwise(F.lit(0).cast("long"))


def token_counts(docs: DataFrame, tokenizer: str = TOKENIZER, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, chars_in_limit (longest prefix within the limit)."""
    return (prefix_tables(docs, tokenizer, limit=limit)
            .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "chars_in_limit"))
