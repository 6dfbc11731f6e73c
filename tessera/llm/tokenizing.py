"""Public tokenizers applied to whole texts inside tasks."""

from __future__ import annotations

import os

import numpy as np

from .common import ship

ship(__name__)

#: Encoded chunks kept per worker, in two halves (a memory bound, not a limit on texts).
MAX_CACHED = 900_000
#: Characters of text cut into chunks at once.
BATCH_CHARS = 2_000_000
LEARN_BATCH = 4096
#: Chunks encoded as one string, and what stands before each that starts with a space.
JOINED = 64
BETWEEN = "\nX"


def public_path(name: str) -> str:
    """Place of a public tokenizer file on this machine (a name, or a path of one's own)."""
    if os.path.sep in name:
        return name
    import public_tokenizers
    return public_tokenizers.path(name)


def load(name: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer
    found = Tokenizer.from_file(public_path(name))
    found.no_truncation()
    found.no_padding()
    return found


def shared(key: tuple, make):
    """One object per worker process and key: later tasks of the same worker go on with its caches."""
    import sys
    import types
    store = sys.modules.setdefault("tessera_worker_objects", types.ModuleType("tessera_worker_objects"))
    held = store.__dict__.setdefault("held", {})
    if key not in held:
        held[key] = make()
    return held[key]


class Chunks:
    """What is known of chunks, in two generations: when the newer is full it becomes the older, and chunks met
    again move back, so frequent ones stay and those met once go."""

    def __init__(self) -> None:
        self.new: dict = {}
        self.old: dict = {}

    def missing(self, chunks: set[str]) -> set[str]:
        """The chunks to learn; all others are in ``new`` afterwards."""
        if len(self.new) > MAX_CACHED // 2:
            self.old, self.new = self.new, {}
        todo = chunks.difference(self.new)
        again = todo.intersection(self.old)
        self.new.update(zip(again, map(self.old.__getitem__, again), strict=True))
        return todo - again


class ByteBpeEncoder:
    """encode_all(texts) -> ids of each as little-endian unsigned integers, equal to the library's ids for the whole text.

    For byte-level BPE whose pre-tokenizer lets a word take at most one space before it.  A text
    is cut before every space or newline that stands alone between two other characters; no
    pre-token crosses such a cut, so chunks encode independently and the library runs once per
    distinct chunk.  A text with any other white space goes to the library whole.  With ``lengths``
    only the number of ids of each text is kept and returned."""

    def __init__(self, name: str, lengths: bool = False):
        self.tk = load(name)
        self.dtype = np.dtype("<u2") if self.tk.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        size = self.dtype.itemsize
        self.kept, self.whole = (lambda raw: len(raw) // size, sum) if lengths else (lambda raw: raw, b"".join)
        self.known, self.heads = Chunks(), Chunks()
        self.between = np.frombuffer(self._ids([BETWEEN])[0], self.dtype)

    def _ids(self, texts: list[str], step: int = LEARN_BATCH) -> list[bytes]:
        out: list[bytes] = []
        for at in range(0, len(texts), step):
            out += [np.array(e.ids, self.dtype).tobytes()
                    for e in self.tk.encode_batch_fast(texts[at:at + step], add_special_tokens=False)]
        return out

    def _joined_ids(self, chunks: list[str]) -> list[bytes]:
        """ids of chunks that all start with a space, or all with a newline, JOINED to a string: a new line
        starts before each (BETWEEN, or the chunk's own), a cut the encoding respects, so the ids are split
        at the newline's id.  A string whose lines come out otherwise is encoded chunk by chunk."""
        if not chunks or len(self.between) != 2:
            return self._ids(chunks)
        own = chunks[0][0] == "\n"
        skip = 0 if own else self.between.nbytes
        parts = [chunks[at:at + JOINED] for at in range(0, len(chunks), JOINED)]
        raws = self._ids(["".join(p) if own else BETWEEN + BETWEEN.join(p) for p in parts],
                         LEARN_BATCH // JOINED)
        out: list[bytes] = []
        for part, raw in zip(parts, raws, strict=True):
            ids = np.frombuffer(raw, self.dtype)
            lines = np.flatnonzero(ids == self.between[0])
            if len(lines) != len(part) or lines[0] or not (own or (ids[lines + 1] == self.between[1]).all()):
                out += self._ids(part)
                continue
            at = [*(lines * self.dtype.itemsize).tolist(), len(raw)]
            out += [raw[p + skip:q] for p, q in zip(at, at[1:])]
        return out

    def _learn(self, known: Chunks, chunks: set[str], lead: str) -> None:
        """Encode the chunks not met before, each after ``lead`` (a newline at its start takes none).
        None marks a chunk whose white space makes the cuts around it unsafe."""
        words, lines = [], []
        for c in known.missing(chunks):
            body = c[1:] if c[:1] == "\n" else c
            if not body or body[0].isspace() or body[-1].isspace():
                known.new[c] = None
            else:
                (words if body is c else lines).append(c)
        spaced = [lead + c for c in words]
        known.new.update(zip(words, map(self.kept, self._joined_ids(spaced) if lead else self._ids(spaced)), strict=True))
        known.new.update(zip(lines, map(self.kept, self._joined_ids(lines)), strict=True))

    def encode_all(self, texts: list[str]) -> list:
        """ids of each text (those of an empty text are none), or their number; at most BATCH_CHARS of text are cut at once."""
        out: list = []
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end]) <= BATCH_CHARS):
                size += len(texts[end])
                end += 1
            cut = [t.replace("\n", " \n").split(" ") for t in texts[at:end]]
            self._learn(self.heads, {c[0] for c in cut}, "")
            self._learn(self.known, set().union(*(c[1:] for c in cut)), " ")
            for text, (first, *rest) in zip(texts[at:end], cut, strict=True):
                try:
                    out.append(self.heads.new[first] + self.whole(map(self.known.new.__getitem__, rest)) if text else self.kept(b""))
                except TypeError:
                    out += map(self.kept, self._ids([text]))
            at = end
        return out
