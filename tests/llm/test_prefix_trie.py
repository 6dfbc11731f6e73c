"""The prefix trie against a plain dictionary of prefixes."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tessera.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def words(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t))


def plain(rows, rebuild):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [(t[2], t[3]) for t in sorted(ts)] for c, ts in convs.items()}
    if rebuild:
        h = {c: zlib.crc32(str(c).encode()) % 4 for c in convs}
        convs = {c: convs.get(c - c % 20, [])[:h[c]] + ts[h[c]:] for c, ts in convs.items()}
    members = {}
    for c, ts in convs.items():
        for d in range(len(ts) + 1):
            members.setdefault(tuple(ts[:d]), []).append(c)
    kids = {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        below = kids.get(p, [])
        leaves[p] = sum(leaves[k] for k in below) if below else 1
        saved[p] = sum(saved[k] for k in below) + (len(members[p]) - 1) * (words(p[-1][1]) if p else 0)
    out = []
    for p, cs in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in cs if len(convs[c]) == len(p)))
        out.append((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), len(kids.get(p, [])), leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def conversations():
    rng = random.Random(3)
    rows = []
    for c in rng.sample(range(400), 260):
        start = rng.choice([["a"], ["a", "b"], ["b"], ["a", "b", "c", "d"], []])
        ts = start + [rng.choice("abc") * rng.randint(1, 2) for _ in range(rng.randint(0 if start else 1, 5))]
        rows += [(c, i, rng.choice(["user", "user", None]) if rng.random() < .1 else "user", t + " " + t if t == "a" else t)
                 for i, t in enumerate(ts)]
    rows += [(c, i, "user", t) for c in range(1000, 1100) for i, t in enumerate("same")]          # a hundred equal ones
    rows += [(2000, i, "user", f"long {i}") for i in range(700)]                                   # one long, and others that follow it
    rows += [(2020 + k, i, "user", f"long {i}" if i < 50 * k else f"off {k}") for k in range(12) for i in range(50 * k + 2)]
    rows += [(3000, None, "user", "no turn"), (3000, 0, None, None), (3001, 0, "user", "x"), (3001, 0, "user", "x"), (3001, 0, "bot", "y"),
             (None, 0, "user", "nobody's"), (3003, 0, "user", " \n "), (3004, 0, "", "")]
    return rows


ROWS = conversations()


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.mark.parametrize("rebuild,cut", [(True, False), (False, False), (True, True)])
def test_trie_matches_plain_version(table, rebuild, cut, monkeypatch):
    if cut:  # blocks of some 40 rows: every running value and neighbour crosses blocks
        from tessera.operators import ordering
        real = ordering.deal
        small = lambda df, keys, order, per_block=40: real(df, keys, order, 40)
        monkeypatch.setattr(ordering, "deal", small)
        monkeypatch.setattr(prefix_trie, "deal", small)
    clash = table.select("*", F.lit(1).alias("depth"), F.lit("q").alias("TEXT"), F.lit(2).alias("chain"))
    got = sorted(map(tuple, prefix_trie.prefix_trie(clash, rebuild).collect()), key=repr)
    want = plain(ROWS, rebuild)
    assert len(got) == len(want)
    assert got == want


def test_small_tables(spark):
    assert prefix_trie.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    one = [(7, 0, "user", "hello there")]
    got = sorted(map(tuple, prefix_trie.prefix_trie(spark.createDataFrame(one, SCHEMA)).collect()))
    assert got == plain(one, False)
    far = [(25, 0, "u", "a"), (25, 1, "u", "b"), (45, 0, "u", "c")]  # no conversation 20 or 40 to begin with
    got = sorted(map(tuple, prefix_trie.prefix_trie(spark.createDataFrame(far, SCHEMA), True).collect()), key=repr)
    assert got == plain(far, True)
