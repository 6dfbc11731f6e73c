"""Fingerprints against a plain version that hashes every text, also the edited one, from the start."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tessera.llm import fingerprints as fp

SCHEMA = "doc_id long, text string"


def xx(data, seed):
    return xxhash.xxh64_intdigest(data, seed & (2 ** 64 - 1))


def paragraph_vector(part):
    p = []
    for seed in range(1, 5):
        h = xx(part.encode(), xx(seed.to_bytes(4, "little"), 42))
        p += [h & 0xFFFFFFFF, h >> 32]
    w = np.zeros(120, np.int64)
    words = re.findall(r"[^\x20\x09-\x0D]+", part)
    for i, word in enumerate(words):
        h = xx(word.encode(), xx(words[i - 1].encode(), 42) if i else 42) & ~3
        g = xx(h.to_bytes(8, "little"), 42)
        bits = [x >> (2 + k + j) & 1 for k in (0, 30) for x in (h, g) for j in range(30)]
        w += 2 * np.array(bits) - 1
    return np.array(p, dtype=object), w


def vector(text):
    p, w = np.zeros(8, dtype=object), np.zeros(120, np.int64)
    for part in text.split("\n"):
        a, b = paragraph_vector(part)
        p, w = p + a, w + b
    return p % 2 ** 32, w % 2 ** 16


def digits(v):
    return "".join(f"{x:08x}" for x in v[0]) + "".join(f"{x:04x}" for x in v[1])


def likeness(a, b):
    if digits(a) == digits(b):
        return 1.0
    signed = lambda x: (x + 2 ** 15) % 2 ** 16 - 2 ** 15
    both = sum(int((signed(v[1]) ** 2).sum()) for v in (a, b))
    return max(0.0, 1 - int((signed(a[1] - b[1]) ** 2).sum()) / both) if both else 0.0


def edited(text, after):
    k = len(text) // 4
    return text[:len(text) - k] + after[:k]


def texts():
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(300)] + ["é漢", "A", "b,"]
    for i in range(150):
        yield i * 3, rng.choice(["", "\n", "x"]) + "".join(rng.choice(vocabulary) + rng.choice([" ", " ", " ", "\n", "\t", "\n\n"])
                                                            for _ in range(rng.choice([0, 1, 3, 40, 200])))


ROWS = [*texts(), (1, None), (4, ""), (7, " \n \t"), (10, "one"), (11, "one"), (13, "\n" * 9), (16, "abc\ndef\nghi jkl"), (None, "no id here"),
        (500, "same row again"), (500, "same row again"), (500, "same row again"), (500, "another text of this id"), (501, "w1 w2\n" * 3000)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


def key(row):
    text = row[1] or ""
    h = xx(text.encode(), 42)
    return (row[0] is not None, row[0], len(text), h - 2 ** 64 if h >= 2 ** 63 else h)


@pytest.mark.parametrize("per_block", [5, 64])
def test_fingerprints_match_plain_version(docs, per_block):
    rows = sorted(ROWS, key=key)
    want = []
    for i, (doc_id, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        e = edited(text, after)
        v, ve, vn = vector(text), vector(e), vector(after)
        want.append((doc_id, len(text), hashlib.sha256(e.encode()).hexdigest(), digits(v), digits(ve),
                     round(likeness(v, ve), 12), round(likeness(v, vn), 12)))
    clash = docs.select("*", F.lit(1).alias("pos"), F.lit("x").alias("TEXT"), F.lit(2).alias("_block"))
    got = fp.document_fingerprints(clash, per_block).collect()
    have = sorted(((*r[:5], round(r.near_edited, 12), round(r.near_next, 12)) for r in got), key=repr)
    assert have == sorted(want, key=repr)


def test_paragraphs_in_any_order_and_deletion(spark):
    rows = [(1, "a b\nc d\ne"), (2, "e\na b\nc d"), (3, "a b c d e"), (4, "a b\nc d\ne"), (5, "a b\nc d")]
    got = {r.doc_id: r for r in fp.document_fingerprints(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[1].fingerprint == got[2].fingerprint == got[4].fingerprint
    assert len({r.fingerprint for r in got.values()}) == 3 and got[1].near_next == 1.0 and got[3].near_next < 1
    lanes = spark.createDataFrame(rows, SCHEMA).select("doc_id", fp.paragraph_lanes(F.split("text", "\n")).alias("p"))
    p = {r.doc_id: r.p for r in lanes.collect()}
    one = spark.createDataFrame([(p[1], p[5])], "a array<long>, b array<long>")
    left = one.select(fp.subtract_lanes(F.col("a"), F.col("b"), fp.P_MASK).alias("d"))
    e = spark.createDataFrame([("e",)], "t string").select(fp.paragraph_lanes(F.split("t", "\n")).alias("d"))
    assert left.first().d == e.first().d


def test_likeness_follows_the_shared_part(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(f"v{rng.randint(0, 10 ** 6)}" for _ in range(400))) for i in range(300)]
    got = fp.document_fingerprints(spark.createDataFrame(rows, SCHEMA)).toPandas()
    assert abs(got.near_edited.mean() - 0.75) < 0.02 and got.near_edited.min() > 0.6
    assert got.near_next.mean() < 0.08 and got.near_next.max() < 0.45


def test_single_long_and_empty_tables(spark):
    got = fp.document_fingerprints(spark.createDataFrame([(1, "alone here now")], SCHEMA)).collect()
    assert got[0].edited_sha256 == hashlib.sha256(edited("alone here now", "alone here now").encode()).hexdigest()
    assert got[0].near_next == 1.0
    big = "word " * 200_000
    got = fp.document_fingerprints(spark.createDataFrame([(1, big), (2, "x")], SCHEMA)).orderBy("doc_id").collect()
    assert got[0].fingerprint == digits(vector(big)) and got[0].n_chars == 1_000_000
    assert fp.document_fingerprints(spark.createDataFrame([], SCHEMA)).count() == 0
