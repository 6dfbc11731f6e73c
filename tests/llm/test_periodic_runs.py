"""Periodic runs against a search over all periods."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tessera.llm import periodic_runs

SCHEMA = "doc_id long, text string"


def brute_runs(words):
    """Every period up to a third of the text, every stretch that keeps it; the smallest period per stretch."""
    best, n = {}, len(words)
    for q in range(1, n // 3 + 1):
        start = None
        for i in range(n - q + 1):
            same = i + q < n and words[i] == words[i + q]
            if same and start is None:
                start = i
            if not same and start is not None:
                if i - start + q >= max(24, 3 * q):
                    best.setdefault((start, i - start + q), q)
                start = None
    return sorted(((s, n_, q) for (s, n_), q in best.items()), key=lambda r: (r[0], r[2]))


def edited(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def expected(doc_id, text, edit):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    words = edited(doc_id, words) if edit else words
    runs = brute_runs(words)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
            sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def texts():
    rng = random.Random(5)
    for i in range(300):
        words = []
        while len(words) < rng.choice([0, 20, 80, 250]):
            if rng.random() < .5:
                words += [rng.choice("abcdé") for _ in range(rng.randint(1, 12))]
            else:
                unit = [rng.choice(["x", "yy", "漢"]) for _ in range(rng.randint(1, 15))]
                words += (unit * rng.randint(2, 40))[:rng.randint(5, 140)]
        yield i, rng.choice([" ", "\n", " \t "]).join(words)


ROWS = [*texts(), (None, "a b " * 30), (None, None), (500, None), (501, ""), (502, " \n\t"), (503, "one"),
        (504, "a b c " * 10), (504, "a b c " * 10), (504, "other words"), (505, " ".join("ab" * 40)),
        (506, " ".join(f"w{i}" for i in range(4000)))]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


def test_runs_match_brute_force(docs):
    clash = docs.select("*", F.lit(1).alias("n_runs"), F.lit("x").alias("TEXT"), F.lit(2).alias("start"))
    got = sorted(map(tuple, periodic_runs.run_digests(clash).collect()), key=repr)
    assert got == sorted((expected(i, t, True) for i, t in ROWS), key=repr)
    assert sum(r[1] > 0 for r in got) > 100


def test_runs_without_edit(docs):
    got = sorted((r.doc_id, r.n_runs, r.collapsed) for r in periodic_runs.periodic_runs(docs).collect() if r.doc_id in (503, 504, 505))
    assert got == [(503, 0, "one"), (504, 0, "other words"), (504, 1, "a b c"), (504, 1, "a b c"), (505, 1, "a b")]


def test_long_texts_and_empty_table(spark):
    word = " ".join(f"w{i}" for i in range(30_000))
    rows = [(1, "a " * 60_000), (2, f"{word} {word} {word} {word}"), (3, word)]
    got = {r.doc_id: r for r in periodic_runs.periodic_runs(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert (got[1].runs, got[1].collapsed) == ("0,60000,1\n", "a")
    assert (got[2].runs, got[2].collapsed, got[2].exponent_milli) == ("0,120000,30000\n", word, 4000)
    assert got[3].n_runs == 0 and got[3].start is None
    assert periodic_runs.run_digests(spark.createDataFrame([], SCHEMA)).count() == 0


def test_copies_in_one_batch_do_not_match_each_other(spark):
    text = " ".join(f"w{i % 40}" for i in range(100))  # 2.5 periods: no run, in any number of copies
    got = periodic_runs.periodic_runs(spark.createDataFrame([(i, text) for i in range(50)], SCHEMA).coalesce(1))
    assert got.filter("n_runs > 0").count() == 0
