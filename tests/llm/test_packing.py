"""Variable-capacity best fit against a plain, slow version, and the choice of lengths."""

import random

import pytest

from tessera.llm import packing


def plain(sizes, lengths, overhead):
    best = None
    for ceiling in sorted(lengths):
        bins = []  # [capacity, items]
        where = []
        for i, s in enumerate(sizes):
            free = [(cap - sum(items), n) for n, (cap, items) in enumerate(bins) if cap - sum(items) >= s]
            if free:
                n = min(free)[1]
            else:
                fit = [c for c in sorted(lengths) if s <= c <= ceiling] or [min(c for c in lengths if c >= s)]
                scored = []
                for c in fit:
                    used = s
                    for t in sizes[i + 1:]:
                        if used + t <= c:
                            used += t
                    scored.append(((min(x for x in lengths if x >= used) + overhead) / used, c))
                bins.append([min(scored)[1], []])
                n = len(bins) - 1
            where.append((n, sum(bins[n][1])))
            bins[n][1].append(s)
        final = [min(x for x in lengths if x >= sum(items)) for _, items in bins]
        cost = sum(final) + overhead * len(final)
        if best is None or cost < best[0]:
            best = cost, [(n, at, final[n]) for n, at in where]
    return best


@pytest.mark.parametrize("seed", range(6))
def test_best_fit_equals_plain_version(seed):
    rng = random.Random(seed)
    lengths = rng.choice([(512, 1024, 2048, 4096, 8192), (16, 40, 64), (100,)])
    sizes = sorted((rng.randint(1, rng.choice([lengths[0], lengths[-1]])) for _ in range(150)), reverse=True)
    assert packing.best_fit(sizes, lengths, 64) == plain(sizes, lengths, 64)[1]


def test_lengths_are_mixed_where_that_costs_less():
    sizes = [2000] * 10 + [600] * 40  # two of 600 fill 1200, three leave much of 2048
    got = packing.best_fit(sizes, (1200, 2048), 64)
    bins = {b: c for b, _, c in got}
    assert sorted(bins.values()) == [1200] * 20 + [2048] * 10
    uniform = len({b for b, _, _ in packing.best_fit(sizes, (2048,), 64)}) * (2048 + 64)
    assert sum(c + 64 for c in bins.values()) < uniform


def test_ties_empty_and_full_sizes():
    assert packing.best_fit([], (8, 16)) == []
    assert packing.best_fit([16, 16, 8], (8, 16), 1) == [(0, 0, 16), (1, 0, 16), (2, 0, 8)]


def test_documents_with_nulls_long_texts_and_clashing_columns(spark):
    from pyspark.sql import functions as F
    rows = [(1, None), (2, ""), (3, "word " * 60_000), (3, "word " * 60_000), (None, "no id"), (4, "a b c")]
    df = spark.createDataFrame(rows, "doc_id long, text string").select("*", F.lit(1).alias("bin_id"), F.lit("x").alias("TEXT"), F.lit(2).alias("copies"))
    got = packing.pack_documents(df).toPandas()
    top = packing.LENGTHS[-1]
    for (doc, copy), part in got[got.doc_id == 3].groupby(["doc_id", "copy"]):
        part = part.sort_values("piece")
        assert list(part.piece) == list(range(len(part))) and (part.n_tokens[:-1] == top).all() and part.n_tokens.sum() > 60_000
    assert set(got[got.doc_id == 3]["copy"]) == {1, 2} and len(got[got.doc_id.isna()]) == 1
    assert (got[got.doc_id.isin([1, 2])].n_tokens == 1).all()  # the end token
    fill = got.groupby("bin_id").agg(used=("n_tokens", "sum"), length=("bin_length", "first"))
    assert (fill.used <= fill.length).all()
