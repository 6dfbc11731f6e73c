"""The corpus operators against brute force, on a fixture with nulls, empty and long texts, ties and repeats."""

import hashlib
import os
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm import (components, exact_dedup, langid, line_dedup, mixing, packing, quality_rules, queries, simhash,
                         suffix_dedup, token_counts, token_files)

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join(WORDS[i] + ("." if i % 7 == 0 else "") + ("\n" if i % 11 == 0 else "") for i in rng.integers(0, 19, n))


LONG = prose(99, 4000)
ROWS = [
    (1, prose(1, 80), "en", "a", 1), (2, prose(1, 80).replace(" ", "  "), "en", "a", 2), (3, None, None, None, None),
    (4, "", "en", "a", 0), (5, "  \n\t ", "en", "b", 5), (6, LONG, "de", "b", 6), (7, "x" + LONG, "de", "b", 6),
    (8, prose(2, 60) + "\n" + LONG[300:1200], "fr", "a", 9), (9, "one two", "fr", None, 7), (9, "one two", "fr", None, 7),
    (10, "same line\n" * 30, "en", "c", 1), (11, "*** | % $$ #\n|", "en", "c", 1), (12, "wé ñ Å € 漢字 12 3's", "es", "c", 1),
    (None, prose(3, 70), "en", "a", 1), (None, prose(1, 80), "en", "a", 1), (13, "aaaa" * 300, "en", "a", 1),
    (14, prose(2, 60) + "\n" + prose(5, 90), "en", "a", 1), (14, "another text of the same id " * 3, "en", "a", 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def clashing(df):
    """Extra columns with names the operators use themselves, also in other case."""
    return df.select("*", F.lit(1).alias("keep_id"), F.lit("q").alias("TEXT"), F.lit(2).alias("fp"), F.lit(3).alias("n_tokens"),
                     F.lit(4).alias("t"), F.lit(5).alias("host"), F.lit(6).alias("Doc_ID"))


def words_of(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def test_exact_dedup(docs):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = {}
    for r in ROWS:
        groups.setdefault(norm(r[1]), []).append(r[0])
    got = exact_dedup.exact_dedup(clashing(docs)).collect()
    assert len(got) == len(ROWS)
    for t, ids in groups.items():
        sha = hashlib.sha256(t.encode()).hexdigest()
        rows = [r for r in got if r.text_sha256 == sha]
        want = min((i for i in ids if i is not None), default=None)
        assert len(rows) == len(ids) and all(r.group_size == len(ids) and r.keep_id == want for r in rows)
        assert [r.doc_id for r in rows if r.kept] == [want]
    assert exact_dedup.keep_first(clashing(docs)).count() == len(groups)


def test_quality_rules(docs):
    got = {(r.doc_id, r.n_words, r.n_repeat_words): r for r in quality_rules.quality_rules(clashing(docs)).collect()}
    for i, t, *_ in ROWS:
        w = words_of(t)
        tri = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
        hit = {k + d for k, x in enumerate(tri) if tri.count(x) > 1 for d in range(3)}
        r = got[i, len(w), len(hit)]
        lines = [x for x in (t or "").split("\n") if words_of(x)]
        assert r.word_chars == sum(map(len, w)) and r.n_symbols == sum(c in "#*$%&|<>" for c in t or "")
        assert r.n_dup_lines == len(lines) - len(set(lines))
        assert r.base_failed == (len(w) < 50 or 100 * len(hit) > 50 * len(w))
    kept = quality_rules.keep_passing(docs)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.kept for r in quality_rules.quality_rules(docs).collect())


def test_host_verdict_rejects_a_bad_host(spark):
    rows = [(f"h{h}", h == 0 or i == 0) for h in range(20) for i in range(40)]
    got = {r.host: r for r in quality_rules.host_verdicts(spark.createDataFrame(rows, "host string, base_failed boolean")).collect()}
    assert not got["h0"].host_ok and all(got[f"h{h}"].host_ok for h in range(1, 20))
    assert got["h0"].rate < 1.0 and got["h1"].rate > 1 / 40


def slow_fingerprint(t):
    w = words_of("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    grams = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_simhash_fingerprints(docs):
    got = sorted(((r.doc_id or -1), r.fingerprint) for r in simhash.simhash_groups(clashing(docs)).collect())
    assert got == sorted(((i or -1), f"{slow_fingerprint(t):016x}") for i, t, *_ in ROWS)


def brute_components(fps, distance=3):
    root = {f: f for f in fps}
    changed = True
    while changed:
        changed = False
        for a in fps:
            for b in fps:
                if (a ^ b).bit_count() <= distance and root[a] != root[b]:
                    root[a] = root[b] = min(root[a], root[b])
                    changed = True
    return root


@pytest.mark.parametrize("bucket", [64, 3])
def test_simhash_links_in_small_and_large_buckets(spark, bucket):
    rng = np.random.default_rng(4)
    fps = {int(x) for x in rng.integers(0, 1 << 62, 30)}
    for c in list(fps)[:6]:
        for _ in range(14):
            f = c
            for b in rng.integers(0, 64, rng.integers(1, 5)):
                f ^= 1 << int(b)
            fps.add(f)
    signed = lambda f: f - (1 << 64) if f >> 63 else f
    nodes = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    links = simhash.links(nodes, pair_bucket=bucket).distinct().collect()
    got = {r.node: r.root for r in components.components(spark.createDataFrame(
        [(r.u, r.v) for r in links], "u long, v long")).collect()}
    want = brute_components(sorted(fps))
    part = lambda root: {frozenset(signed(f) for f in fps if root(f) == x) for x in {root(f) for f in fps}}
    assert part(lambda f: want[f]) == part(lambda f: got.get(signed(f), signed(f)))


def test_simhash_never_broadcasts_exploded_rows(spark):
    rng = np.random.default_rng(11)
    fps = [int(x) for x in rng.integers(-2**63, 2**63, 300, dtype=np.int64)]
    fps += [fps[0] ^ (1 << a) ^ (1 << b) for a in range(12) for b in range(a)]
    nodes = simhash.cut_lineage(spark.createDataFrame([(x,) for x in sorted(set(fps))], "fp long"))
    for found in (simhash.links(nodes, pair_bucket=4), simhash._ball_links(nodes)):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
        assert {(r.u, r.v) for r in found.collect()}


def test_allocate_meets_the_pigeonhole_sum():
    costs = [{-1: 0.0, 0: 5.0, 1: 9.0}, {-1: 0.0, 0: 50.0, 1: 90.0}, {-1: 0.0, 0: 4.0, 1: 40.0}]
    paid, picked = simhash.allocate(costs, 1)
    assert sum(picked) == 1 and paid == min(
        costs[0][a] + costs[1][b] + costs[2][c] for a in (-1, 0, 1) for b in (-1, 0, 1) for c in (-1, 0, 1) if a + b + c == 1)


def test_token_counts_and_prefixes(docs):
    from tokenizers import Tokenizer

    from tessera.llm.tokenizing import public_path
    tk = Tokenizer.from_file(public_path(token_counts.TOKENIZER))
    count = lambda t: len(tk.encode(t, add_special_tokens=False).ids)
    got = sorted((r.doc_id or -1, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.token_counts(clashing(docs)).collect())
    assert got == sorted((i or -1, len((t or "").encode()), count(t or ""), count(t or "") > 2048) for i, t, *_ in ROWS)
    pc = token_counts.PrefixCounter(token_counts.TOKENIZER)
    for t in (prose(1, 20), "we're 'twas é éx<|endoftext|>a ﬃ ΑΣ  \t b''s'r'''re 12a3", ""):
        assert pc.prefix_counts(t).tolist() == [count(t[:j]) for j in range(len(t) + 1)]
    table = token_counts.prefix_tables(docs.filter("doc_id = 6")).first()
    assert all(count(LONG[:e]) == c for e, c in list(zip(table.ends, table.counts, strict=True))[::500])


def test_token_files_round_trip(docs, spark, tmp_path):
    from tokenizers import Tokenizer

    from tessera.llm.tokenizing import public_path
    tk = Tokenizer.from_file(public_path(token_files.TOKENIZER))
    got = token_files.token_files(clashing(docs), folder=str(tmp_path / "files")).orderBy("start").collect()
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids, key=lambda x: -1 if x is None else x) and len(ids) == len(ROWS)
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    want = sorted((i or -1, len(e) + 1, zlib.crc32(np.array(e + [0], "<u4").tobytes())) for i, e in (
        (i, tk.encode(t or "", add_special_tokens=False).ids) for i, t, *_ in ROWS))
    assert sorted((r.doc_id or -1, r.n_tokens, r.ids_crc32) for r in got) == want


def test_byte_encoder_on_odd_white_space():
    from tessera.llm.tokenizing import ByteBpeEncoder
    enc = ByteBpeEncoder(token_files.TOKENIZER)
    texts = ["", "a", " a", "a ", "\n", "a\n\nb", "a \n b", "a  b", "a   b", "\n\n\na", "x\n", "é  b\t\tc <|endoftext|> d", "  ", "a\n b"]
    parts = ["a", "b1", " ", "\n", "é", "X", "\nX", "\t", "<|endoftext|>", "'ll"]
    texts += ["".join(parts[(k * k * 7 + j * (k + 3)) % len(parts)] for j in range(k % 40)) for k in range(400)]
    for t, raw in zip(texts, enc.encode_all(texts), strict=True):
        assert raw == np.array(enc.tk.encode(t, add_special_tokens=False).ids, enc.dtype).tobytes()


def test_suffix_dedup_matches_brute_force(docs):
    unique = {(i, t or "") for i, t, *_ in ROWS}
    for length, window in ((400, 128), (40, 16)):
        seen = {}
        for i, t in unique:
            raw = t.encode()
            for p in range(len(raw) - length + 1):
                seen.setdefault(raw[p:p + length], []).append((i, t, p))
        marks = {k: bytearray(len(k[1].encode())) for k in unique}
        for places in seen.values():
            for i, t, p in places if len(places) > 1 else ():
                marks[i, t][p:p + length] = b"\1" * length
        want = sorted(((i or -1), sum(m), bytes(c for c, x in zip(t.encode(), m, strict=True) if not x)) for (i, t), m in marks.items())
        got = sorted({(r.doc_id or -1, r.n_removed, bytes(r.kept)) for r in suffix_dedup.suffix_dedup(clashing(docs), length, window).collect()})
        assert got == sorted(set(want))


PASSAGE = " ".join(f"planted{i}" for i in range(60))


def test_suffix_dedup_query_on_planted_passages(spark, tmp_path):
    """Every copy of a passage of 400 bytes goes, one of 399 bytes stays, clean documents of any length stay; n_bytes is the input's."""
    own = lambda i, n: " ".join(f"own{i}word{j}" for j in range(n))
    just, less = "é" + PASSAGE[:398], "漢" + PASSAGE[::-1][:396]
    assert [len(x.encode()) for x in (just, less)] == [400, 399]
    texts = {1: (own(1, 5) + "1", PASSAGE, "1" + own(1, 9)), 2: ("2", PASSAGE, "2" + own(2, 300)), 3: (own(3, 900), "", ""), 4: ("", "", own(4, 2)),
             5: (own(5, 20) + "5", just, "5"), 6: ("6", just, "6" + own(6, 20)), 7: (own(7, 20) + "7" + less + "7", "", ""), 8: ("8" + less + "8", "", "")}
    rows = [(i, "".join(t), "en", "a", 1) for i, t in texts.items()] + [(9, None, None, None, None)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.QUERIES["op6_suffix_dedup"](spark, str(tmp_path)).orderBy("doc_id").collect()
    want = [(i, len((a + b + c).encode()), len(b.encode()), int(b != ""), hashlib.sha256((a + c).encode()).hexdigest()) for i, (a, b, c) in texts.items()]
    assert [tuple(r) for r in got] == [*want, (9, 0, 0, 0, hashlib.sha256(b"").hexdigest())]


def test_suffix_dedup_classes_of_any_size(spark, monkeypatch):
    """Edges of matches, found by comparing contexts or, in classes too large for that, start by start: equal to brute force,
    with zero bytes, periods and repeated rows; no written table outgrows the sampled suffixes when contexts are compared."""
    rng = np.random.default_rng(3)
    word = lambda n, letters="abcdefgh": "".join(rng.choice(list(letters), n))
    core, parts = word(90), [word(60, "ab\0é") for _ in range(3)]
    texts = [word(k % 50) + core[k % 7:90 - k % 11] + word(30) for k in range(30)] + [word(9) + parts[k % 3] + word(k) + parts[k % 2][:45] for k in range(12)]
    texts += ["xyz" * 40, "yzx" * 21 + core, "\0" * 70, "\0" * 50 + "a"]
    rows = [(i, t, "en", "a", 1) for i, t in enumerate(texts)]
    length, window = 40, 16
    seen, marks = {}, [bytearray(len(t.encode())) for t in texts]
    for i, t in enumerate(texts):
        for p in range(len(t.encode()) - length + 1):
            seen.setdefault(t.encode()[p:p + length], []).append((i, p))
    for places in seen.values():
        for i, p in places if len(places) > 1 else ():
            marks[i][p:p + length] = b"\1" * length
    want = [(i, sum(m), bytes(c for c, x in zip(t.encode(), m, strict=True) if not x)) for i, (t, m) in enumerate(zip(texts, marks, strict=True))]
    suffixes = sum(len(suffix_dedup.sample_suffixes(t.encode(), length, window)[0]) for t in texts)
    sizes, cut = [], suffix_dedup.cut_lineage

    def counted(df):
        out = cut(df)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(suffix_dedup, "cut_lineage", counted)
    data = spark.createDataFrame(rows, SCHEMA)
    for most, docs, copies in ((64, data, 1), (5, data.unionByName(data).unionByName(data), 3), (0, data, 1)):
        sizes.clear()
        monkeypatch.setattr(suffix_dedup, "CLASS", most, raising=False)
        got = sorted((r.doc_id, r.n_removed, bytes(r.kept)) for r in suffix_dedup.suffix_dedup(docs, length, window).collect())
        assert got == sorted(want * copies)
        assert max(sizes) <= suffixes * copies or most < 64


LINE_ROWS = [*ROWS, (30, f"{PASSAGE}\nown words of thirty", "en", "a", 1), (31, f"before\n \n{PASSAGE}\nafter", "en", "a", 1), (32, PASSAGE, "en", "a", 1),
             (33, "one two three four\nfive six seven eight nine ten", "en", "a", 1), (34, "x\none two three four\n\nfive six seven eight nine ten\ny", "en", "a", 1),
             (35, "short line\nother", "en", "a", 1), (36, "short line\nanother", "en", "a", 1)]


def test_line_dedup_matches_brute_force(spark):
    """All rows, also null doc_ids, repeated rows and several texts of one doc_id."""
    sign = lambda v: v - 2 ** 64 if v >= 2 ** 63 else v
    order = sorted({(i is not None, i or 0, sign(xxhash.xxh64_intdigest((t or "").encode(), 42)), t or "") for i, t, *_ in LINE_ROWS})
    first, gone = {}, {}
    for has, i, _, t in order:
        lines = [x for x in t.split("\n") if words_of(x)]
        for size in (1, 2, 3):
            for s in range(len(lines) - size + 1):
                key = tuple(lines[s:s + size])
                if size < 3 and sum(len(words_of(x)) for x in key) < 10:
                    continue
                if first.setdefault(key, (has, i, t, s)) != (has, i, t, s):
                    gone.setdefault((has, i, t), set()).update(range(s, s + size))
    want = []
    for i, t, *_ in LINE_ROWS:
        t = t or ""
        out = gone.get((i is not None, i or 0, t), set())
        kept, k = [], 0
        for x in t.split("\n"):
            if words_of(x):
                k += 1
                if k - 1 in out:
                    continue
            kept.append(x)
        want.append((i, k, len(out), sum(r - 1 not in out for r in out), "\n".join(kept)))
    df = spark.createDataFrame(LINE_ROWS, SCHEMA).repartition(3)
    got = sorted(map(tuple, line_dedup.line_dedup(clashing(df)).collect()), key=repr)
    assert got == sorted(want, key=repr)
    kept = {r[0]: r[4] for r in got}
    assert kept[32] == "" and kept[31] == "before\n \nafter" and kept[34] == "x\n\ny" and kept[36] == "short line\nanother"


def test_line_dedup_of_a_very_long_text(spark):
    lines = "\n".join(f"line number {i} of a long text" for i in range(100_000))
    got = line_dedup.line_dedup(spark.createDataFrame([(1, lines, "en", "a", 1), (2, lines, "en", "a", 1)], SCHEMA)).orderBy("doc_id").collect()
    assert [(r.n_lines, r.n_removed, r.n_runs) for r in got] == [(100_000, 0, 0), (100_000, 100_000, 1)]
    assert got[0].kept_text == lines and got[1].kept_text == ""


def test_mixing_flags_match_plain_counts(spark):
    """The flags from few passes over a text equal counts by regular expressions, and known words are one hash set in the plan."""
    texts = ["", None, " ", "a a", "a a a a b", "  x  x", "q\nq q q", "A B C", "ABC d", "#*$%&|<>! A", "!!! !!", "12 12 12", "\u00c9 \u00e9 \u01c5", "\U0001d400 b",
             "\u0130I \u0130I", "A\x1cA A", "word " * 60, "-a-", "foo  foo\x0bfoo\x0cfoo"]
    got = mixing._featured(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")).orderBy("doc_id").collect()
    t = F.col("t")
    flat = F.trim(F.regexp_replace(F.lower(t), r"[^\p{L}]+", " "))
    n = F.regexp_count(t, F.lit(r"[^\x20\x09-\x0D]+"))
    plain = [n < 50, 50 * F.regexp_count(t, F.lit("[#*$%&|<>]")) > F.length(t), F.length(t) > 8 * n,
             10 * F.regexp_count(t, F.lit(r"(?<!\S)(\S++)\s++\1(?!\S)")) > n, 3 * F.regexp_count(t, F.lit(r"\p{Lu}")) > F.length(flat),
             40 * F.regexp_count(t, F.lit("!")) > F.length(t)]
    want = spark.createDataFrame([(i, x or "") for i, x in enumerate(texts)], "doc_id int, t string").select("doc_id", flat.alias("flat"), n.alias("n"), *[
        c.alias(f"x{i}") for i, c in enumerate(plain)]).orderBy("doc_id").collect()
    for g, w in zip(got, want, strict=True):
        assert (g.n_tokens, " ".join(x for x in g.words if x), *[g[f"x{i}"] for i in range(6)]) == (w.n, w.flat, *[w[f"x{i}"] for i in range(6)])
    words = [f"w{'abcdefghijklmnop'[i]}" for i in range(16)]
    scored = mixing.Evidence(words, [[1.0] * 16, [-1.0] * 16]).attach(mixing._featured(spark.createDataFrame([("WA wb wb zz",)], "text string")), [])
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "INSET" in plan and "array_intersect" not in plan
    assert scored.first().x6 and not scored.first().x7


def test_mixing_meets_targets(spark):
    rng = np.random.default_rng(1)
    good, bad = WORDS[:9], WORDS[9:]
    rows = [(i, " ".join((good if i % 3 else bad)[k] for k in rng.integers(0, 9, 60)), "en", "s", 1) for i in range(300)]
    rows += [(300, None, None, None, None), (301, "", "en", "s", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(0, 300, 2)], "doc_id long, quality int, toxic int")
    got = mixing.mixing_rates(clashing(docs), labels, {"q1t0": 0.9, "q0t0": 0.1}).toPandas()
    assert len(got) == 302 and (got.rate >= 0).all()
    known = got[got.doc_id < 300]
    assert ((known.domain == "q1t0") == (known.doc_id % 3 > 0)).mean() > 0.98
    w = known.n_tokens * known.rate
    assert abs(w[known.domain == "q1t0"].sum() / w.sum() - 0.9) < 0.02
    assert mixing.mix(docs, labels).columns == docs.columns
    none = mixing.mixing_rates(docs, labels.limit(0))
    assert [r.rate for r in none.distinct().select("rate").distinct().collect()] == [1.0]


def test_mixing_tells_clean_and_toxic_in_every_language(spark):
    """Recall on labelled documents of sf0.1 whose texts the fit did not see, a quarter by hash."""
    folder = "/root/testdata/sf0.1"
    if not os.path.exists(folder):
        pytest.skip("no test data")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    one = docs.groupBy("text").agg(F.min("doc_id").alias("doc_id"), F.min_by("lang", "doc_id").alias("lang"))
    domains = mixing.label_domains(spark.read.parquet(f"{folder}/labels.parquet"))
    known = one.withColumn("held", F.pmod(F.xxhash64("text", F.lit("held out")), F.lit(4)) == 0).join(domains, "doc_id")
    model = mixing.fit_posterior(docs, known.filter("NOT held").select("doc_id", "domain"))
    got = model.attach(known.filter("held").select("doc_id", "text", "lang", "domain")).toPandas()
    got["hit"] = [model.domains[int(np.argmax(p))] == d for p, d in zip(got.p, got.domain, strict=True)]
    clean, toxic = got[got.domain == "q1t0"], got[got.domain == "q1t1"]
    assert set(clean.lang) == {"en", "fr", "de", "es"} and (clean.groupby("lang").hit.mean() > 0.95).all()
    assert toxic[toxic.lang == "en"].hit.mean() > 0.9 and toxic[toxic.lang != "en"].hit.mean() > 0.8


def test_rates_meet_small_targets_or_tell(spark):
    rng = np.random.default_rng(5)
    names, kinds = ["a", "b", "c"], np.array([[0.97, 0.02, 0.01], [0.05, 0.9, 0.05], [0.02, 0.03, 0.95], [0.5, 0.3, 0.2]])
    rows = [(int(rng.integers(1, 400)), kinds[k].tolist()) for k in rng.choice(4, 500, p=[0.5, 0.3, 0.1, 0.1])]
    scored = spark.createDataFrame(rows, "n_tokens long, p array<double>")
    targets = {"a": 0.96, "b": 0.024, "c": 0.016}
    pulls, missed = mixing.fit_rates(scored, names, targets)
    assert not missed
    rates = scored.select("n_tokens", "p", mixing._rate(F.col("p"), pulls).alias("r")).toPandas()
    mass = (np.stack(rates.p) * (rates.n_tokens * rates.r).to_numpy()[:, None]).sum(axis=0)
    assert all(abs(m / rates.n_tokens.sum() - t) <= 0.01 * t for m, t in zip(mass, targets.values(), strict=True))
    _, missed = mixing.fit_rates(scored, names, {"a": 0.9999, "b": 0.00005, "c": 0.00005})
    assert {"b", "c"} <= set(missed) and all(now > goal for d, (now, goal) in missed.items() if d != "a")


def test_packing_fits_and_keeps_every_token(spark):
    sizes = [(i, int(x)) for i, x in enumerate(np.random.default_rng(2).integers(0, 3000, 400))] + [(7, 20_000), (8, None)] + [(5, 100)] * 50
    items = spark.createDataFrame(sizes, "doc_id long, n_tokens int")
    extra = items.select("*", F.lit(1).alias("n"), F.lit(2).alias("copy"), F.lit(3).alias("Bin_ID"))
    got = packing.pack(extra, shard_items=100).toPandas()
    full = got.dropna(subset=["bin_id"])
    assert got.n_tokens.sum() == sum(n or 0 for _, n in sizes)
    for _, b in full.groupby("bin_id"):
        b = b.sort_values("offset")
        assert b.offset.tolist() == (b.n_tokens.cumsum() - b.n_tokens).tolist()
        assert b.n_tokens.sum() <= b.bin_length.iloc[0] == min(c for c in packing.LENGTHS if c >= b.n_tokens.sum())
    assert full.n_tokens.sum() / full.drop_duplicates("bin_id").bin_length.sum() > 0.8


def test_language_identification(spark):
    rng = np.random.default_rng(3)
    kinds = {"en": "the and that with from".split(), "fr": "être où déjà mais nous".split(), "de": "über und nicht für straße".split()}
    rows = [(i, " ".join(kinds[k][x] for x in rng.integers(0, 5, 60)), k, "s", 1) for i, k in enumerate(list(kinds) * 60)]
    rows += [(900, None, "en", "s", 1), (901, "12 !", None, "s", 1), (None, "the and that", None, "s", 1)]
    got = langid.identify_language(clashing(spark.createDataFrame(rows, SCHEMA))).toPandas().set_index("doc_id")
    assert (got.loc[[900, 901]].lang_pred == "und").all() and len(got) == len(rows)
    held = [r for r in rows if r[0] is not None and r[0] < 900 and zlib.crc32(str(r[0]).encode()) % 4 == 2]
    assert all(got.loc[r[0]].held_out for r in held)
    assert np.mean([got.loc[r[0]].lang_pred == r[2] for r in held]) > 0.95
    assert got.score.between(0, 1).all()


def test_empty_tables(empty, spark, tmp_path):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for df in (exact_dedup.exact_dedup(empty), quality_rules.quality_rules(empty), simhash.simhash_groups(empty),
               token_counts.token_counts(empty), token_files.token_files(empty, folder=str(tmp_path / "none")),
               suffix_dedup.suffix_dedup(empty), line_dedup.line_dedup(empty), mixing.mixing_rates(empty, labels),
               packing.pack_documents(empty), langid.identify_language(empty), quality_rules.keep_passing(empty),
               exact_dedup.keep_first(empty), simhash.keep_one_per_group(empty), mixing.mix(empty, labels)):
        assert df.count() == 0 and isinstance(df.schema, T.StructType)


def test_pipeline_stages(docs, spark, tmp_path):
    import corpus_pipeline
    folder = str(tmp_path / "sf")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (6, 1, 0), (10, 0, 0), (11, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(
        f"{folder}/labels.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "mixing", "packing"]
    rows = corpus_pipeline.run(spark, folder).collect()
    assert rows and {r.doc_id for r in rows} <= {r[0] for r in ROWS}
