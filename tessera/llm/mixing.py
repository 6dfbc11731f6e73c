"""Mixing documents to target domain weights (DataFrame functions only).

A classifier learned from the labelled table gives every document posteriors over domains;
it goes by surface flags and by words present, so a language without them is not held against a
text.  Nonnegative document rates are then fitted by distributed projected-gradient least squares
so that the expected tokens of each domain meet their targets."""

from __future__ import annotations

import math
import warnings
from functools import reduce

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import DOC_COLUMNS, HAS_WORD, filter_above, pick, present

#: The classifier is fitted on at most this many labelled documents (those with the smallest hash of doc_id).
MAX_LABELLED = 4000
#: Words whose presence counts as evidence, at most, and the least information (nats) of one.
VOCABULARY = 1024
MIN_GAIN = 9.0
#: Hash buckets that words are looked up in.
BUCKETS = 128
#: A domain's evidence counts as such when it leads every other domain's by this many nats.
LEVELS = (2.0, 6.0)
#: The evidence is calibrated on documents that did not choose its words, by as many parts.
FOLDS = 4
#: Added to counts of words, seen and expected.
PRIOR = 0.5
MAX_DOMAINS = 64
#: Steps before the fit gives up with an error, and the slope (in shares of all tokens) that counts as none.
MAX_STEPS = 500_000
STILL = 1e-9
#: Distinct posteriors the driver takes; the model has at most 2^N_FLAGS (1 + domains x LEVELS) = 8256.
MAX_KINDS = 10_000
#: Largest miss of a domain, as a share of its target; of a domain without target, as a share of all tokens.
TOLERANCE = 1e-2
UNWANTED = 2e-3
#: Share of tokens per (quality, toxic) domain of the labels table.
REACHED = "array<struct<domain:string,share:double,target:double>>"
TARGETS = {"q1t0": 0.85, "q0t0": 0.12, "q1t1": 0.02, "q0t1": 0.01}


def label_domains(labels: DataFrame) -> DataFrame:
    """doc_id, domain ("q1t0" for quality 1, toxic 0) for labels with no null; one row per doc_id (smallest domain)."""
    rows = pick(labels, "doc_id", "quality", "toxic").dropna()
    return (rows.select("doc_id", F.concat(F.lit("q"), F.col("quality").cast("string"), F.lit("t"),
                                           F.col("toxic").cast("string")).alias("domain"))
            .groupBy("doc_id").agg(F.min("domain").alias("domain")))


def _featured(rows: DataFrame) -> DataFrame:
    """Add n_tokens (words), words (lower-case letter runs) and boolean surface flags x0, x1, ...
    that need no language to a frame with ``text``."""
    t = F.col("t")
    out = rows.withColumn("t", present("text"))
    # one pass leaves the few characters that are counted one by one; the other passes each read the text once
    few = F.regexp_replace(t, r"[^\p{Lu}!#*$%&|<>]+", "")
    out = (out.withColumn("words", F.split(F.lower(t), r"[^\p{L}]+"))
           .withColumn("n_tokens", F.regexp_count("t", F.lit(HAS_WORD + "+")).cast("long"))
           .withColumn("few", few)
           .withColumn("twice", F.regexp_count(F.concat(F.lit(" "), t), F.lit(r"\s(\S++)\s++\1(?!\S)"))))
    unmarked = F.translate("few", "#*$%&|<>", "")
    out = (out.withColumn("marks", F.length("few") - F.length(unmarked))
           .withColumn("capitals", F.length(F.translate(unmarked, "!", "")))
           .withColumn("shouts", F.length("few") - F.length(F.translate("few", "!", ""))))
    # the words joined by single spaces are seldom so short that the capitals can be a third of them
    least = 2 * F.size("words") - 5
    loud = 3 * F.col("capitals") > F.length(F.trim(F.array_join("words", " ")))
    flags = [F.col("n_tokens") < 50, 50 * F.col("marks") > F.length("t"), F.length("t") > 8 * F.col("n_tokens"),
             10 * F.col("twice") > F.col("n_tokens"), F.when(3 * F.col("capitals") <= least, False).otherwise(loud),
             40 * F.col("shouts") > F.length("t")]
    return out.select("*", *[c.alias(f"x{i}") for i, c in enumerate(flags)])


N_FLAGS = 6


class Evidence:
    """Words and, for every domain, the log ratio of each word's documents to those expected."""

    def __init__(self, words: list[str], ratios: list[list[float]]):
        self.words, self.ratios = words, ratios

    def attach(self, featured: DataFrame, keep: list[str]) -> DataFrame:
        """``keep`` and the features x0, x1, ... (flags, then every domain's lead over LEVELS) of featured rows.

        Only the words present are summed, so a language or a length without any is no evidence."""
        d = range(len(self.ratios))
        flags = [f"x{i}" for i in range(N_FLAGS)]
        if self.words:
            # words are letters only; a list of literals becomes one hash set, an array would be hashed for every text
            known = ", ".join(f"'{w}'" for w in self.words)
            rows = featured.withColumn("met", F.array_distinct(F.expr(f"filter(words, w -> w IN ({known}))")))
            # a word's place: its bucket by hash, then its position among the few words there
            buckets: list[list[tuple[str, int]]] = [[] for _ in range(BUCKETS)]
            for i, w in enumerate(self.words):
                buckets[xxhash.xxh64_intdigest(w.encode(), 42) % BUCKETS].append((w, i))
            room = max(map(len, buckets))
            held = F.array(*[F.split(F.lit(" ".join(w for w, _ in b)), " ") for b in buckets])

            def place(w: Column) -> Column:
                h = F.pmod(F.xxhash64(w), F.lit(BUCKETS)).cast("int")
                return h * room + F.array_position(held[h], w).cast("int") - 1

            rows = rows.select(*keep, *flags, F.transform("met", place).alias("at"))

            def total(ratio: list[float]) -> Column:
                padded = [repr(ratio[b[k][1]]) if k < len(b) else "0.0" for b in buckets for k in range(room)]
                weight = F.split(F.lit(" ".join(padded)), " ").cast("array<double>")
                return F.aggregate("at", F.lit(0.0), lambda a, i: a + F.get(weight, i))

            rows = rows.select(*keep, *flags, *[total(r).alias(f"e{i}") for i, r in enumerate(self.ratios)])
        else:
            rows = featured.select(*keep, *flags, *[F.lit(0.0).alias(f"e{i}") for i in d])
        leads = []
        for i in d:
            others = [F.col(f"e{j}") for j in d if j != i]
            top = F.greatest(*others) if len(others) > 1 else others[0] if others else F.lit(0.0)
            leads += [F.col(f"e{i}") - top > level for level in LEVELS]
        return rows.select(*keep, *flags, *[c.alias(f"x{N_FLAGS + i}") for i, c in enumerate(leads)])


class Posterior:
    """A fitted naive Bayes model over flags and evidence: domains and log-odds as plain numbers."""

    def __init__(self, domains: list[str], evidence: Evidence, base: list[float], weight: list[list[float]]):
        self.domains, self.evidence, self.base, self.weight = domains, evidence, base, weight

    def attach(self, rows: DataFrame) -> DataFrame:
        """Add n_tokens and p (array of posteriors in the order of ``domains``) to rows with ``text``."""
        keep = rows.columns
        scored = self.evidence.attach(_featured(rows), [*keep, "n_tokens"])
        scores = [F.lit(b) + sum((F.when(F.col(f"x{i}"), F.lit(w)).otherwise(F.lit(0.0))
                                  for i, w in enumerate(ws)), F.lit(0.0))
                  for b, ws in zip(self.base, self.weight, strict=True)]
        scored = scored.select(*keep, "n_tokens", *[s.alias(f"s{d}") for d, s in enumerate(scores)])
        top = F.greatest(*[F.col(f"s{d}") for d in range(len(scores))]) if len(scores) > 1 else F.col("s0")
        scored = scored.withColumn("top", top)
        scored = scored.select(*keep, "n_tokens", *[F.exp(F.col(f"s{d}") - F.col("top")).alias(f"e{d}")
                                                    for d in range(len(scores))])
        total = sum((F.col(f"e{d}") for d in range(len(scores))), F.lit(0.0))
        return scored.select(*keep, "n_tokens", F.array(*[F.col(f"e{d}") / total for d in range(len(scores))]).alias("p"))


def choose_words(rows: DataFrame, names: list[str], vocabulary: int = VOCABULARY) -> Evidence:
    """The words that say most about the domain of documents of one language and size.

    ``rows``: domain, stratum (language and size), words.  A word's documents in a domain are compared
    with those expected if, within every stratum, its presence told nothing; so a word that only
    marks a language or long texts has ratio 1.  Only the chosen words' counts reach the driver."""
    size = range(len(names))
    strata = rows.groupBy("stratum").agg(*[F.avg((F.col("domain") == d).cast("double")).alias(f"e{i}")
                                           for i, d in enumerate(names)])
    words = (rows.join(F.broadcast(strata), "stratum")
             .select("domain", *[f"e{i}" for i in size], F.explode("words").alias("w")).filter("w <> ''")
             .groupBy("w").agg(*[F.sum((F.col("domain") == d).cast("double")).alias(f"n{i}") for i, d in enumerate(names)],
                               *[F.round(F.sum(f"e{i}"), 9).alias(f"e{i}") for i in size]))
    gain = sum((F.when(F.col(f"n{i}") > 0, F.col(f"n{i}") * F.log(F.col(f"n{i}") / F.col(f"e{i}"))).otherwise(F.lit(0.0))
                for i in size), F.lit(0.0))
    best = (words.withColumn("gain", F.round(gain, 6)).filter(F.col("gain") >= MIN_GAIN)
            .orderBy(F.desc("gain"), "w").limit(vocabulary).collect())
    return Evidence([r.w for r in best], [[math.log((r[f"n{i}"] + PRIOR) / (r[f"e{i}"] + PRIOR)) for r in best] for i in size])


def fit_posterior(docs: DataFrame, domains: DataFrame, max_labelled: int = MAX_LABELLED,
                  vocabulary: int = VOCABULARY) -> Posterior | None:
    """Learn the model from the labelled documents (None if there are none).

    The labelled sample is bounded by ``max_labelled`` rows of ``domains`` and so is safe to
    broadcast.  How often the evidence leads in each domain is counted on parts of the sample that
    did not choose the words (equal texts are in one part); the words used are those of the whole sample.
    ``lang``, if ``docs`` has it, only groups the sample; it is not read when documents are scored."""
    chosen = domains.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    lang = [] if "lang" in docs.columns else [F.lit(None).cast("string").alias("lang")]
    plain = pick(docs, "doc_id", "text", *([] if lang else ["lang"])).select("*", *lang)
    size = F.floor(F.log2(F.greatest(F.col("n_tokens"), F.lit(1)))).cast("string")
    flags = [f"x{i}" for i in range(N_FLAGS)]
    sample = cut_lineage(
        _featured(plain.join(F.broadcast(chosen), "doc_id"))
        .select("domain", *flags, F.array_distinct("words").alias("words"),
                F.pmod(F.xxhash64("t"), F.lit(FOLDS)).alias("fold"),
                F.concat(size, F.lit(" "), present("lang")).alias("stratum")))
    sizes = {r.domain: r.n for r in sample.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).limit(MAX_DOMAINS + 1)
             .collect()}
    if not sizes:
        return None
    if len(sizes) > MAX_DOMAINS:
        raise ValueError(f"more than {MAX_DOMAINS} domains")
    names = sorted(sizes)
    n = sum(sizes.values())
    parts = [choose_words(sample.filter(F.col("fold") != f), names, vocabulary)
             .attach(sample.filter(F.col("fold") == f), ["domain"]) for f in range(FOLDS)]
    width = N_FLAGS + len(names) * len(LEVELS)
    counts = (reduce(DataFrame.unionByName, parts).groupBy("domain")
              .agg(*[F.sum(F.col(f"x{i}").cast("double")).alias(f"f{i}") for i in range(width)]).collect())
    count = {r.domain: [r[f"f{i}"] for i in range(width)] for r in counts}
    base, weight = [], []
    for d in names:
        yes = [(c + 1) / (sizes[d] + 2) for c in count[d]]
        base.append(math.log(sizes[d] / n) + sum(math.log(1 - q) for q in yes))
        weight.append([math.log(q / (1 - q)) for q in yes])
    return Posterior(names, choose_words(sample, names, vocabulary), base, weight)


def reach_targets(scored: DataFrame, domains: list[str], targets: dict[str, float], max_steps: int = MAX_STEPS,
                  tolerance: float = TOLERANCE) -> tuple[list[tuple[list[float], float]], dict[str, tuple[float, float]]]:
    """(posteriors, rate) of every distinct posterior, and {domain: (share reached, target)} of all domains.

    Minimises the squared miss of the domain equations sum_i tok_i p_id r_i = T_d over r >= 0, T_d the domain's
    share of all tokens, by projected gradient from r = 1.  Preconditioned by 1/tok_i, a document's step depends on
    its posteriors only, so documents of equal posteriors move alike: one aggregate over all documents
    sums the tokens of each distinct posterior (at most MAX_KINDS), and the steps run on these sums, with
    momentum that starts anew where it would climb.  Ends when every domain is within a tenth of
    ``tolerance`` of its target (one without target: of UNWANTED of all tokens), or where no step lessens
    the miss: then the targets are out of reach of the posteriors and the rates are the least-squares ones.  Raises if
    neither is reached in ``max_steps``."""
    rows = scored.groupBy("p").agg(F.sum("n_tokens").alias("n")).limit(MAX_KINDS + 1).collect()
    if len(rows) > MAX_KINDS:
        raise ValueError(f"more than {MAX_KINDS} distinct posteriors")
    rows.sort(key=lambda r: r.p)
    p = np.array([r.p for r in rows]).reshape(-1, len(domains))
    tok = np.array([r.n or 0 for r in rows], float)
    now = tok @ p
    total = now.sum()
    share = np.array([max(0.0, targets.get(d, 0.0)) if now[i] > 0 else 0.0 for i, d in enumerate(domains)])
    rate = np.ones(len(p))
    if total <= 0 or share.sum() <= 0:
        return [(r.p, 1.0) for r in rows], {}
    tok, goal = tok / total, share / share.sum()
    near = 0.1 * np.where(goal > 0, tolerance * goal, UNWANTED)
    step = 1.0 / np.linalg.eigvalsh(p.T @ (p * tok[:, None]))[-1]
    ahead, speed = rate, 1.0
    for _ in range(max_steps):
        off = (tok * rate) @ p - goal
        slope = p @ off
        # no rate can move against the slope: zero slope, or a rate at its bound that would go below
        still = np.abs(np.where((rate > 0) | (slope < 0), slope, 0.0)).max() <= STILL
        if (np.abs(off) <= near).all() or still:
            now = (tok * rate) @ p
            return ([(r.p, float(x)) for r, x in zip(rows, rate, strict=True)],
                    {d: (float(now[i]), float(goal[i])) for i, d in enumerate(domains)})
        pull = p @ ((tok * ahead) @ p - goal)
        new = np.maximum(0.0, ahead - step * pull)
        if (tok * pull) @ (new - rate) > 0:  # the momentum climbs
            speed, ahead, new = 1.0, rate, np.maximum(0.0, rate - step * slope)
        faster = (1 + math.sqrt(1 + 4 * speed * speed)) / 2
        ahead = np.maximum(0.0, new + (speed - 1) / faster * (new - rate))
        rate, speed = new, faster
    raise RuntimeError(f"rates still change after {max_steps} steps")


def _missed(reached: dict[str, tuple[float, float]]) -> dict[str, tuple[float, float]]:
    return {d: (now, goal) for d, (now, goal) in reached.items() if abs(now - goal) > (TOLERANCE * goal if goal > 0 else UNWANTED)}


def fit_rates(scored: DataFrame, domains: list[str], targets: dict[str, float]) -> tuple[list[tuple[list[float], float]], dict[str, tuple[float, float]]]:
    """``reach_targets`` with only the domains whose target is missed: {domain: (share reached, target)}."""
    kinds, reached = reach_targets(scored, domains, targets)
    return kinds, _missed(reached)


def _rate(p: Column, kinds: list[tuple[list[float], float]]) -> Column:
    """The fitted rate of a posterior; for few kinds, as the expression holds them all."""
    known = F.array(*[F.array(*[F.lit(float(x)) for x in k]) for k, _ in kinds])
    return F.element_at(F.map_from_arrays(known, F.array(*[F.lit(float(r)) for _, r in kinds])), p)


def document_rates(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None,
                   texts: bool = True) -> DataFrame:
    """``docs`` (distinct column names; doc_id, text, and lang if there) with n_tokens, p, rate and copies.

    copies = floor(rate), plus one with the fraction as probability (a hash of doc_id and text
    decides, so a rerun decides alike).  Targets that cannot be met are named in a
    warning.  Without ``texts`` the scores are written once, else read twice from the texts.
    Without labelled documents every rate is 1.  ``reached`` lists the share of every domain and its target.  A null
    text has no tokens; its rate follows from its posteriors like any other.  Rows repeated
    in doc_id and text get the same copies."""
    model = fit_posterior(docs, label_domains(labels))
    if model is None:
        plain = docs.withColumn("n_tokens", F.regexp_count(present("text"), F.lit(HAS_WORD + "+")).cast("long"))
        return plain.withColumn("p", F.array().cast("array<double>")).withColumn("rate", F.lit(1.0)) \
            .withColumn("copies", F.lit(1)).withColumn("domain", F.lit(None).cast("string")).withColumn("reached", F.lit(None).cast(REACHED))
    u = F.pmod(F.xxhash64("doc_id", "text", F.lit("mixing")), F.lit(1 << 40)) / F.lit(float(1 << 40))
    rated = model.attach(docs.withColumn("u", u))
    if not texts:
        rated = cut_lineage(rated.drop("text"))
    kinds, reached = reach_targets(rated.select("n_tokens", "p"), model.domains, targets or TARGETS)
    missed = _missed(reached)
    if missed:
        warnings.warn("domain targets missed: " + ", ".join(f"{d} {now:.4g} of {goal:.4g}" for d, (now, goal)
                                                            in missed.items()), stacklevel=2)
    # a rate per distinct posterior: at most MAX_KINDS rows
    rates = rated.sparkSession.createDataFrame(kinds, "p array<double>, rate double")
    rated = rated.join(F.broadcast(rates), "p", "left").withColumn("rate", F.round("rate", 9))
    reach = F.array(*[F.struct(F.lit(d).alias("domain"), F.lit(now).alias("share"), F.lit(goal).alias("target"))
                      for d, (now, goal) in sorted(reached.items())]) if reached else F.lit(None).cast(REACHED)
    rated = rated.withColumn("reached", reach)
    whole = F.floor("rate")
    names = F.array(*[F.lit(d) for d in model.domains])
    return (rated.withColumn("copies", (whole + (F.col("u") < F.col("rate") - whole).cast("int")).cast("int")).drop("u")
            .withColumn("domain", F.get(names, F.array_position("p", F.array_max("p")).cast("int") - 1)))


def mixing_rates(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
    """doc_id, n_tokens, domain (most likely), score (its posterior), rate, copies, target, reached for every document.

    ``target`` is the share of all tokens that the document's domain should have, ``reached`` the expected share at
    these rates; they differ where the targets are out of reach of the posteriors (null without labels)."""
    rated = document_rates(pick(docs, "doc_id", "text", *[c for c in docs.columns if c == "lang"][:1]), labels, targets, texts=False)
    own = F.get(F.filter("reached", lambda r: r["domain"] == F.col("domain")), F.lit(0))
    return rated.select("doc_id", "n_tokens", "domain", F.array_max("p").alias("score"), "rate", "copies",
                        own["target"].alias("target"), own["share"].alias("reached"))


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
    """A documents table resampled to the targets: each row ``copies`` times, with the columns of documents."""
    rated = filter_above(document_rates(pick(docs, *DOC_COLUMNS), labels, targets), F.col("copies") > 0)
    return rated.select(*DOC_COLUMNS, F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).drop("copy")
