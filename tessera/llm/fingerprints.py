"""Document fingerprints: a homomorphic multiset hash over paragraphs (DataFrame functions only).

Every paragraph (a \\n-separated piece of a text) is hashed to a wide vector, and a text's fingerprint is
the sum of its paragraphs' vectors, lane by lane, modulo powers of two.  So the order of paragraphs
does not matter, and paragraphs are inserted or deleted by adding or subtracting their vectors.

A paragraph's vector has two parts:
* 8 lanes modulo 2^32, the halves of four seeded XXH64 of the whole paragraph: equality;
* 120 lanes modulo 2^16, each +1 or -1 by a hash bit of every word of the paragraph taken with the
  word before it: the squared lanes of a difference of two fingerprints estimate how many such word
  pairs the texts do not share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordering import BLOCK, deal, join_keys
from .common import WS_CONTROLS, pick, present

SEEDS = 4
P_MASK = (1 << 32) - 1
W_MASK = (1 << 16) - 1
#: A word pair's hash gives SHIFTS pairs of bits, bit 2 + j and bit 32 + j; a second hash of it as many.
SHIFTS = 30
LANES = 4 * SHIFTS
#: Documents of a block whose neighbours are found in one window.
DOCS_PER_BLOCK = 64


def _bind(value: Column, body) -> Column:
    """``body(value)``, with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def paragraph_lanes(parts: Column) -> Column:
    """8 sums modulo 2^32 over an array of paragraphs: both halves of four seeded hashes."""
    def seeded(s: Column) -> Column:
        return _bind(F.transform(parts, lambda t: F.xxhash64(s, t)), lambda hs: F.array(
            F.aggregate(hs, F.lit(0).cast("long"), lambda a, h: (a + h.bitwiseAND(F.lit(P_MASK))).bitwiseAND(F.lit(P_MASK))),
            F.aggregate(hs, F.lit(0).cast("long"), lambda a, h: (a + F.shiftrightunsigned(h, 32)).bitwiseAND(F.lit(P_MASK)))))
    return F.flatten(F.transform(F.sequence(F.lit(1), F.lit(SEEDS)), seeded))


def pair_hashes(parts: Column, tag: int) -> Column:
    """Hashes of every word with the word before it in its paragraph (the first: with null); ``tag`` in the low two bits."""
    def of_words(ws: Column) -> Column:
        return F.transform(ws, lambda x, i: F.xxhash64(F.get(ws, i - 1), x).bitwiseAND(F.lit(-4)).bitwiseOR(F.lit(tag)))

    def of_part(t: Column) -> Column:
        flat = F.translate(t, WS_CONTROLS, " " * len(WS_CONTROLS))
        return _bind(F.filter(F.split(flat, " "), lambda x: x != F.lit("")), of_words)

    return F.flatten(F.transform(parts, of_part))


def bit_sums(rows: DataFrame, keys: list[str], hashes: str) -> DataFrame:
    """Per ``keys`` and tag (``kind``): the number of hashes (``n``) and, in b0, b1, ..., how many of them have each
    lane's bit, two lanes to a long.  Rows without hashes keep a row of their own."""
    flat = rows.select(*keys, F.explode_outer(hashes).alias("x"))
    flat = flat.withColumns({"kind": F.col("x").bitwiseAND(F.lit(3)), "y": F.xxhash64(F.col("x").bitwiseAND(F.lit(-4)))})
    pair = F.lit(1 | 1 << 30)
    sums = [F.sum(F.shiftright(c, 2 + j).bitwiseAND(pair)) for c in ("x", "y") for j in range(SHIFTS)]
    return flat.groupBy(*keys, "kind").agg(F.count("x").alias("n"), *[e.alias(f"b{i}") for i, e in enumerate(sums)])


def signed_lanes(n: Column, sums: list[Column]) -> Column:
    """Lanes modulo 2^16 from bit counts: ones less zeros, 2 * count - n."""
    low = [F.coalesce(c, F.lit(0)).bitwiseAND(F.lit((1 << 30) - 1)) for c in sums]
    high = [F.shiftright(F.coalesce(c, F.lit(0)), 30) for c in sums]
    return F.array(*[(2 * c - n).bitwiseAND(F.lit(W_MASK)) for c in low + high])


def add_lanes(a: Column, b: Column, mask: int) -> Column:
    """Lanes of the paragraphs of both: insertion."""
    return F.zip_with(a, b, lambda x, y: (x + y).bitwiseAND(F.lit(mask)))


def subtract_lanes(a: Column, b: Column, mask: int) -> Column:
    """Lanes of ``a`` without the paragraphs of ``b``: deletion."""
    return F.zip_with(a, b, lambda x, y: (x - y).bitwiseAND(F.lit(mask)))


def digits(p: Column, w: Column) -> Column:
    """A fingerprint as hexadecimal text: 8 digits a paragraph lane, 4 a word lane."""
    def part(v: Column, size: int) -> Column:
        return F.transform(v, lambda x: F.lpad(F.lower(F.hex(x)), size, "0"))
    return F.array_join(F.concat(part(p, 8), part(w, 4)), "")


def squares(w: Column) -> Column:
    """Sum of the squared signed lanes."""
    signed = lambda x: (x + F.lit(1 << 15)).bitwiseAND(F.lit(W_MASK)) - F.lit(1 << 15)
    return F.aggregate(w, F.lit(0).cast("long"), lambda a, x: a + signed(x) * signed(x))


def likeness(same: Column, apart: Column, both: Column) -> Column:
    """1 - |A - B|^2 / (|A|^2 + |B|^2) over the word lanes, within 0 to 1; equal fingerprints: exactly 1.

    For texts that share the part s of their word pairs it estimates s, to some 0.1 where s is 0
    and closer the larger s is.  Two different fingerprints without words: 0."""
    near = F.when(both == 0, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.lit(1.0) - apart / both))
    return F.when(same, F.lit(1.0)).otherwise(near)


def with_next(docs: DataFrame, per_block: int = DOCS_PER_BLOCK) -> DataFrame:
    """Rows (doc_id, n_chars, h, text, _block, head) dealt into blocks of consecutive documents, each block
    followed by a copy (head = 1) of the row that comes after it; the last block's is the first row of all.

    Order: doc_id (null first), then n_chars and the text's hash.  Blocks are cut at sampled boundaries; which
    row heads a block is found from narrow columns, and only those rows' texts are read again, one a block."""
    rows = pick(docs, "doc_id", "text").select("doc_id", present("text").alias("text"))
    rows = rows.withColumns({"n_chars": F.length("text").cast("long"), "h": F.xxhash64("text")})
    order = ["doc_id", "n_chars", "h"]
    d = deal(rows, [], order, per_block)
    heads = sorted(d.frame.groupBy(BLOCK).agg(F.min(F.struct(*order)).alias("s")).collect(), key=lambda r: r[BLOCK])
    own = d.frame.withColumn("head", F.lit(0))
    if not heads:
        return own
    goes = [(*r["s"], heads[i - 1][BLOCK]) for i, r in enumerate(heads)]  # to the block before; the first to the last
    kinds = [rows.schema[c].dataType.simpleString() for c in order]
    schema = ", ".join(f"k{i} {kind}" for i, kind in enumerate(kinds)) + ", goes int"
    where = F.broadcast(rows.sparkSession.createDataFrame(goes, schema))  # a row a block: bounded
    copies = (join_keys(rows, where, [(c, f"k{i}") for i, c in enumerate(order)])
              .dropDuplicates(["goes"])  # of repeated rows one
              .withColumn(BLOCK, F.col("goes")).withColumn("head", F.lit(1)))
    return own.unionByName(copies.drop("goes"))


def document_fingerprints(docs: DataFrame, per_block: int = DOCS_PER_BLOCK) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last floor(n_chars / 4) code points replaced by the first as many (or all) of the next
    document's; its fingerprint is the text's without the paragraphs that the edit touches, with those
    it makes: only they are hashed anew.  Texts are shuffled once, by block.

    Null texts count as empty; null doc_ids come first; rows of one doc_id follow by length and hash of their
    text, repeated rows follow each other; a single document is its own next; an empty table gives no rows.
    Extra columns are not read.  Memory: one block's rows (spilled by the window) and the words of the longest
    paragraph."""
    rows = with_next(docs, per_block)
    w = Window.partitionBy(BLOCK).orderBy("head", "doc_id", "n_chars", "h")
    cut = F.col("n_chars") - F.floor(F.col("n_chars") / 4)
    texts = (rows.withColumns({"next_text": F.lead("text").over(w), "pos": F.row_number().over(w)})
             .withColumn("cut", cut.cast("int"))
             .withColumn("kept", F.expr("substring(text, 1, cut)"))
             .withColumn("edited", F.concat("kept", F.expr("substring(coalesce(next_text, ''), 1, int(n_chars) - cut)")))
             .withColumn("whole", F.col("cut") - F.length(F.substring_index("kept", "\n", -1))))  # up to the edit's paragraph
    before = F.split(F.expr("substring(text, 1, whole - 1)"), "\n")  # without the last of its \n
    parts = texts.select(
        BLOCK, "pos", "head", "doc_id", "n_chars", F.unhex(F.sha2("edited", 256)).alias("sha"),
        F.when(F.col("whole") > 0, before).otherwise(F.array().cast("array<string>")).alias("before"),
        F.split(F.expr("substring(text, whole + 1)"), "\n").alias("gone"),
        F.split(F.expr("substring(edited, whole + 1)"), "\n").alias("made"))
    ids = [BLOCK, "pos", "head", "doc_id", "n_chars", "sha", "p", "pe"]
    hashed = (parts.withColumns({f"p_{c}": paragraph_lanes(F.col(c)) for c in ("before", "gone", "made")})
              .withColumns({"p": add_lanes(F.col("p_before"), F.col("p_gone"), P_MASK),
                            "pe": add_lanes(F.col("p_before"), F.col("p_made"), P_MASK),
                            "hashes": F.concat(*[pair_hashes(F.col(c), i) for i, c in enumerate(("before", "gone", "made"))])}))
    sums = bit_sums(hashed, ids, "hashes")  # per document and kind, in the task of the block
    names = ["n", *[f"b{i}" for i in range(2 * SHIFTS)]]
    old, new = F.col("kind") != 2, F.col("kind") != 1  # the text, and the edited text: gone deleted, made inserted
    one = sums.groupBy(*ids).agg(*[F.sum(F.when(k, F.col(c)).otherwise(0)).alias(f"{t}{c}")
                                   for t, k in (("t", old), ("e", new)) for c in names])
    lanes = one.select(*ids, *[signed_lanes(F.col(f"{t}n"), [F.col(f"{t}{c}") for c in names[1:]]).alias(f"w{t}")
                               for t in ("t", "e")])
    w2 = Window.partitionBy(BLOCK).orderBy("pos")
    after = lanes.select("*", F.lead("p").over(w2).alias("pn"), F.lead("wt").over(w2).alias("wn")).where("head = 0")
    after = after.withColumns({f"s_{c}": squares(F.col(c)) for c in ("wt", "we", "wn")}
                              | {f"d_{c}": squares(subtract_lanes(F.col("wt"), F.col(c), W_MASK)) for c in ("we", "wn")})
    return after.select(
        "doc_id", "n_chars", F.lower(F.hex("sha")).alias("edited_sha256"), digits(F.col("p"), F.col("wt")).alias("fingerprint"),
        digits(F.col("pe"), F.col("we")).alias("edited_fingerprint"),
        likeness((F.col("p") == F.col("pe")) & (F.col("wt") == F.col("we")), F.col("d_we"), F.col("s_wt") + F.col("s_we"))
        .alias("near_edited"),
        likeness((F.col("p") == F.col("pn")) & (F.col("wt") == F.col("wn")), F.col("d_wn"), F.col("s_wt") + F.col("s_wn"))
        .alias("near_next"))
