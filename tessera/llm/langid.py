"""Language identification with a byte convolutional network."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, ship

ship(__name__)

WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBED = 8
#: The network is fitted on at most this many labelled documents, TRAIN_WINDOWS windows of each.
MAX_LABELLED = 3000
TRAIN_WINDOWS = 4
EPOCHS = 12
RATE = 0.01
BATCH = 64
BLOCK_BYTES = 1 << 20
UNDETERMINED = "und"


class ByteCnn:
    """Byte embedding -> filters of several widths -> max over the window -> softmax, in numpy."""

    def __init__(self, langs: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.langs = langs
        n = FILTERS * len(WIDTHS)
        self.params = {"e": rng.normal(0, 0.3, (256, EMBED)), "b": np.zeros(n),
                       "o": rng.normal(0, 0.3, (n, len(langs))), "c": np.zeros(len(langs))}
        for w in WIDTHS:
            self.params[f"w{w}"] = rng.normal(0, (2 / (w * EMBED)) ** 0.5, (w * EMBED, FILTERS))

    def tables(self) -> list[np.ndarray]:
        """T[j][byte]: what a byte at offset j adds to every filter (zero beyond the filter's width)."""
        out = np.zeros((max(WIDTHS), 256, FILTERS * len(WIDTHS)), np.float32)
        for i, w in enumerate(WIDTHS):
            for j in range(w):
                out[j, :, i * FILTERS:(i + 1) * FILTERS] = (
                    self.params["e"] @ self.params[f"w{w}"][j * EMBED:(j + 1) * EMBED])
        return list(out)

    @staticmethod
    def responses(tables: list[np.ndarray], x: np.ndarray) -> np.ndarray:
        """Filter values at every position of each window (bytes past its end count as 0)."""
        pad = np.pad(x, ((0, 0), (0, len(tables) - 1)))
        r = tables[0][x]
        for j in range(1, len(tables)):
            r += tables[j][pad[:, j:j + x.shape[1]]]
        return r

    def probabilities(self, x: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
        top = np.maximum(self.responses(tables, x).max(axis=1) + self.params["b"].astype(np.float32), 0)
        z = top @ self.params["o"] + self.params["c"]
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> None:
        """Adam on the cross-entropy; the maximum passes its gradient to the winning position only."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.params.items()}
        s = {k: np.zeros_like(v) for k, v in self.params.items()}
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for at in range(0, len(x), BATCH):
                rows = order[at:at + BATCH]
                step += 1
                for k, g in self._gradients(x[rows], y[rows]).items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    s[k] = 0.999 * s[k] + 0.001 * g * g
                    self.params[k] -= RATE * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(s[k] / (1 - 0.999 ** step)) + 1e-8)

    def _gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p = self.params
        r = self.responses(self.tables(), x)
        at = r.argmax(axis=1)
        raw = np.take_along_axis(r, at[:, None, :], 1)[:, 0] + p["b"]
        top = np.maximum(raw, 0)
        z = top @ p["o"] + p["c"]
        z = np.exp(z - z.max(axis=1, keepdims=True))
        d = z / z.sum(axis=1, keepdims=True)
        d[np.arange(len(y)), y] -= 1
        d /= len(y)
        dtop = (d @ p["o"].T) * (raw > 0)
        grads = {"o": top.T @ d, "c": d.sum(axis=0), "b": dtop.sum(axis=0), "e": np.zeros_like(p["e"])}
        pad = np.pad(x, ((0, 0), (0, max(WIDTHS) - 1)))
        for i, w in enumerate(WIDTHS):
            cols = slice(i * FILTERS, (i + 1) * FILTERS)
            won = pad[np.arange(len(x))[:, None, None], at[:, cols, None] + np.arange(w)]  # rows, filters, width
            emb = p["e"][won].reshape(len(x), FILTERS, w * EMBED)
            grads[f"w{w}"] = np.einsum("bf,bfk->kf", dtop[:, cols], emb)
            back = dtop[:, cols, None] * p[f"w{w}"].T[None]
            np.add.at(grads["e"], won.reshape(-1), back.reshape(-1, EMBED))
        return grads


def windows(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All fixed-length windows of the texts (the last one padded with 0) and the number of each text's windows."""
    n = np.array([max(1, -(-len(r) // WINDOW)) for r in raws])
    flat = b"".join(r.ljust(k * WINDOW, b"\0") for r, k in zip(raws, n.tolist(), strict=True))
    return np.frombuffer(flat, np.uint8).reshape(-1, WINDOW), n


def fit_language_model(docs: DataFrame, max_labelled: int = MAX_LABELLED) -> ByteCnn | None:
    """Fit the network on text and non-null lang of documents whose crc32(doc_id) mod 4 is not 2.

    A bounded sample: the ``max_labelled`` documents with the smallest hash of doc_id, and of each
    TRAIN_WINDOWS stretches of WINDOW characters at evenly spaced places.  None without labels."""
    rows = pick(docs, "doc_id", "text", "lang")
    part = F.crc32(F.col("doc_id").cast("string")) % 4
    rows = rows.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & F.coalesce(part != 2, F.lit(True)))
    n = F.length("text")
    cuts = [F.substring("text", (F.floor(n * i / TRAIN_WINDOWS) + 1).cast("int"), F.lit(WINDOW))
            for i in range(TRAIN_WINDOWS)]
    sample = (rows.select(F.xxhash64("doc_id").alias("h"), "doc_id", "lang", F.array_distinct(F.array(*cuts)).alias("cuts"))
              .orderBy("h", "doc_id", "lang").limit(max_labelled).select("lang", "cuts").collect())
    pairs = [(c.encode()[:WINDOW], r.lang) for r in sample for c in r.cuts if regex.search(r"\p{L}", c)]
    if not pairs:
        return None
    langs = sorted({lang for _, lang in pairs})
    net = ByteCnn(langs)
    x, _ = windows([raw for raw, _ in pairs])
    net.fit(x, np.array([langs.index(lang) for _, lang in pairs]))
    return net


def predict_language(docs: DataFrame, net: ByteCnn | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score from every window of every whole text.

    The score is the predicted language's probability, averaged over the text's windows by their
    bytes.  ``und`` with score 0 if the text is null or has no letter (or nothing was learned).
    held_out is false for a null doc_id; repeated rows come out repeated."""
    rows = pick(docs, "doc_id", "text")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = net.tables() if net else []
        letter = regex.compile(r"\p{L}")

        def judge(raws: list[bytes]) -> tuple[list[str], list[float]]:
            x, n = windows(raws)
            p = np.concatenate([net.probabilities(x[i:i + BATCH], tables) for i in range(0, len(x), BATCH)])
            real = np.full(len(x), float(WINDOW))
            last = np.cumsum(n) - 1
            real[last] = [len(r) - (k - 1) * WINDOW for r, k in zip(raws, n.tolist(), strict=True)]
            mean = np.add.reduceat(p * real[:, None], last - n + 1, axis=0)
            mean /= mean.sum(axis=1, keepdims=True)
            best = mean.argmax(axis=1)
            return [net.langs[b] for b in best], mean[np.arange(len(best)), best].tolist()

        for b in batches:
            texts = b.column(2).to_pylist()
            lang, score = [UNDETERMINED] * len(texts), [0.0] * len(texts)
            todo = [i for i, t in enumerate(texts) if net and t and letter.search(t)]
            at = 0
            while at < len(todo):
                group, size = [], 0
                while at < len(todo) and (not group or size < BLOCK_BYTES):
                    group.append((todo[at], texts[todo[at]].encode()))
                    size += len(group[-1][1])
                    at += 1
                for i, (la, sc) in zip([i for i, _ in group], zip(*judge([r for _, r in group]), strict=True), strict=True):
                    lang[i], score[i] = la, min(1.0, sc)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(lang), pa.array(score, pa.float64())],
                                             names=["doc_id", "held_out", "lang_pred", "score"])

    return rows.select("doc_id", held.alias("held_out"), "text").mapInArrow(
        run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def identify_language(docs: DataFrame) -> DataFrame:
    """Fit on the labelled part of ``docs`` and predict every row."""
    return predict_language(docs, fit_language_model(docs))
