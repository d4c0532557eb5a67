"""Language identification by a byte convolutional network.

A text's bytes are cut into windows of fixed length that overlap by the widest filter less one,
so that each byte n-gram of the whole text is seen.  Filters of several widths slide over the
one-hot bytes of a window, each keeps its largest response, and a softmax layer turns those
into probabilities of languages.  A text's probabilities are its windows' means, weighted by
their bytes.  Everything is trained in numpy with Adam on a bounded sample of labelled rows.

Null text, or text without any letter, is ``und`` with score 0; so is every text when no
labelled row exists.  Equal probabilities go to the language first in order.  Rows are judged
one by one: repeated rows and ids change nothing.  Of other columns only the label is read,
and only for training.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.llm.common import fit_fold, slices
from aerolith.llm.sampling import sample_by_label

WIDTHS = (2, 3, 4)
WINDOW = 256
_STRIDE = WINDOW - max(WIDTHS) + 1
_LETTER = regex.compile(r"\p{L}")
UNKNOWN = "und"


def windows(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(n, WINDOW) bytes, the last ones filled up with zeros, and how many bytes of each are the text's own."""
    n = max(1, -(-(len(data) - max(WIDTHS) + 1) // _STRIDE))
    padded = np.zeros((n - 1) * _STRIDE + WINDOW, np.uint8)
    padded[: len(data)] = np.frombuffer(data, np.uint8)
    lengths = np.minimum(len(data) - _STRIDE * np.arange(n), WINDOW)
    return np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[::_STRIDE], lengths


def _pooled(x: np.ndarray) -> np.ndarray:
    """Maximum over axis 1 by halving, which keeps the inner loops long."""
    while x.shape[1] > 1:
        half = -(-x.shape[1] // 2)
        x = np.maximum(x[:, :half], x[:, x.shape[1] - half :])
    return x[:, 0]


@dataclass
class ByteNetwork:
    """tables[w][k]: (256, filters) responses of the width-w filters to the byte at place k."""

    languages: list[str]
    tables: dict[int, np.ndarray]
    bias: np.ndarray
    dense: np.ndarray
    offset: np.ndarray

    def _pairs(self, width: int, at: int) -> np.ndarray:
        """Responses to two bytes in a row, for one lookup instead of two."""
        if not hasattr(self, "_cache"):
            self._cache = {}
        if (width, at) not in self._cache:
            t = self.tables[width]
            self._cache[width, at] = (t[at][:, None] + t[at + 1][None]).reshape(65536, -1)
        return self._cache[width, at]

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_cache"}

    def _responses(self, x: np.ndarray, width: int) -> np.ndarray:
        pairs = x[:, :-1].astype(np.uint16) << 8 | x[:, 1:]
        n = x.shape[1] - width + 1
        out = np.take(self._pairs(width, 0), pairs[:, :n], axis=0)
        for at in range(2, width - 1, 2):
            out += np.take(self._pairs(width, at), pairs[:, at : at + n], axis=0)
        if width % 2:
            out += np.take(self.tables[width][width - 1], x[:, width - 1 :], axis=0)
        return out

    def hidden(self, x: np.ndarray) -> np.ndarray:
        pooled = [_pooled(self._responses(x, w)) for w in WIDTHS]
        return np.maximum(np.concatenate(pooled, axis=1) + self.bias, 0)

    def probabilities(self, x: np.ndarray, at_once: int = 64) -> np.ndarray:
        out = [self.hidden(x[i : i + at_once]) @ self.dense + self.offset for i in range(0, len(x), at_once)]
        return _softmax(np.concatenate(out))

    def judge(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        readable = [i for i, t in enumerate(texts) if t and self.languages and _LETTER.search(t)]
        held, size = [], 0
        for i in readable:
            held.append(i)
            size += len(texts[i])
            if size > 1_000_000 or i == readable[-1]:
                parts = [windows(texts[k].encode()) for k in held]
                p = self.probabilities(np.concatenate([w for w, _ in parts]))
                weights = np.concatenate([n for _, n in parts]).astype(np.float64)
                first = np.cumsum([0, *(len(w) for w, _ in parts[:-1])])
                mean = np.add.reduceat(p * weights[:, None], first, axis=0) / np.add.reduceat(weights, first)[:, None]
                for k, row in zip(held, mean, strict=True):
                    names[k], scores[k] = self.languages[int(row.argmax())], float(min(1.0, row.max()))
                held, size = [], 0
        return names, scores


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z.astype(np.float64) - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(
    x: np.ndarray, y: np.ndarray, languages: list[str], filters: int = 12, steps: int = 300, batch: int = 96,
    rate: float = 0.02, seed: int = 3,
) -> ByteNetwork:
    """Fit to windows ``x`` with class numbers ``y``; gradients flow to each filter's largest response only.

    As many steps for few windows as for many, so that a small sample is learnt as well.
    """
    rng = np.random.default_rng(seed)
    k = len(WIDTHS) * filters
    tables = {w: rng.normal(0, 0.3, (w, 256, filters)).astype(np.float32) for w in WIDTHS}
    values = [*tables.values(), np.zeros(k, np.float32), rng.normal(0, 0.1, (k, len(languages))).astype(np.float32),
              np.zeros(len(languages), np.float32)]
    net = ByteNetwork(languages, tables, *values[len(WIDTHS) :])
    first, second, step = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values], 0
    columns = np.arange(filters)
    while step < steps:
        order = rng.permutation(len(x))
        for i in range(0, len(x), batch):
            xb, yb = x[order[i : i + batch]], y[order[i : i + batch]]
            net._cache = {}
            best, pooled = [], []
            for w in WIDTHS:
                r = net._responses(xb, w)
                at = r.argmax(axis=1)
                best.append(at)
                pooled.append(np.take_along_axis(r, at[:, None], axis=1)[:, 0])
            z = np.concatenate(pooled, axis=1) + net.bias
            h = np.maximum(z, 0)
            g = _softmax(h @ net.dense + net.offset).astype(np.float32)
            g[np.arange(len(yb)), yb] -= 1
            g /= len(yb)
            gz = (g @ net.dense.T) * (z > 0)
            grads = []
            for j, w in enumerate(WIDTHS):
                part, grad = gz[:, j * filters : (j + 1) * filters], np.zeros_like(tables[w])
                for place in range(w):
                    seen = np.take_along_axis(xb, best[j] + place, axis=1)
                    np.add.at(grad[place], (seen, columns[None]), part)
                grads.append(grad)
            grads += [gz.sum(0), h.T @ g, g.sum(0)]
            step += 1
            for v, gr, m, s in zip(values, grads, first, second, strict=True):
                m += 0.1 * (gr - m)
                s += 0.001 * (gr * gr - s)
                v -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    net._cache = {}
    return net


def training_windows(docs: DataFrame, per_language: int, per_document: int) -> tuple[np.ndarray, list[str]]:
    """At most ``per_document`` windows, evenly spread, of about ``per_language`` documents of each language."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                w, _ = windows(text.as_py().encode())
                for k in np.unique(np.linspace(0, len(w) - 1, per_document).astype(int)):
                    found.append((lang, w[k].tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.binary())], ["lang", "w"]
            )

    labelled = docs.where(fit_fold() & F.col("lang").isNotNull()).select("doc_id", "text", F.col("lang").cast("string"))
    sample = sample_by_label(labelled.where("text is not null"), "lang", "doc_id", per_language)
    rows = sample.select("lang", "text").mapInArrow(cut, "lang string, w binary").toArrow()
    pairs = sorted(zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()))
    x = np.frombuffer(b"".join(w for _, w in pairs), np.uint8).reshape(-1, WINDOW)
    return x, [lang for lang, _ in pairs]


def fit(docs: DataFrame, per_language: int = 500, per_document: int = 3, **options) -> ByteNetwork:
    """Learn from documents of the fitting fold with a label: some ``per_language`` of each language."""
    x, labels = training_windows(docs, per_language, per_document)
    languages = sorted(set(labels))
    if not languages:
        return ByteNetwork([], {}, np.zeros(0), np.zeros((0, 0)), np.zeros(0))
    return train(x, np.array([languages.index(v) for v in labels]), languages, **options)


def predict(docs: DataFrame, model: ByteNetwork) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            names, scores = model.judge(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), (~fit_fold()).alias("held_out"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def readable(docs: DataFrame, model: ByteNetwork, least: float = 0.5) -> DataFrame:
    """``docs`` without texts of unknown language or with a score below ``least``."""

    text = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            names, scores = model.judge(batch.column(text).to_pylist())
            yield batch.filter(pa.array([n != UNKNOWN and s >= least for n, s in zip(names, scores, strict=True)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
