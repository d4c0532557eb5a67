"""Toxicity by a chain of classifiers over hashed words.

The categories stand in an order.  The model of each is logistic regression on hashed words and
beginnings of words, and on the probabilities that the models before it give.  In training those
come from models that haven't seen the row (one per fold), so that a later model learns how far
an earlier one can be trusted on new text.  A feature's value is the root of its count, divided by
the root of all counts, so the length of a text doesn't matter.

Training takes a bounded sample of labelled rows; scoring reads every whole text.  Null texts and
texts without words have probability 0 in every category.  Labels that are null, or of ids
without a document, teach nothing; a category without both values of its label has probability
0.  Repeated rows are scored alike.  Columns other than doc_id, text and the labels are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith.llm.decontaminate import words_of
from aerolith.llm.sampling import sample_by_label

BUCKETS = 1 << 15
_BEGINNING = 5  # bytes
_KEPT = 400_000


class _Places(dict):
    """word -> the buckets of the word and of its beginning; keeps a bounded number of words."""

    def __missing__(self, word: bytes) -> tuple[int, int]:
        found = tuple(xxhash.xxh64_intdigest(w) % BUCKETS for w in (word, b"^" + word[:_BEGINNING]))
        if len(self) < _KEPT:
            self[word] = found
        return found


_PLACES = _Places()


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets, and their values."""
    counts = Counter(words_of(text))
    if not counts:
        return np.zeros(0, np.int64), np.zeros(0, np.float32)
    places = np.array(list(map(_PLACES.__getitem__, counts)), np.int64)
    weights = np.repeat(np.fromiter(counts.values(), np.float64, len(counts)), 2)
    total = np.bincount(places.ravel(), weights, BUCKETS)
    at = np.flatnonzero(total)
    return at, np.sqrt(total[at] / weights.sum()).astype(np.float32)


@dataclass(frozen=True)
class Rows:
    """Sparse rows: row r has entries first[r] .. first[r + 1]."""

    first: np.ndarray
    at: np.ndarray
    value: np.ndarray

    def __len__(self) -> int:
        return len(self.first) - 1

    def take(self, chosen: np.ndarray) -> Rows:
        sizes = np.diff(self.first)
        entries = np.repeat(chosen, sizes)
        return Rows(np.concatenate([[0], np.cumsum(sizes[chosen])]), self.at[entries], self.value[entries])

    def times(self, weights: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0.0], np.cumsum(weights[self.at] * self.value, dtype=np.float64)])
        return sums[self.first[1:]] - sums[self.first[:-1]]

    def transposed_times(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.at, np.repeat(r, np.diff(self.first)) * self.value, BUCKETS)


@dataclass(frozen=True)
class Linear:
    weights: np.ndarray
    chained: np.ndarray  # weights of the earlier probabilities
    bias: float

    def probability(self, words: np.ndarray | float, earlier: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(words + earlier @ self.chained + self.bias, -60, 60)))


def fit_linear(
    x: Rows, earlier: np.ndarray, y: np.ndarray, steps: int = 80, rate: float = 20.0, penalty: float = 1e-5, least_rows: int = 3
) -> Linear:
    """Gradient steps with momentum over all rows; both classes weigh the same.

    Features are scaled by how much more often one class has them (log of the ratio), so that words of
    a single document, which any model can learn by heart, don't drown those that many share.
    """
    entry = np.repeat(y == 1, np.diff(x.first))
    seen = [np.bincount(x.at[entry == side], minlength=BUCKETS) for side in (True, False)]
    share = [(n + 1) / ((y == side).sum() + 2) for n, side in zip(seen, (1, 0), strict=True)]
    scale = np.abs(np.log(share[0] / share[1])) * (seen[0] + seen[1] >= least_rows)
    x = Rows(x.first, x.at, (x.value * scale[x.at]).astype(np.float32))
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    w, c, b = np.zeros(BUCKETS), np.zeros(earlier.shape[1]), 0.0
    vw, vc, vb = np.zeros_like(w), np.zeros_like(c), 0.0
    for _ in range(steps):
        r = (Linear(w, c, b).probability(x.times(w), earlier) - y) * weight
        vw = 0.9 * vw - rate * (x.transposed_times(r) + penalty * w)
        vc, vb = 0.9 * vc - 0.3 * rate * (earlier.T @ r), 0.9 * vb - 0.3 * rate * r.sum()
        w, c, b = w + vw, c + vc, b + vb
    return Linear((w * scale).astype(np.float32), c, float(b))


@dataclass(frozen=True)
class Chain:
    categories: tuple[str, ...]
    models: tuple[Linear | None, ...]
    thresholds: tuple[float, ...]

    def probabilities(self, text: str | None) -> list[float]:
        at, value = features(text)
        if not len(at):
            return [0.0] * len(self.categories)
        found: list[float] = []
        for model in self.models:
            words = float(model.weights[at] @ value) if model else 0.0
            found.append(float(model.probability(words, np.array(found))) if model else 0.0)
        return found


def fit_chain(x: Rows, labels: np.ndarray, folds: np.ndarray, categories: Sequence[str]) -> Chain:
    """``labels``: (rows, categories) of 0, 1 or -1 for unknown; ``folds``: the fold of each row."""
    models: list[Linear | None] = []
    thresholds: list[float] = []
    earlier = np.zeros((len(x), 0))
    for j in range(len(categories)):
        y = labels[:, j]
        known = y >= 0
        if len(np.unique(y[known])) < 2:
            models.append(None)
            thresholds.append(1.0)
            earlier = np.column_stack([earlier, np.zeros(len(x))])
            continue
        models.append(fit_linear(x.take(known), earlier[known], y[known]))
        unseen = np.zeros(len(x))
        for fold in np.unique(folds):
            out = folds == fold
            part = known & ~out
            if len(np.unique(y[part])) == 2:
                model = fit_linear(x.take(part), earlier[part], y[part])
                unseen[out] = model.probability(x.take(out).times(model.weights), earlier[out])
        thresholds.append(threshold_of(unseen[known], y[known]))
        earlier = np.column_stack([earlier, unseen])
    return Chain(tuple(categories), tuple(models), tuple(thresholds))


def threshold_of(p: np.ndarray, y: np.ndarray, cost: float = 15.0) -> float:
    """The hundredth, from 0.2 to 0.8, at which missed members and ``cost`` times the wrongly taken are fewest, by their shares."""
    steps = np.arange(20, 81) / 100
    lost = [(p[y == 1] < t).mean() + cost * (p[y == 0] >= t).mean() for t in steps]
    return float(np.mean(steps[np.isclose(lost, min(lost))]))


#: Categories of the labels table, in the order of the chain: name and the column that is 1 for a member.
def default_categories() -> dict[str, Column]:
    return {"low_quality": 1 - F.col("quality"), "toxic": F.col("toxic")}


def fit(
    docs: DataFrame, labels: DataFrame, categories: dict[str, Column] | None = None, per_label: int = 2000, folds: int = 3
) -> Chain:
    """Learn from about ``per_label`` labelled documents of each value of the last category, chosen by a hash of the id."""
    categories = categories or default_categories()
    names = list(categories)
    marked = labels.select(
        F.col("doc_id").cast("long").alias("_id"),
        *[F.coalesce(c.cast("int"), F.lit(-1)).alias(f"_y{j}") for j, c in enumerate(categories.values())],
    ).where("_id is not null")
    sample = sample_by_label(marked, f"_y{len(names) - 1}", "_id", per_label).limit(8 * per_label)
    kind = "id long, y array<int>, at array<int>, value array<float>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t.as_py()) for t in batch.column(1)]
            ys = list(zip(*(batch.column(2 + j).to_pylist() for j in range(len(names)))))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(ys, pa.list_(pa.int32())),
                    pa.array([a for a, _ in found], pa.list_(pa.int32())),
                    pa.array([v for _, v in found], pa.list_(pa.float32())),
                ],
                ["id", "y", "at", "value"],
            )

    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("_text"))
    rows = texts.join(F.broadcast(sample), "_id").select("_id", "_text", *[f"_y{j}" for j in range(len(names))])
    found = rows.mapInArrow(run, kind).toArrow().sort_by([("id", "ascending")])
    if not found.num_rows:
        return Chain(tuple(names), (None,) * len(names), (1.0,) * len(names))
    at, value = (found.column(c).combine_chunks() for c in ("at", "value"))
    first = np.concatenate([[0], np.cumsum([len(a) for a in at])]).astype(np.int64)
    x = Rows(first, at.flatten().to_numpy().astype(np.int64), value.flatten().to_numpy())
    y = np.array(found.column("y").to_pylist(), np.int64)
    fold = np.array([xxhash.xxh32_intdigest(str(i).encode()) % folds for i in found.column("id").to_pylist()])
    return fit_chain(x, y, fold, names)


def predict(docs: DataFrame, chain: Chain) -> DataFrame:
    """doc_id, and p_<category> of every whole text."""
    names = ["doc_id", *(f"p_{c}" for c in chain.categories)]
    kind = ", ".join(["doc_id long", *(f"{n} double" for n in names[1:])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([chain.probabilities(t.as_py()) for t in batch.column(1)]).reshape(-1, len(chain.categories))
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, np.ascontiguousarray(found.T))], names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, kind)


def flagged(docs: DataFrame, chain: Chain, category: str = "toxic", least: float | None = None) -> DataFrame:
    """Rows of ``predict`` of the documents whose probability of ``category`` is at least ``least``.

    By default that is the threshold that served best on rows the judging model had not seen in training.
    """
    least = chain.thresholds[chain.categories.index(category)] if least is None else least
    return predict(docs, chain).where(F.col(f"p_{category}") >= least)
