"""Toxicity by a factorization machine over hashed terms.

A text is the set of its hashed words. The score is the logistic function of

    bias + sum_i w_i + sum_{i<j} <v_i, v_j>

over its known terms: besides a weight of its own each term has a short vector, and pairs of terms whose vectors
agree raise the score, so an insult beside a mention of a group counts for more than the two alone.

Terms are hashed to 30 bits without a stored vocabulary. The model keeps two kinds of terms, `MAX_TERMS` in all, so its
size is bounded: those that tell the labels apart beyond chance by themselves (chi-squared of at least `MIN_CHI`), and
those that do so only beside another one. For these all pairs of the `PAIR_TERMS` most frequent terms are counted, and
both terms of a pair are kept where the label among rows with both departs from what either alone would give. Rows
with the same terms count once in the fit, or a group of copies would outvote the rest. The machine is fitted on at
most `TRAIN_ROWS` labelled rows, broadcast to the scan of the documents (two numbers a row, a proven bound), and every
document is scored on its whole text.

Defined results: NULL and empty texts have no terms and get the bias. Without labelled rows of both classes every
score is the share of label 1 (0.5 without labels). NULL ids are scored; their remainder is that of empty text. An
empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from batchlens.llm.common import id_and_text
from batchlens.llm.labelled import training_sample

TRAIN_ROWS = 20_000
MAX_TERMS = 8_192
MIN_DOCS = 4
#: Of chance terms about one in 100,000 reaches it.
MIN_CHI = 20.0
#: Terms whose pairs are counted, and what a pair must reach; there are two million pairs, so it is higher.
PAIR_TERMS = 2_048
PAIR_CHI = 45.0
#: Rows of either label that a pair must lead one to expect, or the statistic does not hold.
PAIR_EXPECTED = 5.0
FACTORS = 4
EPOCHS = 20
HASH_BITS = 30
THRESHOLD = 0.7
SEED = 7

_WORD = re.compile(r"[^\W_]+")


def terms(text: str) -> np.ndarray:
    """Sorted different hashed words of a whole text."""
    words = set(_WORD.findall(text.lower()))
    hashed = np.fromiter(map(zlib.crc32, map(str.encode, words)), np.uint32, len(words))
    return np.unique(hashed >> np.uint32(32 - HASH_BITS)).astype(np.int32)


@dataclass
class Machine:
    terms: np.ndarray
    bias: float
    weights: np.ndarray
    vectors: np.ndarray

    def score(self, found: np.ndarray) -> float:
        at = np.searchsorted(self.terms, found)
        at = at[np.take(self.terms, at, mode="clip") == found] if len(self.terms) else at[:0]
        v = self.vectors[at]
        total = v.sum(axis=0)
        margin = self.bias + self.weights[at].sum() + 0.5 * float(total @ total - (v * v).sum())
        return float(1 / (1 + np.exp(-np.clip(margin, -30, 30))))


def _paired(hit: np.ndarray, row: np.ndarray, y: np.ndarray, n: int) -> np.ndarray:
    """For each of n terms, the largest chi-squared of a pair that holds it.

    `hit` and `row` are the term and the row of each entry, sorted by row. A pair is measured against the share of
    label 1 among rows with one of its terms, and counts with the lesser of the two.
    """
    both, positive = np.zeros((n, n), np.float32), np.zeros((n, n), np.float32)
    step = 1024
    for at in range(0, len(y), step):
        lo, hi = np.searchsorted(row, [at, at + step])
        block = np.zeros((min(step, len(y) - at), n), np.float32)
        block[row[lo:hi] - at, hit[lo:hi]] = 1
        both += block.T @ block
        toxic = block[y[at : at + step] == 1]
        positive += toxic.T @ toxic
    share = (np.diag(positive) + y.mean()) / (np.diag(both) + 1)
    best = np.zeros(n)
    for at in range(0, n, 256):
        rows = slice(at, at + 256)
        least = np.full(both[rows].shape, np.inf)
        for s in (share[rows, None], share[None, :]):
            expected = both[rows] * s
            sure = np.minimum(expected, both[rows] - expected) >= PAIR_EXPECTED
            chi = np.where(sure, (positive[rows] - expected) ** 2 / np.maximum(expected * (1 - s), 1e-9), 0)
            least = np.minimum(least, chi)
        own = np.arange(least.shape[0])
        least[own, own + at] = 0
        best[rows] = least.max(axis=1)
    return best


def _telling(flat: np.ndarray, row: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """The hashed terms that tell the labels apart, alone or in pairs, sorted.

    `row` is the row of each entry of `flat`, ascending; `labels` has one label per row.
    """
    share = labels.mean()
    known, inverse, docs = np.unique(flat, return_inverse=True, return_counts=True)
    positive = np.bincount(inverse, weights=labels[row], minlength=len(known))
    chi = (positive - docs * share) ** 2 / (docs * share * (1 - share))
    usable = np.flatnonzero((docs >= MIN_DOCS) & (chi >= MIN_CHI))
    alone = usable[np.argsort(-chi[usable], kind="stable")]
    frequent = np.sort(np.argsort(-docs, kind="stable")[:PAIR_TERMS])
    place = np.full(len(known), -1)
    place[frequent] = np.arange(len(frequent))
    hit = place[inverse]
    beside = _paired(hit[hit >= 0], row[hit >= 0], labels, len(frequent))
    some = np.flatnonzero(beside >= PAIR_CHI)
    # A quarter of the places, at least, is for terms that count beside others.
    pairs = frequent[some[np.argsort(-beside[some], kind="stable")]][: max(MAX_TERMS // 4, MAX_TERMS - len(alone))]
    alone = alone[~np.isin(alone, pairs)][: MAX_TERMS - len(pairs)]
    return np.sort(known[np.concatenate([alone, pairs])])


def fit(rows: list[np.ndarray], y: np.ndarray, seed: int = SEED) -> Machine:
    """Adaptive gradient descent on the logistic loss, in mini-batches of rows.

    Rows are put in an order of their own first, so that the model does not depend on the order they come in.
    """
    once = {r.tobytes(): (r, label) for r, label in sorted(zip(rows, y), key=lambda x: (x[0].tobytes(), x[1]))}
    rows, y = [r for r, _ in once.values()], np.array([label for _, label in once.values()], dtype=float)
    share = float(y.mean()) if len(y) else 0.5
    empty = Machine(np.zeros(0, np.int32), float(np.log((share + 1e-9) / (1 - share + 1e-9))), np.zeros(0), np.zeros((0, FACTORS)))
    if not len(y) or not 0 < share < 1:
        return empty
    sizes = np.array([len(r) for r in rows])
    flat = np.concatenate(rows)
    kept = _telling(flat, np.repeat(np.arange(len(rows)), sizes), y)
    if not len(kept):
        return empty
    index = np.searchsorted(kept, flat)
    hit = np.take(kept, index, mode="clip") == flat
    owner = np.repeat(np.arange(len(rows)), sizes)[hit]
    index = index[hit]
    starts = np.searchsorted(owner, np.arange(len(rows) + 1))

    random = np.random.default_rng(seed)
    n = len(kept)
    bias, w, v = empty.bias, np.zeros(n), random.normal(0, 0.01, (n, FACTORS))
    seen_w, seen_v, seen_b = np.full(n, 1e-6), np.full((n, FACTORS), 1e-2), 1e-6
    for _ in range(EPOCHS):
        order = random.permutation(len(rows))
        for at in range(0, len(order), 256):
            batch = order[at : at + 256]
            entry = np.concatenate([index[starts[r] : starts[r + 1]] for r in batch])
            row = np.repeat(np.arange(len(batch)), starts[batch + 1] - starts[batch])
            own = v[entry]
            total = np.stack([np.bincount(row, own[:, f], len(batch)) for f in range(FACTORS)], axis=1)
            square = np.bincount(row, (own * own).sum(axis=1), len(batch))
            margin = bias + np.bincount(row, w[entry], len(batch)) + 0.5 * ((total * total).sum(axis=1) - square)
            slip = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y[batch]
            touched, place = np.unique(entry, return_inverse=True)
            grad = np.bincount(place, slip[row], len(touched)) / len(batch) + 2e-5 * w[touched]
            seen_w[touched] += grad * grad
            w[touched] -= 0.6 * grad / np.sqrt(seen_w[touched])
            for f in range(FACTORS):
                pull = slip[row] * (total[row, f] - own[:, f])
                grad = np.bincount(place, pull, len(touched)) / len(batch) + 1e-4 * v[touched, f]
                seen_v[touched, f] += grad * grad
                v[touched, f] -= 0.05 * grad / np.sqrt(seen_v[touched, f])
            grad = slip.mean()
            seen_b += grad * grad
            bias -= 0.1 * grad / np.sqrt(seen_b)
    return Machine(kept.astype(np.int32), float(bias), w, v)


def train(
    docs: DataFrame,
    labels: DataFrame,
    held_out: Column,
    label: str = "toxic",
    train_rows: int = TRAIN_ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Machine:
    """A machine from a sample of at most `train_rows` labelled rows that are not held out."""
    sample = training_sample(labels, label, held_out, train_rows, id_col)
    source = id_and_text(docs, id_col, text_col).join(F.broadcast(sample), "id").select("text", "y")
    out = StructType([StructField("y", IntegerType()), StructField("terms", ArrayType(IntegerType()))])
    schema = to_arrow_schema(out)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = [terms(t) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({"y": part.column("y"), "terms": found}, schema=schema)

    rows = source.mapInArrow(run, out).toArrow()
    y = rows["y"].to_numpy().astype(float)
    found = [x.values.to_numpy() for x in rows["terms"]]
    return fit(found, y)


def score(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every document."""
    source = id_and_text(docs, id_col, text_col)
    out = StructType([StructField("id", source.schema["id"].dataType), StructField("score", DoubleType())])
    schema = to_arrow_schema(out)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            scores = [machine.score(terms(t)) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(scores, pa.float64())], schema=schema)

    return source.mapInArrow(run, out).withColumnRenamed("id", id_col)


def clean(
    docs: DataFrame, machine: Machine, threshold: float = THRESHOLD, text_col: str = "text"
) -> DataFrame:
    """The documents that score below `threshold`, with all their columns, in one scan without a shuffle."""
    schema = to_arrow_schema(docs.schema)
    at = docs.columns.index(text_col)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            low = [machine.score(terms(t or "")) < threshold for t in part.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(part.filter(pa.array(low, pa.bool_())).columns, schema=schema)

    return docs.mapInArrow(run, docs.schema)
