"""Text quality by a sparse ensemble of rules.

1. `statistics` reduces each whole text to numbers (shares of letters, marks, repeated words and lines, ...).
2. `fit` grows small boosted trees on the statistics of a sample of labelled rows. Every path from a root to a node
   is a conjunctive rule: a few `statistic <= cut` or `statistic > cut` conditions.
3. A logistic regression with an L1 penalty weighs the rules; most get no weight and are dropped.
4. `rule_score` compiles what is left into one Spark column expression, which scores the table of statistics
   inside generated code.

At most `TRAIN_ROWS` labelled rows reach the driver, and the statistics are numbers only.

Defined results: NULL and empty texts have zero for every statistic and are scored like any other. Without
labelled rows of both classes there are no rules and every score is the share of label 1 (0.5 without labels). An
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, StructField, StructType

from batchlens.llm.common import id_and_text
from batchlens.llm.labelled import training_sample
from batchlens.session import stage

TRAIN_ROWS = 20_000
TREES = 30
DEPTH = 3
RATE = 0.3
CUTS = 31
PENALTY = 2e-3
THRESHOLD = 0.3

NAMES = (
    "log_bytes log_words words_per_line word_bytes upper lower digit other_byte blank full_stop comma bang mark pipe "
    "symbol bracket distinct_words top_word doubled_words distinct_lines short_words long_words odd_ends entropy"
).split()

_UPPER, _LOWER, _DIGIT = range(65, 91), range(97, 123), range(48, 58)
_SYMBOLS, _BRACKETS = list(b"#$%&*+=@^_~\\/"), list(b"()[]{}<>")


def text_statistics(text: str) -> list[float]:
    """The statistics of one whole text, in the order of NAMES."""
    raw = text.encode()
    words = raw.split()
    if not words:
        return [0.0] * len(NAMES)
    n, count = len(raw), len(words)
    seen = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    share = seen / n
    lines = [x for x in raw.split(b"\n") if x]
    sizes = np.fromiter(map(len, words), np.int64, count)
    tally: dict[bytes, int] = {}
    for w in words:
        tally[w] = tally.get(w, 0) + 1
    ends = bytes(w[-1] for w in words)
    doubled = sum(a == b for a, b in zip(words, words[1:]))
    some = share[share > 0]
    return [
        float(np.log1p(n)),
        float(np.log1p(count)),
        count / len(lines),
        float(sizes.mean()),
        float(share[_UPPER].sum()),
        float(share[_LOWER].sum()),
        float(share[_DIGIT].sum()),
        float(share[128:].sum()),
        float(share[32] + share[9] + share[10]),
        float(share[46]),
        float(share[44]),
        float(share[33]),
        float(share[63] + share[58] + share[59]),
        float(share[124]),
        float(share[_SYMBOLS].sum()),
        float(share[_BRACKETS].sum()),
        len(tally) / count,
        max(tally.values()) / count,
        doubled / count,
        len(set(lines)) / len(lines),
        float((sizes <= 2).mean()),
        float((sizes > 12).mean()),
        sum(map(ends.count, (b"!", b"#", b"$", b"%", b"&", b"*", b"|"))) / count,
        float(-(some * np.log2(some)).sum()),
    ]


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, one column per statistic) of every document."""
    source = id_and_text(docs, id_col, text_col)
    out = StructType([source.schema["id"], *(StructField(n, DoubleType()) for n in NAMES)])
    schema = to_arrow_schema(out)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            numbers = np.array([text_statistics(t) for t in part.column("text").to_pylist()], dtype=float)
            columns = numbers.reshape(-1, len(NAMES)).T
            yield pa.RecordBatch.from_arrays([part.column("id"), *map(pa.array, columns)], schema=schema)

    return source.mapInArrow(run, out)


@dataclass(frozen=True)
class Rule:
    """All conditions (statistic, cut, above) must hold."""

    conditions: tuple[tuple[str, float, bool], ...]
    weight: float = 0.0


@dataclass(frozen=True)
class RuleSet:
    bias: float
    rules: tuple[Rule, ...]


def _grow(binned: np.ndarray, slope: np.ndarray, curve: np.ndarray) -> list[tuple]:
    """One tree by second-order gains: nodes as (conditions (column, cut, above), rows, value)."""
    nodes, open_nodes = [], [((), np.arange(len(binned)))]
    while open_nodes:
        conditions, rows = open_nodes.pop()
        g, h = slope[rows], curve[rows]
        total_g, total_h = g.sum(), h.sum()
        best = (1e-3, None, None)
        if len(conditions) < DEPTH and len(rows) >= 20:
            for column in range(binned.shape[1]):
                bins = binned[rows, column]
                left_g = np.cumsum(np.bincount(bins, g, CUTS + 1))[:-1]
                left_h = np.cumsum(np.bincount(bins, h, CUTS + 1))[:-1]
                right_g, right_h = total_g - left_g, total_h - left_h
                gain = left_g**2 / (left_h + 1) + right_g**2 / (right_h + 1) - total_g**2 / (total_h + 1)
                gain[(left_h < 1) | (right_h < 1)] = -1
                cut = int(gain.argmax())
                if gain[cut] > best[0]:
                    best = (gain[cut], column, cut)
        _, column, cut = best
        nodes.append((conditions, rows, -total_g / (total_h + 1), column is None))
        if column is not None:
            low = binned[rows, column] <= cut
            open_nodes += [
                ((*conditions, (column, cut, False)), rows[low]),
                ((*conditions, (column, cut, True)), rows[~low]),
            ]
    return nodes


def _lasso(x: np.ndarray, y: np.ndarray, penalty: float, steps: int = 400) -> tuple[float, np.ndarray]:
    """Logistic regression with an L1 penalty by accelerated proximal gradient steps; the bias is free."""
    n, k = x.shape
    mean = x.mean(axis=0)
    centred = x - mean
    size = 4 * n / (np.linalg.norm(centred, 2) ** 2 + n)
    w, b = np.zeros(k), float(np.log(y.mean() / (1 - y.mean())))
    look_w, look_b, t = w, b, 1.0
    for _ in range(steps):
        slip = 1 / (1 + np.exp(-(centred @ look_w + look_b))) - y
        step = look_w - size * (centred.T @ slip) / n
        new_w = np.sign(step) * np.maximum(np.abs(step) - size * penalty, 0)
        new_b = look_b - size * slip.mean()
        new_t = (1 + np.sqrt(1 + 4 * t * t)) / 2
        look_w = new_w + (t - 1) / new_t * (new_w - w)
        look_b = new_b + (t - 1) / new_t * (new_b - b)
        w, b, t = new_w, new_b, new_t
    return float(b - mean @ w), w


def fit(x: np.ndarray, y: np.ndarray, penalty: float = PENALTY) -> RuleSet:
    """Rules from boosted trees, weighed by the lasso; `x` has a column per name."""
    share = float(y.mean()) if len(y) else 0.5
    if not len(y) or not 0 < share < 1:
        return RuleSet(float(np.log((share + 1e-9) / (1 - share + 1e-9))), ())
    order = np.lexsort((y, *x.T))
    x, y = x[order], y[order]
    cuts = [np.unique(np.quantile(column, np.linspace(0, 1, CUTS + 2)[1:-1])) for column in x.T]
    binned = np.stack([np.searchsorted(c, column) for c, column in zip(cuts, x.T)], axis=1)
    margin = np.full(len(y), np.log(share / (1 - share)))
    found: dict[tuple, np.ndarray] = {}
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        for conditions, rows, value, leaf in _grow(binned, p - y, p * (1 - p)):
            if leaf:
                margin[rows] += RATE * value
            if conditions:
                fires = np.zeros(len(y))
                fires[rows] = 1
                found.setdefault(tuple(sorted(conditions)), fires)
    if not found:
        return RuleSet(float(np.log(share / (1 - share))), ())
    bias, weights = _lasso(np.stack(list(found.values()), axis=1), y, penalty)
    rules = []
    for conditions, weight in zip(found, weights):
        if abs(weight) > 1e-6:
            named = tuple((NAMES[c], float(cuts[c][min(cut, len(cuts[c]) - 1)]), above) for c, cut, above in conditions)
            rules.append(Rule(named, float(weight)))
    return RuleSet(bias, tuple(rules))


def rule_score(model: RuleSet) -> Column:
    """The rule set as a column expression over the statistics."""
    margin = F.lit(model.bias)
    for rule in model.rules:
        holds = F.lit(True)
        for name, cut, above in rule.conditions:
            holds = holds & (F.col(name) > cut if above else F.col(name) <= cut)
        margin = margin + F.when(holds, F.lit(rule.weight)).otherwise(0.0)
    return 1 / (1 + F.exp(-margin))


def train(
    numbers: DataFrame,
    labels: DataFrame,
    held_out: Column,
    label: str = "quality",
    train_rows: int = TRAIN_ROWS,
    id_col: str = "doc_id",
) -> RuleSet:
    """A rule set from the statistics of at most `train_rows` labelled rows that are not held out."""
    sample = training_sample(labels, label, held_out, train_rows, id_col)
    rows = numbers.join(F.broadcast(sample), "id").select("y", *NAMES).toPandas()
    return fit(rows[NAMES].to_numpy(float), rows["y"].to_numpy(float))


def quality(
    docs: DataFrame,
    labels: DataFrame,
    held_out: Column,
    train_rows: int = TRAIN_ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, score) of every document, with a model learnt from the labels that are not held out."""
    numbers = stage(statistics(docs, id_col, text_col), "statistics")
    model = train(numbers, labels, held_out, train_rows=train_rows, id_col=id_col)
    return numbers.select(F.col("id").alias(id_col), rule_score(model).alias("score"))
