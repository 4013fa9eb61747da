"""Quality scores by a sparse rule ensemble.

1. Statistics of the whole text: sizes, shares of kinds of characters, how
   words repeat, how well the bytes compress.
2. Boosted trees of small depth over the statistics of labelled rows; every
   path from a root to a node is a conjunctive rule.
3. Logistic regression with an L1 penalty over the rules (and the clipped,
   standardised statistics) leaves few of them with a weight.
4. The rules and weights are compiled to one Spark column expression over the
   statistics' columns, so scoring has no model object.

The trees and weights are fitted on a bounded sample: the ``SAMPLE`` labelled
training rows of the smallest key hash.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanwright.llm.common import bounded_batches, checked_broadcast
from spanwright.llm.langid import held_out

SAMPLE = 20_000
TREES, DEPTH, BINS, PENALTY = 40, 3, 32, 2e-3
STATISTICS = (
    "log_bytes", "log_words", "word_bytes", "symbols", "pipes", "exclamations", "upper", "digits", "distinct", "lines", "stops", "foreign", "packed", "top_word",
)
ROWS = 4096
_CLASS = np.zeros((8, 256))
for _i, _chars in enumerate((b"#$%&*@^~<>{}[]\\/=+_", b"|", b"!", bytes(range(65, 91)), bytes(range(48, 58)), b"\n", b".?", bytes(range(128, 256)))):
    _CLASS[_i, list(_chars)] = 1
_LOWER = np.zeros(256)
_LOWER[97:123] = 1


def statistics(text: str | None) -> list[float]:
    """The values of STATISTICS for one text; null counts as empty."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n, k = len(raw), len(words)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    symbol, pipe, bang, upper, digit, line, stop, foreign = _CLASS @ counts
    share = 1 / max(n, 1)
    seen: dict[bytes, int] = {}
    for word in words:
        seen[word] = seen.get(word, 0) + 1
    return [
        float(np.log1p(n)), float(np.log1p(k)), (n - k) / max(k, 1), symbol * share, pipe * share, bang * share, upper / max(upper + _LOWER @ counts, 1), digit * share,
        float(np.log1p(len(seen)) / np.log1p(k)) if k else 0.0, line / max(k, 1), stop / max(k, 1), foreign * share, len(zlib.compress(raw, 1)) / (n + 32),
        max(seen.values(), default=0) / max(k, 1),
    ]


def _measured(batches):
    for batch in batches:
        texts = batch.column(0)
        for start in range(0, len(texts), ROWS):
            part = texts.slice(start, ROWS)
            values = np.array([statistics(t.as_py()) for t in part]).T
            yield pa.RecordBatch.from_arrays(
                [*(c.slice(start, ROWS) for c in batch.columns[1:]), *map(pa.array, values)], names=[*batch.schema.names[1:], *STATISTICS]
            )


def with_statistics(frame: DataFrame, text: str = "text", keep: str = "doc_id long") -> DataFrame:
    """The columns of ``keep`` (a DDL string) and the statistics of the text."""
    names = [part.split()[0] for part in keep.split(",")]
    rows = bounded_batches(frame).select(F.col(f"`{text}`").alias("__text"), *names)
    return rows.mapInArrow(_measured, f"{keep}, " + ", ".join(f"{c} double" for c in STATISTICS))


#: A rule: ((statistic's index, above?, bound), ...); all must hold.
Rule = tuple[tuple[int, bool, float], ...]


@dataclass
class RuleModel:
    rules: list[Rule]
    weights: list[float]
    slopes: list[tuple[int, float, float, float]]  # statistic, weight, low, high
    base: float

    def column(self) -> Column:
        """The probability of label 1, over columns named as STATISTICS."""
        total = F.lit(float(self.base))
        for rule, weight in zip(self.rules, self.weights, strict=True):
            holds = F.lit(True)
            for i, above, bound in rule:
                c = F.col(STATISTICS[i])
                holds = holds & (c > bound if above else c <= bound)
            total = total + F.when(holds, float(weight)).otherwise(0.0)
        for i, weight, low, high in self.slopes:
            total = total + F.least(F.greatest(F.col(STATISTICS[i]), F.lit(low)), F.lit(high)) * float(weight)
        return 1 / (1 + F.exp(-total))

    def apply(self, values: np.ndarray) -> np.ndarray:
        """The same for an array of statistics, for checks."""
        total = np.full(len(values), self.base)
        for rule, weight in zip(self.rules, self.weights, strict=True):
            total += weight * rule_holds(rule, values)
        for i, weight, low, high in self.slopes:
            total += weight * np.clip(values[:, i], low, high)
        return 1 / (1 + np.exp(-total))


def rule_holds(rule: Rule, values: np.ndarray) -> np.ndarray:
    out = np.ones(len(values), bool)
    for i, above, bound in rule:
        out &= values[:, i] > bound if above else values[:, i] <= bound
    return out


def _tree(cells, edges, slope, curve, rows, depth, path, rules):
    """Grow a tree on gradients; add every path to ``rules``; the leaves' values."""
    g, h = slope[rows].sum(), curve[rows].sum()
    best, gain = None, 1e-6
    if depth and len(rows) >= 20:
        for i, bounds in enumerate(edges):
            if not len(bounds):
                continue
            gs = np.cumsum(np.bincount(cells[rows, i], slope[rows], len(bounds) + 1))[:-1]
            hs = np.cumsum(np.bincount(cells[rows, i], curve[rows], len(bounds) + 1))[:-1]
            ns = np.cumsum(np.bincount(cells[rows, i], minlength=len(bounds) + 1))[:-1]
            value = gs**2 / (hs + 1) + (g - gs) ** 2 / (h - hs + 1) - g**2 / (h + 1)
            value[(ns < 10) | (len(rows) - ns < 10)] = 0
            if value.max() > gain:
                gain, best = value.max(), (i, int(value.argmax()))
    if best is None:
        return [(rows, -g / (h + 1))]
    i, at = best
    out = []
    for above in (False, True):
        part = rows[(cells[rows, i] > at) == above]
        rule = (*path, (i, above, float(edges[i][at])))
        rules.append(rule)
        out += _tree(cells, edges, slope, curve, part, depth - 1, rule, rules)
    return out


def tree_rules(values: np.ndarray, labels: np.ndarray, trees: int = TREES, depth: int = DEPTH, seed: int = 7) -> list[Rule]:
    edges = [np.unique(np.quantile(values[:, i], np.linspace(0, 1, BINS + 1)[1:-1])) for i in range(values.shape[1])]
    cells = np.stack([np.searchsorted(e, values[:, i], side="left") for i, e in enumerate(edges)], axis=1)
    score, rules, random = np.zeros(len(labels)), [], np.random.default_rng(seed)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        rows = np.flatnonzero(random.random(len(labels)) < 0.7)
        for part, value in _tree(cells, edges, p - labels, p * (1 - p), rows, depth, (), rules):
            score[part] += 0.3 * value
    return list(dict.fromkeys(tuple(sorted(r)) for r in rules))


def _lasso(x: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 400) -> tuple[np.ndarray, float]:
    """Logistic regression with an L1 penalty, by accelerated proximal steps."""
    n, d = x.shape
    v = np.random.default_rng(1).random(d)
    for _ in range(20):  # the largest curvature, for the step
        v = x.T @ (x @ v)
        v /= np.linalg.norm(v) + 1e-12
    step = 1 / (0.25 * (np.linalg.norm(x @ v) ** 2 / n + 1) + 1e-9)
    w, b, z, zb, t = np.zeros(d), float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6))), np.zeros(d), 0.0, 1.0
    zb = b
    for _ in range(rounds):
        error = (1 / (1 + np.exp(-(x @ z + zb))) - y) / n
        new = z - step * (x.T @ error)
        new = np.sign(new) * np.maximum(np.abs(new) - step * penalty, 0)
        new_b = zb - step * error.sum()
        following = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z, zb = new + (t - 1) / following * (new - w), new_b + (t - 1) / following * (new_b - b)
        w, b, t = new, new_b, following
    return w, b


def fit(values: np.ndarray, labels: np.ndarray, penalty: float = PENALTY) -> RuleModel:
    """The rule ensemble of labelled statistics; without both labels, a constant."""
    if not len(labels):
        return RuleModel([], [], [], 0.0)
    if labels.min() == labels.max():
        return RuleModel([], [], [], 4.0 if labels[0] else -4.0)
    rules = tree_rules(values, labels)
    matrix = np.stack([rule_holds(r, values) for r in rules], axis=1).astype(float) if rules else np.empty((len(labels), 0))
    scale = matrix.std(axis=0)
    keep = scale > 1e-3
    rules = [r for r, k in zip(rules, keep, strict=True) if k]
    matrix, scale = matrix[:, keep], scale[keep]
    low, high = np.quantile(values, 0.025, axis=0), np.quantile(values, 0.975, axis=0)
    linear = np.clip(values, low, high)
    spread = linear.std(axis=0)
    x = np.concatenate([(matrix - matrix.mean(axis=0)) / scale, (linear - linear.mean(axis=0)) / np.maximum(spread, 1e-9)], axis=1)
    w, b = _lasso(x, labels.astype(float), penalty)
    k = len(rules)
    weights = w[:k] / scale
    slopes = np.where(spread > 1e-9, w[k:] / np.maximum(spread, 1e-9), 0)
    base = b - float(weights @ matrix.mean(axis=0)) - float(slopes @ linear.mean(axis=0))
    chosen = np.flatnonzero(weights)
    return RuleModel(
        [rules[i] for i in chosen], [float(weights[i]) for i in chosen],
        [(i, float(slopes[i]), float(low[i]), float(high[i])) for i in np.flatnonzero(slopes)], base,
    )


def learn(documents: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> RuleModel:
    """Fit on the labelled rows that aren't held out, at most ``sample`` keys.

    Null labels are ignored; a key with several labels has the largest.
    """
    known = labels.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{label}`").cast("int").alias("label")).filter("doc_id is not null and label is not null")
    known = known.filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("label").alias("label"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = documents.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")).join(checked_broadcast(known), "doc_id")
    found = with_statistics(rows, keep="doc_id long, label int").toPandas().sort_values(["doc_id", *STATISTICS])
    return fit(found[list(STATISTICS)].to_numpy(float), found["label"].to_numpy(int))


def quality_scores(documents: DataFrame, model: RuleModel, key: str = "doc_id", text: str = "text", threshold: float = 0.3) -> DataFrame:
    """doc_id, score (0 to 1) and predicted of each row, from the text alone.

    A null text is scored as an empty one; rows stand for themselves, whatever
    their keys; an empty table gives none.
    """
    rows = documents.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    scored = with_statistics(rows).select("doc_id", model.column().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
