"""Quality classifier: a sparse rule ensemble over text statistics.

Boosted trees of small depth are grown on the statistics of labelled documents;
every path of a tree becomes a conjunctive rule; lasso logistic regression gives the
rules sparse weights; the rules left over are compiled into one Spark column
expression, so scoring is a projection.

Training takes a bounded sample (about MAX_ROWS labelled rows, chosen by a hash of
the id): a few numbers per row reach the driver, never texts.

Defined cases: null or empty texts have all statistics 0 and are scored like any
other; labels that are null are left out; rows repeated in either table count as
often as they stand; without any label every score is 0.5; if only one class is
labelled, the score is its smoothed rate. Extra columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import quality_rules

MAX_ROWS = 20_000
TREES, DEPTH, RATE = 16, 3, 0.3
PENALTY = 2e-4

# Statistic -> SQL over the measurements; all finite, 0 for an empty text.
STATISTICS = {
    "s_words": "ln(1 + n_words)",
    "s_chars": "word_chars / greatest(n_words, 1)",
    "s_symbols": "n_symbols / greatest(n_words, 1)",
    "s_upper": "n_upper / greatest(word_chars, 1)",
    "s_repeat": "n_repeat_words / greatest(n_words, 1)",
    "s_dup_lines": "n_dup_lines / greatest(n_lines, 1)",
    "s_line": "ln(1 + n_words / greatest(n_lines, 1))",
}
NAMES = tuple(STATISTICS)

Rule = tuple[tuple[int, bool, float], ...]  # (statistic, greater, cut): all must hold


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id and the statistics of every document (native expressions)."""
    rows = quality_rules.measure(docs.select("doc_id", text), text)
    return rows.select("doc_id", *(F.expr(f"cast({sql} as double)").alias(n) for n, sql in STATISTICS.items()))


def _grow(x: np.ndarray, g: np.ndarray, h: np.ndarray, cuts: list[np.ndarray], depth: int,
          path: Rule, rules: set[Rule], out: np.ndarray, rows: np.ndarray) -> None:
    """One Newton tree: adds each path to ``rules`` and leaf values to ``out``."""
    total_g, total_h = g[rows].sum(), h[rows].sum()
    best = (1e-6, -1, 0.0)
    if depth:
        for f, c in enumerate(cuts):
            if not len(c):
                continue
            where = np.searchsorted(c, x[rows, f], side="left")  # 0..len: cuts below the value
            gl = np.cumsum(np.bincount(where, g[rows], len(c) + 1))[:-1]
            hl = np.cumsum(np.bincount(where, h[rows], len(c) + 1))[:-1]
            gain = gl ** 2 / (hl + 1) + (total_g - gl) ** 2 / (total_h - hl + 1) - total_g ** 2 / (total_h + 1)
            i = int(gain.argmax())
            if gain[i] > best[0]:
                best = (float(gain[i]), f, float(c[i]))
    _, f, cut = best
    if f < 0:
        out[rows] = -total_g / (total_h + 1)
        return
    for greater in (False, True):
        side = rows[(x[rows, f] > cut) == greater]
        step = (*path, (f, greater, cut))
        rules.add(tuple(sorted(step)))
        if len(side):
            _grow(x, g, h, cuts, depth - 1, step, rules, out, side)


def extract_rules(x: np.ndarray, y: np.ndarray) -> list[Rule]:
    """All paths of the boosted trees."""
    cuts = []
    for f in range(x.shape[1]):
        values = np.unique(np.quantile(x[:, f], np.linspace(0, 1, 65)))
        cuts.append((values[:-1] + values[1:]) / 2)
    rate = y.mean()
    score = np.full(len(y), math.log(rate / (1 - rate)))
    rules: set[Rule] = set()
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-score))
        out = np.zeros(len(y))
        _grow(x, p - y, p * (1 - p), cuts, DEPTH, (), rules, out, np.arange(len(y)))
        score += RATE * out
    return sorted(rules)


def fires(rule: Rule, x: np.ndarray) -> np.ndarray:
    hit = np.ones(len(x), bool)
    for f, greater, cut in rule:
        hit &= (x[:, f] > cut) == greater
    return hit


def lasso_logistic(a: np.ndarray, y: np.ndarray, penalty: float = PENALTY, steps: int = 400):
    """(weights, bias) by accelerated proximal gradient; the bias is not penalised."""
    n = len(y)
    mean = a.mean(axis=0)
    centred = a - mean
    v = np.ones(a.shape[1])
    for _ in range(30):  # largest curvature, by power iteration
        v = centred.T @ (centred @ v)
        v /= max(np.linalg.norm(v), 1e-12)
    rate = 1 / (0.25 * max(np.linalg.norm(centred @ v) ** 2 / n, 1e-9) + 0.25)
    w = z = np.zeros(a.shape[1])
    rate_y = y.mean()
    b = zb = math.log(rate_y / (1 - rate_y))
    t = 1.0
    for _ in range(steps):
        r = 1 / (1 + np.exp(-(centred @ z + zb))) - y
        step = z - rate * centred.T @ r / n
        step = np.sign(step) * np.maximum(np.abs(step) - rate * penalty, 0)
        step_b = zb - rate * r.mean()
        t_next = (1 + math.sqrt(1 + 4 * t * t)) / 2
        z, zb = step + (t - 1) / t_next * (step - w), step_b + (t - 1) / t_next * (step_b - b)
        w, b, t = step, step_b, t_next
    return w, b - float(mean @ w)


@dataclass
class RuleModel:
    """Weighted rules; ``score`` is their compiled expression."""

    rules: list[tuple[Rule, float]]
    bias: float

    def sql(self) -> str:
        terms = [repr(self.bias) + "D"]
        for rule, weight in self.rules:
            when = " AND ".join(f"{NAMES[f]} {'>' if greater else '<='} {cut!r}D" for f, greater, cut in rule)
            terms.append(f"CASE WHEN {when} THEN {weight!r}D ELSE 0.0D END")
        return f"1 / (1 + exp(-({' + '.join(terms)})))"

    def score(self) -> Column:
        return F.expr(self.sql())


def train(stats: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> RuleModel:
    """Fit on statistics joined with (doc_id, quality) labels; of more than ``max_rows``
    pairs a hash of both row numbers draws about so many, also where rows repeat."""
    number = F.monotonically_increasing_id()
    rows = stats.select("doc_id", *NAMES, number.alias("_at")).join(
        labels.where("quality is not null").select("doc_id", "quality", number.alias("_label")), "doc_id")
    total = rows.count()
    if not total:
        return RuleModel([], 0.0)
    drawn = F.pmod(F.xxhash64(F.lit(4), "doc_id", "_at", "_label"), F.lit(1_000_003)) / F.lit(1_000_003.0)
    got = (rows.where(drawn < max_rows / total) if total > max_rows else rows).toArrow().sort_by(
        [("doc_id", "ascending"), ("_at", "ascending"), ("_label", "ascending")])
    x = np.column_stack([got[n].to_numpy() for n in NAMES])
    y = (got["quality"].to_numpy() > 0).astype(float)
    if y.min() == y.max():
        rate = (y.sum() + 1) / (len(y) + 2)
        return RuleModel([], math.log(rate / (1 - rate)))
    rules = extract_rules(x, y)
    a = np.column_stack([fires(r, x) for r in rules]).astype(float)
    w, bias = lasso_logistic(a, y)
    return RuleModel([(r, float(v)) for r, v in zip(rules, w) if abs(v) > 1e-3], float(bias))


def predict(stats: DataFrame, model: RuleModel, threshold: float = 0.3) -> DataFrame:
    """Add score and predicted (1 from the threshold on)."""
    return stats.withColumn("score", model.score()).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))
