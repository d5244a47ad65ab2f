"""Operator 5: text quality by a sparse ensemble of rules.

Shallow trees are grown on bootstrap samples of labelled documents.  Every path
from a root becomes a rule, a conjunction of comparisons of text statistics.  A
logistic model with an L1 penalty weighs the rules; most weights are zero.  The
rest compiles into one Spark expression, so scoring reads each text once and
runs in generated code.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalloom.llm.common import whole_text

#: Labelled rows that a fit may read at most, those with the smallest hash of doc_id.
MAX_LABELLED = 20_000
ACCEPT = 0.7

_SYMBOLS = "#$%&*<>{}[]|\\^~=_@"


def statistics(docs: DataFrame) -> DataFrame:
    """``docs`` with the columns ``_s_<statistic>``; a null text is empty, an empty one all zeros."""
    text = F.col("_t")
    chars = F.greatest(F.length(text), F.lit(1)).cast("double")

    def share(kept: str) -> Column:
        return F.length(F.regexp_replace(text, f"[^{kept}]+", "")) / chars

    def count(mark: str) -> Column:
        return (F.octet_length(text) - F.octet_length(F.replace(text, F.lit(mark), F.lit("")))) / len(mark)

    words, lines = F.col("_w"), F.col("_l")
    n_words, n_lines = F.greatest(F.size(words), F.lit(1)), F.greatest(F.size(lines), F.lit(1))
    staged = (
        docs.withColumn("_t", whole_text())
        .withColumn("_w", F.filter(F.split("_t", r"\s+"), lambda w: w != ""))
        .withColumn("_l", F.filter(F.split("_t", "\n"), lambda line: line != ""))
    )
    values = {
        "log_chars": F.log1p(F.length(text).cast("double")),
        "word_chars": F.length(text) / n_words,
        "upper": share("A-Z"),
        "digits": share("0-9"),
        "letters": share("A-Za-zÀ-ÿ"),
        "symbols": share(_SYMBOLS.replace("\\", r"\\").replace("[", r"\[").replace("]", r"\]").replace("^", r"\^").replace("&", r"\&")),
        "bangs": count("!") / chars,
        "bars": count("|") / chars,
        "stops": count(".") / n_words,
        "commas": count(",") / n_words,
        "distinct_words": F.size(F.array_distinct(words)) / n_words,
        "line_words": n_words / n_lines,
        "distinct_lines": F.size(F.array_distinct(lines)) / n_lines,
        "links": (count("http") + count("www.")) / n_words,
    }
    return staged.withColumns({f"_s_{k}": v.cast("double") for k, v in values.items()}).drop("_t", "_w", "_l")


STATISTICS = (
    "log_chars",
    "word_chars",
    "upper",
    "digits",
    "letters",
    "symbols",
    "bangs",
    "bars",
    "stops",
    "commas",
    "distinct_words",
    "line_words",
    "distinct_lines",
    "links",
)

Condition = tuple[int, bool, float]  # statistic, above, threshold
Rule = tuple[Condition, ...]


def _split(x: np.ndarray, y: np.ndarray, features: np.ndarray, least: int) -> tuple[int, float] | None:
    """The statistic and threshold that lower the Gini impurity most."""
    best, best_gain, n, ones = None, 1e-9, len(y), y.sum()
    whole = ones * (n - ones) / n
    for j in features:
        order = np.argsort(x[:, j], kind="stable")
        v, t = x[order, j], np.cumsum(y[order])
        left = np.arange(1, n)
        right = n - left
        a, b = t[:-1], ones - t[:-1]
        gain = whole - a * (left - a) / left - b * (right - b) / right
        gain[(v[1:] <= v[:-1]) | (left < least) | (right < least)] = -1.0
        k = int(np.argmax(gain)) if len(gain) else 0
        if len(gain) and gain[k] > best_gain:
            best, best_gain = (int(j), float((v[k] + v[k + 1]) / 2)), float(gain[k])
    return best


def tree_rules(x: np.ndarray, y: np.ndarray, rng: np.random.Generator, depth: int, least: int) -> list[Rule]:
    """The paths to every node of one tree grown on ``x`` and ``y``."""
    rules, todo = [], [((), np.arange(len(y)), depth)]
    while todo:
        path, rows, left = todo.pop()
        if path:
            rules.append(path)
        if left == 0 or len(rows) < 2 * least or y[rows].min() == y[rows].max():
            continue
        features = rng.choice(x.shape[1], max(2, x.shape[1] // 2), replace=False)
        found = _split(x[rows], y[rows], features, least)
        if found is None:
            continue
        j, cut = found
        above = x[rows, j] > cut
        todo.append(((*path, (j, True, cut)), rows[above], left - 1))
        todo.append(((*path, (j, False, cut)), rows[~above], left - 1))
    return rules


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for j, above, cut in rule:
        out &= (x[:, j] > cut) == above
    return out


def lasso_logistic(z: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 400) -> tuple[float, np.ndarray]:
    """Intercept and L1-penalised weights by accelerated proximal gradient steps."""
    n, m = z.shape
    design = np.hstack([np.ones((n, 1)), z])
    probe = np.ones(m + 1)
    for _ in range(30):
        probe = design.T @ (design @ probe)
        probe /= np.linalg.norm(probe) or 1.0
    step = 4 * n / max(float(np.linalg.norm(design @ probe)) ** 2, 1e-9)
    w = look = np.zeros(m + 1)
    momentum = 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ look, -30, 30)))
        moved = look - step * (design.T @ (p - y)) / n
        shrunk = np.sign(moved) * np.maximum(np.abs(moved) - step * penalty, 0)
        shrunk[0] = moved[0]
        faster = (1 + math.sqrt(1 + 4 * momentum**2)) / 2
        look = shrunk + (momentum - 1) / faster * (shrunk - w)
        w, momentum = shrunk, faster
    return float(w[0]), w[1:]


@dataclass
class RuleModel:
    """Weighted rules over ``STATISTICS``."""

    intercept: float
    weighted: list[tuple[Rule, float]] = field(default_factory=list)

    def score(self) -> Column:
        """The probability of label 1, from the statistic columns."""
        total = F.lit(self.intercept)
        for rule, weight in self.weighted:
            holds_all = F.lit(True)
            for j, above, cut in rule:
                value = F.col(f"_s_{STATISTICS[j]}")
                holds_all = holds_all & (value > cut if above else value <= cut)
            total = total + F.when(holds_all, F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

    def describe(self) -> list[str]:
        """The rules in words, the heaviest first."""
        ordered = sorted(self.weighted, key=lambda r: -abs(r[1]))
        return [
            f"{w:+.3f} if " + " and ".join(f"{STATISTICS[j]} {'>' if a else '<='} {c:.4g}" for j, a, c in rule)
            for rule, w in ordered
        ]


def fit_rules(
    x: np.ndarray, y: np.ndarray, trees: int = 24, depth: int = 3, least: int = 8, penalty: float = 0.0008, seed: int = 7
) -> RuleModel:
    """A rule model of statistics ``x`` and labels ``y`` (0 or 1).

    Without rows the score is a half; with one label only, a constant near it.
    """
    if len(y) == 0:
        return RuleModel(0.0)
    base = (y.sum() + 1) / (len(y) + 2)
    if y.min() == y.max():
        return RuleModel(math.log(base / (1 - base)))
    rng, rules = np.random.default_rng(seed), {}
    for _ in range(trees):
        rows = rng.integers(0, len(y), min(len(y), 4000))
        for rule in tree_rules(x[rows], y[rows], rng, depth, least):
            covered = holds(rule, x)
            if 0 < covered.sum() < len(y):
                rules.setdefault(covered.tobytes(), (rule, covered))
    kept = list(rules.values())
    z = np.stack([c for _, c in kept], axis=1).astype(float) if kept else np.zeros((len(y), 0))
    intercept, weights = lasso_logistic(z, y.astype(float), penalty)
    return RuleModel(intercept, [(r, float(w)) for (r, _), w in zip(kept, weights, strict=True) if abs(w) > 1e-6])


def is_held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> RuleModel:
    """Fit on at most ``max_labelled`` labelled documents that are not held out.

    Rows without a label or doc_id are left out, of repeated doc_ids one row is
    used.  The chosen labels are few by their bound, so they are broadcast.
    """
    usable = labels.where(~is_held_out() & F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    chosen = (
        usable.groupBy("doc_id")
        .agg(F.max("quality").alias("_label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_labelled)
    )
    rows = statistics(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"))
    # one row per label, so no more than there are labels
    one = rows.groupBy("doc_id").agg(F.min(F.struct("_label", *[f"_s_{s}" for s in STATISTICS])).alias("_row"))
    collected = sorted((r[0], tuple(r[1])) for r in one.collect())
    y = np.array([r[1][0] for r in collected], int)
    x = np.array([r[1][1:] for r in collected], float).reshape(len(y), len(STATISTICS))
    return fit_rules(x, y)


def score_quality(docs: DataFrame, model: RuleModel, accept: float = ACCEPT) -> DataFrame:
    """``docs`` with columns ``score`` and ``predicted`` (existing ones are replaced)."""
    scored = statistics(docs).withColumn("score", model.score())
    scored = scored.withColumn("predicted", (F.col("score") >= accept).cast("int"))
    return scored.drop(*[f"_s_{s}" for s in STATISTICS])
