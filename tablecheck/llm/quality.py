"""Quality classifier: a sparse ensemble of rules over text statistics.

Statistics of whole texts are Spark column expressions. Shallow trees are boosted on labelled rows; every
path from a root to any node below is a rule, a conjunction of bounds on statistics. A lasso logistic
regression weighs the rules and leaves most of them out, and what remains is compiled into one Spark
column expression: scoring runs no Python.

Fitting takes at most ``SAMPLE_ROWS`` labelled rows (those with the smallest hash of their id, so the
choice is the same in every run); everything else covers all rows. Labels, language, source and ids are
no inputs of a score.

Cases: null and empty texts have all statistics 0 and are scored like others; null labels are left out;
repeated rows are scored each, and a repeated label counts as often; without labels of both kinds the
score is their share (0.5 if there are none); an empty table gives an empty result. Other columns are
kept by ``with_score``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 10_000
TREES, TREE_DEPTH, LEAST_LEAF, BINS, RATE = 24, 3, 10, 32, 0.3
LASSO = 2e-3

SYMBOLS = "#$%&*+/<=>@[\\]^_`{|}~"
MARKS = "!?"
STOPS = ".,;:"
DIGITS = "0123456789"
WORD_BREAK = r"[\x20\x09-\x0D]+"


def _count(text: Column, characters: str) -> Column:
    return F.char_length(text) - F.char_length(F.translate(text, characters, ""))


def with_statistics(docs: DataFrame, text: str = "text") -> tuple[DataFrame, list[str]]:
    """``docs`` with one column per statistic, and their names; each text is searched once per kind."""
    t = F.coalesce(F.col(text), F.lit(""))
    counts = docs.select(
        "*",
        F.char_length(t).cast("double").alias("c_chars"),
        _count(t, SYMBOLS).alias("c_symbols"),
        _count(t, MARKS).alias("c_marks"),
        _count(t, STOPS).alias("c_stops"),
        _count(t, DIGITS).alias("c_digits"),
        F.regexp_count(t, F.lit(r"\p{Lu}")).alias("c_upper"),
        F.regexp_count(t, F.lit(r"\p{L}")).alias("c_letters"),
        F.split(F.trim(t), WORD_BREAK).alias("c_words"),
        F.split(t, "\n").alias("c_lines"),
    )
    sized = counts.select(
        *docs.columns,
        *[c for c in counts.columns[len(docs.columns) :] if c not in ("c_words", "c_lines")],
        F.size("c_words").cast("double").alias("c_n_words"),
        F.size(F.array_distinct("c_words")).cast("double").alias("c_distinct_words"),
        F.size("c_lines").cast("double").alias("c_n_lines"),
        F.size(F.array_distinct("c_lines")).cast("double").alias("c_distinct_lines"),
    )

    def share(part: str, whole: str) -> Column:
        return F.when(F.col("c_chars") > 0, F.col(part) / F.col(whole)).otherwise(0.0)

    statistics = {
        "s_log_chars": F.log1p("c_chars"),
        "s_word_chars": share("c_chars", "c_n_words"),
        "s_symbols": share("c_symbols", "c_chars"),
        "s_marks": share("c_marks", "c_chars"),
        "s_stops": share("c_stops", "c_n_words"),
        "s_digits": share("c_digits", "c_chars"),
        "s_upper": share("c_upper", "c_chars"),
        "s_letters": share("c_letters", "c_chars"),
        "s_distinct_words": share("c_distinct_words", "c_n_words"),
        # Texts use fewer distinct words the longer they are.
        "s_word_variety": F.when(
            F.col("c_chars") > 0, F.log1p("c_distinct_words") / F.log1p("c_n_words")
        ).otherwise(0.0),
        "s_distinct_lines": share("c_distinct_lines", "c_n_lines"),
    }
    out = sized.select(*docs.columns, *[e.cast("double").alias(n) for n, e in statistics.items()])
    return out, list(statistics)


@dataclass(frozen=True)
class Rule:
    """All of ``(statistic, at_most, bound)``: value <= bound, or value > bound."""

    bounds: tuple[tuple[str, bool, float], ...]
    weight: float = 0.0

    def column(self) -> Column:
        parts = [F.col(s) <= F.lit(b) if low else F.col(s) > F.lit(b) for s, low, b in self.bounds]
        both = parts[0]
        for p in parts[1:]:
            both = both & p
        return F.when(both, F.lit(self.weight)).otherwise(F.lit(0.0))

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        out = np.ones(len(next(iter(x.values()))), dtype=bool)
        for s, low, b in self.bounds:
            out &= x[s] <= b if low else x[s] > b
        return out


@dataclass(frozen=True)
class RuleModel:
    intercept: float
    rules: tuple[Rule, ...]

    def column(self) -> Column:
        """The score as an expression over the statistics' columns, between 0 and 1."""
        z = F.lit(self.intercept)
        for rule in self.rules:
            z = z + rule.column()
        return 1.0 / (1.0 + F.exp(-z))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def tree_paths(x: dict[str, np.ndarray], y: np.ndarray) -> list[Rule]:
    """Rules of boosted trees: every path from a root to a node below it, each once."""
    cuts = {}
    for s, v in x.items():
        at = np.unique(np.quantile(v, np.linspace(0, 1, BINS + 1)[1:-1]))
        cuts[s] = at[at < v.max()]
    bins = {s: np.searchsorted(c, x[s], side="left") for s, c in cuts.items()}
    z = np.full(len(y), np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    found: dict[tuple, None] = {}
    for _ in range(TREES):
        p = _sigmoid(z)
        gradient, hessian = y - p, p * (1 - p)
        nodes = [((), np.arange(len(y)))]
        for _ in range(TREE_DEPTH):
            nodes = [child for node in nodes for child in _split(node, bins, cuts, gradient, hessian)]
        for bounds, rows in nodes:
            z[rows] += RATE * gradient[rows].sum() / (hessian[rows].sum() + 1.0)
            for depth in range(1, len(bounds) + 1):
                found.setdefault(tuple(sorted(bounds[:depth])))
    return [Rule(bounds) for bounds in found]


def _split(node, bins, cuts, gradient, hessian):
    bounds, rows = node
    g, h = gradient[rows], hessian[rows]
    best, choice = 1e-6, None
    whole = g.sum() ** 2 / (h.sum() + 1.0)
    for s, b in bins.items():
        n_bins = len(cuts[s]) + 1
        if n_bins < 2:
            continue
        at = b[rows]
        left_g = np.cumsum(np.bincount(at, g, n_bins))[:-1]
        left_h = np.cumsum(np.bincount(at, h, n_bins))[:-1]
        left_n = np.cumsum(np.bincount(at, minlength=n_bins))[:-1]
        gain = left_g**2 / (left_h + 1.0) + (g.sum() - left_g) ** 2 / (h.sum() - left_h + 1.0) - whole
        gain[(left_n < LEAST_LEAF) | (len(rows) - left_n < LEAST_LEAF)] = -1
        if gain.max() > best:
            best, choice = gain.max(), (s, int(gain.argmax()))
    if choice is None:
        return [node]
    s, k = choice
    low = bins[s][rows] <= k
    bound = float(cuts[s][k])
    return [
        (bounds + ((s, True, bound),), rows[low]),
        (bounds + ((s, False, bound),), rows[~low]),
    ]


def lasso_logistic(a: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 400):
    """Intercept and weights of the penalised mean log loss, by accelerated proximal gradients."""
    n, k = a.shape
    w, intercept = np.zeros(k), float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    full = np.hstack([a, np.ones((n, 1))])
    v = np.ones(k + 1)
    for _ in range(20):  # the largest eigenvalue bounds the curvature
        v = full.T @ (full @ v)
        norm = np.linalg.norm(v)
        v /= norm
    step = 4.0 * n / norm
    x = np.append(w, intercept)
    ahead, t = x.copy(), 1.0
    for _ in range(rounds):
        new = ahead - step * (full.T @ (_sigmoid(full @ ahead) - y)) / n
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - step * penalty, 0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, x, t = new + (t - 1) / t_new * (new - x), new, t_new
    return float(x[-1]), x[:-1]


def fit(rows: list[dict], names: list[str]) -> RuleModel:
    """``rows`` have the statistics and ``quality``."""
    y = np.array([r["quality"] for r in rows], dtype=float)
    if len(y) == 0 or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1.0)
        return RuleModel(float(np.log(share / (1 - share))), ())
    x = {s: np.array([r[s] for r in rows], dtype=float) for s in names}
    rules = tree_paths(x, y)
    if not rules:
        return RuleModel(float(np.log(y.mean() / (1 - y.mean()))), ())
    a = np.stack([r.holds(x) for r in rules], axis=1).astype(float)
    intercept, weights = lasso_logistic(a, y, LASSO)
    kept = [Rule(r.bounds, float(w)) for r, w in zip(rules, weights, strict=True) if abs(w) > 1e-6]
    return RuleModel(intercept, tuple(kept))


def held_out(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 3, is 1; a null id is as the empty text."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 3 == 1


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> RuleModel:
    """Fits on at most ``sample_rows`` labels, none of them held out.

    Documents that share a labelled id are one of them, the one with the least hash of its text: no more
    rows than labels come to the driver.
    """
    chosen = (
        labels.where("quality is not null and doc_id is not null")
        .where(~held_out())
        .select("doc_id", F.col("quality").cast("int").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "quality")
        .limit(sample_rows)
    )
    # At most sample_rows rows of two numbers: a broadcast of a proven size.
    labelled = docs.select("doc_id", "text").join(F.broadcast(chosen.select("doc_id").distinct()), "doc_id")
    first = F.min(F.struct(F.xxhash64("text").alias("hash"), "text"))
    texts = labelled.groupBy("doc_id").agg(first["text"].alias("text"))
    measured, names = with_statistics(texts.join(F.broadcast(chosen), "doc_id"))
    rows = measured.select("quality", *names).collect()
    return fit([r.asDict() for r in rows], names)


def with_score(docs: DataFrame, model: RuleModel) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``, which replace columns of these names."""
    inner = docs.select(F.struct(*docs.columns).alias("doc"), "text")
    measured, names = with_statistics(inner)
    # A generator of one row stands between statistics and rules. Without it, a caller's filter on the
    # score would be moved below both, with every statistic worked out again for each rule.
    one = F.explode(F.array(F.struct(*names))).alias("statistics")
    scored = measured.select("doc", one).select("doc", "statistics.*")
    scored = scored.select("doc", model.column().alias("score"))
    kept = [c for c in docs.columns if c.lower() not in ("score", "predicted")]
    return scored.select(
        *[F.col("doc").getField(c).alias(c) for c in kept],
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
