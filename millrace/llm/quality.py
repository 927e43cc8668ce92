"""Quality classifier as a sparse rule ensemble over text statistics.

Statistics are Spark column expressions. Trees grown by boosting on a bounded sample of labelled rows are taken apart into
conjunctive rules (one per path); an L1-penalised logistic regression keeps a few of them; the kept rules become one Spark
expression, so scoring the corpus is a projection without Python.

Defined results: a null or empty text has all statistics 0 and gets the score of its rules; labels without a document or
without ``quality`` are left out; repeated rows are scored each; without labels of both kinds the score is the smoothed share
of label 1 (0.5 if there are none); an empty table gives an empty result; extra columns are ignored by ``score`` and kept by
``keep_good``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bound of the labelled sample that is sent to the driver (rows of a few dozen numbers), taken by hash of the document id.
SAMPLE = 8_000
TREES, DEPTH, LEAF = 60, 3, 12
PENALTY = 0.002


def statistics() -> dict[str, Column]:
    """Named statistics over a text and its words and lines; all finite, 0 for an empty text."""
    t, words, lines = F.col("_t"), F.col("_words"), F.col("_lines")
    n = F.greatest(F.length(t), F.lit(1)).cast("double")
    n_words = F.greatest(F.size(words), F.lit(1)).cast("double")
    n_lines = F.greatest(F.size(lines), F.lit(1)).cast("double")
    share = lambda chars: (F.length(t) - F.length(F.translate(t, chars, ""))) / n
    pairs = F.zip_with(words, F.slice(words, 2, F.greatest(F.size(words), F.lit(1))), lambda a, b: a == b)
    return {
        "words": F.size(words).cast("double"),
        "word_length": (n - F.size(words)) / n_words,
        "upper": share("ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        "digits": share("0123456789"),
        "sentence_marks": share(".,"),
        "loud": share("!?"),
        "symbols": share("#$%&*@^~=+<>\\/_"),
        "brackets": share("|{}[]();:"),
        "distinct_words": F.size(F.array_distinct(words)) / n_words,
        "distinct_lines": F.size(F.array_distinct(lines)) / n_lines,
        "words_a_line": F.size(words) / n_lines,
        "repeats": F.size(F.filter(pairs, lambda x: x)) / n_words,
        "short_words": F.size(F.filter(words, lambda w: F.length(w) <= 3)) / n_words,
        "long_words": F.size(F.filter(words, lambda w: F.length(w) > 14)) / n_words,
        "ends": F.when(F.substring(F.rtrim(t), -1, 1).isin(".", "!", "?", '"'), 1.0).otherwise(0.0),
    }


def with_statistics(docs: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Documents as a struct ``d`` beside statistics (all, or those named) as columns _s_<name>.

    The text, its words and its lines are columns of their own first, for all statistics to share.
    """
    wanted = {k: c for k, c in statistics().items() if names is None or k in names}
    parts = docs.select(F.struct("*").alias("d")).withColumn("_t", F.coalesce(F.col("d.text").cast("string"), F.lit("")))
    parts = parts.withColumn("_words", F.array_remove(F.split("_t", r"[ \n\t\r\f\x0B]"), "")).withColumn("_lines", F.array_remove(F.split("_t", "\n"), ""))
    return parts.select("d", *(c.cast("double").alias(f"_s_{k}") for k, c in wanted.items()))


@dataclass
class RuleModel:
    names: list[str]
    rules: list[tuple[tuple[int, bool, float], ...]] = field(default_factory=list)  # (feature, above, bound), all must hold
    weights: list[float] = field(default_factory=list)
    bias: float = 0.0

    def score(self, features: dict[str, Column]) -> Column:
        """The rules as one column: logistic of the sum of the weights whose conditions hold."""
        total = F.lit(self.bias)
        for rule, weight in zip(self.rules, self.weights, strict=True):
            test = None
            for k, above, bound in rule:
                one = features[self.names[k]] > bound if above else features[self.names[k]] <= bound
                test = one if test is None else test & one
            total = total + F.when(test, F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

    def used(self) -> list[str]:
        return sorted({self.names[k] for rule in self.rules for k, _, _ in rule})

    def predict(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.bias + holds(self.rules, x) @ np.array(self.weights)))) if self.rules else np.full(len(x), 1 / (1 + np.exp(-self.bias)))


def holds(rules: list, x: np.ndarray) -> np.ndarray:
    """Which rules hold on which rows, as bytes."""
    out = np.ones((len(x), len(rules)), bool)
    for j, rule in enumerate(rules):
        for k, above, bound in rule:
            out[:, j] &= x[:, k] > bound if above else x[:, k] <= bound
    return out


def grow(x: np.ndarray, residual: np.ndarray, rows: np.ndarray, columns: np.ndarray, depth: int, path: tuple = ()) -> list[tuple[tuple, np.ndarray]]:
    """Paths of a regression tree with their rows; splits take the largest drop of squared error at quantile bounds."""
    best = (1e-9, None)
    if depth and len(rows) >= 2 * LEAF:
        r = residual[rows]
        base = r.sum() ** 2 / len(rows)
        for k in columns:
            v = x[rows, k]
            for bound in np.unique(np.quantile(v, np.linspace(0.02, 0.98, 25))):
                low = v <= bound
                n = int(low.sum())
                if LEAF <= n <= len(rows) - LEAF:
                    s = r[low].sum()
                    gain = s * s / n + (r.sum() - s) ** 2 / (len(rows) - n) - base
                    if gain > best[0]:
                        best = (gain, (int(k), float(bound)))
    if best[1] is None:
        return [(path, rows)] if path else []
    k, bound = best[1]
    low = x[rows, k] <= bound
    sides = [*grow(x, residual, rows[low], columns, depth - 1, (*path, (k, False, bound))), *grow(x, residual, rows[~low], columns, depth - 1, (*path, (k, True, bound)))]
    return ([(path, rows)] if path else []) + sides


def lasso(z: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 600) -> tuple[np.ndarray, float]:
    """L1-penalised logistic regression by accelerated proximal gradient; the bias is free."""
    a = np.c_[z, np.ones(len(z), bool)].astype(np.float32)
    step = 4 * len(y) / max(np.linalg.eigvalsh(a.T @ a)[-1], 1e-9)
    w = v = np.zeros(a.shape[1])
    t = 1.0
    for _ in range(rounds):
        g = a.T @ (1 / (1 + np.exp(-np.clip(a @ v, -30, 30))) - y) / len(y)
        u = v - step * g
        new = np.sign(u) * np.maximum(np.abs(u) - step * penalty, 0)
        new[-1] = u[-1]
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, w, t = new + (t - 1) / t2 * (new - w), new, t2
    return w[:-1], float(w[-1])


def fit(x: np.ndarray, y: np.ndarray, names: list[str], trees: int = TREES, penalty: float = PENALTY, seed: int = 7) -> RuleModel:
    prior = (y.sum() + 1) / (len(y) + 2)
    model = RuleModel(names, bias=float(np.log(prior / (1 - prior))))
    if len(y) < 4 * LEAF or y.min() == y.max():
        return model
    rng = np.random.default_rng(seed)
    margin, paths = np.full(len(y), model.bias), {}
    for _ in range(trees):
        residual = y - 1 / (1 + np.exp(-margin))
        rows = rng.choice(len(y), max(4 * LEAF, len(y) // 2), replace=True)
        columns = rng.choice(x.shape[1], max(1, x.shape[1] * 2 // 3), replace=False)
        grown = grow(x, residual, np.unique(rows), columns, DEPTH)
        for path, at in grown:
            paths[path] = None
        for path, at in grown:
            if len(path) == max(len(p) for p, _ in grown):
                inside = holds([path], x)[:, 0]
                p = 1 / (1 + np.exp(-margin[inside]))
                margin[inside] += 0.3 * (residual[inside].sum() / max((p * (1 - p)).sum(), 1e-3))
        margin = np.clip(margin, -8, 8)
    rules = list(paths)
    # rules that hold on the same rows are one
    rules = list({holds([rule], x).tobytes(): rule for rule in reversed(rules)}.values())
    weights, bias = lasso(holds(rules, x), y, penalty)
    chosen = [i for i in np.argsort(-np.abs(weights)) if abs(weights[i]) > 1e-4]
    return RuleModel(names, [rules[i] for i in chosen], [float(weights[i]) for i in chosen], bias)


def held_out(column: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(3)) == 1


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> RuleModel:
    """Learn from labels of rows that aren't held out; at most ``sample`` labels, the first by hash of the document id."""
    stats = list(statistics())
    known = labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL").filter(~held_out())
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(sample).select(F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("_y"))
    # at most ``sample`` rows of two numbers: bounded, so the texts need no shuffle
    rows = docs.select("doc_id", "text").join(F.broadcast(known), F.col("doc_id") == F.col("_id"))
    rows = with_statistics(rows).select("d._y", *(F.col(f"_s_{k}").alias(k) for k in stats)).toPandas()
    return fit(rows[stats].to_numpy(float), (rows["_y"].to_numpy() > 0).astype(float), stats)


def score(docs: DataFrame, model: RuleModel) -> DataFrame:
    """doc_id, held_out, score and prediction of every document."""
    wide = with_statistics(docs.select("doc_id", "text"), model.used())
    score = model.score({k: F.col(f"_s_{k}") for k in model.used()})
    scored = wide.select("d.doc_id", F.coalesce(held_out("d.doc_id"), F.lit(False)).alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def keep_good(docs: DataFrame, model: RuleModel, least: float = 0.5) -> DataFrame:
    """Rows whose score is at least ``least``, with their own columns."""
    wide = with_statistics(docs, model.used())
    return wide.filter(model.score({k: F.col(f"_s_{k}") for k in model.used()}) >= least).select("d.*")
