"""Quality classifier: a sparse rule ensemble, compiled into column expressions.

Small boosted trees over statistics of a text propose conjunctive rules, one for the path to each node; a logistic
regression with an L1 penalty keeps few of them. Statistics and rules are DataFrame expressions, so that scoring is one
pass inside Spark without a shuffle; only the fit runs on the driver, over a bounded sample of labelled rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import held
from .spotsigs import ANCHORS

#: Labelled rows that a fit uses at most, chosen by a hash of their id; with 20 statistics each, 3 MB on the driver.
SAMPLE = 16_000
TREES, DEPTH, BINS, SHRINKAGE = 40, 3, 32, 0.3
#: Weight of the L1 penalty, and steps of the fit.
PENALTY, STEPS = 3e-3, 300
FOLDS = 5
THRESHOLD = 0.3


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _count(pattern: str) -> Column:
    """Characters of the text that are not in the class whose complement's runs the pattern names."""
    return F.length(F.regexp_replace("_text", pattern, ""))


def with_statistics(docs: DataFrame, text: str = "text") -> tuple[DataFrame, list[str]]:
    """``docs`` in the one column ``_row``, and its statistics, columns ``_s_...``; a null or empty text has zeros."""
    common = sorted({w for ws in ANCHORS.values() for w in ws})
    docs = held(docs, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    docs = docs.withColumn("_words", F.array_remove(F.split("_text", r"\s+"), "")).withColumn("_lines", F.array_remove(F.split("_text", r"\s*\n\s*"), ""))
    docs = docs.withColumns({
        "_n": F.length("_text").cast("double"), "_w": F.size("_words").cast("double"), "_l": F.size("_lines").cast("double"),
        "_upper": _count(r"[^\p{Lu}]+"), "_letters": _count(r"[^\p{L}]+"), "_digits": _count(r"[^0-9]+"), "_spaces": _count(r"\S+"), "_ends": _count(r"[^.!?]+"), "_commas": _count(r"[^,;:]+"), "_bars": _count(r"[^|]+"), "_shouts": _count(r"[^!]+"),
        "_marks": _count(r"[^#$%&*@^~=+<>\\/{}\[\]]+"),
        "_kinds": F.size(F.array_distinct("_words")), "_line_kinds": F.size(F.array_distinct("_lines")),
        "_same": F.size(F.filter("_words", lambda w, i: w == F.get("_words", i - 1))),
        "_common": F.size(F.filter("_words", lambda w: F.lower(F.rtrim(w, F.lit(".,;:!?"))).isin(common))),
    })
    n, w, lines = F.col("_n"), F.col("_w"), F.col("_l")
    stats = {
        "length": F.log1p(n), "words": F.log1p(w), "lines": F.log1p(lines), "word_length": _share(n - F.col("_spaces"), w), "line_words": _share(w, lines),
        "upper": _share(F.col("_upper"), F.col("_letters")), "letters": _share(F.col("_letters"), n), "digits": _share(F.col("_digits"), n), "spaces": _share(F.col("_spaces"), n),
        "ends": _share(F.col("_ends"), w), "commas": _share(F.col("_commas"), w), "bars": _share(F.col("_bars"), w), "shouts": _share(F.col("_shouts"), w), "marks": _share(F.col("_marks"), w),
        "kinds": _share(F.col("_kinds"), F.sqrt(w)), "fresh": _share(F.col("_kinds"), w), "fresh_lines": _share(F.col("_line_kinds"), lines), "same": _share(F.col("_same"), w), "common": _share(F.col("_common"), w),
    }
    # a filter on what rules say would be pushed below, with every statistic worked out anew for each term; it stops at the explode
    one = F.explode(F.array(F.struct(*[v.cast("double").alias(f"_s_{k}") for k, v in stats.items()])))
    return docs.select("_row", one.alias("_s")).select("_row", "_s.*"), [f"_s_{k}" for k in stats]


@dataclass(frozen=True)
class Rule:
    """A conjunction of (statistic, above?, bound): value > bound, or value <= bound."""

    terms: tuple[tuple[str, bool, float], ...]

    def column(self) -> Column:
        out = F.lit(True)
        for name, above, bound in self.terms:
            out = out & (F.col(name) > bound if above else F.col(name) <= bound)
        return out

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return np.logical_and.reduce([x[n] > b if above else x[n] <= b for n, above, b in self.terms])


@dataclass(frozen=True)
class Model:
    """The chance of label 1: the logistic function of ``base`` and the weights of the rules that hold."""

    base: float
    rules: tuple[tuple[Rule, float], ...]

    def column(self) -> Column:
        total = F.lit(self.base)
        for rule, weight in self.rules:
            total = total + F.when(rule.column(), F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def _rules_of_tree(binned: np.ndarray, edges: list[np.ndarray], names: list[str], gradient: np.ndarray, weight: np.ndarray) -> tuple[list[Rule], np.ndarray]:
    """The rules of one tree grown on a gradient, and its step for every row."""
    rules, step = [], np.zeros(len(gradient))

    def gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
        return g * g / (h + 1.0)

    def grow(rows: np.ndarray, terms: tuple, depth: int) -> None:
        g, h = gradient[rows], weight[rows]
        if terms:
            # a bound that a later one of the same statistic and side tightens goes
            last = {(n, above): (n, above, b) for n, above, b in terms}
            rules.append(Rule(tuple(last.values())))
        best = (1e-9, 0, 0)
        if depth < DEPTH and len(rows) >= 20:
            for f in range(binned.shape[1]):
                if len(edges[f]):
                    sums = [np.cumsum(np.bincount(binned[rows, f], v, len(edges[f]) + 1))[:-1] for v in (g, h, np.ones(len(rows)))]
                    found = gain(sums[0], sums[1]) + gain(g.sum() - sums[0], h.sum() - sums[1]) - gain(g.sum(), h.sum())
                    found = np.where((sums[2] >= 5) & (len(rows) - sums[2] >= 5), found, 0)
                    k = int(found.argmax())
                    if found[k] > best[0]:
                        best = (float(found[k]), f, k)
        if best[0] <= 1e-9:
            step[rows] = g.sum() / (h.sum() + 1.0)
            return
        _, f, k = best
        left = binned[rows, f] <= k
        for side, above in ((left, False), (~left, True)):
            grow(rows[side], (*terms, (names[f], above, float(edges[f][k]))), depth + 1)

    grow(np.arange(len(gradient)), (), 0)
    return rules, step


def _lasso(held: np.ndarray, y: np.ndarray, penalty: float) -> tuple[float, np.ndarray]:
    """Intercept and weights of logistic regression with an L1 penalty, by accelerated proximal steps."""
    n, means = len(y), held.mean(axis=0)
    # the largest eigenvalue by a few power steps gives the step length; the intercept moves with it
    v = np.ones(held.shape[1] + 1, np.float32)
    for _ in range(20):
        u = held @ v[1:] + v[0]
        v = np.concatenate([[u.sum()], held.T @ u]).astype(np.float32)
        v /= np.linalg.norm(v) or 1
    u = held @ v[1:] + v[0]
    rate = 4 * n / max(float(u @ u), 1e-9)
    w, old = np.zeros(held.shape[1] + 1, np.float32), np.zeros(held.shape[1] + 1, np.float32)
    share = min(max(y.mean(), 1e-4), 1 - 1e-4)
    w[0] = old[0] = np.log(share / (1 - share))
    scale = np.sqrt(np.maximum(means * (1 - means), 1e-4))  # a rule that hardly ever differs pays as little as it can do
    for k in range(STEPS):
        a = w + (k / (k + 3)) * (w - old)
        r = 1 / (1 + np.exp(-(held @ a[1:] + a[0]))) - y
        old = w
        w = a - rate / n * np.concatenate([[r.sum()], held.T @ r]).astype(np.float32)
        w[1:] = np.sign(w[1:]) * np.maximum(np.abs(w[1:]) - rate * penalty * scale, 0)
    return float(w[0]), w[1:]


def fit(x: np.ndarray, y: np.ndarray, names: list[str], penalty: float = PENALTY) -> Model:
    """A model from statistics (rows by names) and labels 0 and 1; always the same for the same rows. Without both labels it is their share, without any 0.5."""
    y = np.asarray(y, float)
    if not len(y) or y.min() == y.max():
        share = 0.5 if not len(y) else min(max(y.mean(), 0.01), 0.99)
        return Model(float(np.log(share / (1 - share))), ())
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    edges = [e[e < x[:, f].max()] for f, e in enumerate(edges)]
    binned = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], axis=1)
    score, found = np.full(len(y), np.log(y.mean() / (1 - y.mean()))), {}
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-score))
        rules, step = _rules_of_tree(binned, edges, names, y - p, p * (1 - p))
        found |= dict.fromkeys(rules)
        score += SHRINKAGE * step
    values = {n: x[:, f] for f, n in enumerate(names)}
    rules, columns, seen = [], [], set()
    for rule in found:
        held = rule.holds(values)
        mark = held.tobytes()
        if held.any() and not held.all() and mark not in seen and (~held).tobytes() not in seen:
            seen.add(mark)
            rules.append(rule)
            columns.append(held)
    if not rules:
        return Model(float(np.log(y.mean() / (1 - y.mean()))), ())
    base, weights = _lasso(np.stack(columns, axis=1).astype(np.float32), y.astype(np.float32), penalty)
    return Model(base, tuple((r, float(w)) for r, w in zip(rules, weights, strict=True) if abs(w) > 1e-6))


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> Model:
    """Fits on at most ``sample`` labelled documents outside the held-out fold, those with the least hash of their id.

    Null labels and ids do not count; of several labels for an id the least holds, and of several documents all are used.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out()).groupBy("doc_id").agg(F.min(label).alias("_y"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows, names = with_statistics(docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("doc_id", "text", "_y"))  # `sample` rows of 12 bytes
    rows = rows.select("_row._y", "_row.doc_id", *names).orderBy(F.xxhash64("doc_id"), "doc_id", *names).limit(sample).toPandas()
    return fit(rows[names].to_numpy(float), rows["_y"].to_numpy(), names)


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``, in place of any such columns; a null or empty text is scored like any other, by zeros."""
    names = [c for c in docs.columns if c not in ("score", "predicted")]
    rows, _ = with_statistics(docs)
    return rows.select("_row", model.column().alias("score")).select(*[F.col("_row")[c].alias(c) for c in names], "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted. Null ids are never held out; other columns are ignored."""
    return score(docs.select("doc_id", "text"), train(docs, labels), threshold).select("doc_id", held_out().alias("held_out"), "score", "predicted")


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without those predicted 0; all columns stay."""
    model = train(docs, labels)
    rows, _ = with_statistics(docs)
    return rows.where(model.column() >= threshold).select("_row.*")
