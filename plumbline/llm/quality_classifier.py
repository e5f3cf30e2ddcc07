"""Quality classifier: a sparse ensemble of rules over text statistics, compiled into Spark columns.

Shallow trees are grown on the residuals of a growing model; every path from a root is a rule, a conjunction of
comparisons. A lasso logistic fit gives most rules no weight. What remains is one sum of ``when`` columns, so
scoring is a projection without a shuffle. Only the fit runs on the driver, on at most ``max_rows`` labelled rows
(drawn by hash, so the same each time) of a fixed number of statistics.

Null and blank texts get the statistics of an empty text and a score like any other. Labels that are null, or whose
document is missing, are not learned from; repeated labels count as often as they stand there. Without labels of
both kinds the score is the smoothed share of the kind there is (0.5 without any). Empty tables give empty results;
further columns of the documents are kept by ``score`` and never used.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import BLANKS, count_of, fresh_prefix, words_of

STATISTICS = ["n_words", "word_length", "distinct_words", "symbols", "shouts", "digits", "stops",
              "line_words", "dup_lines", "line_chars"]


def with_statistics(docs: DataFrame, text: str = "text", prefix: str = "_") -> DataFrame:
    """Adds the doubles named in STATISTICS as columns ``<prefix>stat_<name>``; no column of ``docs`` may begin with the prefix.

    They are columns and no array: an item of an array built in the same plan would be computed anew for each rule.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    words_, lines_, chars_ = (f"{prefix}{x}" for x in ("words", "lines", "chars"))
    step = docs.withColumn(words_, words_of(F.col(text))).withColumn(lines_, lines)
    n, m = F.size(words_), F.size(lines_)
    share = lambda part, whole: F.when(whole > 0, part / whole).otherwise(F.lit(0.0))
    step = step.withColumn(chars_, F.length(body) - count_of(body, "\\x20\\x09-\\x0D"))
    chars = F.col(chars_)
    stats = [n.cast("double"), share(chars, n), share(F.size(F.array_distinct(words_)), n),
             share(count_of(body, "#*$%&|<>"), chars), share(count_of(body, "A-Z!"), chars),
             share(count_of(body, "0-9"), chars), share(count_of(body, ".?,;:"), n),
             share(n, m), share(m - F.size(F.array_distinct(lines_)), m), share(chars, m)]
    return (step.withColumns({f"{prefix}stat_{k}": c.cast("double") for k, c in zip(STATISTICS, stats)})
            .drop(words_, lines_, chars_))


@dataclass(frozen=True)
class RuleModel:
    """score = 1 / (1 + exp(-(bias + sum of the weights of the rules that hold)))."""

    bias: float
    rules: tuple[tuple[float, tuple[tuple[int, bool, float], ...]], ...]  # weight, ((statistic, above, cut), ...)

    def column(self, prefix: str = "_") -> Column:
        total = F.lit(float(self.bias))
        for weight, parts in self.rules:
            holds = F.lit(True)
            for at, above, cut in parts:
                value = F.col(f"{prefix}stat_{STATISTICS[at]}")
                holds = holds & ((value > cut) if above else (value <= cut))
            total = total + F.when(holds, F.lit(float(weight))).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def _best_split(x: np.ndarray, r: np.ndarray, cuts: list[np.ndarray], least: int):
    best = (1e-9, None, None)
    for j, points in enumerate(cuts):
        if not len(points):
            continue
        place = np.searchsorted(points, x[:, j])  # rows at or below points[k] have a place of at most k
        n = np.cumsum(np.bincount(place, minlength=len(points) + 1))
        s = np.cumsum(np.bincount(place, weights=r, minlength=len(points) + 1))
        left, right = n[:-1], n[-1] - n[:-1]
        gain = np.where((left >= least) & (right >= least),
                        s[:-1] ** 2 / np.maximum(left, 1) + (s[-1] - s[:-1]) ** 2 / np.maximum(right, 1) - s[-1] ** 2 / n[-1], 0)
        k = int(np.argmax(gain))
        if gain[k] > best[0]:
            best = (float(gain[k]), j, float(points[k]))
    return best[1:]


def _grow(x, r, cuts, depth, least, path, rules, fitted, rows):
    """One tree; its paths go to ``rules`` and its leaf means to ``fitted``."""
    j, cut = _best_split(x[rows], r[rows], cuts, least) if depth else (None, None)
    if j is None:
        fitted[rows] = r[rows].mean()
        return
    above = x[rows, j] > cut
    for side, part in ((False, rows[~above]), (True, rows[above])):
        step = (*path, (j, side, cut))
        rules.append(step)
        _grow(x, r, cuts, depth - 1, least, step, rules, fitted, part)


def _holds(x: np.ndarray, rule) -> np.ndarray:
    out = np.ones(len(x), bool)
    for j, above, cut in rule:
        out &= (x[:, j] > cut) if above else (x[:, j] <= cut)
    return out


def _lasso(z: np.ndarray, y: np.ndarray, penalty: float, steps: int) -> tuple[float, np.ndarray]:
    """Logistic weights under an L1 penalty by accelerated proximal gradient steps; the bias is not penalised."""
    n, k = z.shape
    rate = 4.0 * n / (np.linalg.norm(z, 2) ** 2 + n)
    w, b = np.zeros(k), float(np.log(y.mean() / (1 - y.mean())))
    vw, vb, t = w.copy(), b, 1.0
    for _ in range(steps):
        miss = 1 / (1 + np.exp(-(z @ vw + vb))) - y
        nw = vw - rate * (z.T @ miss) / n
        nw = np.sign(nw) * np.maximum(np.abs(nw) - rate * penalty, 0)
        nb = vb - rate * miss.mean()
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        vw, vb = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = nw, nb, nt
    return b, w


def fit_rules(x: np.ndarray, y: np.ndarray, trees: int = 24, depth: int = 3, shrink: float = 0.3, penalty: float = 1e-3,
              steps: int = 400, seed: int = 7) -> RuleModel:
    """Grows trees, keeps each distinct rule once and fits sparse weights."""
    if len(y) == 0 or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.5
        return RuleModel(float(np.log(share / (1 - share))), ())
    draw = np.random.default_rng(seed)
    cuts = []
    for j in range(x.shape[1]):
        values = np.unique(x[:, j])
        middle = (values[:-1] + values[1:]) / 2
        cuts.append(middle if len(middle) <= 64 else np.unique(np.quantile(middle, np.linspace(0, 1, 64))))
    raw, rules = np.full(len(y), np.log(y.mean() / (1 - y.mean()))), []
    for _ in range(trees):
        residual, fitted, part = y - 1 / (1 + np.exp(-raw)), np.zeros(len(y)), []
        sample = np.sort(draw.choice(len(y), max(2, len(y) // 2), replace=False))
        _grow(x, residual, cuts, depth, max(3, len(y) // 500), (), part, fitted, sample)
        rules += part
        for rule in part:  # leaves of the tree, applied to all rows
            if not any(other[:len(rule)] == rule and len(other) > len(rule) for other in part):
                hit = _holds(x, rule)
                p = 1 / (1 + np.exp(-raw[hit]))
                if hit.any():
                    raw[hit] += shrink * np.clip((y[hit] - p).sum() / max((p * (1 - p)).sum(), 1e-3), -4, 4)
    rules = list(dict.fromkeys(tuple(sorted(r)) for r in rules))
    z = np.column_stack([_holds(x, r) for r in rules]).astype(float) if rules else np.zeros((len(y), 0))
    _, first = np.unique(z, axis=1, return_index=True)  # rules that hold on the same rows are one
    rules, z = [rules[i] for i in sorted(first)], z[:, sorted(first)]
    bias, weights = _lasso(z, y.astype(float), penalty, steps)
    return RuleModel(bias, tuple((float(w), r) for w, r in zip(weights, rules) if abs(w) > 1e-6))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = 20_000) -> RuleModel:
    """Fits on at most ``max_rows`` of the labelled documents given, chosen by the hash of id and text.

    Labels and documents are bounded: an id may stand in both many times.
    """
    known = labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("_y")).filter("_id is not null and _y in (0, 1)")
    rows = known.count()
    if rows > max_rows:
        known = known.filter(F.pmod(F.xxhash64("_id"), F.lit(rows)) < max_rows)
    known = F.broadcast(known.orderBy(F.xxhash64("_id"), "_id", "_y").limit(max_rows))  # the bound of the broadcast
    drawn = docs.select("doc_id", "text").join(known, F.col("doc_id") == F.col("_id")).withColumn("_draw", F.xxhash64("_id", "text"))
    named = [f"__stat_{k}" for k in STATISTICS]
    table = (with_statistics(drawn, prefix="__").select("doc_id", "_y", "_draw", *named).orderBy("_draw", "doc_id", "_y").limit(max_rows)
             .toPandas().sort_values(["doc_id", "_y", "_draw"], kind="stable"))
    if len(table) == 0:
        return fit_rules(np.zeros((0, len(STATISTICS))), np.zeros(0))
    return fit_rules(table[named].to_numpy(float), table["_y"].to_numpy())


def score(docs: DataFrame, model: RuleModel, out: str = "score") -> DataFrame:
    """Adds the score column to the documents; one of its name is replaced, all others stay."""
    prefix = fresh_prefix(docs.columns)
    return with_statistics(docs, prefix=prefix).withColumn(out, model.column(prefix)).drop(*[f"{prefix}stat_{k}" for k in STATISTICS])
