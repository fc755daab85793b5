"""Quality classifier: a sparse ensemble of rules over text statistics, compiled into Spark columns."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import free_name, packed, plain, text_of

# Labelled rows that a model is fitted on, at most: those with the smallest hashes of their ids.
FIT_ROWS = 20_000
TREES, DEPTH, BINS = 16, 3, 32
# Weight of the absolute rule weights against the mean loss.
PENALTY = 2e-4
STEPS = 600

SYMBOLS = "#%&$*|<>{}[]=\\^~_@+"
STATISTICS = (
    "_q_words", "_q_distinct", "_q_word_length", "_q_symbols", "_q_exclaims", "_q_upper", "_q_digits", "_q_stops",
    "_q_lines", "_q_spaces",
)


def with_statistics(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``docs`` with the statistics of whole texts as columns that begin with ``_q_``; an empty text has zeros.

    Shares are per character or per word, so that they do not grow with the text; only ``_q_words`` does (as a
    logarithm), since the share of distinct words depends on it.
    """
    text = plain("_q_text")
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda word: word != "")
    chars = F.greatest(F.length(text), F.lit(1)).cast("double")

    def count(characters: str) -> Column:
        return F.length(text) - F.length(F.translate(text, characters, ""))

    def runs(pattern: str) -> Column:
        return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))

    counted = (
        docs.withColumn("_q_text", text_of(text_column))
        .withColumn("_q_all", words)
        .withColumns({
            "_q_n": F.size("_q_all"),
            "_q_d": F.size(F.array_distinct("_q_all")),
            "_q_chars": chars,
            "_q_symbols_n": count(SYMBOLS),
            "_q_exclaims_n": count("!"),
            "_q_upper_n": runs(r"\p{Lu}+"),
            "_q_digits_n": runs(r"[0-9]+"),
            "_q_stops_n": count(".?:;"),
            "_q_lines_n": count("\n"),
            "_q_spaces_n": count(" \t"),
        })
    )
    at_least_one = F.greatest(F.col("_q_n"), F.lit(1)).cast("double")
    return counted.withColumns({
        "_q_words": F.log(at_least_one),
        "_q_distinct": F.col("_q_d") / at_least_one,
        "_q_word_length": (F.length("_q_text") - F.col("_q_spaces_n")) / at_least_one,
        "_q_symbols": F.col("_q_symbols_n") / at_least_one,
        "_q_exclaims": F.col("_q_exclaims_n") / at_least_one,
        "_q_upper": F.col("_q_upper_n") / F.col("_q_chars"),
        "_q_digits": F.col("_q_digits_n") / F.col("_q_chars"),
        "_q_stops": F.col("_q_stops_n") / at_least_one,
        "_q_lines": F.col("_q_lines_n") / at_least_one,
        "_q_spaces": F.col("_q_spaces_n") / F.col("_q_chars"),
    }).drop(
        "_q_all", "_q_n", "_q_d", "_q_chars", "_q_text", "_q_symbols_n", "_q_exclaims_n", "_q_upper_n", "_q_digits_n",
        "_q_stops_n", "_q_lines_n", "_q_spaces_n",
    )


Rule = tuple[tuple[int, bool, float], ...]  # (statistic, above, threshold), all of which must hold


@dataclass(frozen=True)
class RuleModel:
    """Log-odds of a good text: ``intercept`` plus the weights of the rules that hold."""

    intercept: float
    rules: tuple[tuple[Rule, float], ...]

    def score(self) -> Column:
        """The compiled score, 0 to 1, over the columns of ``with_statistics``."""
        odds = F.lit(self.intercept)
        for rule, weight in self.rules:
            holds = F.lit(True)
            for statistic, above, threshold in rule:
                value = F.col(STATISTICS[statistic])
                holds = holds & (value > F.lit(threshold) if above else value <= F.lit(threshold))
            odds = odds + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))

    def text(self) -> list[str]:
        """The rules for people."""
        names = [s.removeprefix("_q_") for s in STATISTICS]
        return [
            f"{weight:+.3f} if " + " and ".join(f"{names[s]} {'>' if above else '<='} {t:.4g}" for s, above, t in rule)
            for rule, weight in self.rules
        ]


def _grow(x: np.ndarray, bins: np.ndarray, cuts: list[np.ndarray], residual: np.ndarray, rows: np.ndarray, path: Rule, depth: int,
          rules: list[Rule], value: np.ndarray) -> None:
    """Split ``rows`` by the best cut of the residuals' squares; every node's path becomes a rule."""
    if path:
        rules.append(path)
    value[rows] = residual[rows].mean()
    if depth == 0 or len(rows) < 40:
        return
    best = (1e-9, 0, 0)
    total, n = residual[rows].sum(), len(rows)
    for s in range(x.shape[1]):
        if not len(cuts[s]):
            continue
        at = bins[rows, s]
        number = np.bincount(at, minlength=len(cuts[s]) + 1).cumsum()[:-1]
        below = np.bincount(at, weights=residual[rows], minlength=len(cuts[s]) + 1).cumsum()[:-1]
        good = (number >= 15) & (n - number >= 15)
        if good.any():
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(good, below**2 / number + (total - below) ** 2 / (n - number) - total**2 / n, -1.0)
            if gain.max() > best[0]:
                best = (float(gain.max()), s, int(gain.argmax()))
    if best[0] <= 1e-9:
        return
    _, s, cut = best
    under = bins[rows, s] <= cut
    for above, part in ((False, rows[under]), (True, rows[~under])):
        _grow(x, bins, cuts, residual, part, (*path, (s, above, float(cuts[s][cut]))), depth - 1, rules, value)


def _holds(x: np.ndarray, rule: Rule) -> np.ndarray:
    held = np.ones(len(x), dtype=bool)
    for s, above, threshold in rule:
        held &= (x[:, s] > threshold) if above else (x[:, s] <= threshold)
    return held


def fit_rules(x: np.ndarray, y: np.ndarray) -> RuleModel:
    """Boosted trees give the rules, logistic regression with an absolute penalty their weights.

    Without rows the score is 1 (nothing speaks against a text); with one label only, it is that label's smoothed share.
    """
    if len(y) == 0:
        return RuleModel(30.0, ())
    prior = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(prior / (1 - prior)))
    if y.min() == y.max():
        return RuleModel(base, ())
    cuts = []
    for s in range(x.shape[1]):
        values = np.unique(x[:, s])
        edges = np.unique(np.quantile(values, np.linspace(0, 1, BINS + 1)[1:-1])) if len(values) > 1 else np.array([])
        # the ends of what all rows have: rare values lie beyond them
        tails = np.quantile(x[:, s], [0.01, 0.05, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99]) if len(values) > 1 else np.array([])
        cuts.append(np.unique(np.concatenate([edges, tails])))
    bins = np.stack([np.searchsorted(c, x[:, s], side="left") for s, c in enumerate(cuts)], axis=1)
    odds, rules = np.full(len(y), base), []
    for _ in range(TREES):
        residual = y - 1 / (1 + np.exp(-odds))
        value = np.zeros(len(y))
        _grow(x, bins, cuts, residual, np.arange(len(y)), (), DEPTH, rules, value)
        odds = odds + 2.0 * value
    rules = list(dict.fromkeys(rules))
    held = np.stack([_holds(x, r) for r in rules], axis=1).astype(np.float64) if rules else np.zeros((len(y), 0))
    _, first = np.unique(held, axis=1, return_index=True)  # rules that hold for the same rows are one
    rules, held = [rules[i] for i in sorted(first)], held[:, sorted(first)]
    weights, intercept = _lasso(held, y, base)
    return RuleModel(intercept, tuple((r, float(w)) for r, w in zip(rules, weights) if w != 0.0))


def _lasso(held: np.ndarray, y: np.ndarray, intercept: float) -> tuple[np.ndarray, float]:
    """Accelerated proximal gradient steps on the mean logistic loss; the intercept is not penalised."""
    n, k = held.shape
    step = 4.0 / (np.linalg.norm(held.T @ held / n, 2) + 1.0 if k else 1.0)
    weights = ahead = np.zeros(k)
    bias = bias_ahead = intercept
    t = 1.0
    for _ in range(STEPS):
        error = 1 / (1 + np.exp(-(held @ ahead + bias_ahead))) - y
        moved = ahead - step * (held.T @ error) / n
        new = np.sign(moved) * np.maximum(np.abs(moved) - step * PENALTY, 0.0)
        new_bias = bias_ahead - step * error.mean()
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + (t - 1) / t_new * (new - weights)
        bias_ahead = new_bias + (t - 1) / t_new * (new_bias - bias)
        weights, bias, t = new, new_bias, t_new
    return weights, float(bias)


def is_held_out(id_column: str = "doc_id") -> Column:
    """Rows that no model is fitted on: CRC-32 of the id's text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(plain(id_column).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "quality",
    fit_rows: int = FIT_ROWS,
) -> RuleModel:
    """Fit on at most ``fit_rows`` labelled rows outside the held-out part.

    Their ids and labels are bounded by ``fit_rows``, so they are broadcast to the scan of ``docs`` and only their
    statistics (not texts) come to the driver, one row per id and label: of documents that share an id, that with the
    smallest hash of its text. Labels other than 0 and 1 and NULL ids are left out; an id with several labels counts with
    each.
    """
    sample = (
        labels.select(plain(id_column).alias("_q_id"), plain(label_column).cast("int").alias("_q_label"))
        .filter(F.col("_q_id").isNotNull() & F.col("_q_label").isin(0, 1))
        .filter(~is_held_out("_q_id"))
        .orderBy(F.xxhash64("_q_id"), "_q_id", "_q_label")
        .limit(fit_rows)
    )
    rows = docs.select(plain(id_column).alias("_q_id"), plain(text_column).alias("_q_source")).join(F.broadcast(sample), "_q_id")
    one = F.min(F.struct(F.col("_q_hash").alias("hash"), *STATISTICS)).alias("_q_one")
    stated = with_statistics(rows.withColumn("_q_hash", F.xxhash64("_q_source")), "_q_source")
    found = stated.groupBy("_q_id", "_q_label").agg(one).orderBy("_q_id", "_q_label").select("_q_one.*", "_q_label").toPandas()
    return fit_rules(found[list(STATISTICS)].to_numpy(dtype=np.float64), found["_q_label"].to_numpy(dtype=np.float64))


def scored(docs: DataFrame, model: RuleModel, text_column: str = "text", output: str = "score") -> DataFrame:
    """``docs`` with the score in ``output`` (a column of that name is replaced); rows, NULLs and repeats stay as they are.

    No shuffle and no Python: statistics and rules are columns. The score leaves a generator, so that a filter on it is
    not copied into every rule.
    """
    rows = docs.select(packed(docs).alias("_q_row"), text_of(text_column).alias("_q_source"))
    others = [F.col("_q_row").getField(c).alias(c) for c in docs.columns if c != output]
    return with_statistics(rows, "_q_source").select(*others, F.explode(F.array(model.score())).alias(output))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, as they are."""
    model = fit(docs, labels, text_column=text_column)
    score = free_name(docs, "score")
    return scored(docs, model, text_column, score).filter(F.col(score) >= threshold).drop(score)
