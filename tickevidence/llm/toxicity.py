"""Toxicity by a classifier chain: each category's model also sees the earlier categories' probabilities."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickevidence.llm.common import labelled_sample, map_arrow, text_or_empty
from tickevidence.llm.textmodel import Scorer, TextFeatures, Vocabulary, choose_features, fit_softmax, softmax

#: Bounds of the fit: labelled texts per combination of categories, their length, and folds.
TEXTS, MAX_CHARS, FOLDS = 1_200, 32_768, 3
#: A category's cut is the highest that finds this share of its rows, unless more than that share of all others is then flagged.
RECALL, ALARMS = 0.95, 0.05


@dataclass(frozen=True)
class Chain:
    """A linear model per category, in order; model k has k more inputs, the earlier log-odds."""

    categories: tuple[str, ...]
    vocabulary: Vocabulary
    weights: tuple[np.ndarray, ...]
    cuts: tuple[float, ...]


def _log_odds(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return (np.log(p / (1 - p)) / 4).astype(np.float32)


def _fit_one(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    w = fit_softmax(x, y, 2, weight)
    return w[:, 1] - w[:, 0]


def _probability(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return softmax(np.stack([np.zeros(len(x)), x @ w[:-1] + w[-1]], axis=1))[:, 1]


def _out_of_fold(found: TextFeatures, codes: np.ndarray, weight: np.ndarray, fold: np.ndarray, categories: int) -> list[np.ndarray]:
    """Each category's probabilities from models, vocabulary included, that have not seen the row."""
    out: list[np.ndarray] = [np.zeros(len(codes)) for _ in range(categories)]
    inputs = []
    for f in range(FOLDS):
        train = fold != f
        if len(set(codes[train].tolist())) < 2:
            return out
        inputs.append(choose_features(found, codes, train).matrix(found))
    for k in range(categories):
        y = (codes >> k) & 1
        for f, x in enumerate(inputs):
            train = fold != f
            x = np.hstack([x, *(_log_odds(p)[:, None] for p in out[:k])])
            out[k][~train] = _probability(x[~train], _fit_one(x[train], y[train], weight[train]))
    return out


def choose_cut(p: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The highest cut with the wanted recall, raised to the lowest one that keeps the false alarms; rows count by weight.

    If even the highest probability is too many alarms, that is the cut.
    """
    steps = np.unique(p)[::-1]
    alarms = np.array([weight[(y == 0) & (p >= c)].sum() for c in steps]) / weight[y == 0].sum()
    recall = np.array([weight[(y == 1) & (p >= c)].sum() for c in steps]) / weight[y == 1].sum()
    enough = int(np.searchsorted(recall, RECALL - 1e-9))
    allowed = int(np.searchsorted(alarms, ALARMS + 1e-9)) - 1
    return float(steps[max(0, min(enough, allowed, len(steps) - 1))])


def fit(docs: DataFrame, labels: DataFrame, categories: dict[str, str]) -> Chain | None:
    """The chain from labelled rows; ``categories`` maps a name to a SQL condition on the labels, in chain order.

    A later model learns from out-of-fold probabilities of the earlier ones, which is
    what it meets on new texts. The sample is bounded per combination of
    categories (see the constants) and weighted back to the combinations' counts over
    all labels. Each category's cut is chosen on out-of-fold probabilities of the same rows (RECALL, ALARMS).
    None when a category has only one value.
    """
    names = list(categories)
    code = sum((F.coalesce(F.expr(c), F.lit(False)).cast("int") * 2**k for k, c in enumerate(categories.values())), F.lit(0))
    coded = labels.select("doc_id", code.alias("code"))
    counts = {r["code"]: r["n"] for r in coded.groupBy("code").agg(F.count(F.lit(1)).alias("n")).collect()}
    sample = [x for part in (0, 1) for x in labelled_sample(docs, coded, "code", TEXTS // 2, MAX_CHARS, part)]
    codes = np.array([c for _, c in sample], np.int64)
    targets = [(codes >> k) & 1 for k in range(len(names))]
    if not len(codes) or any(t.min() == t.max() for t in targets):
        return None
    found = TextFeatures(t for t, _ in sample)
    vocabulary = choose_features(found, codes)
    x = vocabulary.matrix(found)
    got = {c: (codes == c).sum() for c in set(codes.tolist())}
    weight = np.array([counts[c] / got[c] for c in codes.tolist()])
    fold = np.arange(len(codes)) % FOLDS
    weights = []
    for k, y in enumerate(targets):
        weights.append(_fit_one(x, y, weight))
        if k + 1 < len(targets):
            held = np.zeros(len(y))
            for f in range(FOLDS):
                train = fold != f
                held[~train] = _probability(x[~train], _fit_one(x[train], y[train], weight[train]))
            x = np.hstack([x, _log_odds(held)[:, None]])
    honest = _out_of_fold(found, codes, weight, fold, len(names))
    cuts = tuple(choose_cut(p, y, weight) for p, y in zip(honest, targets, strict=True))
    return Chain(tuple(names), vocabulary, tuple(weights), cuts)


def score(docs: DataFrame, chain: Chain | None, categories: list[str]) -> DataFrame:
    """doc_id and the probability of each category (p_<name>) for every whole text; one scan, no shuffle.

    NULL and empty texts are scored as texts without words. Without a chain all
    probabilities are 0.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    if chain is None:
        return rows.select("doc_id", *(F.lit(0.0).alias(f"p_{c}") for c in categories))
    memo: dict = {}

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if "scorer" not in memo:
            memo["scorer"] = Scorer(chain.vocabulary)
        found = [r for r, _ in memo["scorer"].rows(batch.column(1).to_pylist())]
        base = len(chain.vocabulary.index)
        probs: list[np.ndarray] = []
        for w in chain.weights:
            z = np.array([w[r].sum() for r in found]) + w[-1]
            z += sum((_log_odds(p) * w[base + i] for i, p in enumerate(probs)), np.zeros(len(found)))
            probs.append(1 / (1 + np.exp(-np.clip(z, -30, 30))))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(p.astype(np.float64)) for p in probs)],
            names=["doc_id", *(f"p_{c}" for c in chain.categories)],
        )

    return map_arrow(rows, ["doc_id", "text"], run, "doc_id long, " + ", ".join(f"p_{c} double" for c in categories))
