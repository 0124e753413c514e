"""Mixing to target weights by soft membership: document rates whose expected domain totals meet the targets."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickevidence.llm.common import labelled_texts, map_arrow, text_or_empty
from tickevidence.llm.textmodel import Scorer, TextFeatures, Vocabulary, choose_features, fit_softmax, softmax
from tickevidence.session import stage_table

#: Bounds of the classifier's fit: labelled texts per domain, and their length.
TEXTS, MAX_CHARS = 1_200, 32_768
#: Steps of the projected gradient, and the residual (as a share of all tokens) at which it ends.
STEPS, CLOSE = 25, 1e-7


@dataclass(frozen=True)
class DomainModel:
    """Softmax over word features; without a vocabulary every text belongs to all domains alike."""

    domains: tuple[str, ...]
    vocabulary: Vocabulary | None
    weights: np.ndarray | None


@dataclass(frozen=True)
class Rates:
    """The steps taken: a document's rate follows from its posteriors alone."""

    steps: tuple[tuple[float, ...], ...]
    highest: float
    targets: tuple[float, ...]
    reached: tuple[float, ...]

    def of(self, p: np.ndarray) -> np.ndarray:
        r = np.ones(len(p))
        for move in self.steps:
            r = np.clip(r - p @ np.array(move), 0.0, self.highest)
        return r


def fit_domains(docs: DataFrame, labelled: DataFrame, domain: Column, names: list[str]) -> DomainModel:
    """The classifier of domains from a labelled table: ``domain`` is a Column over it, one of ``names``.

    Bounded sample per domain (see the constants) of the labelled rows in ``docs``, weighted back to
    the domains' counts among these. Domains without labelled texts get no mass; with fewer than
    two, all documents belong to the one (or to all alike).
    """
    number = F.array_position(F.array(*(F.lit(n) for n in names)), domain).cast("int") - 1
    coded = labelled.select("doc_id", number.alias("code")).filter(F.col("code") >= 0)
    sample, counts = labelled_texts(docs, coded, "code", TEXTS, MAX_CHARS)
    codes = np.array([c for _, c in sample], np.int64)
    if len(set(codes.tolist())) < 2:
        return DomainModel(tuple(names), None, None)
    found = TextFeatures(t for t, _ in sample)
    del sample  # the driver needs the numbers only
    vocabulary = choose_features(found, codes)
    got = {c: int((codes == c).sum()) for c in set(codes.tolist())}
    weight = np.array([counts[c] / got[c] for c in codes.tolist()])
    weights = fit_softmax(vocabulary.matrix(found), codes, len(names), weight)
    for c in range(len(names)):
        if c not in got:
            weights[-1, c] = -1e4
    return DomainModel(tuple(names), vocabulary, weights)


def posteriors(docs: DataFrame, model: DomainModel, keep: list[str] | None = None) -> DataFrame:
    """Kept columns, ``tokens`` (words between white space), ``posterior`` (by domain) and ``content`` (a hash) of every whole text.

    NULL and empty texts have no tokens and so no weight. One scan, no shuffle.
    """
    keep = keep or ["doc_id"]
    names = [f"k{i}" for i in range(len(keep))]
    rows = docs.select(*(F.col(c).alias(n) for c, n in zip(keep, names, strict=True)), text_or_empty().alias("body"))
    rows = rows.withColumn("hashed", F.xxhash64("body"))
    memo: dict = {}

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if "scorer" not in memo:
            memo["scorer"] = Scorer(model.vocabulary or Vocabulary({}))
        found = memo["scorer"].rows(batch.column(len(names)).to_pylist())
        d = len(model.domains)
        if model.weights is None:
            p = np.full((len(found), d), 1 / d)
        else:
            w = model.weights.astype(np.float64)
            p = softmax(np.array([w[r].sum(axis=0) for r, _ in found]).reshape(-1, d) + w[-1])
        offsets = pa.array(np.arange(0, d * len(found) + 1, d, dtype=np.int32))
        return pa.RecordBatch.from_arrays(
            [
                *batch.columns[: len(names)],
                pa.array([n for _, n in found], pa.int64()),
                pa.ListArray.from_arrays(offsets, pa.array(p.ravel())),
                batch.column(len(names) + 1),
            ],
            names=[*names, "tokens", "posterior", "content"],
        )

    schema = ", ".join(f"{n} {rows.schema[n].dataType.simpleString()}" for n in names)
    out = map_arrow(rows, [*names, "body", "hashed"], run, f"{schema}, tokens long, posterior array<double>, content long")
    return out.select(*(F.col(n).alias(c) for n, c in zip(names, keep, strict=True)), "tokens", "posterior", "content")


def _totals(soft: DataFrame, d: int, rates: Rates) -> tuple[np.ndarray, np.ndarray, float]:
    """Expected domain totals at the current rates, the Gram matrix of the documents in use, and all tokens.

    One pass over the small staged table; each task returns one row of d + d*d + 1 sums.
    """

    def run(batches):
        sums, n = np.zeros(d + d * d + 1), 0
        for b in batches:
            p = b.column(1).flatten().to_numpy().reshape(-1, d)
            t = b.column(0).to_numpy().astype(np.float64)
            r = rates.of(p)
            free = t * (r > 0)
            sums[:d] += (t * r) @ p
            sums[d : d + d * d] += (p.T @ (p * free[:, None])).ravel()
            sums[-1] += t.sum()
            n += len(t)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([sums], pa.list_(pa.float64()))], names=["sums"])

    parts = soft.select("tokens", "posterior").mapInArrow(run, "sums array<double>")
    row = parts.agg(*(F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(d + d * d + 1))).first()
    sums = np.array([x or 0.0 for x in row])
    return sums[:d], sums[d : d + d * d].reshape(d, d), float(sums[-1])


def fit_rates(soft: DataFrame, weights: list[float], total: float | None = None, highest: float = float("inf")) -> Rates:
    """Nonnegative rates by projected-gradient least squares over all documents.

    Minimises the squared distance between expected domain totals and targets, from
    rates of 1. With documents measured by their tokens, the gradient of a rate is the posterior
    times the residual, so every step is one vector over domains: it is scaled by the
    Gram matrix of the documents in use and projected onto [0, highest]. When
    that no longer lowers the distance, plain steps follow, halved where they overshoot. Documents of equal posteriors get equal rates.

    ``weights`` are the targets' shares; ``total`` their sum in tokens, by default such
    that the domain with the largest share is used as it is. Rates above 1 mean repetition,
    at most ``highest`` times; a domain with too little text then stays below its target.
    """
    d = len(weights)
    share = np.array(weights, float)
    share = share / share.sum()
    rates = Rates((), highest, (), ())
    reached, gram, tokens = _totals(soft, d, rates)
    if tokens == 0:
        return Rates((), highest, tuple(share * 0), tuple(share * 0))
    if total is None:
        most = int(share.argmax())
        total = float(reached[most] / share[most])
    targets = share * total
    step, scaled, best = 1.0, True, rates
    distance = float(((reached - targets) ** 2).sum())
    for _ in range(STEPS):
        if np.abs(reached - targets).max() <= CLOSE * tokens or step < 1e-3:
            break
        metric, residual = gram / tokens + 1e-6 * np.eye(d), (reached - targets) / tokens
        move = step * (np.linalg.solve(metric, residual) if scaled else residual / np.linalg.eigvalsh(metric)[-1])
        trial = Rates((*best.steps, tuple(move)), highest, (), ())
        got, trial_gram, _ = _totals(soft, d, trial)
        now = float(((got - targets) ** 2).sum())
        if now < distance:
            if now > 0.999999 * distance:
                step = 0.0
            best, reached, gram, distance = trial, got, trial_gram, now
        elif scaled:
            scaled = False
        else:
            step /= 2
    return Rates(best.steps, highest, tuple(targets), tuple(reached))


def with_copies(soft: DataFrame, rates: Rates, seed: int = 23, key: str = "doc_id") -> DataFrame:
    """Adds rate and copies: the rate's whole part, and one more with the probability of the rest.

    The draw is a hash of the key, the text's content and the row's number among equal ones of its task, so rows
    that share a key draw by themselves. Works on every kept column.
    """
    cols = soft.columns
    at = cols.index("posterior")
    d = len(rates.targets)
    seen: dict[int, int] = {}

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        r = rates.of(batch.column(at).flatten().to_numpy().reshape(-1, d))
        copy = []
        for name in batch.column(len(cols)).to_pylist():
            copy.append(seen.get(name, 0))
            seen[name] = copy[-1] + 1
        added = [batch.column(len(cols)), pa.array(copy, pa.int64()), pa.array(r)]
        return pa.RecordBatch.from_arrays([*batch.columns[: len(cols)], *added], names=[*cols, "_row", "_copy", "rate"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in soft.schema) + ", _row long, _copy long, rate double"
    named = soft.withColumn("_row", F.xxhash64(key, "content"))
    out = map_arrow(named, [*cols, "_row"], run, schema, 2000)
    draw = F.pmod(F.xxhash64("_row", "_copy", F.lit(seed)), F.lit(1_000_000)) / 1_000_000
    whole = F.floor("rate")
    out = out.withColumn("copies", (whole + (draw < F.col("rate") - whole).cast("int")).cast("long"))
    return out.drop("_row", "_copy")


def mix(
    docs: DataFrame,
    labelled: DataFrame,
    domain: Column,
    weights: dict[str, float],
    highest: float = float("inf"),
    keep: list[str] | None = None,
) -> tuple[DomainModel, Rates, DataFrame]:
    """Classifier, rates and the staged table (kept columns, tokens, posterior) behind them.

    Every text is scored once; the steps of the fit read tokens and posteriors from the staged table alone.
    """
    names = list(weights)
    model = fit_domains(docs, labelled, domain, names)
    soft = stage_table(posteriors(docs, model, keep), "posteriors")
    return model, fit_rates(soft, [weights[n] for n in names], highest=highest), soft
