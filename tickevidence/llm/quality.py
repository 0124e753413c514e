"""Quality by compression: which of two zstandard dictionaries, built from good and bad texts, shortens a text more."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickevidence.llm.common import fit_logistic, held_out, labelled_sample, map_arrow, sigmoid, text_or_empty

#: Bounds of the fit: labelled texts per class for the dictionaries and, from other ids, for the calibration.
DICTIONARY_TEXTS, CALIBRATION_TEXTS, MAX_CHARS = 400, 1_500, 32_768
#: Bytes of a dictionary, and of the pieces that are compressed one by one; zstandard's level.
DICTIONARY_BYTES, PIECE_BYTES, LEVEL = 112_640, 1_024, 3


def _pieces(body: bytes) -> list[bytes]:
    """The whole text in pieces, so that a long text's own history does not outweigh the dictionary."""
    return [body[i : i + PIECE_BYTES] for i in range(0, len(body), PIECE_BYTES)]


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(
        level=LEVEL,
        dict_data=zstandard.ZstdCompressionDict(dictionary),
        write_content_size=False,
        write_checksum=False,
        write_dict_id=False,
    )


class _Sizes:
    """Compressed sizes of a text under both dictionaries, and the features made of them."""

    def __init__(self, good: bytes, bad: bytes):
        self.good, self.bad = _compressor(good), _compressor(bad)

    def features(self, text: str) -> list[float]:
        body = text.encode("utf-8", "surrogatepass")
        parts = _pieces(body)
        good = sum(len(self.good.compress(p)) for p in parts)
        bad = sum(len(self.bad.compress(p)) for p in parts)
        gain = (bad - good) / (bad + good) if parts else 0.0
        ratio = float(np.log((good + bad + 1) / (2 * len(body) + 1)))
        length = float(np.log(len(body) + 1))
        return [gain, ratio, length, gain * ratio, gain * length, ratio * ratio, ratio * length, gain * gain, length * length]


@dataclass(frozen=True)
class QualityModel:
    """Two dictionaries and the calibration of their size difference."""

    good: bytes
    bad: bytes
    mean: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]
    intercept: float
    constant: float | None = None

    def scores(self, texts: list[str], sizes: _Sizes) -> np.ndarray:
        x = np.array([sizes.features(t) for t in texts]).reshape(len(texts), -1)
        z = ((x - np.array(self.mean)) / np.array(self.scale)) @ np.array(self.weights) + self.intercept
        return sigmoid(z)


def fit(docs: DataFrame, labels: DataFrame) -> QualityModel:
    """Dictionaries and calibration from labelled rows that are not held out.

    Both samples are bounded (see the constants) and drawn by a hash of the id from
    disjoint halves, so the calibration sees compressed sizes of unseen texts. The
    score is a logistic function of the normalised size difference (bad - good) /
    (bad + good), of the compression ratio and of the length, with products. With
    labels of one class only, the score is that class's share, smoothed; with none, 0.5.
    """
    train = labels.filter(~held_out())
    texts = labelled_sample(docs, train, "quality", DICTIONARY_TEXTS, MAX_CHARS, 0)
    more = labelled_sample(docs, train, "quality", CALIBRATION_TEXTS, MAX_CHARS, 1)
    classes = {q for _, q in texts if q in (0, 1)} & {q for _, q in more if q in (0, 1)}
    if len(classes) < 2:
        known = [q for _, q in texts + more if q in (0, 1)]
        return QualityModel(b"", b"", (), (), (), 0.0, (sum(known) + 1) / (len(known) + 2))
    dictionaries = {}
    for q in (0, 1):
        parts = [p for t, own in texts if own == q for p in _pieces(t.encode("utf-8", "surrogatepass"))]
        dictionaries[q] = _dictionary(parts)
    sizes = _Sizes(dictionaries[1], dictionaries[0])
    x = np.array([sizes.features(t) for t, q in more if q in (0, 1)])
    y = np.array([float(q) for _, q in more if q in (0, 1)])
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    w, b = fit_logistic((x - mean) / scale, y, weight)
    return QualityModel(dictionaries[1], dictionaries[0], tuple(mean), tuple(scale), tuple(w), b)


def _dictionary(parts: list[bytes]) -> bytes:
    """A trained dictionary; with too few samples for the trainer, their own bytes."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, parts).as_bytes()
    except zstandard.ZstdError:
        return b"".join(parts)[:DICTIONARY_BYTES]


def score(docs: DataFrame, model: QualityModel, keep: list[str] | None = None) -> DataFrame:
    """The kept columns (doc_id unless named) and the score, 0 to 1, of every whole text.

    NULL and empty texts are scored like any other: no pieces, so difference 0 and
    ratio 1. One scan, no shuffle; the model is about 220 KB and travels with the tasks.
    """
    keep = keep or ["doc_id"]
    if model.constant is not None:
        return docs.select(*keep, F.lit(float(model.constant)).alias("score"))
    names = [f"k{i}" for i in range(len(keep))]
    rows = docs.select(*(F.col(c).alias(n) for c, n in zip(keep, names, strict=True)), text_or_empty().alias("body"))
    memo: dict = {}

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if "sizes" not in memo:
            memo["sizes"] = _Sizes(model.good, model.bad)
        found = model.scores(batch.column(len(names)).to_pylist(), memo["sizes"])
        return pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(found)], names=[*names, "score"])

    schema = ", ".join(f"{n} {rows.schema[n].dataType.simpleString()}" for n in names) + ", score double"
    out = map_arrow(rows, [*names, "body"], run, schema)
    return out.select(*(F.col(n).alias(c) for n, c in zip(names, keep, strict=True)), "score")
