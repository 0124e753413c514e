"""What the driver holds while operators fit and count: numbers and levels, not feature sets and counters."""

import math
import tracemalloc
from collections import Counter

import numpy as np

from tickevidence.llm import jaccard, textmodel


def peak_mb(fn):
    tracemalloc.start()
    try:
        out = fn()
        return out, tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def sample(n, words, of):
    rng = np.random.default_rng(5)
    return [" ".join(f"word{i:05d}," for i in rng.integers(0, of, words)) for _ in range(n)]


def plain_features(text):
    words = text.split()
    found = {f for w in words for f in textmodel.word_features(w)}
    return found | set(textmodel.shape_features(text, words, set(words)))


def test_features_are_held_as_numbers():
    texts = sample(400, 600, 3_000)
    found, peak = peak_mb(lambda: textmodel.TextFeatures(texts))
    assert [{found.names[i] for i in row} for row in found.rows] == [plain_features(t) for t in texts]
    assert peak < 8


def test_words_are_not_remembered_after_a_fit():
    assert not hasattr(textmodel.word_features, "cache_info")


def test_chosen_features_equal_a_plain_count():
    texts = [*sample(60, 12, 40), "", "  ", "LOUD LOUD ### text"]
    classes = np.arange(len(texts)) % 3
    among = np.arange(len(texts)) % 4 != 1
    sets = [plain_features(t) for t in texts]
    total = Counter(f for s, k in zip(sets, among) if k for f in s)
    n, value = int(among.sum()), {}
    for c in range(3):
        own = Counter(f for s, k, q in zip(sets, among, classes) if k and q == c for f in s)
        m = int((among & (classes == c)).sum())
        for f, count in total.items():
            if count >= 3:
                a, b = own[f], count - own[f]
                odds = math.log((a + 0.5) / (m - a + 0.5)) - math.log((b + 0.5) / (n - m - b + 0.5))
                value[f] = max(value.get(f, 0.0), abs(odds) * math.sqrt(count))
    shapes = sorted(f for f in total if f.startswith("s "))
    best = sorted((f for f in value if not f.startswith("s ")), key=lambda f: (-value[f], f))[:20]
    found = textmodel.TextFeatures(texts)
    vocabulary = textmodel.choose_features(found, classes, among, 20)
    assert list(vocabulary.index) == shapes + best
    want = [[float(f in s) for f in vocabulary.index] for s in sets]
    assert vocabulary.matrix(found).tolist() == want


def test_levels_reach_the_driver_alone(spark):
    texts = [*sample(40, 30, 25), "", "a b"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    levels, peak = peak_mb(lambda: jaccard.frequency_levels(docs, 5))
    cells = np.zeros((2, 1 << jaccard.SKETCH_BITS), np.uint32)
    for tokens in jaccard.shingle_sets(texts, 5):
        for r in (0, 1):
            np.add.at(cells[r], jaccard._cells(tokens, r, jaccard.SKETCH_BITS), 1)
    want = np.minimum(255, cells.astype(np.float32) * np.float32(32 / max(1.0, float(cells.mean()))))
    assert (levels == want.astype(np.uint8)).all() and levels.any()
    assert peak < 24  # the counters alone took 34 MB


def test_levels_of_a_full_sketch_follow_its_mean(spark):
    texts = sample(300, 200, 5_000)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    cells = np.zeros((2, 1 << 12), np.uint32)
    for tokens in jaccard.shingle_sets(texts, 5):
        for r in (0, 1):
            np.add.at(cells[r], jaccard._cells(tokens, r, 12), 1)
    want = np.minimum(255, cells.astype(np.float32) * np.float32(32 / float(cells.mean()))).astype(np.uint8)
    assert cells.mean() > 1 and (jaccard.frequency_levels(docs, 5, 12) == want).all()


def test_no_texts_give_empty_levels(spark):
    assert not jaccard.frequency_levels(spark.createDataFrame([], "doc_id long, text string"), 5).any()
