"""Word hashes of the n-gram join must tell long words apart."""

from tickevidence.llm import jaccard


def thue_morse(length, one, other):
    return "".join(one if bin(i).count("1") % 2 == 0 else other for i in range(length))


def test_long_alternating_words_differ(spark):
    a, b = thue_morse(2048, "a", "b"), thue_morse(2048, "b", "a")
    sets = jaccard.shingle_sets([f"{a} x y z w", f"{b} x y z w", f"{a.upper()} x y z w"], 4)
    assert len(set(sets[0].tolist()) & set(sets[1].tolist())) == 1
    assert sets[0].tolist() == sets[2].tolist()
    docs = spark.createDataFrame([(1, f"{a} x y z"), (2, f"{b} x y z"), (3, f"{a} x y z")], "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in jaccard.link_components(docs, 4, 85).collect()}
    assert got == {1: 1, 2: 2, 3: 1}


def test_words_around_the_bound():
    words = ["k" * n for n in (63, 64, 65, 66)]
    text = " ".join(words)
    assert jaccard.shingle_sets([text, text + " "], 4)[0].tolist() == jaccard.shingle_sets([text], 4)[0].tolist()
    assert len({jaccard.shingle_sets([w], 4)[0][0] for w in words}) == 4


def test_candidate_sets_are_smaller_than_their_shingles(spark, tmp_path):
    """What a pair carries to its verification: a packed text and half tokens, not 8 bytes a shingle three times over."""
    import numpy as np

    from tickevidence.llm import jaccard

    words = [f"word{k * 7919 % 1000}" for k in range(800)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[:-3])), (3, None)], "doc_id long, text string")
    levels = spark.sparkContext.broadcast(np.zeros((2, 16), np.uint8))
    names = {t: jaccard._node(jaccard.shingle_sets([t], 4)[0]) for t in (" ".join(words), " ".join(words[:-3]))}
    rows = spark.createDataFrame([(k + 1, n) for k, n in enumerate(names.values())], "doc_id long, node long")
    sets = jaccard._candidate_sets(docs, rows, rows.select("node"), levels, 4, 85).collect()
    assert {r["node"] for r in sets} == set(names.values())
    for r in sets:
        _, body, further = r
        assert len(body) + 4 * sum(map(len, further)) < 797 * 8
    pair = spark.createDataFrame([tuple(sorted(names.values()))], "a long, b long")
    found = jaccard._candidate_sets(docs, rows, rows.select("node"), levels, 4, 85)
    assert jaccard._verified(pair, found, 4, 85).count() == 1
    assert jaccard._verified(pair, found, 4, 100).count() == 0


def test_sets_are_made_for_nodes_of_pairs_only(spark, monkeypatch):
    """A document that shares a shingle with a much longer one alone makes no pair, so no set of it is made."""
    long = " ".join(f"w{k}" for k in range(60))
    rows = [(1, long), (2, long + " end"), (3, None)]
    rows += [(100 + k, " ".join(f"w{i}" for i in range(k, k + 4))) for k in range(57)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    asked, made = [], jaccard._candidate_sets

    def noted(texts, rows, nodes, *more):
        asked.append({r["node"] for r in nodes.select("node").collect()})
        return made(texts, rows, nodes, *more)

    monkeypatch.setattr(jaccard, "_candidate_sets", noted)
    got = {r["doc_id"]: r["component_id"] for r in jaccard.link_components(docs, 4, 85).collect()}
    assert got == {d: 1 if d == 2 else d for d, _ in rows}
    both = {jaccard._node(jaccard.shingle_sets([t], 4)[0]) for _, t in rows[:2]}
    assert asked and all(a == both for a in asked)
