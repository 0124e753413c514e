"""N-gram Jaccard join: prefix filters under several token orders, exact verification, link components.

How it goes:

1. A sketch counts in how many documents each shingle occurs (fixed size, every document).
2. Each document's distinct shingles are ordered, rare ones first; the first n - ceil(t n) + 1
   are its prefix. Documents that link share a prefix shingle under any order, and under these
   orders shingles of shared passages hardly ever open a pair.
3. Prefix shingles of the first order that two or more different sets share name the candidates.
4. Within a shingle's documents, first only the most connected document is paired with the others,
   and verified links merge them. What then lies in one component needs no further
   pair. Once few pairs across components are left, all of them are verified. Only for the
   sets of a round's pairs the texts are packed and the prefixes of two further orders made.
5. Before a pair is verified it must share a prefix shingle under the other orders as well.

Equal sets are one node throughout, so copies never make pairs.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickevidence.llm.common import map_arrow, slices, text_or_empty
from tickevidence.session import stage_table

#: Cells in a row of the frequency sketch, and in a part of it, as powers of two.
SKETCH_BITS, PART_BITS = 22, 16
#: Orders besides the first, whose prefixes a pair must share before it is verified.
FURTHER_ORDERS = 2
#: Rounds of pairing with one document at most, and when they end: all remaining pairs (counted per shingle) are made
#: as soon as they are no more than this many per posting.
STAR_ROUNDS, PAIRS_PER_POSTING = 3, 4

#: Words of more bytes are hashed by themselves.
LONG_WORD = 64

_RNG = np.random.default_rng(20_240_607)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _RNG.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray, salt: int = 0) -> np.ndarray:
    x = h ^ (np.uint64((salt * 0xD1342543DE82EF95) & 0xFFFFFFFFFFFFFFFF))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str], words: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles; fewer words make one shingle, none an empty set.

    A-Z are lower-cased; words are runs without white space (U+0009 to U+000D, space).
    The texts are hashed together as one byte array.
    """
    bodies = [t.encode("utf-8", "surrogatepass") for t in texts]
    b = np.frombuffer(b"\n".join(bodies) + b"\n", np.uint8)
    b = np.where((b >= 65) & (b <= 90), b + 32, b).astype(np.uint8)
    inside = ~((b == 32) | ((b >= 9) & (b <= 13)))
    starts = np.flatnonzero(inside & ~np.concatenate(([False], inside[:-1])))
    ends = np.cumsum([len(x) + 1 for x in bodies])
    if not len(starts):
        return [np.zeros(0, np.uint64) for _ in texts]
    # A word's hash: the sum of a number per byte times a power per place in the word.
    place = np.arange(len(b)) - np.repeat(np.concatenate(([0], starts)), np.diff(np.concatenate(([0], starts, [len(b)]))))
    power = np.multiply.accumulate(np.full(int(place.max()) + 1, _BASE))
    value = np.where(inside, _BYTE[b] * power[place], np.uint64(0))
    word = _mix(np.add.reduceat(value, starts))
    # Such sums modulo 2**64 collide for long words made on purpose; those get a hash of their bytes.
    stops = np.flatnonzero(inside & ~np.concatenate((inside[1:], [False]))) + 1
    for k in np.flatnonzero(stops - starts > LONG_WORD).tolist():
        word[k] = int.from_bytes(hashlib.blake2b(b[starts[k] : stops[k]].tobytes(), digest_size=8).digest(), "little")
    first = np.searchsorted(starts, np.concatenate(([0], ends[:-1])))
    last = np.searchsorted(starts, ends)
    wide = np.zeros(max(0, len(word) - words + 1), np.uint64)
    for k in range(words):
        wide += word[k : k + len(wide)] * _PLACE[k]
    wide = _mix(wide, words)
    out = []
    for a, z in zip(first.tolist(), last.tolist(), strict=True):
        n = z - a
        if n >= words:
            out.append(np.unique(wide[a : z - words + 1]))
        elif n:
            out.append(_mix((word[a:z] * _PLACE[:n]).sum(keepdims=True), 1000 + n))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _sets(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Batches of up to 300 documents, at most about 2 MB of text (or one text) hashed at a time."""
    for piece in slices(batches, 300):
        yield piece, _hashed(piece.column(1).to_pylist(), words)


def _hashed(texts: Iterable[str], words: int) -> list[np.ndarray]:
    """The set of each text, with at most about 2 MB of text (or one text) hashed at a time."""
    found, held, size = [], [], 0
    for t in texts:
        held.append(t)
        size += len(t)
        if size > 2_000_000:
            found += shingle_sets(held, words)
            held, size = [], 0
    return found + shingle_sets(held, words) if held else found


def _half(tokens: np.ndarray) -> np.ndarray:
    """The upper halves of tokens: equal tokens have equal halves, so a test for a shared one loses none."""
    return (tokens >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _node(tokens: np.ndarray) -> int | None:
    """The set's own 64-bit name; equal sets have equal names."""
    if not len(tokens):
        return None
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _cells(tokens: np.ndarray, row: int, bits: int) -> np.ndarray:
    """The sketch's cell of each token; its two rows place tokens independently."""
    return ((_mix(tokens, 99) if row else tokens) >> np.uint64(64 - bits)).astype(np.int64)


def prefix(tokens: np.ndarray, levels: np.ndarray, order: int, percent: int) -> np.ndarray:
    """The first tokens of a set under one of three global orders, rare ones first.

    Order 0 and 1 go by the level in the sketch's first and second row, order 2 by the
    higher of both; then by a hash of their own, then by the token.
    """
    bits = levels.shape[1].bit_length() - 1
    found = [levels[r][_cells(tokens, r, bits)] for r in (0, 1) if order in (r, 2)]
    level = np.maximum(*found) if order == 2 else found[0]
    rank = (level.astype(np.uint64) << np.uint64(56)) | (_mix(tokens, order + 1) >> np.uint64(8))
    return tokens[np.argsort(rank, kind="stable")[: prefix_length(len(tokens), percent)]]


# -- fixed-size summaries that are merged on the executors --------------------------------------


def _merged(parts: DataFrame, bits_of: str) -> DataFrame:
    """part, body: sums (or bitwise ors) of compressed parts by number, over groups of 64 tasks and then over those."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        total = None
        for body in table.column("body"):
            x = np.frombuffer(zlib.decompress(body.as_py()), np.uint32 if bits_of == "sum" else np.uint8)
            if total is None:
                total = x.astype(np.uint64) if bits_of == "sum" else x.copy()
            else:
                total = total + x if bits_of == "sum" else total | x
        if bits_of == "sum":
            total = np.minimum(total, 2**32 - 1).astype(np.uint32)
        body = zlib.compress(total.tobytes(), 1)
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "body": pa.array([body], pa.binary())})

    some = parts.withColumn("some", F.floor(F.col("task") / 64)).groupBy("part", "some").applyInArrow(run, "part int, body binary")
    return some.groupBy("part").applyInArrow(run, "part int, body binary")


def _emit(array: np.ndarray, part_items: int, task: int) -> pa.RecordBatch:
    rows = [
        (task, i, zlib.compress(array[at : at + part_items].tobytes(), 1))
        for i, at in enumerate(range(0, len(array), part_items))
    ]
    t, p, b = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(t, pa.int32()), pa.array(p, pa.int32()), pa.array(b, pa.binary())], names=["task", "part", "body"]
    )


def frequency_levels(texts: DataFrame, words: int, bits: int = SKETCH_BITS) -> np.ndarray:
    """How frequent each cell of shingles is, in two rows of 2**bits cells: 32 times its share of the mean, at most 255.

    Counts documents over the whole table; each task sends its cells compressed, the merged cells (a fixed
    32 MB) are staged, and only the levels (8 MB, sent compressed) reach the driver. A cell
    also counts other shingles, so a frequent shingle never looks rare. Any levels
    give right results; they steer which shingles come first.
    """
    from pyspark import TaskContext

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, held, n, any_row = np.zeros((2, 1 << bits), np.uint32), [], 0, False

        def count() -> None:
            tokens = np.concatenate(held)
            for r in (0, 1):
                cells[r] += np.bincount(_cells(tokens, r, bits), minlength=1 << bits).astype(np.uint32)

        for _, sets in _sets(batches, words):
            any_row = True
            held += sets
            n += sum(map(len, sets))
            if n > 1 << bits:
                count()
                held, n = [], 0
        if held:
            count()
        if any_row:
            yield _emit(cells.ravel(), 1 << PART_BITS, TaskContext.get().partitionId())

    def total(batch: pa.RecordBatch) -> pa.RecordBatch:
        sums = [int(np.frombuffer(zlib.decompress(x), np.uint32).sum(dtype=np.uint64)) for x in batch.column(0).to_pylist()]
        return pa.RecordBatch.from_arrays([pa.array(sums, pa.int64())], names=["total"])

    merged = stage_table(_merged(texts.mapInArrow(run, "task int, part int, body binary"), "sum"), "sketch")
    count = map_arrow(merged, ["body"], total, "total long").agg(F.sum("total")).first()[0] or 0
    scale = np.float32(32 / max(1.0, count / (2 << bits)))

    def level(batch: pa.RecordBatch) -> pa.RecordBatch:
        cells = (np.frombuffer(zlib.decompress(x), np.uint32) for x in batch.column(1).to_pylist())
        bodies = [zlib.compress(np.minimum(255, c.astype(np.float32) * scale).astype(np.uint8).tobytes(), 1) for c in cells]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(bodies, pa.binary())], names=["part", "body"])

    levels = np.zeros(2 << bits, np.uint8)
    for part, body in map_arrow(merged, ["part", "body"], level, "part int, body binary").collect():
        x = np.frombuffer(zlib.decompress(body), np.uint8)
        levels[part << PART_BITS : (part << PART_BITS) + len(x)] = x
    return levels.reshape(2, -1)


def _bloom_cells(x: np.ndarray, size: int) -> list[np.ndarray]:
    return [(_mix(x.view(np.uint64), 7 + k) % np.uint64(size)).astype(np.int64) for k in range(3)]


def _bloom(ids: DataFrame, count: int) -> np.ndarray:
    """A bit per cell of the doc_ids: 16 bits an id, at most 32 MB. It only spares reading texts that no one asked for."""
    from pyspark import TaskContext

    size = 1 << min(28, max(16, (16 * count).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, any_row = np.zeros(size, bool), False
        for b in batches:
            x = b.column(0).drop_null().to_numpy()
            any_row |= b.num_rows > 0
            for cells in _bloom_cells(x, size):
                bits[cells] = True
        if any_row:
            yield _emit(np.packbits(bits, bitorder="little"), 1 << PART_BITS, TaskContext.get().partitionId())

    out = np.zeros(size // 8, np.uint8)
    for part, body in _merged(ids.mapInArrow(run, "task int, part int, body binary"), "or").collect():
        x = np.frombuffer(zlib.decompress(body), np.uint8)
        out[part << PART_BITS : (part << PART_BITS) + len(x)] = x
    return out


# -- components -------------------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """node, comp (the smallest node of its component) for every node with an edge.

    Alternates two star steps (Kiveris et al., 2014): neighbours move to the
    smallest neighbour, until only stars are left. Minima are aggregated before the
    shuffle and joined back, so a centre with very many neighbours is no hot group.
    Each round is staged; the rounds grow with the logarithm of the longest chain.
    """
    now = stage_table(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "edges"
    )
    before = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v"))
        )
        now = stage_table(small.filter("u <> v").distinct(), "edges")
        sign = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if sign == before:
            break
        before = sign
    members = now.select(F.col("u").alias("node"), F.col("v").alias("comp"))
    return members.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())


def _needed(x: Column, y: Column, percent: int) -> Column:
    """The least overlap at which sets of these sizes link: ceil(t (x + y) / (1 + t))."""
    return F.floor((F.lit(percent) * (x + y) + (99 + percent)) / (100 + percent)).cast("long")


# -- the join ---------------------------------------------------------------------------------


def _verified(pairs: DataFrame, sets: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) that link: first the prefixes of the further orders must meet, then the sets are compared.

    A pair carries the packed texts, a third of the size of their shingles, and hashes them again.
    """
    slim = sets.select("node", "further")
    a, b = (slim.select(F.col("node").alias(c), F.col("further").alias(f"f{c}")) for c in "ab")
    meets = F.forall(
        F.sequence(F.lit(0), F.lit(FURTHER_ORDERS - 1)), lambda k: F.arrays_overlap(F.get("fa", k), F.get("fb", k))
    )
    left = pairs.join(b, "b").join(a, "a").filter(meets).select("a", "b")
    left = left.join(sets.select(F.col("node").alias("b"), F.col("body").alias("tb")), "b")
    left = left.join(sets.select(F.col("node").alias("a"), F.col("body").alias("ta")), "a")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x, y = (batch.column(k).to_pylist() for k in (0, 1))
        # A node that is in several pairs of the batch is hashed once.
        place: dict[int, tuple[int, int]] = {}
        for column, nodes in enumerate((x, y)):
            for row, node in enumerate(nodes):
                place.setdefault(node, (2 + column, row))
        texts = (zlib.decompress(batch.column(c)[row].as_py()).decode("utf-8", "surrogatepass") for c, row in place.values())
        sets_of = dict(zip(place, _hashed(texts, words), strict=True))
        keep = []
        for one, other in zip(x, y, strict=True):
            s, t = sets_of[one], sets_of[other]
            both = len(np.intersect1d(s, t, assume_unique=True))
            keep.append(100 * both >= percent * (len(s) + len(t) - both))
        return pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return map_arrow(left, ["a", "b", "ta", "tb"], run, "a long, b long", 256)


def link_components(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles and component_id of every row: rows link at Jaccard similarity >= percent / 100.

    component_id is the smallest doc_id among the rows reachable by links, the row's
    own included (NULL doc_ids take the smallest other one, or stay NULL). A text without words,
    empty or NULL, has no shingles and links with nothing. Repeated rows stay rows.
    Sets are compared by 64-bit hashes of their shingles.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    levels = spark.sparkContext.broadcast(frequency_levels(texts, words))

    def outline(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, sets in _sets(batches, words):
            heads = [prefix(s, levels.value, 0, percent).view(np.int64) if len(s) else s.view(np.int64) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_node(s) for s in sets], pa.int64()),
                    pa.array(heads, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n", "node", "head"],
            )

    rows = stage_table(texts.mapInArrow(outline, "doc_id long, n long, node long, head array<long>"), "outlines")

    # Prefix shingles that different sets share.
    posted = rows.filter("node IS NOT NULL").select(F.posexplode("head").alias("at", "token"), "node", "n")
    same = Window.partitionBy("token")
    shared = posted.withColumns({"low": F.min("node").over(same), "high": F.max("node").over(same), "least": F.min("n").over(same)})
    # A partner has at least n * t shingles, and the token must not come too late for the smallest one here.
    smallest = F.greatest(F.col("least"), F.expr(f"({percent} * n + 99) div 100"))
    shared = shared.filter("low < high").filter(F.col("at") <= F.col("n") - _needed(F.col("n"), smallest, percent))
    shared = stage_table(shared.select("token", "node", "n", "at").distinct(), "shared")
    weight = shared.groupBy("token").agg(F.count(F.lit(1)).alias("size"))
    nodes = shared.join(weight, "token").groupBy("node").agg(F.sum("size").alias("weight"))
    nodes = stage_table(nodes, "candidates")

    # Rounds of stars, then every pair that is left across components.
    posts = shared.join(nodes, "node")
    links: DataFrame | None = None
    parts = None
    for round_ in range(STAR_ROUNDS + 1):
        named = posts if parts is None else posts.join(parts, "node", "left")
        comp = F.col("node") if parts is None else F.coalesce("comp", "node")
        named = named.select("token", "node", "n", "at", "weight", comp.alias("comp"))
        w = Window.partitionBy("token")
        named = named.withColumn("low", F.min("comp").over(w)).withColumn("high", F.max("comp").over(w)).filter("low < high")
        named = stage_table(named.drop("low", "high"), "open")
        inside = named.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("k")).groupBy("token")
        each = inside.agg(((F.sum("k") ** 2 - F.sum(F.col("k") ** 2)) / 2).alias("pairs"), F.sum("k").alias("postings"))
        size = each.agg(F.sum("pairs"), F.sum("postings")).first()
        if not size[1]:
            break
        last = round_ > 0 and size[0] <= PAIRS_PER_POSTING * size[1] or round_ == STAR_ROUNDS
        if not last:
            # The most connected document first, then others by a hash that changes with the round.
            first = F.struct(F.when(F.lit(round_ == 0), F.col("weight")).otherwise(F.xxhash64("node", F.lit(round_))).alias("w"), "node", "n", "at", "comp")
            star = named.withColumn("top", F.max(first).over(w)).filter("comp <> top.comp")
            pairs = star.selectExpr("node x", "n nx", "at ix", "top.node y", "top.n ny", "top.at iy")
        else:
            left = named.selectExpr("token", "node x", "n nx", "at ix", "comp cx")
            right = named.selectExpr("token", "node y", "n ny", "at iy", "comp cy")
            pairs = left.join(right, "token").filter("cx < cy")
        # Sizes must allow the similarity, and so must the places of the token: behind the first shared one lies all overlap.
        need = _needed(F.col("nx"), F.col("ny"), percent)
        pairs = pairs.filter((need <= F.least("nx", "ny")) & (F.col("ix") <= F.col("nx") - need) & (F.col("iy") <= F.col("ny") - need))
        pairs = stage_table(pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "pairs")
        if not pairs.isEmpty():
            # Most shingles that are shared make no pair of fitting sizes and places: sets are made for nodes of pairs only.
            paired = stage_table(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "paired")
            sets = _candidate_sets(texts, rows, paired, levels, words, percent)
            found = stage_table(_verified(pairs, sets, words, percent), "links")
            if not found.isEmpty():
                links = found if links is None else links.unionByName(found)
                parts = components(links)
        if last:
            break
    levels.destroy()  # all that used them is staged
    out = rows.select("doc_id", F.col("n").alias("n_shingles"), "node")
    if parts is not None:
        out = out.join(parts, "node", "left").withColumn("comp", F.coalesce("comp", "node")).drop("node")
    else:
        out = out.withColumnRenamed("node", "comp")
    least = out.filter("comp IS NOT NULL").groupBy("comp").agg(F.min("doc_id").alias("least"))
    out = out.join(least, "comp", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"))


def _candidate_sets(texts: DataFrame, rows: DataFrame, nodes: DataFrame, levels, words: int, percent: int) -> DataFrame:
    """node, a packed text of it and its prefixes (half tokens) under the further orders, for the given nodes only.

    One document stands for each node. A Bloom filter of their ids keeps other texts
    from being hashed and shuffled; the join by node that follows is exact.
    """
    spark = texts.sparkSession
    chosen = rows.join(nodes.select("node"), "node").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.max(F.col("doc_id").isNull()).alias("lost"))
    chosen = stage_table(chosen, "chosen")
    bits = spark.sparkContext.broadcast(_bloom(chosen.select("doc_id"), chosen.count()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(bits.value) * 8

        def wanted() -> Iterator[pa.RecordBatch]:
            for b in batches:
                ids = b.column(0).fill_null(0).to_numpy(zero_copy_only=False)
                keep = np.array(b.column(0).is_null())
                hit = np.ones(len(ids), bool)
                for cells in _bloom_cells(np.ascontiguousarray(ids), size):
                    hit &= (bits.value[cells >> 3] >> (cells & 7) & 1).astype(bool)
                yield b.filter(pa.array(keep | hit))

        for piece, sets in _sets(wanted(), words):
            full = [(s, t) for s, t in zip(sets, piece.column(1), strict=True) if len(s)]
            orders = range(1, FURTHER_ORDERS + 1)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([_node(s) for s, _ in full], pa.int64()),
                    pa.array([zlib.compress(t.as_buffer()) for _, t in full], pa.binary()),
                    pa.array(
                        [[_half(prefix(s, levels.value, k, percent)) for k in orders] for s, _ in full],
                        pa.list_(pa.list_(pa.int32())),
                    ),
                ],
                names=["node", "body", "further"],
            )

    made = texts.mapInArrow(run, "node long, body binary, further array<array<int>>")
    wanted = made.join(nodes.select("node"), "node", "left_semi")
    # Several documents may show the same set; one row of each is kept.
    made = stage_table(wanted.dropDuplicates(["node"]), "sets")
    bits.destroy()
    return made
