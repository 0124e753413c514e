"""Exact top-k by integer inner product over a bit-sliced index."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows of an index block and queries of a query block, on average.
BLOCK_ROWS, QUERY_ROWS = 16_384, 128
#: Quantised components must be smaller than this, so that scores fit a long.
LIMIT = 1 << 23


def quantised(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id and floor(scale * x) of every component.

    NULL vectors, vectors with NULL or non-finite components and rows without a vec_id
    take no part. A component of 2**23 or more after scaling is an error: its score
    might not fit a long.
    """
    whole = F.col("embedding").isNotNull() & F.col("vec_id").isNotNull()
    wide = F.transform("embedding", lambda x: x.cast("double") * F.lit(float(scale)))
    fine = F.forall("wide", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    fits = F.forall("wide", lambda x: F.abs(x) < F.lit(float(LIMIT)))
    wrong = F.raise_error(F.lit("a quantised component exceeds 2**23")).cast("array<long>")
    rows = vectors.filter(whole).select(F.col("vec_id").cast("long"), wide.alias("wide")).filter(fine)
    return rows.select("vec_id", F.when(fits, F.transform("wide", lambda x: F.floor(x).cast("long"))).otherwise(wrong).alias("q"))


def _pack(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans as 64-bit words, the first row in the lowest bit."""
    return np.packbits(bits, axis=-1, bitorder="little").view("<u8")


def build_blocks(rows: DataFrame, blocks: int) -> DataFrame:
    """The index: per block its vec_ids in order and, per component, offset and bit slices.

    Rows are dealt by a hash, so a block holds about 16,384 whatever the corpus.
    A component is stored as value minus the block's least value, in as many slices as
    that range needs. Vectors of different lengths are in different blocks.
    """

    def run(key: tuple, table: pa.Table) -> pa.Table:
        ids = table.column("vec_id").to_numpy()
        order = np.argsort(ids, kind="stable")
        dim, n = key[0].as_py(), len(ids)
        x = table.column("q").combine_chunks().flatten().to_numpy().reshape(n, dim)[order]
        low = x.min(axis=0) if dim else np.zeros(0, np.int64)
        bits = max(int((x - low).max()).bit_length(), 1) if dim else 1
        words = -(-n // 64)
        slices = np.zeros((dim, bits, words), "<u8")
        padded = np.zeros((dim, words * 64), np.int64)
        padded[:, :n] = (x - low).T
        for b in range(bits):
            slices[:, b] = _pack((padded >> b & 1).astype(bool))
        return pa.table(
            {
                "dim": pa.array([dim], pa.int32()),
                "block": pa.array([key[1].as_py()], pa.int64()),
                "bits": pa.array([bits], pa.int32()),
                "ids": pa.array([ids[order]], pa.list_(pa.int64())),
                "low": pa.array([low], pa.list_(pa.int64())),
                "slices": pa.array([slices.tobytes()], pa.binary()),
            }
        )

    salted = rows.select(
        F.size("q").alias("dim"), F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(blocks)).alias("block"), "vec_id", "q"
    )
    return salted.groupBy("dim", "block").applyInArrow(
        run, "dim int, block long, bits int, ids array<long>, low array<long>, slices binary"
    )


def _add(stack: list[np.ndarray]) -> list[np.ndarray]:
    """Adds bitmaps by weight: carry-save adders, three bitmaps to a sum and a carry, down to one slice per weight."""
    out, carried = [], []
    weight = 0
    while weight < len(stack) or carried:
        parts = carried + ([stack[weight]] if weight < len(stack) and len(stack[weight]) else [])
        now = np.concatenate(parts) if parts else np.zeros((0, out[0].shape[0] if out else 0), "<u8")
        carried = []
        while len(now) > 1:
            k = len(now) // 3
            if k:
                a, b, c = now[:k], now[k : 2 * k], now[2 * k : 3 * k]
                x = a ^ b
                carried.append((a & b) | (x & c))
                now = np.concatenate([x ^ c, now[3 * k :]]) if len(now) > 3 * k else x ^ c
            else:
                carried.append((now[0] & now[1])[None])
                now = (now[0] ^ now[1])[None]
        out.append(now[0] if len(now) else np.zeros(0, "<u8"))
        weight += 1
    return out


def score_slices(q: np.ndarray, slices: np.ndarray) -> tuple[list[np.ndarray], int]:
    """Bit slices of sum |q_d| * y_d over all rows of a block, and what to add to get sum q_d * (x_d - low_d).

    y is the stored component, or its complement where q_d is negative, so that only
    additions of shifted slices remain: bit j of |q_d| adds slice i at weight i + j.
    """
    dim, bits, words = slices.shape
    size = np.abs(q)
    top = int(size.max()).bit_length() if dim else 0
    plus, minus = q > 0, q < 0
    stack = []
    for weight in range(top + bits - 1 if top else 0):
        parts = []
        for j in range(max(0, weight - bits + 1), min(top, weight + 1)):
            has = (size >> j & 1).astype(bool)
            if (has & plus).any():
                parts.append(slices[has & plus, weight - j])
            if (has & minus).any():
                parts.append(~slices[has & minus, weight - j])
        stack.append(np.concatenate(parts) if parts else np.zeros((0, words), "<u8"))
    added = [s if len(s) else np.zeros(words, "<u8") for s in _add(stack)]
    return added, -int(size[minus].sum()) * ((1 << bits) - 1)


def select_top(added: list[np.ndarray], allowed: np.ndarray, k: int, words: int) -> np.ndarray:
    """Places of the k rows with the highest sums, lowest places first among equals.

    From the most significant slice down: rows surely above the boundary, and rows
    still equal to it. What is left equal at the end has one value; the lowest places win.
    """
    above, equal = np.zeros(words, "<u8"), allowed.copy()
    for s in reversed(added):
        ones = equal & s
        n = int(np.bitwise_count(above | ones).sum())
        if n > k:
            equal = ones
        else:
            above, equal = above | ones, equal & ~s
            if n == k:
                equal = np.zeros(words, "<u8")
                break
    sure = np.flatnonzero(np.unpackbits(above.view("u1"), bitorder="little"))
    ties = np.flatnonzero(np.unpackbits(equal.view("u1"), bitorder="little"))[: k - len(sure)]
    return np.concatenate([sure, ties])


def top_of_block(queries: list[tuple[int, np.ndarray]], ids: np.ndarray, low: np.ndarray, slices: np.ndarray, k: int) -> list[tuple]:
    """(query_id, vec_id, score) of each query's best k rows in one block; rows with its own vec_id left out."""
    words = slices.shape[2]
    valid = np.zeros(words * 64, bool)
    valid[: len(ids)] = True
    out = []
    for query, q in queries:
        added, shift = score_slices(q, slices)
        allowed = valid.copy()
        allowed[np.searchsorted(ids, query) : np.searchsorted(ids, query, side="right")] = False
        at = select_top(added, _pack(allowed), k, words)
        score = np.full(len(at), shift + int((q * low).sum()), np.int64)
        for b, s in enumerate(added):
            score += ((s[at >> 6] >> (at & 63).astype("<u8")) & np.uint64(1)).astype(np.int64) << b
        out += [(query, int(ids[p]), int(v)) for p, v in zip(at, score, strict=True)]
    return out


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: int = 256) -> DataFrame:
    """Each query's k candidates with the highest integer inner product, ties to the smaller vec_id.

    Candidates are all rows of ``vectors`` of the query's length, but those with its own
    vec_id. Queries go in blocks to every block of the index; a pair of blocks is one
    row of work of bounded size and leaves k rows per query. The pairs are dealt out evenly,
    so neither side is broadcast or collected. Columns: query_id, rank, vec_id, score.
    An empty side gives no rows; fewer candidates than k are all returned. A query row that
    occurs twice is answered once.
    """
    rows = quantised(vectors, scale)
    asked = quantised(queries, scale).distinct()
    n, m = rows.count(), asked.count()
    blocks, groups = max(1, -(-n // BLOCK_ROWS)), max(1, -(-m // QUERY_ROWS))
    index = build_blocks(rows, blocks)
    batch = F.pmod(F.xxhash64("vec_id"), F.lit(groups)).alias("batch")
    asked = asked.select(F.size("q").alias("dim"), batch, F.struct("vec_id", "q").alias("query"))
    asked = asked.groupBy("dim", "batch").agg(F.collect_list("query").alias("queries"))  # bounded by the block
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    work = index.join(asked, ["dim", "block"]).repartition(F.col("block"), F.col("batch"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                row = {c: b.column(c)[r] for c in b.schema.names}
                dim, bits = row["dim"].as_py(), row["bits"].as_py()
                ids, low = row["ids"].values.to_numpy(), row["low"].values.to_numpy()
                slices = np.frombuffer(row["slices"].as_buffer(), "<u8").reshape(dim, bits, -(-len(ids) // 64))
                queries_ = [(q["vec_id"], np.array(q["q"], np.int64)) for q in row["queries"].as_py()]
                found = top_of_block(queries_, ids, low, slices, k)
                cols = list(zip(*found)) if found else [[], [], []]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["query_id", "vec_id", "score"])

    work = work.select("dim", "bits", "ids", "low", "slices", "queries")
    best = work.mapInArrow(run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int"), "vec_id", "score")
