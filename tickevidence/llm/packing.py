"""Packing token ids into windows: best-fit decreasing over a segment tree of remaining capacities."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickevidence.llm.common import map_arrow, text_or_empty
from tickevidence.llm.encoding import encoder, groups, id_bytes, ids_crc32

PIECES = (
    "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, id_width int, ids binary"
)
#: Remainders that one round of packing holds, and the bytes of their ids.
ROUND_PIECES, ROUND_BYTES = 16_384, 32_000_000


class CapacityTree:
    """Counts of open windows by remaining capacity; finds the tightest one that still fits.

    A leaf per capacity 0..size, an inner node the sum of its leaves.
    """

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.sums = [0] * (2 * self.leaves)

    def add(self, capacity: int, change: int) -> None:
        node = capacity + self.leaves
        while node:
            self.sums[node] += change
            node >>= 1

    def tightest(self, need: int) -> int:
        """The smallest capacity of an open window that is at least ``need``; -1 when none is."""
        sums, node = self.sums, need + self.leaves
        while not sums[node]:
            while node & 1:  # climb until there is a right neighbour
                node >>= 1
            if not node:
                return -1
            node += 1
        while node < self.leaves:
            node *= 2
            if not sums[node]:
                node += 1
        return node - self.leaves


def best_fit(lengths: list[int], window: int) -> list[tuple[int, int]]:
    """(window number, offset) of each length, longest first, each into the tightest open window.

    Lengths are 1 to ``window``; equal lengths keep their order.
    """
    tree = CapacityTree(window)
    open_at: list[list[int]] = [[] for _ in range(window + 1)]
    out: list[tuple[int, int]] = [(0, 0)] * len(lengths)
    used = 0
    for k in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        room = tree.tightest(lengths[k])
        if room < 0:
            room, number = window, used
            used += 1
        else:
            number = open_at[room].pop()
            tree.add(room, -1)
        out[k] = (number, window - room)
        left = room - lengths[k]
        if left:
            open_at[left].append(number)
            tree.add(left, 1)
    return out


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 0, window: int = 1024) -> DataFrame:
    """Pieces of all documents with their place in sequences of at most ``window`` ids.

    A document's ids are those of its whole text plus ``end_id``; an empty or NULL
    text is the end id alone. Full windows are cut off first and fill a sequence
    each; remainders are packed best-fit decreasing in rounds of up to 16,384
    within a partition, so no shuffle and no global list is needed, and each round
    leaves about one window open. ``ids`` holds ``id_width`` bytes per id, little-endian.
    ``sequence_id`` is the partition's number times 2**32 plus a running number. A
    NULL doc_id and repeated rows are packed like any other row. Write the result
    once: partitions of a scan are the unit of repeatability.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        width = enc.dtype.itemsize
        end = id_bytes(enc.dtype, end_id)
        task = TaskContext.get()
        sequence = (task.partitionId() if task else 0) << 32
        schema = pa.schema(
            [(n, pa.int64()) for n in ("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset")]
            + [("id_width", pa.int32()), ("ids", pa.binary())]
        )

        def table(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)

        def close(rest: list[tuple]) -> list[tuple]:
            nonlocal sequence
            places = best_fit([r[2] for r in rest], window)
            first, sequence = sequence, sequence + 1 + max(p[0] for p in places)
            return [(*r[:4], first + n, at, width, r[4]) for r, (n, at) in zip(rest, places, strict=True)]

        rest: list[tuple] = []
        held = 0
        texts = (
            (d, t) for b in batches for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)
        )
        for group in groups(texts):
            rows = []
            for (doc, _), body in zip(group, enc.encode([t for _, t in group]), strict=True):
                body += end
                n = len(body) // width
                full = n // window
                for k in range(full):
                    part = body[k * window * width : (k + 1) * window * width]
                    rows.append((doc, k * window, window, n, sequence, 0, width, part))
                    sequence += 1
                if n > full * window:
                    part = body[full * window * width :]
                    rest.append((doc, full * window, n - full * window, n, part))
                    held += len(part)
            if len(rest) >= ROUND_PIECES or held >= ROUND_BYTES:
                rows += close(rest)
                rest, held = [], 0
            for at in range(0, len(rows), 4096):
                yield table(rows[at : at + 4096])
        if rest:
            rows = close(rest)
            for at in range(0, len(rows), 4096):
                yield table(rows[at : at + 4096])
        enc.forget_older()  # the worker outlives its task, and stages of other work follow in it

    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInArrow(run, PIECES)


def piece_digests(pieces: DataFrame) -> DataFrame:
    """The pieces with the crc32 of their ids instead of the ids."""
    keep = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset"]

    def crc(batch: pa.RecordBatch) -> pa.RecordBatch:
        widths, ids = batch.column(6).to_pylist(), batch.column(7).to_pylist()
        crcs = [ids_crc32(np.frombuffer(b, f"<u{w}")) for w, b in zip(widths, ids, strict=True)]
        return pa.RecordBatch.from_arrays(
            [*batch.columns[:6], pa.array(crcs, pa.int64())], names=[*keep, "ids_crc32"]
        )

    schema = ", ".join(f"{c} long" for c in [*keep, "ids_crc32"])
    return map_arrow(pieces, [*keep, "id_width", "ids"], crc, schema, 4096)
