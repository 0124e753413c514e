"""Aligning the tokens of two tokenizers over the same text by their shared byte ends.

Both tokenizers encode the whole text (after one blank, which the second one adds
itself). Documents of a batch are laid end to end, and the bytes where tokens of both
end cut their groups, all documents at once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickevidence.llm.common import text_or_empty
from tickevidence.llm.encoding import Encoder, PieceEncoder, _byte_letters, groups
from tickevidence.session import stage_table

ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, groups string, links binary"
BLOCKS = (
    "block long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, groups_sha256 array<string>, "
    "sizes array<int>, links binary, pairs array<long>, counts array<long>"
)
SCORED = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)
#: Words of both tokenizers remembered per worker, about 200 bytes each; beyond that a new memory begins, and the
#: last one is kept beside it until the task ends.
MEMORY = 100_000
#: Links of one block of documents: the unit whose distinct pairs are counted and looked up together.
BLOCK_LINKS = 250_000
#: Bits of an id in a pair; a pair is the first id shifted by this many bits plus the second.
BITS = 24


def _slices(values: pa.Array, stops: np.ndarray) -> list[memoryview]:
    """The bytes of the values up to each stop, joined; ``stops`` are numbers of values and rise."""
    _, offsets, data = values.buffers()
    ends = np.frombuffer(offsets, np.int64)[np.concatenate([[0], stops])].tolist()
    view = memoryview(data or b"").cast("B")
    return [view[i:k] for i, k in zip(ends, ends[1:])]


def _spell(names: pa.Array, ids: list[np.ndarray]) -> list[memoryview]:
    """The bytes of each document's tokens."""
    if not ids:
        return []
    return _slices(names.take(pa.array(np.concatenate(ids))), np.cumsum([len(x) for x in ids]))


def _shared(one: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the values that two rising arrays share, in each of them."""
    if not len(one) or not len(other):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    place = np.minimum(np.searchsorted(other, one), len(other) - 1)
    same = other[place] == one
    return np.flatnonzero(same), place[same]


class Aligner:
    """Groups and links of texts under two tokenizers.

    ``first`` is a file of the tokenizers library with a byte-level vocabulary, ``second``
    a sentencepiece model. Strings of special tokens in a text are ordinary text.
    """

    def __init__(self, first: str, second: str):
        self.a, self.b = Encoder(first), PieceEncoder(second, MEMORY)
        self.a.memory = MEMORY
        vocabulary = self.a.full.get_vocab(with_added_tokens=True)
        bytes_of = {chr(letter): byte for byte, letter in _byte_letters().items()}
        bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            known = all(c in bytes_of for c in token)
            bytes_a[i] = bytes(bytes_of[c] for c in token) if known else token.encode()
        bytes_b = [self._piece(i) for i in range(self.b.model.get_piece_size())]
        self.bytes_a, self.bytes_b = pa.array(bytes_a, pa.large_binary()), pa.array(bytes_b, pa.large_binary())
        self.len_a, self.len_b = (np.array([len(x) for x in side]) for side in (bytes_a, bytes_b))
        # Decimal ids with the sign behind them: of the first side in a group and at its end there, then of the second.
        rows = ((len(bytes_a), ",|"), (len(bytes_b), ",;"))
        self.names = pa.array([f"{i}{sign}" for n, signs in rows for sign in signs for i in range(n)], pa.large_string())

    def _piece(self, i: int) -> bytes:
        piece = self.b.model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.model.is_byte(i) else piece.replace("\u2581", " ").encode()

    def align(self, texts: list[str]) -> list[tuple[int, int, int, memoryview, bytes]]:
        """Per text the numbers of tokens of both and of groups, the groups as ASCII text, and the links as packed pairs."""
        ids_a = [np.frombuffer(x, self.a.dtype) for x in self.a.encode_led(texts)]
        ids_b = [np.frombuffer(x, self.b.dtype) for x in self.b.encode(texts)]
        out = [(0, 0, 0, memoryview(b""), b"")] * len(texts)
        some = [k for k, t in enumerate(texts) if t and len(ids_a[k]) and len(ids_b[k])]
        # Both tokenizers must spell the text.
        spelled = [_spell(names, [ids[k] for k in some]) for names, ids in ((self.bytes_a, ids_a), (self.bytes_b, ids_b))]
        some = [k for k, one, other in zip(some, *spelled, strict=True) if one == other == b" " + texts[k].encode()]
        if some:
            for k, found in zip(some, self._align([ids_a[k] for k in some], [ids_b[k] for k in some]), strict=True):
                out[k] = (len(ids_a[k]), len(ids_b[k]), *found)
        return out

    def _align(self, ids_a: list[np.ndarray], ids_b: list[np.ndarray]) -> Iterator[tuple[int, memoryview, bytes]]:
        """Number of groups, groups and links of documents that both sides spell alike, laid end to end.

        Both sides of a document have the same bytes, so its end is shared, and no group reaches over it.
        """
        a, b = np.concatenate(ids_a).astype(np.int64), np.concatenate(ids_b).astype(np.int64)
        last_a, last_b = _shared(np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b]))
        # In the text, a group's tokens of the first side stand before those of the second.
        place_a = np.arange(len(a)) + np.repeat(np.concatenate([[0], last_b[:-1] + 1]), np.diff(last_a, prepend=-1))
        place_b = np.arange(len(b)) + np.repeat(last_a + 1, np.diff(last_b, prepend=-1))
        names = np.empty(len(a) + len(b), np.int32)
        names[place_a], names[place_b] = a, b + 2 * len(self.len_a)
        names[place_a[last_a]] += len(self.len_a)
        names[place_b[last_b]] += len(self.len_b)
        links = (a[last_a] << BITS | b[last_b]).astype("<i8").tobytes()
        stops_a = np.cumsum([len(x) for x in ids_a])
        tokens = stops_a + np.cumsum([len(x) for x in ids_b])
        shared = np.searchsorted(last_a, stops_a).tolist()
        at = 0
        for text, to in zip(_slices(self.names.take(pa.array(names)), tokens), shared, strict=True):
            yield to - at, text[:-1], links[8 * at : 8 * to]
            at = to


_LOADED: dict[tuple[str, str], Aligner] = {}


def aligner(first: str, second: str) -> Aligner:
    """One aligner per worker process and pair of vocabularies."""
    if (first, second) not in _LOADED:
        _LOADED[first, second] = Aligner(first, second)
    return _LOADED[first, second]


def _aligned(batches: Iterator[pa.RecordBatch], first: str, second: str) -> Iterator[tuple[list, list]]:
    """Ids of some documents and what the aligner says of each."""
    work = aligner(first, second)
    texts = ((d, t) for b in batches for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
    for group in groups(texts, 250, 1_000_000):
        yield [d for d, _ in group], work.align([t for _, t in group])
    work.a.forget_older()
    work.b.forget_older()


def align_documents(docs: DataFrame, first: str, second: str) -> DataFrame:
    """Each document's groups, ``a1,a2|b1;a3|b2,b3``, and links: pairs of ids (8 bytes each) that end together.

    NULL and empty texts, and texts that one tokenizer does not spell back byte by byte,
    have no tokens. A NULL doc_id and repeated rows are documents like all others.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        names = ["doc_id", "n_a", "n_b", "n_groups", "groups", "links"]
        for ids, found in _aligned(batches, first, second):
            columns = [ids, *map(list, zip(*((*n, str(text, "ascii"), links) for *n, text, links in found)))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInArrow(run, ALIGNED)


def align_in_blocks(docs: DataFrame, first: str, second: str) -> DataFrame:
    """The same, neighbouring documents as one row, with the digests of their groups.

    Links are numbers into the block's own list of distinct pairs, which has counts. Groups
    are hashed where they are made, so their text, longer than the documents, never leaves the task.
    """
    names = [part.strip().split(" ")[0] for part in BLOCKS.split(",")]

    def close(rows: list[tuple], block: int) -> pa.RecordBatch:
        doc_id, n_a, n_b, n_groups, sha, links = zip(*rows)
        pairs, which, counts = np.unique(np.frombuffer(b"".join(links), "<i8"), return_inverse=True, return_counts=True)
        values = [
            ([block], pa.int64()),
            *[([list(c)], pa.list_(pa.int64())) for c in (doc_id, n_a, n_b, n_groups)],
            ([list(sha)], pa.list_(pa.string())),
            ([[len(x) // 8 for x in links]], pa.list_(pa.int32())),
            ([which.astype("<u2" if len(pairs) <= 65_536 else "<u4").tobytes()], pa.binary()),
            ([pairs], pa.list_(pa.int64())),
            ([counts], pa.list_(pa.int64())),
        ]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in values], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        block = (task.partitionId() if task else 0) << 32
        rows, held = [], 0
        for ids, found in _aligned(batches, first, second):
            for doc_id, (n_a, n_b, n_groups, text, links) in zip(ids, found, strict=True):
                sha = hashlib.sha256(text).hexdigest() if n_a else ""
                rows.append((doc_id, n_a, n_b, n_groups, sha, links))
                held += len(links) // 8
            if held >= BLOCK_LINKS or len(rows) >= BLOCK_LINKS:
                yield close(rows, block)
                rows, held, block = [], 0, block + 1
        if rows:
            yield close(rows, block)

    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInArrow(run, BLOCKS)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """Each linked pair of ids with its links in all documents, and whether no other pair of its second id has more.

    A window holds the pairs of one second id, at most as many as the first vocabulary has ids.
    """
    each = blocks.select(F.explode(F.arrays_zip("pairs", "counts")).alias("e")).select("e.pairs", "e.counts")
    counted = each.groupBy(F.col("pairs").alias("pair")).agg(F.sum("counts").alias("count"))
    second = F.col("pair").bitwiseAND(F.lit((1 << BITS) - 1))
    return counted.withColumn("best", F.col("count") == F.max("count").over(Window.partitionBy(second)))


def score_links(blocks: DataFrame) -> DataFrame:
    """Per document of :func:`align_in_blocks`: its links whose count is the highest of their second id, and the sum of its links' counts.

    Only the distinct pairs of each block, not all links, go to the corpus-wide counts
    and back, so a frequent pair is one row per block.
    """
    blocks = stage_table(blocks, "aligned")
    pairs = pair_counts(blocks)
    places = blocks.select("block", F.posexplode("pairs").alias("place", "pair")).join(pairs, "pair")
    known = places.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("place", "count", "best"))).alias("known"))
    known = known.select("block", F.col("known.count").alias("count"), F.col("known.best").alias("best"))
    cols = ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "sizes", "links", "count", "best"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = [c[k] for c in batch.columns]
                doc_id, n_a, n_b, n_groups, sha = [c.values for c in row[:5]]
                sizes = row[5].values.to_numpy(zero_copy_only=False).astype(np.int64)
                packed = row[6].as_py()
                which = np.frombuffer(packed, "<u2" if len(packed) == 2 * sizes.sum() else "<u4")
                empty = not row[7].is_valid
                count = np.zeros(0, np.int64) if empty else row[7].values.to_numpy(zero_copy_only=False)
                best = np.zeros(0, np.int64) if empty else row[8].values.to_numpy(zero_copy_only=False).astype(np.int64)
                stops = np.cumsum(sizes)
                sums = []
                for values in (best, count):
                    running = np.concatenate([[0], np.cumsum(values[which])])
                    sums.append(pa.array(running[stops] - running[stops - sizes], pa.int64()))
                columns = [doc_id, n_a, n_b, n_groups, pa.array(sizes, pa.int64()), *sums, sha]
                yield pa.RecordBatch.from_arrays(columns, names=[part.strip().split(" ")[0] for part in SCORED.split(",")])

    return blocks.join(known, "block", "left").select(*cols).mapInArrow(run, SCORED)
