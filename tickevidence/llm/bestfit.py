"""Packing whole documents into windows by bulk-synchronous best fit.

Documents of one length are a run, and so are open sequences with one room (a gap);
both are kept as (size, first number, count). In a round, the runs of both are ranged by
size into bands: a gap by its room, a document by its successor, the tightest gap that
holds it. Each band is sorted and swept on its own. Where runs reach for the same gaps,
rank decides: longer documents first, and within a length the earlier ones; who gets
none moves on to the next band with room in the next round. Gaps shrink, and rounds
repeat until no document is left. A sweep sees one row per length and per gap run, at most
a few thousand for a window of some thousand tokens, however many documents a run
counts; documents themselves are ranked once before the rounds and placed once after them.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickevidence.llm.common import map_arrow, numbered, text_or_empty
from tickevidence.llm.encoding import groups, id_bytes, ids_crc32, word_end_encoder
from tickevidence.session import stage_table

PIECES = "row_key long, doc_id long, piece int, start long, length long, id_width int, ids binary"
RUNS = "kind int, size long, start long, n long, sequence long, slots long"
#: Kinds of runs. A move puts documents start .. start + n - 1 of a length into sequences from ``sequence`` on, ``slots`` each.
GAP, DOC, MOVE = 0, 1, 2
#: Sizes of a band differ by less than this factor.
BAND = 8
#: Ranks of one length that meet their moves together.
RANK_BLOCK = 4096


def encode_pieces(docs: DataFrame, tokenizer: str, end_id: int, window: int) -> DataFrame:
    """Pieces of at most ``window`` ids of each document with its end id; only longer documents have more than one.

    ``row_key`` tells pieces apart: the task's number and a running one. A NULL or empty
    text is the end id alone. Write the result once, then the keys stay.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = word_end_encoder(tokenizer)
        width = enc.dtype.itemsize
        end = id_bytes(enc.dtype, end_id)
        task = TaskContext.get()
        key = (task.partitionId() if task else 0) << 33
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
        names = [part.strip().split(" ")[0] for part in PIECES.split(",")]
        texts = (
            (d, t) for b in batches for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)
        )
        for group in groups(texts):
            rows = []
            for (doc, _), ids in zip(group, enc.encode([t for _, t in group]), strict=True):
                ids += end
                for k, at in enumerate(range(0, len(ids), window * width)):
                    part = ids[at : at + window * width]
                    rows.append((key, doc, k, at // width, len(part) // width, width, part))
                    key += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types, strict=True)], names=names)

    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInArrow(run, PIECES)


def band_of(size: int) -> int:
    """0 for sizes below BAND, 1 below its square, and so on."""
    band = 0
    while size >= BAND ** (band + 1):
        band += 1
    return band


def sweep(docs: list[tuple], gaps: list[tuple], lowest: int) -> list[tuple]:
    """Best fit of one band's documents (size, first, n) into its gaps (room, sequence, n), as rows of RUNS.

    Documents of one length go on filling the gap they are in while it holds another, as
    they would one by one. What is left of a gap is open again at once unless it is below
    ``lowest``, where another band begins.
    """
    gaps, rows, left = sorted(gaps), [], []

    def give(room: int, sequence: int, n: int) -> None:
        if n and room >= lowest:
            bisect.insort(gaps, (room, sequence, n))
        elif n and room:
            left.append((GAP, room, sequence, n, 0, 0))

    for size, first, n in sorted(docs, reverse=True):
        while n:
            at = bisect.bisect_left(gaps, (size, -1, 0))
            if at == len(gaps):
                left.append((DOC, size, first, n, 0, 0))
                break
            room, sequence, wide = gaps.pop(at)
            slots = room // size
            put, full = min(n, wide * slots), min(n // slots, wide)
            rows.append((MOVE, size, first, put, sequence, slots))
            first, n = first + put, n - put
            rest = put - full * slots
            give(room - slots * size, sequence, full)
            give(room - rest * size, sequence + full, 1 if rest else 0)
            full += 1 if rest else 0
            give(room, sequence + full, wide - full)
    return rows + left + [(GAP, *g, 0, 0) for g in gaps]


def _round(state: DataFrame, rooms: dict[int, int]) -> DataFrame:
    """All bands' sweeps; ``rooms`` is the widest gap of each band that has gaps."""

    def run(band: pd.DataFrame) -> pd.DataFrame:
        rows = band[["kind", "size", "start", "n"]].itertuples(index=False, name=None)
        docs, gaps = [], []
        for kind, *run in rows:
            (docs if kind == DOC else gaps).append(tuple(run))
        number = int(band["band"].iloc[0])
        lowest = 1 if number == 0 else BAND**number
        return pd.DataFrame(sweep(docs, gaps, lowest), columns=["kind", "size", "start", "n", "sequence", "slots"])

    size = F.col("size")
    own = reduce(lambda got, k: F.when(size >= BAND**k, k).otherwise(got), range(1, max(rooms) + 1), F.lit(0))
    successor = reduce(lambda got, k: F.when((own <= k) & (size <= rooms[k]), k).otherwise(got), sorted(rooms, reverse=True), F.lit(None).cast("int"))
    band = F.when(F.col("kind") == DOC, successor).otherwise(own)
    return state.withColumn("band", band).groupBy("band").applyInPandas(run, RUNS)


def match_rounds(spark: SparkSession, lengths: DataFrame, window: int) -> list[DataFrame]:
    """The moves of all rounds for ``lengths`` (size up to ``window``, n), the number of documents of each length.

    Where documents have no successor, as many new sequences open as their tokens, or
    those over half a window, need in any case; so none is opened in vain. The driver sees
    one row of totals per band and round.
    """
    zero = F.lit(0).cast("long")
    docs = lengths.select(F.lit(DOC).alias("kind"), "size", zero.alias("start"), "n", zero.alias("sequence"), zero.alias("slots"))
    state = stage_table(docs, "runs")
    moves, opened = [], 0
    while True:
        sizes = [F.when(F.col("size") >= BAND**k, 1).otherwise(0) for k in range(1, band_of(window) + 1)]
        totals = state.groupBy("kind", reduce(Column.__add__, sizes, F.lit(0)).alias("band")).agg(F.max("size").alias("top")).collect()
        longest = max((r["top"] for r in totals if r["kind"] == DOC), default=None)
        if longest is None:
            return moves
        rooms = {r["band"]: r["top"] for r in totals if r["kind"] == GAP}
        widest = max(rooms.values(), default=0)
        if longest > widest:
            lost = state.filter((F.col("kind") == DOC) & (F.col("size") > widest))
            half = F.when(F.col("size") * 2 > window, F.col("n")).otherwise(0)
            need = lost.agg(F.sum(F.col("size") * F.col("n")).alias("tokens"), F.sum(half).alias("large")).first()
            new = max(-(-need["tokens"] // window), need["large"])
            state = state.unionByName(spark.createDataFrame([(GAP, window, opened, new, 0, 0)], RUNS))
            opened += new
            rooms[band_of(window)] = window
        made = stage_table(_round(state, rooms), "round")
        moves.append(made.filter(F.col("kind") == MOVE).drop("kind"))
        state = made.filter(F.col("kind") != MOVE)


def place(pieces: DataFrame, window: int) -> DataFrame:
    """row_key, sequence_id and offset of each piece (row_key, length). Full windows are sequences of their own, below 0."""
    spark = pieces.sparkSession
    full = pieces.filter(F.col("length") == window)
    full = full.select("row_key", (-1 - F.col("row_key")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = pieces.filter(F.col("length") < window).select("row_key", F.col("length").alias("size"))
    lengths = rest.groupBy("size").agg(F.count(F.lit(1)).alias("n"))
    moves = match_rounds(spark, lengths, window)
    if not moves:
        return full
    moves = reduce(DataFrame.unionByName, moves).select("size", F.col("start").alias("first"), F.col("n").alias("count"), "sequence", "slots")
    ranks = F.sequence(F.floor(F.col("first") / RANK_BLOCK), F.floor((F.col("first") + F.col("count") - 1) / RANK_BLOCK))
    moves = moves.withColumn("block", F.explode(ranks))
    ranked = numbered(rest, ["size"], ["row_key"], "ranked").withColumn("block", F.floor(F.col("position") / RANK_BLOCK))
    found = ranked.join(moves, ["size", "block"]).filter("position >= first AND position < first + count")
    number = F.floor((F.col("position") - F.col("first")) / F.col("slots"))
    found = found.select("row_key", "size", (F.col("sequence") + number).alias("sequence_id"))
    before = Window.partitionBy("sequence_id").orderBy(F.desc("size"), "row_key").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("size").over(before), F.lit(0))
    return full.unionByName(found.select("row_key", "sequence_id", offset.alias("offset")))


def pack_whole(docs: DataFrame, tokenizer: str, end_id: int = 1, window: int = 4096) -> DataFrame:
    """Pieces of all documents (doc_id, piece, start, length, id_width, ids) with their sequence and offset.

    A document of at most ``window`` ids stays whole. NULL ids and repeated rows are
    packed like any other row; an empty table gives no pieces. ``ids`` holds
    ``id_width`` bytes per id, little-endian. Sequence numbers are unique, not gapless.
    """
    pieces = stage_table(encode_pieces(docs, tokenizer, end_id, window), "whole-pieces")
    places = place(pieces.select("row_key", "length"), window)
    return pieces.join(places, "row_key").drop("row_key")


def piece_digests(packed: DataFrame) -> DataFrame:
    """The packed pieces with the crc32 of their ids instead of the ids."""
    keep = ["doc_id", "piece", "start", "length", "sequence_id", "offset"]

    def crc(batch: pa.RecordBatch) -> pa.RecordBatch:
        widths, ids = batch.column(6).to_pylist(), batch.column(7).to_pylist()
        crcs = [ids_crc32(np.frombuffer(b, f"<u{w}")) for w, b in zip(widths, ids, strict=True)]
        return pa.RecordBatch.from_arrays([*batch.columns[:6], pa.array(crcs, pa.int64())], names=[*keep, "ids_crc32"])

    schema = "doc_id long, piece int, start long, length long, sequence_id long, offset long, ids_crc32 long"
    return map_arrow(packed, [*keep, "id_width", "ids"], crc, schema, 4096)
