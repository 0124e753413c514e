"""Raw token-id shards with a minimal perfect hash index from document keys to shard offsets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickevidence.llm.common import map_arrow, slices, text_or_empty
from tickevidence.llm.encoding import encoder, id_bytes, ids_crc32

SHARDS = "part long, shard long, id_width int, keys array<long>, copies array<long>, lengths array<long>, payload binary"
#: Bytes after which a shard is closed, and documents; a longer document makes a longer shard.
SHARD_BYTES, SHARD_DOCS = 8_000_000, 50_000
#: Mean number of keys in a bucket of the index, and of keys that share one displacement.
BUCKET_KEYS, GROUP_KEYS = 2_048, 4


# -- shards -----------------------------------------------------------------------------------


def write_shards(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """The shards of all documents in ascending doc_id order; the caller writes the table.

    A shard is a row: ``payload`` holds the ids of its documents one after another,
    ``id_width`` bytes each, little-endian, nothing between them. ``keys``, ``copies``
    and ``lengths`` (in ids) list its documents in order; they are the source of the
    index and are not read for a lookup. Each document ends with ``end_id``; an empty
    or NULL text is that id alone. Rows with the same doc_id stay next to each other,
    ordered by text, and are numbered 0, 1, ... in ``copies``. A NULL doc_id sorts first.
    Shard numbers ascend with the order: range partition times 2**24 plus a running number.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        width, end = enc.dtype.itemsize, id_bytes(enc.dtype, end_id)
        task = TaskContext.get()
        part = task.partitionId() if task else 0
        shard = part << 24
        keys, copies, lengths, payload, size = [], [], [], [], 0
        last, copy = object(), 0
        schema = pa.schema(
            [("part", pa.int64()), ("shard", pa.int64()), ("id_width", pa.int32())]
            + [(n, pa.list_(pa.int64())) for n in ("keys", "copies", "lengths")]
            + [("payload", pa.binary())]
        )

        def close() -> pa.RecordBatch:
            row = [[part], [shard], [width], [keys], [copies], [lengths], [b"".join(payload)]]
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

        for piece in slices(batches, 250):
            docs_, texts = piece.column(0).to_pylist(), piece.column(1).to_pylist()
            for doc, body in zip(docs_, enc.encode(texts), strict=True):
                copy = copy + 1 if doc == last else 0
                last = doc
                body += end
                keys.append(doc)
                copies.append(copy)
                lengths.append(len(body) // width)
                payload.append(body)
                size += len(body)
                if size >= SHARD_BYTES or len(keys) >= SHARD_DOCS:
                    yield close()
                    shard += 1
                    keys, copies, lengths, payload, size = [], [], [], [], 0
        if keys:
            yield close()

    rows = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return ordered.mapInArrow(run, SHARDS)


def directory(shards: DataFrame) -> DataFrame:
    """One row per document: key, copy, shard, offset (in ids) and length; the payload is not read."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        shard = batch.column(0).to_pylist()
        keys, copies, lengths = (batch.column(k).to_pylist() for k in (1, 2, 3))
        n = [len(x) for x in keys]
        offsets = [np.concatenate(([0], np.cumsum(x[:-1], dtype=np.int64))) for x in lengths]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([k for x in keys for k in x], pa.int64()),
                pa.array([k for x in copies for k in x], pa.int64()),
                pa.array(np.repeat(np.array(shard, np.int64), n)),
                pa.array(np.concatenate(offsets) if offsets else np.zeros(0, np.int64), pa.int64()),
                pa.array([k for x in lengths for k in x], pa.int64()),
            ],
            names=["doc_id", "copy", "shard", "offset", "length"],
        )

    return map_arrow(
        shards, ["shard", "keys", "copies", "lengths"], run, "doc_id long, copy long, shard long, offset long, length long", 8
    )


def records(shards: DataFrame) -> DataFrame:
    """What the payloads hold: for each stored document its shard, offset, length and the crc32 of its ids."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[list] = [[], [], [], [], []]
        for part, shard, width, lengths, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            ids, at = np.frombuffer(body, f"<u{width}"), 0
            for n in lengths:
                for col, v in zip(out, (part, shard, at, n, ids_crc32(ids[at : at + n])), strict=True):
                    col.append(v)
                at += n
        names = ["part", "shard", "offset", "n_tokens", "ids_crc32"]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=names)

    cols = ["part", "shard", "id_width", "lengths", "payload"]
    return map_arrow(shards, cols, run, "part long, shard long, offset long, n_tokens long, ids_crc32 long", 1)


def shard_starts(shards: DataFrame) -> DataFrame:
    """Ids of all shards before each one: summed inside a range partition, then over the partitions.

    The second sum has one row per range partition, whose number the session bounds.
    """
    sizes = shards.select("part", "shard", F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    before = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    inside = sizes.select("part", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("inside"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n").alias("n"))
    base = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    return inside.join(base, "part").select("shard", (F.col("base") + F.col("inside")).alias("shard_start"))


# -- minimal perfect hash ---------------------------------------------------------------------


def key_hash() -> Column:
    return F.xxhash64("doc_id", "copy")


def _mix(h: np.ndarray, salt: int | np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: multiply and shift rounds over the hash and a salt (or salts, against all hashes)."""
    with np.errstate(over="ignore"):
        x = h ^ (np.asarray(salt, np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def displacements(hashes: np.ndarray) -> np.ndarray:
    """Hash and displace: one displacement per group of keys, so that n distinct keys fill slots 0..n-1.

    Large groups choose first. A key's slot is ``mix(hash, displacement + 2) mod n``.
    """
    n = len(hashes)
    if len(np.unique(hashes)) < n:
        raise ValueError("two keys of the index share their 64-bit hash")
    groups = max(1, -(-n // GROUP_KEYS))
    group = (_mix(hashes, 1) % np.uint64(groups)).astype(np.int64)
    order = np.argsort(group, kind="stable")
    bounds = np.searchsorted(group[order], np.arange(groups + 1))
    out, free = np.zeros(groups, np.int64), np.ones(n, bool)
    trial = np.arange(64)
    for g in np.argsort(-(bounds[1:] - bounds[:-1]), kind="stable"):
        own = hashes[order[bounds[g] : bounds[g + 1]]]
        if not len(own):
            break
        at = 0
        while True:
            slots = (_mix(own[None], (trial + at + 2)[:, None]) % np.uint64(n)).astype(np.int64)
            good = free[slots].all(axis=1)
            if len(own) > 1:
                s = np.sort(slots, axis=1)
                good &= (s[:, 1:] != s[:, :-1]).all(axis=1)
            if good.any():
                k = int(good.argmax())
                out[g], free[slots[k]] = at + k, False
                break
            at += 64
    return out


def slots_of(hashes: np.ndarray, disp: np.ndarray, n: int) -> np.ndarray:
    group = (_mix(hashes, 1) % np.uint64(len(disp))).astype(np.int64)
    return (_mix(hashes, disp[group] + 2) % np.uint64(n)).astype(np.int64)


def bucket_count(keys: int) -> int:
    return max(1, -(-keys // BUCKET_KEYS))


def build_index(entries: DataFrame, buckets: int) -> DataFrame:
    """One row per bucket of about 2,048 keys: displacements, and by slot fingerprint, shard, offset and length.

    Keys are (doc_id, copy), distinct; a bucket is one group, so memory is bounded by
    the bucket whatever the corpus. A lookup costs two hashes and one slot. Stored are
    fingerprints instead of keys: 32 bits taken from the key's hash besides the bits
    that placed it, so an absent key is told with an error of 2**-32.
    """

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        h = rows.column("hash").to_numpy().view(np.uint64)
        disp = displacements(h)
        slot = slots_of(h, disp, len(h))
        order = np.argsort(slot)
        cols = {c: rows.column(c).to_numpy()[order] for c in ("shard", "offset", "length")}
        prints = (_mix(h, 0) >> np.uint64(32)).astype(np.int64)[order]
        one = lambda v: pa.array([v], pa.list_(pa.int64()))
        return pa.table(
            [pa.array([key[0].as_py()], pa.int64()), one(disp), one(prints), *(one(cols[c]) for c in ("shard", "offset", "length"))],
            names=["bucket", "displacements", "prints", "shard", "offset", "length"],
        )

    h = entries.select(key_hash().alias("hash"), "shard", "offset", "length").withColumn("bucket", F.pmod("hash", F.lit(buckets)))
    return h.groupBy("bucket").applyInArrow(
        run,
        "bucket long, displacements array<long>, prints array<long>, shard array<long>, offset array<long>, length array<long>",
    )


def lookup(keys: DataFrame, index: DataFrame, buckets: int) -> DataFrame:
    """Shard, offset and length of each distinct (doc_id, copy); NULL where the index has no such key."""

    def run(key: tuple, asked: pa.Table, bucket: pa.Table) -> pa.Table:
        n = asked.num_rows
        out = {c: np.zeros(n, np.int64) for c in ("shard", "offset", "length")}
        known = np.zeros(n, bool)
        if n and bucket.num_rows:
            h = asked.column("hash").to_numpy().view(np.uint64)
            cell = {c: np.array(bucket.column(c)[0].as_py(), np.int64) for c in bucket.column_names if c != "bucket"}
            slot = slots_of(h, cell["displacements"], len(cell["prints"]))
            known = cell["prints"][slot] == (_mix(h, 0) >> np.uint64(32)).astype(np.int64)
            for c in out:
                out[c] = cell[c][slot]
        return pa.table(
            [asked.column("doc_id"), asked.column("copy"), *(pa.array(v, pa.int64(), mask=~known) for v in out.values())],
            names=["doc_id", "copy", *out],
        )

    asked = keys.select(F.col("doc_id").cast("long"), F.col("copy").cast("long")).distinct()
    asked = asked.withColumn("hash", key_hash()).withColumn("bucket", F.pmod("hash", F.lit(buckets)))
    return (
        asked.groupBy("bucket")
        .cogroup(index.groupBy("bucket"))
        .applyInArrow(run, "doc_id long, copy long, shard long, offset long, length long")
    )


def read_ids(located: DataFrame, shards: DataFrame) -> DataFrame:
    """The ids of located documents, cut out of the payloads: doc_id, copy, ids."""
    rows = located.filter("shard IS NOT NULL").join(shards.select("shard", "id_width", "payload"), "shard")
    part = F.expr("substring(payload, cast(offset * id_width + 1 as int), cast(length * id_width as int))")
    return rows.select("doc_id", "copy", "id_width", part.alias("ids"))


def document_keys(docs: DataFrame) -> DataFrame:
    """The keys of a table's rows: doc_id, and 0, 1, ... for rows that share it."""
    counts = docs.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select("doc_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("copy"))
