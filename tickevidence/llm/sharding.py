"""Seeded two-pass shuffle into shards: scatter into memory-sized buckets, then Fisher-Yates inside each bucket."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickevidence.session import scratch_path

#: UTF-8 bytes of text in a bucket, on average.
BUCKET_BYTES = 24_000_000


def shard_of(key: str, shards: int, seed: int) -> Column:
    """Rendezvous hashing: the shard whose hash with the key is highest.

    Key and shard count decide. With one more shard, a key moves only when the new
    shard's hash is the highest. NULL keys hash like any value.
    """
    marks = [F.xxhash64(F.col(key), F.lit(s), F.lit(seed)) for s in range(shards)]
    found = F.lit(0)
    best = marks[0]
    for s in range(1, shards):
        found = F.when(marks[s] > best, F.lit(s)).otherwise(found)
        best = F.greatest(best, marks[s])
    return found.cast("int")


def shuffle_into_shards(
    docs: DataFrame, shards: int = 8, seed: int = 17, bucket_bytes: int = BUCKET_BYTES, path: str | None = None
) -> DataFrame:
    """All rows in shards by doc_id, in a seeded random order, written below ``path`` and read back.

    Pass one scatters the rows of a shard uniformly over its buckets by a seeded hash
    of doc_id and row position, so that rows sharing a doc_id or a text spread as
    well. Pass two sorts a bucket by content, shuffles it (Fisher-Yates, seeded by
    bucket) and writes it: one file per bucket, in a folder per shard. The number of
    buckets follows the bytes of each shard, memory the bucket, not the corpus.

    A NULL text has size 1 (no bytes) and a NULL crc32 of the empty text. Columns:
    doc_id, text, size, text_crc32, grown_shard, bucket, place (0, 1, ... in a bucket), shard.
    """
    raw = docs.select(F.col("doc_id").cast("long"), "text")
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    body = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    rows = raw.withColumns(
        {
            "size": size,
            "text_crc32": F.crc32(body),
            "shard": shard_of("doc_id", shards, seed),
            "grown_shard": shard_of("doc_id", shards + 1, seed),
        }
    )
    # At most one row per shard comes to the driver.
    sizes = {r["shard"]: r["bytes"] for r in rows.groupBy("shard").agg(F.sum("size").alias("bytes")).collect()}
    buckets = [max(1, -(-sizes.get(s, 0) // bucket_bytes)) for s in range(shards)]
    first = [sum(buckets[:s]) for s in range(shards)]
    total = sum(buckets)
    pick = F.pmod(F.xxhash64("doc_id", F.monotonically_increasing_id(), F.lit(seed + 1)), F.get(F.array(*map(F.lit, buckets)), "shard"))
    scattered = rows.withColumn("bucket", (F.get(F.array(*map(F.lit, first)), "shard") + pick).cast("int"))

    def permute(table: pa.Table) -> Iterator[pa.RecordBatch]:
        """One bucket in its new order."""
        number = table.column("bucket")[0].as_py()
        ids = table.column("doc_id")
        keys = np.lexsort(
            (table.column("text_crc32").to_numpy(), ids.is_valid().to_numpy(), ids.fill_null(0).to_numpy())
        )
        np.random.default_rng([seed, number]).shuffle(keys)  # Fisher-Yates
        place = np.arange(len(keys), dtype=np.int64)
        for at in range(0, len(keys), 1000):
            part = table.take(pa.array(keys[at : at + 1000]))
            part = part.append_column("place", pa.array(place[at : at + 1000]))
            yield from part.combine_chunks().to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:  # the partition is one bucket
            yield from permute(pa.Table.from_batches(held))

    schema = "doc_id long, text string, size long, text_crc32 long, grown_shard int, bucket int, shard int, place long"
    dealt = scattered.select("doc_id", "text", "size", "text_crc32", "grown_shard", "bucket", "shard").repartitionById(
        total, "bucket"
    )
    path = path or scratch_path(docs.sparkSession, "shards")
    dealt.mapInArrow(run, schema).write.partitionBy("shard").parquet(path)
    return docs.sparkSession.read.schema(
        "doc_id long, text string, size long, text_crc32 long, grown_shard int, bucket int, place long, shard int"
    ).parquet(path)


def with_slots(written: DataFrame) -> DataFrame:
    """Slot of each row in its shard: rows of the shard's earlier buckets plus its place in its own."""
    counts = written.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return written.join(base, "bucket").withColumn("slot", F.col("base") + F.col("place")).drop("base")
