"""File sources, append-only sinks, committed revisions and artifact verification.

Nothing here overwrites. A revision becomes visible through one appended commit
row; readers join commits and re-check every file's hash.
"""

from __future__ import annotations

import csv
import hashlib
import io
import os
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickevidence.operators.explorer import latest_per_key

ARTIFACT_SCHEMA = "path string, sha256 string, size_bytes bigint"
COMMIT_SCHEMA = (
    "trading_date date, revision string, committed_at timestamp, status string, "
    "artifacts array<struct<path:string,sha256:string,size_bytes:bigint>>, row_counts map<string,bigint>"
)


# Sources ------------------------------------------------------------------------


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Names of the first line as they stand; names that are blank or repeated, white space aside, are an error."""
    first = spark.read.text(path).limit(1).select(F.regexp_replace("value", "^﻿", "").alias("v"))
    rows = first.collect()
    if not rows:
        raise ValueError("empty file")
    names = next(csv.reader(io.StringIO(rows[0]["v"])))
    trimmed = [n.strip() for n in names]
    if any(not n for n in trimmed) or len(set(trimmed)) != len(names):
        raise ValueError("header names must be non-empty and unique")
    return names


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Every column as text; a line with another number of fields fails the read, and so does a file with another header."""
    names = csv_header(spark, path)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    rows = spark.read.schema(schema).csv(path, header=True, enforceSchema=False, mode="FAILFAST", encoding="UTF-8")
    return rows.toDF(*(n.strip() for n in names))


@dataclass(frozen=True)
class JsonRecords:
    """Records of JSON files: typed later, every field as text here."""

    rows: DataFrame  # the wanted fields
    rejected: DataFrame  # (value, reason)
    unknown: DataFrame  # (field, records): fields nobody asked for


def read_json_records(spark: SparkSession, path: str, fields: list[str], *, array: bool = False) -> JsonRecords:
    """Records of JSON-lines files, or with ``array`` of files that hold one array each.

    Duplicate keys and NaN / Infinity words spoil their line or array; records that are no
    objects, and records with a nested value in any field, are rejected alone. Whole
    numbers beyond 2^53 keep every digit. An array is parsed by the task that reads its file, then
    its records spread like any rows.
    """
    texts = spark.read.text(path, wholetext=array).filter(F.trim("value") != "")
    parsed = texts.withColumn("_doc", F.try_parse_json("value"))
    whole = F.lit("malformed_array" if array else "malformed_record")
    if array:
        items = F.expr("try_variant_get(_doc, '$', 'array<variant>')")
        parsed = parsed.withColumn("_items", items)
        spoilt = parsed.filter(F.col("_items").isNull()).select("value", whole.alias("reason"))
        records = parsed.select(F.explode("_items").alias("_doc")).withColumn("value", F.to_json("_doc"))
    else:
        spoilt = parsed.filter(F.col("_doc").isNull()).select("value", whole.alias("reason"))
        records = parsed.filter(F.col("_doc").isNotNull())
    members = records.withColumn("_map", F.expr("try_variant_get(_doc, '$', 'map<string, variant>')"))
    nested = F.exists(F.map_values("_map"), lambda v: F.schema_of_variant(v).rlike("^(OBJECT|ARRAY)"))
    reason = F.when(F.col("_map").isNull(), "malformed_record").when(nested, "nested_value")
    judged = members.withColumn("reason", reason)
    good = judged.filter(F.col("reason").isNull())
    rows = good.select(*[F.expr(f"try_variant_get(try_element_at(_map, '{f}'), '$', 'string')").alias(f) for f in fields])
    extra = F.array_except(F.map_keys("_map"), F.array(*[F.lit(f) for f in fields]))
    unknown = good.select(F.explode(extra).alias("field")).groupBy("field").agg(F.count(F.lit(1)).alias("records"))
    return JsonRecords(rows, judged.filter(F.col("reason").isNotNull()).select("value", "reason").unionByName(spoilt), unknown)


def read_json_lines(spark: SparkSession, path: str, fields: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected) of JSON-lines files, see :func:`read_json_records`."""
    found = read_json_records(spark, path, fields)
    return found.rows, found.rejected


def read_day(spark: SparkSession, path: str, date_column: str, date: str) -> DataFrame:
    """One day of a partitioned table; the filter prunes partitions."""
    return spark.read.parquet(path).filter(F.col(date_column) == F.lit(date).cast("date"))


# Verification -------------------------------------------------------------------


#: Files up to this size are hashed as one value, larger ones as a chain of pieces of at most so many bytes.
WHOLE_BYTES, PIECE_BYTES = 32 << 20, 8 << 10
#: Readers of lines unpack names that end so; their files are hashed as one value, whatever their size.
PACKED = r"\.(deflate|gz|bz2|lz4|snappy|zst|zstd)$"
BOM = b"\xef\xbb\xbf"
_PIECES = "file string, size bigint, kind int, start bigint, place bigint, total bigint, data binary"


def file_digests(
    spark: SparkSession, path: str, pattern: str = "*", recursive: bool = True, whole_bytes: int = WHOLE_BYTES
) -> DataFrame:
    """(path, sha256, size_bytes) of files, hashed in the tasks that read them.

    SHA-256 is one chain over a file's bytes, so one task hashes a file; beyond ``whole_bytes`` it sees
    the file as a sorted stream of small pieces and never holds it.
    """

    def reader(kind: str) -> DataFrame:
        found = spark.read.format(kind).option("pathGlobFilter", pattern)
        return found.option("recursiveFileLookup", str(recursive).lower()).load(path)

    files = reader("binaryFile")
    packed = F.col("_metadata.file_name").rlike(PACKED)
    large = F.col("length") > whole_bytes
    whole = files.filter(~large).unionByName(files.filter(packed).filter(large))
    whole = whole.select("path", F.sha2("content", 256).alias("sha256"), F.octet_length("content").cast("bigint").alias("size_bytes"))
    # Without the content these are names and sizes only.
    listed = files.filter(large & ~packed).select("path", F.col("_metadata.file_path").alias("file"), F.col("length").alias("size_bytes"))
    lines = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", str(recursive).lower())
    lines = lines.option("lineSep", "\n").text(path).filter((F.col("_metadata.file_size") > whole_bytes) & ~packed)
    chains = chain_digests(
        lines.select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_size").alias("size"),
            F.col("_metadata.file_block_start").alias("start"),
            F.col("value").cast("binary").alias("line"),
        )
    )
    lost = F.raise_error(F.concat(F.lit("file was not read: "), "path"))
    streamed = listed.join(chains, "file", "left").select("path", F.coalesce("sha256", lost).alias("sha256"), "size_bytes")
    return whole.unionByName(streamed)


def chain_digests(lines: DataFrame) -> DataFrame:
    """(file, sha256) from the lines of files (file, size, start of the split, line), which a task has in their order.

    Lines are put together to pieces where they are read; the pieces of a file meet in one task, sorted on disk.
    """
    pieces = lines.mapInArrow(_line_pieces, _PIECES)
    ordered = pieces.repartition("file").sortWithinPartitions("file", "kind", "start", "place")
    return ordered.mapInArrow(_hash_pieces, "file string, sha256 string")


def _line_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces (kind 1) of every split, each line with its line feed, and one row (kind 0) with their total."""
    schema = pa.schema(
        [("file", pa.string()), ("size", pa.int64()), ("kind", pa.int32()), ("start", pa.int64()), ("place", pa.int64())]
        + [("total", pa.int64()), ("data", pa.binary())]
    )
    split, place, total = None, 0, 0

    def made(kind: int, places: list[int], data: list[bytes]) -> pa.RecordBatch:
        file, size, start = split
        rows = [[x] * len(data) for x in (file, size, kind, start)]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip([*rows, places, [total] * len(data), data], schema, strict=True)], schema=schema)

    for batch in batches:
        files, sizes, starts, lines = batch.columns
        # A task reads its splits one after the other, so equal ends mean one split.
        at, end = 0, batch.num_rows
        while at < end:
            mine = (files[at].as_py(), sizes[at].as_py(), starts[at].as_py())
            until = end
            if (files[end - 1].as_py(), starts[end - 1].as_py()) != (mine[0], mine[2]):
                until = next(i for i in range(at, end) if (files[i].as_py(), starts[i].as_py()) != (mine[0], mine[2]))
            if mine != split:
                if split is not None:
                    yield made(0, [0], [b""])
                split, place, total = mine, 0, 0
            text = b"\n".join([*lines.slice(at, until - at).to_pylist(), b""])
            total += len(text)
            data = [text[i : i + PIECE_BYTES] for i in range(0, len(text), PIECE_BYTES)]
            yield made(1, list(range(place, place + len(data))), data)
            place += len(data)
            at = until
    if split is not None:
        yield made(0, [0], [b""])


def _hash_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each file; its totals come first and tell what the reader of lines left out.

    That is a byte order mark in front; the line feed behind the last line is one too many unless the file has it.
    """
    file, chain, size, read, left = None, None, 0, 0, 0

    def done() -> pa.RecordBatch:
        if chain is None or left:
            raise ValueError(f"file changed while it was read: {file}")
        return pa.RecordBatch.from_pydict({"file": [file], "sha256": [chain.hexdigest()]})

    for batch in batches:
        names = batch.column("file")
        other = names.to_pylist() if names[0].as_py() != file or names[-1].as_py() != file else None
        kinds, totals, data = batch.column("kind").to_pylist(), batch.column("total").to_pylist(), batch.column("data")
        for i in range(batch.num_rows):
            if other is not None and other[i] != file:
                if file is not None:
                    yield done()
                file, chain, size, read = other[i], None, batch.column("size")[i].as_py(), 0
            if kinds[i] == 0:
                read += totals[i]
                continue
            if chain is None:
                front = BOM if size - read in (2, 3) else b""
                if size - len(front) - read not in (-1, 0):
                    raise ValueError(f"file changed while it was read: {file}")
                chain, left = hashlib.sha256(front), size - len(front)
            piece = data[i].as_py()[:left]
            chain.update(piece)
            left -= len(piece)
    if file is not None:
        yield done()


def artifact_problems(registered: DataFrame, actual: DataFrame) -> DataFrame:
    """(path, problem) where a registered file is missing, altered or badly recorded."""
    right = actual.select(F.col("path").alias("_p"), F.col("sha256").alias("_h"), F.col("size_bytes").alias("_s"))
    joined = registered.join(right, F.col("path") == F.col("_p"), "left")
    good_digest = F.coalesce(F.col("sha256").rlike("^[0-9a-f]{64}$"), F.lit(False))
    problem = (
        F.when(~good_digest, "malformed_digest")
        .when(F.col("_p").isNull(), "missing")
        .when(F.col("size_bytes") != F.col("_s"), "size_mismatch")
        .when(F.col("sha256") != F.col("_h"), "hash_mismatch")
    )
    return joined.withColumn("problem", problem).filter(F.col("problem").isNotNull()).select("path", "problem")


def artifact_identity(artifacts: DataFrame, version: str = "2") -> DataFrame:
    """One row with the identity of a set of files: hashes and sizes folded per folder, folders to one digest."""
    item = F.concat_ws(":", "sha256", F.col("size_bytes").cast("string"))
    folder = F.regexp_extract("path", "^(.*)/[^/]*$", 1)

    def fold(col: Column) -> Column:
        return F.sha2(F.array_join(F.sort_array(F.collect_list(col)), ","), 256)

    folders = artifacts.groupBy(folder.alias("_folder")).agg(fold(item).alias("_digest"))
    return folders.agg(F.sha2(F.concat_ws(";", F.lit(version), fold(F.col("_digest"))), 256).alias("dataset_id"))


# Statuses of a usable revision.
CURRENT = ("PUBLISHED", "RETRY_PENDING", "LOCAL_PASS")


def current_revisions(progress: DataFrame, closed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(selected, skipped): the newest revision of each date, without closed or empty days.

    ``progress`` has trading_date, revision, finished_at and status. Days whose newest
    revision was published, or passed locally and waits for its upload, are current.
    """
    newest = latest_per_key(progress, ["trading_date"], ["finished_at", "revision"])
    marked = newest.join(
        F.broadcast(closed.select("trading_date").distinct().withColumn("_closed", F.lit(True))), "trading_date", "left"
    )
    reason = F.when(F.col("_closed"), "holiday").when(~F.col("status").isin(*CURRENT), F.lower("status"))
    tagged = marked.withColumn("reason", reason).drop("_closed")
    return tagged.filter(F.col("reason").isNull()).drop("reason"), tagged.filter(F.col("reason").isNotNull())


def repeated_ids(rows: DataFrame, key: str, session: str) -> DataFrame:
    """Ids that occur in more than one session."""
    per = rows.groupBy(key).agg(F.min(session).alias("_a"), F.max(session).alias("_b"))
    return per.filter(F.col("_a") != F.col("_b")).select(key, F.col("_a").alias("first_session"), F.col("_b").alias("last_session"))


# Sinks --------------------------------------------------------------------------


def split_replays(batch: DataFrame, stored: DataFrame, key: str, digest: str) -> tuple[DataFrame, DataFrame]:
    """(new rows, conflicts) of a batch against what is stored.

    The same key and digest again is a no-op; the same key with another digest is
    a conflict. Inside the batch the smallest digest wins and others conflict.
    """
    first = batch.groupBy(key).agg(F.min(digest).alias("_first"))
    known = stored.select(F.col(key).alias("_k"), F.col(digest).alias("_old")).distinct()
    judged = batch.join(first, key).join(known, F.col(key) == F.col("_k"), "left")
    wanted = F.coalesce("_old", "_first")
    conflicts = judged.filter(F.col(digest) != wanted).select(*batch.columns).dropDuplicates([key, digest])
    fresh = judged.filter(F.col("_old").isNull() & (F.col(digest) == F.col("_first"))).select(*batch.columns)
    return fresh.dropDuplicates([key]), conflicts


def require_unique(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once (a bulk append must have none)."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def iso_text(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")


#: Overwrites the days of this write only: it clears what a stopped attempt left of them.
ONLY_THESE_DAYS = {"partitionOverwriteMode": "dynamic"}


def write_table_pair(observations: DataFrame, options: DataFrame, folder: str, *, replace_days: bool = False) -> None:
    """Both cleaned tables as Parquet by day with CSV companions: ISO times, blanks for NULL.

    The folder must be new; with ``replace_days`` the days of these rows take the place
    of what a stopped attempt left of them, and the CSV files lie in one folder per day, too.
    """
    for name, df in (("observations", observations), ("options", options)):
        text = df.select(
            *[iso_text(F.col(f.name)).alias(f.name) if f.dataType.typeName() == "timestamp" else f.name for f in df.schema.fields]
        )
        if replace_days:
            text = text.withColumn("day", F.col("trading_date"))
        rows, lines = df.write.partitionBy("trading_date"), text.write
        if replace_days:
            rows = rows.mode("overwrite").options(**ONLY_THESE_DAYS)
            lines = lines.mode("overwrite").options(**ONLY_THESE_DAYS).partitionBy("day")
        rows.parquet(os.path.join(folder, f"{name}.parquet"))
        lines.csv(os.path.join(folder, f"{name}.csv"), header=True, emptyValue="", nullValue="")


def write_quarantine(rows: DataFrame, folder: str) -> None:
    """Rejected rows by day as JSON lines with reason and raw record."""
    writer = rows.write.mode("overwrite").options(**ONLY_THESE_DAYS).partitionBy("trading_date")
    writer.json(os.path.join(folder, "quarantine.jsonl"))


def revision_id(source_digest: str, metadata: str, pipeline: str) -> str:
    """Identity of a revision: the same inputs and code give the same revision."""
    return hashlib.sha256("\n".join((source_digest, metadata, pipeline)).encode()).hexdigest()


def committed(spark: SparkSession, root: str) -> DataFrame:
    """The commits table (empty when nothing is published yet)."""
    path = os.path.join(root, "commits")
    try:
        return spark.read.schema(COMMIT_SCHEMA).parquet(path)
    except Exception as exc:
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        return spark.createDataFrame([], COMMIT_SCHEMA)


def publish_revision(
    tables: dict[str, DataFrame], *, root: str, trading_date: str, revision: str, committed_at: str, status: str = "PUBLISHED"
) -> bool:
    """Write artifacts, then their manifest, then one commit row. Returns False when
    the revision already exists, and then writes nothing."""
    spark = next(iter(tables.values())).sparkSession
    same = committed(spark, root).filter(
        (F.col("trading_date") == F.lit(trading_date).cast("date")) & (F.col("revision") == revision)
    )
    if not same.isEmpty():
        return False
    folder = os.path.join(root, "data", f"trading_date={trading_date}", f"revision={revision}")
    for name, df in tables.items():
        df.write.parquet(os.path.join(folder, name))
    digests = file_digests(spark, folder, "*.parquet")
    counts = F.create_map(*[x for n in tables for x in (F.lit(n), F.col(f"_{n}"))])
    commit = digests.agg(F.collect_list(F.struct("path", "sha256", "size_bytes")).alias("artifacts"))
    for name in tables:
        size = spark.read.parquet(os.path.join(folder, name)).agg(F.count(F.lit(1)).alias("n")).scalar()
        commit = commit.withColumn(f"_{name}", size)
    commit.select(
        F.lit(trading_date).cast("date").alias("trading_date"),
        F.lit(revision).alias("revision"),
        F.lit(committed_at).cast("timestamp").alias("committed_at"),
        F.lit(status).alias("status"),
        "artifacts",
        counts.alias("row_counts"),
    ).write.mode("append").parquet(os.path.join(root, "commits"))
    return True


def read_revision(spark: SparkSession, root: str, trading_date: str) -> dict[str, DataFrame] | None:
    """Tables of the newest commit of a day, verified; None without a commit."""
    mine = committed(spark, root).filter(F.col("trading_date") == F.lit(trading_date).cast("date"))
    newest = mine.orderBy(F.desc("committed_at"), F.desc("revision")).limit(1).collect()
    if not newest:
        return None
    row = newest[0]
    if not row["artifacts"] or not row["row_counts"]:
        raise ValueError("malformed commit")
    folder = os.path.join(root, "data", f"trading_date={trading_date}", f"revision={row['revision']}")
    registered = spark.createDataFrame([tuple(a) for a in row["artifacts"]], ARTIFACT_SCHEMA)
    if not artifact_problems(registered, file_digests(spark, folder, "*.parquet")).isEmpty():
        raise ValueError("committed artifacts do not match their digests")
    tables = {name: spark.read.parquet(os.path.join(folder, name)) for name in row["row_counts"]}
    for name, df in tables.items():
        if df.count() != row["row_counts"][name]:
            raise ValueError(f"row count of {name} differs from its commit")
    return tables
