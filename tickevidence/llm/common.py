"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickevidence.session import stage_table

#: The white space that separates words: space and U+0009 to U+000D.
SPACE = "\\x20\\x09-\\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Cut batches into pieces, so that few texts are Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def map_arrow(
    df: DataFrame, cols: list[str], fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, rows: int = 500
) -> DataFrame:
    """Apply ``fn`` to small Arrow batches of the named columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, rows):
            yield fn(piece)

    return df.select(*cols).mapInArrow(run, schema)


def held_out(key: str = "doc_id") -> Column:
    """Rows kept away from every label: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, max_chars: int, part: int) -> list:
    """At most ``rows`` labelled texts of each class, chosen by a hash of the id.

    ``part`` (0 or 1) picks one of two disjoint halves of the ids. Texts above
    ``max_chars`` are left to the scoring pass; this bounds the driver's memory to
    classes * rows * max_chars characters. The chosen ids are so few that they
    are broadcast to the text scan.
    """
    ids = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", label).distinct()
    half = F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)) == part
    order = F.xxhash64("doc_id", F.lit("sample"))
    found = [r[0] for r in ids.select(label).distinct().collect()]
    out = []
    for value in sorted(found):
        chosen = ids.filter((F.col(label) == value) & half).orderBy(order, "doc_id").limit(rows)
        texts = docs.select("doc_id", text_or_empty().alias("text")).filter(F.length("text") <= max_chars)
        out += [(r["text"], value) for r in texts.join(F.broadcast(chosen), "doc_id").orderBy(order, "doc_id", "text").limit(rows).collect()]
    return out


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, rows: int, max_chars: int) -> tuple[list, dict]:
    """At most ``rows`` texts of each class among the labelled documents at hand, and how many of these each class has.

    Labels whose document is not in ``docs`` count nowhere; every row of a repeated doc_id does. Rows are drawn by
    a hash of doc_id, content and copy number, equal rows being numbered by their counts per task, so no task
    lists a frequent document alone. Texts above ``max_chars`` are counted and left to the scoring pass.
    """
    ids = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", label).distinct()
    body = text_or_empty()
    texts = docs.select("doc_id", body.alias("text"), F.xxhash64(body).alias("content"), F.length(body).alias("size"))
    held = texts.select("doc_id", "content", "size", F.spark_partition_id().alias("task")).join(ids, "doc_id")
    held = stage_table(held.groupBy("doc_id", label, "content", "size", "task").agg(F.count(F.lit(1)).alias("n")), "labelled")
    counts = {r[0]: r["n"] for r in held.groupBy(label).agg(F.sum("n").alias("n")).collect()}
    earlier = Window.partitionBy("doc_id", label, "content", "size").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    copies = held.filter(F.col("size") <= max_chars).withColumn("before", before)
    copies = copies.select("doc_id", label, "content", F.explode(F.sequence("before", F.col("before") + F.col("n") - 1)).alias("copy"))
    draw = F.xxhash64("doc_id", "content", "copy", F.lit("sample"))
    chosen = None
    for value in sorted(counts):
        some = copies.filter(F.col(label) == value).orderBy(draw, "doc_id", "content", "copy").limit(rows)
        chosen = some if chosen is None else chosen.unionByName(some)
    if chosen is None:
        return [], {}
    chosen = chosen.groupBy("doc_id", label, "content").agg(F.count(F.lit(1)).alias("times"))
    found = texts.filter(F.col("size") <= max_chars).join(F.broadcast(chosen), ["doc_id", "content"])
    found = found.dropDuplicates(["doc_id", label, "content"]).select("doc_id", label, "content", "text", "times").collect()
    found.sort(key=lambda r: (r[1], r["content"], r["doc_id"]))
    return [(r["text"], r[1]) for r in found for _ in range(r["times"])], counts


def numbered(df: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """The rows with ``position``, their number from 0 within their group, and ``total``, the group's rows, by a range sort.

    Groups and order together are range-sorted, so a group with a third of all rows
    spreads over many tasks; ``order`` should tell all rows of a group apart. The sorted
    table is staged, which fixes its order; one row per (group, task) then says how many
    rows come before. Group columns must not be NULL.
    """
    place = F.monotonically_increasing_id()  # the task's number and the row's number in it
    held = df.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order).withColumn("place", place)
    held = stage_table(held, name).withColumn("task", F.shiftright("place", 33))
    runs = held.groupBy(*group, "task").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("rows"))
    earlier = Window.partitionBy(*group).orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("total", F.sum("rows").over(Window.partitionBy(*group)))
    runs = runs.withColumn("before", F.coalesce(F.sum("rows").over(earlier), F.lit(0))).drop("rows")
    position = F.col("place") - F.col("first") + F.col("before")
    return held.join(runs, [*group, "task"]).withColumn("position", position).drop("place", "first", "before", "task")


def fit_logistic(
    x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, ridge: float = 1e-3, steps: int = 40
) -> tuple[np.ndarray, float]:
    """Newton steps for a small dense logistic regression: weights and intercept."""
    a = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(a.shape[1])
    weight = np.ones(len(y)) if weight is None else weight
    keep = np.full(a.shape[1], ridge * len(y))
    keep[-1] = 1e-9
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (weight * (p - y)) + keep * w
        hess = (a.T * (weight * np.maximum(p * (1 - p), 1e-6))) @ a + np.diag(keep)
        move = np.linalg.solve(hess, grad)
        w = w - move
        if np.abs(move).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))
