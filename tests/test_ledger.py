"""Appending with a ledger: replays, conflicts, stopped attempts, pruned reads."""

import pytest
from pyspark.sql import functions as F

from tickevidence.sources import ledger as L

SCHEMA = "key string, digest string, v int"


def place():
    return F.substring("key", 1, 2)


def add(spark, root, number, rows, **more):
    return L.append_batch(spark.createDataFrame(rows, SCHEMA), root, number, key="key", digest="digest", place=place(), **more)


def seen(spark, root, name="rows"):
    return sorted(tuple(r) for r in L.stored(spark, root, SCHEMA, name).collect())


def test_three_batches(spark, tmp_path):
    root = str(tmp_path)
    assert add(spark, root, "0", [("d1-a", "x", 1), ("d1-b", "y", 2), ("d1-b", "y", 2)]) == {"new_rows": 2, "replays": 1, "conflicts": 0}
    assert add(spark, root, "1", [("d1-a", "x", 1), ("d2-c", "z", 3)]) == {"new_rows": 1, "replays": 1, "conflicts": 0}
    assert add(spark, root, "1", [("d9-q", "x", 1)]) is None
    assert add(spark, root, "2", [("d1-a", "w", 9), ("d3-d", "n", 4), ("d3-d", "m", 5)]) == {"new_rows": 1, "replays": 0, "conflicts": 2}
    assert seen(spark, root) == [("d1-a", "x", 1), ("d1-b", "y", 2), ("d2-c", "z", 3), ("d3-d", "m", 5)]
    assert seen(spark, root, "conflicts") == [("d1-a", "w", 9), ("d3-d", "n", 4)]
    assert L.commits(spark, root).count() == 3


def test_only_the_places_of_the_batch_are_read(spark, tmp_path):
    root = str(tmp_path)
    add(spark, root, "0", [(f"d{d}-a", "x", 1) for d in range(5)])
    known = L.ledger(spark, root, ["d1"])
    assert [r["key"] for r in known.collect()] == ["d1-a"]
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert any("place" in part.split("]")[0] for part in plan.split("PartitionFilters: ")[1:])


def test_a_stopped_attempt_is_never_seen(spark, tmp_path):
    root = str(tmp_path)
    add(spark, root, "0", [("d1-a", "x", 1)])
    # A second batch that wrote rows and ledger, but no commit.
    left = spark.createDataFrame([("d1-b", "y", 2, "d1", "lost")], SCHEMA + ", place string, attempt string")
    left.write.mode("append").partitionBy("place", "attempt").parquet(f"{root}/rows")
    left.drop("v").write.mode("append").partitionBy("place", "attempt").parquet(f"{root}/ledger")
    assert seen(spark, root) == [("d1-a", "x", 1)]
    assert add(spark, root, "1", [("d1-b", "y", 2)]) == {"new_rows": 1, "replays": 0, "conflicts": 0}
    assert seen(spark, root) == [("d1-a", "x", 1), ("d1-b", "y", 2)]


def test_bulk_append_fails_as_a_whole(spark, tmp_path):
    root = str(tmp_path)
    add(spark, root, "0", [("d1-a", "x", 1)], bulk=True)
    for rows in ([("d1-a", "x", 1), ("d1-b", "y", 2)], [("d1-c", "x", 1), ("d1-c", "x", 1)]):
        with pytest.raises(ValueError, match="bulk append"):
            add(spark, root, "1", rows, bulk=True)
    assert seen(spark, root) == [("d1-a", "x", 1)]


def test_rows_without_a_key_fail_and_empty_batches_commit(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(ValueError, match="without a key"):
        add(spark, root, "0", [(None, "x", 1)])
    empty = spark.createDataFrame([], SCHEMA)
    assert L.append_batch(empty, root, "0", key="key", digest="digest", place=place()) == {"new_rows": 0, "replays": 0, "conflicts": 0}
    assert seen(spark, root) == [] and L.commits(spark, root).count() == 1
