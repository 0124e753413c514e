"""Digests of files: small ones as one value, large ones as a chain of pieces that no task holds whole."""

import hashlib
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tickevidence.sources import tables as S

NOISE = random.Random(5)
FILES = {
    "small.bin": b"few",
    "noise.bin": NOISE.randbytes(300_000),
    "noise ended=1.bin": NOISE.randbytes(200_000) + b"\n",
    "feeds.bin": b"\n" * 70_000,
    "carriage.bin": b"a\r\n\r\nb\r" * 20_000,
    "marked.bin": b"\xef\xbb\xbf" + NOISE.randbytes(150_000) + b"x",
    "marked ended.bin": b"\xef\xbb\xbf" + b"caf\xc3\xa9\n" * 20_000,
    "one line.bin": b"z" * 90_000,
    "folder/deep.bin": NOISE.randbytes(100_000),
    "packed.gz": b"not really packed" * 9_000,
}


def digests(df):
    return {r["path"].split("/digests/")[1]: (r["sha256"], r["size_bytes"]) for r in df.collect()}


@pytest.mark.parametrize("split", ["134217728", "7001"])
def test_digests_do_not_depend_on_pieces_and_splits(spark, tmp_path, split):
    for name, content in FILES.items():
        path = tmp_path / "digests" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content)
    want = {name: (hashlib.sha256(c).hexdigest(), len(c)) for name, c in FILES.items()}
    folder = str(tmp_path / "digests")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        assert digests(S.file_digests(spark, folder)) == want
        assert digests(S.file_digests(spark, folder, whole_bytes=1_000)) == want
        assert set(digests(S.file_digests(spark, folder, "noise*.bin", recursive=False, whole_bytes=1_000))) == {"noise.bin", "noise ended=1.bin"}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_large_files_are_never_one_value(spark, tmp_path):
    content = FILES["noise.bin"]
    (tmp_path / "digests").mkdir()
    (tmp_path / "digests" / "a.parquet").write_bytes(content)
    (tmp_path / "digests" / "b.parquet").write_bytes(b"few")
    # The reader of whole files refuses to read more than this.
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", 100_000)
    try:
        found = digests(S.file_digests(spark, str(tmp_path / "digests"), "*.parquet", whole_bytes=100_000))
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
    assert found["a.parquet"] == (hashlib.sha256(content).hexdigest(), len(content))
    assert found["b.parquet"] == (hashlib.sha256(b"few").hexdigest(), 3)


def test_pieces_are_small_and_what_is_missing_is_an_error():
    lines = pa.array(FILES["noise.bin"].split(b"\n"), pa.binary())
    n = len(lines)
    batch = pa.RecordBatch.from_arrays([pa.array(["f"] * n), pa.array([300_000] * n), pa.array([0] * n), lines], names=["file", "size", "start", "line"])
    pieces = list(S._line_pieces(iter([batch])))
    assert max(len(d) for p in pieces for d in p.column("data").to_pylist()) <= S.PIECE_BYTES
    ordered = [pieces[-1], *pieces[:-1]]
    assert next(S._hash_pieces(iter(ordered))).column("sha256")[0].as_py() == hashlib.sha256(FILES["noise.bin"]).hexdigest()
    for kept in ([ordered[0], ordered[1].slice(1)], [ordered[0]], ordered[1:]):
        with pytest.raises(ValueError, match="changed while it was read"):
            list(S._hash_pieces(iter(kept)))


def test_the_whole_reader_sees_no_large_file_and_the_other_no_small_one(spark, tmp_path):
    (tmp_path / "digests").mkdir()
    for name in ("noise.bin", "small.bin"):
        (tmp_path / "digests" / name).write_bytes(FILES[name])
    text = S.file_digests(spark, str(tmp_path / "digests"), whole_bytes=1_000)._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(length,1000)" in text
    assert digests(S.file_digests(spark, str(tmp_path / "digests"), whole_bytes=1_000).filter(F.col("size_bytes") > 3)).keys() == {"noise.bin"}
