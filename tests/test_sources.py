"""Archives, published versions, switched-off keys, and batches of an embedding service through Spark."""

import io
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from lexquarry import providers as P
from lexquarry.operators import usage
from lexquarry.sources import readers, writers


def archive(members, packing=zipfile.ZIP_DEFLATED):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", packing) as z:
        for name, text in members.items():
            z.writestr(name, text)
    return out.getvalue()


def test_members_of_archives(spark, tmp_path):
    (tmp_path / "a.zip").write_bytes(archive({"x/1.json": "one é", "2.json": "", "notes.txt": "no", "3.json": "w " * 50_000}))
    (tmp_path / "b.zip").write_bytes(archive({"1.json": "stored"}, zipfile.ZIP_STORED) )
    (tmp_path / "c.zip").write_bytes(archive({}))
    got = readers.members(spark.read.format("binaryFile").load(str(tmp_path)))
    assert sorted((r["path"][-5:], r["member"], len(r["text"])) for r in got.collect()) == [("a.zip", "2.json", 0), ("a.zip", "3.json", 100_000), ("a.zip", "x/1.json", 5), ("b.zip", "1.json", 6)]
    assert [r["text"] for r in readers.members(spark.read.format("binaryFile").load(str(tmp_path)), r"\.txt$").collect()] == ["no"]


def test_broken_archive_is_an_error(spark):
    df = spark.createDataFrame([("a", bytearray(b"no zip"))], "path string, content binary")
    with pytest.raises(Exception, match="not a zip file"):
        readers.members(df).collect()


def test_versions_are_published_whole(spark, tmp_path):
    rows = lambda *xs: spark.createDataFrame([(i, s) for i, s in xs], "id long, source string")
    root = str(tmp_path)
    assert writers.current_version(spark, root, "documents") == 0
    assert writers.publish(rows((1, "a"), (2, "b")), root, "documents") == 1
    broken = rows((3, "a")).withColumn("content", F.raise_error(F.lit("no text")).cast("string"))
    with pytest.raises(Exception, match="no text"):
        writers.replace_current(broken, root, "documents", F.col("source") == "a")
    pairs = lambda: sorted((r["id"], r["source"]) for r in writers.read_current(spark, root, "documents").collect())
    assert pairs() == [(1, "a"), (2, "b")]  # the old version is current
    old = writers.read_current(spark, root, "documents")
    assert writers.replace_current(rows((3, "a"), (4, "a")), root, "documents", F.col("source") == "a") == 2
    assert pairs() == [(2, "b"), (3, "a"), (4, "a")] and old.count() == 2


def test_keys_that_contain_an_address(spark):
    keys = spark.createDataFrame([(1, "a@x.org", True), (2, "Key of A@X.org", True), (3, None, True), (4, "axx.org", True)], "id int, name string, active boolean")
    off = lambda **k: {r["id"] for r in usage.deactivate(keys, "a@x.org", **k).collect() if not r["active"]}
    assert off() == {1} and off(contained=True) == {1, 2}


class Moody:
    """Refuses long batches, and every worker's first call; embeds a text as its length."""

    dim = 1

    def embed(self, texts, input_type="document"):
        if len(texts) > 3:
            raise P.TooManyTokens
        if not os.environ.get("MOODY"):
            os.environ["MOODY"] = "1"
            raise ConnectionError("busy")
        return [[float(len(t))] for t in texts]


def test_batches_are_halved_and_tried_again_in_tasks(spark):
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(__import__(__name__))
    docs = spark.range(50).select("id", F.expr("repeat('x', cast(id % 7 AS int))").alias("content")).union(spark.sql("SELECT 99L, CAST(NULL AS STRING)"))
    got = {r["id"]: r["embedding"] for r in P.embed(docs, Moody(), batch=10).collect()}
    assert got == {**{i: [float(i % 7)] for i in range(50)}, 99: [0.0]}


def test_unpacked_texts_are_passed_on_before_a_batch_ends(spark):
    import zlib

    import pyarrow as pa

    texts = ["x" * readers.UNPACKED, "a", "", "é" * (readers.UNPACKED - 1), "b", "last"]
    pack = zlib.compressobj
    packed = [(z := pack(9, zlib.DEFLATED, -15)).compress(t.encode()) + z.flush() for t in texts]
    batch = pa.RecordBatch.from_arrays([pa.array(["p"] * 6), pa.array(list("abcdef")), pa.array([True] * 6), pa.array(packed, pa.binary())], ["path", "member", "deflated", "packed"])
    out = list(readers._unpack(iter([batch])))
    assert [b.num_rows for b in out] == [1, 3, 2]
    assert [(r["member"], r["text"]) for b in out for r in b.to_pylist()] == list(zip("abcdef", texts))
