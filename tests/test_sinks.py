from pyspark.sql import functions as F

from lexquarry import providers as P
from lexquarry.sources import writers as W


def test_append_replace_and_partitions(spark, tmp_path):
    root = str(tmp_path)
    rows = lambda *r: spark.createDataFrame(r, "id long, content string, source string, source_type string")
    W.append(rows((1, "a", "s", "historical"), (2, "b", "t", "literary")), root, "documents")
    W.append(rows((3, "c", "s", "historical")), root, "documents")
    docs = W.read(spark, root, "documents")
    assert sorted(r["id"] for r in docs.collect()) == [1, 2, 3] and docs.columns[0] == "id"
    next_ = W.replace(rows((4, "d", "s", "historical")), root, "documents", F.col("source") == "s")
    assert sorted(r["id"] for r in next_.collect()) == [2, 4]
    W.overwrite_partitions(rows((5, "e", "u", "literary")), root, "documents")
    assert sorted(r["id"] for r in W.read(spark, root, "documents").collect()) == [1, 3, 5]
    W.manifest(rows((1, "a", "s", "x")), f"{root}/manifest")
    assert spark.read.json(f"{root}/manifest").count() == 1


def test_fetch_ocr_translate(spark):
    class Web:
        def fetch(self, url):
            if url == "bad":
                raise OSError
            return None if url == "none" else url.encode()

        def run(self, data, languages, timeout):
            if data == b"slow":
                raise TimeoutError
            return {b"has": (6, b""), b"odd": (2, b"")}.get(data, (0, data.upper()))

        def translate(self, text):
            if text == "x":
                raise RuntimeError
            return text[::-1]

    df = spark.createDataFrame([("s", 1, "bad"), ("s", 2, "none"), ("s", 3, "ok"), ("t", 1, None)], "source string, priority int, url string")
    assert [r["content"] for r in P.fetch(df, Web()).orderBy("source", "priority").collect()] == [None, None, b"ok", None]
    files = spark.createDataFrame([("a", b"new"), ("b", b"has"), ("c", b"odd"), ("d", b"slow")], "path string, content binary")
    assert [tuple(r)[1:] for r in P.ocr(files, Web(), "ara+eng").orderBy("path").collect()] == [("DONE", b"NEW"), ("COPIED", b"has"), ("FAILED", None), ("TIMEOUT", None)]
    text = spark.createDataFrame([(1, "ab"), (2, "x"), (3, None)], "id long, content string")
    assert [r["content"] for r in P.translate(text, Web()).orderBy("id").collect()] == ["ba", None, None]
