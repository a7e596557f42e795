"""Crawls that are stopped and go on, and a stream over a numbered API that is stopped and goes on."""

import pytest
from pyspark.sql import functions as F

from lexquarry.sources import crawl as C
from lexquarry.sources import readers

WEB = {"a": ["b", "c", "a", "b#x"], "b": ["d", None, "c/"], "c": [], "d": ["a", "gone"], "z": ["a"], "e": ["a"]}


def web(spark):
    return spark.createDataFrame([(u, f"<p>{u}</p>", ls) for u, ls in WEB.items()], "url string, html string, links array<string>")


def test_crawl_reaches_everything_once_and_resumes(spark, tmp_path):
    asked = []

    def fetch(frontier):
        asked.extend(r["url"] for r in frontier.collect())
        return web(spark).join(frontier, "url", "left_semi")

    seeds = spark.createDataFrame([("a",), ("e/",), ("a#top",), (None,)], "url string")
    part = C.crawl(seeds, fetch, str(tmp_path / "c"), rounds=2)
    assert {r["url"]: r["round"] for r in part.collect()} == {"a": 0, "e": 0, "b": 1, "c": 1}
    (tmp_path / "c" / "pages=2").mkdir()  # a round that was broken off
    whole = C.crawl(seeds, fetch, str(tmp_path / "c"))
    assert {r["url"]: r["round"] for r in whole.collect()} == {"a": 0, "e": 0, "b": 1, "c": 1, "d": 2, "gone": 3}
    assert sorted(asked) == sorted(set(asked)) and {r["url"] for r in whole.where("html is null").collect()} == {"gone"}
    again = C.crawl(seeds, fetch, str(tmp_path / "c"))
    assert again.count() == 6 and len(asked) == 6


def test_empty_seeds(spark, tmp_path):
    assert C.crawl(spark.createDataFrame([], "url string"), lambda f: web(spark).join(f, "url", "left_semi"), str(tmp_path / "c")).collect() == []


def test_site_texts(spark):
    rows = [("s", f"u{i:02}", i // 10, f"w{i} " * 30) for i in range(30)] + [("short", "u", 0, "few words"), ("s", "none", 0, None)]
    pages = spark.createDataFrame(rows, "site string, url string, round int, text string")
    got = C.site_texts(pages).collect()
    assert [(r["site"], r["pages"]) for r in got] == [("s", 21)] and got[0]["text"].split("\n\n")[20].startswith("w20 ")
    assert {r["site"] for r in C.site_texts(pages, least_words=1).collect()} == {"s", "short"}


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 8, 100])
def test_last_page(n):
    fetch = lambda p: "x" if p <= n else None
    assert readers.last_page(fetch) == n and readers.last_page(fetch, min(n, 5)) == n


def test_stream_of_pages_goes_on_where_it_stopped(spark, tmp_path):
    (tmp_path / "pages").mkdir()

    def publish(a, b):
        for i in range(a, b + 1):
            (tmp_path / "pages" / str(i)).write_text(f"body {i}")

    def fetch(page, folder=str(tmp_path / "pages")):
        import os

        path = f"{folder}/{page}"
        if os.path.exists(path + ".broken"):
            raise OSError("server error")
        return open(path).read() if os.path.exists(path) else None

    def run():
        q = readers.paged_stream(spark, fetch, 3).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        q.awaitTermination()
        return sorted((r["page"], r["body"]) for r in spark.read.parquet(str(tmp_path / "out")).collect())

    publish(1, 5)
    assert run() == [(i, f"body {i}") for i in range(1, 6)]
    publish(6, 12)
    (tmp_path / "pages" / "9.broken").write_text("")
    with pytest.raises(Exception, match="server error|STREAM_FAILED"):
        run()
    (tmp_path / "pages" / "9.broken").unlink()
    assert run() == [(i, f"body {i}") for i in range(1, 13)]
    assert run() == [(i, f"body {i}") for i in range(1, 13)]
    assert spark.read.parquet(str(tmp_path / "out")).groupBy("page").count().where(F.col("count") > 1).count() == 0
