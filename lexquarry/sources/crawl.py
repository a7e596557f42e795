"""A crawl that can be stopped and taken up again: a frontier of addresses, round by round, as stored tables.

A round's pages are written below the folder and marked as done; the next frontier is what they link
to, less all addresses that earlier rounds had. So each address is fetched once, whatever links to it, and a
crawl that is started again in its folder goes on after the last round that was finished.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexquarry.functions.text import word_count

_PAGES = "url string, html string, links array<string>, round int"


def address(url: Column) -> Column:
    """Without the fragment and a slash at the end."""
    return F.regexp_replace(F.regexp_replace(url, "#.*$", ""), "/+$", "")


def _is_done(spark: SparkSession, folder: str, k: int) -> bool:
    try:
        return spark.read.schema("round int").parquet(f"{folder}/done={k}").count() == 1
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def crawl(seeds: DataFrame, fetch: Callable[[DataFrame], DataFrame], folder: str, rounds: int | None = None) -> DataFrame:
    """(url, html, links, round) of all that is reached from ``seeds`` (url), until nothing is new or ``rounds`` are done.

    ``fetch`` makes of a frame of addresses (url) one of pages (url, html, links), by a join with a
    stored web or by a map that asks a server; of several pages of one address any one is taken. An address
    without a page is kept without html and not asked again. Null addresses are left out. ``folder`` is one
    that driver and executors share.
    """
    spark = seeds.sparkSession
    stored = lambda k: spark.read.schema(_PAGES).parquet(*[f"{folder}/pages={i}" for i in range(k)])
    k = 0
    while _is_done(spark, folder, k):
        k += 1
    while rounds is None or k < rounds:
        if k:
            before = stored(k)
            next_ones = before.where(F.col("round") == k - 1).select(F.explode("links").alias("u"))
            frontier = next_ones.select(address(F.col("u")).alias("url")).distinct().join(before.select("url"), "url", "left_anti")
        else:
            frontier = seeds.select(address(F.col("url")).alias("url")).distinct()
        frontier = frontier.where("url is not null")
        found = fetch(frontier).select(address(F.col("url")).alias("url"), "html", F.col("links").cast("array<string>").alias("links")).dropDuplicates(["url"])
        pages = frontier.join(found, "url", "left").withColumn("round", F.lit(k))
        pages.write.mode("overwrite").parquet(f"{folder}/pages={k}")
        n = spark.read.schema(_PAGES).parquet(f"{folder}/pages={k}").count()
        spark.range(1).select(F.lit(k).alias("round")).coalesce(1).write.mode("overwrite").parquet(f"{folder}/done={k}")
        k += 1
        if not n:
            break
    return stored(k) if k else spark.createDataFrame([], _PAGES)


def site_texts(pages: DataFrame, site: str = "site", text: str = "text", most: int = 20, least_words: int = 500) -> DataFrame:
    """(site, pages, text): the texts of a site's first page and the next ``most`` in order of rounds and addresses, a blank line between; sites of no more words than the floor are left out."""
    first = pages.where(F.col(text).isNotNull()).withColumn("_rn", F.row_number().over(Window.partitionBy(site).orderBy("round", "url"))).where(F.col("_rn") <= most + 1)
    joined = first.groupBy(site).agg(F.count(F.lit(1)).alias("pages"), F.array_sort(F.collect_list(F.struct("_rn", F.col(text).alias("t")))).alias("a"))
    out = joined.select(site, "pages", F.array_join(F.transform("a", lambda x: x["t"]), "\n\n").alias("text"))
    return out.where(word_count(F.col("text")) > least_words)
