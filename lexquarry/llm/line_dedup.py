"""Line deduplication by site-relative frequency.

A line that a large share of a host's pages contain is boilerplate of that host: pages that hold
the line are divided by all pages of the host, and lines over the ratio go from every page of it.
Only digests of lines are shuffled for the counts, partly summed before; the boilerplate of a
host has at most (lines per page / ratio) digests. These are broadcast if all of them are counted to
be few. Beyond that, those of hosts with over a thousandth of all pages, at most 1,000 hosts, still
are, so that such a host's pages stay where they are; pages of the others meet theirs in a shuffle by
host, in which no host is hot. Counted lines meet the page totals of their hosts in the same way.

Everything is DataFrame expressions. Defined results: a null page has no lines; a null or
malformed URL has the host ''; repeated rows count as pages; a share equal to the ratio is no
boilerplate; very long pages are lines like others; an empty table gives an empty result; other
columns are ignored, whatever their names. On hosts of fewer than ``LEAST_PAGES`` pages no line is
boilerplate: there a line of one page would be over the ratio by itself, and every page would go.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexquarry.llm._util import BROADCAST_ROWS, join_unique, materialise

#: A line is boilerplate of a host from this share of its pages, and at least this many of them.
RATIO, LEAST_PAGES = 0.3, 3
#: (pattern, replacement), applied in order. All are read alike by Java and RE2.
_STEPS = (
    (r"(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>", ""),
    (r"(?i)</?(?:p|div|br|li|ul|ol|tr|table|h[1-6]|nav|article|section|main|header|footer|aside|title|head|body|html|blockquote|pre)\b[^>]*>", "\n"),
    (r"<[^>]*>", ""),
)
#: Literal replacements, in order.
_ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))
#: Runs of blanks that aren't a single space.
_BLANKS = r"[\x20\x09\x0B-\x0D]{2,}|[\x09\x0B-\x0D]"


def page_lines(html: Column) -> Column:
    """The trimmed lines of a page's visible text that aren't blank."""
    text = F.coalesce(html.cast("string"), F.lit(""))
    for pattern, by in _STEPS:
        text = F.regexp_replace(text, F.lit(pattern), F.lit(by))
    for entity, by in _ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(by))
    text = F.regexp_replace(text, F.lit(_BLANKS), F.lit(" "))
    return F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), lambda x: x != "")


def host(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url.cast("string"), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))


def line_dedup(pages: DataFrame, ratio: float = RATIO, least_pages: int = LEAST_PAGES, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: id, host, n_lines, n_dropped, text (the lines that stay)."""
    rows = pages.select(pages[id_col].alias("id"), host(pages[url_col]).alias("host"), pages[html_col].cast("string").alias("html"))
    digest = lambda x: F.unhex(F.md5(x.cast("binary")))
    sizes = materialise(rows.groupBy("host").agg(F.count(F.lit(1)).alias("pages")))
    n_hosts, n_pages = sizes.agg(F.count(F.lit(1)), F.coalesce(F.sum("pages"), F.lit(0))).first()
    held = rows.select("host", F.explode(F.array_distinct(F.transform(page_lines(F.col("html")), digest))).alias("line")).groupBy("host", "line").agg(F.count(F.lit(1)).alias("n"))
    held = held.where(F.col("n") >= least_pages)
    sized = held.join(F.broadcast(sizes), "host") if n_hosts <= BROADCAST_ROWS else join_unique(materialise(held), sizes, "host", "pages", n_pages)
    common = sized.where(F.col("n") > ratio * F.col("pages"))
    common = materialise(common.groupBy("host").agg(F.collect_list("line").alias("common"), F.first("pages").alias("pages")))
    lines = common.agg(F.sum(F.size("common"))).first()[0] or 0
    joined = rows.join(F.broadcast(common), "host", "left") if lines <= BROADCAST_ROWS else join_unique(rows, common, "host", "pages", n_pages)
    joined = joined.withColumn("lines", page_lines(F.col("html")))
    known = F.array_intersect(F.transform("lines", digest), F.coalesce("common", F.array().cast("array<binary>")))
    kept = F.when(F.size("known") == 0, F.col("lines")).otherwise(F.filter("lines", lambda x: ~F.array_contains(F.col("known"), digest(x))))
    out = joined.withColumn("known", known).withColumn("kept", kept)
    return out.select(F.col("id").alias(id_col), "host", F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"), F.array_join("kept", "\n").alias("text"))
