"""Gates, registries and idempotent writes on the driver's tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lexquarry.functions import tagging as G
from lexquarry.functions import text as T
from lexquarry.operators import ingest as I
from lexquarry.operators.ingest import shared_folder, written
from lexquarry.queries._base import query, role, table
from lexquarry.queries.text import _alpha, _norm, _strip
from lexquarry.sources import crawl, readers, registry, writers


@query(
    "ingest_gate_status",
    f"""SELECT doc_id, CASE WHEN doc_id % 13 = 0 THEN 'SKIPPED_EXISTS' WHEN length({_strip('text')}) < 500 THEN 'TOO_SHORT' WHEN length(c) < 1000 THEN 'TOO_SHORT_CLEAN'
    WHEN NOT {_alpha('c')} > 0.75::DOUBLE THEN 'FAILED_READABLE_FILTER' ELSE 'OK' END AS status FROM (SELECT doc_id, text, {_norm('text')} AS c FROM documents)""",
)
def ingest_gate_status(spark, d):
    text = F.col("text")
    return table(spark, d, "documents").select("doc_id", I.gate_status(text, T.normalize_whitespace(text), F.col("doc_id") % 13 == 0, threshold=0.75).alias("status"))


@query("pending_sources", "SELECT DISTINCT source, upper(source) AS short_name FROM documents WHERE source NOT IN (SELECT source FROM documents WHERE lang = 'en' GROUP BY source HAVING count(*) >= 31) AND upper(source) NOT IN ('SRC3', 'SRC7')")
def pending_sources(spark, d):
    docs = table(spark, d, "documents")
    known = docs.select("source", F.upper("source").alias("short_name")).distinct()
    done = known.where("short_name IN ('SRC3', 'SRC7')").select("short_name")
    return I.pending_sources(known, docs.where("lang = 'en'"), done, least=31)


@query("new_rows_anti", "SELECT doc_id, source, doc_id % 50 AS number FROM documents d WHERE NOT EXISTS (SELECT 1 FROM documents x WHERE x.source = d.source AND x.doc_id % 4 = 0 AND x.doc_id % 60 = d.doc_id % 50)")
def new_rows_anti(spark, d):
    docs = table(spark, d, "documents")
    existing = docs.where("doc_id % 4 = 0").select("source", F.concat(F.lit("[x] Hadith "), (F.col("doc_id") % 60).cast("string"), F.lit(": "), "text").alias("content"))
    return I.new_rows(docs.select("doc_id", "source", (F.col("doc_id") % 50).alias("number")), existing)


@query("register_sources", "SELECT source AS short_name, 'old' AS state FROM (SELECT DISTINCT source FROM documents WHERE doc_id % 2 = 0 AND source < 'src15') UNION ALL SELECT source, 'new' FROM (SELECT DISTINCT source FROM documents) WHERE source NOT IN (SELECT source FROM documents WHERE doc_id % 2 = 0 AND source < 'src15')")
def register_sources(spark, d):
    docs = table(spark, d, "documents").select(F.col("source").alias("short_name"), "doc_id")
    old = docs.where("doc_id % 2 = 0 AND short_name < 'src15'").select("short_name").distinct().withColumn("state", F.lit("old"))
    return I.register(old, docs.select("short_name").withColumn("state", F.lit("new")))


@query("source_slug", "SELECT p_partkey, regexp_replace(regexp_replace(lower(substring(concat(p_name, ' (', p_type, ')'), 1, 40)), '[^a-z0-9_]', '_', 'g'), '^_+|_+$', '', 'g') AS slug FROM part")
def source_slug(spark, d):
    name = F.concat("p_name", F.lit(" ("), "p_type", F.lit(")"))
    return table(spark, d, "part").select("p_partkey", G.source_slug(name).alias("slug"))


@query("upsert_latest", "SELECT c_custkey, c_acctbal, 'old' AS state FROM customer WHERE c_custkey % 3 <> 0 UNION ALL SELECT c_custkey, round(c_acctbal * 2, 2), 'new' FROM customer WHERE c_custkey % 3 = 0")
def upsert_latest(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_acctbal")
    new = c.where("c_custkey % 3 = 0").withColumn("c_acctbal", F.round(F.col("c_acctbal") * 2, 2)).withColumn("state", F.lit("new"))
    return I.upsert_latest(c.withColumn("state", F.lit("old")), new, "c_custkey")


@query("dedupe_keep_min_id", "SELECT figure_a_id, figure_b_id, relationship, min(id) AS id FROM rels WHERE figure_a_id <> figure_b_id GROUP BY 1, 2, 3", "rels")
def dedupe_keep_min_id(spark, d):
    out = I.dedupe_keep_min_id(role(spark, d, "rels"), ["figure_a_id", "figure_b_id", "relationship"], drop_self_loops=("figure_a_id", "figure_b_id"))
    return out.select("figure_a_id", "figure_b_id", "relationship", "id")


@query("date_ce_year", r"SELECT p_partkey, try_cast(nullif(regexp_extract(s, '(\d{3,4})', 1), '') AS INT) AS year FROM (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN concat('-', p_partkey + 500) WHEN 1 THEN concat(p_partkey + 600, '-', p_partkey + 601) WHEN 2 THEN cast(p_size AS VARCHAR) WHEN 3 THEN NULL ELSE concat('c. ', p_partkey * 100) END AS s FROM part)")
def date_ce_year(spark, d):
    k = F.col("p_partkey")
    text = lambda c: c.cast("string")
    s = F.when(k % 5 == 0, F.concat(F.lit("-"), text(k + 500))).when(k % 5 == 1, F.concat(text(k + 600), F.lit("-"), text(k + 601))).when(k % 5 == 2, text(F.col("p_size"))).when(k % 5 == 4, F.concat(F.lit("c. "), text(k * 100)))
    return table(spark, d, "part").select("p_partkey", G.date_ce_year(s).alias("year"))


_FILES = "files AS (SELECT o_custkey AS item, o_orderkey AS pos, CASE o_orderkey % 6 WHEN 0 THEN concat('a', o_orderkey, '_djvu.txt') WHEN 1 THEN concat('b', o_orderkey, '.TXT') WHEN 2 THEN concat('c', o_orderkey, '.pdf') WHEN 3 THEN concat('d', o_orderkey, '_meta.xml') WHEN 4 THEN concat('e', o_orderkey, '.jpg') ELSE concat('f', o_orderkey, '.epub') END AS name, o_orderkey % 4 AS size FROM orders)"


@query(
    "pick_best_file",
    f"""WITH {_FILES}, r AS (SELECT *, CASE WHEN ends_with(lower(name), '_djvu.txt') THEN 0 WHEN ends_with(lower(name), '.txt') THEN 1 WHEN ends_with(lower(name), '.pdf') THEN 2 WHEN ends_with(lower(name), '.epub') THEN 4 ELSE 9 END AS p FROM files WHERE NOT contains(name, '_meta.xml'))
    SELECT item, name FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY p, CASE WHEN p < 9 THEN size END DESC, pos) AS rn FROM r) WHERE rn = 1""",
)
def pick_best_file(spark, d):
    k = F.col("o_orderkey").cast("string")
    kind = F.col("o_orderkey") % 6
    name = F.when(kind == 0, F.concat(F.lit("a"), k, F.lit("_djvu.txt"))).when(kind == 1, F.concat(F.lit("b"), k, F.lit(".TXT"))).when(kind == 2, F.concat(F.lit("c"), k, F.lit(".pdf"))).when(kind == 3, F.concat(F.lit("d"), k, F.lit("_meta.xml"))).when(kind == 4, F.concat(F.lit("e"), k, F.lit(".jpg"))).otherwise(F.concat(F.lit("f"), k, F.lit(".epub")))
    files = table(spark, d, "orders").select(F.col("o_custkey").alias("item"), F.col("o_orderkey").alias("pos"), name.alias("name"), (F.col("o_orderkey") % 4).cast("string").alias("size"))
    return I.pick_best_file(files).select("item", "name")


@query("first_usable_url", r"SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents WHERE len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')) > 500) WHERE rn = 1")
def first_usable_url(spark, d):
    return I.first_usable(table(spark, d, "documents").withColumn("priority", F.col("doc_id"))).select("source", "doc_id")


@query("concat_parts", r"SELECT source, string_agg(text, chr(10) || chr(10) ORDER BY doc_id) AS text FROM documents WHERE len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')) >= 100 GROUP BY source")
def concat_parts(spark, d):
    return I.concat_parts(table(spark, d, "documents").withColumn("pos", F.col("doc_id")), least_words=100)


@query("verse_groups", "SELECT conv_id AS group_key, (turn // 2)::INT AS chunk_index, string_agg(text, chr(10) ORDER BY turn) AS content FROM turns GROUP BY 1, 2", "turns")
def verse_groups(spark, d):
    verses = role(spark, d, "turns").select(F.col("conv_id").alias("group_key"), F.col("turn").alias("pos"), F.col("text").alias("line"))
    return I.verse_groups(verses, size=2)


@query(
    "hadith_chunks",
    "SELECT conv_id, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1)::INT AS chunk_index, concat('[C] Hadith ', turn, ': ', trim(text)) AS content, CASE WHEN turn % 2 = 0 THEN 'sahih' ELSE 'unknown' END AS chain_strength FROM turns QUALIFY length(trim(text)) >= 200",
    "turns",
)
def hadith_chunks(spark, d):
    grade = F.when(F.col("turn") % 2 == 0, "Sahih").otherwise("none")
    entry = F.struct("turn", F.struct(F.col("turn").alias("hadithnumber"), "text", F.array(F.struct(grade.alias("grade"))).alias("grades")).alias("h"))
    rows = role(spark, d, "turns").groupBy("conv_id").agg(F.array_sort(F.collect_list(entry)).alias("a"))
    return I.hadith_chunks(rows.select("conv_id", F.transform("a", lambda x: x["h"]).alias("hadiths")), "C", 200)


@query("serial_ids", "SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) + 100 AS id FROM orders")
def serial_ids(spark, d):
    return I.numbered_after(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"], 100).select("o_orderkey", "id")


@query("source_catalog_registry", "SELECT * FROM (VALUES ('multi', 12::BIGINT), ('single', 1::BIGINT)) t(category, sources)")
def source_catalog_registry(spark, d):
    base = {"category": "multi", "short_name": "work_v{n}", "source": "Work, volume {n}", "source_type": "historical"}
    rows = registry.volumes(spark, 12, base).unionByName(registry.volumes(spark, 1, {**base, "category": "single"}))
    return registry.counts(registry.by_categories(rows, ["multi", "single"]))


@query("ocr_job_status", "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'DONE' WHEN doc_id % 2 = 0 THEN 'READY' ELSE 'MISSING' END AS status FROM documents")
def ocr_job_status(spark, d):
    jobs = table(spark, d, "documents").select("doc_id", (F.col("doc_id") % 3 == 0).alias("output_exists"), (F.col("doc_id") % 2 == 0).alias("input_exists"))
    return I.ocr_job_status(jobs).select("doc_id", "status")


_FRONT = """SELECT concat('/in/my_file-', doc_id, '.txt') AS path, CASE WHEN doc_id % 2 = 0 THEN 'A' ELSE concat('My File ', doc_id) END AS source, concat('my_file-', doc_id) AS short_name,
    'secondary' AS source_type, CASE WHEN doc_id % 2 = 0 THEN [source] ELSE []::VARCHAR[] END AS era, NULL::VARCHAR AS translator, NULL::VARCHAR AS reliability, text AS body FROM documents"""


@query("front_matter", _FRONT)
def front_matter(spark, d):
    head = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("---\nsource: A\nera: ["), "source", F.lit("]\n---\n"))).otherwise("")
    files = table(spark, d, "documents").select(F.concat(F.lit("/in/my_file-"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("path"), F.concat(head, "text").alias("text"))
    return readers.front_matter(files)


@query(
    "sidecar_front_matter",
    """SELECT concat('/in/my_file-', doc_id, '.txt') AS path, CASE WHEN doc_id % 3 = 0 THEN concat('From ', source) WHEN doc_id % 2 = 0 THEN 'A' ELSE concat('My File ', doc_id) END AS source, concat('my_file-', doc_id) AS short_name,
    CASE WHEN doc_id % 3 = 0 THEN 'hadith' ELSE 'secondary' END AS source_type, CASE WHEN doc_id % 3 = 0 THEN ['x', 'y'] WHEN doc_id % 2 = 0 THEN [source] ELSE []::VARCHAR[] END AS era, NULL::VARCHAR AS translator, NULL::VARCHAR AS reliability,
    CASE WHEN doc_id % 6 = 0 THEN concat('---', chr(10), 'source: A', chr(10), 'era: [', source, ']', chr(10), '---', chr(10), text) ELSE text END AS body FROM documents""",
)
def sidecar_front_matter(spark, d):
    docs = table(spark, d, "documents")
    head = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("---\nsource: A\nera: ["), "source", F.lit("]\n---\n"))).otherwise("")
    path = lambda end: F.concat(F.lit("/in/my_file-"), F.col("doc_id").cast("string"), F.lit(end)).alias("path")
    side = docs.where("doc_id % 3 = 0").select(path(".yaml"), F.concat(F.lit("source: From "), "source", F.lit("\nsource_type: hadith\nera:\n- x\n- y\n")).alias("text"))
    return readers.front_matter(docs.select(path(".txt"), F.concat(head, "text").alias("text")), side)


_WEB = """w AS (SELECT min(page_id) AS page_id, regexp_replace(regexp_replace(url, '#.*$', ''), '/+$', '') AS url FROM pages WHERE url IS NOT NULL GROUP BY 2),
    e AS (SELECT a.url, b.url AS next FROM w a JOIN w b ON b.page_id IN (2 * a.page_id + 3, 2 * a.page_id + 4))"""


@query("crawl_pages", f"""WITH RECURSIVE {_WEB}, c AS (SELECT url, 0 AS round FROM w WHERE page_id < 3 UNION SELECT e.next, round + 1 FROM e JOIN c USING (url) WHERE round < 60)
    SELECT url, min(round)::INT AS round, any_value(length(html)) AS n_chars FROM c JOIN w USING (url) JOIN (SELECT page_id, html FROM pages) p USING (page_id) GROUP BY url""")
def crawl_pages(spark, d):
    """A web in which page n links to 2n + 3 and 2n + 4, crawled from the first three in two goes."""
    pages = table(spark, d, "pages").where("url is not null")
    own = written(pages.groupBy(crawl.address(F.col("url")).alias("url")).agg(F.min("page_id").alias("page_id")))
    to = own.select(F.col("page_id").alias("_to"), F.col("url").alias("_link"))
    each = own.select("url", F.explode(F.array(F.col("page_id") * 2 + 3, F.col("page_id") * 2 + 4)).alias("_to")).join(to, "_to").groupBy("url").agg(F.collect_list("_link").alias("links"))
    web = written(own.join(each, "url", "left"))

    def fetch(frontier):
        """The frontier's pages of the table; texts stay where they are while the asked ones are counted to be few."""
        asked = written(web.join(frontier, "url", "left_semi"))
        asked = F.broadcast(asked) if asked.count() <= 200_000 else asked
        return pages.select("page_id", "html").join(asked, "page_id")

    folder = f"{shared_folder(spark)}/crawl-{uuid.uuid4().hex}"
    seeds = web.where("page_id < 3").select("url")
    crawl.crawl(seeds, fetch, folder, rounds=3)
    return crawl.crawl(seeds, fetch, folder).select("url", "round", F.length("html").alias("n_chars"))


@query("archive_books", "SELECT concat('book ', id % 40) AS book, id AS number, content AS text, source_type AS grade FROM docs WHERE content IS NOT NULL", "docs")
def archive_books(spark, d):
    """Documents as books of JSON in zip archives, read back member by member."""
    each = role(spark, d, "docs").where("content is not null").selectExpr("concat('book ', id % 40) AS book", "id div 400 AS part", "id", "content", "source_type")

    def pack(batches):
        """An archive is written when the next one's first document comes, so a task holds one."""
        import io
        import json
        import zipfile
        from itertools import groupby

        import pyarrow as pa

        rows = (tuple(c[i].as_py() for c in b.columns) for b in batches for i in range(b.num_rows))
        for (book, part), entries in groupby(rows, lambda r: r[:2]):
            text = json.dumps({"books": [{"name_en": book, "hadiths": [{"hadith_number": r[2], "text_en": r[3], "grade_en": r[4]} for r in entries]}]}, ensure_ascii=False)
            out = io.BytesIO()
            with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
                z.writestr(f"{book}/{part}.json", text)
                z.writestr("README", "no book")
            yield pa.RecordBatch.from_arrays([pa.array([f"{book}-{part}.zip"]), pa.array([out.getvalue()], pa.binary())], ["path", "content"])

    books = each.repartition("book", "part").sortWithinPartitions("book", "part")
    archives = written(books.mapInArrow(pack, "path string, content binary"))
    shape = "books array<struct<name_en:string,hadiths:array<struct<hadith_number:bigint,text_en:string,grade_en:string>>>>"
    return readers.collection_rows(readers.members(archives).select(F.from_json("text", shape).alias("j")).select("j.*"))


@query("english_bodies", r"SELECT cast(id AS VARCHAR) AS number, trim(regexp_replace(content, '<[^>]+>', '', 'g')) AS body FROM docs WHERE source_type = 'en' AND length(trim(regexp_replace(content, '<[^>]+>', '', 'g'))) >= 20", "docs")
def english_bodies(spark, d):
    """The first English body of nested entries."""
    body = lambda lang, text: F.struct(lang.alias("lang"), text.alias("body"))
    docs = role(spark, d, "docs")
    entry = F.struct(F.col("id").cast("string").alias("hadithNumber"), F.array(body(F.lit("ar"), F.col("source")), body(F.col("source_type"), F.col("content")), body(F.lit("en"), F.lit(None).cast("string"))).alias("hadith"))
    return readers.sunnah_bodies(docs.select(F.array(entry).alias("data")))


@query("source_manifest", "SELECT source, source_type, count(*) AS chunk_count FROM docs GROUP BY ALL", "docs")
def source_manifest(spark, d):
    """Sources written as a manifest of JSON lines and read as a registry."""
    folder = f"{shared_folder(spark)}/manifest-{uuid.uuid4().hex}"
    writers.manifest(role(spark, d, "docs").groupBy("source", "source_type").agg(F.count(F.lit(1)).alias("chunk_count")), folder)
    return spark.read.schema("source string, source_type string, chunk_count bigint").json(folder)


@query("replace_source", "SELECT id, CASE WHEN source = 'src1' THEN concat('new ', id) ELSE content END AS content, source FROM docs WHERE NOT (source = 'src1' AND id % 2 = 0)", "docs")
def replace_source(spark, d):
    """A published table of which one source is replaced by half as many new rows in a new version."""
    root, docs = f"{shared_folder(spark)}/tables-{uuid.uuid4().hex}", role(spark, d, "docs")
    writers.publish(docs, root, "documents")
    fresh = docs.where("source = 'src1' AND id % 2 <> 0").withColumn("content", F.concat(F.lit("new "), "id"))
    writers.replace_current(fresh, root, "documents", F.col("source") == "src1")
    return writers.read_current(spark, root, "documents").select("id", "content", "source")
