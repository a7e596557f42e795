"""Cleaning, chunking and tagging on the documents and pages tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexquarry.functions import automaton
from lexquarry.functions import table as table_functions
from lexquarry.functions import tagging as G
from lexquarry.functions import text as T
from lexquarry.operators import ingest as I
from lexquarry.queries._base import query, role, table
from lexquarry.sources import readers

NAMES = ["the", "Und", "que", "Ali", "tion", "no such name"]
_N_SQL = "['the', 'Und', 'que', 'Ali', 'tion', 'no such name']"


def _docs(spark, d):
    return table(spark, d, "documents")


def _strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def _alpha(x: str) -> str:
    return rf"coalesce(length(regexp_replace({x}, '[^\p{{L}}]', '', 'g'))::DOUBLE / nullif(length({x}), 0), 0.0)"


def _norm(x: str) -> str:
    newlines = rf"regexp_replace({x}, '\n{{3,}}', chr(10) || chr(10), 'g')"
    blanks = "regexp_replace(" + newlines + ", '[ \\t]{3,}', '  ', 'g')"
    return _strip(blanks)


def _clean_sql(text: str, alpha: float | None, short: int, page: str | None, repeat: int | None, feeds: bool, indent: bool, exempt: int | None = None, period: bool = False, source: str = "documents") -> str:
    if feeds:
        text = rf"regexp_replace(replace({text}, chr(12), chr(10)), '(?m)^\s*\d{{1,4}}\s*$', '', 'g')"
    s = _strip("l")
    bad = []
    if short:
        noise = rf"(length({s}) < {short} OR (regexp_matches({s}, '(?i)^[ivxlcdm]+$') AND length({s}) < 10))"
        bad.append(f"({noise} AND NOT ends_with({s}, '.'))" if period else noise)
    if repeat:
        bad.append(f"list_contains(rep, {s})")
    if page:
        bad.append(f"regexp_matches({s}, '{page}')")
    if alpha is not None:
        weak = f"{_alpha(s)} <= {alpha}::DOUBLE"
        bad.append(weak if exempt is None else f"({weak} AND length({s}) < {exempt})")
    keep = f"({s} = '' OR NOT ({' OR '.join(bad)}))"
    shown = f"CASE WHEN {s} = '' THEN '' ELSE {'l' if indent else s} END"
    short_lines = rf"list_filter(list_transform(ls, lambda q: {_strip('q')}), lambda q: length(q) > 5 AND length(q) < 100)"
    rep = f"list_filter(list_distinct({short_lines}), lambda q: len(list_filter({short_lines}, lambda z: z = q)) >= {repeat})" if repeat else "[]"
    return f"""WITH a AS (SELECT doc_id, string_split({text}, chr(10)) AS ls FROM {source}), b AS (SELECT doc_id, ls, {rep} AS rep FROM a),
        c AS (SELECT doc_id, list_transform(list_filter(ls, lambda l: {keep}), lambda l: {shown}) AS k FROM b),
        e AS (SELECT doc_id, array_to_string(list_filter(k, lambda x, i: x <> '' OR (i > 1 AND k[i - 1] <> '')), chr(10)) AS t FROM c)
        SELECT doc_id, {_norm('t')} AS cleaned FROM e"""


@query("alpha_ratio", f"SELECT doc_id, round({_alpha('text')}, 6) AS ratio FROM documents")
def alpha_ratio(spark, d):
    return _docs(spark, d).select("doc_id", F.round(T.alpha_ratio(F.col("text")), 6).alias("ratio"))


@query("is_readable", f"SELECT doc_id, length(text) > 0 AND {_alpha('text')} > 0.7::DOUBLE AS readable FROM documents")
def is_readable(spark, d):
    return _docs(spark, d).select("doc_id", T.is_readable(F.col("text"), 0.7).alias("readable"))


@query("word_count", r"SELECT doc_id, len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> ''))::BIGINT AS words FROM documents")
def word_count(spark, d):
    return _docs(spark, d).select("doc_id", T.word_count(F.col("text")).alias("words"))


@query("normalize_whitespace", f"SELECT doc_id, {_norm('text')} AS cleaned FROM documents")
def normalize_whitespace(spark, d):
    return _docs(spark, d).select("doc_id", T.normalize_whitespace(F.col("text")).alias("cleaned"))


@query("noise_line", rf"SELECT doc_id, count(*) AS lines, count(*) FILTER (length(s) < 15 OR (regexp_matches(s, '(?i)^[ivxlcdm]+$') AND length(s) < 10)) AS noise FROM (SELECT doc_id, {_strip('l')} AS s FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM documents)) GROUP BY doc_id")
def noise_line(spark, d):
    lines = _docs(spark, d).select("doc_id", F.explode(F.split("text", "\n")).alias("l"))
    return lines.groupBy("doc_id").agg(F.count(F.lit(1)).alias("lines"), F.count_if(T.is_noise_line(T.strip(F.col("l")))).alias("noise"))


def _repeated(least: int) -> str:
    return f"SELECT doc_id, list_sort(list(s)) AS repeated FROM (SELECT doc_id, s FROM (SELECT doc_id, {_strip('l')} AS s FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM documents)) WHERE length(s) > 5 AND length(s) < 100 GROUP BY doc_id, s HAVING count(*) >= {least}) GROUP BY doc_id"


@query("repeated_headers", _repeated(30))
def repeated_headers(spark, d, least: int = 30):
    found = _docs(spark, d).select("doc_id", T.repeated_lines(F.split("text", "\n"), least).alias("repeated"))
    return found.where(F.size("repeated") > 0).select("doc_id", F.array_sort("repeated").alias("repeated"))


@query("repeated_lines_twice", _repeated(2))
def repeated_lines_twice(spark, d):
    return repeated_headers(spark, d, 2)


@query("clean_djvu", _clean_sql("text", 0.4, 15, None, 30, True, True))
def clean_djvu(spark, d):
    return _docs(spark, d).select("doc_id", T.clean_djvu(F.col("text")).alias("cleaned"))


@query("clean_pdf", _clean_sql("text", None, 15, r"^\d+$", 30, False, False))
def clean_pdf(spark, d):
    return _docs(spark, d).select("doc_id", T.clean_pdf(F.col("text")).alias("cleaned"))


@query("clean_pdf_then_djvu", _clean_sql("cleaned", 0.4, 15, None, 30, True, True, source="(" + _clean_sql("text", None, 15, r"^\d+$", 30, False, False) + ")"))
def clean_pdf_then_djvu(spark, d):
    return _docs(spark, d).select("doc_id", T.clean_pdf(F.col("text")).alias("text")).select("doc_id", T.clean_djvu(F.col("text")).alias("cleaned"))


def _profile(name: str, sql: str) -> None:
    query(f"clean_profile_{name}", sql)(lambda spark, d: _docs(spark, d).select("doc_id", T.clean(F.col("text"), T.LEGACY[name]).alias("cleaned")))


_profile("strict", _clean_sql("text", 0.5, 0, None, None, False, True))
_profile("middle", _clean_sql("text", 0.4, 0, None, None, False, True))
_profile("loose", _clean_sql("text", 0.35, 0, None, None, False, True))
_profile("short_only", _clean_sql("text", 0.5, 15, None, 30, False, True, exempt=80))
_profile("sentence", _clean_sql("text", None, 15, r"^\d+$", 30, False, False, period=True))
_profile("plain", _clean_sql("text", None, 0, r"^\d+$", 30, False, False))


@query(
    "clean_section",
    rf"""WITH a AS (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda l: {_strip('l')}), lambda s: s <> '' AND NOT (regexp_matches(s, '(?i)^(?:[ivxlcdm]+|\d+)$') AND length(s) < 10)
        AND NOT regexp_matches(s, '^\(\d+\)') AND NOT regexp_matches(s, '^[\d\W]+$')) AS ls FROM documents),
        b AS (SELECT doc_id, ls, list_filter(range(1, len(ls) + 1), lambda i: regexp_matches(ls[i], '(?i)th'))[1] AS p FROM a)
        SELECT doc_id, coalesce(array_to_string(CASE WHEN p IS NOT NULL THEN ls[p:] ELSE ls END, chr(10)), '') AS cleaned FROM b""",
)
def clean_section(spark, d):
    return _docs(spark, d).select("doc_id", T.clean_section(F.col("text"), "(?i)th").alias("cleaned"))


@query("section_slice", "SELECT doc_id, substring(text, 22, 300) AS part FROM documents")
def section_slice(spark, d):
    return _docs(spark, d).select("doc_id", T.section(F.col("text"), 21, 321).alias("part"))


@query("strip_html", "SELECT page_id, regexp_replace(html, '<[^>]+>', '', 'g') AS text FROM pages")
def strip_html(spark, d):
    return table(spark, d, "pages").select("page_id", T.strip_html(F.col("html")).alias("text"))


#: On these pages an article holds no dropped element and no other article.
_ARTICLE = r"regexp_replace(regexp_extract(html, '(?s)<article[^>]*>(.*?)</article>', 1), '(?s)<!--.*?-->|<[^>]*>', chr(10), 'g')"


@query("html_main_text", rf"""SELECT page_id, array_to_string(list_filter(list_transform(string_split(replace(replace({_ARTICLE}, '&quot;', '"'), '&amp;', '&'), chr(10)), lambda l: {_strip('l')}), lambda l: l <> ''), chr(10)) AS text FROM pages""")
def html_main_text(spark, d):
    return table(spark, d, "pages").select("page_id", readers.html_main_text(F.col("html")).alias("text"))


@query("html_links", r"""SELECT page_id, list_transform(list_distinct_ordered[1:20], lambda x: CASE WHEN starts_with(x, 'http') THEN x ELSE concat('https://example.org', x) END) AS links
    FROM (SELECT page_id, list_filter(f, lambda x, i: list_position(f, x) = i) AS list_distinct_ordered FROM (SELECT page_id, regexp_extract_all(html, 'href=["'']([^"'']+)["'']', 1) AS f FROM pages))""")
def html_links(spark, d):
    return table(spark, d, "pages").select("page_id", readers.html_links(F.col("html"), "https://example.org", r"[^\"']+").alias("links"))


@query("strip_gutenberg", rf"""SELECT doc_id, {_strip("CASE WHEN instr(body, '*** END OF') > 0 THEN left(body, instr(body, '*** END OF') - 1) ELSE body END")} AS body FROM (SELECT doc_id, concat(text, chr(10), CASE WHEN doc_id % 3 = 0 THEN concat('*** END OF it', chr(10), 'tail') ELSE '' END) AS body FROM documents)""")
def strip_gutenberg(spark, d):
    tail = F.when(F.col("doc_id") % 3 == 0, "*** END OF it\ntail").otherwise("")
    head = F.when(F.col("doc_id") % 2 == 0, "licence\n*** START OF it\n").otherwise("")
    return _docs(spark, d).select("doc_id", T.strip_gutenberg(F.concat(head, F.col("text"), F.lit("\n"), tail)).alias("body"))


@query("sentences", r"SELECT doc_id, list_filter(list_transform(string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(31), 'g'), chr(31)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') AS sentences FROM documents")
def sentences(spark, d):
    return _docs(spark, d).select("doc_id", T.sentences(F.col("text")).alias("sentences"))


def _windows(target: int, overlap: int, min_words: int, min_chars: int = 0) -> str:
    step = target - overlap
    return rf"""WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '') AS ws FROM documents),
        c AS (SELECT doc_id, list_filter(list_transform(range(0, len(ws), {step}), lambda i: ws[i + 1:i + {target}]), lambda x: len(x) >= {min_words}) AS cs FROM w)
        SELECT doc_id, list_filter(list_transform(cs, lambda x: array_to_string(x, ' ')), lambda t: length(t) >= {min_chars}) AS chunks FROM c"""


@query("chunk_words", _windows(500, 50, 100))
def chunk_words(spark, d):
    return _docs(spark, d).select("doc_id", T.chunk_words(F.col("text")).alias("chunks"))


@query("chunk_words_legacy", _windows(500, 50, 0, 101))
def chunk_words_legacy(spark, d):
    return _docs(spark, d).select("doc_id", T.chunk_words(F.col("text"), min_words=0, min_chars=101).alias("chunks"))


@query("chunk_translation", _windows(800, 0, 50))
def chunk_translation(spark, d):
    return _docs(spark, d).select("doc_id", T.chunk_words(F.col("text"), 800, 0, 50).alias("chunks"))


def _count(x: str) -> str:
    return rf"len(list_filter(regexp_split_to_array({x}, '\s+'), lambda q: q <> ''))"


#: Chunk by chunk: one ends at the first sentence by which it holds 500 words, and the next one starts with the last
#: sentences of at most 50 words together. cum[i + 1] is the number of words of the first i sentences.
_CHUNKS = rf"""WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '\s+'), lambda q: q <> '') AS ws,
        list_filter(list_transform(string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(31), 'g'), chr(31)), lambda x: {_strip('x')}), lambda x: x <> '') AS p FROM documents),
    z AS (SELECT doc_id, ws, p, len(p) AS m, list_transform(p, lambda x: {_count('x')}) AS n FROM w),
    y AS (SELECT doc_id, ws, p, m, [0] || list_transform(range(1, m + 1), lambda i: list_sum(n[1:i])::BIGINT) AS cum FROM z),
    r AS (SELECT doc_id, 1::BIGINT AS f, 0::BIGINT AS e, 0 AS k, NULL::VARCHAR AS chunk FROM y WHERE NOT (m <= 3 AND len(ws) > 500)
        UNION ALL
        SELECT doc_id, CASE WHEN e2 IS NOT NULL THEN list_filter(range(f, e2 + 2), lambda s: cum[e2 + 1] - cum[s] <= 50)[1] END, e2, k + 1,
            CASE WHEN e2 IS NOT NULL THEN array_to_string(p[f:e2], ' ') WHEN f <= m AND cum[m + 1] - cum[f] >= 100 THEN array_to_string(p[f:m], ' ') END
        FROM (SELECT r.doc_id, r.f, r.k, y.p, y.m, y.cum, list_filter(range(r.e + 1, y.m + 1), lambda j: y.cum[j + 1] - y.cum[r.f] >= 500)[1] AS e2 FROM r JOIN y ON r.doc_id = y.doc_id WHERE r.f IS NOT NULL)),
    chunked AS (SELECT doc_id, coalesce(list(chunk ORDER BY k) FILTER (WHERE chunk IS NOT NULL), []) AS chunks FROM r GROUP BY doc_id
        UNION ALL SELECT doc_id, list_transform(list_filter(list_transform(range(0, len(ws), 450), lambda i: ws[i + 1:i + 500]), lambda x: len(x) >= 100), lambda x: array_to_string(x, ' ')) FROM y WHERE m <= 3 AND len(ws) > 500)"""


@query("chunk_sentences", f"{_CHUNKS} SELECT doc_id, chunks FROM chunked")
def chunk_sentences(spark, d):
    return _docs(spark, d).select("doc_id", T.chunk_sentences()(F.col("text")).alias("chunks"))


@query("build_chunks", f"{_CHUNKS} SELECT id, (i - 1)::INT AS chunk_index, chunks[i] AS content, {_count('chunks[i]')}::BIGINT AS word_count FROM (SELECT doc_id AS id, chunks, unnest(range(1, len(chunks) + 1)) AS i FROM chunked)")
def build_chunks(spark, d):
    return I.build_chunks(role(spark, d, "docs"), T.chunk_sentences())


@query("chunk_text_table", f"{_CHUNKS} SELECT id, source, (i - 1)::INT AS chunk_index, chunks[i] AS content, {_count('chunks[i]')}::BIGINT AS word_count FROM (SELECT doc_id AS id, source, chunks, unnest(range(1, len(chunks) + 1)) AS i FROM chunked JOIN documents USING (doc_id))")
def chunk_text_table(spark, d):
    """The table function, called from SQL."""
    table_functions.register(spark)
    return spark.sql("SELECT * FROM chunk_text(TABLE({docs}) PARTITION BY id)", docs=role(spark, d, "docs").select("id", "content", "source"))


@query("readable_chunks", rf"WITH w AS ({_windows(500, 50, 100)}) SELECT doc_id, list_filter(chunks, lambda c: {_alpha('c')} > 0.7::DOUBLE) AS readable, len(list_filter(chunks, lambda c: {_alpha('c')} > 0.7::DOUBLE)) >= 2 AS enough FROM w")
def readable_chunks(spark, d):
    chunks = F.filter(T.chunk_words(F.col("text")), lambda c: T.is_readable(c, 0.7))
    return _docs(spark, d).select("doc_id", chunks.alias("readable")).withColumn("enough", F.size("readable") >= 2)


@query("extract_entities", f"SELECT doc_id, CASE WHEN len(f) > 0 THEN f END AS figures FROM (SELECT doc_id, list_filter({_N_SQL}, lambda n: contains(lower(text), lower(n))) AS f FROM documents)")
def extract_entities(spark, d):
    return _docs(spark, d).select("doc_id", G.extract_entities(F.col("text"), NAMES).alias("figures"))


@query("extract_known_names", "SELECT doc_id, CASE WHEN len(f) > 0 THEN f END AS figures FROM (SELECT doc_id, list_filter([" + ", ".join("'" + n.replace("'", "''") + "'" for n in G.KNOWN_NAMES) + "], lambda n: contains(lower(text), lower(n))) AS f FROM documents)")
def extract_known_names(spark, d):
    return _docs(spark, d).select("doc_id", G.extract_entities(F.col("text")).alias("figures"))


_REGISTRY = "names AS (SELECT DISTINCT n FROM (SELECT concat(p_name, ' ', p_brand) AS n FROM part UNION ALL SELECT unnest(regexp_extract_all(text, '[a-z]{7,}')) AS n FROM benchmark))"


@query("tag_registry_names", f"WITH {_REGISTRY} SELECT doc_id, list(n ORDER BY n) FILTER (contains(lower(text), lower(n))) AS figures FROM documents, names GROUP BY doc_id")
def tag_registry_names(spark, d):
    """About two thousand names: one for each kind of part, and the long words of the benchmark."""
    words = table(spark, d, "benchmark").select(F.explode(F.regexp_extract_all("text", F.lit("[a-z]{7,}"), F.lit(0))).alias("name"))
    names = table(spark, d, "part").select(F.concat_ws(" ", "p_name", "p_brand").alias("name")).unionByName(words)
    return automaton.tag_names(_docs(spark, d), names, "doc_id", "text")


@query("extract_entities_ext", f"SELECT doc_id, list_sort(list_filter({_N_SQL} || ['der', 'zu'], lambda n: contains(lower(text), lower(n)))) AS figures FROM documents")
def extract_entities_ext(spark, d):
    return _docs(spark, d).select("doc_id", G.extract_entities_ext(F.col("text"), ["der", "zu"], tuple(NAMES)).alias("figures"))


_ERAS = {"a": ("ttion", "zzz"), "b": ("schach",), "c": ("eaue", "ento")}


@query("detect_era", "SELECT doc_id, CASE WHEN contains(t, 'ttion') OR contains(t, 'zzz') THEN 'a' WHEN contains(t, 'schach') THEN 'b' WHEN contains(t, 'eaue') OR contains(t, 'ento') THEN 'c' END AS era FROM (SELECT doc_id, lower(text) AS t FROM documents)")
def detect_era(spark, d):
    return _docs(spark, d).select("doc_id", G.detect_era(F.col("text"), _ERAS).alias("era"))


_GRADES = "CASE doc_id % 6 WHEN 0 THEN ['none', 'Daif', 'Sahih'] WHEN 1 THEN ['Hasan Sahih'] WHEN 2 THEN ['Da''if'] WHEN 3 THEN ['weak'] WHEN 4 THEN ['good', 'Hasan'] ELSE ['x'] END"


def _grades():
    a = lambda *x: F.array(*map(F.lit, x))
    k = F.col("doc_id") % 6
    return F.when(k == 0, a("none", "Daif", "Sahih")).when(k == 1, a("Hasan Sahih")).when(k == 2, a("Da'if")).when(k == 3, a("weak")).when(k == 4, a("good", "Hasan")).otherwise(a("x"))


@query("chain_strength_first", "SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN 'daif' WHEN 1 THEN 'sahih' WHEN 2 THEN 'daif' WHEN 4 THEN 'hasan' ELSE 'unknown' END AS chain FROM documents")
def chain_strength_first(spark, d):
    return _docs(spark, d).select("doc_id", G.chain_strength_first(_grades()).alias("chain"))


@query("chain_strength_any", f"SELECT doc_id, CASE WHEN contains(g, 'sahih') THEN 'sahih' WHEN contains(g, 'hasan') THEN 'hasan' WHEN contains(g, 'daif') OR contains(g, 'da''if') OR contains(g, 'weak') THEN 'daif' ELSE 'unknown' END AS chain FROM (SELECT doc_id, lower(array_to_string({_GRADES}, ' ')) AS g FROM documents)")
def chain_strength_any(spark, d):
    return _docs(spark, d).select("doc_id", G.chain_strength_any(_grades()).alias("chain"))


@query("embedding_plan", f"SELECT doc_id, CASE WHEN lang = 'en' THEN '{G.ENGLISH_MODEL}' ELSE '{G.OTHER_MODEL}' END AS model, CASE WHEN lang = 'en' THEN 128 ELSE 64 END AS batch FROM documents")
def embedding_plan(spark, d):
    english = F.col("lang") == "en"
    return _docs(spark, d).select("doc_id", G.embedding_model(F.when(english, "english").otherwise(F.col("lang"))).alias("model"), F.when(english, 128).otherwise(64).alias("batch"))
