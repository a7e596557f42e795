"""The registered queries of this folder: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lexquarry.llm import ann, merkle, unigram_sp
from lexquarry.llm._util import table
from lexquarry.llm.alignment import align
from lexquarry.llm.exact_dedup import exact_dedup
from lexquarry.llm.kn_quality import quality
from lexquarry.llm.licenses import scan_licenses
from lexquarry.llm.line_dedup import _BLANKS, _ENTITIES, _STEPS, LEAST_PAGES, RATIO, line_dedup
from lexquarry.llm.mixing import mix
from lexquarry.llm.pii import find_pii
from lexquarry.llm.sharding import kd_shards
from lexquarry.llm.simhash_golay import simhash_golay
from lexquarry.llm.token_counts import token_counts


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op2_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "pages"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op5_kn_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_golay(table(spark, sf_dir, "documents"))


def op7_unigram_sp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unigram_sp.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_shards(table(spark, sf_dir, "documents"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.merkle(table(spark, sf_dir, "documents"))


def op12_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents")).drop("places")


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def queries() -> dict:
    found = {k: v for k, v in globals().items() if k.startswith("op") and callable(v)}
    return dict(sorted(found.items(), key=lambda x: int(x[0][2:].split("_")[0])))


def _lines_sql() -> str:
    text = "coalesce(html, '')"
    for pattern, by in _STEPS:
        text = f"regexp_replace({text}, {_quoted(pattern)}, {_quoted(by)}, 'g')"
    for entity, by in _ENTITIES:
        text = f"replace({text}, {_quoted(entity)}, {_quoted(by)})"
    text = f"regexp_replace({text}, {_quoted(_BLANKS)}, ' ', 'g')"
    return f"list_filter(list_transform(string_split({text}, chr(10)), lambda x: trim(x)), lambda x: x <> '')"


def _quoted(s: str) -> str:
    return "chr(10)" if s == "\n" else "'" + s.replace("'", "''") + "'"


ORACLE_SQL = {
    "op3_line_dedup": f"""
        WITH rows AS (
            SELECT page_id, lower(coalesce(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1), '')) AS host, {_lines_sql()} AS lines FROM pages),
        sizes AS (SELECT host, count(*) AS pages FROM rows GROUP BY host),
        held AS (SELECT host, line, count(*) AS n FROM (SELECT host, unnest(list_distinct(lines)) AS line FROM rows) GROUP BY host, line),
        common AS (SELECT host, list(line) AS common FROM held JOIN sizes USING (host) WHERE n >= {LEAST_PAGES} AND n > {RATIO}::DOUBLE * pages GROUP BY host),
        cleaned AS (SELECT page_id, host, lines, list_filter(lines, lambda x: NOT list_contains(coalesce(common, []), x)) AS kept FROM rows LEFT JOIN common USING (host))
        SELECT page_id, host, len(lines) AS n_lines, len(lines) - len(kept) AS n_dropped, coalesce(array_to_string(kept, chr(10)), '') AS text FROM cleaned""",
    "op4_exact_dedup": r"""
        WITH rows AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h FROM documents)
        SELECT doc_id, min(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
               doc_id = min(doc_id) OVER (PARTITION BY h) AS kept, h AS text_sha256 FROM rows""",
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
