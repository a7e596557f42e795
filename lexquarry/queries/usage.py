"""Quotas, limits, sessions and telemetry on the events and conversations tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lexquarry.functions import tagging as G
from lexquarry.functions import variant as V
from lexquarry.operators import usage as U
from lexquarry.operators.ingest import shared_folder
from lexquarry.queries._base import query, role, table
from lexquarry.streaming import usage as stream


@query("monthly_usage", "SELECT api_key, endpoint, date_trunc('month', created_at)::TIMESTAMP AS month, count(*) AS used FROM log GROUP BY 1, 2, 3", "log")
def monthly_usage(spark, d):
    return U.monthly_usage(role(spark, d, "log")).withColumn("month", F.col("month").cast("timestamp_ntz"))


@query("quota_check", "SELECT api_key, count(*) AS used, count(*) < 70 AS allowed FROM log WHERE created_at >= TIMESTAMP '2024-01-01' AND created_at < TIMESTAMP '2024-02-01' GROUP BY 1", "log")
def quota_check(spark, d):
    return U.quota_check(role(spark, d, "log"), F.lit("2024-01-15").cast("timestamp_ntz"), 70)


@query("quota_decisions", "SELECT id, api_key, row_number() OVER (PARTITION BY api_key, date_trunc('month', created_at) ORDER BY created_at, id) <= 40 AS accepted FROM log", "log")
def quota_decisions(spark, d):
    return U.quota_decisions(role(spark, d, "log"), 40).select("id", "api_key", "accepted")


@query("quota_stream", "SELECT api_key, month, least(n, 40) AS accepted, greatest(n - 40, 0) AS rejected FROM (SELECT api_key, year(created_at) * 12 + month(created_at) AS month, count(*) AS n FROM log GROUP BY 1, 2)", "log")
def quota_stream(spark, d):
    """Events dealt to eight files whatever their time, replayed file by file: the sums of what was decided at each arrival."""
    folder = f"{shared_folder(spark)}/quota-{uuid.uuid4().hex}"
    log = role(spark, d, "log").select("id", "api_key", F.col("created_at").cast("timestamp").alias("created_at"))
    log.repartition(8, "id").drop("id").write.parquet(f"{folder}/in")
    arriving = spark.readStream.schema("api_key bigint, created_at timestamp").option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    before = spark.conf.get(stream.STATE_STORE[0], None)
    spark.conf.set(*stream.STATE_STORE)
    try:
        decided = stream.quota_decisions(arriving, 40, key="api_key", late="1000 days")
        decided.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(stream.STATE_STORE[0], before) if before else spark.conf.unset(stream.STATE_STORE[0])
    return spark.read.parquet(f"{folder}/out").groupBy("api_key", "month").agg(F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected"))


@query("rate_limit_violations", "SELECT api_key, time_bucket(INTERVAL 60 MINUTES, created_at) AS window_start, count(*) AS hits FROM log GROUP BY 1, 2 HAVING count(*) > 1", "log")
def rate_limit_violations(spark, d):
    return U.rate_limit_violations(role(spark, d, "log"), 1, minutes=60)


@query("percent_used", "SELECT id, round(CASE WHEN id % 5 = 0 THEN NULL ELSE (id % 97)::DOUBLE / (id % 5)::DOUBLE END * 100, 1) AS percent FROM log", "log")
def percent_used(spark, d):
    return role(spark, d, "log").select("id", G.percent_used(F.col("id") % 97, F.col("id") % 5).alias("percent"))


@query("latest_key", "SELECT api_key, id, endpoint FROM (SELECT *, row_number() OVER (PARTITION BY api_key ORDER BY created_at DESC, id DESC) AS rn FROM log) WHERE rn = 1", "log")
def latest_key(spark, d):
    return U.latest_row(role(spark, d, "log"), "api_key").select("api_key", "id", "endpoint")


@query(
    "chat_sessions",
    """WITH g AS (SELECT api_key, created_at, CASE WHEN created_at - lag(created_at) OVER w < INTERVAL 6 HOURS THEN 0 ELSE 1 END AS fresh FROM log WINDOW w AS (PARTITION BY api_key ORDER BY created_at, id)),
    s AS (SELECT api_key, created_at, sum(fresh) OVER (PARTITION BY api_key ORDER BY created_at ROWS UNBOUNDED PRECEDING) AS n FROM g)
    SELECT api_key, min(created_at) AS start, max(created_at) AS last, count(*) AS events FROM s GROUP BY api_key, n""",
    "log",
)
def chat_sessions(spark, d):
    return U.sessions(role(spark, d, "log"), key="api_key")


@query("telemetry_sweep", """SELECT id, CASE WHEN created_at < TIMESTAMP '2022-12-01' OR (count(*) OVER (PARTITION BY query_hash) = 1 AND created_at < TIMESTAMP '2024-03-03') THEN NULL ELSE props END AS query_text
    FROM (SELECT *, md5(CASE WHEN id % 4 = 0 THEN cast(id AS VARCHAR) ELSE props END) AS query_hash FROM log)""", "log")
def telemetry_sweep(spark, d):
    log = role(spark, d, "log").withColumn("query_hash", F.md5(F.when(F.col("id") % 4 == 0, F.col("id").cast("string")).otherwise(F.col("props")))).withColumn("query_text", F.col("props"))
    return U.telemetry_sweep(log, F.lit("2024-06-01").cast("date")).select("id", "query_text")


_PII = " OR ".join(f"regexp_matches(text, '{p.replace(chr(39), chr(39) * 2)}')" for p in G.PERSONAL)


@query("pii_flag", f"SELECT doc_id, coalesce({_PII}, false) AS pii FROM documents")
def pii_flag(spark, d):
    return table(spark, d, "documents").select("doc_id", G.pii_flag(F.col("text")).alias("pii"))


@query("query_hash", r"SELECT conv_id, turn, upper(sha256(regexp_replace(regexp_replace(lower(text), '^\s+|\s+$', '', 'g'), '\s+', ' ', 'g'))) AS hash FROM turns", "turns")
def query_hash(spark, d):
    return role(spark, d, "turns").select("conv_id", "turn", F.hex(G.query_hash(F.col("text"))).alias("hash"))


@query("telemetry_row", rf"SELECT conv_id, turn, coalesce({_PII}, false) AS pii_flagged, CASE WHEN NOT coalesce({_PII}, false) THEN text END AS query_text, ((length(text) - length(replace(text, '**', ''))) // 4)::BIGINT AS citations_count FROM turns", "turns")
def telemetry_row(spark, d):
    return U.telemetry_row(role(spark, d, "turns")).select("conv_id", "turn", "pii_flagged", "query_text", "citations_count")


@query("citations_count", "SELECT doc_id, ((length(text) - length(replace(text, '**', ''))) // 4)::BIGINT AS citations FROM documents")
def citations_count(spark, d):
    return table(spark, d, "documents").select("doc_id", G.citations_count(F.col("text")).alias("citations"))


@query("valid_email", "SELECT c_custkey, regexp_full_match(CASE WHEN c_custkey % 3 = 0 THEN c_name ELSE concat(c_name, '@', c_mktsegment, '.com') END, '[^@]+@[^@]+\\.[^@]+') AS ok FROM customer".replace("\\\\", "\\"))
def valid_email(spark, d):
    c = table(spark, d, "customer")
    mail = F.when(F.col("c_custkey") % 3 == 0, F.col("c_name")).otherwise(F.concat("c_name", F.lit("@"), "c_mktsegment", F.lit(".com")))
    return c.select("c_custkey", G.valid_email(mail).alias("ok"))


@query("format_passages", "SELECT o_orderkey, CASE WHEN n >= 1000000 THEN concat(regexp_replace(regexp_replace(format('{:.1f}', n / 1e6), '0+$', ''), '\\.$', ''), 'M+') WHEN n >= 1000 THEN concat(n // 1000, 'K+') ELSE cast(n AS VARCHAR) END AS shown FROM (SELECT o_orderkey, o_orderkey * o_orderkey AS n FROM orders)".replace("\\\\", "\\"))
def format_passages(spark, d):
    return table(spark, d, "orders").select("o_orderkey", G.format_passages(F.col("o_orderkey") * F.col("o_orderkey")).alias("shown"))


@query("stats_inject", """SELECT n_nationkey, concat('<p><b data-stat="sources" class="x">', n_nationkey * 7, '</b> of <i data-stat="other">5</i></p>') AS html FROM nation""")
def stats_inject(spark, d):
    n = table(spark, d, "nation")
    page = F.lit('<p><b data-stat="sources" class="x">0</b> of <i data-stat="other">5</i></p>')
    return n.select("n_nationkey", G.inject_stats(page, {"sources": F.col("n_nationkey") * 7}).alias("html"))


@query("props_by_path", """SELECT id, try_cast(regexp_extract(props, '"k": ([0-9]+)', 1) AS BIGINT) AS k, CASE WHEN props IS NOT NULL THEN 'object' END AS kind, NULL::VARCHAR AS missing FROM log""", "log")
def props_by_path(spark, d):
    """Properties parsed once, read by path and type."""
    v = role(spark, d, "log").select("id", V.parsed(F.col("props")).alias("v"))
    return v.select("id", V.at(F.col("v"), "$.k", "bigint").alias("k"), V.kind(F.col("v")).alias("kind"), V.at(F.col("v"), "$.nothing.here", "string").alias("missing"))


@query("props_fields", """SELECT 'k' AS field, 'number' AS kind, count(*) AS rows, max(try_cast(regexp_extract(props, '"k": ([0-9]+)', 1) AS BIGINT)) AS largest FROM log WHERE contains(props, '"k"')""", "log")
def props_fields(spark, d):
    v = role(spark, d, "log").select("id", V.parsed(F.col("props")).alias("v"))
    return V.fields(v, "v", "id").groupBy("field", V.kind(F.col("value")).alias("kind")).agg(F.count(F.lit(1)).alias("rows"), F.max(V.at(F.col("value"), "$", "bigint")).alias("largest"))


@query("deactivate_contained", "SELECT c_custkey AS id, NOT c_name ILIKE '%er#00000001%' AS active FROM customer")
def deactivate_contained(spark, d):
    keys = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.lit(True).alias("active"))
    return U.deactivate(keys, "ER#00000001", contained=True).select("id", "active")


@query("exactly_once_stream", "SELECT id, api_key FROM log", "log")
def exactly_once_stream(spark, d):
    """Every event sent twice in different files: one comes through."""
    folder = f"{shared_folder(spark)}/once-{uuid.uuid4().hex}"
    log = role(spark, d, "log").select("id", "api_key", F.col("created_at").cast("timestamp").alias("created_at"))
    log.withColumn("sent", F.explode(F.array(F.lit(0), F.lit(1)))).repartition(6, "id", "sent").drop("sent").write.parquet(f"{folder}/in")
    arriving = spark.readStream.schema("id bigint, api_key bigint, created_at timestamp").option("maxFilesPerTrigger", 2).parquet(f"{folder}/in")
    once = stream.exactly_once(arriving, "id", late="1000 days")
    once.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{folder}/out").select("id", "api_key")
