"""Quotas, rate limits, sessions and telemetry over append-only logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexquarry.functions import tagging as G

#: Days after which a unique question, and months after which any, loses its text.
UNIQUE_DAYS, ALL_MONTHS = 90, 18


def monthly_usage(log: DataFrame, key: str = "api_key", kind: str = "endpoint", ts: str = "created_at") -> DataFrame:
    return log.groupBy(key, kind, F.date_trunc("month", ts).alias("month")).agg(F.count(F.lit(1)).alias("used"))


def quota_check(log: DataFrame, month: Column, limit: int, key: str = "api_key", ts: str = "created_at") -> DataFrame:
    """(key, used, allowed) in one month; the predicate on the time reaches the scan."""
    start = F.date_trunc("month", month)
    own = log.where((F.col(ts) >= start) & (F.col(ts) < F.add_months(start, 1)))
    return own.groupBy(key).agg(F.count(F.lit(1)).alias("used")).withColumn("allowed", F.col("used") < limit)


def quota_decisions(log: DataFrame, limit: int, key: str = "api_key", ts: str = "created_at", order: str = "id") -> DataFrame:
    """Adds ``accepted``: counts start anew each month, a request is accepted while fewer than ``limit`` were.

    Only the first ``limit`` requests of a key and month are ranked, a limit that is applied before
    the exchange; all rows are compared with the last of these, so no task sorts a busy key.
    """
    month = F.date_trunc("month", ts)
    first = log.select(F.col(key).alias("_key"), month.alias("_month"), F.struct(F.col(ts).alias("t"), F.col(order).alias("o")).alias("_at"))
    first = first.withColumn("_rn", F.row_number().over(Window.partitionBy("_key", "_month").orderBy("_at"))).where(F.col("_rn") <= limit)
    last = first.groupBy("_key", "_month").agg(F.count(F.lit(1)).alias("_n"), F.max("_at").alias("_last")).where(F.col("_n") == limit)
    joined = log.join(last, F.col(key).eqNullSafe(F.col("_key")) & month.eqNullSafe(F.col("_month")), "left")
    inside = F.col("_last").isNull() | (F.struct(F.col(ts).alias("t"), F.col(order).alias("o")) <= F.col("_last"))
    return joined.withColumn("accepted", inside if limit > 0 else F.lit(False)).drop("_key", "_month", "_n", "_last")


def rate_limit_violations(log: DataFrame, limit: int, minutes: int = 1, key: str = "api_key", ts: str = "created_at") -> DataFrame:
    """(key, window_start, hits) of fixed windows with more than ``limit`` requests."""
    window = F.window(ts, f"{minutes} minutes")
    return log.groupBy(key, window["start"].alias("window_start")).agg(F.count(F.lit(1)).alias("hits")).where(F.col("hits") > limit)


def latest_row(rows: DataFrame, key: str, ts: str = "created_at", order: str = "id") -> DataFrame:
    """The newest row of each key; of equal times the one of largest id."""
    rest = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(ts, order)).alias("r")).select(key, "r.*")


def sessions(log: DataFrame, gap: str = "6 hours", key: str = "user_id", ts: str = "created_at") -> DataFrame:
    """(key, start, last, events): runs of events with no gap as long as ``gap``."""
    s = F.session_window(ts, gap)
    return log.groupBy(key, s).agg(F.count(F.lit(1)).alias("events"), F.max(ts).alias("last")).select(key, F.col("session_window.start").alias("start"), "last", "events")


def telemetry_row(turns: DataFrame, text: str = "text") -> DataFrame:
    """Adds hash, flag and the text, which is null where it looks personal."""
    flag = G.pii_flag(F.col(text))
    return turns.withColumns({"pii_flagged": flag, "query_hash": F.hex(G.query_hash(F.col(text))), "query_text": F.when(~flag, F.col(text)), "citations_count": G.citations_count(F.col(text))})


def telemetry_sweep(log: DataFrame, as_of: Column, ts: str = "created_at", id_col: str = "id") -> DataFrame:
    """Retention: texts of unique questions go after 90 days, all texts after 18 months.

    Unique questions are found by a partial aggregation and met again by the row's own id, so a
    question that many ask doesn't gather in one task.
    """
    single = log.groupBy("query_hash").agg(F.count(F.lit(1)).alias("n"), F.min(id_col).alias("_alone")).where("n = 1").select("_alone")
    joined = log.join(single, F.col(id_col) == F.col("_alone"), "left")
    old = F.col(ts) < F.add_months(as_of, -ALL_MONTHS)
    stale = F.col("_alone").isNotNull() & (F.col(ts) < F.date_sub(as_of, UNIQUE_DAYS))
    return joined.withColumn("query_text", F.when(~(old | stale), F.col("query_text"))).drop("_alone")


def deactivate(keys: DataFrame, email: str, contained: bool = False) -> DataFrame:
    """Keys named for exactly this address are switched off; with ``contained`` all whose name contains it, whatever the case, in which % and _ are wild cards."""
    hit = F.col("name").ilike(f"%{email}%") if contained else F.lower("name") == email.lower()
    return keys.withColumn("active", F.col("active") & ~F.coalesce(hit, F.lit(False)))


def reset_month(keys: DataFrame, today: Column) -> DataFrame:
    """Counters whose month is over start again."""
    first = F.trunc(today, "month")
    over = F.coalesce(F.col("month_reset") < first, F.lit(True))
    return keys.withColumns({"month_count": F.when(over, 0).otherwise(F.col("month_count")), "month_reset": F.when(over, first).otherwise(F.col("month_reset"))})


def tier_config(keys: DataFrame, tiers: DataFrame, default: str = "free") -> DataFrame:
    """Adds the limits of each key's tier; unknown tiers get the default's."""
    known = keys.join(F.broadcast(tiers.select(F.col("tier").alias("_t"))), F.col("tier") == F.col("_t"), "left")
    named = known.withColumn("_tier", F.coalesce("_t", F.lit(default))).drop("_t")
    return named.join(F.broadcast(tiers.withColumnRenamed("tier", "_k")), F.col("_tier") == F.col("_k"), "left").drop("_tier", "_k")
