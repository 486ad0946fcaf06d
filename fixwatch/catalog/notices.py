"""Notice chains, events and classification."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fixwatch import sinks
from fixwatch.catalog.inputs import CHAINS, NOTICES, landing, notices, table
from fixwatch.catalog.registry import query, tidy_sql
from fixwatch.functions import notices as fn
from fixwatch.operators import outages

_TYPE = """CASE WHEN upper({t}) LIKE '%DECOM%' THEN 'decommissioning'
  WHEN upper({t}) LIKE '%FCST%' OR upper({t}) LIKE '%PLN@_OUTAGE%' ESCAPE '@' OR upper({t}) LIKE '%MAINT%' THEN 'scheduled_maintenance'
  WHEN upper({t}) LIKE '%UNUSABLE%' OR upper({t}) LIKE '%UNUNOREF%' OR upper({t}) LIKE '%UNAVAIL%' THEN 'unscheduled_outage'
  WHEN upper({t}) LIKE '%USABLE%' OR upper({t}) LIKE '%HEALTH%' THEN 'health_change'
  WHEN upper({t}) LIKE '%GENERAL%' THEN 'other' WHEN upper({t}) LIKE '%HAS%' THEN 'frequency_outage' ELSE 'other' END"""
_SEVERITY = """CASE WHEN upper({t}) LIKE '%USABLE%' AND upper({t}) NOT LIKE '%UNUSABLE%' THEN 'informational'
  WHEN upper({t}) LIKE '%GENERAL%' THEN 'informational'
  WHEN coalesce({s}, '') <> '' AND upper(trim({s})) <> 'ALL' THEN 'partial'
  WHEN regexp_matches(upper({t}), 'L1S|L6|L1C/B|L2|L5|DCR|DCX|MDC|HAS') THEN 'partial' ELSE 'total' END"""
_AFFECTED = """CASE WHEN {s} IS NOT NULL THEN
    CASE WHEN trim({s}) <> '' AND upper(trim({s})) <> 'ALL' THEN regexp_replace(upper(trim({s})), ' *, *', '|', 'g') END
  WHEN {h} IS NOT NULL AND upper({h}) NOT IN ('PNT', 'ALL', '') THEN {h} END"""


@query("notice_chains", f"WITH RECURSIVE {NOTICES}, {CHAINS} SELECT id, root FROM walk")
def notice_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outages.chain_roots(outages.notice_links(notices(spark, sf_dir)))


OUTAGE_EVENTS = f"""WITH RECURSIVE {NOTICES}, {CHAINS}, m AS (SELECT n.*, w.root, row_number() OVER (PARTITION BY w.root ORDER BY published_at, notice_id) AS i,
      row_number() OVER (PARTITION BY w.root ORDER BY published_at DESC, notice_id DESC) AS j FROM notices AS n JOIN walk AS w ON n.notice_id = w.id),
    g AS (SELECT root, arg_min(svn, i) FILTER (WHERE svn IS NOT NULL) AS svn0, arg_min(vehicle, i) FILTER (WHERE vehicle IS NOT NULL) AS veh,
      arg_min(prn, i) FILTER (WHERE prn IS NOT NULL) AS prn, min(effective_at) AS eff, max(expires_at) AS fin,
      string_agg(notice_id, ',' ORDER BY i) AS source_notice_ids FROM m GROUP BY ALL)
    SELECT 'qzs:' || format('{{:03d}}', CAST(coalesce(svn0, veh, 0) AS BIGINT)) || ':' || strftime(h.published_at, '%Y%m%d') || ':' || split_part(h.notice_id, ' ', 2) AS event_id,
      h.constellation, CAST(coalesce(svn0, veh, 0) AS BIGINT) AS svn, CAST(g.prn AS BIGINT) AS prn, CAST(NULL AS VARCHAR) AS block,
      strftime(coalesce(eff, h.published_at), '%Y-%m-%d %H:%M:%S') AS start_at, strftime(fin, '%Y-%m-%d %H:%M:%S') AS end_at,
      {_TYPE.format(t="h.notice_type")} AS event_type, {_SEVERITY.format(t="t.notice_type", s="t.signals")} AS severity,
      {_AFFECTED.format(s="t.signals", h="t.hint")} AS affected_signals, coalesce(t.condition, t.subject) AS reason,
      strftime(h.published_at, '%Y-%m-%d %H:%M:%S') AS first_published_at, strftime(t.published_at, '%Y-%m-%d %H:%M:%S') AS last_updated_at,
      (fin IS NULL OR t.expires_at IS NULL) AS is_active_at_publish, source_notice_ids
    FROM g JOIN m AS h ON h.root = g.root AND h.i = 1 JOIN m AS t ON t.root = g.root AND t.j = 1"""


@query("outage_events", OUTAGE_EVENTS)
def outage_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        outages.normalise(notices(spark, sf_dir))
        .withColumn("affected_signals", F.array_join("affected_signals", "|"))
        .withColumn("source_notice_ids", F.array_join("source_notice_ids", ","))
    )


@query(
    "classify_notices",
    f"""SELECT doc_id, {_TYPE.format(t="l")} AS event_type, {_SEVERITY.format(t="l", s="s")} AS severity, {_AFFECTED.format(s="s", h="h")} AS affected_signals
    FROM (SELECT doc_id, upper(source) || ' ' || substr(text, 1, length(text)) AS l, CASE doc_id % 4 WHEN 0 THEN 'ALL' WHEN 1 THEN ' e1,E5a ' WHEN 2 THEN ' ' END AS s,
      CASE doc_id % 3 WHEN 0 THEN 'L1S' WHEN 1 THEN 'pnt' END AS h FROM documents) AS d""",
)
def classify_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole text of a document stands for the type label."""
    label = F.concat(F.upper("source"), F.lit(" "), "text")
    doc = F.col("doc_id")
    signals = F.when(doc % 4 == 0, "ALL").when(doc % 4 == 1, " e1,E5a ").when(doc % 4 == 2, " ")
    hint = F.when(doc % 3 == 0, "L1S").when(doc % 3 == 1, "pnt")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        fn.event_type(label).alias("event_type"),
        fn.severity(label, signals).alias("severity"),
        F.array_join(fn.affected_signals(signals, hint), "|").alias("affected_signals"),
    )


@query(
    "latest_notices",
    tidy_sql(
        f"""WITH {NOTICES}, twice AS (SELECT notice_id, published_at AS fetched_at, notice_type FROM notices
          UNION ALL SELECT notice_id, published_at - INTERVAL 1 DAY, 'OLD' FROM notices)
        SELECT notice_id, arg_max(notice_type, fetched_at) AS notice_type, max(fetched_at) AS fetched_at FROM twice GROUP BY ALL""",
        time=["fetched_at"],
    ),
)
def latest_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = notices(spark, sf_dir).select("notice_id", "fetched_at", "notice_type")
    old = now.select("notice_id", (F.col("fetched_at") - F.expr("INTERVAL 1 DAY")).alias("fetched_at"), F.lit("OLD").alias("notice_type"))
    return outages.latest_notices(now.unionByName(old))


@query(
    "raw_notice_partitions",
    f"WITH {NOTICES} SELECT constellation, strftime(published_at, '%Y-%m') AS ym, count(*) AS n_rows FROM notices GROUP BY ALL",
)
def raw_notice_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the sink reports of its partitions."""
    return sinks.write_raw_notices(notices(spark, sf_dir), landing(spark, "raw-notices"))


@query(
    "raw_notices_replaced",
    f"WITH {NOTICES} SELECT constellation, strftime(published_at, '%Y-%m') AS ym, notice_id, notice_type FROM notices",
)
def raw_notices_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written twice, as by a run that is repeated, and read back."""
    path = landing(spark, "raw-notices")
    for _ in range(2):
        sinks.write_raw_notices(notices(spark, sf_dir), path)
    stored = spark.read.option("basePath", path).schema("notice_id string, notice_type string, constellation string, ym string")
    return stored.parquet(path).select("constellation", "ym", "notice_id", "notice_type")
