"""Outage events of arriving notices: only the chains that a batch touches are made anew."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fixwatch.functions.notices import canonical_notice_id
from fixwatch.operators.guards import cut_lineage
from fixwatch.operators.outages import chain_members, chain_roots, latest_notices, notice_links, outage_events, with_member_ids
from fixwatch.streaming.versions import bucket_of, latest, write_buckets

BUCKETS = 64


def _touched(chains: DataFrame, incoming: DataFrame) -> DataFrame:
    """Roots of the chains that hold an arriving notice or one it refers to, or that wait for
    it. Three narrow columns of the stored notices are read."""
    ids = incoming.select(F.col("notice_id").alias("key"))
    near = ids.unionByName(incoming.select(F.col("wanted").alias("key"))).where("key IS NOT NULL").distinct()
    known = chains.select("notice_id", "wanted", "root")
    holds = known.join(near, F.col("notice_id") == F.col("key"), "left_semi")
    waits = known.join(ids.distinct(), F.col("wanted") == F.col("key"), "left_semi")
    return holds.unionByName(waits).select("root").distinct()


def stream_chains(notices: DataFrame, checkpoint: str, out: str, *, buckets: int = BUCKETS) -> StreamingQuery:
    """Keep the versions of all notices with the root of their chain in `out`/chains and the
    events of the chains in `out`/events, both in buckets of the root.

    A batch finds the chains it touches, takes their notices out, adds its own, and settles
    this part again: chains merge where a missing link arrives and split where a correction
    refers elsewhere. Every notice that a member refers to is in its chain, missing, or in the
    batch, so nothing else can change. Only buckets of roots old and new are written."""

    def apply(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        reference = F.when(F.col("extras.reference_id") != "", canonical_notice_id(F.col("constellation"), F.col("extras.reference_id")))
        incoming = batch.withColumn("wanted", reference).persist()
        chains, events = (latest(spark, f"{out}/{t}", number) for t in ("chains", "events"))
        rows, old = incoming, None
        if chains is not None:
            old = cut_lineage(_touched(chains, incoming))
            rows = chains.join(old, "root", "left_semi").drop("root", "bucket").unionByName(incoming)
        rows = cut_lineage(rows.distinct())
        current = cut_lineage(latest_notices(rows.drop("wanted")))
        roots = cut_lineage(chain_roots(notice_links(current)))
        members = chain_members(current, roots)
        made = outage_events(members)
        made = with_member_ids(made, members).withColumn("bucket", bucket_of("root", buckets))
        stored = rows.join(roots.withColumnRenamed("id", "notice_id"), "notice_id").withColumn("bucket", bucket_of("root", buckets))
        changed = roots.select("root").distinct()
        if old is not None:
            changed = changed.unionByName(old).distinct()
        changed = cut_lineage(changed.withColumn("bucket", bucket_of("root", buckets)))
        touched = changed.select("bucket").distinct()
        for table, new, before in (("chains", stored, chains), ("events", made, events)):
            if before is not None:
                rest = before.join(touched, "bucket", "left_semi").join(changed, "root", "left_anti")
                new = new.unionByName(rest.select(new.columns))
            write_buckets(new, touched, f"{out}/{table}", number)
        incoming.unpersist()

    return notices.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(apply).start()


def current_events(spark: SparkSession, out: str) -> DataFrame:
    """The events as they are now."""
    return latest(spark, f"{out}/events").drop("bucket", "root", "n_notices")
