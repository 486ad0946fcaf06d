"""Notice chains and the outage event each chain describes."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fixwatch.functions.notices import (
    affected_signals,
    canonical_notice_id,
    event_id,
    event_type,
    severity,
)
from fixwatch.operators.guards import cut_lineage


def latest_notices(raw: DataFrame, order: str = "fetched_at") -> DataFrame:
    """One row per notice_id, the one fetched last."""
    rest = [c for c in raw.columns if c != "notice_id"]
    plain = [f.name for f in raw.schema.fields if f.name in rest and "map" not in f.dataType.simpleString()]
    newest = F.max_by(F.struct(*rest), F.struct(order, *plain)).alias("n")
    return raw.groupBy("notice_id").agg(newest).select("notice_id", "n.*")


def notice_links(notices: DataFrame) -> DataFrame:
    """(id, parent): parent is the referenced notice where it is present, else NULL."""
    edges = notices.select(
        F.col("notice_id").alias("id"),
        F.when(
            F.col("extras.reference_id") != "",
            canonical_notice_id(F.col("constellation"), F.col("extras.reference_id")),
        ).alias("wanted"),
    )
    present = notices.select(F.col("notice_id").alias("parent"))
    return edges.join(present, F.col("wanted") == F.col("parent"), "left").select("id", "parent")


def _jump(state: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Double the hop of every open row until all are closed or every row has passed the
    whole length of the longest possible path. Returns (closed, still open)."""
    rounds = math.ceil(math.log2(max(state.count(), 2))) + 1
    state = cut_lineage(state)
    for _ in range(rounds):
        open_rows = state.where(~F.col("done"))
        if open_rows.isEmpty():
            break
        # Closed rows no longer take part, so a frequent root is looked up only once by
        # the rows that have just reached it; the adaptive skew join splits those.
        step = state.select(F.col("id").alias("at"), F.col("ptr").alias("next"), F.col("done").alias("closed"))
        moved = open_rows.join(step, F.col("ptr") == F.col("at")).select(
            "id", F.col("next").alias("ptr"), F.col("closed").alias("done")
        )
        state = cut_lineage(state.where("done").unionByName(moved))
    return state.where("done"), state.where(~F.col("done"))


def chain_roots(links: DataFrame) -> DataFrame:
    """(id, root) for a table of (id, parent), by pointer jumping: the number of joins is
    the logarithm of the deepest chain.

    Members of a reference cycle are their own roots, and a notice that leads into a cycle
    gets the member at which it enters. After enough doublings the pointers of the open
    rows are exactly the cycle members; with those as roots the rest closes as well.
    """
    start = links.select(
        "id", F.coalesce("parent", F.col("id")).alias("ptr"), F.col("parent").isNull().alias("done")
    )
    closed, open_rows = _jump(start)
    if not open_rows.isEmpty():
        on_cycle = cut_lineage(open_rows.select(F.col("ptr").alias("id")).distinct())
        again = (
            links.join(open_rows.select("id"), "id", "left_semi")
            .join(on_cycle.withColumn("cyclic", F.lit(True)), "id", "left")
            .select(
                "id",
                F.when(F.col("cyclic"), F.col("id")).otherwise(F.col("parent")).alias("ptr"),
                F.coalesce("cyclic", F.lit(False)).alias("done"),
            )
        )
        resolved, _ = _jump(again)
        closed = closed.unionByName(resolved)
    return closed.select("id", F.col("ptr").alias("root"))


def chain_members(notices: DataFrame, roots: DataFrame) -> DataFrame:
    """Notices with the root of their chain; the long form of the membership."""
    return notices.join(roots.withColumnRenamed("id", "notice_id"), "notice_id")


def _first_known(value: Column, order: Column) -> Column:
    return F.min_by(value, F.when(value.isNotNull(), order))


def outage_events(members: DataFrame) -> DataFrame:
    """One row per chain. Everything is a min/max-by aggregate, so a long chain is combined
    before the shuffle and never collected."""
    order = F.struct("published_at", "notice_id")
    head = F.min_by(F.struct("notice_id", "constellation", "notice_type", "published_at"), order)
    tail = F.max_by(F.struct("notice_type", "published_at", "expires_at", "extras"), order)
    chains = members.groupBy("root").agg(
        head.alias("head"),
        tail.alias("tail"),
        _first_known(F.col("svn"), order).alias("svn"),
        _first_known(F.col("extras.space_vehicle_id"), order).alias("vehicle"),
        _first_known(F.col("prn"), order).alias("prn"),
        F.min("effective_at").alias("first_effective"),
        F.max("expires_at").alias("end_at"),
        F.count(F.lit(1)).alias("n_notices"),
    )
    svn = F.coalesce("svn", "vehicle", F.lit(0)).cast("int")
    reason = F.coalesce(
        *[F.nullif(F.col(f"tail.extras.{c}"), F.lit("")) for c in ("event_description", "condition", "subject")]
    )
    return chains.select(
        "root",
        event_id(F.col("head.constellation"), svn, F.col("head.published_at"), F.col("head.notice_id")).alias("event_id"),
        F.col("head.constellation").alias("constellation"),
        svn.alias("svn"),
        F.col("prn").cast("int").alias("prn"),
        F.lit(None).cast("string").alias("block"),
        F.coalesce("first_effective", "head.published_at").alias("start_at"),
        "end_at",
        event_type(F.col("head.notice_type")).alias("event_type"),
        severity(F.col("tail.notice_type"), F.col("tail.extras.signals_affected")).alias("severity"),
        affected_signals(F.col("tail.extras.signals_affected"), F.col("tail.extras.naq_ss_signal")).alias(
            "affected_signals"
        ),
        reason.alias("reason"),
        "n_notices",
        F.col("head.published_at").alias("first_published_at"),
        F.col("tail.published_at").alias("last_updated_at"),
        (F.col("end_at").isNull() | F.col("tail.expires_at").isNull()).alias("is_active_at_publish"),
    )


def event_members(events: DataFrame, members: DataFrame) -> DataFrame:
    """(event_id, notice_id, published_at): the membership of every chain, whatever its
    length, one row per notice. The order of a chain is (published_at, notice_id)."""
    return members.select("root", "notice_id", "published_at").join(events.select("root", "event_id"), "root").drop("root")


def with_member_ids(events: DataFrame, members: DataFrame) -> DataFrame:
    """Adds `source_notice_ids`, every member of the chain in published order. The list is
    one value of a published row; `event_members` holds the same without lists."""
    listed = (
        members.groupBy("root")
        .agg(F.sort_array(F.collect_list(F.struct("published_at", "notice_id"))).alias("m"))
        .select("root", F.col("m.notice_id").alias("source_notice_ids"))
    )
    return events.join(listed, "root", "left")


def events_and_members(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Raw notices to ordered outage events and their membership in long form."""
    notices = cut_lineage(latest_notices(raw))
    members = cut_lineage(chain_members(notices, chain_roots(notice_links(notices))))
    events = outage_events(members)
    ordered = with_member_ids(events, members).drop("root", "n_notices").orderBy("first_published_at", "constellation", "svn")
    return ordered, event_members(events, members)


def normalise(raw: DataFrame) -> DataFrame:
    """Raw notices to ordered outage events."""
    return events_and_members(raw)[0]
