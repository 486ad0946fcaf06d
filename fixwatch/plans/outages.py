"""Landed notices of all constellations to raw and event tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from fixwatch.operators.guards import cut_lineage
from fixwatch.operators.outages import events_and_members
from fixwatch.sinks import write_events, write_raw_notices
from fixwatch.sources.notices import raw_nagu, raw_nanu, raw_naqu, read_naqu_pages, read_rss_items
from fixwatch.sources.text import documents


def read_notices(
    spark: SparkSession, *, nanu: str | None = None, naqu: str | None = None, nagu: str | None = None
) -> DataFrame:
    parts = []
    if nanu:
        parts.append(raw_nanu(documents(spark, nanu)))
    if naqu:
        parts.append(raw_naqu(read_naqu_pages(spark, naqu)))
    if nagu:
        parts.append(raw_nagu(read_rss_items(spark, nagu)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def run_outages(spark: SparkSession, output_root: str, **paths: str) -> DataFrame:
    """Writes raw notices, events and the membership of each event; returns the raw row
    counts per constellation and month. The landed files are parsed once."""
    raw = cut_lineage(read_notices(spark, **paths))
    counts = write_raw_notices(raw, f"{output_root}/raw_notices")
    events, members = events_and_members(raw)
    write_events(events, f"{output_root}/events")
    write_events(members, f"{output_root}/event_members")
    return counts
