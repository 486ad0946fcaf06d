"""Sweeps over intervals: union, common spans, stabbing, and carrying values forward.

Places on a line (seconds, days) are longs; intervals are half-open, and one without an end
is still open. Every running value is taken at two levels: inside blocks of the line, which
hold at most `block` different places, and over one row per block. No window holds the
whole line of a key, and rows at one place are added up before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fixwatch.operators.guards import cut_lineage

DAY = 86_400
# An interval at most this many buckets long belongs to a level of buckets; the next level's
# buckets are that much wider.
FAN_OUT = 8
OPEN_LEVEL = -1


def _block(at: str, block: int) -> Column:
    return F.floor(F.col(at) / F.lit(block))


def running_total(changes: DataFrame, keys: Sequence[str], block: int = DAY) -> DataFrame:
    """`changes` (keys, at, delta; one row per place) with `total`, the sum up to the place."""
    keys = list(keys)
    dealt = changes.withColumn("block", _block("at", block))
    inside = Window.partitionBy(*keys, "block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*keys).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = dealt.groupBy(*keys, "block").agg(F.sum("delta").alias("in_block"))
    carried = blocks.select(*keys, "block", F.coalesce(F.sum("in_block").over(before), F.lit(0)).alias("carried"))
    inner = dealt.withColumn("inner", F.sum("delta").over(inside))
    return inner.join(carried, [*keys, "block"]).withColumn("total", F.col("inner") + F.col("carried")).drop("inner", "carried", "block")


def with_next(rows: DataFrame, keys: Sequence[str], block: int = DAY) -> DataFrame:
    """`rows` (keys, at; one row per place) with `next_at`, the place of the following row."""
    keys = list(keys)
    dealt = rows.withColumn("block", _block("at", block))
    firsts = dealt.groupBy(*keys, "block").agg(F.min("at").alias("first_at"))
    later = firsts.select(*keys, "block", F.lead("first_at").over(Window.partitionBy(*keys).orderBy("block")).alias("later"))
    inner = dealt.withColumn("inner", F.lead("at").over(Window.partitionBy(*keys, "block").orderBy("at")))
    return inner.join(later, [*keys, "block"]).withColumn("next_at", F.coalesce("inner", "later")).drop("inner", "later", "block")


def carry_last(rows: DataFrame, keys: Sequence[str], block: int = DAY) -> DataFrame:
    """`rows` (keys, at, mark) with `last_mark`, the largest mark at or before the place of
    the row. Marks are places themselves, so the largest is the last."""
    keys = list(keys)
    dealt = rows.withColumn("block", _block("at", block))
    # Peers of a place share their marks, whatever their order.
    inside = Window.partitionBy(*keys, "block").orderBy("at").rangeBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*keys).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = dealt.groupBy(*keys, "block").agg(F.max("mark").alias("in_block"))
    carried = blocks.select(*keys, "block", F.max("in_block").over(before).alias("carried"))
    inner = dealt.withColumn("inner", F.max("mark").over(inside))
    return inner.join(carried, [*keys, "block"]).withColumn("last_mark", F.coalesce("inner", "carried")).drop("inner", "carried", "block")


def largest_so_far(rows: DataFrame, keys: Sequence[str], marks: Sequence[str], block: int = DAY) -> DataFrame:
    """`rows` (keys, at, marks; one row per place) where each of `marks` is its largest value
    at or before the place, NULL where there is none yet. Rows without key or place stay."""
    keys = list(keys)
    dealt = rows.withColumn("block", _block("at", block))
    inside = Window.partitionBy(*keys, "block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*keys).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = dealt.groupBy(*keys, "block").agg(*[F.max(m).alias(f"{m}_in_block") for m in marks])
    carried = blocks.select(*keys, "block", *[F.max(f"{m}_in_block").over(before).alias(f"{m}_carried") for m in marks])
    inner = dealt.withColumns({m: F.max(m).over(inside) for m in marks})
    joined = inner.join(carried, [*keys, "block"], "left")
    return joined.withColumns({m: F.greatest(m, f"{m}_carried") for m in marks}).drop("block", *[f"{m}_carried" for m in marks])


def _changes(intervals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, at, delta) of intervals (keys, start, end), summed per place. Intervals without
    a start, and those that end where or before they start, are none."""
    ends = F.array(
        F.struct(F.col("start").cast("long").alias("at"), F.lit(1).cast("long").alias("delta")),
        F.struct(F.col("end").cast("long").alias("at"), F.lit(-1).cast("long").alias("delta")),
    )
    held = intervals.where(F.col("start").isNotNull() & (F.col("end").isNull() | (F.col("end") > F.col("start"))))
    events = held.select(*keys, F.explode(ends).alias("e")).select(*keys, "e.*").where(F.col("at").isNotNull())
    return events.groupBy(*keys, "at").agg(F.sum("delta").alias("delta")).where(F.col("delta") != 0)


def spans_at_least(changes: DataFrame, keys: Sequence[str], least: Column, block: int = DAY) -> DataFrame:
    """(keys, start, end) of the longest spans in which the running total of `changes` is at
    least `least`; the end is NULL where the total never falls below it again."""
    totals = running_total(changes, keys, block)
    on, was = F.col("total") >= least, F.col("total") - F.col("delta") >= least
    edges = cut_lineage(totals.select(*keys, "at", on.alias("on"), was.alias("was")).where(F.col("on") != F.col("was")).drop("was"))
    return with_next(edges, keys, block).where("on").select(*keys, F.col("at").alias("start"), F.col("next_at").alias("end"))


def union_of(intervals: DataFrame, keys: Sequence[str], block: int = DAY) -> DataFrame:
    """(keys, start, end): the intervals of each key merged where they overlap or touch."""
    return spans_at_least(_changes(intervals, keys), keys, F.lit(1), block)


def all_out(outages: DataFrame, members: DataFrame, block: int = DAY) -> DataFrame:
    """(set_id, start, end): the spans in which every member of a set is out.

    `outages` is (member, start, end), `members` (set_id, member). Overlapping and touching
    outages of a member count once; a member without outages keeps its sets available. The
    running total of a set moves by one when a member's merged outage begins or ends, and
    the service is down while it equals the size of the set."""
    known = members.select("set_id", "member").where(F.col("set_id").isNotNull() & F.col("member").isNotNull()).distinct()
    sizes = known.groupBy("set_id").agg(F.count(F.lit(1)).alias("size"))
    merged = union_of(outages.select("member", "start", "end").where(F.col("member").isNotNull()), ["member"], block)
    of_sets = merged.join(known.join(sizes, "set_id"), "member").select("set_id", "size", "start", "end")
    return spans_at_least(_changes(of_sets, ["set_id", "size"]), ["set_id", "size"], F.col("size"), block).drop("size")


def _bucket(at: Column, level: Column | int, base: int) -> Column:
    width = F.lit(base) * F.pow(F.lit(FAN_OUT), F.lit(level) if isinstance(level, int) else level)
    return F.floor(at / width)


def stab(questions: DataFrame, spans: DataFrame, keys: Sequence[str], base: int = DAY) -> DataFrame:
    """Distinct (keys, at) of `questions` with `start` and `end` of the span that holds it, or
    NULLs. `spans` (keys, start, end) of a key do not overlap.

    A span lies in buckets of a width like its length, at most FAN_OUT + 1 of them, so a
    question meets it by an equi-join on (key, level, bucket) and an exact check of the few
    spans there; an open span of a key (there is one at most) has a bucket of its own. One
    join, one aggregate, and no range condition over all spans of a key."""
    keys = list(keys)
    length = F.col("end") - F.col("start")
    level = F.when(F.col("end").isNull(), F.lit(OPEN_LEVEL)).otherwise(
        F.greatest(F.lit(0), F.ceil(F.log(float(FAN_OUT), length / base)) - 1).cast("int")
    )
    leveled = cut_lineage(spans.where(F.col("end").isNull() | (F.col("end") > F.col("start"))).select(*keys, "start", "end", level.alias("level")))
    # One row per level of length, a handful whatever the table.
    levels = sorted(r["level"] for r in leveled.select("level").distinct().toLocalIterator())
    buckets = F.when(F.col("level") == OPEN_LEVEL, F.array(F.lit(0).cast("long"))).otherwise(
        F.sequence(_bucket(F.col("start"), F.col("level"), base), _bucket(F.col("end") - 1, F.col("level"), base))
    )
    placed = leveled.withColumn("bucket", F.explode(buckets))
    asked = questions.select(*keys, F.col("at").cast("long").alias("at")).distinct()
    if not levels:
        return asked.withColumns({"start": F.lit(None).cast("long"), "end": F.lit(None).cast("long")})
    probes = F.array(
        *[F.struct(F.lit(n).alias("level"), (F.lit(0).cast("long") if n == OPEN_LEVEL else _bucket(F.col("at"), n, base)).alias("bucket")) for n in levels]
    )
    probed = asked.withColumn("p", F.explode(probes)).select(*keys, "at", "p.level", "p.bucket")
    q, s = probed.alias("q"), placed.alias("s")
    same = [F.col(f"q.{c}") == F.col(f"s.{c}") for c in (*keys, "level", "bucket")]
    inside = (F.col("s.start") <= F.col("q.at")) & (F.col("s.end").isNull() | (F.col("q.at") < F.col("s.end")))
    met = q.join(s, [*same, inside], "left").select(*[F.col(f"q.{c}").alias(c) for c in (*keys, "at")], F.col("s.start").alias("start"), F.col("s.end").alias("end"))
    found = met.groupBy(*keys, "at").agg(F.max(F.struct("start", "end")).alias("span"))
    return found.select(*keys, "at", "span.start", "span.end")


def health_at(questions: DataFrame, outages: DataFrame, base: int = DAY) -> DataFrame:
    """Was each (member, at) of `questions` healthy: no outage holds the instant. With the
    merged outage that does, `out_since` and `out_until` (NULL while it is open)."""
    merged = union_of(outages.select("member", "start", "end").where(F.col("member").isNotNull()), ["member"], base)
    found = stab(questions, merged, ["member"], base)
    return found.select("member", "at", F.col("start").isNull().alias("healthy"), F.col("start").alias("out_since"), F.col("end").alias("out_until"))
