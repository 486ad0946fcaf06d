"""Exact order statistics that never sort or hash a whole group in one task.

Holding the values of a group, as a sorted array or in the map of Spark's `percentile`, is
right for groups of bounded size (a station-day), and cannot work for a group that holds a
large share of the data (a national month, a pooled threshold cell). For those the rank is
narrowed in counting passes over an order-preserving code, a logarithmic slice:

1. rows are counted per (group, coarse code) with map-side combine, a table of at most
   some 35,000 rows per group whatever the group's size, and running sums say which
   coarse code (a slice 1% wide) holds each wanted rank;
2. where such a slice alone exceeds a task, rows with a wanted coarse code are counted
   per fine code (2.4e-6 wide) in the same way;
3. rows with a wanted code are counted per distinct value, and the running sum inside
   that one code gives the value itself.

Groups may overlap: `expand` turns a counting table keyed by disjoint keys into one
keyed by overlapping cells, so that the overlap multiplies counts, not rows; in the later
passes a count meets only those of its cells that want its code.

Both paths take the same values: NULL and NaN are missing, infinities are the outermost
values of their side.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fixwatch.functions.labels import nan_to_null
from fixwatch.operators.guards import BROADCAST_ROWS, at_most, broadcast_if_small, cut_lineage

# One task holds at most this many values of a group on the direct path (a station has some
# 90,000 a month).
MAX_GROUP_ROWS = 250_000

# Slices per factor e, and the bits by which a code is shortened to a coarse code.
_SLICES = 409_600
_COARSE_BITS = 12
_OFFSET = 500_000_000
# Beyond the code of the largest finite double.
_INFINITE = 1 << 30

RankOf = Callable[[Column], Column]
Expand = Callable[[DataFrame], DataFrame]


def order_code(value: Column) -> Column:
    """Monotone map of a double to a long; equal codes mean nearly equal values."""
    size = F.abs(value)
    finite = (F.floor(F.ln(F.when(size < F.lit(float("inf")), size)) * _SLICES) + _OFFSET).cast("long")
    magnitude = F.coalesce(finite, F.lit(_INFINITE).cast("long"))
    return (
        F.when(value > 0, magnitude).when(value < 0, -magnitude).when(value == 0, F.lit(0).cast("long"))
    )


def measured(column: str) -> Column:
    """A value column as a double, NULL for NaN."""
    return nan_to_null(F.col(column).cast("double"))


def between(lo: Column, hi: Column, share: Column) -> Column:
    """The point at `share` of the way from lo to hi, also where one of them is infinite;
    NULL half way between both infinities."""
    weighted = nan_to_null(lo * (1 - share) + hi * share)
    return F.when((lo == hi) | (share == 0), lo).when(lo == F.lit(float("-inf")), weighted).otherwise(lo + (hi - lo) * share)


def linear_ranks(probs: Mapping[str, float]) -> dict[str, RankOf]:
    """Lower and upper neighbour of each interpolated percentile."""
    ranks: dict[str, RankOf] = {}
    for label, p in probs.items():
        ranks[f"{label}.lo"] = lambda n, p=p: F.floor((n - 1) * F.lit(p)).cast("long")
        ranks[f"{label}.hi"] = lambda n, p=p: F.ceil((n - 1) * F.lit(p)).cast("long")
    return ranks


def index_rank(p: float, *, descending: Column | None = None) -> RankOf:
    """Element int(n*p) of the sorted group, counted from the other end where `descending`."""

    def rank(n: Column) -> Column:
        index = F.least(F.floor(n * F.lit(p)).cast("long"), n - 1)
        return index if descending is None else F.when(descending, n - 1 - index).otherwise(index)

    return rank


def _match(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join in which NULL keys meet; the right side's keys are dropped."""
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    condition = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    joined = left.join(renamed, condition, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_r_{k}" for k in keys])


def _before(within: Sequence[str], order: str) -> Column:
    window = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("n").over(window), F.lit(0))


def _holds(rank: Column) -> Column:
    return (rank >= F.col("before")) & (rank < F.col("before") + F.col("n"))


def _wanted_here(counts: DataFrame, within: Sequence[str], order: str) -> DataFrame:
    """Keep the rows of a counting table that contain a wanted rank; the rank becomes
    relative to the row."""
    held = counts.withColumn("before", _before(within, order)).where(F.exists("want", lambda w: _holds(w["rank"])))
    return _relative(held)


def _relative(held: DataFrame) -> DataFrame:
    return held.withColumn(
        "want",
        F.transform(
            F.filter("want", lambda w: _holds(w["rank"])),
            lambda w: F.struct(w["label"].alias("label"), (w["rank"] - F.col("before")).alias("rank")),
        ),
    )


def _want(ranks: Mapping[str, RankOf], total: Column) -> Column:
    return F.array(
        *[F.struct(F.lit(label).alias("label"), rank(total).cast("long").alias("rank")) for label, rank in ranks.items()]
    )


def _coded(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    return (
        rows.select(*keys, measured(value).alias("v"))
        .where(F.col("v").isNotNull())
        .withColumn("code", order_code(F.col("v")))
        .withColumn("coarse", F.shiftright("code", _COARSE_BITS))
    )


def _count(df: DataFrame, by: Sequence[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def _tally(df: DataFrame, by: Sequence[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.sum("n").alias("n"))


def _coarse_picks(counts: DataFrame, out: Sequence[str], ranks: Mapping[str, RankOf]) -> DataFrame:
    """Which coarse code holds each rank. Most rows hold none, so they are dropped by plain
    comparisons before any array is built."""
    placed = counts.withColumn("total", F.sum("n").over(Window.partitionBy(*out))).withColumn(
        "before", _before(out, "coarse")
    )
    hits = [_holds(rank(F.col("total"))) for rank in ranks.values()]
    held = placed.where(reduce(lambda a, b: a | b, hits)).withColumn("want", _want(ranks, F.col("total")))
    return cut_lineage(_relative(held).select(*out, "coarse", "total", "want", "n"))


def _values_found(values: DataFrame, picks: DataFrame, out: Sequence[str], level: str) -> DataFrame:
    wanted = _match(values, picks.select(*out, level, "total", "want"), [*out, level], "inner")
    return (
        _wanted_here(wanted, [*out, level], "v")
        .select(*out, "total", F.explode("want").alias("w"), "v")
        .select(*out, "total", F.col("w.label").alias("label"), F.col("v").alias("value"))
    )


def _fine_picks(fine: DataFrame, picks: DataFrame, out: Sequence[str]) -> DataFrame:
    matched = _match(fine, picks.drop("n"), [*out, "coarse"], "inner")
    return cut_lineage(_wanted_here(matched, [*out, "coarse"], "code").select(*out, "code", "total", "want"))


def select_ranks(
    rows: DataFrame,
    keys: Sequence[str],
    value: str,
    ranks: Mapping[str, RankOf],
    *,
    max_code_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """(keys, total, label, value): the element at each rank, by counting passes."""
    out, level = list(keys), "coarse"
    coded = _coded(rows, out, value)
    picks = _coarse_picks(_count(coded, [*out, "coarse"]), out, ranks)

    def narrowed() -> DataFrame:
        return _match(coded, broadcast_if_small(picks.select(*out, level)), [*out, level], "left_semi")

    coded = narrowed()
    # Only where one coarse code alone is too much for a task.
    if not at_most(picks.where(F.col("n") > max_code_rows), 0):
        picks = _fine_picks(_count(coded, [*out, "coarse", "code"]), picks, out)
        level = "code"
        coded = narrowed()
    return _values_found(_count(coded, [*out, level, "v"]), picks, out, level)


def select_ranks_in_cells(
    rows: DataFrame,
    keys: Sequence[str],
    value: str,
    ranks: Mapping[str, RankOf],
    *,
    expand: Expand,
    out_keys: Sequence[str],
    max_code_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """As `select_ranks` over overlapping cells. `expand` maps a table of disjoint groups
    to the cells each belongs to. Groups and cells get short ids, so that shuffles carry two
    numbers in place of all keys, and a count is paired only with cells that want its code.
    """
    coded = _coded(rows, keys, value)
    first = cut_lineage(_count(coded, [*keys, "coarse"]))
    # Checkpointed, so the ids stay what they are.
    groups = cut_lineage(first.select(*keys).distinct().withColumn("_g", F.monotonically_increasing_id()))
    spread = expand(groups)
    cells = cut_lineage(spread.select(*out_keys).distinct().withColumn("_c", F.monotonically_increasing_id()))
    members = cut_lineage(_match(spread, cells, out_keys, "inner").select("_g", "_c"))
    small_groups, small_members = broadcast_if_small(groups), broadcast_if_small(members)

    own = _match(first, small_groups, keys, "inner").select("_g", "coarse", "n")
    picks = _coarse_picks(_tally(own.join(small_members, "_g"), ["_c", "coarse"]), ["_c"], ranks)
    coded = _match(coded, small_groups, keys, "inner").select("_g", "coarse", "code", "v")

    def narrowed(level: str) -> tuple[DataFrame, DataFrame]:
        """Rows with a code some cell of theirs wants, and (_g, level, _c) for who wants it."""
        wanting = cut_lineage(picks.select("_c", level).join(small_members, "_c"))
        codes = broadcast_if_small(wanting.select("_g", level).distinct())
        return coded.join(codes, ["_g", level], "left_semi"), wanting

    def by_cell(counts: DataFrame, wanting: DataFrame, by: Sequence[str]) -> DataFrame:
        return _tally(counts.join(broadcast_if_small(wanting), ["_g", by[0]]), ["_c", *by])

    level = "coarse"
    coded, wanting = narrowed("coarse")
    if not at_most(picks.where(F.col("n") > max_code_rows), 0):
        fine = by_cell(_count(coded, ["_g", "coarse", "code"]), wanting, ["coarse", "code"])
        picks = _fine_picks(fine, picks, ["_c"])
        level = "code"
        coded, wanting = narrowed("code")
    values = by_cell(_count(coded, ["_g", level, "v"]), wanting, [level, "v"])
    found = _values_found(values, picks, ["_c"], level)
    return found.join(broadcast_if_small(cells), "_c").drop("_c")


def _direct_ranks(rows: DataFrame, keys: Sequence[str], value: str, ranks: Mapping[str, RankOf]) -> DataFrame:
    """As `select_ranks` for groups known to be small: one sort inside each group."""
    group = Window.partitionBy(*keys)
    return (
        rows.select(*keys, measured(value).alias("value"))
        .where(F.col("value").isNotNull())
        .withColumn("at", F.row_number().over(group.orderBy("value")) - 1)
        .withColumn("total", F.count(F.lit(1)).over(group))
        .withColumn("want", F.filter(_want(ranks, F.col("total")), lambda w: w["rank"] == F.col("at")))
        .where(F.size("want") > 0)
        .select(*keys, "total", F.explode("want.label").alias("label"), "value")
    )


def _split_by_size(
    df: DataFrame, keys: Sequence[str], max_group_rows: int
) -> tuple[DataFrame | None, DataFrame | None]:
    """(rows of small groups, rows of large groups); either may be None."""
    # A plain row count is the cheaper check and settles small inputs.
    if max_group_rows and df.count() <= max_group_rows:
        return df, None
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    large = sizes.where(F.col("n") > max_group_rows).select(*keys)
    if at_most(large, 0):
        return df, None
    if not keys:
        return None, df
    # At most total rows / max_group_rows keys, counted again before any broadcast.
    large = broadcast_if_small(cut_lineage(large), BROADCAST_ROWS)
    return _match(df, large, keys, "left_anti"), _match(df, large, keys, "left_semi")


def pick_ranks(
    rows: DataFrame,
    keys: Sequence[str],
    value: str,
    ranks: Mapping[str, RankOf],
    *,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """(keys, total, label, value), choosing the path by the measured group sizes."""
    small, large = _split_by_size(rows, keys, max_group_rows)
    parts = []
    if small is not None:
        parts.append(_direct_ranks(small, keys, value, ranks))
    if large is not None:
        parts.append(select_ranks(large, keys, value, ranks))
    return reduce(DataFrame.unionByName, parts)


def interpolate(picked: DataFrame, keys: Sequence[str], probs: Mapping[str, float], prefix: str = "") -> DataFrame:
    """Turn the `.lo`/`.hi` neighbours of `linear_ranks` into one column per percentile."""
    columns = []
    for label, p in probs.items():
        lo = F.max(F.when(F.col("label") == f"{label}.lo", F.col("value")))
        hi = F.max(F.when(F.col("label") == f"{label}.hi", F.col("value")))
        at = (F.max("total") - 1) * F.lit(p)
        columns.append(between(lo, hi, at - F.floor(at)).alias(f"{prefix}{label}"))
    return picked.groupBy(*keys).agg(*columns)


def all_groups_small(df: DataFrame, keys: Sequence[str], max_group_rows: int = MAX_GROUP_ROWS) -> bool:
    return _split_by_size(df, keys, max_group_rows)[1] is None


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    values: Mapping[str, str],
    probs: Mapping[str, float],
    *,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """One row per group with `{name}_{label}` for each value column and probability,
    linearly interpolated; NULL where a group has no value."""
    small, large = _split_by_size(df, keys, max_group_rows)
    parts = []
    if small is not None:
        parts.append(direct_quantiles(small, keys, values, probs))
    if large is not None:
        long = large.select(
            *keys,
            F.explode(
                F.array(*[F.struct(F.lit(n).alias("axis"), measured(c).alias("x")) for n, c in values.items()])
            ).alias("s"),
        ).select(*keys, "s.axis", "s.x")
        picked = select_ranks(long, [*keys, "axis"], "x", linear_ranks(probs))
        wide = interpolate(picked, [*keys, "axis"], probs)
        columns = [
            F.max(F.when(F.col("axis") == name, F.col(label))).alias(f"{name}_{label}")
            for name in values
            for label in probs
        ]
        per_group = wide.groupBy(*keys).agg(*columns)
        if keys:
            # A group without any value still has its row.
            per_group = _match(large.select(*keys).distinct(), per_group, keys, "left")
        parts.append(per_group)
    return reduce(DataFrame.unionByName, parts)


def quantile_columns(values: Mapping[str, str]) -> list[Column]:
    """Sorted values per group, for groups of checked or bounded size. Reading several
    percentiles off one sorted array costs less than Spark's value-to-count map."""
    return [F.sort_array(F.collect_list(measured(column))).alias(f"_{name}") for name, column in values.items()]


def unpack_quantiles(df: DataFrame, values: Mapping[str, str], probs: Mapping[str, float]) -> DataFrame:
    kept = [c for c in df.columns if c not in {f"_{name}" for name in values}]
    return df.select(
        *kept,
        *[array_quantile(F.col(f"_{name}"), p).alias(f"{name}_{label}") for name in values for label, p in probs.items()],
    )


def direct_quantiles(
    df: DataFrame, keys: Sequence[str], values: Mapping[str, str], probs: Mapping[str, float]
) -> DataFrame:
    return unpack_quantiles(df.groupBy(*keys).agg(*quantile_columns(values)), values, probs)


def array_quantile(values: Column, p: float) -> Column:
    """Interpolated percentile of a sorted array without NULLs; NULL for an empty one."""
    at = (F.size(values) - 1) * F.lit(p)
    lo, hi = F.get(values, F.floor(at).cast("int")), F.get(values, F.ceil(at).cast("int"))
    return between(lo, hi, at - F.floor(at))


def running_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(keys, value, n, before, total): how many values of the group lie below each
    distinct value. Three levels of running sums keep every window bounded."""
    keyed = list(keys) or ["_all"]
    source = df if keys else df.withColumn("_all", F.lit(0))
    distinct = (
        source.select(*keyed, measured(value).alias("value"))
        .where(F.col("value").isNotNull())
        .groupBy(*keyed, "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("code", order_code(F.col("value")))
        .withColumn("coarse", F.shiftright("code", _COARSE_BITS))
    )

    def before(within: list[str], order: str) -> Column:
        window = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("n").over(window), F.lit(0))

    fine = distinct.groupBy(*keyed, "coarse", "code").agg(F.sum("n").alias("n"))
    coarse = (
        fine.groupBy(*keyed, "coarse")
        .agg(F.sum("n").alias("n"))
        .withColumn("coarse_before", before(keyed, "coarse"))
        .withColumn("total", F.sum("n").over(Window.partitionBy(*keyed)))
        .drop("n")
    )
    offsets = _match(
        fine.withColumn("fine_before", before([*keyed, "coarse"], "code")).drop("n"), coarse, [*keyed, "coarse"], "inner"
    ).drop("coarse")
    ranked = _match(
        distinct.drop("coarse").withColumn("value_before", before([*keyed, "code"], "value")),
        offsets,
        [*keyed, "code"],
        "inner",
    )
    return ranked.select(
        *keys,
        "value",
        "n",
        (F.col("coarse_before") + F.col("fine_before") + F.col("value_before")).alias("before"),
        "total",
    )
