import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fixwatch.operators import distributions
from fixwatch.operators import quantiles as q

PROBS = {"p05": 0.05, "p50": 0.5, "p95": 0.95, "p999": 0.999}


@pytest.fixture(scope="module")
def values():
    """A hot group with half of all rows, a group of one value, negatives, zeros, NULL keys."""
    rng = np.random.default_rng(7)
    parts = [
        ("hot", rng.gamma(2.0, 0.05, 4000)),
        ("same", np.full(1500, 0.25)),
        ("mixed", np.concatenate([-rng.gamma(2.0, 3.0, 700), np.zeros(300), rng.gamma(2.0, 1e-6, 700)])),
        ("single", np.array([3.5])),
        ("pair", np.array([1.0, 2.0])),
        (None, rng.normal(0, 1, 300)),
    ]
    frame = pd.concat([pd.DataFrame({"k": k, "x": x}) for k, x in parts], ignore_index=True)
    frame["y"] = np.where(frame["x"] > 0.1, frame["x"] * 1e3, np.nan)
    return frame


@pytest.fixture(scope="module")
def df(spark, values):
    rows = spark.createDataFrame(values.astype({"k": object}).where(values.notna(), None))
    return rows.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in ("x", "y")}).repartition(6).cache()


def expected(values, column):
    out = {}
    for k, g in values.groupby("k", dropna=False):
        x = g[column].dropna().to_numpy()
        out[None if pd.isna(k) else k] = [np.percentile(x, p * 100) if x.size else None for p in PROBS.values()]
    return out


@pytest.mark.parametrize("limit", [0, 1000, 10**6])
def test_quantiles_on_either_path(df, values, limit):
    rows = q.exact_quantiles(df, ["k"], {"x": "x", "y": "y"}, PROBS, max_group_rows=limit).collect()
    assert len(rows) == 6
    for axis in ("x", "y"):
        want = expected(values, axis)
        for r in rows:
            got = [r[f"{axis}_{p}"] for p in PROBS]
            if want[r.k][0] is None:
                assert got == [None] * 4
            else:
                assert got == pytest.approx(want[r.k], rel=1e-12, abs=1e-15)


@pytest.mark.parametrize("limit", [0, 10**6])
def test_quantiles_without_keys(df, values, limit):
    row = q.exact_quantiles(df, [], {"x": "x"}, PROBS, max_group_rows=limit).first()
    assert list(row) == pytest.approx([np.percentile(values["x"], p * 100) for p in PROBS.values()], rel=1e-12)


def test_fine_pass_gives_the_same(df, values):
    picked = q.select_ranks(df, ["k"], "x", q.linear_ranks(PROBS), max_code_rows=5)
    rows = q.interpolate(picked, ["k"], PROBS).collect()
    want = expected(values, "x")
    for r in rows:
        assert [r[p] for p in PROBS] == pytest.approx(want[r.k], rel=1e-12, abs=1e-15)


@pytest.mark.parametrize("limit", [0, 10**6])
def test_index_rank_both_directions(spark, limit):
    df = spark.range(1, 101).select(
        F.explode(F.array(F.lit("up"), F.lit("down"))).alias("k"), (F.col("id") / 100).alias("x")
    )
    rank = q.index_rank(0.9973, descending=F.col("k") == "down")
    got = {r.k: r.value for r in q.pick_ranks(df, ["k"], "x", {"t": rank}, max_group_rows=limit).collect()}
    assert got == {"up": 1.0, "down": 0.01}


def test_order_code_is_monotone(spark):
    x = np.unique(np.concatenate([np.geomspace(1e-300, 1e300, 4001), -np.geomspace(1e-9, 1e9, 999), [0.0]]))
    df = spark.createDataFrame(pd.DataFrame({"x": x})).withColumn("c", q.order_code(F.col("x")))
    codes = df.orderBy("x").toPandas()["c"].to_numpy()
    assert (np.diff(codes) >= 0).all()


def test_running_counts(df, values):
    got = q.running_counts(df, ["k"], "x").toPandas()
    for k, g in got.groupby("k", dropna=False):
        x = np.sort(values[values["k"].isna() if pd.isna(k) else values["k"] == k]["x"].to_numpy())
        g = g.sort_values("value")
        assert g["before"].tolist() == [int(np.searchsorted(x, v)) for v in g["value"]]
        assert set(g["total"]) == {len(x)}


def test_ecdf_keeps_every_row(df, values):
    got = distributions.ecdf(df.where("k = 'mixed'"), "x").toPandas().sort_values("i")
    x = np.sort(values[values["k"] == "mixed"]["x"].to_numpy())
    assert got["value"].tolist() == x.tolist()
    assert got["i"].tolist() == list(range(1, len(x) + 1))
    assert got["share"].iloc[-1] == 1.0


def test_histogram_matches_numpy(spark):
    x = np.random.default_rng(1).normal(10, 3, 5000)
    df = spark.createDataFrame(pd.DataFrame({"x": x}))
    got = distributions.histogram(df, "x").orderBy("bin").toPandas()
    counts, edges = np.histogram(x, bins=40)
    assert got["n"].sum() == 5000 and len(got) == 40
    assert np.abs(got["n"].to_numpy() - counts).sum() <= 2
    assert got["lower"].tolist() == pytest.approx(edges[:-1].tolist())


def test_histogram_of_one_value(spark):
    got = distributions.histogram(spark.range(3).select(F.lit(2.0).alias("x")), "x").orderBy("bin").collect()
    assert got[20].n == 3 and got[0].lower == 1.5 and got[39].upper == 2.5


def test_log_histogram(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 0.5, 1.0, 10.0, 100.0, 1000.0)], "x double")
    got = distributions.log_histogram(df, "x").orderBy("bin").collect()
    assert len(got) == 39 and sum(r.n for r in got) == 4
    assert got[0].n == 1 and got[38].n == 1
    assert got[38].upper == pytest.approx(1000.0)


@pytest.fixture(scope="module")
def strange(spark):
    inf, nan = float("inf"), float("nan")
    groups = {
        "nan": [0.1, 0.2, 0.3, 2.0, 3.0, nan],
        "top": [1.0, 2.0, inf, inf],
        "both": [-inf, 1.0, 2.0, inf],
        "ends": [-inf, inf],
        "none": [nan, nan],
    }
    return spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs], "k string, x double")


@pytest.mark.parametrize("limit", [0, 10**6])
def test_nan_is_missing_and_infinity_outermost_on_either_path(strange, limit):
    inf = float("inf")
    probs = {"p25": 0.25, "p50": 0.5, "p95": 0.95}
    rows = q.exact_quantiles(strange, ["k"], {"x": "x"}, probs, max_group_rows=limit).collect()
    got = {r.k: [r.x_p25, r.x_p50, r.x_p95] for r in rows}
    assert got["nan"] == pytest.approx([0.2, 0.3, 2.8])
    assert got["top"] == [1.75, inf, inf]
    assert got["both"] == [-inf, 1.5, inf]
    assert got["ends"] == [None] * 3 and got["none"] == [None] * 3


def test_ecdf_with_nan_and_infinity(strange):
    rows = distributions.ecdf(strange.where("k IN ('nan', 'both')"), "x", ["k"]).collect()
    got = {k: [r.value for r in sorted(rows, key=lambda r: r.i) if r.k == k] for k in ("nan", "both")}
    assert got == {"nan": [0.1, 0.2, 0.3, 2.0, 3.0], "both": [float("-inf"), 1.0, 2.0, float("inf")]}
