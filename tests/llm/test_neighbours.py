import numpy as np

from llm.hilbert import nearest


def test_recall_and_exact_scores(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((3000, 16)).astype(np.float32)
    x[7] = x[500]
    rows = [(k, v.tolist(), 1) for k, v in enumerate(x)]
    rows += [(10_000, None, 0), (10_100, [0.0] * 16, 0), (10_200, [float("nan")] * 16, 0), (10_300, [None] + [1.0] * 15, 0), (10_400, [1.0, 2.0], 0)]
    got = nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int")).collect()
    wide = x.astype(np.float64)
    hits = 0
    for q in range(0, 3000, 100):
        d = np.sqrt(((wide - wide[q]) ** 2).sum(axis=1))
        d[q] = np.inf
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [m[0] for m in mine] == list(range(1, 11))
        assert all(abs(m[2] - d[m[1]]) < 1e-12 for m in mine) and mine == sorted(mine, key=lambda m: (m[2], m[1]))
        hits += len({m[1] for m in mine} & set(np.argsort(d, kind="stable")[:10].tolist()))
    assert hits >= 0.9 * 300
    assert {r["query_id"] for r in got} == set(range(0, 3000, 100))
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0])], "vec_id long, embedding array<double>")
    assert [(r["query_id"], r["vec_id"]) for r in nearest(few).collect()] == [(0, 1)]
    assert nearest(few.limit(0)).count() == 0


def test_crowds_of_equal_vectors_keep_the_smallest_ids(spark):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((4000, 16)).astype(np.float32)
    x[1000:3000] = x[1000]
    x[3500] = x[1000] + np.float32(1e-3)  # beside the crowd
    rows = [(k, v.tolist(), "clash") for k, v in enumerate(x)] + [(77, x[50].tolist(), "again"), (50, x[50].tolist(), "row repeated")]
    got = nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>, point string")).collect()
    found = {}
    for r in got:
        found.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    assert set(found) == set(range(0, 4000, 100)) and all(sorted(v) == list(range(1, 11)) for v in found.values())
    for q in (1000, 2500):
        assert [found[q][n] for n in range(1, 11)] == [(i, 0.0) for i in range(1000, 1011) if i != q][:10]
    assert [found[3500][n][0] for n in range(1, 11)] == list(range(1000, 1010))
