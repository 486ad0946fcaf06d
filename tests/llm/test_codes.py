import hashlib
import math

import numpy as np
import pytest

from llm import codes

SCHEMA = "vec_id long, embedding array<double>, label int, code string"


def plain(rows, parts=16, entries=64, rounds=2):
    """The definition in Python integers, every part against every entry."""
    kept = [r for r in rows if r[1] is not None and all(v is not None and math.isfinite(v) for v in r[1])]
    width = -(-max((len(r[1]) for r in kept), default=0) // parts)
    whole = [[int(v) * 256 if abs(v) > 2**53 else math.floor(v * 256) for v in r[1]] + [0] * (width * parts - len(r[1])) for r in kept]
    cut = [[x[width * p : width * (p + 1)] for p in range(parts)] for x in whole]
    order = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, kept[k][1]))[:entries]
    books = [[cut[k][p] for k in order] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            got = [nearest(c[p], books[p])[1] for c in cut]
            for i in range(len(books[p])):
                mine = [c[p] for c, g in zip(cut, got) if g == i]
                if mine:
                    books[p][i] = [sum(v) // len(mine) for v in zip(*mine)]
    out = []
    for r, c in zip(kept, cut):
        found = [nearest(c[p], books[p]) for p in range(parts)]
        out.append((r[0], r[2], "".join(f"{i:02x}" for _, i in found), sum(d for d, _ in found)))
    by_label = {}
    for _, label, _, error in out:
        by_label[label] = by_label.get(label, 0) + error
    sha = hashlib.sha256(",".join(str(v) for book in books for e in book for v in e).encode()).hexdigest()
    long = lambda v: v if v < 1 << 63 else None
    wide = {label for _, label, _, e in out if e >= 1 << 63}
    return sorted(((i, l, c, long(e), None if l in wide else long(by_label[l]), sha) for i, l, c, e in out), key=str)


def run(spark, rows, **options):
    table = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in codes.encode(table, **options).collect()), key=str)


def random_rows(count, dim, seed=3, spread=1.0):
    rng = np.random.default_rng(seed)
    return [(k, (rng.standard_normal(dim) * spread).tolist(), int(k % 5) if k % 7 else None) for k in range(count)]


def test_as_the_definition(spark):
    rows = random_rows(400, 64)
    assert run(spark, rows) == plain(rows)


def test_ties_and_copies_go_to_the_lower_entry(spark):
    rng = np.random.default_rng(5)
    rows = [(k, rng.integers(-1, 2, 16).astype(float).tolist(), 1) for k in range(200)]
    rows += [(3, rows[3][1], 1), (3, rows[4][1], None), (None, rows[5][1], 2)]
    assert run(spark, rows) == plain(rows)


def test_rejected_and_uneven_vectors(spark):
    rows = random_rows(90, 20) + [(900, None, 1), (901, [1.0, None], 1), (902, [math.nan] * 20, 2), (903, [math.inf] * 20, 2), (904, [], 2), (905, [0.5], None)]
    got = run(spark, rows)
    assert got == plain(rows)
    assert {r[0] for r in got}.isdisjoint({900, 901, 902, 903})


def test_huge_components_stay_exact(spark):
    rows = random_rows(70, 16, spread=1e7) + [(1000, [1e300] * 16, 3), (1001, [-1e18] * 16, 4)]
    assert run(spark, rows) == plain(rows)


def test_balls_without_parts_in_some_task(spark):
    """Small radii of one task meet empty balls of another."""
    rows = [(k, [float(k % 70) / 256] * 16, 0) for k in range(300)]
    assert run(spark, rows) == plain(rows)


def test_fewer_rows_than_entries_and_none(spark):
    rows = random_rows(5, 32)
    assert run(spark, rows) == plain(rows)
    assert run(spark, []) == []
    assert run(spark, [(1, None, None)]) == []


@pytest.mark.parametrize("radius", [True, False])
def test_rings_leave_no_entry_out(radius):
    rng = np.random.default_rng(11)
    entries = rng.integers(-50, 50, (64, 4))
    x = rng.integers(-60, 60, (3000, 4))
    own = rng.integers(0, 64, 3000)
    d2 = codes.squared(x[:, None], entries[None])
    radii = [max(d2[own == i, i].tolist(), default=-1) for i in range(64)] if radius else None
    code, far = codes.assign(x, own, codes.balls(entries, radii))
    assert (code == d2.argmin(axis=1)).all() and (far == d2.min(axis=1)).all()


def test_stable_core_is_not_compared(monkeypatch):
    entries = np.array([[0, 0], [100, 0], [0, 100]])
    x = np.array([[1, 1], [99, 2], [3, 96]])
    asked = []
    squared = codes.squared
    monkeypatch.setattr(codes, "squared", lambda a, b: asked.append(len(a)) or squared(a, b))
    part = codes.balls(entries, [50, 50, 50])
    asked.clear()
    codes.assign(x, np.array([0, 1, 2]), part)
    assert asked == [3]
