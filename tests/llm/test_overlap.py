import re

import numpy as np
import pytest

from llm import overlap

SCHEMA = "doc_id long, text string, n long, id long, tokens string, maybe string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(words[i : i + 4]) for i in range(max(1, len(words) - 3))} if words else set()


def plain(rows):
    """All pairs, on the shingles themselves."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and rows[i][0] is not None and rows[j][0] is not None and 100 * len(a & b) >= 85 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for k, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(k)] = min(least.get(find(k), doc), doc)
    return sorted(((d, len(s), least[find(k)] if d is not None else None) for k, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def run(spark, rows):
    table = spark.createDataFrame([(*r, 1, 2, "clash", "clash") for r in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in overlap.similar_sets(table).collect()), key=str)


def variants(rng, words, changes):
    words = list(words)
    for at in rng.choice(len(words), changes, replace=False):
        words[at] = f"v{rng.integers(1 << 40)}"
    return " ".join(words)


def family(rng, size, length, changes):
    base = [f"b{rng.integers(1 << 40)}" for _ in range(length)]
    return [variants(rng, base, rng.integers(0, changes + 1)) for _ in range(size)]


def corpus(seed=1):
    rng = np.random.default_rng(seed)
    texts = []
    for length, changes in ((8, 1), (30, 2), (90, 5), (200, 9), (500, 20)):
        texts += family(rng, 12, length, changes)
    common = " ".join(f"c{k}" for k in range(60))
    # A passage that many share, alone and with more or less text of their own.
    texts += [f"{common} " + " ".join(f"o{rng.integers(1 << 40)}" for _ in range(n)) for n in (0, 1, 3, 6, 8, 10, 12, 30, 60, 200) * 3]
    texts += ["a b c", "A  b\tC", "a b c d", "lone", None, "", " \n", "x " * 5000, "x " * 4000 + "y"]
    order = rng.permutation(len(texts))
    return [(int(k) * 3 + 1, texts[i]) for k, i in enumerate(order)]


def test_as_all_pairs(spark):
    rows = corpus()
    assert run(spark, rows) == plain(rows)


@pytest.mark.parametrize("seed", [2, 3])
def test_long_lists_and_large_groups(spark, monkeypatch, seed):
    """Limits so small that every path is taken: long lists, whole sets, split groups."""
    for name, value in (("LONG", 4), ("MEMBERS", 6), ("HUBS", 2), ("SHINGLES", 900)):
        monkeypatch.setattr(overlap, name, value)
    rows = corpus(seed)
    assert run(spark, rows) == plain(rows)


def test_copies_repeated_ids_and_missing_ids(spark):
    text = " ".join(f"w{k}" for k in range(50))
    near = text + " more"
    rows = [(5, text)] * 3 + [(9, text), (4, near), (None, text), (7, "other words here now"), (7, text), (8, None), (None, None)]
    assert run(spark, rows) == plain(rows)


def test_chains_link_what_is_not_alike(spark):
    words = [f"w{k}" for k in range(200)]
    rows = [(k, " ".join(words[4 * k : 4 * k + 100])) for k in range(25, -1, -1)]
    got = run(spark, rows)
    assert got == plain(rows) and {r[2] for r in got} == {0}


def test_empty_table(spark):
    assert run(spark, []) == []


def test_sizes_in_sql_and_python(spark):
    ns = list(range(1, 400))
    rows = spark.createDataFrame([(n, n, m) for n in ns for m in (n, n + n // 10)], "n long, na long, nb long")
    got = rows.select("n", "nb", *(overlap._sql(t).alias(c) for c, t in (("s", "spare(n)"), ("l", "spare_low(n)"), ("t", "least_shared(n)"), ("r", "required")))).collect()
    for r in got:
        n = r["n"]
        assert (r["s"], r["l"], r["t"], r["r"]) == (overlap.spare(n), overlap.spare(overlap.smallest(n)), overlap.least_shared(n), overlap.required(n, r["nb"]))
        assert 100 * r["r"] >= 85 * (n + r["nb"] - r["r"]) and not 100 * (r["r"] - 1) >= 85 * (n + r["nb"] - r["r"] + 1)


@pytest.mark.parametrize("seed", range(6))
def test_search_finds_all_sets_that_share_enough(seed):
    rng = np.random.default_rng(seed)
    sets = []
    for _ in range(12):
        base = rng.choice(400, rng.integers(1, 120), replace=False)
        for _ in range(rng.integers(1, 9)):
            keep = base[rng.random(len(base)) > rng.choice([0.0, 0.05, 0.2])]
            sets.append(np.unique(np.concatenate([keep, rng.choice(400, rng.integers(1, 6))])))
    lists = overlap.Lists(sets)
    for r in range(len(sets)):
        mine = set(sets[lists.order[r]].tolist())
        want = [s for s in range(len(sets)) if s != r and 100 * len(mine & set(sets[lists.order[s]].tolist())) >= 85 * len(mine | set(sets[lists.order[s]].tolist()))]
        assert lists.search(r) == want


def test_families_are_connected_whatever_is_left_alive():
    rng = np.random.default_rng(8)
    base = rng.choice(10_000, 300, replace=False)
    sets = [np.unique(np.concatenate([rng.choice(base, 300 - c, replace=False), rng.choice(10_000, c)])) for c in rng.integers(0, 25, 40)]
    links = {(a, b) for a in range(40) for b in range(a) if 100 * len(np.intersect1d(sets[a], sets[b])) >= 85 * len(np.union1d(sets[a], sets[b]))}
    root = overlap.Lists(sets).connect()[0]
    want = list(range(40))
    for _ in range(40):
        for a, b in links:
            want[a] = want[b] = min(want[a], want[b])
    assert len(set(root.tolist())) == len(set(want)) < 40
    assert all((root[a] == root[b]) == (want[a] == want[b]) for a in range(40) for b in range(40))
