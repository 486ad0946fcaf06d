import re
from collections import Counter

import numpy as np

from llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, n long, p long, term string"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def plain(rows, least, top=50):
    """The definition in Python integers."""
    rows = [(t, lang or "", source or "") for t, lang, source in rows]
    out = []
    for lang in {r[1] for r in rows}:
        mine = [r for r in rows if r[1] == lang]
        df = Counter(t for r in mine for t in set(terms(r[0])))
        kept = {t for t, n in df.items() if n >= least}

        def shares(some):
            n = Counter(t for r in some for t in terms(r[0]) if t in kept)
            return n, {t: 1 + 10**9 * (n[t] + 5) // (sum(n.values()) + 5 * len(kept)) for t in kept}

        sources = {s: shares([r for r in mine if r[2] == s]) for s in {r[2] for r in mine}}
        q = shares(mine)[1]
        for s, (n, p) in sources.items():
            pair = [(sum(abs(p[t] - other[t]) for t in kept), o) for o, (_, other) in sources.items() if o != s]
            term = [(p[t] - q[t], t) for t in kept if n[t] and p[t] > q[t]]
            for part, found, most in (("pair", pair, None), ("term", term, top)):
                found.sort(key=lambda v: (-v[0], v[1].encode()))
                out += [(lang, s, part, item, v, k) for k, (v, item) in enumerate(found[:most], 1)]
    return sorted(out)


def run(spark, rows, **options):
    table = spark.createDataFrame([(k, *r, 1, 2, "clash") for k, r in enumerate(rows)], SCHEMA).repartition(3)
    return sorted(tuple(r) for r in divergence.divergence(table, **options).select("lang", "source", "part", "item", "value", "rank").collect())


def corpus(count=150, seed=4):
    rng = np.random.default_rng(seed)
    words = ["a", "Bé", "eightlet", "ninechars", "sixteencharacter", "seventeencharacte", "größenwahnsinnig", "日本語日本語日本語", "zz", "ABBA"] + [f"w{chr(97 + k)}" for k in range(20)]
    out = []
    for k in range(count):
        p = rng.dirichlet(np.full(len(words), 0.4))
        text = rng.choice([" ", ", ", "1", "\n"]).join(rng.choice(words, rng.integers(0, 60), p=p))
        out.append((text, ["en", "de", None][k % 3], None if k % 11 == 0 else f"s{k % 5}"))
    return out


def test_as_the_definition(spark):
    rows = corpus()
    assert run(spark, rows, least=5) == plain(rows, 5)


def test_nulls_empty_and_long_texts(spark):
    rows = [*corpus(60), (None, "en", "s1"), ("", "en", "lone"), (None, None, None), ("x" * 100_000 + " y", "en", "s2"), ("same " * 50_000, "fr", "only")]
    assert run(spark, rows, least=3, top=4) == plain(rows, 3, 4)


def test_languages_without_kept_terms_have_pairs_of_value_0(spark):
    rows = [("alpha", "en", "a"), ("beta", "en", "b"), (None, "en", "c")]
    got = run(spark, rows)
    assert got == plain(rows, 30) and [r[4] for r in got] == [0] * 6


def test_empty_table(spark):
    assert run(spark, []) == []


def test_repeated_rows_count_each_time(spark):
    rows = [("one two", "en", "a")] * 3 + [("two three", "en", "b")] * 2
    assert run(spark, rows, least=3) == plain(rows, 3)


def test_many_sources_in_tiles(spark, monkeypatch):
    monkeypatch.setattr(divergence, "TILE", 2)
    monkeypatch.setattr(divergence, "BLOCK", 7)
    rows = corpus(120, seed=9)
    assert run(spark, rows, least=4) == plain(rows, 4)


def test_flushes_between_documents(spark, monkeypatch):
    monkeypatch.setattr(divergence, "FLUSH_BYTES", 50)
    rows = corpus(80, seed=2)
    assert run(spark, rows, least=4) == plain(rows, 4)


def test_radix_order_is_stable():
    rng = np.random.default_rng(1)
    low, high = rng.integers(0, 4, 500).astype(np.uint32), rng.integers(0, 1 << 63, 500).astype(np.uint64) % np.uint64(9)
    high <<= np.uint64(40)
    assert divergence.radix_order([low, high]).tolist() == np.lexsort((low, high)).tolist()


def test_terms_end_with_their_document():
    texts = [b"ab", b"cd", b"", b"ab!"]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    got = {}
    for group, names, n, docs in divergence.count_terms(data, offsets, np.zeros(4, np.int64)):
        got |= {t: (int(a), int(b)) for t, a, b in zip(names, n, docs)}
    assert got == {b"ab": (2, 2), b"cd": (1, 1)}
