import random

import xxhash
from pyspark.sql import functions as F

from llm.components import components
from llm.simhash import fingerprint, near_duplicates


def plain_fingerprint(text, words=4):
    parts = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()]
    grams = [b" ".join(parts[i : i + words]) for i in range(len(parts) - words + 1)] or ([b" ".join(parts)] if parts else [])
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(pairs, nodes):
    root = {n: n for n in nodes}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in pairs:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def test_fingerprint_matches_its_definition(spark):
    texts = ["", None, "One", "one two three", "A b C d e", "Été x y\tz\x0bq é É", "x " * 500, "word " + " ".join(str(i) for i in range(700))]
    for text in texts:
        assert int.from_bytes(fingerprint(text), "big") == plain_fingerprint(text)
    native = spark.createDataFrame([("a b c d",)], "t string").select(F.xxhash64("t")).first()[0]
    assert native % 2**64 == plain_fingerprint("A B C D")


def test_components_agree_with_union_find(spark):
    rng = random.Random(5)
    pairs = [(k, k + 1) for k in range(100, 140)] + [(7, k) for k in range(200, 260)] + [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    nodes = {n for a, b in pairs if a != b for n in (a, b)}
    assert got == {n: r for n, r in plain_groups(pairs, nodes).items()}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_groups_match_all_pairs(spark, documents):
    rng = random.Random(3)
    vocabulary = [f"w{k}" for k in range(300)]
    texts = []
    for _ in range(12):
        base = rng.choices(vocabulary, k=rng.choice([30, 200, 900]))
        for _ in range(6):
            words = list(base)
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            texts.append(" ".join(words))
    texts += ["", None, "   ", "same", "same", "x " * 50_000]
    docs = documents(texts).withColumn("fp", F.lit("clash")).withColumn("component_id", F.lit("clash"))
    prints = [plain_fingerprint(t) for t in texts]
    for radius, tile in ((4, 8192), (9, 8192)):
        got = near_duplicates(docs, 4, radius).collect()
        pairs = [(a, b) for a in range(len(texts)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= radius]
        want = plain_groups(pairs, range(len(texts)))
        assert {r["doc_id"]: r["component_id"] for r in got} == want
        assert {r["doc_id"]: int.from_bytes(r["fp"], "big") for r in got} == dict(enumerate(prints))


def test_small_tiles_and_wide_fingerprints_lose_no_link(spark):
    from llm.simhash import close_links

    rng = random.Random(9)
    prints = []
    for _ in range(30):
        base = rng.getrandbits(128)
        prints += [base] + [base ^ sum(1 << rng.randrange(128) for _ in range(6)) for _ in range(6)]
    prints = sorted(set(p % 2**128 for p in prints))
    unique = spark.createDataFrame([(bytearray(p.to_bytes(16, "big")), k) for k, p in enumerate(prints)], "fp binary, rep long")
    got = {r["node"]: r["root"] for r in components(close_links(unique, 12, 2, tile=16)).collect()}
    pairs = [(a, b) for a in range(len(prints)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 12]
    assert {k: got.get(k, k) for k in range(len(prints))} == plain_groups(pairs, range(len(prints)))


def test_null_ids_repeated_rows_and_empty_tables(spark, documents):
    docs = documents(["a b c d e"]).union(documents(["a b c d e"])).union(documents([None])).withColumn("text", F.col("text"))
    odd = docs.union(spark.createDataFrame([(None, "a b c d e", None, None, None)], docs.schema))
    rows = near_duplicates(odd).collect()
    assert len(rows) == 4
    assert [r["component_id"] for r in rows if r["doc_id"] is None] == [None]
    assert near_duplicates(docs.limit(0)).count() == 0
