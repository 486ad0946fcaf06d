import random

import numpy as np
from pyspark.sql import functions as F

from llm import decontam
from llm.decontam import STEP, build, common_subsequence, cooccurrences, decontaminate, words


def test_common_subsequence():
    rng = random.Random(1)
    for _ in range(200):
        a, b = rng.choices(range(5), k=rng.randint(1, 9)), rng.choices(range(6), k=rng.randint(0, 12))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert common_subsequence(a, b) == table[-1][-1]


def test_copies_and_paraphrases_are_found_and_clean_texts_stay(spark, documents):
    rng = random.Random(4)
    words = [f"{a}{k}" for a in ("the", "ña", "of", "re") for k in range(500)]
    items = [rng.choices(words, k=rng.randint(17, 50)) for _ in range(30)]
    texts, leaks = [], {}
    for k in range(150):
        body = rng.choices(words, k=rng.randint(0, 300))
        if k % 3 == 0:
            item = list(items[k % 30])
            if k % 2:
                item[len(item) // 3] = "other"
            at = rng.randint(0, len(body))
            body[at:at] = item
            leaks[k] = k % 30
        texts.append(" ".join(body).title())
    docs = documents([*texts, None, "", "x " * 100_000]).withColumn("item_id", F.lit("clash"))
    bench = spark.createDataFrame([(k, " ".join(v)) for k, v in enumerate(items)] + [(None, "a b c d e f"), (90, None), (91, "too few")], "item_id long, text string")
    got = {r["doc_id"]: r for r in decontaminate(docs, bench).collect()}
    assert {k: r["item_id"] for k, r in got.items() if r["contaminated"]} == leaks
    assert decontaminate(docs.limit(0), bench).count() == 0
    assert decontaminate(docs, bench.limit(0)).filter("contaminated").count() == 0


def test_items_of_3_to_1000_words(spark, documents):
    rng = random.Random(9)
    words = [f"{a}{k}" for a in ("the", "ña", "of", "re") for k in range(500)]
    sizes = [3, 4, 5, 8, 16, 40, 64, 65, 100, 160, 200, 250, 300, 500, 1000]
    items = [[f"q{n}", *rng.choices(words, k=n - 1)] for n in sizes]
    texts = []
    for item in items:
        body = rng.choices(words, k=300)
        at = rng.randint(0, 300)
        texts += [" ".join(body[:at] + item + body[at:]), " ".join(body)]
    # A long item with every tenth word changed; half of one; a short one with another order.
    edited = [w if k % 10 else "new" for k, w in enumerate(items[-2])]
    texts += [" ".join(rng.choices(words, k=150) + edited), " ".join(items[-2][:250]), " ".join(rng.choices(words, k=100) + items[1][::-1])]
    bench = spark.createDataFrame([(k, " ".join(v)) for k, v in enumerate(items)] + [(50, " ".join(items[3])), (51, "two words"), (7, " ".join(items[7]))], "item_id long, text string")
    rows = documents(texts)
    got = {r["doc_id"]: r for r in decontaminate(rows.union(rows.filter("doc_id = 6")), bench).collect()}
    want = {2 * k: k for k in range(len(sizes))} | {2 * len(sizes): len(sizes) - 2}
    assert {k: r["item_id"] for k, r in got.items() if r["contaminated"]} == want
    assert got[6]["n_items"] == 2 and got[0]["lcs_share"] == 1.0


def test_pairs_of_all_passages_are_counted(spark, documents, monkeypatch):
    rng = random.Random(3)
    pool = [f"w{k}" for k in range(40)]
    texts = [" ".join(rng.choices(pool, k=n)) for n in (0, 1, 15, 16, 17, 31, 32, 33, 48, 49, 200, 1000)] + [None, "w1 " * 300]
    vocabulary = {w.encode(): k for k, w in enumerate(pool[:30])}
    want, present = np.zeros((30, 30), np.int64), np.zeros(30, np.int64)
    for text in texts:
        ids = [vocabulary.get(w, -1) for w in words(text)]
        present[sorted({w for w in ids if w >= 0})] += 1
        for p in range(max(1, -(-len(ids) // STEP) - 1)):
            t = np.bincount([w for w in ids[p * STEP : (p + 2) * STEP] if w >= 0], minlength=30)
            want += np.outer(t, t)
    for per_pass, per_part in ((1 << 24, 1 << 19), (100, 20)):
        monkeypatch.setattr(decontam, "PAIRS_PER_PASS", per_pass)
        monkeypatch.setattr(decontam, "STEPS_PER_PART", per_part)
        monkeypatch.setattr(decontam, "PAIRS_PER_BLOCK", 50)
        monkeypatch.setattr(decontam, "GROUP_STEPS", per_part)
        n, counts, table = cooccurrences(documents(texts).repartition(3), vocabulary)
        assert n == len(texts) and counts.tolist() == present.tolist()
        assert np.array_equal(decontam._product(table, np.eye(30)), want)


def test_model_depends_on_every_document(spark, documents):
    rng = random.Random(5)
    pool = [f"w{k}" for k in range(240)]
    rows = [(k, " ".join(pool[6 * k : 6 * k + 6])) for k in range(40)]
    texts = [" ".join(rng.choices(pool, k=20)) for _ in range(510)]
    docs = documents(texts)
    last = docs.orderBy(F.xxhash64("doc_id").desc()).first()["doc_id"]
    tail = pool * 2

    def subspace(order):
        long = documents([*texts[:last], " ".join(order), *texts[last + 1 :]])
        index = build(long, rows)
        return (index.loadings / index.idf[:, None]) @ (index.loadings / index.idf[:, None]).T

    # The same words in every document, in another order in one that no sample of 500 held.
    one, other = subspace(tail), subspace(sorted(tail))
    assert abs(one - other).max() > 1e-3


def test_pair_counts_travel_packed_and_few_at_a_time(spark, documents):
    """A task gets the sums of hundreds of others: raw, a batch of them took its memory."""
    pool = [f"w{k}" for k in range(1500)]
    texts = [" ".join(pool[k : k + 40]) for k in range(0, 1460, 20)]
    _, _, table = cooccurrences(documents(texts).repartition(3), {w.encode(): k for k, w in enumerate(pool)})
    raw = 8 * 1500 * 1501 // 2
    assert table.agg(F.sum(F.octet_length("part"))).first()[0] < raw / 20
    parts = [(k, k + 1, np.zeros(1 << 15, np.int32)) for k in range(100)]
    batches = list(decontam._packed(iter(parts)))
    assert max(b.num_rows for b in batches) <= decontam.ROWS_PER_BATCH and max(b.nbytes for b in batches) < 1 << 15
    assert all(np.array_equal(p[2], q[2]) and p[:2] == q[:2] for p, q in zip(parts, decontam._unpacked(iter(batches), np.int32), strict=True))
