import random

import numpy as np
from pyspark.sql import functions as F

from llm.lines import _connect, block_keys, dedup_lines, keys_due, letter_counts, majorities, may_be_similar, normalise, similar, within


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        previous, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            previous, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, previous + (x != y))
    return row[-1]


def test_within_agrees_with_the_full_table():
    rng = random.Random(4)
    for _ in range(2000):
        a = "".join(rng.choice("ab ñ") for _ in range(rng.randint(0, 16)))
        b = list(a)
        for _ in range(rng.randint(0, 5)):
            k = rng.randint(0, len(b))
            b[k : k + rng.randint(0, 1)] = rng.choice(["", "x", "b"])
        b = "".join(b)
        most = rng.randint(0, 6)
        assert within(a, b, most) == (plain_distance(a, b) <= most), (a, b, most)


def shared(lines, other):
    """Common pigeonhole keys of each pair of lines, where they are enough."""
    (a, x), (b, y) = block_keys(lines), block_keys(other)
    left = [set(x[a == k].tolist()) for k in range(len(lines))]
    right = [set(y[b == k].tolist()) for k in range(len(lines))]
    words = [np.array([t.count(" ") + 1 for t in ts]) for ts in (lines, other)]
    due = np.minimum(keys_due(words[0]), keys_due(words[1]))
    return np.array([len(p & q) >= d for p, q, d in zip(left, right, due)])


def edited(rng, line, edits):
    chars = list(line)
    for _ in range(edits):
        k, kind = rng.randrange(len(chars)), rng.random()
        if kind < 0.6:
            chars[k] = rng.choice("abcdefghij")
        elif kind < 0.8:
            chars.insert(k, rng.choice("abcdefghij"))
        else:
            del chars[k]
    return " ".join("".join(chars).split())


def test_recall_of_edited_lines_at_every_length():
    """Against all pairs, with no radius: lines of a few letters' difference meet."""
    rng = random.Random(12)
    for words in (1, 2, 4, 6, 9, 12, 16, 20, 30, 45, 70, 150, 400):
        lines = [" ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9) + 10 * (words < 3))) for _ in range(words)) for _ in range(300)]
        for edits in (1, 2):
            if edits > 0.1 * min(map(len, lines)) and edits > 1:
                continue
            other = [edited(rng, line, edits) for line in lines]
            kept = [k for k in range(300) if within(lines[k], other[k], int(0.1 * max(len(lines[k]), len(other[k]))))]
            recall = shared([lines[k] for k in kept], [other[k] for k in kept]).mean() if kept else 1.0
            assert recall >= (0.9 if edits == 1 or words >= 20 else 0.5), (words, edits, recall)


def test_block_is_the_majority_of_its_words():
    hashes = np.array([0b1100, 0b1010, 0b1001, 0b0110], np.uint64)
    fps, counts = majorities(hashes, np.array([0, 0, 0, 2]), 3)
    assert fps.tolist() == [0b1000, 0, 0b0110] and counts.tolist() == [3, 0, 1]


def brute(texts, least, min_chars):
    """All pairs of lines."""
    rows = [(d, n, line) for d, t in enumerate(texts) if t is not None for n, line in enumerate(normalise(t)) if line]
    root = list(range(len(rows)))

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            a, b = rows[i][2], rows[j][2]
            far = int((1 - least) * max(len(a), len(b)) + 1e-9)
            if a == b or min(len(a), len(b)) >= min_chars and within(a, b, far):
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    gone = {rows[k][:2] for k in range(len(rows)) if top(k) != k}
    return [None if t is None else "\n".join(line for n, line in enumerate(t.split("\n")) if (d, n) not in gone) for d, t in enumerate(texts)]


def lines_of(rng, count):
    words = [f"{c}{k}" for c in ("the", "ña", "of", "ret") for k in range(40)]
    bases = [rng.choices(words, k=rng.choice([4, 8, 40, 90])) for _ in range(count)]
    for _ in range(4 * count):
        line = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 2])):
            line[rng.randrange(len(line))] = rng.choice(words)
        yield (" " if rng.random() < 0.5 else ", ").join(line).title() + rng.choice(["", ".", "!!"])


def test_matches_all_pairs(spark, documents, monkeypatch):
    import llm.lines as module

    rng = random.Random(8)
    texts, pool = [], list(lines_of(rng, 40))
    while pool:
        k = rng.randint(1, 6)
        texts.append("\n".join(pool[:k]))
        pool = pool[k:]
    texts += ["", None, "\n\n", "one two three four five six\n" * 30, "w " * 20_000]
    docs = documents(texts)
    for name in ("n_lines", "key", "maybe", "_at", "_word", "_bits", "lines", "rest"):
        docs = docs.withColumn(name, F.lit("clash"))
    for members, long in ((1024, 64), (4, 3)):
        monkeypatch.setattr(module, "MEMBERS", members)
        monkeypatch.setattr(module, "LONG", long)
        got = {r["doc_id"]: r for r in dedup_lines(docs).collect()}
        want = brute(texts, 0.9, 10)
        assert {k: r["text"] for k, r in got.items()} == dict(enumerate(want))
        for k, text in enumerate(texts):
            assert got[k]["n_removed"] == (0 if text is None else text.count("\n") - want[k].count("\n") + (0 if want[k] or not text or got[k]["n_removed"] < got[k]["n_lines"] else 1))


def test_nulls_repeats_and_empty_tables(spark, documents):
    text = "a line with quite enough words\nshort one"
    docs = documents([text, None, text])
    odd = docs.union(spark.createDataFrame([(None, text, None, None, None)], docs.schema))
    got = dedup_lines(odd).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "", r["n_lines"], r["n_removed"]) for r in got) == [
        (False, 0, text, 2, 0),
        (False, 1, "", 0, 0),
        (False, 2, "", 2, 2),
        (True, 0, text, 2, 0),
    ]
    assert dedup_lines(docs.limit(0)).count() == 0


def test_letter_counts_leave_out_no_similar_pair():
    rng = random.Random(21)
    lines = [" ".join("".join(rng.choice("abcñ漢") for _ in range(rng.randint(1, 7))) for _ in range(rng.randint(3, 9))) for _ in range(600)]
    other = [edited(rng, line, rng.randint(0, 3)) if rng.random() < 0.7 else rng.choice(lines) for line in lines]
    maybe = may_be_similar(letter_counts(lines), letter_counts(other), 0.9)
    alike = np.array([similar(a, b, 0.9) for a, b in zip(lines, other)])
    assert not (alike & ~maybe).any() and alike.sum() > 50
    assert may_be_similar(letter_counts([""]), letter_counts([""]), 0.9).all()


def test_lines_of_a_family_with_other_letters_are_not_compared():
    rng = random.Random(22)
    rows = [(bytes([k]), bytes(16), "one frequent block of words " + "".join(rng.choice("abcdefghijklmnop") for _ in range(40))) for k in range(60)]
    asked = []
    _connect(rows, 26, lambda a, b: asked.append(1) or similar(a, b, 0.9), 0.9)
    assert len(asked) < 60 * 59 // 2 // 4


def test_many_pairs_at_once_agree_with_one_by_one(monkeypatch):
    import llm.lines as module

    rng = random.Random(31)
    lines = ["".join(rng.choice("ab ñ漢") for _ in range(rng.randint(0, rng.choice([5, 60, 900])))) for _ in range(400)]
    other = [edited(rng, line, rng.randint(0, len(line) // 8 + 1)) if line else "x" for line in lines]
    for least in (0.9, 0.7, 0.0):
        want = [similar(a, b, least) for a, b in zip(lines, other)]
        assert module.similar_pairs(lines, other, least).tolist() == want
    # Nearly all of them are settled without a table of their own.
    asked = []
    monkeypatch.setattr(module, "within", lambda a, b, most: asked.append(most) or within(a, b, most))
    module.similar_pairs(lines, other, 0.9)
    assert len(asked) < 40 and min(asked, default=64) >= 64


def test_keys_of_a_line_travel_as_arrays(spark, documents, monkeypatch):
    """A row for each of a line's twenty keys cost more than the comparisons."""
    import llm.lines as module

    rng = random.Random(32)
    lines = [" ".join(rng.choices([f"w{k}" for k in range(3000)], k=30)) for _ in range(300)]
    frequent = [f"one block of very frequent words here {k}" for k in range(300)]
    docs = documents([*lines, *(line.replace("w1", "w2", 1) for line in lines), *frequent])
    keyed = module._keyed_lines(docs, 10).cache()
    plans = module._candidates(keyed, 0.9)
    assert "Generate" not in plans._jdf.queryExecution().executedPlan().toString()
    want = sorted(map(tuple, plans.filter("b is not null").groupBy("a", "b").agg(F.sum("shared")).collect()))
    family = {tuple(r) for r in plans.filter("b is null").select("a", "block").collect()}
    assert want and family
    # More tasks with fewer keys find the same.
    monkeypatch.setattr(module, "KEYS", 50)
    plans = module._candidates(keyed, 0.9)
    assert sorted(map(tuple, plans.filter("b is not null").groupBy("a", "b").agg(F.sum("shared")).collect())) == want
    assert {tuple(r) for r in plans.filter("b is null").select("a", "block").collect()} == family
