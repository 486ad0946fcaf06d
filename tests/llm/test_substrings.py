import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from llm.substrings import remove_repeats


def plain(texts, length):
    """(n_removed, n_spans, kept) of each text by counting every string."""
    raws = [(t or "").encode() for t in texts]
    counts = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for raw in raws:
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if counts[raw[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = sum(gone[k] and not (k and gone[k - 1]) for k in range(len(gone)))
        out.append((sum(gone), runs, bytes(b for b, g in zip(raw, gone) if not g)))
    return out


def check(docs, texts, **more):
    got = {r["doc_id"]: r for r in remove_repeats(docs, **more).collect()}
    assert len(got) == len(texts)
    for k, (removed, runs, kept) in enumerate(plain(texts, 200)):
        r = got[k]
        assert (r["n_bytes"] - len(r["kept"]), len(r["spans"]), bytes(r["kept"])) == (removed, runs, kept), k


@pytest.mark.parametrize("most", [6000, 12])
def test_matches_counting_every_string(spark, documents, most):
    rng = random.Random(11)
    words = ["the", "ñandú", "of", "retion", "über", "x", "and,"]

    def prose(n):
        return " ".join(rng.choice(words) + rng.choice(["", "", "s", "ed", "é"]) + str(rng.randrange(50)) for _ in range(n))

    shared = [prose(40) for _ in range(3)]
    texts = []
    for _ in range(60):
        parts = [prose(rng.randint(5, 60))]
        if rng.random() < 0.7:
            parts.insert(rng.randrange(2), rng.choice(shared)[rng.randrange(60) :])
        texts.append(" ".join(parts))
    near = prose(150)
    for _ in range(20):
        k = rng.randrange(len(near))
        texts.append(near[:k] + "#" + near[k + 1 :])
    texts += [near, near, "", None, "short", "ab" * 500, "a" * 199, "a" * 200, "a" * 201, "z" * 200, "\0" * 300, prose(3000)]
    docs = documents(texts).withColumn("kept", F.lit("clash")).withColumn("row_id", F.lit("clash"))
    check(docs, texts, most=most)


def test_long_text_in_segments(spark, documents, monkeypatch):
    import llm.substrings as module

    rng = random.Random(2)
    monkeypatch.setattr(module, "SEGMENT", 3000)
    body = "".join(rng.choice("abcdefgh \n") for _ in range(40_000))
    texts = [body, "-" + body[2_500:7_000] + "-" + body[11_900:12_150] + body[100:305], "b" * 9_000]
    check(documents(texts), texts)
    assert module._segments(10_000, 200)[0] == (0, 3400, 0, 3000)


def test_repeated_rows_are_two_places(spark, documents):
    text = "".join(random.Random(1).choices("abcdef", k=300))
    docs = documents([text]).union(documents([text])).coalesce(1)
    rows = remove_repeats(docs).collect()
    assert [bytes(r["kept"]) for r in rows] == [b"", b""]
    assert remove_repeats(docs.limit(0)).count() == 0
    alone = remove_repeats(documents([text])).first()
    assert hashlib.sha256(alone["kept"]).hexdigest() == hashlib.sha256(text.encode()).hexdigest()
