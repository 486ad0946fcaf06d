import random

from pyspark.sql import functions as F

from llm.langid import Parser, identify, learn, letters


def plain_phrases(text, sample):
    text, sample = "".join(map(chr, letters(text))), "".join(map(chr, letters(sample)))
    n = at = 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at : at + size + 1] in sample:
            size += 1
        if text[at] in sample and at + size < len(text) and text[at + size] not in sample:
            size += 1
        n, at = n + 1, at + size
    return n


def test_phrases_match_longest_matches():
    rng = random.Random(3)
    samples = (("a", "".join(rng.choices("abc é", k=400))), ("b", "".join(rng.choices("bcd ", k=300))))
    texts = ["".join(rng.choices("abcdeé ,", k=rng.randint(1, 300))) for _ in range(40)]
    texts = [t for t in texts if letters(t).any()]
    got = Parser(samples).phrases([letters(t) for t in texts])
    for t, row in zip(texts, got.tolist()):
        # The last phrase is still open when the text ends.
        assert all(plain_phrases(t, s) - 1 <= n <= plain_phrases(t, s) for n, (_, s) in zip(row, samples))


def test_held_out_languages_and_odd_texts(spark):
    rng = random.Random(5)
    words = {"x": ["dom", "kor", "vila", "tenu"], "y": ["shra", "moth", "quen", "ilby"]}
    rows = [(k, " ".join(rng.choices(words["xy"[k % 2]], k=30)), "xy"[k % 2], k >= 40) for k in range(80)]
    rows += [(100, None, "x", True), (101, "", None, True), (102, "12 !!", "y", True), (103, "DOM kor " * 20_000, None, True)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, held_out boolean").withColumn("score", F.lit("clash"))
    got = {r["doc_id"]: r for r in identify(docs, learn(docs.filter("not held_out"))).collect()}
    assert all(got[k]["lang_pred"] == "xy"[k % 2] for k in range(80)) and got[103]["lang_pred"] == "x"
    assert [got[k]["lang_pred"] for k in (100, 101, 102)] == ["und"] * 3
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert identify(docs, learn(docs.limit(0))).filter("lang_pred != 'und'").count() == 0
