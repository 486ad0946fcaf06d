import random

import numpy as np
from pyspark.sql import functions as F

from llm.quality import SLOTS, Model, features, fit, grade, score, train


def texts(rng, count):
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    for k in range(count):
        body = rng.choices(words, k=rng.randint(20, 150))
        level = rng.choice([0, 1, 2, 2, 2])
        if level == 0:
            body = [w.upper() + "!!" for w in body]
        if level == 1:
            for _ in range(3):
                body[rng.randrange(len(body))] = rng.choice(["nastyword", "vileword"])
        yield k, " ".join(body), level


def test_held_out_grades_are_recovered(spark):
    rows = list(texts(random.Random(6), 900))
    docs = spark.createDataFrame([(k, t, "clash") for k, t, _ in rows], "doc_id long, text string, keep string")
    ratings = spark.createDataFrame([(k, g) for k, _, g in rows if k < 600] + [(1, 2), (10**9, 0), (None, 1), (2, None), (3, 7)], "doc_id long, grade int")
    model = train(docs, ratings)
    assert (np.diff(model.thresholds) > 0).all()
    got = {r["doc_id"]: r for r in score(docs, model).collect()}
    held = [(got[k]["keep"], got[k]["expected_grade"], g) for k, _, g in rows if k >= 600]
    assert np.mean([keep == (g == 2) for keep, _, g in held]) > 0.97
    means = [np.mean([e for _, e, g in held if g == level]) for level in range(3)]
    assert means[0] < means[1] < means[2]


def test_nothing_to_grade_and_nothing_to_learn(spark, documents):
    docs = documents(["", None, "  \n", "some words", "x " * 200_000])
    ratings = spark.createDataFrame([], "doc_id long, grade int")
    rows = score(docs, train(docs, ratings)).orderBy("doc_id").collect()
    assert [r["p_top"] is None for r in rows] == [True, True, True, False, False]
    assert not any(r["keep"] for r in rows[:3])
    assert score(docs.limit(0), train(docs.limit(0), ratings)).count() == 0


def test_grades_and_features(spark):
    rows = spark.createDataFrame([(0, 1), (1, 1), (1, 0), (1, None), (None, 0)], "q int, t int").select(grade(F.col("q"), F.col("t")).alias("g"))
    assert [r["g"] for r in rows.collect()] == [0, 1, 2, 2, None]
    assert features("") == {} and set(features("The the")) & set(features("the"))
    model = fit(np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64), 3)
    assert model.thresholds[0] < model.thresholds[1]


def test_every_rated_row_is_learned_from(spark):
    # Each toxic document has a word of its own kind; a sample of a twentieth would miss most.
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    rows = []
    for k in range(3000):
        body = rng.choices(words, k=40)
        if k % 5 == 0:
            body[rng.randrange(40)] = f"vile{k // 5 % 20:02d}"
        rows.append((k, " ".join(body), 1 if k % 5 == 0 else 2))
    docs = spark.createDataFrame(rows, "doc_id long, text string, grade int")
    learned = docs.filter("doc_id < 2400")
    model = train(docs.drop("grade"), learned.select("doc_id", "grade"), rows=800)
    got = score(docs.filter("doc_id >= 2400"), model).collect()
    assert np.mean([r["keep"] for r in got if r["grade"] == 2]) > 0.97
    assert np.mean([not r["keep"] for r in got if r["grade"] == 1]) > 0.9
    again = train(docs.drop("grade"), learned.select("doc_id", "grade").repartition(7), rows=800)
    assert (again.weights == model.weights).all()


def test_a_score_looks_at_all_features():
    rng = np.random.default_rng(4)
    model = Model(np.where(rng.random(SLOTS) < 0.3, rng.normal(size=SLOTS), 0.0), np.array([-1.0, 0.5]))
    tails = model.scorer()
    for text in ("", "One two, two THREE!! four4 four4", "x " * 50 + "Straße ***a### überall"):
        value = sum(model.weights[slot] * share for slot, share in features(text).items())
        assert np.allclose(tails(text), 1 / (1 + np.exp(model.thresholds - value)))
