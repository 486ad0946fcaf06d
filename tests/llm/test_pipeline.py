import random

from corpus_pipeline import line_stage, simhash_stage

A, B, C, D, E = (f"{x} line number {x} with quite enough distinct {x} words" for x in ("alpha", "bravo", "charlie", "delta", "echo"))


def test_line_stage_loses_no_line(spark, documents):
    texts = [
        "\n".join([A, B, C, D]),
        "\n".join([A, B, C, D, A, B, E, "rest"]),  # mostly copied, but holds the kept occurrence of E
        E,
        "\n".join([A] * 3),
        "\n".join(["only its own line again and again here"] * 30),
        "   ",
    ]
    got = {r["doc_id"]: r for r in line_stage(spark, documents(texts), "").collect()}
    assert {k: r["text"] for k, r in got.items()} == {0: texts[0], 1: f"{E}\nrest", 4: "only its own line again and again here", 5: "   "}
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())


def near_copies(rng):
    """Texts with variants of all degrees, short ones and blank ones."""
    for length in (0, 3, 6, 12, 25, 60, 200, 200, 400):
        base = [f"w{rng.randrange(3000)}" for _ in range(length)]
        yield " ".join(base)
        for share in (0, 0.01, 0.02, 0.03, 0.04, 0.05, 0.07):
            for _ in range(3):
                yield " ".join(f"w{rng.randrange(3000)}" if rng.random() < share else w for w in base)


def test_simhash_stage_matches_all_pairs(spark, documents, monkeypatch):
    import llm.lines

    texts = list(near_copies(random.Random(5)))
    random.Random(6).shuffle(texts)
    sets = [set(zip(*(t.split()[k:] for k in range(5)))) or {tuple(t.split())} for t in texts]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) and root[i] != root[j]:
                low, high = sorted((root[i], root[j]))
                root = [low if x == high else x for x in root]
    for members in (512, 8):
        monkeypatch.setattr(llm.lines, "MEMBERS", members)
        got = simhash_stage(spark, documents(texts), "").collect()
        assert sorted(r["doc_id"] for r in got) == sorted(set(root))
