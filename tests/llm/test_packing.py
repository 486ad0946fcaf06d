import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm.common import cut
from llm.matrices import matrix, read, write, written
from llm.packing import best_fit_decreasing, check_plan, fullest, length_counts, minimum_slack, place
from llm.tokens import ADDED, cut_points, encoder, pieces

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
ODD = ["", None, "a", "two words", "  spaces  and\ttabs\r\n\n x", "Été ñ ß 日本語 🙂", "<|endoftext|> in text", "1234 it's", "line\nbreaks\n\nhere ", " x y"]


def test_ids_equal_those_of_the_json_vocabulary():
    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    own = encoder(RANKS, PATTERN)
    assert {t.content: k for k, t in reference.get_added_tokens_decoder().items()} == ADDED
    added = ["<|endoftext|>", "a<|endoftext|>b <|endoftext|><|endoftext|>\n x", "<|endoftext|", " <|endoftext|> "]
    for text in [t for t in ODD if t] + ["word " * 3000, *added]:
        assert np.frombuffer(own.encode(text), "<u4").tolist() == reference.encode(text, add_special_tokens=False).ids


def test_cutting_is_lossless():
    for length in (1, 5, 8, 9, 16, 17):
        parts = cut_points(length, 8)
        assert parts[0][0] == 0 and sum(n for _, n in parts) == length
        assert all(n == 8 for _, n in parts[1:]) and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:]))


def plain_best_fit(lengths, limit):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [k for k, r in enumerate(rooms) if r >= n]
        if fits:
            rooms[min(fits, key=lambda k: rooms[k])] -= n
        else:
            rooms.append(limit - n)
    return Counter(limit - r for r in rooms)


def fills(plan):
    total = defaultdict(int)
    for s in plan:
        for b in range(s.bin, s.bin + s.bins):
            total[b] += s.each * s.length
    return Counter(total.values())


@pytest.mark.parametrize("seed", range(8))
def test_plans_against_item_by_item_versions(seed):
    rng = random.Random(seed)
    limit = rng.choice([10, 64, 100])
    lengths = [rng.randint(1, limit) for _ in range(rng.randint(0, 120))]
    counts = Counter(lengths)
    plan = best_fit_decreasing(counts, limit)
    assert check_plan(plan, counts, limit) == sum(fills(plan).values())
    assert fills(plan) == plain_best_fit(lengths, limit)
    slack = minimum_slack(counts, limit)
    assert check_plan(slack, counts, limit) <= check_plan(plan, counts, limit) + 1
    room = rng.randint(0, limit)
    sums = {0}
    for n in lengths:
        sums |= {s + n for s in sums if s + n <= room}
    chosen = fullest(counts, room)
    assert sum(chosen) == max(sums) and not Counter(chosen) - counts


def placed_rows(docs, limit, planner):
    found = cut(pieces(docs, RANKS, PATTERN, limit), "test")
    plan = planner(length_counts(found), limit)
    return place(found, plan)


@pytest.mark.parametrize("planner", [minimum_slack, best_fit_decreasing])
def test_every_piece_is_placed_without_gap_or_overlap(spark, documents, planner):
    docs = documents(ODD + ["same text here"] * 50 + ["long " * 700]).withColumn("offset", F.lit("clash")).withColumn("piece", F.lit("clash"))
    docs = docs.union(docs.limit(1).withColumn("doc_id", F.lit(None).cast("long")))
    rows = placed_rows(docs, 64, planner).collect()
    by_sequence = defaultdict(list)
    for r in rows:
        assert len(r["ids"]) == 4 * r["length"]
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    own = encoder(RANKS, PATTERN)
    for doc_id, text in enumerate(ODD + ["same text here"] * 50 + ["long " * 700]):
        parts = sorted((r["piece"], r["start"], bytes(r["ids"])) for r in rows if r["doc_id"] == doc_id)
        assert b"".join(p[2] for p in parts) == own.encode(text or "") + bytes(4)
        assert all(len(p[2]) == 256 for p in parts[1:])
    assert placed_rows(docs.limit(0), 64, planner).count() == 0


def test_matrices_round_trip(spark, documents, tmp_path):
    docs = documents(ODD + ["long " * 300])
    placed = placed_rows(docs, 64, best_fit_decreasing)
    folder = f"file://{tmp_path}/m"
    assert write(placed, folder, 64).count() >= 1
    key = ["doc_id", "piece", "start", "length", "sequence_id", "offset", F.crc32("ids").alias("ids_crc32")]
    want = sorted(map(tuple, placed.select(*key).collect()))
    got = sorted(map(tuple, read(spark, folder).select("doc_id", "piece", "start", "length", "sequence_id", "offset", "ids_crc32").collect()))
    assert got == want
    assert written(docs.limit(0), RANKS, PATTERN, 64).count() == 0
    assert written(docs, RANKS, PATTERN, 64).count() == len(want)


def test_matrix_positions():
    raw = lambda *x: np.array(x, "<u4").tobytes()
    got = matrix([(5, [(0, 1, 0, 0, raw(7, 8)), (2, None, 0, 0, raw(9))])], 4)
    assert got["ids"].tolist() == [[7, 8, 9, 0]]
    assert got["cumulative"].tolist() == [0, 2, 3] and got["resets"].tolist() == [0, 2]
