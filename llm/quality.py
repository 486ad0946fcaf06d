"""Quality classifier: ordinal cumulative-link regression on hashed text features."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import islice
from math import fsum
from operator import eq
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import membership

SLOTS = 1 << 18
GROUP_ROWS = 10_000
LEAST_ROWS = 5
LEAST_EVIDENCE = 3.0
CACHED_TOKENS = 150_000
STEM = 4
_LETTERS = re.compile(r"[^\W\d_]+")
_RUN = re.compile(r"(.)\1+", re.DOTALL)
_WORD = zlib.crc32(b"w")


def _slot(kind: str, name: str) -> int:
    return zlib.crc32((kind + name).encode("utf-8", "surrogatepass")) % SLOTS


@lru_cache(CACHED_TOKENS)
def _common_slot(kind: str, name: str) -> int:
    return _slot(kind, name)


def _word_slots(word: str) -> tuple[int, ...]:
    """The word and, in a longer one, its stem: forms too rare to be known share it."""
    own = zlib.crc32(word.encode("utf-8", "surrogatepass"), _WORD) % SLOTS
    return (own, _common_slot("p", word[:STEM])) if len(word) > STEM else (own,)


def _parts(token: str) -> tuple[int, tuple[int, ...]]:
    """The slot of a token's shape and those of its lower-cased words. The shape has upper-case
    letters as A, others as a, digits as 0, and runs merged."""
    # Most tokens are a word, or a word and one mark.
    last = token[-1]
    word, mark = (token, "") if last.isalpha() or last.isdigit() else (token[:-1], last)
    if word.isalpha():
        if word.islower():
            return _common_slot("s", "a" + mark), _word_slots(word)
        if word.istitle() and len(word) > 1:
            return _common_slot("s", "Aa" + mark), _word_slots(word.lower())
    marks = "".join("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in token)
    return _common_slot("s", _RUN.sub(r"\1", marks)), tuple(s for w in _LETTERS.findall(token.lower()) for s in _word_slots(w))


class _Tokens(dict):
    """Token -> its `_parts`, of its words' slots only those in `known`, if given; bounded."""

    def __init__(self, known: frozenset[int] | None = None):
        self.known = known

    def __missing__(self, token: str) -> tuple[int, tuple[int, ...]]:
        found = _parts(token)
        if self.known is not None:
            found = found[0], () if self.known.isdisjoint(found[1]) else tuple(s for s in found[1] if s in self.known)
        if len(self) < CACHED_TOKENS:
            self[token] = found
        return found


_TOKENS = _Tokens()


def _read(text: str, known: _Tokens) -> tuple[set[int], list[tuple[int, float]]]:
    """Slots of the words and stems of a whole text, and (slot, square root of a share) of each
    word shape, of words equal to the one before, and of different words among all."""
    tokens = text.split()
    if not tokens:
        return set(), []
    counts = Counter(tokens)
    shapes: dict[int, int] = {}
    words: set[int] = set()
    for token, n in counts.items():
        shape, slots = known[token]
        shapes[shape] = shapes.get(shape, 0) + n
        if slots:
            words.update(slots)
    total = len(tokens)
    same = sum(map(eq, tokens, islice(tokens, 1, None)))
    shares = [*shapes.items(), (_slot("x", "same"), same), (_slot("x", "different"), len(counts)), (_slot("x", "top"), max(counts.values()))]
    return words, [(slot, 3 * (n / total) ** 0.5) for slot, n in shares]


def features(text: str) -> dict[int, float]:
    """Hashed features of a whole text: 1 for a word or stem it has, and the shares of `_read`."""
    words, shares = _read(text, _TOKENS)
    out = dict.fromkeys(words, 1.0)
    for slot, share in shares:
        out[slot] = out.get(slot, 0.0) + share
    return out


def _telling(slots: np.ndarray, values: np.ndarray, row_grades: np.ndarray, grades: np.ndarray) -> np.ndarray:
    """Slots in LEAST_ROWS rows or more whose correlation with the grade is LEAST_EVIDENCE
    standard errors from 0; all others keep weight 0, so long texts gather no noise."""
    n = max(len(grades), 1)
    times = np.bincount(slots, minlength=SLOTS)
    total = np.bincount(slots, values, minlength=SLOTS)
    spread = np.bincount(slots, values**2, minlength=SLOTS) / n - (total / n) ** 2
    mean = grades.mean() if len(grades) else 0.0
    shared = np.bincount(slots, values * (row_grades - mean), minlength=SLOTS) / n
    scale = np.sqrt(np.maximum(spread, 1e-12)) * max(grades.std() if len(grades) else 0.0, 1e-6)
    return (times >= LEAST_ROWS) & (np.abs(shared) * n**0.5 >= LEAST_EVIDENCE * scale)


class Model(NamedTuple):
    """P(grade <= k) = 1 / (1 + exp(score - thresholds[k])); weights are shared by all grades."""

    weights: np.ndarray
    thresholds: np.ndarray

    def scorer(self) -> Callable[[str], np.ndarray]:
        """P(grade > k) of a text for every threshold k; only words with a weight are looked at."""
        at = np.flatnonzero(self.weights)
        weights = dict(zip(at.tolist(), self.weights[at].tolist()))
        known = _Tokens(frozenset(weights))

        def tails(text: str) -> np.ndarray:
            words, shares = _read(text, known)
            score = fsum(map(weights.__getitem__, words)) + fsum(weights.get(slot, 0.0) * share for slot, share in shares)
            return 1 / (1 + np.exp(np.clip(self.thresholds - score, -50, 50)))

        return tails


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of the runs of `values` that begin at `starts`, none of which is empty."""
    return np.add.reduceat(values, starts) if len(starts) else np.zeros(0)


def fit(slots: np.ndarray, values: np.ndarray, sizes: np.ndarray, grades: np.ndarray, levels: int, rounds: int = 300, ridge: float = 0.1) -> Model:
    """Penalised maximum likelihood by Adam; row k has the next sizes[k] slots and values.
    Thresholds are a first value and positive steps, so they stay ordered. Slots that tell
    nothing are left out of the arrays; entries lie once by row and once by slot."""
    rows = len(sizes)
    row = np.repeat(np.arange(rows, dtype=np.int32), sizes)
    telling = _telling(slots, values, grades[row] if rows else grades, grades)
    at = np.flatnonzero(telling)
    kept = telling[slots]
    place = np.zeros(SLOTS, np.int32)
    place[at] = np.arange(len(at))
    slots, values, row = place[slots[kept]], values[kept].astype(np.float64), row[kept]
    order = np.argsort(slots, kind="stable")
    values_by_slot, row_by_slot = values[order], row[order]
    slot_starts = np.searchsorted(slots[order], np.arange(len(at)))
    full, row_starts = np.unique(row, return_index=True)
    n = max(rows, 1)
    share = np.bincount(grades, minlength=levels) / n if len(grades) else np.ones(levels) / levels
    below = np.cumsum(share)[:-1].clip(0.5 / n, 1 - 0.5 / n) if len(grades) else np.full(levels - 1, 0.5)
    start = np.log(below / (1 - below))
    steps = np.log(np.maximum(np.diff(start), 1e-2))
    words = len(at)
    theta = np.concatenate([np.zeros(words), [start[0]], steps])
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    # Rare grades count as much as half of their even share would.
    cost = ((1 / np.maximum(share, 1 / n)) ** 0.5)[grades]
    cost = cost / max(cost.mean(), 1e-12) if len(grades) else cost
    score = np.zeros(rows)
    for t in range(1, rounds + 1 if rows else 1):
        w = theta[:words]
        cuts = np.concatenate([[-np.inf], theta[words] + np.concatenate([[0], np.cumsum(np.exp(theta[words + 1 :]))]), [np.inf]])
        score[full] = _sums(values * w[slots], row_starts)
        upper = 1 / (1 + np.exp(np.clip(score - cuts[grades + 1], -50, 50)))
        lower = 1 / (1 + np.exp(np.clip(score - cuts[grades], -50, 50)))
        p = np.maximum(upper - lower, 1e-9)
        du, dl = upper * (1 - upper), lower * (1 - lower)
        d_score = cost * (du - dl) / p / n
        g = np.zeros_like(theta)
        g[:words] = _sums(values_by_slot * d_score[row_by_slot], slot_starts) + ridge * w / n
        for k in range(levels - 1):
            d_cut = (-(cost * du / p)[grades == k].sum() + (cost * dl / p)[grades == k + 1].sum()) / n
            g[words] += d_cut
            for j in range(k):
                g[words + 1 + j] += d_cut * np.exp(theta[words + 1 + j])
        mean = 0.9 * mean + 0.1 * g
        square = 0.99 * square + 0.01 * g * g
        rate = 0.2 * (1 - 0.95 * t / rounds)
        theta = theta - rate * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.99**t)) + 1e-8)
    weights = np.zeros(SLOTS)
    weights[at] = theta[:words]
    return Model(weights, theta[words] + np.concatenate([[0], np.cumsum(np.exp(theta[words + 1 :]))]))


def grade(quality: Column, toxic: Column) -> Column:
    """0: poor; 1: good prose with toxic words; 2: good and clean. Null if quality is null."""
    return F.when(quality.isNull(), None).when(quality == 0, 0).when(F.coalesce(toxic, F.lit(0)) == 1, 1).otherwise(2)


def train(docs: DataFrame, ratings: DataFrame, levels: int = 3, rows: int = GROUP_ROWS) -> Model:
    """Fit on every rated document (ratings: doc_id, grade). They are dealt by hash to groups
    of about `rows`; a task fits a model to each whole group, and the model is the mean of the
    groups' weights and thresholds, each counted by its rows: what a group's model owes to
    chance cancels out. Only weights reach the driver."""
    rated = ratings.filter(f"doc_id is not null and grade between 0 and {levels - 1}").groupBy("doc_id").agg(F.min("grade").cast("int").alias("grade"))
    groups = max(1, -(-docs.select("doc_id").join(rated, "doc_id", "left_semi").count() // rows))
    # Texts are moved once: a rating goes to its group and meets its text there.
    near = membership(docs.select("doc_id", "text").filter("text is not null"), "doc_id", rated.select("doc_id")).filter("maybe")
    both = rated.select("doc_id", F.lit(None).cast("string").alias("text"), "grade").unionByName(near.select("doc_id", "text", F.lit(None).cast("int").alias("grade")))
    sample = both.withColumn("group", F.pmod(F.xxhash64("doc_id"), F.lit(groups)).cast("int"))

    def learn(held: list[tuple[np.ndarray, np.ndarray, int]]) -> pa.RecordBatch:
        sizes = np.array([len(s) for s, _, _ in held], np.int64)
        slots, values = (np.concatenate([h[k] for h in held]) for k in (0, 1))
        model = fit(slots, values, sizes, np.array([g for _, _, g in held], np.int64), levels)
        at = np.flatnonzero(model.weights)
        theta = np.concatenate([model.weights[at], model.thresholds, [1.0]]) * len(held)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([at, SLOTS + np.arange(levels)])), pa.array(theta)], names=["at", "value"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, open_group, rating = [], None, (None, None)
        for batch in batches:
            for number, doc_id, text, level in zip(*(c.to_pylist() for c in batch.columns)):
                if text is None:
                    rating = doc_id, level
                    continue
                if doc_id != rating[0]:
                    continue
                # A group that repeated ids swell is fitted in parts.
                if held and (number != open_group or len(held) >= 2 * rows):
                    yield learn(held)
                    held = []
                open_group = number
                # Arrays take a tenth of what thousands of dicts would hold until the fit.
                found = features(text)
                held.append((np.fromiter(found, np.int32, len(found)), np.fromiter(found.values(), np.float32, len(found)), rating[1]))
        if held:
            yield learn(held)

    # A rating comes before the texts of its document.
    ordered = sample.repartitionById(groups, "group").sortWithinPartitions("group", "doc_id", F.col("text").isNotNull(), F.xxhash64("text"))
    dealt = ordered.select("group", "doc_id", "text", "grade")
    # Added in order of their size, the groups' values give the same sum in every run.
    total = F.expr("aggregate(array_sort(collect_list(value)), 0D, (a, x) -> a + x)")
    got = dealt.mapInArrow(run, "at long, value double").groupBy("at").agg(total.alias("value")).toArrow()
    if not got.num_rows:
        return fit(*(np.zeros(0, np.int64) for _ in range(4)), levels)
    theta = np.zeros(SLOTS + levels)
    theta[got.column("at").to_numpy()] = got.column("value").to_numpy()
    theta /= theta[-1]
    return Model(theta[:SLOTS], theta[SLOTS:-1])


def score(docs: DataFrame, model: Model, least_tail: float = 0.5) -> DataFrame:
    """`docs` with expected_grade, p_top (probability of the top grade) and keep
    (p_top >= least_tail). Null or blank text has nothing to grade: null scores, keep false.
    Other columns, of any name but these three, pass through."""
    added = ["expected_grade", "p_top", "keep"]
    docs = docs.drop(*added)
    fields = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tails_of = model.scorer()
        for batch in batches:
            expected, top = [], []
            for text in batch.column(at):
                text = text.as_py()
                tails = tails_of(text) if text and not text.isspace() else None
                expected.append(None if tails is None else float(tails.sum()))
                top.append(None if tails is None else float(tails[-1]))
            columns = [*batch.columns, pa.array(expected, pa.float64()), pa.array(top, pa.float64()), pa.array([p is not None and p >= least_tail for p in top], pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, *added])

    return docs.mapInArrow(run, f"{fields}, expected_grade double, p_top double, keep boolean")
