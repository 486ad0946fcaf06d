"""Language identification by cross-parsing entropy over suffix automata."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

DOCS_PER_LANGUAGE = 60
LETTERS_PER_LANGUAGE = 40_000
BLOCK = 16_384


@lru_cache(maxsize=1)
def _fold() -> np.ndarray:
    """Code point -> lower-cased code point for letters (and marks), 0 for all else."""
    fold = np.zeros(0x110000, np.uint32)
    for code in range(0x110000):
        c = chr(code)
        if c.isalpha() or unicodedata.category(c)[0] == "M":
            low = c.lower()
            fold[code] = ord(low) if len(low) == 1 else code
    return fold


def letters(text: str) -> np.ndarray:
    """Lower-cased letters as code points; each run of other characters is one 0 (word edge)."""
    codes = _fold()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")]
    edge = codes == 0
    return codes[~(edge & np.concatenate([[False], edge[:-1]]))] if len(codes) else codes


def automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a sequence; state 0 is the start."""
    nexts: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in codes:
        new = len(nexts)
        nexts.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in nexts[p]:
            nexts[p][c] = new
            p = link[p]
        if p != -1:
            q = nexts[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                clone = len(nexts)
                nexts.append(dict(nexts[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and nexts[p].get(c) == q:
                    nexts[p][c] = clone
                    p = link[p]
                link[q] = link[new] = clone
        last = new
    return nexts


class Parser:
    """All languages' automata in one table. A step that no automaton state allows ends a
    phrase and starts the next one with the same letter, so entries hold both the next state
    and whether a phrase ended. A letter that a sample lacks ends the phrase before it and is
    part of it; with none open, it is a phrase by itself."""

    def __init__(self, samples: tuple[tuple[str, str], ...]) -> None:
        self.languages = [lang for lang, _ in samples]
        coded = [letters(text)[:LETTERS_PER_LANGUAGE].tolist() for _, text in samples]
        alphabet = sorted({c for codes in coded for c in codes})
        self.symbols = np.zeros(0x110000, np.uint16)  # 0: a letter that no sample has
        self.symbols[alphabet] = np.arange(1, len(alphabet) + 1)
        self.width = width = len(alphabet) + 1
        self.bits = np.array([np.log2(max(len(codes), 2)) for codes in coded])
        rows, self.starts = [], []
        base = 0
        for codes in coded:
            nexts = automaton(self.symbols[codes].tolist())
            start = np.full(width, base * width * 2 + 1, np.int64)  # a letter the sample lacks
            for c, state in nexts[0].items():
                start[c] = (base + state) * width * 2 + 1
            table = np.tile(start, (len(nexts), 1))
            for state, out in enumerate(nexts):
                for c, to in out.items():
                    table[state, c] = (base + to) * width * 2
            self.starts.append(base * width)
            rows.append(table)
            base += len(nexts)
        self.table = np.concatenate(rows).ravel().astype(np.int32 if base * width * 2 < 2**31 else np.int64) if rows else np.zeros(0, np.int32)

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrases of each text (rows) against each language (columns).

        Texts run side by side, one letter a step, in blocks of at most BLOCK letters; a
        phrase ends with its block, so long texts cost no more steps than short ones."""
        owner = np.concatenate([np.full(max(1, -(-len(t) // BLOCK)), k) for k, t in enumerate(texts)]) if texts else np.zeros(0, np.int64)
        start, length, at = [], [], 0
        for t in texts:
            for s in range(0, max(len(t), 1), BLOCK):
                start.append(at + s)
                length.append(min(BLOCK, len(t) - s))
            at += len(t)
        symbols = self.symbols[np.concatenate(texts)] if texts else np.zeros(0, np.uint16)
        start, length = np.array(start, np.int64), np.array(length, np.int64)
        order = np.argsort(-length, kind="stable")
        start, length = start[order], length[order]
        n = len(self.languages)
        state = np.repeat(np.array(self.starts, self.table.dtype)[:, None], len(start), 1)
        count = np.zeros((n, len(start)), np.int32)
        active = np.searchsorted(-length, -np.arange(length[0] if len(length) else 0), "left")
        for t, k in enumerate(active.tolist()):
            step = self.table[state[:, :k] + symbols[start[:k] + t]]
            count[:, :k] += step & 1
            state[:, :k] = step >> 1
        count += (length > 0)[None, :] * (count == 0)  # a block within one phrase
        out = np.zeros((len(texts), n), np.int64)
        np.add.at(out, owner[order], count.T)
        return out


@lru_cache(maxsize=2)
def parser(samples: tuple[tuple[str, str], ...]) -> Parser:
    return Parser(samples)


def learn(labelled: DataFrame, per_language: int = DOCS_PER_LANGUAGE) -> tuple[tuple[str, str], ...]:
    """(language, text) samples from rows (doc_id, lang, text): of each language the
    `per_language` documents whose hashed ids come first, cut to LETTERS_PER_LANGUAGE
    letters in all. Ids are chosen first, so that no text is sorted or shuffled."""
    known = labelled.filter("lang is not null and text is not null")
    # The rank's limit is pushed below the shuffle: every task sends `per_language` ids a language.
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    chosen = known.select("lang", "doc_id").withColumn("nth", rank).filter(F.col("nth") <= per_language).select("lang", "doc_id", "nth").distinct()
    kept = known.select("lang", "doc_id", F.left("text", F.lit(LETTERS_PER_LANGUAGE)).alias("text")).join(F.broadcast(chosen), ["lang", "doc_id"])
    rows = kept.dropDuplicates(["lang", "doc_id"]).orderBy("lang", "nth").collect()
    samples: dict[str, str] = {}
    for r in rows:
        text = samples.get(r["lang"], "")
        if len(text) < LETTERS_PER_LANGUAGE:
            samples[r["lang"]] = (text + " " + r["text"])[: 2 * LETTERS_PER_LANGUAGE]
    return tuple(sorted((lang, text) for lang, text in samples.items() if len(letters(text)) > 1))


def identify(docs: DataFrame, samples: tuple[tuple[str, str], ...]) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of rows (doc_id, text, held_out).

    The cross-parsing entropy of a text against a language is its number of phrases times
    log2 of the sample's length, per letter; the least wins, ties to the smaller name. score
    is the winner's share of the reciprocal entropies. Null text, text without a letter, and
    any text when nothing was learned are `und` with score 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = parser(samples)
        for batch in batches:
            names: list[str] = ["und"] * batch.num_rows
            scores = np.zeros(batch.num_rows)
            held: list[tuple[int, np.ndarray]] = []
            size = 0

            def settle() -> None:
                if not held or not model.languages:
                    return
                bits = model.phrases([codes for _, codes in held]) * model.bits
                best = np.argmin(bits, axis=1)
                inverse = 1 / bits
                share = inverse[np.arange(len(held)), best] / inverse.sum(axis=1)
                for (k, _), b, s in zip(held, best.tolist(), share.tolist()):
                    names[k], scores[k] = model.languages[b], s

            for k, text in enumerate(batch.column(1)):
                codes = letters(text.as_py() or "")
                if codes.any():
                    held.append((k, codes))
                    size += len(codes)
                if size > 16_000_000:
                    settle()
                    held, size = [], 0
            settle()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(names), pa.array(scores)], names=["doc_id", "held_out", "lang_pred", "score"])

    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), "held_out")
    return source.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
