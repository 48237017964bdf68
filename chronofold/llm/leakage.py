"""Evaluation passages inside training text: shared runs and rare words as seeds, then Smith-Waterman alignment."""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronofold.llm.textform import words

#: Characters of items that one pass over the documents looks for; more items mean more passes, not more memory.
BLOCK_CHARS = 8_000_000
_MIX = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(ids: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of every n consecutive word numbers; equal hashes are checked by alignment."""
    if len(ids) < n:
        return np.empty(0, np.uint64)
    out = np.zeros(len(ids) - n + 1, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            x = ids[k : k + len(out)].astype(np.uint64) + np.uint64(1)
            out = (out ^ (x * _MIX)) * np.uint64(0xBF58476D1CE4E5B9)
            out ^= out >> np.uint64(29)
    return out


def _join(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([np.empty(0, np.int64), *parts])


def _inverted(lists: list[np.ndarray], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of the lists in the order of their values, and where each of ``keys`` begins in it."""
    values = np.concatenate([keys[:0], *lists])
    owner = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    order = np.argsort(values, kind="stable")
    return owner[order], np.searchsorted(values[order], keys)


def _ranges(starts: np.ndarray, which: np.ndarray) -> np.ndarray:
    """All positions of the ranges ``which`` of those that begin at ``starts``, in order."""
    lens = starts[which + 1] - starts[which]
    return np.arange(lens.sum()) + np.repeat(starts[which] - (np.cumsum(lens) - lens), lens)


class Items:
    """A block of evaluation items: their words as numbers, and what finds them in a document."""

    def __init__(self, rows: list[tuple], n: int) -> None:
        self.n, self.vocab, self.ids, self.words = n, {}, [], []
        for item_id, text in rows:
            self.ids.append(item_id)
            self.words.append(np.array([self.vocab.setdefault(w, len(self.vocab)) for w in words(text)], np.int64))

    def numbers(self, text: str) -> np.ndarray:
        get = self.vocab.get
        return np.array([get(w, -1) for w in words(text)], np.int64)

    def sharing_runs(self, ids: np.ndarray) -> set[int]:
        """The items that share ``run`` consecutive words with the document, but for equal hashes."""
        grams = gram_hashes(ids, self.run)
        lo, hi = np.searchsorted(self.runs, grams), np.searchsorted(self.runs, grams, "right")
        return {k for i in np.flatnonzero(lo < hi).tolist() for k in self.run_items[lo[i] : hi[i]].tolist()}

    def n_seeds(self, ids: np.ndarray, k: int) -> int:
        """How many of the document's n-grams the item has."""
        return int(np.isin(gram_hashes(ids, self.n), gram_hashes(self.words[k], self.n)).sum())

    def index(self, run: int, min_share: float) -> None:
        """What finds the pairs to align: the items of each ``run`` of words, and of each word that is a seed.

        An alignment gains only by matched words, so ``min_share`` of an item of n words takes ``need`` = min_share * n of them.
        Any need of n words include one of the n - need + 1 rarest, whichever order is called rare; those are the item's seeds.
        """
        self.run, self.need = run, [max(1, math.ceil(min_share * len(w) - 1e-9)) for w in self.words]
        self.bags = [np.unique(w, return_counts=True) for w in self.words]
        self.bag_words, self.bag_counts = (_join([b[i] for b in self.bags]) for i in (0, 1))
        self.bag_starts, self.needs = np.cumsum([0, *(len(b) for b, _ in self.bags)]), np.array(self.need, np.int64)
        many, self.held = np.bincount(self.bag_words, minlength=len(self.vocab)), np.zeros(len(self.vocab), np.int64)
        seeds = [np.unique(w[np.lexsort((w, many[w]))][: max(0, len(w) - need + 1)]) for w, need in zip(self.words, self.need, strict=True)]
        self.seed_items, self.seed_starts = _inverted(seeds, np.arange(len(self.vocab) + 1))
        grams = [np.unique(gram_hashes(w, run)) for w in self.words]
        self.runs = np.sort(np.concatenate([np.empty(0, np.uint64), *grams]))
        self.run_items, _ = _inverted(grams, self.runs[:0])

    def sharing_words(self, ids: np.ndarray) -> list[int]:
        """The items of whose words the document has ``need``, in any order and place."""
        own, many = np.unique(ids[ids >= 0], return_counts=True)
        items = np.unique(self.seed_items[_ranges(self.seed_starts, own)])
        if not len(items):
            return []
        at, lens = _ranges(self.bag_starts, items), self.bag_starts[items + 1] - self.bag_starts[items]
        self.held[own] = many
        common = np.add.reduceat(np.minimum(self.held[self.bag_words[at]], self.bag_counts[at]), np.cumsum(lens) - lens)
        self.held[own] = 0
        return items[common >= self.needs[items]].tolist()

    def stretches(self, ids: np.ndarray, k: int, need: int) -> list[tuple[int, int]]:
        """The stretches of a document outside of which no alignment with item ``k`` scores as much as ``need`` words.

        Such an alignment of m words leaves at most 2 * (m - need) words of the document unmatched, so it spans at most 3 n - 2 need
        words and has ``need`` of the item's words there, none of them more often than the item.
        """
        bag, counts = self.bags[k]
        width = 3 * len(self.words[k]) - 2 * need
        at = np.minimum(np.searchsorted(bag, ids), len(bag) - 1)
        pos = np.flatnonzero(bag[at] == ids)
        if len(pos) < need:
            return []
        word = at[pos]
        order = np.lexsort((pos, word))
        by, where = word[order], pos[order]
        back = np.arange(len(by)) - counts[by]
        same = (back >= 0) & (by[np.maximum(back, 0)] == by)
        # A word counts for the windows that begin after the occurrence that would make it one too many.
        after = np.maximum(np.where(same, where[np.maximum(back, 0)], -width), where - width) + width + 1
        change = np.zeros(len(ids) + width + 1, np.int64)
        np.add.at(change, after, 1)
        np.add.at(change, where + width + 1, -1)
        begins = np.flatnonzero(np.cumsum(change) >= need) - width
        if not len(begins):
            return []
        cut = np.flatnonzero(np.diff(begins) > width)
        lo, hi = begins[np.concatenate([[0], cut + 1])], begins[np.concatenate([cut, [len(begins) - 1]])] + width
        return list(zip(np.maximum(lo, 0).tolist(), hi.tolist(), strict=True))


def align(a: np.ndarray, b: np.ndarray, *, match: int = 2, mismatch: int = -1, gap: int = -1) -> tuple[int, int, int]:
    """Smith-Waterman over words: (best local score, longest common run, matched part of ``b`` in words). Unknown words (-1) match nothing."""
    col = np.arange(len(a) + 1) * -gap
    prev, runs = np.zeros(len(a) + 1, np.int64), np.zeros(len(a) + 1, np.int64)
    score = longest = covered = 0
    for w in b:
        same = a == w
        cur = np.zeros(len(a) + 1, np.int64)
        cur[1:] = np.maximum(prev[:-1] + np.where(same, match, mismatch), prev[1:] + gap)
        cur = np.maximum(cur, 0)
        cur = np.maximum.accumulate(cur + col) - col  # gaps along the document
        runs[1:] = np.where(same, runs[:-1] + 1, 0)
        covered += bool(same.any())
        score, longest, prev = max(score, int(cur.max())), max(longest, int(runs.max())), cur
    return score, longest, covered


def find_leaks(docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", run: int = 8, seed: int = 4, min_share: float = 0.5, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, item_id, n_seeds, longest_run, score, share) of the documents that hold a part of an item.

    A pair comes out if document and item share ``run`` consecutive words, or if their alignment
    score reaches ``min_share`` of the item's own. Both are whole, whatever else the corpus holds: the pairs
    to align share a run, or as many words as such a score takes. ``n_seeds`` counts the document's runs of
    ``seed`` words that the item has; it is 0 for a copy edited more densely. Items are taken in blocks of
    ``block_chars`` characters, each against all documents in one pass; no document is shuffled. Null or wordless
    texts share nothing. Repeated documents come out each with its own id; rows that repeat id and text come out once each.
    """
    spark = docs.sparkSession
    size = items.agg(F.coalesce(F.sum(F.length(item_text)), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(size / block_chars))
    kinds = dict(docs.dtypes)[doc_id], dict(items.dtypes)[item_id]
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, n_seeds int, longest_run int, score int, share double"
    slim = docs.where(F.col(text).isNotNull()).select(F.col(doc_id).alias("d"), F.col(text).alias("t"))
    asked = items.where(F.col(item_text).isNotNull()).select(F.col(item_id).alias("i"), F.col(item_text).alias("t"))
    out = spark.createDataFrame([], schema)
    for k in range(blocks):
        mine = asked if blocks == 1 else asked.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == k)
        block = Items([tuple(r) for r in mine.collect()], seed)
        block.index(run, min_share)
        part = slim.mapInPandas(_aligner(block, min_share), schema)
        out = part if k == 0 else out.unionByName(part)
    return out


def _aligner(block: Items, min_share: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for d, t in zip(b["d"], b["t"], strict=True):
                ids = block.numbers(t)
                same_run = block.sharing_runs(ids)
                for k in sorted(same_run.union(block.sharing_words(ids))):
                    item, need = block.words[k], block.need[k]
                    score = longest = 0
                    for lo, hi in block.stretches(ids, k, min(need, block.run) if k in same_run else need):
                        s, r, _ = align(ids[lo:hi], item)
                        score, longest = max(score, s), max(longest, r)
                    share = score / (2 * len(item))
                    if longest >= block.run or share >= min_share:
                        rows.append((d, block.ids[k], block.n_seeds(ids, k), longest, score, share))
            yield pd.DataFrame(rows, columns=["doc_id", "item_id", "n_seeds", "longest_run", "score", "share"])

    return run
