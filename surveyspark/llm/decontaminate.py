"""Benchmark decontamination: rare n-gram seeds find passages, local alignment scores them.

Texts and items are lower-cased words (``\\w+``). An item's seeds are its runs of ``n`` words. Documents that
hold two of an item's seeds near each other are candidates; the passage around them is aligned with the item
by Smith-Waterman (match 2, other word -1, gap -1), and the score is the alignment's share of the item's best
possible one. So edited or shortened copies that keep two seeds are scored like exact ones.

Spark counts over all documents how many hold each seed. Frequency only orders the work: passages with rare
seeds (at most ``over`` times as frequent as the item's median seed) are aligned first, and others only where
the words that they share with the item allow the threshold and a better score. No seed is dropped, so a row
depends on its document and item alone, not on how many documents hold the same passage.

The items go to all tasks. They are taken in blocks of ``block_bytes`` of text, with a pass over the
documents for each block, so that what is sent never grows beyond that.

Cases: null or empty texts and items match nothing, nor do items of fewer than ``n`` words; repeated rows
are scored each; an empty table on either side gives no rows; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyspark.llm.common import batch_of, id_and_text, ngram_hashes, slices, word_hashes, word_memo

_WORD = re.compile(r"\w+")
MATCH, OTHER, GAP = 2, -1, 1


def align(item: np.ndarray, passage: np.ndarray) -> int:
    """The best local alignment's score. Each row of the table is one pass: a gap along the row is a running maximum."""
    j = np.arange(len(passage), dtype=np.int64) * GAP
    row, best = np.zeros(len(passage), dtype=np.int64), 0
    for word in item:
        diagonal = np.concatenate(([0], row[:-1])) + np.where(passage == word, MATCH, OTHER)
        row = np.maximum(np.maximum(diagonal, row - GAP), 0)
        row = np.maximum.accumulate(row + j) - j
        best = max(best, int(row.max(initial=0)))
    return best


class Seeds:
    """The seeds of a block of items: sorted hashes, and where in which item each stands."""

    def __init__(self, items: list[tuple[int | None, str | None]], n: int):
        memo, self.n, self.ids, self.words = word_memo(), n, [], []
        self.vocabulary: dict[str, int] = {}
        hashes, owners, places = [], [], []
        for item_id, text in items:
            found = _WORD.findall((text or "").lower())
            words = word_hashes([w.encode() for w in found], memo)
            self.vocabulary.update(zip(found, words.tolist(), strict=True))
            grams = ngram_hashes(words, n)
            if len(grams):
                hashes.append(grams)
                owners.append(np.full(len(grams), len(self.ids)))
                places.append(np.arange(len(grams)))
                self.ids.append(item_id)
                self.words.append(words)
        flat = [np.concatenate(x) if x else np.empty(0, dtype=np.uint64) for x in (hashes, owners, places)]
        order = np.argsort(flat[0], kind="stable")
        self.hash, self.owner, self.place = flat[0][order], flat[1][order].astype(int), flat[2][order].astype(int)
        self.distinct, self.first = np.unique(self.hash, return_index=True)
        self.last = np.append(self.first[1:], len(self.hash))
        self.size = np.array([len(w) for w in self.words], dtype=int)
        self.rare = np.ones(len(self.hash), dtype=bool)

    def mark_rare(self, frequency: np.ndarray, over: float) -> None:
        """An item's rare seeds, looked at first: those that at most ``over`` times as many documents hold as its median seed."""
        own = np.repeat(frequency, self.last - self.first)
        for k in range(len(self.ids)):
            at = self.owner == k
            self.rare[at] = own[at] <= over * np.median(own[at])

    def read(self, text: str | None) -> np.ndarray:
        """The hashes of a text's words; 0 for a word that is in no item."""
        words = _WORD.findall((text or "").lower())
        return np.fromiter(map(self.vocabulary.get, words, repeat(0)), dtype=np.uint64, count=len(words))

    def held(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in the text, number of the distinct seed) of each of the text's n-grams that is a seed."""
        m = max(len(words) - self.n + 1, 0)
        known, whole = words != 0, np.ones(m, dtype=bool)
        for i in range(self.n):
            whole &= known[i : i + m]
        places = np.flatnonzero(whole)
        grams = ngram_hashes(words, self.n)[places]
        at = np.minimum(np.searchsorted(self.distinct, grams), len(self.distinct) - 1)
        same = self.distinct[at] == grams
        return places[same], at[same]


FREQ = pa.schema([("seed", pa.int64()), ("n", pa.int64())])


def _count(seeds: Seeds):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(seeds.distinct), dtype=np.int64)
        for batch in slices(batches):
            for text in batch.column(1).to_pylist():
                total[np.unique(seeds.held(seeds.read(text))[1])] += 1
        at = np.flatnonzero(total)
        yield batch_of(FREQ, at, total[at])

    return run


def bound(item: np.ndarray, passage: np.ndarray) -> int:
    """At least the best local alignment's score: on either side, a word that the other side lacks costs one."""

    def most(words: np.ndarray, other: np.ndarray) -> int:
        total = np.concatenate(([0], np.cumsum(np.where(np.isin(words, other), MATCH, max(OTHER, -GAP)))))
        return int((total - np.minimum.accumulate(total)).max())

    return min(most(passage, item), most(item, passage))


def hits(seeds: Seeds, words: np.ndarray, threshold: float, slack: int = 8) -> Iterator[tuple[int, int, int, int]]:
    """(item number, alignment score, first word, seeds) of passages that score ``threshold`` or more, those with most rare seeds first; of an item, each better than the one before."""
    places, found = seeds.held(words)
    if not len(places):
        return
    sizes = seeds.last[found] - seeds.first[found]
    at = np.repeat(seeds.first[found] - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(sizes.sum())
    text = np.repeat(places, sizes)
    order = np.lexsort((text, seeds.owner[at]))
    at, text = at[order], text[order]
    owner, own = seeds.owner[at], seeds.place[at]
    # seeds further apart than the item is long belong to different passages
    cut = (np.diff(owner) != 0) | (np.diff(text) > seeds.size[owner[1:]] + slack)
    start = np.concatenate(([0], np.flatnonzero(cut) + 1))
    group, held = np.concatenate(([0], np.cumsum(cut))), np.diff(start, append=len(at))
    width = int(seeds.size.max())
    distinct = np.bincount(np.unique(group * width + own) // width, minlength=len(start))
    low = np.maximum(np.minimum.reduceat(text - own, start) - slack, 0)
    high = np.maximum.reduceat(text - own, start) + seeds.size[owner[start]] + slack
    rare = np.add.reduceat(seeds.rare[at].astype(int), start)
    some = np.flatnonzero(distinct >= np.minimum(2, seeds.size[owner[start]] - seeds.n + 1))
    best: dict[int, tuple[int, int]] = {}
    for g in some[np.argsort(-rare[some], kind="stable")]:
        k, first = int(owner[start[g]]), int(text[start[g]])
        item, passage = seeds.words[k], words[low[g] : high[g]]
        most = bound(item, passage)
        if most < threshold * MATCH * len(item) or (k in best and (most, -first) < best[k]):
            continue
        score = align(item, passage)
        if score >= threshold * MATCH * len(item) and (k not in best or (score, -first) > best[k]):
            best[k] = (score, -first)
            yield k, score, first, int(held[g])


def matches(seeds: Seeds, words: np.ndarray, threshold: float) -> list[tuple[int, float, int, int]]:
    """(item number, score, first word, seeds) of each item whose best passage in the text scores ``threshold`` or more."""
    last = {k: (k, score / (MATCH * len(seeds.words[k])), first, held) for k, score, first, held in hits(seeds, words, threshold)}  # an item's later hit is better
    return [last[k] for k in sorted(last)]


HITS = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()), ("first_word", pa.int64()), ("n_seeds", pa.int64())])


def _score(seeds: Seeds, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows += [(doc_id, seeds.ids[k], score, start, n) for k, score, start, n in matches(seeds, seeds.read(text), threshold)]
            if rows:
                yield batch_of(HITS, *zip(*rows, strict=True))

    return run


def _blocks(docs: DataFrame, benchmark: DataFrame, item_col: str, item_text: str, n: int, over: float, block_bytes: int) -> Iterator[Seeds]:
    """The items in blocks, with their seeds counted over all documents (doc_id, text)."""
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = size // block_bytes + 1
    for part in range(parts):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).collect()
        seeds = Seeds(sorted(((r.item_id, r.text) for r in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")), n)
        if len(seeds.hash):
            counted = docs.mapInArrow(_count(seeds), "seed long, n long").groupBy("seed").agg(F.sum("n").alias("n")).collect()  # a row per seed of the block at most
            frequency = np.zeros(len(seeds.distinct))
            for r in counted:
                frequency[r.seed] = r.n
            seeds.mark_rare(frequency, over)
            yield seeds


def contaminated(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", n: int = 3, over: float = 4.0,
                 threshold: float = 0.5, block_bytes: int = 8 << 20) -> DataFrame:
    """A row for each document and item it holds: doc_id, item_id, score (0 to 1), first_word (of the first seed), n_seeds."""
    given = id_and_text(docs, id_col, text_col)
    out = docs.sparkSession.createDataFrame([], "doc_id long, item_id long, score double, first_word long, n_seeds long")
    for seeds in _blocks(given, benchmark, item_col, item_text, n, over, block_bytes):
        out = out.unionByName(given.mapInArrow(_score(seeds, threshold), "doc_id long, item_id long, score double, first_word long, n_seeds long"))
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", n: int = 3, over: float = 4.0,
                      threshold: float = 0.5, block_bytes: int = 8 << 20) -> DataFrame:
    """The documents that hold no item, with all their columns."""
    out = docs
    for seeds in _blocks(id_and_text(docs, id_col, text_col), benchmark, item_col, item_text, n, over, block_bytes):

        def run(batches: Iterator[pa.RecordBatch], seeds=seeds) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, text_col):
                texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
                yield batch.filter(pa.array([next(hits(seeds, seeds.read(t), threshold), None) is None for t in texts], pa.bool_()))

        out = out.mapInArrow(run, docs.schema)
    return out
