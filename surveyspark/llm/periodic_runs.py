"""Periodic run detection (12) by recursive frequency splitting and a lag scan of what is left.

Each word of a run stands in it at least twice (it is as long as two periods). So a word that occurs once in a segment
lies in no run of that segment and splits it; segments too short for a run go; this repeats until nothing splits. Whole
batches are split at once: a round is one sort of (segment, word). Runs lie whole in the segments left, which are scanned
lag by lag: all lags below ``2 * SHORT``, and beyond them, for lags from 2g to 4g, those at which a block of g words (every
g-th place) occurs again; as many words in a row agree, so each run holds such a block. Documents are independent: one
pass over the table, nothing is shuffled."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from surveyspark.llm.common import _U, batch_of, id_and_text, mix, ngram_hashes, slices

#: Least length of a run in words, and least number of its periods.
LEAST, TIMES = 12, 2

#: Words of the shortest block that stands for long lags: half of LEAST, so that all lags below LEAST are scanned.
SHORT = LEAST // TIMES

RUNS_SCHEMA = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
_SCHEMA = pa.schema([("doc_id", pa.int64()), *[(c, pa.int64()) for c in ("n_runs", "start", "length", "period", "exponent_milli")], ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())])


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """Places of the words to read for a document whose tail is made periodic; None if it stays as it is."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or n == 0:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.concatenate([np.arange(a), a + np.arange(n - a) % p])


def segments(ids: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, segment of each): the words that may stand in a run, by rounds of splitting at words that occur once in their segment."""
    live, seg = np.arange(len(ids)), doc.astype(np.int64)
    words = int(ids.max()) + 1 if len(ids) else 1
    while True:
        sizes = np.bincount(seg, minlength=1)
        keep = sizes[seg] >= LEAST
        live, seg = live[keep], seg[keep]
        if not len(live):
            return live, seg
        _, place, counts = np.unique(seg * words + ids[live], return_inverse=True, return_counts=True)
        often = counts[place] >= TIMES
        done = often.all()
        live, seg = live[often], seg[often]
        new = np.empty(len(live), dtype=bool)
        if len(live):
            new[0] = False
            new[1:] = (live[1:] != live[:-1] + 1) | (seg[1:] != seg[:-1])
        seg = np.cumsum(new)
        if done:
            return live, seg


class Scanner:
    """Runs (start, end, period) in ``words``, segment by segment; ``seg`` ascends. Places are those in ``words``."""

    def __init__(self, words: np.ndarray, seg: np.ndarray):
        self.words, self.seg = words, seg
        sizes = np.bincount(seg) if len(seg) else np.zeros(1, dtype=np.int64)
        self.sizes = sizes[seg] if len(seg) else sizes[:0]
        self.ends = np.cumsum(sizes)
        self.found: dict[tuple[int, int], int] = {}
        self.last = (0, 0)  # lag and end of the last stretch that was extended

    def add(self, start: int, end: int, lag: int) -> None:
        """A stretch with a smaller period is that period's run, found before: lags ascend."""
        if end - start >= max(LEAST, TIMES * lag):
            self.found.setdefault((start, end), lag)

    def scan(self) -> dict[tuple[int, int], int]:
        longest = int(self.sizes.max()) if len(self.sizes) else 0
        for lag in range(1, min(TIMES * SHORT, longest)):
            self.short_lag(lag)
        g, hashes = SHORT, None
        while 2 * TIMES * g <= longest:
            hashes = self.blocks(g, hashes)
            for lag, at in self.proposed(g, hashes):
                self.extend(lag, at)
            g *= 2
        return self.found

    def short_lag(self, lag: int) -> None:
        w, s = self.words, self.seg
        same = np.zeros(len(w) - lag + 2, dtype=np.int8)
        same[1:-1] = (w[lag:] == w[:-lag]) & (s[lag:] == s[:-lag])
        turn = np.diff(same)
        starts, ends = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)
        for k in np.flatnonzero(ends - starts + lag >= max(LEAST, TIMES * lag)):
            self.add(int(starts[k]), int(ends[k]) + lag, lag)

    def blocks(self, g: int, half: np.ndarray | None) -> np.ndarray:
        """Hash of the g words from each place on, from the hashes of half as many."""
        if half is None:
            return ngram_hashes(mix(self.words.astype(_U) + _U(1)), g)
        h = g // 2
        return mix(half[: len(half) - h] * _U(0xD6E8FEB86659FD93) + half[h:])

    def proposed(self, g: int, hashes: np.ndarray) -> Iterator[tuple[int, int]]:
        """(lag, place) in ascending order: blocks of g words that stand again 2g to 4g - 1 words on, in segments long enough
        for such a run. Pairs inside a known run whose period divides the lag are that run, and left out."""
        m = len(hashes)
        at = np.flatnonzero((self.sizes[:m] >= 2 * TIMES * g) & (self.seg[:m] == self.seg[g - 1 : g - 1 + m]))
        if not len(at):
            return
        _, group = np.unique(hashes[at], return_inverse=True)
        wide = np.int64(len(self.words) + 4 * g + 1)
        order = np.argsort(group, kind="stable")
        keys, places = (group * wide + at)[order], at[order]
        own = (group * wide + at)[at % g == 0]
        first = at[at % g == 0]
        lo, hi = np.searchsorted(keys, own + 2 * g), np.searchsorted(keys, own + 4 * g)
        runs = sorted((s, e, p) for (s, e), p in self.found.items())
        starts = np.array([r[0] for r in runs], dtype=np.int64)
        reach = np.maximum.accumulate([r[1] for r in runs]) if runs else np.zeros(0, dtype=np.int64)
        period = np.zeros(len(runs), dtype=np.int64)
        for k, r in enumerate(runs):
            period[k] = r[2] if reach[k] == r[1] and (k == 0 or reach[k - 1] < r[1]) else period[k - 1]
        out = []
        step = max(1, (1 << 21) // (2 * g))
        for b in range(0, len(own), step):  # so many blocks at a time, for bounded memory
            n = hi[b : b + step] - lo[b : b + step]
            if not n.sum():
                continue
            i = np.repeat(first[b : b + step], n)
            j = places[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo[b : b + step], n)]
            ok = self.seg[i] == self.seg[j]
            if runs:
                k = np.searchsorted(starts, i, side="right") - 1
                known = (k >= 0) & (reach[k] >= j + g)
                known &= (j - i) % np.where(known, period[k], 1) == 0
                ok &= ~known
            out.append(np.stack([j[ok] - i[ok], i[ok]]))
        if out:
            pairs = np.concatenate(out, axis=1)
            for k in np.lexsort((pairs[1], pairs[0])):
                yield int(pairs[0, k]), int(pairs[1, k])

    def extend(self, lag: int, at: int) -> None:
        """The stretch of lag ``lag`` that holds ``at``, if it was not found from an earlier place."""
        if self.last[0] == lag and at < self.last[1]:
            return
        w, end = self.words, int(self.ends[self.seg[at]])
        begin = end - int(self.sizes[at])
        right = self.agree(w[at : end - lag], w[at + lag : end])
        left = self.agree(w[begin:at][::-1], w[begin + lag : at + lag][::-1])
        self.last = (lag, at + right)
        self.add(at - left, at + right + lag, lag)

    @staticmethod
    def agree(a: np.ndarray, b: np.ndarray) -> int:
        """Number of leading places where both agree."""
        k, step = 0, 64
        while k < len(a):
            differ = a[k : k + step] != b[k : k + step]
            if differ.any():
                return k + int(differ.argmax())
            k, step = k + step, step * 2
        return len(a)


def find_runs(docs: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of each document (its words as numbers), by start, then period."""
    lengths = np.array([len(d) for d in docs], dtype=np.int64)
    begins = np.cumsum(lengths) - lengths
    ids = np.concatenate(docs) if docs else np.empty(0, dtype=np.int64)
    doc = np.repeat(np.arange(len(docs)), lengths)
    live, seg = segments(ids, doc)
    out: list[list[tuple[int, int, int]]] = [[] for _ in docs]
    for (start, end), period in Scanner(ids[live], seg).scan().items():
        d = int(doc[live[start]])
        out[d].append((int(live[start] - begins[d]), end - start, period))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def describe(doc_id: int | None, words: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
    """A result row; a word that any run holds after its first period is dropped."""
    kept = words
    best: tuple = (None, None, None, None)
    if runs:
        marks = np.zeros(len(words) + 1, dtype=np.int64)
        for start, length, period in runs:
            marks[start + period] += 1
            marks[start + length] -= 1
        kept = [words[i] for i in np.flatnonzero(np.cumsum(marks[:-1]) == 0)]
        start, length, period = min(runs, key=lambda r: (-r[1], r[0], r[2]))
        best = (start, length, period, 1000 * length // period)
    text = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
    return (doc_id, len(runs), *best, hashlib.sha256(text.encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest())


def periodic_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", plant: bool = False) -> DataFrame:
    """Per row: doc_id, n_runs, the longest run (start, length, period, exponent_milli), runs_sha256, collapsed_sha256.

    ``plant`` first makes the tail of a tenth of the documents periodic (``planted``), by their ids; a null id plants
    nothing. Null and empty texts have no words and no runs (nulls, and hashes of nothing); very long texts are read
    whole, in time about linear in their words; repeated rows are judged one by one; an empty table gives no rows;
    further columns are not read."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            doc_ids, texts, vocabulary, numbers = batch.column(0).to_pylist(), [], {}, []
            for doc_id, text in zip(doc_ids, batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                words = (text or b"").split()
                there = planted(doc_id, len(words)) if plant else None
                if there is not None:
                    words = [words[i] for i in there]
                texts.append(words)
                numbers.append(np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words], dtype=np.int64))
            rows = [describe(*x) for x in zip(doc_ids, texts, find_runs(numbers), strict=True)]
            yield batch_of(_SCHEMA, *zip(*rows, strict=True))

    return id_and_text(df, id_col, text_col).mapInArrow(work, RUNS_SCHEMA)
