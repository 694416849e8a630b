"""Removal of repeated word windows: recurring passages, confirmed and located by Aho-Corasick automata.

Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. A window is ``window`` consecutive words; a word goes if a window
over it has the same words as one that starts earlier (smaller doc_id, or same doc_id and earlier start).

1. One pass over all texts notes each text's digest and its anchors: the ``gram``-word run of least hash in each
   window (a new one every 8 words or so). Equal windows have equal anchors.
2. Exact copies of an earlier document go as a whole. Of the others, Spark counts the anchors; only windows
   whose anchor recurs can recur.
3. Those documents' stretches of windows with one recurring anchor are dealt out by the anchor. A stretch whose
   words another one of its anchor had before goes as a whole. Of the others each shard hashes all windows at once, confirms which of those with equal hashes recur, compiles them (a letter per word) into Aho-Corasick automata of bounded
   size, and streams the stretches that hold such windows through them, so that every occurrence but the first is located.
   The windows of an anchor in more than ``hot`` documents are dealt out one by one, by their own words and a
   salt of the doc_id; the first of each salt meet again by their words. So no task holds an anchor's windows
   or all copies of a window.
4. The located spans return to their documents, which drop the words and hash what is left.

Cases: a null or empty text has no words; a document of fewer than ``window`` words keeps all; a null doc_id
takes no part and keeps all its words; repeated rows (same doc_id and text) are one document and each gets its
result; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyspark.llm.common import batch_of, id_and_text, mix, ngram_hashes, slices, stored, word_hashes, word_memo

#: Words of the stretches that an automaton is compiled from at a time.
AUTOMATON_WORDS = 400_000
#: Shares that the documents of a hot window are dealt into.
SALTS = 64


def first_least(values: np.ndarray, width: int) -> np.ndarray:
    """Of each run of ``width`` neighbours: the place of the least one, the first of equal ones. Runs double until they are as wide."""
    least, places, wide = values, np.arange(len(values)), 1
    while wide < width:
        step = min(wide, width - wide)
        right = least[step:] < least[:-step]
        places = np.where(right, places[step:], places[:-step])
        least, wide = values[places], wide + step
    return places


def anchors(words: list[bytes], memo, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each window: the place of its anchor; and the hashes of all runs of ``gram`` words."""
    grams = ngram_hashes(word_hashes(words, memo), gram)
    n = len(words) - window + 1
    if n <= 0:
        return np.empty(0, dtype=np.int64), grams
    return first_least(grams, window - gram + 1), grams


def _digest(joined: bytes) -> int:
    return int.from_bytes(xxhash.xxh3_64_digest(joined), "big", signed=True)


PROFILE = pa.schema([("doc_id", pa.int64()), ("mark", pa.int64()), ("digest", pa.string()), ("n_words", pa.int64()), ("all_sha256", pa.string()), ("anchors", pa.list_(pa.int64()))])
PROFILE_SQL = "doc_id long, mark long, digest string, n_words long, all_sha256 string, anchors array<long>"


def _profile(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = word_memo()
        for batch in slices(batches):
            memo.trim()
            rows = []
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = (text or "").encode().split()
                joined = b" ".join(words)
                places, grams = anchors(words, memo, window, gram)
                own = grams[places[np.flatnonzero(np.diff(places, prepend=-1))]].view(np.int64) if doc_id is not None else ()
                sha = hashlib.sha256(joined).hexdigest()
                rows.append((doc_id, _digest(joined), sha[:32], len(words), sha, own))
            yield batch_of(PROFILE, *zip(*rows, strict=True))

    return run


BODY = pa.schema([("doc_id", pa.int64()), ("mark", pa.int64()), ("body", pa.binary())])


def _bodies(window: int):
    """The words of texts long enough, compressed: what is shuffled is a third of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)
        for batch in slices(batches):
            rows = []
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = (text or "").encode().split()
                if doc_id is not None and len(words) >= window:
                    joined = b" ".join(words)
                    rows.append((doc_id, _digest(joined), pack.compress(joined)))
            if rows:
                yield batch_of(BODY, *zip(*rows, strict=True))

    return run


STRETCH = pa.schema([("anchor", pa.int64()), ("doc_id", pa.int64()), ("mark", pa.int64()), ("pos", pa.int64()), ("words", pa.binary())])
STRETCH_SQL = "anchor long, doc_id long, mark long, pos long, words binary"


def _stretches(window: int, gram: int, single: bool = False):
    """Maximal rows of neighbouring windows that share one of the given anchors at one place; if ``single``, each window, under the hash of its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, unpack = word_memo(), zstandard.ZstdDecompressor()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                rows = []
                memo.trim()
                for doc_id, mark, body, recurring in zip(*(c.to_pylist() for c in batch.slice(at, 500).columns), strict=True):
                    words = unpack.decompress(body).split()
                    places, grams = anchors(words, memo, window, gram)
                    hashes = grams.view(np.int64)[places]
                    given = np.isin(hashes, np.array(recurring, dtype=np.int64))
                    if single:
                        parts = [(int(i), b" ".join(words[i : i + window])) for i in np.flatnonzero(given)]
                        rows += [(_digest(part), doc_id, mark, i, part) for i, part in parts]
                        continue
                    starts = np.flatnonzero(given & (np.diff(places, prepend=-1) != 0))
                    ends = np.append(np.flatnonzero(np.diff(places)), len(places) - 1)
                    ends = ends[np.searchsorted(ends, starts)]
                    rows += [(int(hashes[i]), doc_id, mark, int(i), b" ".join(words[i : j + window])) for i, j in zip(starts, ends, strict=True)]
                if rows:
                    yield batch_of(STRETCH, *zip(*rows, strict=True))

    return run


SPANS = pa.schema([("doc_id", pa.int64()), ("mark", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())])


#: Odd, so that its powers can be divided out again modulo 2 ** 64.
_BASE = 0x9E3779B97F4A7C15


_LETTERS = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


def window_hashes(data: bytes, window: int) -> np.ndarray:
    """Of words that each end with one space: a hash of each run of ``window`` words, from running sums over the bytes. Equal runs have equal ones."""
    letters = np.frombuffer(data, dtype=np.uint8)
    ends = np.flatnonzero(letters == 32)
    starts = np.concatenate(([0], ends[:-1] + 1))[: max(len(ends) - window + 1, 0)]
    power = np.multiply.accumulate(np.full(len(letters), _BASE, dtype=np.uint64))
    sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(_LETTERS[letters] * power, dtype=np.uint64)))
    back = np.multiply.accumulate(np.full(len(letters), pow(_BASE, -1, 1 << 64), dtype=np.uint64))
    return (sums[ends[window - 1 :]] - sums[starts]) * back[starts]


class Locator:
    """Locates repeated windows in stretches given in order of (anchor, doc_id, pos)."""

    def __init__(self, window: int):
        self.window, self.anchor, self.seen = window, None, {}
        self.whole_anchor, self.whole = None, {}

    def copied(self, row: tuple) -> tuple[int, int, int, int] | None:
        """The span of a stretch whose anchor had the same words at an earlier place: each of its windows is a repeat, and none is the first of its words."""
        anchor, doc_id, mark, pos, words = row
        if anchor != self.whole_anchor:
            self.whole_anchor, self.whole = anchor, {}
        if self.whole.setdefault(words, (doc_id, pos)) == (doc_id, pos):
            return None
        return doc_id, mark, pos, pos + words.count(b" ") + 1

    def _suspects(self, rows: list[tuple]) -> dict[int, list[int]]:
        """Of each row the windows that may recur: by hash, or as their anchor's rows go on before or behind the given ones."""
        sizes = np.array([r[4].count(b" ") + 1 for r in rows], dtype=np.int64)
        ends, anchor = np.cumsum(sizes), np.array([r[0] for r in rows], dtype=np.int64)
        of = np.repeat(np.arange(len(rows)), sizes)
        at = np.flatnonzero(np.arange(len(of)) + self.window <= ends[of])  # windows within one row
        of = of[at]
        keys = window_hashes(b" ".join([*(r[4] for r in rows), b""]), self.window)[at]
        keys = mix(keys + mix(anchor.view(np.uint64))[of])  # windows of different anchors differ, or are different shares of a hot window
        order = np.argsort(keys)
        same = keys[order[1:]] == keys[order[:-1]]
        suspect = (anchor == anchor[-1])[of]
        if self.anchor is not None:
            suspect |= (anchor == self.anchor)[of]
        suspect[order[1:][same]] = suspect[order[:-1][same]] = True
        out: dict[int, list[int]] = {}
        for row, k in zip(of[suspect].tolist(), (at - (ends - sizes)[of])[suspect].tolist(), strict=True):
            out.setdefault(row, []).append(k)
        return out

    def locate(self, rows: list[tuple]) -> list[tuple[int, int, int, int]]:
        window, letters, used, of = self.window, {}, 1, None
        suspects = self._suspects(rows)
        texts = {}
        recurring: dict[str, tuple[int, int]] = {}
        for row, places in suspects.items():  # in order of the rows
            anchor, doc_id, _, pos, words = rows[row]
            words = words.split(b" ")
            if anchor != of:  # a letter per distinct word of an anchor, so that no phrase is another anchor's; surrogates are no letters
                letters, used, of = {}, used + len(letters), anchor
            texts[row] = text = "".join([chr(k if k < 0xD800 else k + 0x800) for k in [letters.setdefault(w, used + len(letters)) for w in words]])
            if anchor != self.anchor:
                self.anchor, self.seen = anchor, {}
            for k in places:
                key = hashlib.blake2b(b" ".join(words[k : k + window]), digest_size=16).digest()
                where = self.seen.setdefault(key, (doc_id, pos + k))
                if where != (doc_id, pos + k):
                    recurring.setdefault(text[k : k + window], where)
        if not recurring:
            return []
        automaton = ahocorasick.Automaton()
        for phrase, where in recurring.items():
            automaton.add_word(phrase, where)
        automaton.make_automaton()
        out = []
        for row, text in texts.items():
            _, doc_id, mark, pos, _ = rows[row]
            start = stop = None
            for end, where in automaton.iter(text):
                at = pos + end - window + 1
                if where == (doc_id, at):
                    continue
                if stop is not None and at <= stop:
                    stop = at + window
                else:
                    if stop is not None:
                        out.append((doc_id, mark, start, stop))
                    start, stop = at, at + window
            if stop is not None:
                out.append((doc_id, mark, start, stop))
        return out


def _locate(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        locator, held, size = Locator(window), [], 0
        for batch in batches:
            found = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if span := locator.copied(row):
                    found.append(span)
                    continue
                held.append(row)
                size += row[4].count(b" ") + 1
                if size >= AUTOMATON_WORDS:
                    found += locator.locate(held)
                    held, size = [], 0
            if found:
                yield batch_of(SPANS, *zip(*found, strict=True))
        if held and (found := locator.locate(held)):
            yield batch_of(SPANS, *zip(*found, strict=True))

    return run


def _leading(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of single windows in order of (anchor, doc_id, pos): those at the first place of their words, under the hash of their words."""
    anchor, seen = None, {}
    for batch in batches:
        rows = []
        for at, doc_id, mark, pos, words in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if at != anchor:
                anchor, seen = at, {}
            if seen.setdefault(words, (doc_id, pos)) == (doc_id, pos):
                rows.append((_digest(words), doc_id, mark, pos, words))
        if rows:
            yield batch_of(STRETCH, *zip(*rows, strict=True))


def _sharded(stretches: DataFrame) -> DataFrame:
    return stretches.repartition("anchor").sortWithinPartitions("anchor", "doc_id", "pos")


KEPT = pa.schema([("doc_id", pa.int64()), ("mark", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])


def _drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        rows = []
        for doc_id, mark, body, spans in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            words = unpack.decompress(body).split()
            keep = np.ones(len(words), dtype=bool)
            for s in spans:
                keep[s["start"] : s["stop"]] = False
            kept = b" ".join([words[k] for k in np.flatnonzero(keep)])
            rows.append((doc_id, mark, len(words) - int(keep.sum()), hashlib.sha256(kept).hexdigest()))
        yield batch_of(KEPT, *zip(*rows, strict=True))


def remove_repeats(docs: DataFrame, *, window: int = 20, gram: int = 6, hot: int = 20_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256 (of the kept words, joined by one space)."""
    given = id_and_text(docs, id_col, text_col)
    profile = stored(given.mapInArrow(_profile(window, gram), PROFILE_SQL), "passage-anchors")
    first = profile.where("doc_id is not null").groupBy("digest", "n_words").agg(F.min("doc_id").alias("first_id"))
    judged = profile.drop("anchors").join(first, ["digest", "n_words"], "left").withColumn("copy", F.coalesce((F.col("first_id") < F.col("doc_id")) & (F.col("n_words") >= window), F.lit(False)))
    judged = stored(judged.select("doc_id", "mark", "n_words", "all_sha256", "copy"), "passage-copies")
    own = judged.where(~F.col("copy") & F.col("doc_id").isNotNull() & (F.col("n_words") >= window)).select("doc_id", "mark").distinct()
    places = profile.select("doc_id", "mark", "anchors").join(own, ["doc_id", "mark"], "left_semi").select("doc_id", F.explode("anchors").alias("anchor"))
    often = places.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1")
    anchors_if = lambda kept: F.collect_set(F.when(kept, F.col("anchor")))
    recurring = places.join(often, "anchor").groupBy("doc_id").agg(anchors_if(F.col("n") <= hot).alias("recurring"), anchors_if(F.col("n") > hot).alias("hot"))
    recurring = stored(recurring.join(own, "doc_id"), "recurring-anchors")  # at most one entry for each of a document's own anchors
    bodies = given.mapInArrow(_bodies(window), "doc_id long, mark long, body binary")
    affected = stored(bodies.join(recurring, ["doc_id", "mark"]).dropDuplicates(["doc_id", "mark"]).select("doc_id", "mark", "body", "recurring", "hot"), "passage-documents")
    spans_sql = "doc_id long, mark long, start long, stop long"
    stretches = affected.select("doc_id", "mark", "body", "recurring").mapInArrow(_stretches(window, gram), STRETCH_SQL)
    spans = _sharded(stretches).mapInArrow(_locate(window), spans_sql)
    if not recurring.where(F.size("hot") > 0).isEmpty():
        single = affected.where(F.size("hot") > 0).select("doc_id", "mark", "body", "hot").mapInArrow(_stretches(window, gram, single=True), STRETCH_SQL)
        dealt = _sharded(single.withColumn("anchor", F.xxhash64("anchor", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))))
        first_of_salt = dealt.mapInArrow(_leading, STRETCH_SQL)
        spans = spans.unionByName(dealt.mapInArrow(_locate(window), spans_sql)).unionByName(_sharded(first_of_salt).mapInArrow(_locate(window), spans_sql))
    by_doc = spans.groupBy("doc_id", "mark").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    dropped = affected.select("doc_id", "mark", "body").join(by_doc, ["doc_id", "mark"]).mapInArrow(_drop, "doc_id long, mark long, n_removed long, kept_sha256 string")
    out = judged.join(dropped, ["doc_id", "mark"], "left")
    copy = F.col("copy")
    return out.select(
        "doc_id", "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "all_sha256")).alias("kept_sha256"),
    )
