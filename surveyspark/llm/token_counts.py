"""Token counts of whole texts, huge ones by overlapping chunks.

A text of up to ``huge_chars`` characters is counted in one piece. A longer one is cut into chunks of
``chunk_chars``; each chunk is encoded with ``overlap`` characters of the next one, and Spark joins the
token boundaries (offset, next token) that two neighbouring chunks report for their common stretch.
Where both have a boundary at the same offset and the same token after it, the splice is proven: of a
merge-type encoding every two neighbouring tokens stand side by side in some valid encoding, and then
the whole is the one valid encoding. Documents of which a seam finds no such boundary are encoded again
with a wider overlap, at last in one piece.

Cases: null and empty texts count 0 bytes and 0 tokens; rows repeat as given; an empty table gives an
empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyspark.llm.common import Memo, batch_of, id_and_text, slices, stored
from surveyspark.llm.pieces import MARK, Pieces


class LibraryCounter:
    """Token counts by the sentencepiece library. Words, which no merge leaves, are encoded once and kept."""

    def __init__(self, path: str, limit: int = 1_000_000):
        self.pieces = Pieces(path)
        self.counts = Memo(int, limit)

    def _learn(self, runs: list[str]) -> None:
        # the library puts a word mark in front of what it encodes: each run goes without its first one
        alone = [r for r in runs if r != MARK]
        for r, ids in zip(alone, self.pieces.sp.encode([r[1:] for r in alone], num_threads=1), strict=True):
            self.counts[r] = len(ids)
        self.counts[MARK] = 1

    def count(self, texts: list[str]) -> list[int]:
        self.counts.trim()
        split = [self.pieces.runs(t) if t else [] for t in texts]
        new = {r for runs in split for r in runs if r not in self.counts}
        if new:
            self._learn(list(new))
        return [sum(map(self.counts.__getitem__, runs)) for runs in split]


COUNTS = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])


def _count_whole(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = LibraryCounter(path)
        for batch in slices(batches):
            ids, texts, sizes = (c.to_pylist() for c in batch.columns)
            yield batch_of(COUNTS, ids, sizes, counter.count([t or "" for t in texts]))

    return run


def token_spans(pieces: Pieces, text: str) -> list[tuple[int, int, int]]:
    """(start, id, end) of each token, in characters. The first one's leading word mark lies before the text; of a byte-coded character the first byte's token spans it, the others nothing."""
    out, pos, by_byte = [], -1, {i: b for b, i in pieces.bytes.items()}
    for i in pieces.sp.encode(text):
        b = by_byte.get(i)
        size = len(pieces.text[i]) if b is None else b & 0xC0 != 0x80
        out.append((pos, i, pos + size))
        pos += size
    return out


_EDGE = pa.struct([("off", pa.int64()), ("id", pa.int32()), ("end", pa.int64()), ("idx", pa.int64())])
CHUNKS = pa.schema([("doc_id", pa.int64()), ("hash", pa.int64()), ("size", pa.int64()), ("chunk", pa.int64()), ("n", pa.int64()), ("left", pa.list_(_EDGE)), ("right", pa.list_(_EDGE))])


def _encode_chunks(path: str, chunk_chars: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(path)
        for batch in slices(batches):
            rows = []
            for doc_id, mark, size, chunk, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                spans, base = token_spans(pieces, text), chunk * chunk_chars
                left, right = [], []
                for k, (start, i, end) in enumerate(spans):
                    if end == start or start < 0:
                        continue  # inside a character, or with the chunk's own word mark
                    edge = {"off": base + start, "id": i, "end": base + end, "idx": k}
                    if chunk and start < overlap:
                        left.append(edge)
                    if start >= chunk_chars:
                        right.append(edge)
                rows.append((doc_id, mark, size, chunk, len(spans), left, right))
            yield batch_of(CHUNKS, *zip(*rows, strict=True))

    return run


KEY = ["doc_id", "hash", "size"]


def _spliced(huge: DataFrame, path: str, chunk_chars: int, overlap: int) -> DataFrame:
    """Of each huge text: ``n_tokens``, null where a seam has no proven boundary at this overlap."""
    # one pass cuts a text into pieces; a chunk is a piece and the beginning of the next (the overlap is shorter than one)
    pieces = huge.select(*KEY, F.regexp_extract_all("text", F.lit("(?s).{1,%d}" % chunk_chars), F.lit(0)).alias("pieces"))
    chunked = F.expr(f"transform(pieces, (p, i) -> concat(p, substring(coalesce(get(pieces, i + 1), ''), 1, {overlap})))")
    rows = pieces.select(*KEY, F.posexplode(chunked).alias("chunk", "text")).withColumn("chunk", F.col("chunk").cast("long"))
    coded = stored(rows.mapInArrow(_encode_chunks(path, chunk_chars, overlap), "doc_id long, hash long, size long, chunk long, n long, `left` array<struct<off:long,id:int,end:long,idx:long>>, `right` array<struct<off:long,id:int,end:long,idx:long>>"), "token-chunks")
    none = F.lit(None).cast("long")
    # seam k lies between chunk k-1 (its right edge) and chunk k (its left edge)
    edges = coded.select(*KEY, (F.col("chunk") + 1).alias("seam"), F.explode("right").alias("e"), F.col("e.idx").alias("before"), none.alias("after")).unionByName(
        coded.select(*KEY, F.col("chunk").alias("seam"), F.explode("left").alias("e"), none.alias("before"), F.col("e.idx").alias("after"))
    )
    common = edges.groupBy(*KEY, "seam", "e.off", "e.id", "e.end").agg(F.max("before").alias("before"), F.max("after").alias("after")).where("before is not null and after is not null")
    seams = common.groupBy(*KEY, "seam").agg(F.min_by(F.struct("before", "after"), "off").alias("at"))
    # a document's tokens: each chunk's, less what its left neighbour has already and what its right neighbour takes over
    parts = coded.groupBy(*KEY, "chunk").agg(F.max("n").alias("n")).select(*KEY, F.col("chunk").alias("seam"), "n", F.lit(None).cast("struct<before:long,after:long>").alias("at"))
    every = parts.unionByName(seams.select(*KEY, "seam", none.alias("n"), "at")).groupBy(*KEY, "seam").agg(F.max("n").alias("n"), F.max("at").alias("at"))
    last = every.groupBy(*KEY).agg(F.max(F.when(F.col("n").isNotNull(), F.col("seam"))).alias("last"), F.count("at").alias("found"), F.sum("at.before").alias("before"), F.sum("at.after").alias("after"),
                                   F.max_by("n", F.when(F.col("n").isNotNull(), F.col("seam"))).alias("tail"))
    total = F.coalesce(F.col("before"), F.lit(0)) - F.coalesce(F.col("after"), F.lit(0)) + F.col("tail")
    return last.select(*KEY, F.when(F.col("found") == F.col("last"), total).alias("n_tokens"))


def token_counts(docs: DataFrame, path: str, *, limit: int = 4096, huge_chars: int = 32768, chunk_chars: int = 16384, overlap: int = 256, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > ``limit``)."""
    given = id_and_text(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    sized = given.withColumn("n_bytes", F.octet_length("text").cast("long"))
    small = sized.where(F.length("text") <= huge_chars).select("doc_id", "text", "n_bytes").mapInArrow(_swap(path), "doc_id long, n_bytes long, n_tokens long")
    huge = stored(sized.where(F.length("text") > huge_chars).withColumns({"hash": F.xxhash64("text"), "size": F.col("n_bytes")}), "huge-texts")
    texts, pending, done = huge.select(*KEY, "text"), huge.select(*KEY, "text"), []
    while overlap < chunk_chars and not pending.isEmpty():
        got = stored(_spliced(pending, path, chunk_chars, overlap), "token-splices")
        done.append(got.where("n_tokens is not null"))
        left = got.where("n_tokens is null").select(*[F.col(c).alias(f"{c}_") for c in KEY])
        if left.isEmpty():
            pending = left
            break
        pending = stored(texts.join(left, F.expr("doc_id <=> doc_id_ and hash = hash_ and size = size_"), "left_semi"), "token-pending")
        overlap *= 8
    else:
        if not pending.isEmpty():  # no seam that can be proven: these are counted in one piece
            texts_left = pending.select(F.col("hash").alias("doc_id"), "text", "size")  # a count depends on the text alone
            whole = stored(texts_left.mapInArrow(_swap(path), "doc_id long, n_bytes long, n_tokens long"), "token-whole")
            counts = whole.groupBy(F.col("doc_id").alias("hash"), F.col("n_bytes").alias("size")).agg(F.max("n_tokens").alias("n_tokens"))
            done.append(pending.select(*KEY).distinct().join(counts, ["hash", "size"]).select(*KEY, "n_tokens"))
    counted = huge.select(*KEY, "n_bytes")
    if done:
        found = done[0]
        for d in done[1:]:
            found = found.unionByName(d)
        found = found.select(*[F.col(c).alias(f"{c}_") for c in KEY], "n_tokens")
        counted = counted.join(found, F.expr("doc_id <=> doc_id_ and hash = hash_ and size = size_")).select("doc_id", "n_bytes", "n_tokens")
        small = small.unionByName(counted)
    return small.withColumn("over_limit", F.col("n_tokens") > limit)


def _swap(path: str):
    """Counts whole texts given as (doc_id, text, n_bytes)."""
    whole = _count_whole(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return whole(b.select(["doc_id", "text", b.schema.names[2]]) for b in batches)

    return run
